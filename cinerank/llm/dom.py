"""A small tolerant HTML reader and the simple tree matching of two page trees."""

from __future__ import annotations

import re
import sys
from html import unescape

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|$)"
    r"|<[!?/][^>]*(?:>|$)",
    re.S,
)
#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math select object canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"br", "html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "summary"}
#: Elements that an opening tag ends, and the element beyond which it does not look.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Elements, roles and class or id words that mark what is not the article.
BOILER_TAGS = frozenset("nav header footer aside form button dialog menu head label input".split()) | (RAW - {"object"})
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login search share sharing social related recommended comment comments reply replies "
    "respond disqus pagination pager toolbar widget widgets skip toc copyright disclaimer form".split()
)
CONTENT_WORDS = frozenset("content article post entry story main body text".split())
_ATTR = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-zA-Z]+")

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TEXT = "#"


class Node:
    __slots__ = ("tag", "kids", "text", "boiler", "content", "number", "shape")

    def __init__(self, tag: str, text: str = ""):
        self.tag, self.text, self.kids = tag, text, []
        self.boiler = self.content = False
        self.number, self.shape = -1, 0


def _marks(node: Node, attrs: str) -> None:
    for m in _ATTR.finditer(attrs):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name == "role":
            node.boiler |= value.lower() in BOILER_ROLES
            node.content |= value.lower() in ("main", "article")
        elif name in ("class", "id"):
            words = {w.lower() for w in _WORD.findall(value)}
            if "no" not in words and "has" not in words and "with" not in words:
                node.boiler |= not BOILER_WORDS.isdisjoint(words)
            node.content |= not CONTENT_WORDS.isdisjoint(words)
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            node.boiler = True
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            node.boiler = True


def parse(html: str) -> Node:
    """The page as a tree; text is kept raw (references undecoded) in ``#`` nodes."""
    root = Node("html")
    stack = [root]
    pos, end = 0, len(html)
    while pos < end:
        m = _TOKEN.search(html, pos)
        stop = m.start() if m else end
        if stop > pos:
            stack[-1].kids.append(Node(TEXT, html[pos:stop]))
        if m is None:
            break
        pos = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        attrs = m[3] or m[6] or ""
        if tag in ("html", "body") and any(x.tag == tag for x in stack):
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCK:
                    break
        if tag in IMPLIED:
            ends, within = IMPLIED[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in within:
                    break
                if stack[k].tag in ends:
                    del stack[k:]
                    if tag != "tr":
                        break
                    break
        node = Node(tag)
        node.boiler = tag in BOILER_TAGS
        node.content = tag in ("article", "main")
        if attrs and not attrs.isspace():
            _marks(node, attrs)
        stack[-1].kids.append(node)
        if tag in RAW:
            if not attrs.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, pos)
                stop = close.start() if close else end
                pos = html.find(">", stop) + 1 if close else end
                if pos == 0:
                    pos = end
            continue
        if tag not in VOID and not attrs.endswith("/"):
            stack.append(node)
    return root


def clean(text: str) -> str:
    return " ".join((unescape(text) if "&" in text else text).split())


def number(root: Node) -> list[Node]:
    """All nodes in page order, numbered; sets subtree shapes."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        n.number = len(order)
        order.append(n)
        todo.extend(reversed(n.kids))
    for n in reversed(order):
        n.shape = hash((n.tag, tuple(k.shape for k in n.kids))) if n.kids else hash(n.tag)
    return order


#: Alignment tables kept between pages, by the two subtree shapes.
MEMO_TABLES = 20_000


def _size(a: Node, b: Node, memo: dict) -> int:
    """Size of the largest match of two subtrees whose tables, if they need one, are in ``memo``."""
    if a.tag != b.tag:
        return 0
    if not a.kids or not b.kids:
        return 1
    t = memo[a.shape, b.shape]
    return 1 + (t if isinstance(t, int) else t[-1][-1])


def _table(a: Node, b: Node, memo: dict) -> list[list[int]] | int:
    """Best match sizes of the first i and j children, or one number when every child has the same shape.

    Tables of the children are made first, from a stack, so trees of any depth are matched.
    """
    todo = [(a, b)]
    while todo:
        u, v = todo[-1]
        key = (u.shape, v.shape)
        if key in memo:
            todo.pop()
            continue
        x, y = u.kids, v.kids
        first = x[0].shape
        alike = all(k.shape == first for k in x) and all(k.shape == first for k in y)
        pairs = [(x[0], y[0])] if alike else [(p, q) for p in x for q in y]
        needed = {(p.shape, q.shape): (p, q) for p, q in pairs if p.tag == q.tag and p.kids and q.kids and (p.shape, q.shape) not in memo}
        if needed:
            todo += needed.values()
            continue
        todo.pop()
        if alike:
            memo[key] = min(len(x), len(y)) * _size(x[0], y[0], memo)
            continue
        got = [[0] * (len(y) + 1)]
        for p in x:
            prev, row, left = got[-1], [0], 0
            for j, q in enumerate(y):
                w = prev[j] + _size(p, q, memo) if p.tag == q.tag else 0
                left = max(left, prev[j + 1], w)
                row.append(left)
            got.append(row)
        memo[key] = got
    return memo[a.shape, b.shape]


def match(a: Node, b: Node, memo: dict) -> list[tuple[Node, Node]]:
    """Node pairs of the largest order- and level-keeping match of two numbered trees (simple
    tree matching).  ``memo`` may be shared between calls: sizes depend on shapes alone."""
    if len(memo) > MEMO_TABLES:
        memo.clear()
    out, todo = [], [(a, b)] if a.tag == b.tag else []
    while todo:
        u, v = todo.pop()
        out.append((u, v))
        if not u.kids or not v.kids:
            continue
        t = _table(u, v, memo)
        if isinstance(t, int):
            todo += zip(u.kids, v.kids)
            continue
        i, j = len(u.kids), len(v.kids)
        while i and j:
            if t[i][j] == t[i - 1][j]:
                i -= 1
            elif t[i][j] == t[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((u.kids[i], v.kids[j]))
    return out


def lengths(order: list[Node]) -> list[int]:
    """Characters of text under each node of a numbered tree."""
    out = [len(n.text.strip()) if n.tag == TEXT else 0 for n in order]
    for n in reversed(order):
        for k in n.kids:
            out[n.number] += out[k.number]
    return out


def _holds(node: Node, tags: frozenset) -> bool:
    todo = list(node.kids)
    while todo:
        n = todo.pop()
        if n.tag in tags and not n.boiler:
            return True
        todo.extend(n.kids)
    return False


_MAIN = frozenset(("article", "main"))


def article_roots(root: Node) -> list[Node]:
    """Where the article is: ``article`` elements, else ``main``, else marked content, else the page."""
    found: dict[str, list[Node]] = {"article": [], "main": [], "marked": []}
    todo = [root]
    while todo:
        n = todo.pop()
        if n.boiler and n is not root and (n.tag in BOILER_TAGS or not _holds(n, _MAIN)):
            continue
        if n.tag == "article":
            found["article"].append(n)
            continue
        if n.tag == "main":
            found["main"].append(n)
        elif n.content and n.tag != "body":
            found["marked"].append(n)
        todo.extend(reversed(n.kids))
    if found["article"]:
        return found["article"]
    for kind in ("main", "marked"):
        if found[kind]:
            outer, inside = [], set()
            for n in found[kind]:
                if id(n) not in inside:
                    outer.append(n)
                    below = list(n.kids)
                    while below:
                        k = below.pop()
                        inside.add(id(k))
                        below.extend(k.kids)
            return outer
    return [root]


def extract(roots: list[Node], template: set[int]) -> str:
    """The roots' text by blocks, without boilerplate and without the blocks all of whose ``#`` nodes
    have their id in ``template`` (a constant word inside a varying block is content)."""
    blocks, run, fresh = [], [], False

    def cut():
        nonlocal fresh
        if fresh:
            t = clean("".join(run))
            if t:
                blocks.append(t)
        run.clear()
        fresh = False

    todo: list = list(reversed(roots))
    while todo:
        n = todo.pop()
        if n is None:
            cut()
        elif n.tag == TEXT:
            run.append(n.text)
            fresh = fresh or (id(n) not in template and not n.text.isspace())
        elif not n.boiler or n in roots:
            if n.tag in BLOCK and n.tag != "br":
                cut()
                todo.append(None)
            elif n.tag == "br":
                run.append(" ")
            todo.extend(reversed(n.kids))
    cut()
    return " ".join(blocks)
