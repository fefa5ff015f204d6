"""Main text of web pages by wrapper induction.

Pages of one host come from one template.  Per host a reference page is chosen
(the distinct page of smallest hash) and the DOM tree of every distinct page is aligned
with the reference's by simple tree matching.  Per reference node the pages give the
number that hold it, how many repeat its text word for word, and the sum and squares of
their text lengths; the counts are pre-aggregated inside each task, so a host that holds
a third of all pages is a few partial rows.  From them comes the host's wrapper:

* text that nearly all pages repeat is template;
* the content region is found from the root downwards: into the child whose text length
  varies most over the pages, as long as it has most of its parent's variation.  Menus,
  adverts and footers vary in words, but hardly in length.

In a second pass every page is aligned again.  Its text is that of the node aligned with the
region, with the headings that stand before it on the way down, without the blocks made of
template nodes alone and without what by its element, role or class is a menu, header,
footer, sidebar, notice, advert, form, script, style or comment.  Only pages without a
wrapper (hosts too small to align, regions that do not stand out, pages that lack the
region) take their region from ``article``, ``main`` or marked elements.

Equal pages teach once, and a page that repeats most of the reference's largest part (a near
copy of it) teaches nothing, so copies of an article cannot vote it into the template.

The references travel with the pages by a join on the host: broadcast only under
a measured size, otherwise a shuffle that adaptive execution may split.

Defined results: null or empty html has the empty text; a null or unreadable url
is the host ''; a host with fewer than ``min_pages`` distinct pages has no
template; an article that would be all template keeps its text; repeated rows are
each returned; unclosed and misnested elements are read as browsers do in the common
cases; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm import dom
from cinerank.llm.common import BROADCAST_BYTES, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: References kept parsed inside a task, and count rows kept before they are sent on.
CACHE_HOSTS = 256
FLUSH_HOSTS = 2_000
#: Share of a node's variation in text length that a child must have to be the way to the content.
VARIES = 0.7
#: Share of its text with which a part of the reference is its largest, and of it that a near copy repeats.
LARGEST, REPEATS = 0.6, 0.5


class _References:
    """Parsed reference pages by host, the latest CACHE_HOSTS of them."""

    def __init__(self):
        self.kept: dict[str, tuple] = {}

    def of(self, host: str, html: str):
        """(root, nodes in order, text of text nodes, text nodes of the largest part)."""
        if host not in self.kept:
            if len(self.kept) >= CACHE_HOSTS:
                self.kept.pop(next(iter(self.kept)))
            root = dom.parse(html)
            order = dom.number(root)
            size = dom.lengths(order)
            part = root
            while k := next((k for k in part.kids if k.kids and size[k.number] >= LARGEST * size[root.number]), None):
                part = k
            last = part
            while last.kids:
                last = last.kids[-1]
            inside = range(part.number, last.number + 1)
            self.kept[host] = root, order, [dom.clean(n.text) if n.tag == dom.TEXT else "" for n in order], inside
        return self.kept[host]


def _learn(batches):
    """(host, node, seen, same, total, squares) of the reference's text nodes and containers."""
    refs, counts, memo = _References(), {}, {}

    def flush():
        rows = [(h, k, *c) for h, some in counts.items() for k, c in some.items()]
        counts.clear()
        return pd.DataFrame(rows, columns=["host", "node", "seen", "same", "total", "squares"])

    for pdf in batches:
        for host, html, ref_html in zip(pdf["host"], pdf["html"], pdf["ref_html"]):
            if not html or html == ref_html:
                continue
            ref, _, texts, inside = refs.of(host, ref_html)
            page = dom.parse(html)
            size = dom.lengths(dom.number(page))
            pairs = dom.match(ref, page, memo)
            told = {u.number: dom.clean(v.text) for u, v in pairs if u.tag == dom.TEXT}
            if sum(len(t) for k, t in told.items() if k in inside and t == texts[k]) > REPEATS * sum(len(texts[k]) for k in inside):
                continue  # a near copy of the reference
            c = counts.setdefault(host, {})
            for u, v in pairs:
                if u.kids or texts[u.number]:
                    n = size[v.number]
                    a = c.get(u.number, (0, 0, 0, 0))
                    c[u.number] = a[0] + 1, a[1] + (u.tag == dom.TEXT and told[u.number] == texts[u.number]), a[2] + n, a[3] + n * n
            if len(counts) >= FLUSH_HOSTS:
                yield flush()
    yield flush()


def _path(root: dom.Node, stats: dict[int, tuple], least: int) -> list[int]:
    """Reference nodes from the root's child down to the content region; empty when none stands out."""

    def spread(n: dom.Node) -> float:
        seen, _, total, squares = stats.get(n.number, (0, 0, 0, 0))
        return max(0.0, squares / seen - (total / seen) ** 2) ** 0.5 if seen >= least else 0.0

    out, at = [], root
    while True:
        best = max((k for k in at.kids if k.kids), key=spread, default=None)
        # paragraphs hold text and no blocks: they are content, not a way to it
        if best is None or spread(best) <= VARIES * spread(at) or not any(k.tag in dom.BLOCK and k.tag != "br" for k in best.kids):
            return out
        out.append(best.number)
        at = best


def _wrappers(min_pages: int, constant: float):
    """(host, reference, template text nodes, path to the region) from the counts."""

    def run(batches):
        for pdf in batches:
            rows = []
            for host, html, stats in zip(pdf["host"], pdf["ref_html"], pdf["stats"]):
                root = dom.parse(html)
                order = dom.number(root)
                by = {s["node"]: (s["seen"], s["same"], s["total"], s["squares"]) for s in stats}
                fixed = sorted(k for k, s in by.items() if order[k].tag == dom.TEXT and s[0] >= min_pages - 1 and s[1] >= constant * s[0])
                rows.append((host, html, fixed, _path(root, by, min_pages - 1)))
            yield pd.DataFrame(rows, columns=["host", "ref_html", "fixed", "path"])

    return run


def _extracted(html: str | None, ref, texts, fixed: set[int], path: list[int], memo: dict, hints: bool = True) -> str:
    if not html:
        return ""
    page = dom.parse(html)
    gone: set[int] = set()
    roots: list[dom.Node] = []
    if fixed or path:
        dom.number(page)
        pairs = dom.match(ref, page, memo)
        gone = {id(v) for u, v in pairs if u.number in fixed and texts[u.number] == dom.clean(v.text)}
        at = {u.number: v for u, v in pairs}
        way = [page, *(at.get(k) for k in path)]
        if path and way[-1] is not None:
            for above, below in zip(way, way[1:]):
                roots += [k for k in above.kids[: above.kids.index(below)] if k.tag in dom.HEADINGS]
            roots.append(way[-1])
            if text := dom.extract(roots, gone):
                return text
    if not hints:
        return dom.extract([page], gone)
    roots = dom.article_roots(page)
    return dom.extract(roots, gone) or dom.extract(roots, set())


def _apply(batches):
    refs, memo = _References(), {}
    for pdf in batches:
        out = []
        for host, html, ref_html, fixed, path in zip(pdf["host"], pdf["html"], pdf["ref_html"], pdf["fixed"], pdf["path"]):
            fixed = set() if fixed is None else {int(k) for k in fixed}
            path = [] if path is None else [int(k) for k in path]
            ref, _, texts, _ = refs.of(host, ref_html) if fixed or path else (None, None, None, None)
            out.append(_extracted(html, ref, texts, fixed, path, memo))
        yield pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "text": out})


def main_text(pages: DataFrame, min_pages: int = 5, constant: float = 0.9) -> DataFrame:
    """``page_id, url, text`` for every row of ``pages``."""
    if min_pages < 2 or not 0.5 < constant <= 1:
        raise ValueError("min_pages must be at least 2 and constant within (0.5, 1]")
    url = F.col("url").cast("string")
    host = F.lower(F.coalesce(F.nullif(F.regexp_extract(url, r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")), F.lit("")))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), F.coalesce(host, F.lit("")).alias("host"), F.col("html").cast("string").alias("html"))
    keyed = p.where("html IS NOT NULL AND html <> ''").withColumn("hash", F.xxhash64("html"))
    least = keyed.groupBy("host").agg(F.min("hash").alias("hash"))
    ref = keyed.join(F.broadcast(least) if least.count() * 64 <= BROADCAST_BYTES else least, ["host", "hash"])
    ref = written(ref.select("host", F.col("html").alias("ref_html")).dropDuplicates(["host"]), "references")
    size = ref.agg(F.sum(F.octet_length("ref_html") + 64)).first()[0] or 0
    near = (lambda df: F.broadcast(df)) if size <= BROADCAST_BYTES else (lambda df: df)
    both = keyed.select("host", "hash", "html").dropDuplicates(["host", "hash"]).join(near(ref), "host")
    told = both.select("host", "html", "ref_html").mapInPandas(_learn, "host string, node int, seen long, same long, total long, squares long")
    counts = ["seen", "same", "total", "squares"]
    told = told.groupBy("host", "node").agg(*[F.sum(c).alias(c) for c in counts])
    # at most the reference's own nodes per host
    told = told.groupBy("host").agg(F.collect_list(F.struct("node", *counts)).alias("stats"))
    wrap = ref.join(told, "host").mapInPandas(_wrappers(min_pages, constant), "host string, ref_html string, fixed array<int>, path array<int>")
    j = p.join(near(written(wrap, "wrappers")), "host", "left")
    out = j.select("page_id", "url", "host", "html", F.coalesce("ref_html", F.lit("")).alias("ref_html"), "fixed", "path")
    return out.mapInPandas(_apply, "page_id long, url string, text string")
