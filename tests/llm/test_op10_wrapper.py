"""Wrapper induction without any hint in the markup, copies that must not vote, and deep trees."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cinerank.llm import dom
from cinerank.llm import op10_html as op10
from cinerank.llm.common import table

SCHEMA = "page_id long, url string, html string"


def texts(df, **kw):
    return {r.page_id: r.text for r in op10.main_text(df, **kw).collect()}


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(n))


def test_the_wrapper_alone_finds_the_articles(spark):
    """article, main, nav, header, footer and aside become div; classes, ids and roles go."""
    pages = table(spark, "/root/testdata/sf0.01", "pages").select("page_id", "url", "html")
    bare = F.col("html")
    for tag in ("article", "main", "nav", "footer", "header", "aside", "section", "form"):
        bare = F.regexp_replace(bare, rf"(?i)<(/?){tag}\b", "<$1div")
    bare = F.regexp_replace(bare, r"""(?i)\s(class|id|role)=("[^"]*"|'[^']*')""", "")
    bare = pages.withColumn("html", bare)
    want, got, without = texts(pages), texts(bare), texts(bare, min_pages=10**6)
    host = F.regexp_extract("url", "//([^/]*)", 1)
    big = {r.page_id for r in pages.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(host))).where("n >= 8").collect()}
    assert len(big) > 50
    assert sum(want[k] == got[k] for k in big) >= 0.95 * len(big)
    assert sum(want[k] == without[k] for k in big) < 0.5 * len(big)


def site(rng, i, body, extra=""):
    menu = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in ("Home", "News", "About"))
    return f"<html><body><div><ul>{menu}</ul></div><div>{words(rng, 6)}</div><div><h1>Title {i}</h1>{body}{extra}</div><div>&copy; {words(rng, 4)}</div></body></html>"


def body(rng):
    return "".join(f"<p>{words(rng, rng.randrange(5, 60))}</p>" for _ in range(rng.randrange(2, 9)))


def plain(i, b, extra=""):
    return f"Title {i} " + b.replace("<p>", "").replace("</p>", " ").strip() + extra


def test_unmarked_host_with_constant_notice_inside_the_article(spark):
    rng = random.Random(1)
    bodies = [body(rng) for _ in range(30)]
    rows = [(i, "http://a.example/x", site(rng, i, b, "<div>Subscribe to our letter</div>")) for i, b in enumerate(bodies)]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    assert sum(got[i] == plain(i, b) for i, b in enumerate(bodies)) >= 28


def test_copies_of_an_article_teach_once(spark):
    rng = random.Random(2)
    one, other = body(rng), body(rng)
    exact = site(rng, 1, one)
    rows = [(i, "http://b.example/x", exact) for i in range(40)] + [(99, "http://b.example/y", site(rng, 2, other))]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    assert all(one.split("</p>")[0][3:] in got[i] for i in range(40))
    # near copies, one of them the reference: their common paragraphs stay
    near = [one + f"<p>{words(rng, 3)}</p>" for _ in range(36)]
    rows = [(i, "http://c.example/x", site(rng, 1, b)) for i, b in enumerate(near)] + [(100 + i, "http://c.example/y", site(rng, i, body(rng))) for i in range(4)]
    got = texts(spark.createDataFrame(rows, SCHEMA))
    for i, b in enumerate(near):
        assert all(p in got[i] for p in b.replace("<p>", "").split("</p>") if p)


def test_deep_trees_are_matched_to_the_leaves():
    deep = lambda t: dom.parse("<div>" * 3000 + t + "</div>" * 3000)
    a, b = deep("one"), deep("two")
    dom.number(a)
    dom.number(b)
    pairs = dom.match(a, b, {})
    assert len(pairs) == 3002 and pairs[-1][0].text == "one" and pairs[-1][1].text == "two"
