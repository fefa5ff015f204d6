"""Classifiers on held-out rows, search recall against brute force, wrapper induction, the pipeline."""

import random

import numpy as np
import pytest

from cinerank.llm import dom
from cinerank.llm import op2_quality as op2
from cinerank.llm import op4_ann as op4
from cinerank.llm import op5_toxicity as op5
from cinerank.llm import op10_html as op10
from cinerank.llm.common import BATCH_BYTES
from cinerank.llm.linear import class_prior, fit_nnpu
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def labelled(spark, scored, label):
    return scored.join(read(spark, "labels"), "doc_id").where("held_out").select("score", "predicted", F.col(label).alias("y")).toPandas()


def test_quality_on_held_out_labels(spark):
    docs = read(spark, "documents")
    out = op2.score(docs, op2.train(docs, read(spark, "labels")))
    assert out.count() == docs.count()
    x = labelled(spark, out, "quality")
    assert (x.predicted == x.y).mean() >= 0.95 and x.score.between(0, 1).all()


def test_toxicity_on_held_out_labels(spark):
    big = SF.replace("0.01", "0.1")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    model = op5.train(docs, labels)
    x = op5.score(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), model).join(labels, "doc_id").where("held_out").toPandas()
    assert (x.predicted == x.toxic).mean() >= 0.97
    assert x[x.toxic == 1].predicted.mean() >= 0.8 and x[x.toxic == 0].predicted.mean() <= 0.02


def test_prior_and_non_negative_risk_on_a_known_mixture():
    rng = np.random.default_rng(0)
    p = rng.normal(2.0, 1.0, (4000, 3))
    pos = rng.random(8000) < 0.7
    u = np.where(pos[:, None], rng.normal(2.0, 1.0, (8000, 3)), rng.normal(-2.0, 1.0, (8000, 3)))
    w, b = fit_nnpu(p[::2], u[::2], 0.5, 1e-3, 300, 0.02)
    prior = class_prior(p[1::2] @ w + b, u[1::2] @ w + b)
    assert abs(prior - 0.7) < 0.06
    w, b = fit_nnpu(p, u, prior, 1e-4, 800, 0.02)
    assert ((u @ w + b > 0) == pos).mean() > 0.97


def test_scores_of_nulls_empty_and_long_texts(spark, make):
    rows = [(1, None), (2, ""), (3, "plain text " * 30_000), (None, "a"), (4, "a"), (4, "a")]
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(200)] + [(None, 1, 1), (500, None, None)], "doc_id long, quality int, toxic int")
    train = make([(i, f"good clean words {i} here" if i % 2 else f"JUNK!! JUNK!! idiot {i}!!") for i in range(200)])
    for op, name in ((op2, "quality"), (op5, "toxic")):
        m = op.train(train, labels, name)
        out = op.score(make(rows), m).collect()
        assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
        by = {}
        for r in out:
            by.setdefault(str(r.doc_id), set()).add(round(r.score, 12))
        assert by["1"] == by["2"] and len(by["4"]) == 1
        assert op.score(make([]), m).count() == 0
        none = op.train(make([]), labels.limit(0), name)
        assert len({r.score for r in op.score(make(rows), none).collect()}) == 1
    kept = op2.keep_good(make(rows), op2.train(train, labels))
    assert kept.columns == make(rows).columns


def brute_nearest(ids, x, q, k):
    s = (x * x[q]).sum(1)
    s[ids == ids[q]] = -np.inf
    by = np.lexsort((ids, -s))
    return [(int(ids[i]), s[i]) for i in by[:k] if np.isfinite(s[i])]


def test_search_recall_and_exact_scores(spark):
    df = read(spark, "embeddings")
    pdf = df.toPandas().sort_values("vec_id")
    ids, x = pdf.vec_id.to_numpy(), np.stack(pdf.embedding.to_list()).astype(np.float64)
    out = op4.search(df, F.col("id") % 20 == 0, leaf_rows=8, rows_per_leaf=1, branch=4, sample=200, shelf_rows=16, calibrate=20).toPandas()
    hit = tot = 0
    for q in np.flatnonzero(ids % 20 == 0):
        got = out[out.query_id == ids[q]].sort_values("rank")
        assert got["rank"].tolist() == list(range(1, 21))
        s = (x * x[q]).sum(1)
        assert np.allclose(got.score, [s[np.flatnonzero(ids == v)[0]] for v in got.vec_id], atol=1e-12)
        hit += len(set(got.vec_id) & {v for v, _ in brute_nearest(ids, x, q, 20)})
        tot += 20
    assert hit / tot >= 0.9


def test_walk_goes_on_until_the_leaves_hold_enough():
    x = np.random.default_rng(4).normal(size=(200, 4))
    tree = op4.Tree(x, 4, 8)
    held = np.bincount(tree.assign(x), minlength=tree.leaves)
    for q in x[:40]:
        went = tree.walk(q, 1, held, 21)
        assert held[went].sum() >= 21 and went[:1] == tree.walk(q, 1)
    assert len(tree.walk(x[0], 1, held, 1_000)) == tree.leaves


def test_search_ties_equal_vectors_and_unusable_rows(spark):
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(0, 300)] + [(1000 + i, [0.5, float(i % 7), 1.0]) for i in range(50)]
    bad = [(None, [1.0, 0.0, 0.0]), (2000, None), (2001, [0.0, 0.0, 0.0]), (2002, [1.0, None, 0.0]), (2003, [float("nan"), 1.0, 0.0]), (2004, [1.0]), (2005, [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame(rows + bad + [rows[0]], "vec_id long, embedding array<double>")
    out = op4.search(df, F.col("id") % 20 == 0, k=5, recall=1.0, shelf_rows=8, leaf_rows=2, rows_per_leaf=1, branch=2).collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    for q in np.flatnonzero(ids % 20 == 0):
        got = [(r.vec_id, r.score) for r in sorted((r for r in out if r.query_id == ids[q]), key=lambda r: r.rank)]
        want = brute_nearest(ids, x, q, 5)
        if ids[q] < 300:
            assert got == want
        else:
            assert len(got) == 5
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.vec_id, r.score) for r in op4.search(few, F.col("id") % 20 == 0).collect()] == [(0, 1, 4.0)]
    assert op4.search(few.limit(0), F.col("id") % 20 == 0).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T {i}</title><script>var t="</p>";</script><style>p{{}}</style></head><body>
<header>Site name</header><nav><ul><li><a href=x>Menu {i}</a><li>More</ul></nav><div class="cookie-notice">We use cookies {i}</div>
<article><h1>Title {i}</h1><div>Read this first</div><p>First&nbsp;part {i} &amp; <b>bo</b>ld<br>line<p>Second {i}
 part</p><div class=ad>Buy {i}</div><form>Mail <input></form></article>
<aside>Side {i}</aside><section id="comments"><p>Nice {i}!</p></section><footer>&copy; {i}</footer></body></html>"""


def test_wrapper_and_roles(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(i=i)) for i in range(12)] + [(100, "http://b.example/1", PAGE.format(i=100))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in op10.main_text(df).collect()}
    for i in range(12):  # the constant block inside the article is the host's template
        assert got[i] == f"Title {i} First part {i} & bold line Second {i} part"
    assert got[100] == "Title 100 Read this first First part 100 & bold line Second 100 part"


def test_html_edges(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    rows = [(1, None, None), (2, "no url", ""), (None, "http://c/", "plain &lt;text&gt;"), (3, "http://c/", "<p>one<p>two"), (3, "http://c/", "<p>one<p>two"), (4, "http://c/", "<article><p>x</article"), (5, "http://c/", "<!-- <article>no</article> --><p>a<b>b</p>c"), (6, "http://d/", deep), (7, "http://c/", "<p>" + "long word " * 100_000), (8, "http://c/", "<a href='x>y\" broken <p>z</p>")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text) for r in op10.main_text(df).collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert by[1] == "" and by[2] == "" and by[None] == "plain <text>" and by[3] == "one two" and by[4] == "x" and by[5] == "ab c" and by[6] == "deep"
    assert len(by[7]) == 999_999
    assert op10.main_text(df.limit(0)).count() == 0


def brute_match(a, b):
    if a.tag != b.tag:
        return 0
    m, n = len(a.kids), len(b.kids)
    t = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(m):
        for j in range(n):
            t[i + 1][j + 1] = max(t[i][j + 1], t[i + 1][j], t[i][j] + brute_match(a.kids[i], b.kids[j]))
    return t[m][n] + 1


def test_tree_matching_is_the_largest():
    rng = random.Random(6)

    def tree(depth):
        return "".join(f"<{t}>{tree(depth - 1) if depth else 'x'}</{t}>" for t in rng.choices(["div", "ul", "i"], k=rng.randrange(0, 4)))

    memo = {}
    for _ in range(60):
        a, b = dom.parse(tree(3)), dom.parse(tree(3))
        dom.number(a), dom.number(b)
        pairs = dom.match(a, b, memo)
        assert len(pairs) == brute_match(a, b)
        assert all(u.tag == v.tag for u, v in pairs) and len({id(u) for u, _ in pairs}) == len(pairs) == len({id(v) for _, v in pairs})


def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    from tests.llm.test_op8_ngram_join import brute

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cols, seen = docs.columns, {}
    for name, stage in cp.STAGES:
        before, docs = docs, cp.written(stage(spark, docs, sf), "test")
        seen[name] = (before, docs)
        if name != cp.STAGES[-1][0]:
            assert docs.columns == cols
    a, b = seen["dedup"]
    rows = [(r.doc_id, r.text) for r in a.collect()]
    assert {r.doc_id for r in b.collect()} == {c for _, _, c in brute(rows)}
    a, b = seen["shard"]
    assert a.count() == b.count()
    with_labels = seen["quality"][1].join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert with_labels.where("quality = 0").count() <= 2


def test_registered_names():
    import __spark_entry__ as e

    names = e.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


@pytest.mark.parametrize("name", ["op7_line_dedup", "op8_ngram_join"])
def test_query_equals_its_sql(spark, name):
    import __spark_entry__ as e
    from tools.oracle_check import duck, rows_of

    df = e.queries()[name](spark, SF)
    cols, rows = duck(SF, e.oracle_sql()[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, rows)


def test_quality_sends_python_small_batches(monkeypatch, spark):
    """A partition of 30 MB in few rows is not one batch, neither for the fit nor for the rows kept."""

    def sized(batches):
        for rb in batches:
            x = np.zeros((rb.num_rows, op2.N_FEATURES), dtype=np.float32)
            x[:, 0] = rb.nbytes
            yield rb, x

    class Small:
        def score(self, x):
            return (x[:, 0] < 2 * BATCH_BYTES).astype(float)

    seen = []
    monkeypatch.setattr(op2, "_featured", sized)
    monkeypatch.setattr(op2, "_expand", lambda x, mean, inv: seen.append(x[:, 0].max()) or np.zeros_like(x))
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab cd efgh\n"), 1000).alias("text"))
    labels = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    op2.train(docs, labels)
    assert 0 < seen[0] < 2 * BATCH_BYTES
    assert op2.keep_good(docs, Small()).count() == 3000
