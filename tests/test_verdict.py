"""Repeated ids, exact kNN distances, weighted draws, a heavy user in a training round, saved vectorisers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.operators import catalog, knn, negatives, ranker, recall, text
from cinerank.sources import io


def test_one_row_per_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 3.0), (1, "a", None), (2, None, 1.0), (None, "x", 0.0)], "id long, title string, v double")
    rows = [tuple(r) for r in catalog.one_row_per_key(df, "id").collect()]
    assert sorted(rows, key=str) == sorted([(1, "a", None), (2, None, 1.0), (None, "x", 0.0)], key=str)
    assert catalog.one_row_per_key(df, "id").columns == df.columns


@pytest.mark.parametrize("metric", ["l2", "ip", "cosine"])
def test_knn_with_large_repeated_vectors_and_repeated_ids(spark, metric):
    rng = np.random.default_rng(1)
    base = rng.normal(0, 10, (60, 16))
    x = np.vstack([base, base])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    items = spark.createDataFrame(rows + rows[:5], "iid long, features array<double>")
    queries = spark.createDataFrame(rows[:40], "qid long, features array<double>")
    got = {}
    for r in knn.knn(queries, items, 7, metric, q_block=16, i_block=32).collect():
        got.setdefault(r.qid, []).append((r["rank"], r.iid, r.score))
    y = x / np.linalg.norm(x, axis=1)[:, None] if metric != "l2" else x
    for q in range(40):
        s = np.sqrt(((y - y[q]) ** 2).sum(1)) if metric == "l2" else (y * y[q]).sum(1)
        order = np.lexsort((np.arange(len(y)), np.round(s if metric == "l2" else -s, 9)))[:7]
        mine = sorted(got[q])
        assert [i for _, i, _ in mine] == order.tolist()
        if metric == "l2":
            assert [d for _, _, d in mine][:2] == [0.0, 0.0]


def test_small_inputs_use_every_core(spark):
    n = 20_000
    q = spark.range(n).select(F.col("id").alias("qid"), F.array(F.rand(1), F.rand(2)).alias("features"))
    i = spark.range(500).select(F.col("id").alias("iid"), F.array(F.rand(3), F.rand(4)).alias("features"))
    out = knn.knn(q, i, 3, "ip")
    assert out.count() == 3 * n
    pairs = max(1, -(-n // knn.Q_CHUNK))
    assert pairs >= 2 * spark.sparkContext.defaultParallelism


def test_weighted_negatives_follow_popularity_and_top_up(spark):
    rows = [(u, m) for u in range(300) for m in range(1)] + [(u, 1 + u % 3) for u in range(300)] + [(1000, m) for m in range(4, 40)]
    ratings = spark.createDataFrame(rows, "userId long, movieId long")
    users = spark.range(2000, 2400).select(F.col("id").alias("userId"))
    out = negatives.weighted_negatives(users, recall.seen_pairs(ratings), ratings, n=3).collect()
    per = {}
    for r in out:
        per.setdefault(r.userId, []).append(r.movieId)
    assert len(per) == 400 and all(len(set(v)) == len(v) == 3 for v in per.values())
    share = sum(m == 0 for v in per.values() for m in v) / 400
    assert share > 0.8  # the item with half of all ratings is nearly always among three draws
    most = spark.createDataFrame([(1000,), (5,)], "userId long")
    got = negatives.weighted_negatives(most, recall.seen_pairs(ratings), ratings, n=10).collect()
    mine = {r.movieId for r in got if r.userId == 1000}
    assert mine == {0, 1, 2, 3}  # all that this user has not rated


def test_user_without_candidates_gets_an_empty_list(spark, tmp_path):
    cands = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "userId long, movieId long, rank long")
    io.write_candidates(cands, str(tmp_path / "c"), users=spark.createDataFrame([(1,), (2,)], "userId long"))
    rows = {r.userId: r.candidates for r in spark.read.parquet(str(tmp_path / "c")).collect()}
    assert rows == {1: [10, 11], 2: []}


def _rows(spark, users, heavy):
    rng = np.random.default_rng(3)
    rows = []
    for u in range(users):
        for i in range(heavy if u == 0 else 12):
            lang, x = int(rng.integers(0, 5)), float(rng.normal())
            rows.append((u, u * 10_000 + i, int(lang in (1, 3) and x > -0.5), x, lang, 1.0))
    return spark.createDataFrame(rows, "userId long, movieId long, label int, runtime_z double, lang_idx int, popularity double")


def test_training_with_a_heavy_user_nominal_column_and_early_stop(spark, tmp_path):
    tr, va = _rows(spark, 40, 900), _rows(spark, 25, 12)
    ens, log = ranker.train(tr, va, trees=8, early_stop=2, max_depth=3, checkpoint_every=2, max_bins=32)
    # the labels need a category set: languages 1 and 3 against the others
    assert any(t.cats for t in ens.rounds)
    assert log[-1][2] > 0.8 and ens.best >= 1
    assert len(log) <= 8 and (len(log) == 8 or len(log) - ens.best == 2)
    ens.save(str(tmp_path / "m"))
    again = ranker.Ensemble.load(str(tmp_path / "m"))
    p = ranker.prepare(va)
    a, b = ({(r.userId, r.movieId): r.pred for r in e.predict(p).collect()} for e in (ens, again))
    assert a == b


def test_svd_with_huge_ids_transforms_new_documents_alike(spark):
    base = 3 * 10**12
    docs = spark.createDataFrame([(base + i, f"alpha beta w{i % 4} w{i % 3} gamma{i % 2}") for i in range(40)], "id long, clean_tags string")
    w, vocab = text.tfidf(docs, key="id", text="clean_tags", min_df=2)
    w, vocab = w.checkpoint(), vocab.checkpoint()
    vec, sing, comps = text.svd(w, vocab.count(), 4, key="id", return_components=True)
    again = text.svd_transform(text.tfidf_transform(docs, vocab, 40, key="id", text="clean_tags"), comps, key="id")
    a, b = ({r.id: r.features for r in d.collect()} for d in (vec, again))
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], atol=1e-8) for k in a)


@pytest.mark.parametrize("bad", [0, None])
def test_unbounded_vocabulary_is_refused(spark, bad):
    with pytest.raises((ValueError, TypeError)):
        text.vocabulary(spark.createDataFrame([], "term string, tf long"), max_features=bad)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_knn_keeps_a_running_top_and_moves_no_other_scores(spark, metric):
    """The tops of item blocks do not leave their task: no window over them, and blocks do not change the result."""
    n = knn.Q_CHUNK * 2 * spark.sparkContext.defaultParallelism
    e = spark.range(n).select(F.col("id").alias("qid"), F.array((F.col("id") % 97).cast("float"), (F.col("id") % 89).cast("float"), F.lit(1.0).cast("float")).alias("features"))
    i = e.select(F.col("qid").alias("iid"), "features").where("iid < 600")
    out = knn.knn(e, i, 5, metric, i_block=64)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    whole = knn.knn(e, i, 5, metric)
    assert out.count() == 5 * n and out.exceptAll(whole).isEmpty()


def test_knn_leaves_out_rows_without_a_usable_vector(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (None, [1.0, 1.0]), (6, [0.0, 1.0])]
    e = spark.createDataFrame(rows, "qid long, features array<double>")
    got = knn.knn(e, e.withColumnRenamed("qid", "iid"), 5, "l2").collect()
    assert sorted((r.qid, r.iid) for r in got) == [(1, 1), (1, 6), (6, 1), (6, 6)]
