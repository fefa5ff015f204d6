"""Second implementations, invariants and edge fixtures."""

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cinerank.functions import nested
from cinerank.functions.hashing import md5_key
from cinerank.functions.primes import is_prime, next_prime
from cinerank.functions.ranking import global_rank, group_rank, sorted_rank
from cinerank.functions.vectors import l2_normalize
from cinerank.operators import catalog, features, knn, lambdarank, metrics, negatives, recall
from cinerank.sources import fixtures
from tests.conftest import SF


def _emb(spark):
    return fixtures.embeddings(spark, SF)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_block_knn_matches_brute_force(spark, metric):
    e = _emb(spark)
    pdf = e.toPandas()
    ids = pdf["id"].to_numpy()
    X = np.stack(pdf["features"].to_numpy()).astype(np.float64)
    # exclusion list: every query masks the three ids that follow it
    ex = spark.createDataFrame([(int(q), int(ids[(i + j) % len(ids)])) for i, q in enumerate(ids) for j in (1, 2, 3)], "qid long, iid long")
    got = knn.knn(e.select(F.col("id").alias("qid"), "features"), e.select(F.col("id").alias("iid"), "features"), 7, metric,
                  exclude=ex, q_block=37, i_block=53).toPandas()
    if metric == "cosine":
        Xn = X / np.linalg.norm(X, axis=1, keepdims=True)
        S = Xn @ Xn.T
    else:
        S = -np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    for i, q in enumerate(ids):
        masked = {int(ids[(i + j) % len(ids)]) for j in (1, 2, 3)}
        order = sorted((j for j in range(len(ids)) if int(ids[j]) not in masked), key=lambda j: (-round(S[i, j], 9), ids[j]))[:7]
        exp = [int(ids[j]) for j in order]
        g = got[got.qid == q].sort_values("rank")
        assert g["iid"].tolist() == exp
        assert g["rank"].tolist() == list(range(1, 8))


def test_knn_rejects_unknown_metric(spark):
    e = _emb(spark).select(F.col("id").alias("qid"), "features")
    with pytest.raises(ValueError):
        knn.knn(e, e.withColumnRenamed("qid", "iid"), 3, "manhattan")


def test_ranks_equal_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("g"), (F.col("id") * 7919 % 1000).alias("v"), "id")
    exp = df.withColumn("e", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), "id")))
    got = group_rank(df, "g", [F.desc("v"), F.asc("id")], out="rn")
    assert got.join(exp, ["g", "v", "id"]).filter(F.col("rn") != F.col("e")).count() == 0
    s = sorted_rank(df, [F.asc("v"), F.asc("id")], out="r")
    s_exp = df.withColumn("e", F.row_number().over(Window.orderBy("v", "id")))
    assert s.join(s_exp, ["g", "v", "id"]).filter(F.col("r") != F.col("e")).count() == 0
    h = global_rank(df, md5_key("id"), ["id"], out="r", prefix_len=2)
    h_exp = df.withColumn("e", F.row_number().over(Window.orderBy(F.md5(F.col("id").cast("string")), "id")))
    assert h.join(h_exp, ["g", "v", "id"]).filter(F.col("r") != F.col("e")).count() == 0


def test_primes():
    assert [p for p in range(30) if is_prime(p)] == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29]
    assert next_prime(1_000_000) == 1_000_003
    assert next_prime(0) == 2


def test_easy_negative_invariants(spark):
    ratings = spark.createDataFrame(
        [(u, i, 3.0) for u in range(1, 30) for i in range(100 + u, 100 + u + (u % 9) + 1)] + [(99, i, 3.0) for i in range(100, 160)],
        "userId long, movieId long, rating double",
    )
    seen = recall.seen_pairs(ratings)
    users = ratings.select("userId").distinct()
    a = negatives.easy_negatives(users, seen, ratings, n=5).toPandas()
    b = negatives.easy_negatives(users.repartition(7), seen.repartition(3), ratings.repartition(5), n=5).toPandas()
    key = lambda d: sorted(map(tuple, d[["userId", "movieId", "draw"]].to_numpy().tolist()))
    assert key(a) == key(b)  # independent of partitioning
    pool = {r.movieId for r in ratings.select("movieId").distinct().collect()}
    s = {(r.userId, r.movieId) for r in seen.collect()}
    for u, g in a.groupby("userId"):
        items = g["movieId"].tolist()
        assert len(items) == len(set(items))
        assert all((u, i) not in s and i in pool for i in items)
        unseen = len(pool - {i for (uu, i) in s if uu == u})
        assert len(items) == min(5, unseen)  # user 99 has seen the whole pool → none
    assert 99 not in set(a["userId"])


def test_merge_properties(spark):
    mf = spark.createDataFrame([(1, 10 + r, r) for r in range(1, 6)] + [(2, 20, 1)], "userId long, movieId long, rank int")
    ct = spark.createDataFrame([(1, x, r) for r, x in enumerate([13, 30, 10, 31], start=1)] + [(3, 40, 1)], "userId long, movieId long, rank int")
    u = recall.merge_lists(mf, ct, "union", top_r=7).orderBy("userId", "pos").collect()
    assert [(r.userId, r.movieId) for r in u] == [(1, 11), (1, 12), (1, 13), (1, 14), (1, 15), (1, 30), (1, 10), (2, 20)]
    i = recall.merge_lists(mf, ct, "interleave", top_r=10).orderBy("userId", "pos").collect()
    assert [r.movieId for r in i if r.userId == 1] == [11, 13, 12, 30, 10, 14, 31]
    assert all(r.userId != 2 for r in i)  # zip stops at the shorter (empty) list
    w = recall.merge_lists(mf, ct, "weighted", top_r=3).orderBy("userId", "pos").collect()
    # scores: 11:2.5 12:2.0 13:1.5+2.0=3.5 14:1.0 15:0.5 30:1.5 10:1.0 31:0.5
    assert [r.movieId for r in w if r.userId == 1] == [13, 11, 12]
    with pytest.raises(ValueError):
        recall.merge_lists(mf, ct, "zipper")


def _np_metrics(labels_by_pred, k):
    y = np.array(labels_by_pred)
    top = y[:k]
    if y.sum() == 0:
        return 0.0, 0.0
    ap = 0.0 if top.sum() == 0 else float((np.cumsum(top) / np.arange(1, top.size + 1) * top).sum() / min(y.sum(), k))
    dcg = float((top / np.log2(np.arange(2, top.size + 2))).sum())
    ideal = np.sort(y)[::-1][:k]
    idcg = float((ideal / np.log2(np.arange(2, ideal.size + 2))).sum())
    return ap, dcg / idcg


def test_metrics_against_numpy_and_evaluator(spark):
    rng = np.random.default_rng(3)
    rows = []
    for u in range(40):
        n = int(rng.integers(2, 25))
        for i in range(n):
            rows.append((u, 1000 + i, int(rng.random() < 0.3), float(rng.integers(0, 6))))
    df = spark.createDataFrame(rows, "userId long, movieId long, label int, pred double")
    got = {r.userId: (r.ap, r.ndcg) for r in metrics.per_user(df, 10).collect()}
    for u in range(40):
        mine = sorted([r for r in rows if r[0] == u], key=lambda r: (-r[3], r[1]))
        ap, nd = _np_metrics([r[2] for r in mine], 10)
        assert got[u][0] == pytest.approx(ap, abs=1e-12)
        assert got[u][1] == pytest.approx(nd, abs=1e-12)
    from pyspark.ml.evaluation import RankingEvaluator

    w = Window.partitionBy("userId").orderBy(F.desc("pred"), "movieId")
    lists = (df.withColumn("rn", F.row_number().over(w)).groupBy("userId")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("rn", F.col("movieId").cast("double").alias("m")))), lambda s: s["m"]).alias("prediction"),
                  F.collect_list(F.when(F.col("label") == 1, F.col("movieId").cast("double"))).alias("label"))
             .filter(F.size("label") > 0))
    ev = RankingEvaluator(k=10, metricName="ndcgAtK")
    users_pos = {r[0] for r in rows if r[2] == 1}
    exp_ndcg = sum(got[u][1] for u in users_pos) / len(users_pos)
    assert ev.evaluate(lists) == pytest.approx(exp_ndcg, abs=1e-9)


def test_lambda_gradients_against_numpy(spark):
    rng = np.random.default_rng(7)
    rows = [(1, 500 + i, int(rng.random() < 0.4), float(rng.normal())) for i in range(45)]
    df = spark.createDataFrame(rows, "userId long, movieId long, label int, score double")
    got = {r.movieId: (r.grad, r.hess) for r in lambdarank.gradients(lambdarank.ranked_rows(df)).collect()}
    order = sorted(rows, key=lambda r: (-r[3], r[1]))
    n_pos = sum(r[2] for r in rows)
    inv = 1.0 / sum(1 / math.log2(1 + i) for i in range(1, min(n_pos, 30) + 1))
    g = {r[1]: 0.0 for r in rows}
    h = dict(g)
    tot = 0.0
    for i in range(min(30, len(order))):
        for j in range(i + 1, len(order)):
            a, b = order[i], order[j]
            if a[2] == b[2]:
                continue
            hi, lo = (a, b) if a[2] > b[2] else (b, a)
            ds = hi[3] - lo[3]
            d = abs(1 / math.log2(2 + i) - 1 / math.log2(2 + j)) * inv / (0.01 + abs(ds))
            rho = 1 / (1 + math.exp(ds))
            g[hi[1]] -= d * rho
            g[lo[1]] += d * rho
            h[hi[1]] += d * rho * (1 - rho)
            h[lo[1]] += d * rho * (1 - rho)
            tot += 2 * d * rho
    f = math.log2(1 + tot) / tot
    for m in g:
        assert got[m][0] == pytest.approx(g[m] * f, abs=1e-12)
        assert got[m][1] == pytest.approx(h[m] * f, abs=1e-12)


def test_nested_parsing_edges(spark):
    df = spark.createDataFrame(
        [("[{\"name\": \"a\"}, 3, \"s\", {\"id\": 5}, {\"name\": null}]",), ("{\"name\": \"x\"}",), ("garbage",), (None,),
         ("[{'name': 'Q', 'flag': True}]",)], "s string")
    out = df.select(nested.names(nested.object_list(F.col("s"))).alias("n")).collect()
    assert [r.n for r in out] == [["a", "", None], [], [], [], ["Q"]]


def test_title_resolution_both_sides(spark):
    items = spark.createDataFrame([(1, "orig", "t1"), (2, "o2", None)], "id long, original_title string, title string")
    credits = spark.createDataFrame([(1, "credit-title"), (2, "c2")], "movie_id long, title string")
    out = {r.id: r.title for r in catalog.join_credits(items, credits).collect()}
    assert out == {1: "orig", 2: "o2"}
    only_items = {r.id: r.title for r in catalog.join_credits(items, credits.drop("title")).collect()}
    assert only_items == {1: "t1", 2: "o2"}


def test_dedup_keeps_first(spark):
    df = spark.createDataFrame([(7, 3, "c"), (7, 1, "a"), (7, 2, "b"), (8, 5, "z")], "id long, pos long, title string")
    got = {r.id: (r.pos, r.title, r.n_copies) for r in catalog.first_per_key(df, "id", "pos", ["title"]).collect()}
    assert got == {7: (1, "a", 3), 8: (5, "z", 1)}


def test_zero_vector_stays_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    assert [r.n for r in df.select(l2_normalize(F.col("v")).alias("n")).collect()] == [[0.0, 0.0], [0.6, 0.8]]


def test_null_path_sentinels(spark, tmp_path):
    df = spark.range(3)
    for p in ("none", "NULL", "nul", "/dev/null", "-"):
        assert features.write_rows(df, p) is False
    assert features.write_rows(df, str(tmp_path / "out")) is True
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_group_sizes_consistent(spark):
    rows = spark.createDataFrame([(1, 10, 1), (1, 11, 0), (2, 12, 1)], "userId long, movieId long, label int")
    assert features.group_sizes_consistent(rows)


def test_tfidf_transform_matches_fit_on_same_corpus(spark):
    from cinerank.operators import text

    docs = fixtures.documents(spark, SF)
    w, vocab = text.tfidf(docs)
    again = text.tfidf_transform(docs, vocab, docs.count())
    a = {(r.doc_id, r.term): round(r.weight, 12) for r in w.collect()}
    b = {(r.doc_id, r.term): round(r.weight, 12) for r in again.collect()}
    assert a == b


def test_lemmas_are_put_back_in_place(spark):
    from cinerank.operators import catalog

    df = spark.createDataFrame([(1, ["cats", "run", "cats", "ran"]), (2, []), (3, ["x"])], "id long, lemmas array<string>")
    words = spark.createDataFrame([("cats", "cat"), ("ran", "run"), ("ran", "rune"), ("x", None), (None, "y")], "token string, lemma string")
    got = {r.id: r.lemmas for r in catalog.lemmatised(df, words, "id").collect()}
    assert got == {1: ["cat", "run", "cat", "run"], 2: [], 3: ["x"]}
    assert {r.id: r.lemmas for r in catalog.lemmatised(df, words.limit(0), "id").collect()} == {1: ["cats", "run", "cats", "ran"], 2: [], 3: ["x"]}


def test_knn_candidates_in_single_precision_lose_no_close_neighbour():
    """Scores closer together than floats are told apart; numbers too large for floats are too."""
    from cinerank.operators import knn

    rng = np.random.default_rng(1)
    for metric, scale in (("cosine", 1.0), ("l2", 1.0), ("l2", 1e20)):
        q = rng.standard_normal((3, 64)) * scale
        x = q[rng.integers(0, 3, 4000)] + rng.standard_normal((4000, 64)) * 1e-7 * scale
        if metric == "cosine":
            q, x = knn._unit(q), knn._unit(x)
        none = np.zeros(0, np.int64)
        t = knn._Tops(20, metric, np.arange(3), q, none, none)
        assert t.kind is (np.float64 if scale > 1 else np.float32)
        for a in range(0, 4000, 500):
            t.add(np.arange(a, a + 500), x[a : a + 500])
        got = [np.concatenate(v) for v in zip(*t.rows())]
        for i in range(3):
            exact = np.round(knn._exact(metric, q[i], x), knn.RANK_DECIMALS)
            want = np.lexsort((np.arange(4000), exact if metric == "l2" else -exact))[:20]
            assert got[1][got[0] == i].tolist() == want.tolist()
