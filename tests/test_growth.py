"""What a query moves and keeps grows with its input only."""

import numpy as np
from pyspark.sql import functions as F

from cinerank.operators import als, catalog, negatives, recall, text


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _docs(spark, n=150):
    rng = np.random.default_rng(5)
    return spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.integers(0, 40, 30))) for i in range(n)], "doc_id long, text string")


def test_tfidf_shuffles_texts_and_not_terms(spark):
    docs = _docs(spark)
    w, vocab = text.tfidf(docs)
    assert ", term" not in "".join(line for line in _plan(w).splitlines() if "hashpartitioning(doc_id" in line)
    assert vocab.where("df < 3").isEmpty() and w.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("s")).where("abs(s - 1) > 1e-9").isEmpty()
    # rows with the same key are one document, as one without a key is
    twice = spark.createDataFrame([(1, "aa bb"), (1, "aa"), (None, "aa bb"), (2, "bb aa")], "doc_id long, text string")
    tf = {(r.doc_id, r.term): r.tf for r in text.doc_terms(twice).collect()}
    assert tf[1, "aa"] == 2 and tf[1, "aa bb"] == 1 and tf[None, "aa"] == 1


def test_lemmas_go_back_into_rows_without_a_shuffle_of_tokens(spark, monkeypatch):
    df = catalog.content_tokens(spark.createDataFrame([(1, "cats dog cats"), (2, None), (3, "dogs")], "id long, text string").repartition("id"), "text")
    pairs = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "token string, lemma string")
    made = catalog.lemmatised(df, pairs, "id")
    assert "hashpartitioning(_key" not in _plan(made) and "hashpartitioning(token" not in _plan(made)
    exp = [(1, ["cat", "dog", "cat"]), (2, []), (3, ["dog"])]
    assert sorted((r.id, r.lemmas) for r in made.collect()) == exp
    monkeypatch.setattr(catalog, "DICTIONARY_ROWS", 0)
    assert sorted((r.id, r.lemmas) for r in catalog.lemmatised(df, pairs, "id").collect()) == exp


def test_svd_takes_one_job_an_iteration(spark):
    w, vocab = text.tfidf(_docs(spark))
    w, n = w.checkpoint(), vocab.count()
    spark.sparkContext.setJobGroup("svd-jobs", "svd")
    vec, sing = text.svd(w, n, k=5, n_iter=4)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("svd-jobs"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 4 + 6
    a = np.zeros((150, n))
    for r in w.collect():
        a[r.doc_id, r.term_idx] = r.weight
    s = np.linalg.svd(a, compute_uv=False)
    assert abs(sing[0] - s[0]) < 1e-6 * s[0]
    x = np.array([r.features for r in sorted(vec.collect(), key=lambda r: r.doc_id)])
    assert x.shape == (150, 5) and abs((x[:, 0] ** 2).sum() - s[0] ** 2) < 1e-6 * s[0] ** 2


def test_weighted_draws_are_made_once(spark):
    ratings = spark.createDataFrame([(u, (u * i) % 50) for u in range(1, 40) for i in range(1, 9)], "userId long, movieId long")
    out = negatives.weighted_negatives(ratings.select("userId"), recall.seen_pairs(ratings), ratings, n=5)
    assert _plan(out).count("Generate explode") <= 1
    assert out.groupBy("userId").agg(F.count_distinct("movieId").alias("n")).where("n != 5").isEmpty()


def test_als_lets_go_of_old_messages(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(als, "drop_unused_checkpoints", calls.append)
    conf = spark.createDataFrame([(u, m, 1.0 + (u * m) % 5) for u in range(20) for m in range(15) if (u + m) % 3], "userId long, movieId long, confidence double")
    als.train(conf, factors=4, iters=3, blocks=2)
    assert len(calls) == 6


def test_lists_are_dealt_by_their_own_size(spark, monkeypatch):
    ratings = spark.createDataFrame([(u, (u * i) % 90) for u in range(1, 60) for i in range(1, 9)], "userId long, movieId long")
    whole = recall.popular_unseen(ratings, 30)
    monkeypatch.setattr(recall, "LIST_ROWS", 200)
    spread = recall.popular_unseen(ratings, 30)
    assert spread.rdd.getNumPartitions() == -(-whole.count() // 200)  # the runs alone would fit one task
    assert sorted(spread.collect()) == sorted(whole.collect())
    merged = recall.merge_lists(spread, spread.withColumn("movieId", F.col("movieId") + 7), "union", top_r=40)
    assert "SortAggregate" not in _plan(merged) and "hashpartitioning(userId, movieId" not in _plan(merged)
    first = {(r.userId, r.movieId): r.rank for r in spread.collect()}
    got = {(r.userId, r.movieId): r.pos for r in merged.collect()}
    assert all(got[k] == v for k, v in first.items())


def test_hard_negatives_expand_the_head_of_the_lists_only(spark):
    rows = [(u, (u * i) % 90) for u in range(1, 60) for i in range(1, 9)] + [(99, m) for m in range(85)]
    ratings = spark.createDataFrame(rows, "userId long, movieId long")
    lists, seen = recall.unseen_lists(ratings, 30), recall.seen_pairs(ratings)
    whole = lists()
    assert sorted(lists(4, 9).collect()) == sorted(whole.where("rank > 4 AND rank <= 9").collect())
    asked = []

    def parts(after=0, upto=None, pick=lambda d: d):
        made = lists(after, upto, pick)
        asked.append((after, upto, made.count()))
        return made

    ids = spark.range(0, 90, 1).select(F.col("id")).where("id % 9 != 1")
    users = spark.createDataFrame([(u,) for u in [*range(1, 40), 99]], "userId long")
    got = negatives.hard_negatives(parts, seen, ids, 5, users)
    assert sorted(got.collect()) == sorted(negatives.hard_negatives(whole.join(users, "userId", "left_semi"), seen, ids, 5).collect())
    n_users = users.join(seen.select("userId").distinct(), "userId", "left_semi").count()
    assert asked[0][2] <= 10 * n_users and asked[1][2] <= 20 * 2  # the rest is made for users who lack items
