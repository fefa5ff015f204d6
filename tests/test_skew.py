"""A user holding a third of all ratings: operators stay exact (brute force on a small fixture)."""

import numpy as np
from pyspark.sql import functions as F

from cinerank.operators import negatives, recall


def _ratings(spark):
    rng = np.random.default_rng(11)
    rows = []
    # user 0 rates 300 of the 400 items; 60 light users rate 1-5 items each
    for i in rng.choice(400, 300, replace=False):
        rows.append((0, int(1000 + i), 3.0))
    for u in range(1, 61):
        for i in rng.choice(400, int(rng.integers(1, 6)), replace=False):
            rows.append((u, int(1000 + i), 4.0))
    assert sum(1 for r in rows if r[0] == 0) * 3 >= len(rows)  # the hot user holds >= a third
    return spark.createDataFrame(rows, "userId long, movieId long, rating double"), rows


def test_popular_unseen_exact_with_hot_user(spark):
    df, rows = _ratings(spark)
    got = recall.popular_unseen(df, top_r=50).toPandas()
    counts = {}
    for _, m, _ in rows:
        counts[m] = counts.get(m, 0) + 1
    order = sorted(counts, key=lambda m: (-counts[m], m))
    seen = {}
    for u, m, _ in rows:
        seen.setdefault(u, set()).add(m)
    for u, s in seen.items():
        exp = [m for m in order if m not in s][:50]
        assert got[got.userId == u].sort_values("rank")["movieId"].tolist() == exp


def test_easy_negatives_with_hot_user(spark):
    df, rows = _ratings(spark)
    seen = recall.seen_pairs(df)
    out = negatives.easy_negatives(df.select("userId").distinct(), seen, df, n=10).toPandas()
    pool = {m for _, m, _ in rows}
    s = {(u, m) for u, m, _ in rows}
    for u in {r[0] for r in rows}:
        got = out[out.userId == u]["movieId"].tolist()
        unseen = [m for m in pool if (u, m) not in s]
        assert len(got) == len(set(got)) == min(10, len(unseen))
        assert all((u, m) not in s for m in got)


def test_hard_negatives_hot_user(spark):
    df, rows = _ratings(spark)
    cands = recall.popular_unseen(df, top_r=40)
    ids = df.select(F.col("movieId").alias("id")).distinct()
    hard = negatives.hard_negatives(cands, recall.seen_pairs(df), ids, n=20).toPandas()
    c = cands.toPandas()
    for u, g in c.groupby("userId"):
        exp = g.sort_values("rank")["movieId"].tolist()[:20]
        assert hard[hard.userId == u].sort_values("rank")["movieId"].tolist() == exp


def test_copies_for_hot_keys_do_not_change_recall(spark, monkeypatch):
    from pyspark.sql import functions as F

    from cinerank.operators import recall

    ratings = spark.createDataFrame([(u, (u * i) % 50) for u in range(1, 40) for i in range(1, 9)], "userId long, movieId long")
    seeds = spark.createDataFrame([(u, u % 3) for u in range(60)], "userId long, seed long")
    near = spark.createDataFrame([(s, 100 + r, r, 1.0 / r) for s in range(3) for r in range(1, 6)], "qid long, iid long, rank long, score double")
    run = lambda: (sorted(map(tuple, recall.popular_unseen(ratings, top_r=10).collect())), sorted(map(tuple, recall.seed_lists(seeds, near).collect())))
    plain = run()
    monkeypatch.setattr(recall, "KEY_ROWS", 4)
    assert run() == plain and len(plain[0]) == 390 and len(plain[1]) == 300
    assert recall.seed_lists(seeds.where(F.lit(False)), near).count() == 0


def test_recall_lists_are_expanded_where_they_are_used(spark, monkeypatch):
    """Runs of ranks are materialised, linear in the ratings; lists take no shuffle of their own."""
    df, rows = _ratings(spark)
    ranking = recall.popularity_ranking(df)
    runs = recall.unseen_runs(recall.seen_pairs(df), ranking, 50)
    assert runs.count() <= len(rows) + 61
    assert runs.select(F.sum(F.col("last") - F.col("first") + 1)).first()[0] == recall.popular_unseen(df, top_r=50).count()
    plan = recall.popular_unseen(df, top_r=50)._jdf.queryExecution().executedPlan().toString()
    lists = plan[: plan.index("Generate")]
    assert "SortMergeJoin" not in lists and "Window" not in lists


def test_hard_negatives_beyond_the_head_of_the_list(spark):
    cands = spark.createDataFrame([(u, 10 + r, r) for u in (1, 2) for r in range(1, 21)], "userId long, movieId long, rank int")
    seen = spark.createDataFrame([(1, 10 + r) for r in range(1, 9)] + [(2, 11)], "userId long, movieId long")
    ids = spark.createDataFrame([(10 + r,) for r in range(1, 21) if r != 9], "id long")
    out = sorted(map(tuple, negatives.hard_negatives(cands, seen, ids, n=3).collect()))
    assert out == [(1, 20, 1), (1, 21, 2), (1, 22, 3), (2, 12, 1), (2, 13, 2), (2, 14, 3)]


def test_weighted_draws_are_never_broadcast(spark):
    """Exploded draws look as small as the users to the planner."""
    df, _ = _ratings(spark)
    users = df.select("userId").distinct()
    slots = df.select("movieId").withColumn("slot", F.monotonically_increasing_id())
    got = negatives._first_new(negatives._walk(users, 30, 101, 42), slots, recall.seen_pairs(df), 10)
    plan = got._jdf.queryExecution().executedPlan().toString()
    at = plan.index("[slot#")
    assert "SortMergeJoin" in plan[plan.rindex("\n", 0, at) : at] and "Generate" in plan[at:]


def test_weighted_negatives_whole_walk_for_users_short_of_items(spark, monkeypatch):
    """Looking up the head of the walk first changes no draw, for users with few unseen items either."""
    df, _ = _ratings(spark)
    seen, users = recall.seen_pairs(df), df.select("userId").distinct()
    run = lambda: sorted(map(tuple, negatives.weighted_negatives(users, seen, df, n=10).collect()))
    monkeypatch.setattr(negatives, "HEAD", negatives.WALK)
    whole = run()
    monkeypatch.setattr(negatives, "HEAD", 1)
    assert run() == whole
    assert any(10 <= draw < 200 for _, _, draw in whole)  # some user needed more than the head


def test_merged_lists_take_no_shuffle(spark, monkeypatch):
    """Lists dealt by user alike are merged where they are expanded, in as many tasks as the lists need."""
    monkeypatch.setattr(recall, "LIST_ROWS", 400)
    df, _ = _ratings(spark)
    lists = recall.unseen_lists(df, 50)
    near = spark.createDataFrame([(s, 1000 + 7 * r % 400, r, 1.0 / r) for s in range(1000, 1400) for r in range(1, 31)], "qid long, iid long, rank int, score double")
    seeds = lists(upto=1, whole=True).select("userId", F.col("movieId").alias("seed"))
    for how in recall.MERGES:
        out = recall.merge_lists(lists(), recall.seed_lists(seeds, near), how, top_r=50)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[: plan.index("Union")]
        assert out.rdd.getNumPartitions() > 1 and out.select("userId").distinct().count() == 61


def test_merges_of_users_with_one_list_and_without_id(spark):
    s = "userId long, movieId long, rank int"
    mf = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 10, 1), (None, 13, 1)], s)
    ct = spark.createDataFrame([(1, 12, 1), (1, 14, 2), (3, 15, 1), (None, 16, 1)], s)
    got = {how: sorted(map(tuple, recall.merge_lists(mf, ct, how).where("userId IS NOT NULL").collect())) for how in recall.MERGES}
    assert got["union"] == [(1, 10, 1), (1, 11, 2), (1, 12, 3), (1, 14, 4), (2, 10, 1)]
    assert got["interleave"] == [(1, 10, 1), (1, 11, 3), (1, 12, 2), (1, 14, 4)]
    assert got["weighted"] == [(1, 10, 1), (1, 11, 3), (1, 12, 2), (1, 14, 4), (2, 10, 1)]
    nulls = {how: recall.merge_lists(mf, ct, how).where("userId IS NULL").collect() for how in recall.MERGES}
    assert [tuple(r) for r in nulls["union"]] == [(None, 13, 1)] and not nulls["interleave"] and not nulls["weighted"]
