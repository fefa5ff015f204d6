"""Candidate recall with seen masking, and the list-blending strategies.

JN11-12 JN15 TOP2 WIN5 SET1-4 SET9 SRT2 AGG10.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinerank.functions.ranking import sorted_rank
from cinerank.operators.interactions import popularity
from cinerank.session import checkpoint_dir

# Recall defaults.
TOP_R = 300
CONTENT_TOP = 300
MERGES = ("union", "interleave", "weighted")
#: Rows that one key of a recall join should bring to a task; a hotter key's other side is copied.
KEY_ROWS = 100_000
#: Rows of recall lists that a task expands and works on.
LIST_ROWS = 100_000


def _copied(left: DataFrame, right: DataFrame, key: str, hottest: int) -> DataFrame:
    """Join on ``key``, of which ``left`` has up to ``hottest`` rows: ``right`` is copied once per KEY_ROWS of
    them (not at all where no key is that hot) and users are spread over the copies."""
    salts = min(1024, 1 + (hottest - 1) // KEY_ROWS)
    if salts <= 1:
        return left.join(right, key)
    left = left.withColumn("salt", F.pmod(F.xxhash64("userId"), F.lit(salts)).cast("int"))
    return left.join(right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), [key, "salt"]).drop("salt")


def seen_pairs(ratings: DataFrame) -> DataFrame:
    """AGG10: the distinct (userId, movieId) pairs a user rated — the seen set in long form."""
    return ratings.select("userId", "movieId").distinct()


def popularity_ranking(ratings: DataFrame) -> DataFrame:
    """(movieId, n_ratings, prank): items rated in ``ratings``, most rated first, ties by id."""
    return sorted_rank(popularity(ratings), [F.desc("n_ratings"), F.asc("movieId")], out="prank")


def unseen_runs(seen: DataFrame, ranking: DataFrame, top_r: int) -> DataFrame:
    """(userId, first, last, before): the runs of popularity ranks that make each user's first ``top_r`` unseen items.

    A run ``first`` .. ``last`` lies between two neighbouring ranks the user has seen, ``before`` of which are
    smaller, so rank r is candidate r - before.  At most one run per seen item and one more, whatever ``top_r``.
    """
    n_items = ranking.select(F.count(F.lit(1))).scalar()
    marks = seen.where("userId IS NOT NULL").join(ranking, "movieId").select("userId", F.col("prank").cast("long").alias("prank"))
    marks = marks.unionByName(seen.select("userId", F.lit(0).cast("long").alias("prank")).distinct())
    w = Window.partitionBy("userId").orderBy("prank")
    marks = marks.select("userId", "prank", (F.row_number().over(w) - 1).alias("before"), F.lead("prank").over(w).alias("next"))
    last = F.least(F.coalesce(F.col("next"), n_items + 1) - 1, F.col("before") + F.lit(top_r))
    runs = marks.select("userId", (F.col("prank") + 1).alias("first"), last.cast("long").alias("last"), "before")
    return runs.where("first <= last")


def unseen_lists(ratings: DataFrame, top_r: int = TOP_R) -> Callable[..., DataFrame]:
    """JN12 + TOP2 over a global ranking: first ``top_r`` popular items each user has not rated, in parts.

    Exact without pairing users with the whole catalogue, and without moving lists: what is shuffled and
    materialised are the users' runs of unseen ranks (``unseen_runs``, linear in the ratings).  The result makes lazily
    the candidates ``after`` + 1 .. ``upto`` of the users whose rows ``pick`` keeps: runs are cut, dealt by user and
    expanded there, and the ranks resolved by a join with the head of the ranking that any user needs — copied to
    the tasks while it has at most KEY_ROWS rows, else by an equi-join on the rank.
    The deal has a partition per LIST_ROWS rows of the lists: the runs are far smaller than the lists, so by their
    size Spark would put the lists of many users into a few tasks, and all that follows by user with them.
    With ``whole`` a part is dealt like the whole lists, to meet them or lists as long without a shuffle.
    Output: (userId, movieId, rank, score) with score = n_ratings.
    """
    checkpoint_dir(ratings.sparkSession)
    ranking = popularity_ranking(ratings)
    seen = seen_pairs(ratings)
    runs = unseen_runs(seen, ranking, top_r).checkpoint(eager=True)
    size = runs.agg(F.max("last").alias("deepest"), F.sum(F.col("last") - F.col("first") + 1).alias("n")).first()
    deepest, n = size["deepest"] or 0, size["n"] or 0
    head = ranking.where(F.col("prank") <= deepest)

    def lists(after: int = 0, upto: int | None = None, pick: Callable[[DataFrame], DataFrame] = lambda d: d, whole: bool = False) -> DataFrame:
        upto = top_r if upto is None else min(upto, top_r)
        parts = max(1, math.ceil(n * (1 if whole else max(upto - after, 0) / max(top_r, 1)) / LIST_ROWS))
        some = pick(runs)
        if (after, upto) != (0, top_r):
            first, last = F.greatest("first", F.col("before") + F.lit(after + 1)), F.least("last", F.col("before") + F.lit(upto))
            some = some.select("userId", "before", first.cast("long").alias("first"), last.cast("long").alias("last")).where("first <= last")
        slots = some.repartition(parts, "userId").select("userId", "before", F.explode(F.sequence("first", "last")).alias("prank"))
        if deepest <= KEY_ROWS:
            cand = slots.join(F.broadcast(head), "prank")
        else:  # every user asks for the first ranks
            cand = _copied(slots, head, "prank", seen.select("userId").distinct().count())
        return cand.select("userId", "movieId", (F.col("prank") - F.col("before")).cast("int").alias("rank"), F.col("n_ratings").cast("double").alias("score"))

    return lists


def popular_unseen(ratings: DataFrame, top_r: int = TOP_R) -> DataFrame:
    """The whole lists of ``unseen_lists``."""
    return unseen_lists(ratings, top_r)()


def seed_lists(seeds: DataFrame, neighbours: DataFrame) -> DataFrame:
    """JN18: (userId, seed) x (qid, iid, rank, score) -> (userId, movieId, rank, score).

    Most users share a few popular seeds, so the neighbour lists (at most k rows
    for each distinct seed) are copied to the tasks while they have at most KEY_ROWS
    rows; beyond that they are copied where a seed has many users.
    """
    few = neighbours.limit(KEY_ROWS + 1).count() <= KEY_ROWS
    if few:
        nb = F.broadcast(neighbours.select(F.col("qid").alias("seed"), F.col("iid").alias("movieId"), "rank", "score"))
        return seeds.join(nb, "seed").select("userId", "movieId", "rank", "score")
    hottest = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    nb = neighbours.withColumnRenamed("qid", "seed")
    return _copied(seeds, nb, "seed", hottest).select("userId", F.col("iid").alias("movieId"), "rank", "score")


def merge_lists(mf: DataFrame, ct: DataFrame, how: str = "union", w_mf: float = 0.5, w_ct: float = 0.5, top_r: int = TOP_R) -> DataFrame:
    """SET1-3 in row form.  ``mf`` and ``ct`` are (userId, movieId, rank) with rank 1..len.

    union      MF list, then content items not in it, cut at top_r
    interleave a1, b1, a2, b2, … over the first min(len_mf, len_ct) pairs, first
               occurrence kept, cut at top_r
    weighted   score = w_mf * (len_mf - i) + w_ct * (len_ct - j) (0-based i, j;
               absent = 0); descending, ties in insertion order (MF order, then
               content-only order), cut at top_r
    Every user's rows are bounded by len_mf + len_ct, so the per-user windows
    are bounded.  Each list is read once, and all that follows is by user: lists that
    are dealt by user alike (``unseen_lists``) take no shuffle, and no lengths are joined back.
    Output: (userId, movieId, pos) with pos 1..<= top_r.
    """
    if how not in MERGES:
        raise ValueError(f"how must be one of {MERGES}, got {how!r}")
    a = mf.select("userId", "movieId", F.col("rank").alias("r"), F.lit(0).alias("src"))
    b = ct.where("userId IS NOT NULL").select("userId", "movieId", F.col("rank").alias("r"), F.lit(1).alias("src"))
    both, user = a.unionByName(b), Window.partitionBy("userId")
    in_mf = F.max(F.when(F.col("src") == 0, 1))
    if how == "union":
        # one number in the order of (src, r), an absent r first: it is aggregated without a sort
        k = F.col("src").cast("long") * F.lit(1 << 40) + F.coalesce(F.col("r").cast("long"), F.lit(-(1 << 39)))
        rows = both.groupBy("userId", "movieId").agg(F.min(k).alias("k"), in_mf.alias("in_mf"))
        order = [F.col("k")]
    else:
        length = [F.max(F.when(F.col("src") == i, F.col("r"))).over(user) for i in (0, 1)]
        there = [F.max(F.when(F.col("src") == i, 1)).over(user) for i in (0, 1)]
        both = both.where("userId IS NOT NULL").select("*", length[0].alias("la"), length[1].alias("lb"), there[0].alias("a"), there[1].alias("b"))
        if how == "interleave":
            # a user without a content list has zero pairs, hence an empty merged list
            both = both.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("r") <= F.least("la", "lb")))
            seq = 2 * (F.col("r") - 1) + F.col("src")
            rows = both.groupBy("userId", "movieId").agg(F.min(seq).alias("k"), F.lit(1).alias("in_mf"))
            order = [F.col("k")]
        else:
            mine = F.col("src") == 0
            s = F.when(mine, F.lit(float(w_mf)) * (F.col("la") - F.col("r") + 1)).otherwise(F.lit(float(w_ct)) * (F.col("lb") - F.col("r") + 1))
            rows = both.groupBy("userId", "movieId").agg(
                F.sum(s).alias("score"),
                F.min(F.when(mine, F.col("r"))).alias("mf_r"),
                F.min(F.when(~mine, F.col("r"))).alias("ct_r"),
                in_mf.alias("in_mf"),
            )
            order = [F.desc("score"), F.asc_nulls_last("mf_r"), F.asc("ct_r")]
    rows = rows.withColumn("pos", F.row_number().over(user.orderBy(*order)))
    # a user without an MF list gets no candidates at all (SET9)
    rows = rows.withColumn("any_mf", F.max("in_mf").over(user))
    return rows.filter((F.col("pos") <= top_r) & F.col("any_mf").isNotNull()).select("userId", "movieId", "pos")
