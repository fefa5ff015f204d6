"""Ratings: id mapping, user split, qualification, pruning, confidences.

JN2-9 AGG5-9 SMP1 WIN7 WIN9 SET7 DST1 AGG6 PRJ4-6 ML7 SCL13 SCL15.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.functions.hashing import md5_key
from cinerank.functions.ranking import global_rank

# Job defaults.
VALID_FRAC = 0.20
SEED = 42
POS_THRESH = 4.0
ALPHA = 40.0
MIN_USER_CNT = 5
MIN_ITEM_CNT = 20


def map_ratings(ratings: DataFrame, links: DataFrame, item_ids: DataFrame) -> DataFrame:
    """JN2 + PRJ4-6 + JN3: map source item ids to catalogue ids; keep catalogue items only.

    ``links`` and ``item_ids`` are catalogue-sized; ratings are the big side.
    Many-to-one links keep every rating (duplicates are summed later, AGG9).
    """
    lk = links.select("movieId", "tmdbId").na.drop("any").select(
        F.col("movieId").cast("long").alias("movieId"), F.col("tmdbId").cast("long").alias("tmdbId")
    )
    when = [c for c in ("rated_at", "timestamp") if c in ratings.columns]
    mapped = ratings.join(lk, "movieId", "inner").select(
        "userId", F.col("tmdbId").alias("movieId"), "rating", *when
    )
    ids = item_ids.select(F.col("id").alias("movieId")).distinct()
    return mapped.join(ids, "movieId", "left_semi").select("userId", "movieId", "rating", *when)


def split_users(ratings: DataFrame, valid_frac: float = VALID_FRAC, seed: int = SEED) -> DataFrame:
    """SMP1 + WIN7 + SET7: seeded shuffle of distinct users, first floor(n*(1-f)) are train.

    The shuffle order is md5(userId_seed) — independent of partitioning — and
    the exact position comes from the bucketed global rank, so no single
    task sorts every user.
    """
    users = ratings.select("userId").distinct()
    n = users.select(F.count(F.lit(1))).scalar()
    cut = F.floor(n * (F.lit(1.0) - F.lit(float(valid_frac))))
    ranked = global_rank(users, md5_key("userId", F.lit(str(seed))), ["userId"], out="_pos")
    return ranked.select("userId", F.when(F.col("_pos") <= cut, F.lit("train")).otherwise(F.lit("valid")).alias("split"))


def qualify_users(ratings: DataFrame, split: DataFrame, pos_thresh: float = POS_THRESH) -> DataFrame:
    """JN4 + AGG5 + JN5: keep users with >= 1 positive and >= 1 negative rating; tag the split.

    Per-user counts are a partial+final aggregate (a hot user collapses
    map-side); the semi join is skew-split by AQE.
    """
    counts = ratings.groupBy("userId").agg(
        F.count_if(F.col("rating") >= pos_thresh).alias("n_pos"),
        F.count_if(F.col("rating") < pos_thresh).alias("n_neg"),
    )
    ok = counts.filter((F.col("n_pos") > 0) & (F.col("n_neg") > 0)).select("userId")
    return ratings.join(ok, "userId", "left_semi").join(split, "userId", "inner")


def prune_sparse(ratings: DataFrame, item_ids: DataFrame, min_user: int = MIN_USER_CNT, min_item: int = MIN_ITEM_CNT) -> DataFrame:
    """ML7 = JN6 → JN7 → JN8: one pass each (user count, then item count on what is left, then metadata)."""
    r = ratings
    if min_user > 0:
        users = r.groupBy("userId").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_user)
        r = r.join(users.select("userId"), "userId", "left_semi")
    if min_item > 0:
        items = r.groupBy("movieId").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_item)
        r = r.join(items.select("movieId"), "movieId", "left_semi")
    ids = item_ids.select(F.col("id").alias("movieId")).distinct()
    return r.join(ids, "movieId", "left_semi")


def dense_index(ids: DataFrame, key: str, out: str) -> DataFrame:
    """WIN9: bijection id → 0..n-1 in md5(id) order (any bijection is valid; this one is exact and distributed)."""
    d = ids.select(key).distinct()
    return global_rank(d, md5_key(key), [key], out="_r").select(key, (F.col("_r") - 1).alias(out))


def confidences(pruned: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """SCL13 + AGG9: C_ui = sum over duplicate (u, i) rows of 1 + alpha * rating."""
    return pruned.groupBy("userId", "movieId").agg(
        F.sum(F.lit(1.0) + F.lit(float(alpha)) * F.col("rating")).alias("confidence")
    )


def popularity(ratings: DataFrame) -> DataFrame:
    """AGG11: ratings per item within a split (partial+final aggregate)."""
    return ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("n_ratings"))
