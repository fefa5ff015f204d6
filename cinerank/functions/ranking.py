"""Exact global ranks without a single-partition sort.

A plain ``row_number() OVER (ORDER BY h)`` moves every row into one task.
Here rows are ordered by an md5 hex digest ``h`` (uniform), so the first
``prefix_len`` hex digits split them into ``16**prefix_len`` balanced
buckets that respect the global order.  Per-bucket counts (a bounded,
broadcastable table) give each bucket's offset, and a window per bucket
gives the position inside it: rank = offset + row_number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def global_rank(df: DataFrame, hex_key: Column, ties: list[str], out: str = "rank", prefix_len: int = 4) -> DataFrame:
    """Add ``out`` = 1-based position of each row in order (``hex_key``, *ties)."""
    d = df.withColumn("_h", hex_key).withColumn("_b", F.substring("_h", 1, prefix_len))
    counts = d.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    # at most 16**prefix_len rows: the global window and the broadcast are bounded
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_b").orderBy("_h", *ties)
    return (
        d.join(F.broadcast(offsets), "_b")
        .withColumn(out, F.col("_off") + F.row_number().over(within))
        .drop("_b", "_h", "_off")
    )


def sorted_rank(df: DataFrame, order: list[Column | str], out: str = "rank") -> DataFrame:
    """Add ``out`` = 1-based position in a total order, from a distributed sort.

    ``orderBy`` range-partitions the rows (a hot key spreads over several
    ranges because the order continues past it); the sorted result is
    checkpointed to the shared checkpoint folder so that partition ids and
    in-partition positions are fixed, then per-partition counts (one row per
    partition) give offsets.
    """
    from cinerank.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    s = (
        df.orderBy(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    stats = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select("_pid", "_m0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        s.join(F.broadcast(offsets), "_pid")
        .withColumn(out, F.col("_off") + F.col("_mid") - F.col("_m0") + 1)
        .drop("_pid", "_mid", "_m0", "_off")
    )


def group_rank(df: DataFrame, group: str, order: list[Column | str], out: str = "rn") -> DataFrame:
    """1-based position inside ``group`` by ``order`` without sorting a group in one task.

    Equivalent to ``row_number() OVER (PARTITION BY group ORDER BY order)``,
    but built on ``sorted_rank`` so that one huge group is split across
    range partitions; the group's first position is a partial+final min.
    """
    g = sorted_rank(df, [F.col(group), *order], out="_g")
    first = g.groupBy(group).agg(F.min("_g").alias("_g0"))
    return g.join(first, group).withColumn(out, F.col("_g") - F.col("_g0") + 1).drop("_g", "_g0")
