"""Sinks and artefact I/O (SNK1-SNK13, SRC7-SRC12) in Spark-native formats.

The reference hands files between scripts (CSV, JSON, npz, npy, pickles,
a FAISS index, a text model).  Here every artefact is a parquet table or a
Spark ML model directory under one output root, so downstream jobs prune
columns and partitions when they read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cinerank.sources.schemas import CREDITS, ITEMS, LINKS, RATINGS


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite ``path`` with ``df`` as parquet (arrays and vectors survive, unlike CSV)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_candidates(cands: DataFrame, path: str, users: DataFrame | None = None) -> None:
    """SNK10: one row per user with the ranked ``array<long>`` candidate list; ``users`` (userId)
    without a candidate get an empty list."""
    lists = cands.groupBy("userId").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "movieId"))), lambda s: s["movieId"]).alias("candidates")
    )
    if users is not None:
        lists = users.select("userId").distinct().join(lists, "userId", "left").withColumn("candidates", F.coalesce("candidates", F.array().cast("array<long>")))
    write_table(lists, path)


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """SRC7: back to long form (userId, movieId, rank)."""
    return spark.read.parquet(path).select("userId", F.posexplode("candidates").alias("pos", "movieId")).select(
        "userId", "movieId", (F.col("pos") + 1).alias("rank")
    )


def _csv(spark: SparkSession, path: str, schema: StructType, optional: tuple[str, ...] = (), nested: bool = False) -> DataFrame:
    """Columns of ``schema`` picked by header name and cast; the file may hold others, in any order.

    ``optional`` columns that the header lacks are null.  ``nested`` files have quoted fields with
    line ends (lists as text), which only a whole-file read can parse; others stay splittable.
    """
    r = spark.read.option("header", True).option("escape", '"').option("multiLine", nested)
    df = r.csv(path)
    missing = [f.name for f in schema if f.name not in df.columns and f.name not in optional]
    if missing:
        raise ValueError(f"{path}: the header lacks {missing}")
    return df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: item metadata; one of the two title columns may be missing."""
    return _csv(spark, path, ITEMS, optional=("title", "original_title"), nested=True)


def read_credits_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: credits; the ``cast`` column is exposed as ``cast_list``."""
    return _csv(spark, path, CREDITS, nested=True).withColumnRenamed("cast", "cast_list")


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: userId, movieId, rating, timestamp (epoch seconds)."""
    return _csv(spark, path, RATINGS, optional=("timestamp",))


def read_links_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: only movieId and tmdbId are read (tmdbId may be empty)."""
    return _csv(spark, path, LINKS)
