"""Explicit schemas of the raw CSV inputs (no schema inference)."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

ITEMS = StructType([
    StructField("id", LongType()),
    StructField("original_title", StringType()),
    StructField("title", StringType()),
    StructField("genres", StringType()),
    StructField("keywords", StringType()),
    StructField("production_countries", StringType()),
    StructField("release_date", StringType()),
    StructField("runtime", DoubleType()),
    StructField("original_language", StringType()),
    StructField("popularity", DoubleType()),
    StructField("vote_average", DoubleType()),
    StructField("vote_count", LongType()),
])

CREDITS = StructType([
    StructField("movie_id", LongType()),
    StructField("cast", StringType()),
    StructField("crew", StringType()),
])

RATINGS = StructType([
    StructField("userId", LongType()),
    StructField("movieId", LongType()),
    StructField("rating", DoubleType()),
    StructField("timestamp", LongType()),
])

LINKS = StructType([
    StructField("movieId", LongType()),
    StructField("tmdbId", DoubleType()),
])
