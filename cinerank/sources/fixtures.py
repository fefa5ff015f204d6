"""Domain views over the driver tables (DataFrame form).

The reference reads four CSV files (item metadata, credits, ratings, id
links).  The driver ships TPC-H-shaped tables instead, so these views map
them onto the reference's input schemas, planting the awkward cases the
reference code handles (Python-literal lists, garbage JSON, empty lists,
malformed dates, zero runtimes, null languages, null and many-to-one links).
The same definitions exist as SQL text in ``sql_views`` for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.sources.tables import table

# Fixed values of the fixture mapping.
ITEM_ID_OFFSET = 100000


def _mod(c: Column, m: int) -> Column:
    return c % F.lit(m)


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    first_word = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
    second_word = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    genres = (
        F.when(_mod(k, 41) == 0, F.lit(None).cast("string"))
        .when(_mod(k, 33) == 0, F.lit("not-json"))
        .when(_mod(k, 10) == 0, F.concat(F.lit("[{'id': 1, 'name': '"), F.col("p_type"), F.lit("'}, {'id': 2, 'name': None}]")))
        .otherwise(
            F.concat(
                F.lit('[{"id": 1, "name": "'), F.col("p_type"),
                F.lit('"}, {"id": 2, "name": "Sci '), first_word, F.lit('"}]'),
            )
        )
    )
    return p.select(
        (F.lit(ITEM_ID_OFFSET) + k).alias("id"),
        F.col("p_name").alias("original_title"),
        F.when(_mod(k, 5) == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("T "), F.col("p_name"))).alias("title"),
        genres.alias("genres"),
        F.concat(F.lit('[{"name": "'), second_word, F.lit('"}]')).alias("keywords"),
        F.when(_mod(k, 29) == 0, F.lit("[]"))
        .otherwise(F.concat(F.lit('[{"iso_3166_1": "N'), _mod(k, 25).cast("string"), F.lit('"}]')))
        .alias("production_countries"),
        F.when(_mod(k, 37) == 0, F.lit("????"))
        .otherwise(F.concat((F.lit(1950) + _mod(k, 70)).cast("string"), F.lit("-06-15")))
        .alias("release_date"),
        F.when(_mod(k, 31) == 0, F.lit(None).cast("double"))
        .when(_mod(k, 23) == 0, F.lit(0.0))
        .otherwise((F.lit(80) + F.col("p_size")).cast("double"))
        .alias("runtime"),
        F.when(_mod(k, 53) == 0, F.lit(None).cast("string"))
        .when(_mod(k, 7) == 0, F.lit("fr"))
        .when(_mod(k, 11) == 0, F.lit("de"))
        .otherwise(F.lit("en"))
        .alias("original_language"),
        F.col("p_retailprice").alias("popularity"),
        (_mod(k, 101).cast("double") / 10).alias("vote_average"),
        _mod(k, 1000).alias("vote_count"),
    )


def raw_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    k = F.col("p_partkey")
    cast_list = F.concat(
        F.lit('[{"name": "A'), _mod(k, 17).cast("string"), F.lit(' X"}, {"name": "A'), _mod(k, 13).cast("string"),
        F.lit(' Y"}, {"name": "A3"}, {"name": "A4"}, {"name": "A5"}, {"name": "A6"}, {"name": "A7"}]'),
    )
    crew = F.concat(F.lit('[{"job": "Director", "name": "'), F.col("p_brand"), F.lit('"}, {"job": "Producer", "name": "Zed"}]'))
    return p.filter(_mod(k, 20) != 7).select(
        (F.lit(ITEM_ID_OFFSET) + k).alias("movie_id"), cast_list.alias("cast_list"), crew.alias("crew")
    )


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # orders is the one side of a one-to-many join: both sides are large at
    # scale, so the planner's size estimate (not a hint) picks the strategy.
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("rating"),
        F.col("o_orderdate").alias("rated_at"),
    )


def raw_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey")
    k = F.col("p_partkey")
    return p.select(
        k.alias("movieId"),
        F.when(_mod(k, 50) == 0, F.lit(None).cast("double"))
        .when(_mod(k, 97) == 1, (F.lit(ITEM_ID_OFFSET) + k - 1).cast("double"))
        .otherwise((F.lit(ITEM_ID_OFFSET) + k).cast("double"))
        .alias("tmdbId"),
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
