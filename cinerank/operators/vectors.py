"""Hybrid item vectors: tag block ⊕ language one-hot ⊕ runtime ⊕ year one-hot (VEC1-VEC4).

The tag block is any (id, features) table — the SVD projection of TF-IDF
tags, or a given embedding table; an item without one gets zeros there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.functions.vectors import l2_normalize, one_hot, zeros

# Vectorize-job defaults.
YEAR_BUCKET = 10


def hybrid_vectors(items: DataFrame, tags: DataFrame | None, n_lang: int | F.Column, year_size: int = YEAR_BUCKET, l2: bool = True) -> DataFrame:
    """(id, features array<double>) from items (id, lang_idx, runtime_z, year) and tags (id, features)."""
    parts = []
    d = items
    if tags is not None:
        dim = tags.select(F.max(F.size("features"))).scalar()
        d = d.join(tags.select("id", F.col("features").cast("array<double>").alias("_tag")), "id", "left")
        d = d.withColumn("_dim", dim)  # scalar subqueries may not sit inside higher-order functions
        parts.append(F.coalesce(F.col("_tag"), zeros(F.col("_dim"))))
    d = d.withColumn("_nl", n_lang if isinstance(n_lang, F.Column) else F.lit(n_lang))
    parts.append(one_hot(F.col("lang_idx"), F.col("_nl")))
    parts.append(F.array(F.coalesce(F.col("runtime_z"), F.lit(0.0)).cast("double")))
    if year_size > 0:
        bucket = F.greatest(F.floor(F.coalesce(F.col("year"), F.lit(0)) / F.lit(year_size)), F.lit(0)).cast("int")
        d = d.withColumn("_yb", bucket)
        n_bucket = d.select((F.max("_yb") + 1).cast("int")).scalar()
        d = d.withColumn("_nb", n_bucket)
        parts.append(one_hot(F.col("_yb"), F.col("_nb")))
    v = F.concat(*parts)
    if l2:
        v = l2_normalize(v)
    return d.select("id", v.alias("features"))


def unpivot_nonzero(vectors: DataFrame) -> DataFrame:
    """(id, dim, value) for the non-zero components."""
    return vectors.select("id", F.posexplode("features").alias("dim", "value")).filter(F.col("value") != 0)
