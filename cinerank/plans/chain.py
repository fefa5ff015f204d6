"""Shared sub-plans over the fixture views (lazy DataFrames, built per call).

These are the outputs of the reference's prepare job, expressed once so
that every registered query reuses the same plan fragments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.operators import catalog, interactions
from cinerank.session import checkpoint_dir
from cinerank.sources import fixtures

_STAGES: dict[tuple, DataFrame] = {}


def reset() -> None:
    """Forget materialised stages (the bench times every query from the raw tables)."""
    _STAGES.clear()


def stage(name: str, spark: SparkSession, sf: str, build) -> DataFrame:
    """Materialise a stage output once per session: a reliable checkpoint in the
    shared checkpoint folder, which also cuts the lineage of later stages."""
    key = (name, sf, spark.sparkContext.applicationId)
    if key not in _STAGES:
        checkpoint_dir(spark)
        _STAGES[key] = build().checkpoint(eager=True)
    return _STAGES[key]


def items_joined(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.join_credits(fixtures.raw_items(spark, sf), fixtures.raw_credits(spark, sf))


def items_processed(spark: SparkSession, sf: str) -> DataFrame:
    items, _ = catalog.items_processed(fixtures.raw_items(spark, sf), fixtures.raw_credits(spark, sf))
    return items


def item_meta(spark: SparkSession, sf: str) -> DataFrame:
    """The item columns the ranker uses (everything except the tag text)."""

    def build():
        # no nested-list parsing here: the ranker needs only scalar metadata
        j = catalog.runtime_z(items_joined(spark, sf).select("id", "runtime", "original_language", "popularity", "vote_average", "vote_count"))
        j = catalog.with_language_index(j, catalog.language_order(j))
        return j.select("id", "runtime_z", "lang_idx", "popularity", "vote_average", "vote_count")

    return stage("item_meta", spark, sf, build)


def items_base(spark: SparkSession, sf: str) -> DataFrame:
    """Joined items with parsed lists, year, runtime z-score and language index (materialised)."""

    def build():
        j = catalog.runtime_z(catalog.parse_lists(items_joined(spark, sf)))
        return catalog.with_language_index(j, catalog.language_order(j))

    return stage("items_base", spark, sf, build)


def ratings_mapped(spark: SparkSession, sf: str) -> DataFrame:
    return stage("ratings_mapped", spark, sf, lambda: interactions.map_ratings(
        fixtures.raw_ratings(spark, sf), fixtures.raw_links(spark, sf), items_joined(spark, sf).select("id")
    ))


def user_split(spark: SparkSession, sf: str) -> DataFrame:
    return interactions.split_users(ratings_mapped(spark, sf))


def ratings_split(spark: SparkSession, sf: str) -> DataFrame:
    """Mapped ratings of qualified users, tagged 'train' / 'valid'."""
    def build():
        r = ratings_mapped(spark, sf)
        return interactions.qualify_users(r, interactions.split_users(r))

    return stage("ratings_split", spark, sf, build)


def split_ratings(spark: SparkSession, sf: str, which: str) -> DataFrame:
    return ratings_split(spark, sf).filter(F.col("split") == which).drop("split")


SPLITS = ("train", "valid")


def candidate_lists(spark: SparkSession, sf: str, which: str):
    """Recall lists for one split, made in parts (``recall.unseen_lists``)."""
    from cinerank.operators.recall import unseen_lists

    # not a stage of its own: its runs are materialised, the lists (300 rows a user) are expanded where they are used
    key = (f"candidates_{which}", sf, spark.sparkContext.applicationId)
    if key not in _STAGES:
        _STAGES[key] = unseen_lists(split_ratings(spark, sf, which))
    return _STAGES[key]


def candidates(spark: SparkSession, sf: str, which: str, upto: int | None = None) -> DataFrame:
    """Recall lists for one split: popularity ranking with the user's seen items masked, up to rank ``upto``."""
    return candidate_lists(spark, sf, which)(upto=upto)


def features(spark: SparkSession, sf: str, which: str, source: str = "pop", **kw) -> DataFrame:
    """Feature rows of one split; hard negatives come from the popularity or the ALS recall lists."""
    from cinerank.operators.features import feature_rows

    def build():
        r = split_ratings(spark, sf, which)
        cands = candidate_lists(spark, sf, which) if source == "pop" else als_candidates(spark, sf, which)
        return feature_rows(r, cands, item_meta(spark, sf), **kw)

    tag = "_".join(f"{k}={v}" for k, v in sorted(kw.items()))
    return stage(f"features_{source}_{which}_{tag}", spark, sf, build)


def per_split(fn, spark: SparkSession, sf: str) -> DataFrame:
    """Union of ``fn(which)`` over both splits with a leading ``split`` column."""
    parts = [fn(w).select(F.lit(w).alias("split"), "*") for w in SPLITS]
    return parts[0].unionByName(parts[1])


def item_vector_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """((id, lang_idx, runtime_z, year), lang_order) for the hybrid vectors."""
    j = items_base(spark, sf)
    return j.select("id", "lang_idx", "runtime_z", "year"), catalog.language_order(j)


def item_tag_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """The driver's embedding table as the items' dense tag block (vec_id = id - offset)."""
    e = fixtures.embeddings(spark, sf)
    return e.select((F.col("id") + F.lit(fixtures.ITEM_ID_OFFSET)).alias("id"), "features")


def hybrid(spark: SparkSession, sf: str) -> DataFrame:
    from cinerank.operators.vectors import hybrid_vectors

    def build():
        items, order = item_vector_inputs(spark, sf)
        n_lang = order.select(F.count(F.lit(1)).cast("int")).scalar()
        return hybrid_vectors(items, item_tag_embeddings(spark, sf), n_lang)

    return stage("hybrid", spark, sf, build)


def seed_neighbours(spark: SparkSession, sf: str, which: str, top: int = 300) -> DataFrame:
    """VEC10 + VEC6 + JN18: neighbours of each user's first recalled item, computed once per distinct seed."""
    from cinerank.operators.knn import knn
    from cinerank.operators.recall import seed_lists

    def seeds_of(whole: bool = False):
        return candidate_lists(spark, sf, which)(upto=1, whole=whole).select("userId", F.col("movieId").alias("seed"))

    def build():
        seeds = seeds_of()
        vec = hybrid(spark, sf)
        q = vec.join(seeds.select(F.col("seed").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("qid"), "features")
        return knn(q, vec.select(F.col("id").alias("iid"), "features"), top, "cosine")

    # the lists of the distinct seeds are materialised, the users' copies are made where they are used
    # there users are dealt like the lists that they get
    return seed_lists(seeds_of(whole=True), stage(f"seeds_{which}_{top}", spark, sf, build))


def als(spark: SparkSession, sf: str, **kw):
    """Trained ALS on the pruned, summed confidences; returns (user_factors, item_factors) by id."""
    from cinerank.operators import als as als_ops

    key = ("als", sf, spark.sparkContext.applicationId, tuple(sorted(kw.items())))
    if key not in _STAGES:
        items = items_joined(spark, sf).select("id")
        pruned = interactions.prune_sparse(ratings_mapped(spark, sf), items)
        conf = stage("confidences", spark, sf, lambda: interactions.confidences(pruned))
        model, users, its = als_ops.train(conf, **kw)
        uf, itf = als_ops.factors_by_id(model, users, its)
        _STAGES[key] = (uf.checkpoint(eager=True), itf.checkpoint(eager=True))
    return _STAGES[key]


def als_candidates(spark: SparkSession, sf: str, which: str, **kw) -> DataFrame:
    from cinerank.operators import als as als_ops

    def build():
        uf, itf = als(spark, sf, **kw)
        r = split_ratings(spark, sf, which)
        from cinerank.operators.recall import seen_pairs

        return als_ops.recall(uf, itf, items_joined(spark, sf).select("id"), r.select("userId"), seen_pairs(r))

    tag = "_".join(f"{k}={v}" for k, v in sorted(kw.items()))
    return stage(f"als_cands_{which}_{tag}", spark, sf, build)


def ranker(spark: SparkSession, sf: str, early_stop: int = 50, source: str = "pop"):
    """Trained LambdaMART on one candidate source's feature rows; returns (ensemble, log)."""
    from cinerank.operators import features as feat
    from cinerank.operators import ranker as rk

    key = ("ranker", sf, spark.sparkContext.applicationId, early_stop, source)
    if key not in _STAGES:
        tr = feat.load_split(features(spark, sf, "train", source))
        va = feat.load_split(features(spark, sf, "valid", source))
        _STAGES[key] = rk.train(tr, va, early_stop=early_stop)
    return _STAGES[key]
