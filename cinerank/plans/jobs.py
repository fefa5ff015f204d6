"""The recommender's eight jobs as parameterised functions (survey §2.15).

Each job reads the previous jobs' artefacts under ``out`` (parquet tables and
Spark ML model directories) and writes its own, so the jobs can run as
separate applications like the reference's scripts.  ``out`` must be a shared
folder (HDFS/S3/ABFS) on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.operators import als as als_ops
from cinerank.operators import catalog, features, interactions, knn, metrics, ranker, recall, text, vectors
from cinerank.sources import io

SETS = ("train", "valid")


def _p(out: str, name: str) -> str:
    return f"{out.rstrip('/')}/{name}"


def prepare(spark: SparkSession, items: DataFrame, credits: DataFrame, ratings: DataFrame, links: DataFrame, out: str,
            cast_n: int = 5, df_cut: float = 0.50, valid_frac: float = 0.20, seed: int = 42) -> None:
    """Job 0: processed items, language order, mapped ratings, qualified train/valid split."""
    # a repeated item or credit id counts once: its smallest row (DST2)
    items, credits = catalog.one_row_per_key(items, "id"), catalog.one_row_per_key(credits, "movie_id")
    items_p, lang = catalog.items_processed(items, credits, cast_n, df_cut)
    io.write_table(items_p, _p(out, "items_processed"))
    io.write_table(lang, _p(out, "lang_order"))
    ids = spark.read.parquet(_p(out, "items_processed")).select("id")
    io.write_table(interactions.map_ratings(ratings, links, ids), _p(out, "ratings_mapped"))
    mapped = spark.read.parquet(_p(out, "ratings_mapped"))
    split = interactions.qualify_users(mapped, interactions.split_users(mapped, valid_frac, seed))
    io.write_table(split, _p(out, "ratings_split"), partition_by=["split"])  # readers prune by split


def split_ratings(spark: SparkSession, out: str, which: str) -> DataFrame:
    if which not in SETS:
        raise ValueError(f"set must be one of {SETS}")
    return spark.read.parquet(_p(out, "ratings_split")).filter(F.col("split") == which).drop("split")


def build_mf(spark: SparkSession, out: str, factors: int = 128, iters: int = 20, alpha: float = 40.0, reg: float = 0.01,
             min_user_cnt: int = 5, min_item_cnt: int = 20, seed: int = 42) -> None:
    """Job 1: prune, sum confidences, train implicit ALS; write factors by external id and the id maps."""
    mapped = spark.read.parquet(_p(out, "ratings_mapped"))
    ids = spark.read.parquet(_p(out, "items_processed")).select("id")
    conf = interactions.confidences(interactions.prune_sparse(mapped, ids, min_user_cnt, min_item_cnt), alpha)
    model, users, items = als_ops.train(conf, factors, iters, alpha, reg, seed)
    model.save(_p(out, "als_model"))
    io.write_table(users, _p(out, "user_index"))
    io.write_table(items, _p(out, "item_index"))
    uf, itf = als_ops.factors_by_id(model, users, items)
    io.write_table(uf, _p(out, "user_factors"))
    io.write_table(itf, _p(out, "item_factors"))


def vectorize(spark: SparkSession, out: str, min_df: int = 3, max_features: int = 20000, svd_dim: int = 400,
              l2: bool = True, add_year: int = 10) -> None:
    """Job 2: TF-IDF on clean tags, optional SVD, hybrid vectors (tags ⊕ language ⊕ runtime ⊕ year)."""
    items = spark.read.parquet(_p(out, "items_processed"))
    weights, vocab = text.tfidf(items, key="id", text="clean_tags", min_df=min_df, max_features=max_features)
    io.write_table(vocab, _p(out, "tfidf_vocab"))
    weights = weights.checkpoint(eager=True)
    n_terms = vocab.count()
    if n_terms == 0:
        raise ValueError(f"no term is in {min_df} documents or more")
    if svd_dim > 0:
        # k is cut to the rank inside; V and the corpus size let the artefacts vectorise new items (ML5)
        tags, sing, comps = text.svd(weights, n_terms, svd_dim, key="id", return_components=True)
        io.write_table(spark.createDataFrame([(i, float(s)) for i, s in enumerate(sing)], "k int, singular_value double"),
                       _p(out, "svd_singular_values"))
        io.write_table(comps, _p(out, "svd_components"))
    else:
        # svd_dim 0 keeps the TF-IDF block itself (at most max_features wide)
        tags = weights.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("term_idx", "weight"))).alias("m")).select(
            "id", F.transform(F.sequence(F.lit(0), F.lit(n_terms - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0.0))).alias("features"))
    io.write_table(spark.createDataFrame([(items.count(), n_terms, svd_dim)], "n_docs long, n_terms long, svd_dim int"), _p(out, "vectorizer"))
    n_lang = spark.read.parquet(_p(out, "lang_order")).count()
    hv = vectors.hybrid_vectors(items.select("id", "lang_idx", "runtime_z", "year"), tags, n_lang, add_year, l2)
    io.write_table(hv, _p(out, "item_vectors"))


def vectorize_new(spark: SparkSession, out: str, docs: DataFrame, key: str = "id", text_col: str = "clean_tags") -> DataFrame:
    """ML5: tag vectors of new documents from the saved vocabulary, corpus size and components alone."""
    fit = spark.read.parquet(_p(out, "vectorizer")).first()
    w = text.tfidf_transform(docs, spark.read.parquet(_p(out, "tfidf_vocab")), fit["n_docs"], key=key, text=text_col)
    if not fit["svd_dim"]:
        return w
    return text.svd_transform(w, spark.read.parquet(_p(out, "svd_components")), key=key)


def index(spark: SparkSession, out: str, metric: str = "cosine") -> None:
    """Job 3: the content 'index' is the vector table, L2-normalised for cosine/ip."""
    if metric not in knn.METRICS:
        raise ValueError(f"unknown metric {metric!r}: use one of {', '.join(knn.METRICS)}")
    hv = spark.read.parquet(_p(out, "item_vectors"))
    if metric in ("cosine", "ip"):
        from cinerank.functions.vectors import l2_normalize

        hv = hv.withColumn("features", l2_normalize(F.col("features")))
    io.write_table(hv.withColumn("metric", F.lit(metric)), _p(out, "content_index"))


def recall_job(spark: SparkSession, out: str, which: str, output: str, top_r: int = 300, content: bool = True,
               content_top: int = 300, merge: str = "union", weight_mf: float = 0.5, weight_ct: float = 0.5,
               user: int | None = None) -> None:
    """Job 4: MF recall with seen masking, optionally blended with the seed item's content neighbours."""
    if merge not in recall.MERGES:
        raise ValueError(f"merge must be one of {recall.MERGES}, got {merge!r}")
    seen_r = split_ratings(spark, out, which)
    targets = seen_r.select("userId").distinct()
    if user is not None:
        targets = targets.filter(F.col("userId") == user)
    uf = spark.read.parquet(_p(out, "user_factors"))
    itf = spark.read.parquet(_p(out, "item_factors"))
    catalogue = spark.read.parquet(_p(out, "items_processed")).select("id")
    mf = als_ops.recall(uf, itf, catalogue, targets, recall.seen_pairs(seen_r), top_r).checkpoint(eager=True)
    cands = mf.select("userId", "movieId", "rank")
    if content:
        idx = spark.read.parquet(_p(out, "content_index"))
        metric = idx.select("metric").first()[0]
        seeds = mf.filter(F.col("rank") == 1).select("userId", F.col("movieId").alias("seed"))
        q = idx.join(seeds.select(F.col("seed").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("qid"), "features")
        nb = knn.knn(q, idx.select(F.col("id").alias("iid"), "features"), content_top, metric)
        ct = recall.seed_lists(seeds, nb).select("userId", "movieId", "rank")
        cands = recall.merge_lists(cands, ct, merge, weight_mf, weight_ct, top_r).withColumnRenamed("pos", "rank")
    io.write_candidates(cands, output, users=mf.select("userId"))


def build_features(spark: SparkSession, out: str, which: str, candidates: str, output: str | None, hard_neg: int = 20,
                   easy_neg: int = 10, pos_thresh: float = 4.0, seed: int = 42, counters: str | None = None) -> DataFrame:
    """Job 5: labelled feature rows for one split (a null-sentinel path means 'do not write').

    ``counters`` (a path) gets one more row: kept users, rows and positives of this split (AGG17).
    """
    ratings = split_ratings(spark, out, which)
    cands = io.read_candidates(spark, candidates)
    meta = spark.read.parquet(_p(out, "items_processed"))
    rows = features.feature_rows(ratings, cands, meta, hard_neg, easy_neg, pos_thresh, seed)
    wrote = features.write_rows(rows, output)
    if counters:
        kept = (spark.read.parquet(output) if wrote else rows).agg(
            F.count_distinct("userId").alias("n_users"), F.count(F.lit(1)).alias("n_rows"), F.sum("label").cast("long").alias("n_positive"))
        kept.select(F.lit(which).alias("split"), "*").write.mode("append").parquet(counters)
    return rows


def _report(m: DataFrame, metrics_table: str | None, job: str, n_rows: int) -> DataFrame:
    """SNK13: append the one-row metrics (users included) and the scored rows' number to a metrics table."""
    if metrics_table:
        m.withColumn("n_rows", F.lit(n_rows).cast("long")).withColumn("job", F.lit(job)).withColumn("at", F.current_timestamp()).write.mode("append").parquet(metrics_table)
    return m


def train(spark: SparkSession, train_rows: str, valid_rows: str, model: str, trees: int = 500, lr: float = 0.05,
          ndcg_k: int = 10, metrics_table: str | None = None) -> DataFrame:
    """Job 6: LambdaMART with early stopping; saves the model; returns MAP@k / NDCG@k on valid."""
    tr = features.load_split(spark.read.parquet(train_rows))
    va = features.load_split(spark.read.parquet(valid_rows))
    if not features.group_sizes_consistent(tr):  # AGG14
        raise ValueError("the train rows of some user changed between counting and reading")
    ens, _log = ranker.train(tr, va, trees=trees, lr=lr, k=ndcg_k)
    ens.save(model)
    return _report(metrics.map_ndcg(ens.predict(ranker.prepare(va)), k=ndcg_k), metrics_table, "train", va.count())


def evaluate(spark: SparkSession, rows: str, model: str, k: int = 10, metrics_table: str | None = None) -> DataFrame:
    """Job 7: reload the ranker, score the rows of both-class users, MAP@k / NDCG@k."""
    ens = ranker.Ensemble.load(model)
    va = features.load_split(spark.read.parquet(rows))
    return _report(metrics.map_ndcg(ens.predict(ranker.prepare(va)), k=k), metrics_table, "evaluate", va.count())
