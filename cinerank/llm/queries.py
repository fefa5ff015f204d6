"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.llm import op1_substring as op1
from cinerank.llm import op2_quality as op2
from cinerank.llm import op3_mixing as op3
from cinerank.llm import op4_ann as op4
from cinerank.llm import op5_toxicity as op5
from cinerank.llm import op6_decontam as op6
from cinerank.llm import op7_line_dedup as op7
from cinerank.llm import op8_ngram_join as op8
from cinerank.llm import op9_sharding as op9
from cinerank.llm import op10_html as op10
from cinerank.llm import op11_whitening as op11
from cinerank.llm import op12_negatives as op12
from cinerank.llm import op13_tokens as op13
from cinerank.llm.common import scratch_path, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op2.score(docs, op2.train(docs, table(spark, sf_dir, "labels")))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op3.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("row.doc_id", "size", "source_size", "target", "taken")


def op4_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 20 == 0)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op6.contaminated(docs, table(spark, sf_dir, "benchmark")).drop("text_hash")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op5.score(docs, op5.train(docs, table(spark, sf_dir, "labels")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op7.drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.ngram_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op9.ring_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=16)
    return digest9(out)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op10.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=4)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return op12.mine(rows, F.col("id") % 50 == 0)


def op13_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    op13.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.path("word_bpe_49k.json"))
    return op13.read_documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def digest9(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_mix_sources": op3_mix_sources,
    "op4_ann_search": op4_ann_search,
    "op5_toxicity": op5_toxicity,
    "op6_decontaminate": op6_decontaminate,
    "op7_line_dedup": op7_line_dedup,
    "op8_ngram_join": op8_ngram_join,
    "op9_sharding": op9_sharding,
    "op10_html_extract": op10_html_extract,
    "op11_whiten": op11_whiten,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_ids": op13_token_ids,
}

ORACLE_SQL: dict[str, str] = {
    "op7_line_dedup": op7.ORACLE,
    "op8_ngram_join": op8.ORACLE,
}
