"""A training corpus from raw documents, in five stages of the operators in ``cinerank.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read back as the next stage's documents:

1. ``quality``  drops the documents that the positive-unlabelled classifier rejects (score under 0.3);
2. ``dedup``    keeps one document (the smallest ``doc_id``) of each component of the n-gram Jaccard join;
3. ``decontam`` drops the documents that hold a benchmark item or a re-parameterised variant;
4. ``mix``      returns every document as often as entropy balancing takes it (not at all, once or twice);
5. ``shard``    deals the copies out to 16 shards on the bounded-load ring, with a gapless slot in each.

All but the last return the columns of ``documents``.  Stages 1 and 5 need no
shuffle of texts; stage 4 moves each kept text once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinerank.llm import op2_quality, op3_mixing, op6_decontam, op8_ngram_join, op9_sharding
from cinerank.llm.common import table, written
from cinerank.llm.queries import digest9


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = op2_quality.train(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return op2_quality.keep_good(docs, model, threshold=0.3)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_ngram_join.keep_one(docs)


def decontam(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op6_decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op3_mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest9(op9_sharding.ring_shards(docs.select("doc_id", "text"), shards=16))


STAGES = [("quality", quality), ("dedup", dedup), ("decontam", decontam), ("mix", mix), ("shard", shard)]

#: A fitted classifier and graph components have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
