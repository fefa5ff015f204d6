"""Toxicity scores: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Every whole text is lower-cased and its distinct character n-grams (5, 7 and 9 code
points, white space as one kind of blank) are hashed to ``2**bits`` buckets.
One pass over the labelled sample counts, per bucket, the toxic and the clean
documents that hold it; the smoothed log ratio of the two shares scales the
bucket's 0/1 feature, and a logistic regression is fitted on the scaled features
that separate the classes best.  Scoring is one pass over every row.

The fit uses at most ``max_per_class`` labelled rows a class (chosen by a hash of
the id) and ``max_features`` buckets; the intercept is corrected from the
sample's class shares to those of all labelled rows.

Defined results: null text equals empty text, which has no n-gram and the
intercept's score; null labels are no labels and a document labelled both ways
counts as toxic; without labels every score is 0.5 times the prior's default;
repeated rows score alike; an empty table gives an empty table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import held_out, mix64, written
from cinerank.llm.linear import fit_sparse_logistic, sigmoid

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZES = (5, 7, 9)
#: Code points hashed at once; longer texts go block by block, overlapping so that no n-gram is lost.
BLOCK = 1 << 18
#: Tasks that count the bounded sample's buckets.
COUNT_TASKS = 6
_MUL = mix64(np.arange(1, 129, dtype=np.uint64)) | np.uint64(1)
_BLANK = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})


def buckets(text: str | None, bits: int) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of a whole text, with repeats, in blocks."""
    if not text:
        return
    c = np.frombuffer(f" {text.lower().translate(_BLANK)} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    for at in range(0, len(c), BLOCK):
        x = c[at : at + BLOCK + max(SIZES) - 1]
        for n in SIZES:
            m = len(x) - n + 1
            if m <= 0:
                continue
            h = x[:m] * _MUL[n * 8]
            for k in range(1, n):
                h = h + x[k : k + m] * _MUL[n * 8 + k]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0x94D049BB133111EB)
            yield (h >> np.uint64(64 - bits)).astype(np.int64)


def _texts(batches):
    for rb in batches:
        yield rb, rb.column(rb.schema.get_field_index("text"))


def _counts(bits: int):
    def run(batches):
        total = np.zeros((2, 1 << bits), dtype=np.int32)
        flag = np.zeros(1 << bits, dtype=bool)
        for rb, col in _texts(batches):
            y = rb.column(rb.schema.get_field_index("y"))
            for i in range(rb.num_rows):
                for b in buckets(col[i].as_py(), bits):
                    flag[b] = True
                hit = np.flatnonzero(flag)
                total[y[i].as_py()][hit] += 1
                flag[hit] = False
        at = np.flatnonzero(total.any(axis=0))
        for s in range(0, len(at), 100_000):
            k = at[s : s + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[1][k].astype(np.int64)), pa.array(total[0][k].astype(np.int64))], names=["bucket", "pos", "neg"])

    return run


def chosen(text: str | None, bits: int, index: np.ndarray) -> np.ndarray:
    """Distinct feature numbers of a text."""
    got = [index[b] for b in buckets(text, bits)]
    return np.unique(np.concatenate([g[g >= 0] for g in got])) if got else np.zeros(0, dtype=np.int32)


def _lookup(features: np.ndarray, bits: int) -> np.ndarray:
    index = np.full(1 << bits, -1, dtype=np.int32)
    index[features] = np.arange(len(features), dtype=np.int32)
    return index


def _rows(bits: int, features: np.ndarray):
    def run(batches):
        index = _lookup(features, bits)
        for rb, col in _texts(batches):
            got = [chosen(col[i].as_py(), bits, index).astype(np.int32).tobytes() for i in range(rb.num_rows)]
            yield pa.RecordBatch.from_arrays([rb.column(rb.schema.get_field_index("y")), pa.array(got, pa.binary())], names=["y", "x"])

    return run


class ToxicityModel:
    """Chosen buckets, their weights (naive Bayes scaling included) and the intercept."""

    def __init__(self, bits: int, features: np.ndarray, w: np.ndarray, b: float):
        self.bits, self.features, self.w, self.b = bits, features, w, b


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_per_class: int = 6_000, max_features: int = 24_000, bits: int = 22, min_docs: int = 3) -> ToxicityModel:
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
    lab = lab.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    one = lambda y: lab.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class)
    pick = one(0).union(one(1))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(pick), "doc_id")
    d = written(d.select("y", "text"), "labelled")
    n = {r["y"]: r["n"] for r in d.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return ToxicityModel(bits, np.zeros(0, np.int64), np.zeros(0), -8.0 if not n.get(1) and n.get(0) else 0.0)
    # few tasks: each sends one line for every bucket that it has seen, and the sample is bounded
    tot = d.coalesce(COUNT_TASKS).mapInArrow(_counts(bits), "bucket long, pos long, neg long").groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") + F.col("neg") >= min_docs)
    # the buckets whose class shares differ most, in standard errors
    ps, ns, both = F.col("pos") / F.lit(n[1]), F.col("neg") / F.lit(n[0]), (F.col("pos") + F.col("neg")) / F.lit(n[0] + n[1])
    z = F.abs(ps - ns) / F.sqrt(both * (1 - both) + 1e-9)
    best = tot.withColumn("z", z).orderBy(F.desc("z"), "bucket").limit(max_features).toPandas()
    feats = best["bucket"].to_numpy(np.int64)
    ratio = np.log((best["pos"].to_numpy() + 1.0) / (n[1] + 2.0)) - np.log((best["neg"].to_numpy() + 1.0) / (n[0] + 2.0))
    got = d.mapInArrow(_rows(bits, feats), "y int, x binary").toPandas()
    got = got.sort_values(["y", "x"], kind="stable")  # the same fit whatever the rows' order
    lists = [np.frombuffer(v, dtype=np.int32) for v in got["x"]]
    w, b = fit_sparse_logistic(lists, got["y"].to_numpy(np.float64), ratio, 1e-4, 16, 0.02)
    b += np.log(sizes[1] / sizes[0]) - np.log(n[1] / n[0])
    return ToxicityModel(bits, feats, w, b)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    bits, feats, w, b = model.bits, model.features, model.w, model.b

    def run(batches):
        index = _lookup(feats, bits)
        flag = np.zeros(len(feats) + 1, dtype=bool)
        for rb, col in _texts(batches):
            s = np.zeros(rb.num_rows)
            for i in range(rb.num_rows):
                for x in buckets(col[i].as_py(), bits):
                    flag[index[x]] = True  # -1, no feature, is the last place
                hit = np.flatnonzero(flag[:-1])
                s[i] = w[hit].sum()
                flag[:] = False
            s = sigmoid(s + b)
            keep = [rb.column(rb.schema.get_field_index(c)) for c in ("doc_id", "held_out")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
