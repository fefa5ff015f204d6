"""Quality scores by positive-unlabelled learning.

Trusted positives are the documents labelled good; the unlabelled web text is a
sample of all documents, whose labels are not looked at.  Each whole text
becomes a fixed-length vector of surface features (character-class
unigrams and bigrams, repetition of words, shingles and lines, compressibility,
lengths).  A first positives-against-unlabelled fit on one half gives scores
whose best bin on the other half estimates the class prior; the final linear
model minimises the non-negative unbiased risk (logistic loss) under that prior,
so its sigmoid is the probability of being good.

The fit is on bounded samples (``max_positive``, ``max_unlabelled`` rows, chosen
by a hash of the id); scoring is one pass of Arrow batches over every row.

Defined results: null text equals empty text, whose features are all zero and
whose score is the model's at that point; labels that are null are no labels, a
document labelled both ways is no trusted positive; repeated rows score alike;
without positives or rows to learn from, every score is the prior's default 0.5.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import SMALL_BATCH_BYTES, SMALL_SLICE_BYTES, Words, column, held_out, shingles, text_slices, written
from cinerank.llm.linear import class_prior, fit_nnpu, sigmoid

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Character classes by byte: lower, upper, digit, space, line end, sentence
#: punctuation, exclamation, bar, other symbol, multi-byte letter, control.
N_CLASSES = 11
_CLASS = np.full(256, 10, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9]], _CLASS[[10, 13]] = 3, 4
_CLASS[[ord(c) for c in ".,;:'\"-()"]] = 5
_CLASS[[ord(c) for c in "!?"]] = 6
_CLASS[ord("|")] = 7
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{}~"]] = 8
_CLASS[128:] = 9
N_FEATURES = N_CLASSES * (N_CLASSES + 1) + 12


def features(words: Words, grams: np.ndarray, so: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of N_FEATURES per text; a text without bytes is all zeros."""
    out = np.zeros((len(offs) - 1, N_FEATURES), dtype=np.float32)
    cls = _CLASS[buf]
    length = words.ends - words.starts
    k = N_CLASSES
    for i in range(len(offs) - 1):
        c = cls[offs[i] : offs[i + 1]]
        if len(c) == 0:
            continue
        f = out[i]
        f[:k] = np.sqrt(np.bincount(c, minlength=k) / len(c))
        if len(c) > 1:
            f[k : k + k * k] = np.sqrt(np.bincount(c[:-1] * k + c[1:], minlength=k * k) / (len(c) - 1))
        h = words.hash[words.offs[i] : words.offs[i + 1]]
        g = grams[so[i] : so[i + 1]]
        raw = buf[offs[i] : offs[i + 1]].tobytes()
        lines = [x for x in raw.split(b"\n") if x]
        t = f[k + k * k :]
        n = len(h)
        t[0] = np.log1p(len(c)) / 10
        t[1] = min(len(zlib.compress(raw, 1)) / len(raw), 1.5)
        if n:
            _, cnt = np.unique(h, return_counts=True)
            t[2] = len(cnt) / n
            t[3] = np.log1p(len(cnt)) / np.log1p(n)
            t[4] = cnt.max() / n
            t[5] = (h[1:] == h[:-1]).mean() if n > 1 else 0.0
            t[6] = length[words.offs[i] : words.offs[i + 1]].mean() / 10
            t[7] = len(np.unique(g)) / len(g)
            t[8] = (length[words.offs[i] : words.offs[i + 1]] > 20).mean()
            t[9] = np.log1p(n) / 10
        if lines:
            t[10] = len(set(lines)) / len(lines)
            t[11] = np.log1p(len(raw) / len(lines)) / 10
    return out


def _featured(batches):
    for rb, buf, offs in text_slices(batches, most=SMALL_SLICE_BYTES):
        w = Words(buf, offs)
        g, so = shingles(w, 5)
        yield rb, features(w, g, so, buf, offs)


def _sample_features(batches):
    for rb, x in _featured(batches):
        cols = [rb.column(rb.schema.get_field_index(c)) for c in ("doc_id", "p", "u")]
        ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.itemsize * x.shape[1])
        rows = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])
        yield pa.RecordBatch.from_arrays([*cols, rows], names=["doc_id", "p", "u", "x"])


def _expand(x: np.ndarray, mean: np.ndarray, inv: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) * inv, -6.0, 6.0)


class QualityModel:
    """Standardisation, weights and the estimated prior."""

    def __init__(self, mean, inv, w, b, prior):
        self.mean, self.inv, self.w, self.b, self.prior = mean, inv, w, b, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(_expand(x.astype(np.float64), self.mean, self.inv) @ self.w + self.b)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_positive: int = 12_000, max_unlabelled: int = 24_000) -> QualityModel:
    """Fit on trusted positives (``label`` = 1) and unlabelled documents, none of them held out."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
    pos = lab.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y")).where("y = 1").select("doc_id")
    pos = pos.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_positive).withColumn("p", F.lit(1))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    unl = ids.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(max_unlabelled).distinct().withColumn("u", F.lit(1))
    # at most max_positive + max_unlabelled ids
    pick = pos.join(unl, "doc_id", "full").select("doc_id", F.coalesce("p", F.lit(0)).alias("p"), F.coalesce("u", F.lit(0)).alias("u"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(pick), "doc_id")
    got = written(d.mapInArrow(_sample_features, "doc_id long, p int, u int, x binary"), "features", SMALL_BATCH_BYTES).toPandas().sort_values("doc_id", kind="stable")
    x = np.stack([np.frombuffer(r, dtype=np.float32) for r in got["x"]]).astype(np.float64) if len(got) else np.zeros((0, N_FEATURES))
    mean = x.mean(0) if len(x) else np.zeros(N_FEATURES)
    inv = 1.0 / np.maximum(x.std(0), 0.02) if len(x) else np.ones(N_FEATURES)
    x = _expand(x, mean, inv)
    p, u = x[(got["p"] == 1).to_numpy()], x[(got["u"] == 1).to_numpy()]
    if len(p) == 0 or len(u) == 0:
        return QualityModel(mean, inv, np.zeros(N_FEATURES), 0.0, 0.5)
    # prior: positives against unlabelled on the even rows, best bin on the odd rows
    w, b = fit_nnpu(p[::2], u[::2], 0.5, 1e-3, 400, 0.02)
    prior = class_prior(p[1::2] @ w + b, u[1::2] @ w + b)
    w, b = fit_nnpu(p, u, prior, 1e-4, 1500, 0.01)
    return QualityModel(mean, inv, w, b, prior)


def score(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""

    def run(batches):
        for rb, x in _featured(batches):
            s = model.score(x)
            cols = [rb.column(rb.schema.get_field_index(c)) for c in ("doc_id", "held_out")]
            yield pa.RecordBatch.from_arrays([*cols, column(s), column((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` (all columns as they are) that score at least ``threshold``.

    They are written at once: whole rows go to Python in the small batches of ``written`` only so,
    and an executor holds a batch several times over.
    """

    def run(batches):
        for rb, x in _featured(batches):
            yield rb.filter(column(model.score(x) >= threshold))

    return written(docs.mapInArrow(run, docs.schema), "good", SMALL_BATCH_BYTES)
