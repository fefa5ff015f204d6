"""Hard-negative mining by a secondary-sort shuffle.

Vectors become integers (``floor(scale * x)``) and a row's score for an anchor is
their inner product.  An anchor's positives are its first ``positives`` other rows of
the same label, by score down and id up; a positive of score ``p`` opens the window
``low * p <= 100 * score <= high * p`` for rows of other labels, the first
``negatives`` of which it takes.

Pair scores are packed into byte keys (anchor, descending score, positives first,
id) whose byte order is the order of the result.  They are dealt out by anchor and
sorted within the partitions by that key; one pass then streams over each partition,
opens a window at each positive, hands negatives to the open windows and forgets
them.  It holds the open windows of one anchor and nothing else.

Not every pair is shuffled: chunks of anchors meet blocks of rows, once for the
positives and once, with the positives known, for the windows.  Of a block only the
first ``positives`` rows of an anchor's label and the first ``negatives`` of each of its
windows can be in the result, so only they become keys.  Blocks are dealt by a hash of
the whole row and equal rows are merged before, so neither a vector nor a label that
a third of all rows share ends in one task.

Scores are exact: products run in double precision where no sum can reach 2**53,
else in Python integers; a score beyond 64 bits is cut to the nearest 64-bit number.

Defined results: rows whose id, label or vector is null, or whose vector holds a
null or non-finite component, take no part; a shorter vector counts as filled up
with zeros; repeated rows (id, label and vector alike) count once; rows that share
only the id are rows of their own, yet never each other's positive or negative;
windows of a positive with a score under 0 are empty; other columns are ignored
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Anchors scored at once inside a task: with a block's rows this bounds the score matrix.
AT_ONCE = 64
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
#: anchor id and tag, inverted score, kind (0 positive, 1 negative), id
KEY = np.dtype([("anchor", ">u8"), ("tag", ">u8"), ("down", ">u8"), ("kind", "u1"), ("id", ">u8")])
_SIGN = 1 << 63
_MOST = (1 << 63) - 1


def pack(anchor: np.ndarray, tag: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> np.ndarray:
    """Byte keys whose order is anchor, score down, positives first, id up."""
    out = np.empty(len(anchor), dtype=KEY)
    up = lambda x: x.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    out["anchor"], out["tag"], out["down"], out["kind"], out["id"] = up(anchor), up(tag), ~up(score), kind, up(ids)
    return out


def unpack(key: bytes) -> tuple[int, int, int, int, int]:
    """(anchor, tag, score, kind, id) of a byte key."""
    a, t, d, k, i = np.frombuffer(key, dtype=KEY)[0].tolist()
    return a - _SIGN, t - _SIGN, (_SIGN - 1) - d, k, i - _SIGN


def _matrix(vecs) -> np.ndarray:
    d = max((len(v) for v in vecs), default=0)
    out = np.zeros((len(vecs), d), dtype=np.int64)
    for i, v in enumerate(vecs):
        out[i, : len(v)] = v
    return out


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, as 64-bit integers."""
    d = min(a.shape[1], x.shape[1])
    a, x = a[:, :d], x[:, :d]
    if d == 0 or len(a) == 0 or len(x) == 0:
        return np.zeros((len(a), len(x)), dtype=np.int64)
    if float(np.abs(a.astype(np.float64)).max()) * float(np.abs(x.astype(np.float64)).max()) * d < 2.0**53:
        return (a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    big = a.astype(object) @ x.T.astype(object)
    return np.array([[min(max(v, -_SIGN), _MOST) for v in row] for row in big.tolist()], dtype=np.int64)


def window(p: int, low: int, high: int) -> tuple[int, int]:
    """Smallest and largest score in the window of a positive with score ``p``."""
    return -((-low * p) // 100), (high * p) // 100


def _first(rows: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` of ``rows`` by score down and id up."""
    if len(rows) > k:
        s = score[rows]
        rows = rows[s >= np.partition(s, len(s) - k)[len(s) - k]]
    return rows[np.lexsort((ids[rows], ~score[rows]))][:k]


def _keys(parts: list[np.ndarray]) -> pd.DataFrame:
    k = np.concatenate([*parts, np.empty(0, dtype=KEY)]).astype(KEY)  # concatenation turns byte orders
    raw, w = k.tobytes(), KEY.itemsize
    return pd.DataFrame({"anchor": (k["anchor"] ^ np.uint64(_SIGN)).astype(np.uint64).view(np.int64), "key": [raw[i * w : (i + 1) * w] for i in range(len(k))]})


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, chunk_rows: int = 4096, block_rows: int = 8192) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; ``is_anchor`` is a condition on ``id``."""
    if min(positives, negatives, scale, chunk_rows, block_rows) < 1 or not 0 <= low <= high < 100:
        raise ValueError("positives, negatives, scale and sizes must be at least 1, and 0 <= low <= high < 100")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    v = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    v = v.where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL").where(~F.exists("vec", bad))
    v = v.select("id", "label", F.transform("vec", lambda c: F.floor(c * F.lit(float(scale)))).alias("x")).distinct()
    v = written(v.withColumn("tag", F.xxhash64("id", "label", "x")), "quantised")
    n, anchors = v.agg(F.count(F.lit(1)), F.count(F.when(is_anchor, 1))).first()
    if not anchors:
        return df.sparkSession.createDataFrame([], SCHEMA)
    blocks, chunks = math.ceil(n / block_rows), math.ceil(anchors / chunk_rows)
    numbers = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    right = v.select(F.pmod("tag", F.lit(blocks)).cast("int").alias("block"), numbers(chunks).alias("chunk"), "id", "label", "x")
    left = v.where(is_anchor).select(F.pmod(F.xxhash64("tag"), F.lit(chunks)).cast("int").alias("chunk"), "id", "tag", "label", "x")
    cell = ["block", "chunk"]

    def best_positives(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        label, ids = b["label"].to_numpy(), b["id"].to_numpy()
        for name, part in a.groupby("label"):
            rows = np.flatnonzero(label == name)
            if len(rows) == 0:
                continue
            x, own = _matrix(b["x"].iloc[rows].to_list()), ids[rows]
            for i in range(0, len(part), AT_ONCE):
                some = part.iloc[i : i + AT_ONCE]
                s = scores(_matrix(some["x"].to_list()), x)
                for who, tag, row in zip(some["id"].to_numpy(), some["tag"].to_numpy(), s):
                    got = _first(np.flatnonzero(own != who), row, own, positives)
                    out.append(pack(np.full(len(got), who), np.full(len(got), tag), row[got], 0, own[got]))
        return _keys(out)

    met = lambda a: a.withColumn("block", numbers(blocks)).groupBy(*cell).cogroup(right.groupBy(*cell))
    found = met(left).applyInPandas(best_positives, "anchor long, key binary")

    def keep_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, points = None, [], []
        out: list[tuple] = []
        for rb in batches:
            for key in rb.column(1).to_pylist():
                a, t, s, _, i = unpack(key)
                if (a, t) != now:
                    if now is not None:
                        out.append((*now, ids, points))
                    now, ids, points = (a, t), [], []
                if len(ids) < positives:
                    ids.append(i)
                    points.append(s)
            yield _lists(out)
            out = []
        if now is not None:
            yield _lists([(*now, ids, points)])

    def _lists(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(cols, kinds)], names=["id", "tag", "p_ids", "p_scores"])

    best = found.repartition(F.col("anchor")).sortWithinPartitions("key").mapInArrow(keep_first, "id long, tag long, p_ids array<long>, p_scores array<long>")
    best = written(best, "positives")
    asked = written(left.join(best, ["id", "tag"]), "anchors")

    def in_windows(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            label, ids, x = b["label"].to_numpy(), b["id"].to_numpy(), _matrix(b["x"].to_list())
            for i in range(0, len(a), AT_ONCE):
                some = a.iloc[i : i + AT_ONCE]
                s = scores(_matrix(some["x"].to_list()), x)
                for who, tag, own, points, row in zip(some["id"].to_numpy(), some["tag"].to_numpy(), some["label"].to_numpy(), some["p_scores"], s):
                    other = (label != own) & (ids != who)
                    got = []
                    for p in set(points.tolist()):
                        lo, hi = window(p, low, high)
                        if lo <= hi:
                            got.append(_first(np.flatnonzero((row >= lo) & (row <= hi) & other), row, ids, negatives))
                    got = np.unique(np.concatenate(got)) if got else np.empty(0, dtype=np.int64)
                    out.append(pack(np.full(len(got), who), np.full(len(got), tag), row[got], 1, ids[got]))
        return _keys(out)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, opened = None, []  # [positive, its score, its window, negatives handed out]
        for rb in batches:
            out: list[tuple] = []
            for key in rb.column(1).to_pylist():
                a, t, s, kind, i = unpack(key)
                if (a, t) != now:
                    now, opened = (a, t), []
                if kind == 0:
                    opened.append([i, s, *window(s, low, high), 0])
                    continue
                for w in opened:
                    if w[2] <= s <= w[3] and w[4] < negatives:
                        w[4] += 1
                        out.append((a, w[0], w[4], i, w[1], s))
            cols = list(zip(*out)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in SCHEMA.split(", ")])

    won = best.select(F.col("id").alias("anchor"), "tag", F.explode(F.arrays_zip("p_ids", "p_scores")).alias("p"))

    def as_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _keys([pack(*(pdf[c].to_numpy() for c in ("anchor", "tag", "score")), 0, pdf["id"].to_numpy())])

    opened = won.select("anchor", "tag", F.col("p.p_scores").alias("score"), F.col("p.p_ids").alias("id")).mapInPandas(as_keys, "anchor long, key binary")
    pairs = opened.union(met(asked).applyInPandas(in_windows, "anchor long, key binary"))
    return pairs.repartition(F.col("anchor")).sortWithinPartitions("key").mapInArrow(stream, SCHEMA)
