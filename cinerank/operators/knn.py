"""Exact k-nearest-neighbour join (VEC5-VEC9, JN17-18, TOP2, TOP4).

Queries are hashed into blocks, and a task takes one query block and reads the
items in a stream: items are copied once per query block, queries not at all.
The task scores ``i_block`` items at a time with numpy matrix products, applies
the users' exclusion lists (which travel with the queries, so masking happens
before ranking and needs no over-fetch), and keeps each query's exact running
top k, ties broken by item id; an item enters only if it may beat the worst of
them.  Nothing but the final k rows per query leaves the task.  Where queries
are too few to give every core a block, the items are dealt to groups too, and
a rank-limit window over k rows per query and group merges the groups' tops.

Metrics: ``cosine`` and ``ip`` rank L2-normalised vectors by inner product
(identical, as in the reference); ``l2`` ranks raw vectors by ascending
Euclidean distance and reports the distance.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinerank.functions.vectors import l2_normalize

# The functions shipped to executors are pickled by value, so workers do not
# need this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

METRICS = ("cosine", "ip", "l2")
# Ranking precision — scores are ranked after rounding to this
# many decimals so that summation-order noise cannot reorder exact ties.
RANK_DECIMALS = 9

_OUT = "qid long, iid long, rank int, score double"


#: Queries scored at once inside a task: a chunk × item block matrix is the memory peak.
Q_CHUNK = 256
#: Squared norms from which on candidates are looked for in double precision.
SINGLE_MOST = 1e30
#: Candidates whose exact scores are computed at once.
EXACT_ROWS = 32_768


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows over their norms (a zero row stays); squares are summed in order, as ``l2_normalize`` does."""
    n = np.zeros(len(x))
    for c in x.T:
        n += c * c
    n = np.sqrt(n)
    return x / np.where(n == 0, 1.0, n)[:, None]


def _exact(metric: str, q: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Scores row by row: equal item vectors score equally wherever they stand."""
    if metric == "l2":
        d = items - q
        return np.sqrt((d * d).sum(axis=1))
    return (items * q).sum(axis=1)


def _pairs(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) of every position in the rows' ranges lo .. hi - 1."""
    n = hi - lo
    return np.repeat(np.arange(len(n)), n), np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def _best(row: np.ndarray, iid: np.ndarray, score: np.ndarray, k: int, sign: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` of every row by (score, item id), with their positions from 1."""
    order = np.lexsort((iid, -sign * np.round(score, RANK_DECIMALS), row))
    row, iid, score = row[order], iid[order], score[order]
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, int)
    pos = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    keep = pos < k
    return row[keep], iid[keep], score[keep], pos[keep] + 1


class _Tops:
    """Running top ``k`` of one query block over a stream of items."""

    def __init__(self, k: int, metric: str, qid: np.ndarray, q: np.ndarray, ex_q: np.ndarray, ex_i: np.ndarray):
        order = np.argsort(qid, kind="stable")
        self.k, self.metric, self.sign = k, metric, -1.0 if metric == "l2" else 1.0
        self.qid, self.q = qid[order], q[order]
        self.q2 = (self.q * self.q).sum(1)
        # candidates come from products of single precision, unless numbers are too large for them
        self.kind = np.float32 if self.q2.max(initial=0.0) < SINGLE_MOST else np.float64
        # exclusions as (query row, item), by item
        at, row = _pairs(np.searchsorted(self.qid, ex_q, "left"), np.searchsorted(self.qid, ex_q, "right"))
        by = np.argsort(ex_i[at], kind="stable")
        self.ex_row, self.ex_iid = row[by], ex_i[at][by]
        n = len(range(0, len(qid), Q_CHUNK))
        none = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0))
        self.tops, self.new, self.floor = [none] * n, [[] for _ in range(n)], np.full(len(qid), -np.inf)

    def add(self, iid: np.ndarray, x: np.ndarray) -> None:
        """Candidates by matrix product with a margin above its rounding error, then their exact scores."""
        k, i2 = self.k, (x * x).sum(1)
        kind = self.kind if i2.max() < SINGLE_MOST else np.float64
        # rounding of a sum of products is below (terms) x (unit roundoff) x (norms); twice that, and more terms
        unit = 1e-9 if kind is np.float64 else (x.shape[1] + 16) * 2.0**-23
        xt = x.T.astype(kind)
        col, at = _pairs(np.searchsorted(self.ex_iid, iid, "left"), np.searchsorted(self.ex_iid, iid, "right"))
        order = np.argsort(self.ex_row[at], kind="stable")
        ex_row, ex_col = self.ex_row[at][order], col[order]
        for c, lo in enumerate(range(0, len(self.q), Q_CHUNK)):
            q, q2 = self.q[lo : lo + Q_CHUNK], self.q2[lo : lo + Q_CHUNK]
            rough = q.astype(kind) @ xt
            if self.metric == "l2":
                rough *= kind(2.0)
                rough -= q2[:, None].astype(kind)
                rough -= i2[None, :].astype(kind)
            a, b = np.searchsorted(ex_row, [lo, lo + len(q)])
            rough[ex_row[a:b] - lo, ex_col[a:b]] = -np.inf
            slack = 1e-9 + unit * (q2 + float(i2.max()))
            floor = (self.floor[lo : lo + Q_CHUNK] - slack).astype(kind)
            hit = rough >= floor[:, None]
            if rough.shape[1] > k and np.count_nonzero(hit) > 2 * k * len(q):
                kth = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k] - slack.astype(kind)
                hit = rough >= np.maximum(floor, kth)[:, None]
            row, i = np.nonzero(hit)
            ok = np.isfinite(rough[row, i])
            row, i = row[ok].astype(np.int32), i[ok]
            if len(row):
                score = np.concatenate([_exact(self.metric, q[row[s : s + EXACT_ROWS]], x[i[s : s + EXACT_ROWS]]) for s in range(0, len(row), EXACT_ROWS)])
                self.new[c].append((row, iid[i], score))
                if sum(len(v[0]) for v in self.new[c]) * 2 > k * len(q) or not len(self.tops[c][0]):
                    self._merge(c)

    def _merge(self, c: int) -> None:
        row, iid, score, pos = _best(*(np.concatenate(v) for v in zip(self.tops[c], *self.new[c])), self.k, self.sign)
        self.tops[c], self.new[c] = (row, iid, score), []
        full = pos == self.k
        worst = np.round(score[full], RANK_DECIMALS)
        self.floor[c * Q_CHUNK + row[full]] = -((worst + 1e-9) ** 2) if self.metric == "l2" else worst - 1e-9

    def rows(self):
        """(qid, iid, rank, score) arrays; queries with the same id share one list."""
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for c, lo in enumerate(range(0, len(self.q), Q_CHUNK)):
            if self.new[c]:
                self._merge(c)
            row, iid, score = self.tops[c]
            self.tops[c] = None
            out = tuple(np.concatenate(v) for v in zip(held, (self.qid[lo + row], iid, score)))
            end = lo + Q_CHUNK
            again = out[0] == self.qid[end] if end < len(self.qid) else np.zeros(len(out[0]), bool)
            held = tuple(v[again] for v in out)
            qid, iid, score, pos = _best(*(v[~again] for v in out), self.k, self.sign)
            yield qid, iid, pos.astype(np.int32), score


def _matrix(col: pa.Array, metric: str) -> np.ndarray:
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)
    return x if metric == "l2" else _unit(x)


def _search(k: int, metric: str, i_block: int):
    """Batches sorted by (pair, kind) → tops; kind 0 is a query, 1 an exclusion, 2 an item."""

    def cat(got: list, i: int, like) -> np.ndarray:
        return np.concatenate([v[i] for v in got]) if got else like

    def run(batches):
        now, tops, held, have = None, None, ([], [], []), 0

        def flush():
            nonlocal tops, have
            qs, ex, its = held
            if not qs or not its:
                its.clear()
                have = 0
                return
            if tops is None:
                none = np.zeros(0, np.int64)
                tops = _Tops(k, metric, cat(qs, 0, None), cat(qs, 1, None), cat(ex, 0, none), cat(ex, 1, none))
            iid = cat(its, 0, None)
            order = np.argsort(iid, kind="stable")
            tops.add(iid[order], cat(its, 1, None)[order])
            its.clear()
            have = 0

        def done():
            flush()
            for out in tops.rows() if tops is not None else ():
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in out], names=["qid", "iid", "rank", "score"])

        for rb in batches:
            pair, kind = (rb.column(c).to_numpy() for c in ("pair", "kind"))
            cuts = np.flatnonzero((pair[1:] != pair[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(pair)]):
                if hi == lo:
                    continue
                if pair[lo] != now:
                    yield from done()
                    now, tops, held, have = pair[lo], None, ([], [], []), 0
                part = rb.slice(lo, hi - lo)
                if kind[lo] == 1:
                    held[1].append((part.column("qid").to_numpy(), part.column("iid").to_numpy()))
                    continue
                held[kind[lo]].append((part.column("iid" if kind[lo] else "qid").to_numpy(), _matrix(part.column("features"), metric)))
                if kind[lo] == 2:
                    have += hi - lo
                    if have >= i_block:
                        flush()
        yield from done()

    return run


def knn(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    metric: str = "cosine",
    exclude: DataFrame | None = None,
    q_block: int = 32_768,
    i_block: int = 8192,
) -> DataFrame:
    """Top-``k`` items per query.

    queries: (qid long, features array<float|double>)
    items:   (iid long, features array<float|double>)
    exclude: optional (qid, iid) pairs never returned (seen masking, JN12)
    returns (qid, iid, rank, score): rank 1..k by score descending (cosine/ip)
             or distance ascending (l2), ties by iid.

    Items are copied once per query block, so blocks are as large as a task's
    memory allows: it holds the block's vectors, ``k`` results per query and one
    ``Q_CHUNK`` × ``i_block`` score matrix (16 MB by default).  With few rows the
    blocks shrink until every core has one.  An item id that occurs more than once
    counts once, with its smallest vector.  Rows without an id take no part, nor do
    rows whose vector is null or holds a null or a non-finite number.
    """
    metric = metric.lower()
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}: use one of {', '.join(METRICS)}")

    def usable(df: DataFrame, id_col: str) -> DataFrame:
        bad = F.exists("features", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return df.where(F.col(id_col).isNotNull() & F.col("features").isNotNull() & ~bad).select(id_col, "features")

    queries, items = usable(queries, "qid"), usable(items, "iid")
    n_q = queries.count()
    n_i, distinct = items.agg(F.count("iid"), F.count_distinct("iid")).first()
    if distinct < n_i:
        size = F.col("features") if metric == "l2" else l2_normalize(F.col("features"))
        items = items.groupBy("iid").agg(F.min_by("features", size).alias("features"))
        n_i = distinct
    cores = queries.sparkSession.sparkContext.defaultParallelism
    nqb = max(1, math.ceil(n_q / q_block), min(2 * cores, math.ceil(n_q / Q_CHUNK)))
    nig = max(1, min(math.ceil(2 * cores / nqb), math.ceil(n_i / i_block)))
    float32 = {df.schema["features"].dataType.simpleString() for df in (queries, items)} == {"array<float>"}
    vector = "array<float>" if float32 else "array<double>"

    def blk(c, n):
        return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")

    def rows(df: DataFrame, kind: int, qb, ig):
        """Copies of the rows for their pairs of query block and item group."""
        has = lambda c, t: (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
        out = df.select(qb.alias("qb"), "*").select("*", ig.alias("ig"))
        return out.select((F.col("qb") * nig + F.col("ig")).alias("pair"), F.lit(kind).alias("kind"), has("qid", "long"), has("iid", "long"), has("features", vector))

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    sent = rows(queries, 0, blk("qid", nqb), every(nig)).unionByName(rows(items, 2, every(nqb), blk("iid", nig)))
    if exclude is not None:
        ex = exclude.select("qid", "iid").where("qid IS NOT NULL AND iid IS NOT NULL")
        sent = sent.unionByName(rows(ex, 1, blk("qid", nqb), blk("iid", nig)))
    # one pair per partition; within it queries come first and items are read as a stream
    sent = sent.repartitionById(nqb * nig, F.col("pair")).sortWithinPartitions("pair", "kind")
    tops = sent.mapInArrow(_search(k, metric, i_block), _OUT)
    if nig == 1:
        return tops
    key = F.round("score", RANK_DECIMALS)
    order = [key.asc() if metric == "l2" else key.desc(), F.asc("iid")]
    w = Window.partitionBy("qid").orderBy(*order)
    return tops.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("qid", "iid", "rank", "score")
