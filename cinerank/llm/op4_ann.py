"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

Largest inner product becomes nearest distance by one more coordinate
(``x / M`` with ``sqrt(1 - |x/M|^2)``, M the largest norm), in which a tree of
k-means splits is fitted on a bounded sample.  Every row is then indexed: it
descends to one leaf.  A query walks the tree through a priority queue that
always opens the node whose centre is nearest, so leaves come out best first.

How many leaves to visit is calibrated: for a bounded set of queries the true
neighbours are found by brute force over all rows, and the visits are widened
to the smallest number at which the measured recall reaches ``recall``.

Leaves stand on shelves of about ``shelf_rows`` rows.  Queries meet rows by shelf:
a query goes once to each shelf that holds leaves it visits, is multiplied with
those leaves only, and leaves with one list.  A crowded shelf's rows are cut into
blocks and its queries into chunks, so neither a crowded leaf nor a popular query
region ends in one task.  Equal vectors are one candidate with
their smallest ``k + 1`` ids (no other id of theirs can be among the nearest) and
one query, so a vector that a third of all rows share costs as much as any other.
Scores are the exact double-precision inner products of the original vectors.

Defined results: rows whose id or vector is null, whose vector is zero, holds a
null or non-finite component or has another length than most take no part; a row
is never its own neighbour, nor are other rows with its id; ties go to the
smaller id; a repeated query row is answered once; fewer than ``k`` candidates
are all returned; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinerank.llm.common import maybe_broadcast, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Queries multiplied at once inside a task: with a shelf's rows this bounds the score matrix.
QUERY_ROWS = 64


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    y = x / top
    return np.hstack([y, np.sqrt(np.maximum(0.0, 1.0 - (y * y).sum(1)))[:, None]])


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(steps):
        near = np.argmin((c * c).sum(1)[None, :] - 2.0 * (x @ c.T), axis=1)
        n = np.bincount(near, minlength=k)
        s = np.zeros_like(c)
        np.add.at(s, near, x)
        c = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], c)
    return c, np.argmin((c * c).sum(1)[None, :] - 2.0 * (x @ c.T), axis=1)


class Tree:
    """Nodes as (centres, children); a child is a node number, or ``-1 - leaf``."""

    def __init__(self, x: np.ndarray, branch: int, leaf_rows: int, seed: int = 5):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.root = self._build(x, branch, leaf_rows, np.random.default_rng(seed))

    def _build(self, x, branch, leaf_rows, rng) -> int:
        if len(x) <= leaf_rows or len(x) < 2 * branch:
            self.leaves += 1
            return -self.leaves
        c, near = _kmeans(x, branch, rng)
        used = np.unique(near)
        if len(used) < 2:
            self.leaves += 1
            return -self.leaves
        me = len(self.centres)
        self.centres.append(c[used])
        self.children.append([])
        self.children[me] = [self._build(x[near == j], branch, leaf_rows, rng) for j in used]
        return me

    @classmethod
    def of(cls, state: dict) -> Tree:
        """The tree of a broadcast ``vars(tree)`` (plain arrays, so workers need no package)."""
        me = cls.__new__(cls)
        me.__dict__ = state
        return me

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of every row."""
        out = np.zeros(len(x), dtype=np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
                continue
            c = self.centres[node]
            near = np.argmin((c * c).sum(1)[None, :] - 2.0 * (x[rows] @ c.T), axis=1)
            todo += [(ch, rows[near == j]) for j, ch in enumerate(self.children[node]) if (near == j).any()]
        return out

    def walk(self, q: np.ndarray, visits: int, held: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first ``visits`` leaves, best bin first, and further ones until they hold ``least`` ids."""
        heap, out, ids = [(0.0, self.root)], [], 0
        while heap and (len(out) < visits or ids < least):
            _, node = heapq.heappop(heap)
            if node < 0:
                out.append(-1 - node)
                ids += 0 if held is None else int(held[-1 - node])
                continue
            c = self.centres[node]
            d = (c * c).sum(1) - 2.0 * (c @ q)
            for key, ch in zip(d.tolist(), self.children[node]):
                heapq.heappush(heap, (key, ch))
        return out


def _lifted_queries(vecs, top: float) -> np.ndarray:
    q = np.stack(vecs).astype(np.float64)
    q = q / np.maximum(np.sqrt((q * q).sum(1)), 1e-300)[:, None]
    return np.hstack([q, np.zeros((len(q), 1))])


def _best(rough: np.ndarray, q: np.ndarray, x: np.ndarray, first_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` nearest to ``q`` by (score down, id up), and their exact scores; ``rough`` has the
    products, or -inf for rows that take no part."""
    if len(rough) > k:
        edge = np.partition(rough, len(rough) - k)[len(rough) - k]
        rows = np.flatnonzero((rough >= edge - 1e-9 * (1.0 + abs(edge))) & (rough > -np.inf))
    else:
        rows = np.flatnonzero(rough > -np.inf)
    score = (x[rows] * q[None, :]).sum(axis=1)  # row by row, so equal vectors score equally anywhere
    by = np.lexsort((first_id[rows], -score))[:k]
    return rows[by], score[by]


def _usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    v = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where("id IS NOT NULL AND vec IS NOT NULL")
    v = v.where(~F.exists("vec", bad) & F.exists("vec", lambda x: x != 0))
    sizes = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return v.where(F.size("vec") == (sizes[0]["d"] if sizes else 0))


def search(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, recall: float = 0.97, sample: int = 32_768, branch: int = 8, rows_per_leaf: int = 512, leaf_rows: int = 16, calibrate: int = 256, shelf_rows: int = 16_384) -> DataFrame:
    """``query_id, rank, vec_id, score``; ``is_query`` is a condition on the column ``id``.

    The tree stops splitting when a leaf would hold about ``rows_per_leaf`` rows of the whole table
    (and at ``leaf_rows`` of the sample): a query travels once to each leaf that it visits, so leaves
    are as large as one cheap matrix product.
    """
    if k < 1 or not 0 < recall <= 1 or branch < 2:
        raise ValueError("k must be at least 1, recall within (0, 1] and branch at least 2")
    spark = df.sparkSession
    v = _usable(df, id_col, vec_col).withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(1), "vec"))
    # one row per distinct vector, with the only ids of it that can be found
    few = v.withColumn("rn", F.dense_rank().over(Window.partitionBy("h1", "h2").orderBy("id"))).where(F.col("rn") <= k + 1)
    cand = few.groupBy("h1", "h2").agg(F.min_by("vec", "id").alias("vec"), F.sort_array(F.collect_set("id")).alias("ids"))
    cand = written(cand, "vectors")
    n, top = cand.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)))).first()
    queries = written(v.where(is_query).select("id", "h1", "h2").distinct(), "queries")
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = cand.join(queries.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").select("h1", "h2", "vec")

    fit = np.stack(cand.orderBy(F.xxhash64("h1", "h2"), "h1").limit(sample).select("vec").toPandas()["vec"].to_list()).astype(np.float64)
    tree = Tree(_lift(fit, top), branch, max(leaf_rows, math.ceil(rows_per_leaf * len(fit) / n)))
    shared, leaves = spark.sparkContext.broadcast(vars(tree)), tree.leaves

    def place(batches):
        tree = Tree.of(shared.value)
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(leaf=tree.assign(_lift(np.stack(pdf["vec"].to_list()), top)))

    rows = written(cand.mapInPandas(place, "h1 long, h2 long, vec array<double>, ids array<long>, leaf long"), "leaves")

    # calibration: true neighbours of a bounded set of queries, over all rows
    probe = asked.orderBy(F.xxhash64("h2", "h1"), "h1").limit(calibrate).toPandas()
    if len(probe) == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pq = spark.sparkContext.broadcast(np.stack(probe["vec"].to_list()).astype(np.float64))

    def truth(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x, first = np.stack(pdf["vec"].to_list()), np.array([i[0] for i in pdf["ids"]])
            got = [_best(x @ q, q, x, first, k + 1) for q in pq.value]
            yield pd.DataFrame({"q": np.repeat(np.arange(len(got)), [len(r) for r, _ in got]), "leaf": np.concatenate([pdf["leaf"].to_numpy()[r] for r, _ in got]), "first": np.concatenate([first[r] for r, _ in got]), "score": np.concatenate([s for _, s in got])})

    best = Window.partitionBy("q").orderBy(F.desc("score"), "first")
    true = rows.select("vec", "ids", "leaf").mapInPandas(truth, "q long, leaf long, first long, score double").withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k + 1).select("q", "leaf").toPandas()
    lifted = _lifted_queries(probe["vec"].to_list(), top)
    turn = np.zeros((len(probe), leaves), dtype=np.int64)
    for i, q in enumerate(lifted):
        turn[i, tree.walk(q, leaves)] = np.arange(leaves)
    at = np.sort(turn[true["q"].to_numpy(), true["leaf"].to_numpy()])
    visits = int(at[min(len(at) - 1, math.ceil(recall * len(at)) - 1)]) + 1

    # a query goes on until its leaves hold its k neighbours and itself
    held = np.zeros(leaves, dtype=np.int64)
    for leaf, ids in rows.groupBy("leaf").agg(F.sum(F.size("ids"))).collect():
        held[leaf] = ids
    counts = spark.sparkContext.broadcast(held)

    def plan(batches):
        tree = Tree.of(shared.value)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            got = [tree.walk(q, visits, counts.value, k + 1) for q in _lifted_queries(pdf["vec"].to_list(), top)]
            yield pdf.assign(leaf=got)

    shelves = max(1, min(leaves, math.ceil(n / shelf_rows)))
    ask = asked.mapInPandas(plan, "h1 long, h2 long, vec array<double>, leaf array<long>")
    ask = ask.withColumn("shelf", F.explode(F.array_distinct(F.transform("leaf", lambda x: x % shelves))))
    ask = written(ask.withColumn("leaf", F.filter("leaf", lambda x: x % shelves == F.col("shelf"))), "visits")
    rows = rows.withColumn("shelf", F.col("leaf") % shelves)
    # blocks of rows and chunks of queries per shelf (at most one line per leaf)
    cut = lambda df, c: df.groupBy("shelf").agg(F.ceil(F.count(F.lit(1)) / shelf_rows).alias(c))
    size = F.broadcast(written(cut(rows, "blocks").join(cut(ask, "chunks"), "shelf"), "cuts"))
    left = ask.join(size, "shelf").select("shelf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.pmod("h1", "chunks").alias("chunk"), "h1", "h2", "vec", "leaf")
    right = rows.join(size, "shelf").select("shelf", F.pmod("h2", "blocks").alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), "leaf", "vec", "ids")

    def meet(qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        out = {c: [] for c in ("h1", "h2", "score", "first", "ids")}
        if len(qs) and len(xs):
            xs = xs.sort_values("leaf", kind="stable")
            x, ids, leaf = np.stack(xs["vec"].to_list()), xs["ids"].to_numpy(), xs["leaf"].to_numpy()
            first = np.array([i[0] for i in ids])
            names, starts = np.unique(leaf, return_index=True)
            ends = np.append(starts[1:], len(leaf))
            h1s, h2s = qs["h1"].to_numpy(), qs["h2"].to_numpy()
            for at in range(0, len(qs), QUERY_ROWS):
                q = np.stack(qs["vec"].iloc[at : at + QUERY_ROWS].to_list()).astype(np.float64)
                visits = qs["leaf"].iloc[at : at + QUERY_ROWS].to_list()
                goes = np.array([np.isin(names, v) for v in visits])
                rough = np.full((len(q), len(x)), -np.inf)
                for j in range(len(names)):
                    who = np.flatnonzero(goes[:, j])
                    if len(who):
                        rough[who, starts[j] : ends[j]] = q[who] @ x[starts[j] : ends[j]].T
                for i in range(len(q)):
                    r, s = _best(rough[i], q[i], x, first, k + 1)
                    out["h1"] += [h1s[at + i]] * len(r)
                    out["h2"] += [h2s[at + i]] * len(r)
                    out["score"] += s.tolist()
                    out["first"] += first[r].tolist()
                    out["ids"] += list(ids[r])
        return pd.DataFrame(out)

    key = ["shelf", "block", "chunk"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(meet, "h1 long, h2 long, score double, first long, ids array<long>")
    top_vec = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "first")
    found = found.withColumn("rn", F.row_number().over(top_vec)).where(F.col("rn") <= k + 1)
    found = found.select("h1", "h2", "score", F.explode("ids").alias("vec_id"))
    found = found.withColumn("rn", F.row_number().over(Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id"))).where(F.col("rn") <= k + 1)
    found = written(found.select("h1", "h2", "score", "vec_id"), "found")
    res = queries.join(found, ["h1", "h2"]).where("vec_id <> id")
    res = res.withColumn("rank", F.row_number().over(Window.partitionBy("id", "h1", "h2").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return res.select(F.col("id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
