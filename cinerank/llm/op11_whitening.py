"""Embedding whitening from a weighted multiplicity covariance.

Vectors become integers (``floor(scale * x)``).  Equal vectors are grouped, and
each distinct one carries its number of copies; the fit weighs it by that number
(``weights="count"``) or once (``weights="one"``).  From the weighted sums S and the
total weight n comes the mean S / n; the covariance (divisor n) is a weighted matrix
product of the centred vectors, summed over Arrow batches.  Every distinct vector
is whitened once and joined back to its rows.

Sums are exact: a batch adds integers, and the parts of all tasks are added as
38-digit decimals, per dimension and in Spark.  Only the d sums and the d x d
covariance come to the driver, whose eigenvectors are computed there; d is the
width of a vector, not the size of the table.

Joining back is the one step that a frequent vector could crowd: vectors with more
than ``1 / HOT`` of all rows are fewer than ``HOT``, so they are broadcast, and the
others are joined by a shuffle on the vectors' 128-bit hash.

Defined results: rows whose vector is null or holds a null or non-finite component are
left out; a null id is an id like any other, repeated rows are all kept; a
shorter vector counts as filled up with zeros; components whose eigenvalue is zero to
double precision cannot be whitened and are left out, so a table with one distinct
vector, or none, gives an empty table; a deviation beyond 64 bits is null; other columns
are ignored whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors with more than this share (as a divisor) of all rows are joined by broadcast.
HOT = 1024
#: Vectors multiplied at once inside a task.
SLICE_ROWS = 8192
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _slices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, vectors as a matrix of width d, weights) of runs of whole rows."""
    for rb in batches:
        for i in range(0, rb.num_rows, SLICE_ROWS):
            part = rb.slice(i, SLICE_ROWS)
            col = part.column(part.schema.get_field_index("x"))
            size = pc.list_value_length(col).to_numpy(zero_copy_only=False).astype(np.int64)
            x = np.zeros((len(col), d), dtype=np.int64)
            row = np.repeat(np.arange(len(col)), size)
            x[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = col.flatten().to_numpy(zero_copy_only=False)
            yield part, x, part.column(part.schema.get_field_index("w")).to_numpy(zero_copy_only=False)


def _total(parts: DataFrame, kind: str) -> dict[int, object]:
    """Sum over all tasks of each place of their ``v`` arrays."""
    return {r["pos"]: r["s"] for r in parts.select(F.posexplode("v").alias("pos", "v")).groupBy("pos").agg(F.sum(F.col("v").cast(kind)).alias("s")).collect()}


class Whitening:
    """A fit: ``n``, sums ``s``, eigenvalues (falling) and unit eigenvectors (columns) with positive eigenvalues, trace."""

    def __init__(self, n: int, s: list[int], cov: np.ndarray):
        self.n, self.s = n, s
        e, u = np.linalg.eigh(cov)
        e, u = e[::-1], u[:, ::-1]
        good = e > max(len(e), 1) * np.finfo(float).eps * max(float(e[0]) if len(e) else 0.0, 0.0)
        self.e, self.u, self.trace = e[good], u[:, good], float(np.trace(cov))


def exact_sums(x: np.ndarray, w: np.ndarray) -> list[int]:
    """Weighted sums per dimension, in 64 bits where they surely fit, else as Python integers."""
    if float(np.abs(x.astype(np.float64)).max()) * float(w.max()) * len(x) < 2.0**62:
        return (x * w[:, None]).sum(axis=0).tolist()
    return (x.astype(object) * w.astype(object)[:, None]).sum(axis=0).tolist()


def _centred(x: np.ndarray, n: int, s: list[int]) -> tuple[np.ndarray, bool]:
    """n * x - S as exact integers: 64-bit where they surely fit (True), else Python integers."""
    most = max((abs(v) for v in s), default=0) + n * (int(np.abs(x.astype(np.float64)).max()) + 1 if x.size else 0)
    if most < 1 << 62:
        return x * n - np.array(s, dtype=np.int64), True
    return x.astype(object) * n - np.array(s, dtype=object), False


def deviations(x: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, exact; None beyond 64 bits."""
    c, small = _centred(x, n, s)
    if small and (c.size == 0 or float(np.abs(c).max()) ** 2 * c.shape[1] < 2.0**62):
        return (c * c).sum(axis=1).tolist()
    c = c.astype(object)
    return [v if v < 1 << 63 else None for v in (c * c).sum(axis=1).tolist()]


def centred_rows(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """x - S / n in double precision, from exact integers."""
    return _centred(x, n, s)[0].astype(np.float64) / float(n)


def grouped(df: DataFrame, id_col: str, vec_col: str, scale: int) -> tuple[DataFrame, DataFrame]:
    """Rows (``vec_id, h1, h2``) and distinct vectors (``h1, h2, x, copies``)."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    v = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    v = v.where(F.col("vec").isNotNull()).where(~F.exists("vec", bad))
    x = F.transform("vec", lambda c: F.floor(c * F.lit(float(scale))))
    v = written(v.select("vec_id", x.alias("x"), F.size("vec").alias("width")), "quantised")
    d = v.agg(F.max("width")).first()[0] or 0
    x = F.when(F.col("width") < d, F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.col("width")))).otherwise(F.col("x"))
    v = v.select("vec_id", x.alias("x")).select("vec_id", "x", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(7), "x").alias("h2"))
    return v.select("vec_id", "h1", "h2"), written(v.groupBy("h1", "h2", "x").agg(F.count(F.lit(1)).alias("copies")), "distinct")


def fit(distinct: DataFrame, weights: str = "one") -> Whitening | None:
    """The whitening of distinct vectors (``x, copies``); None without rows."""
    if weights not in ("one", "count"):
        raise ValueError("weights must be 'one' or 'count'")
    v = distinct.select("x", (F.lit(1).cast("long") if weights == "one" else F.col("copies")).alias("w"))
    n, d = v.agg(F.sum("w"), F.max(F.size("x"))).first()
    if not n or not d:
        return None

    def sums(batches):
        for _, x, w in _slices(batches, d):
            total = [[str(c) for c in exact_sums(x, w)]]
            yield pa.RecordBatch.from_arrays([pa.array(total, pa.list_(pa.string()))], names=["v"])

    s = _total(v.mapInArrow(sums, "v array<string>"), "decimal(38,0)")
    s = [int(s[i]) for i in range(d)]

    def gram(batches):
        held = np.zeros((d, d))
        for _, x, w in _slices(batches, d):
            c = centred_rows(x, n, s)
            held += (c * w[:, None]).T @ c
        yield pa.RecordBatch.from_arrays([pa.array([held.ravel().tolist()])], names=["v"])

    g = _total(v.mapInArrow(gram, "v array<double>"), "double")
    cov = np.array([g[i] for i in range(d * d)]).reshape(d, d) / n
    return Whitening(n, s, (cov + cov.T) / 2)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256, components: int = 4, weights: str = "one") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row."""
    if components < 1 or scale < 1:
        raise ValueError("components and scale must be at least 1")
    spark = df.sparkSession
    rows, distinct = grouped(df, id_col, vec_col, scale)
    model = fit(distinct, weights)
    if model is None or len(model.e) == 0:
        return spark.createDataFrame([], SCHEMA)
    k = min(components, len(model.e))
    n, s, d, u, e = model.n, model.s, len(model.s), model.u[:, :k], model.e[:k]

    def project(batches):
        for rb, x, _ in _slices(batches, d):
            z = (centred_rows(x, n, s) @ u) / np.sqrt(e)
            cols = [rb.column(rb.schema.get_field_index(c)) for c in ("h1", "h2", "w")]
            z = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * k), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([*cols, pa.array(deviations(x, n, s), pa.int64()), z], names=["h1", "h2", "w", "deviation", "z"])

    weight = F.lit(1).cast("long") if weights == "one" else F.col("copies")
    made = distinct.select("h1", "h2", "x", weight.alias("w"))
    made = written(made.mapInArrow(project, "h1 long, h2 long, w long, deviation long, z array<double>"), "whitened")

    # covariance of what was whitened, again centred before multiplying
    mean = made.agg(*[F.sum(F.col("w") * F.col("z")[i]).alias(f"m{i}") for i in range(k)]).first()
    c = [F.col("z")[i] - F.lit(mean[i] / n) for i in range(k)]
    cells = made.agg(*[F.sum(F.col("w") * c[i] * c[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(k)]).first()
    error = float(np.abs(np.array(list(cells)).reshape(k, k) / n - np.eye(k)).max())

    copies = distinct.select("h1", "h2", "copies")
    bound = max(1, rows.count() // HOT)
    hot = copies.where(F.col("copies") > bound).select("h1", "h2")  # fewer than HOT rows
    lead = F.broadcast(made.join(F.broadcast(hot), ["h1", "h2"], "left_semi").select("h1", "h2", "deviation", "z"))
    often = rows.join(lead, ["h1", "h2"])
    rest = rows.join(F.broadcast(hot), ["h1", "h2"], "left_anti").join(made.select("h1", "h2", "deviation", "z"), ["h1", "h2"])
    share = F.array(*[F.lit(float(v / model.trace)) for v in e])
    out = often.unionByName(rest).select("vec_id", "deviation", F.posexplode("z").alias("i", "whitened"))
    return out.select("vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", share[F.col("i")].alias("explained"), F.lit(error).alias("identity_error"))
