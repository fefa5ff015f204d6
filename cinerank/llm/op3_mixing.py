"""Mixing sources to target weights by entropy balancing.

Targets: sources in code-point order (null last) weigh ``weights``, repeating,
and share ``share`` times all words; a target stops at ``max_repeat`` times its
source's words and the excess is reshared by weight until none is above.

Rates: among all document rates in ``[0, max_repeat]`` whose words add up to a
source's target, the one nearest to keeping every document once (in relative
entropy) is an exponential tilt, ``rate = min(max_repeat, exp(lambda * size / mean))``.
``lambda`` solves the source's convex dual; all sources' duals are solved
together by distributed, bracketed Newton steps over the (source, size)
histogram, which is the sufficient statistic and is pre-aggregated before any
shuffle, so a source that holds a third of all rows is a few thousand rows.

Copies: the histogram's expected copies are rounded systematically in
descending size, the words still missing are settled by the largest sizes that
fit, and a bin's odd copies go to its documents of smallest id hash (ranked in
bounded sub-bins).  Everything is DataFrame expressions.

Defined results: null and empty texts have size 0 and are taken 0 words (their
``copies`` is 1 if their source is otherwise kept whole, see below); a null
source is a source of its own, last in order; null ids and repeated rows are
documents like any others, alike rows being interchangeable; an empty table
gives an empty table.  Documents without words carry no constraint: rate 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinerank.functions.ranking import sorted_rank
from cinerank.llm.common import maybe_broadcast, written

#: A word is a maximal run outside the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one ranking sub-bin should hold.
BIN_ROWS = 2000
#: Newton stops when every source's words are within this share of the target.
TOLERANCE = 1e-7
MAX_STEPS = 60


def targets(sized: DataFrame, weights=(5, 2, 1), share: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """``sid, source, source_size, target`` from (source, words) rows, one row per source."""
    per = sized.groupBy("source").agg(F.sum("words").cast("long").alias("source_size"))
    per = sorted_rank(per, [F.col("source").asc_nulls_last()], out="sid")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = written(per.select("sid", "source", "source_size", w.alias("w"), (F.col("source_size") * F.lit(float(max_repeat))).alias("cap")), "sources")
    total = per.agg(F.sum("source_size"), F.sum("w")).first()
    goal, level = float(total[0] or 0) * share, None
    nxt = goal / total[1] if total[1] else 0.0
    while level != nxt:  # each turn reshares the excess of the sources that have reached their cap
        level = nxt
        full = F.col("cap") <= F.col("w") * F.lit(level)
        r = per.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("w")))).first()
        if r[1]:
            nxt = max(level, (goal - float(r[0] or 0.0)) / r[1])
    return per.select("sid", "source", "source_size", F.least("cap", F.col("w") * F.lit(level)).alias("target"))


def tilts(hist: DataFrame, per: DataFrame, max_repeat: float = 2.0) -> DataFrame:
    """``sid, lam, mean`` solving every source's dual; ``hist`` is (sid, size, n) with size > 0."""
    shape = hist.groupBy("sid").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"), F.min("size").alias("least"), F.sum(F.col("n") * F.col("size")).alias("words"))
    st = per.select("sid", "target").join(shape, "sid")
    z0 = F.col("least") / F.col("mean")
    # with lam = hi every rate is max_repeat; with lam = lo even the shortest fall below the target
    st = st.where("target > 0").select(
        "sid", "target", "mean", F.lit(0.0).alias("lam"),
        (F.least(F.lit(0.0), F.log(F.col("target") / F.col("words"))) / z0 - 1e-9).alias("lo"),
        (F.lit(float(max_repeat)) * 0 + F.log(F.lit(float(max_repeat))) / z0 + 1e-9).alias("hi"),
        F.lit(1.0).alias("gap"),
    )
    st = written(st, "duals")
    cap = F.log(F.lit(float(max_repeat)))
    for _ in range(MAX_STEPS):
        x = hist.join(maybe_broadcast(st, 64), "sid")
        z = F.col("size") / F.col("mean")
        e = F.col("lam") * z
        rate = F.exp(F.least(e, cap))
        words = F.col("n") * F.col("size")
        x = x.groupBy("sid").agg(F.sum(words * rate).alias("got"), F.sum(F.when(e < cap, words * z * rate).otherwise(0.0)).alias("slope"))
        x = st.join(x, "sid")
        over = F.col("got") > F.col("target")
        lo, hi = F.when(over, F.col("lo")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(F.col("hi"))
        x = x.select("sid", "target", "mean", "lam", lo.alias("lo"), hi.alias("hi"), "got", "slope")
        newton = F.col("lam") - (F.col("got") - F.col("target")) / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("lo")) & (newton < F.col("hi"))
        gap = F.abs(F.col("got") - F.col("target")) / F.col("target")
        step = F.when(gap <= TOLERANCE, F.col("lam")).when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2)
        st = written(x.select("sid", "target", "mean", step.alias("lam"), "lo", "hi", gap.alias("gap")), "duals")
        if (st.agg(F.max("gap")).first()[0] or 0.0) <= TOLERANCE:
            break
    return st.select("sid", "lam", "mean")


def _rounded(bins: DataFrame, max_repeat: int) -> DataFrame:
    """Integer copies per (sid, size) bin, near each source's target in words."""
    down = Window.partitionBy("sid").orderBy(F.col("size").desc())
    upto = F.sum(F.col("n") * F.col("rate")).over(down.rowsBetween(Window.unboundedPreceding, 0))
    b = bins.withColumn("upto", F.floor(upto + 0.5))
    b = b.withColumn("copies", F.col("upto") - F.coalesce(F.lag("upto").over(down), F.lit(0))).drop("upto")
    b = b.withColumn("copies", F.greatest(F.lit(0), F.least("copies", F.col("n") * max_repeat)).cast("long"))
    whole = Window.partitionBy("sid")
    for _ in range(4):  # each turn brings the missing (or surplus) words below the size it used
        left = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(whole)
        b = b.withColumn("left", left)
        room = F.when(F.col("left") > 0, F.col("n") * max_repeat - F.col("copies")).otherwise(F.col("copies"))
        fits = (room > 0) & (F.col("size") <= F.abs("left") + 0.5)
        b = b.withColumn("room", room).withColumn("pick", F.max(F.when(fits, F.col("size"))).over(whole))
        move = F.least("room", F.floor((F.abs("left") + 0.5) / F.col("size"))) * F.signum("left").cast("long")
        b = b.withColumn("copies", (F.col("copies") + F.when(F.col("size") == F.col("pick"), move).otherwise(0)).cast("long")).drop("left", "room", "pick")
    return b


def mix(docs: DataFrame, keep: list[str] | None = None, weights=(5, 2, 1), share: float = 1.5, max_repeat: int = 2) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns, by default doc_id), ``size, source_size, target, rate, copies, taken``."""
    if not weights or min(weights) <= 0 or max_repeat < 1 or not 0 <= share <= max_repeat:
        raise ValueError("weights must be positive, max_repeat at least 1 and share within 0..max_repeat")
    keep = ["doc_id"] if keep is None else keep
    text = F.col("text").cast("string")
    d = docs.select(
        F.struct(*keep).alias("row"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("doc_id", F.crc32(text.cast("binary"))).alias("h"),
    )
    hist = written(d.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    per = written(targets(hist.select("source", (F.col("size") * F.col("n")).alias("words")), weights, share, max_repeat), "targets")
    n_per = per.count()
    hist = hist.withColumnRenamed("source", "s_").join(maybe_broadcast(per.select("sid", "source"), 64, n_per), F.col("s_").eqNullSafe(F.col("source"))).select("sid", "size", "n")
    hist = written(hist, "hist")
    lam = tilts(hist.where("size > 0"), per, max_repeat)
    b = hist.where("size > 0").join(maybe_broadcast(per.select("sid", "target"), 32, n_per), "sid").join(maybe_broadcast(lam, 32, n_per), "sid", "left")
    rate = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.log(F.lit(float(max_repeat)))))
    b = _rounded(b.withColumn("rate", F.coalesce(rate, F.lit(0.0))).drop("lam", "mean"), max_repeat)
    b = b.select("sid", "size", "n", "rate", "copies").union(hist.where("size = 0").select("sid", "size", "n", F.lit(1.0).alias("rate"), F.col("n").alias("copies")))
    b = written(b.join(per.withColumnRenamed("source", "source_"), "sid"), "bins")

    base = (F.col("copies") / F.col("n")).cast("long")
    b = b.select("sid", F.col("source_"), F.col("size").alias("size_"), "source_size", "target", "rate", "n", base.alias("base"), (F.col("copies") - base * F.col("n")).alias("odd"))
    d = d.join(maybe_broadcast(b, 120), F.col("source").eqNullSafe(F.col("source_")) & (F.col("size") == F.col("size_")))
    d = d.withColumn("sub", F.pmod("h", F.ceil(F.col("n") / F.lit(BIN_ROWS)).cast("long")))
    before = Window.partitionBy("sid", "size").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    first = d.groupBy("sid", "size", "sub").agg(F.count(F.lit(1)).alias("k")).select("sid", "size", "sub", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("first"))
    first = written(first, "subs")
    d = d.withColumn("rn", F.row_number().over(Window.partitionBy("sid", "size", "sub").orderBy("h")))
    d = d.join(maybe_broadcast(first, 48), ["sid", "size", "sub"])
    copies = F.col("base") + (F.col("first") + F.col("rn") <= F.col("odd")).cast("long")
    return d.select("row", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: every row of ``docs`` (all columns) as often as it is taken."""
    out = mix(docs, keep=docs.columns, **params)
    rep = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return out.where("copies > 0").select("row", rep.alias("copy_")).select("row.*")
