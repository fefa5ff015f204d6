"""Connected components of a link table, by repeated random contraction.

Each round maps every node to the neighbour (or itself) that comes first in
that round's pseudo-random order, renames the links' ends and drops loops and
repeats; a constant share of the nodes goes in every round whatever the shape
of the graph, so long chains need O(log n) rounds as well.  Every step is a
map-side-combined aggregate or a join that adaptive execution can split, and
each round's (shrinking) tables are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node with a link; nodes share a root iff connected.

    The root is an arbitrary but deterministic member.  Null ends, loops and
    repeated links are ignored; an empty table gives an empty result.
    """
    e = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    e = written(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    steps = []
    for turn in range(200):
        if e.isEmpty():
            break
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("x"))
        step = both.groupBy("a").agg(F.least(F.min(order("b")), F.min(order("a"))).alias("m")).select(F.col("a").alias("n"), F.col("m.x").alias("p"))
        step = written(step, "step")
        steps.append(step)
        left = e.join(step.select(F.col("n").alias("a"), F.col("p").alias("pa")), "a").join(step.select(F.col("n").alias("b"), F.col("p").alias("pb")), "b")
        e = written(left.where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
    if not steps:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    mapping = steps[0].select(F.col("n").alias("node"), F.col("p").alias("root"))
    for step in steps[1:]:  # O(log n) written tables
        mapping = mapping.join(step.select(F.col("n").alias("root"), F.col("p").alias("_p")), "root", "left").select("node", F.coalesce("_p", "root").alias("root"))
    return written(mapping, "map")
