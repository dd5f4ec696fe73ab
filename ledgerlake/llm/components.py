"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import staged


EDGES_A_TASK = 20_000


def _least(edges: DataFrame, tasks: int) -> DataFrame:
    """The least of each ``u`` and its neighbours; written, so the join that uses it is one that can split a hot ``u``."""
    return staged(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks), "cc-least")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns ``a``, ``b``, longs): the root is the least node of its component.

    Each step replaces edges by edges to least neighbours, which keeps components and
    shortens paths; the number of steps grows with the logarithm of the longest path.
    No step gathers a node's neighbours: minima are partial sums, the rest are equi-joins.
    Tasks follow the number of edges, which no step raises: few edges are not dealt over as
    many tasks and files as the session has shuffle partitions.
    """
    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")
    cores, state = e.sparkSession.sparkContext.defaultParallelism, None
    tasks = max(cores, -(-e.count() // EDGES_A_TASK))
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both, tasks), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks)
        large = staged(large.distinct().coalesce(tasks), "cc-large")
        joined = large.join(_least(large, tasks), "u").coalesce(tasks)
        e = staged(joined.select(F.col("u"), F.col("m").alias("v"))
                   .unionByName(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct().coalesce(tasks), "cc-small")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
