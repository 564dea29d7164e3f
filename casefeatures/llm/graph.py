"""Connected components of links, without the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefeatures.sources.files import checkpointed

#: Rows a task takes of a graph, about; a small graph is not dealt over as many tasks as a shuffle has partitions.
TASK_ROWS = 5_000
#: Nodes whose smallest neighbours are broadcast, at most; more are joined by a shuffle.
BROADCAST_NODES = 100_000


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (its component's smallest node) for every node of ``a``, ``b``; other nodes have no row.

    Large and small stars by turns: every node's larger (then smaller) neighbours are hung on the smallest neighbour, until
    every node hangs on one node that hangs on none. Neighbours are never gathered: only minima and counts are, which combine before
    the shuffle. Rounds grow with the logarithm of the longest chain. Self links and null ends are left out; no links give no rows.
    """
    big, small = F.greatest("a", "b"), F.least("a", "b")
    edges = checkpointed(links.where("a <> b").select(big.alias("a"), small.alias("b")).distinct())
    tasks = 1 + edges.count() // TASK_ROWS
    edges = edges.coalesce(tasks)
    while True:
        ends = edges.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))
        smaller = F.count_if(F.col("v") < F.col("u"))
        least = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), smaller.alias("down"), (F.count("*") - smaller).alias("up"))
        least = checkpointed(least.coalesce(tasks)).coalesce(tasks)
        open_ = (F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))
        nodes, unsettled = least.agg(F.count("*"), F.count_if(open_)).first()
        if not unsettled:
            return least.select(F.col("u").alias("node"), F.col("m").alias("root"))
        few = F.broadcast if nodes <= BROADCAST_NODES else lambda df: df
        large = edges.join(few(least.select(F.col("u").alias("b"), "m")), "b").select("a", F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks)
        star = large.join(few(least), "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = checkpointed(star.distinct().coalesce(tasks))
