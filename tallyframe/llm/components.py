"""Connected components of a graph given by its links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.sources.shared import settle


#: Links that one task takes at least, beyond one task a core.
_TASK_LINKS = 100_000


def _is_flat(links: DataFrame, tasks: int) -> bool:
    """Whether each node has one link to a smaller node, or links from larger nodes only."""
    ends = links.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        links.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    node = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).coalesce(tasks)
    return not node.where("up > 1 or up = 1 and down = 1").limit(1).count()


def components(links: DataFrame, left: str, right: str, rounds: int = 60) -> DataFrame:
    """`node` and `component` (the smallest node reachable) for every node with a link to another.

    Large-star and small-star steps in turn, until every node is a head or points to one; each step halves the paths, so
    long chains take logarithmically many. Every node's neighbourhood is reduced to its minimum before it is joined back, so no
    neighbourhood is gathered anywhere, and a hub's links are split by the skew join: null-safe equality changes no row, but
    gives the minima a shuffle of their own, without which adaptive execution splits nothing. Each round is written to the shared
    folder, which cuts the lineage. What a round reduces is held by as many tasks as the number of links asks for, not by one for each
    shuffle partition: links are two numbers each, and a small graph would else take a thousand tasks and hundreds of files a round. The
    joins keep all their partitions, for the skew join to split. Links with a NULL end and loops are ignored; no links give no rows.
    """
    a, b = F.col(f"`{left}`"), F.col(f"`{right}`")
    links = links.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    links = settle(links.distinct(), "links")
    tasks = links.sparkSession.sparkContext.defaultParallelism + links.count() // _TASK_LINKS  # no round has more links
    for _ in range(rounds):
        if _is_flat(links, tasks):
            break
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "node").coalesce(tasks)
        large = both.where("v > u").join(least, F.col("u").eqNullSafe(F.col("node"))).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "node").coalesce(tasks)
        small = large.join(least, F.col("u").eqNullSafe(F.col("node"))).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = settle(small.unionAll(least.select(F.col("node").alias("u"), F.col("m").alias("v"))).distinct().coalesce(tasks), "links")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    heads = links.select(F.col("v").alias("node")).distinct().coalesce(tasks).select("node", F.col("node").alias("component"))
    return settle(links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(heads), "components")
