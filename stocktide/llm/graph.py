"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.tables import scratch, written
from stocktide.shared_dir import shuffles_dropped


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each `u`. Sums before the shuffle, so a hub is one row per task."""
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least(both), "u").select("v", F.least("u", "least").alias("least"))
    return joined.where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    joined = edges.join(_least(edges), "u")
    kept = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).where("u > v")
    return kept.union(joined.select("u", F.col("least").alias("v"))).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether each `u` has one `v`, which is no `u` itself. As `u` is always larger than `v`, every component is
    then a star around its smallest node."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    ends = edges.select(F.col("u").alias("node"), one.alias("up"), none.alias("down")).union(
        edges.select("v", none, one)
    )
    # Sums before the shuffle, so a hub is one row per task.
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    with shuffles_dropped(edges.sparkSession):
        others = nodes.where("up > 0 and up + down > 1").agg(F.count("*")).first()
    return others[0] == 0


def stars(links: DataFrame) -> DataFrame:
    """Every node in `links` (a, b) but the smallest of each component as `u`, with that smallest one as `v`.

    Nulls and loops link nothing. Each step is written to the shared folder; the number of steps
    grows with the logarithm of the longest chain. Only one number per step comes to the driver.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = links.where("a <> b").select(high.alias("u"), low.alias("v")).distinct()
    with scratch(links.sparkSession) as used:
        while True:
            edges = written(_small(_large(edges)), "edges")
            if _all_stars(edges):
                return used.keep(edges)


def labels_of(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in `edges`, which are `stars`."""
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in `links` (a, b): root is the smallest node reachable."""
    return labels_of(stars(links))
