"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loquent.session import write_out


def _both_ways(links: DataFrame) -> DataFrame:
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.unionByName(turned)


def _large_star(links: DataFrame) -> DataFrame:
    """Links larger neighbours of every node to its smallest neighbour."""
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links smaller neighbours of every node, and the node, to the smallest."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; the root is the smallest node.

    ``links`` has two columns of whole numbers, ``a`` and ``b``. Large-star and
    small-star rounds turn every component into a star around its smallest node
    in a number of rounds that grows with the logarithm of its size. A hub is
    reduced by map-side minima and met by skew-aware joins. Every round is
    written to the shared folder, so no lineage grows.
    """
    now = write_out(links.filter("a <> b").distinct(), "links")
    mark = None
    while True:
        seen = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if seen["n"] == 0 or (seen["n"], seen["s"]) == mark:
            break
        mark = (seen["n"], seen["s"])
        starred = _small_star(_large_star(now).distinct())
        now = write_out(starred.filter("a <> b").distinct(), "links")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.unionByName(roots)
