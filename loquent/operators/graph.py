"""The entity graph as a node table and an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loquent.plans.skew import salted_join

_ENDS = ["entity_a", "entity_b"]


def graph_nodes(entities: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One node per entity text; a text with several types keeps the smallest.

    Nodes in ``existing`` stay; their type is overwritten if seen again.
    """
    fresh = entities.groupBy("entity_text").agg(F.min("entity_type").alias("entity_type"))
    if existing is None:
        return fresh
    old = existing.select("entity_text", F.col("entity_type").alias("_old_type"))
    return fresh.join(old, "entity_text", "full_outer").select(
        "entity_text", F.coalesce("entity_type", "_old_type").alias("entity_type")
    )


def ends_known(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose two ends are nodes."""
    for end, other in (_ENDS, _ENDS[::-1]):
        names = nodes.select(F.col("entity_text").alias(end))
        pairs = salted_join(pairs, names, [end], [other], "left_semi")
    return pairs


def graph_edges(
    pairs: DataFrame,
    nodes: DataFrame,
    existing: DataFrame | None = None,
    *,
    replace: bool = False,
) -> DataFrame:
    """Edges whose two ends are nodes, merged into ``existing``.

    Edges seen again get the new counts. Older edges stay, unless ``replace``.
    """
    fresh = ends_known(pairs, nodes)
    if existing is None or replace:
        return fresh
    kept = existing.join(fresh.select(*_ENDS), _ENDS, "left_anti")
    return kept.unionByName(fresh)


def graph_triples(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Every edge with the types of both ends."""
    a = nodes.select(
        F.col("entity_text").alias("entity_a"), F.col("entity_type").alias("type_a")
    )
    b = nodes.select(
        F.col("entity_text").alias("entity_b"), F.col("entity_type").alias("type_b")
    )
    half = salted_join(edges, a, ["entity_a"], ["entity_b"])
    return salted_join(half, b, ["entity_b"], ["entity_a"]).select(
        "entity_a", "type_a", "entity_b", "type_b", "video_count", "segment_count"
    )
