"""The stored graph: merges, repeated loads, broken loads and plans."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loquent.sources.graph_store import GraphStore, merge_edges, merge_nodes
from loquent.sources.warehouse import CommitConflict

NODE = "entity_text STRING, entity_type STRING"
EDGE = "entity_a STRING, entity_b STRING, video_count LONG, segment_count LONG"


@pytest.fixture
def store(spark, tmp_path):
    return GraphStore(spark, str(tmp_path / "graph"), buckets=4)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_loads_are_merged(spark, store):
    assert rows(store.nodes()) == rows(store.edges()) == rows(store.triples()) == []
    first = [("Oslo", "GPE"), ("Oslo", "ORG"), ("Ada", "PERSON"), (None, "ORG"), ("Lab", None)]
    pairs = [("Ada", "Oslo", 2, 3), ("Ada", "Nobody", 9, 9), ("Lab", "Oslo", 1, 1)]
    store.load(spark.createDataFrame(first, NODE), spark.createDataFrame(pairs, EDGE))
    assert rows(store.nodes().na.fill("-")) == [("Ada", "PERSON"), ("Lab", "-"), ("Oslo", "GPE")]
    assert rows(store.edges()) == [("Ada", "Oslo", 2, 3), ("Lab", "Oslo", 1, 1)]
    later = spark.createDataFrame([("Oslo", "CITY"), ("Nobody", "PERSON")], NODE)
    more = spark.createDataFrame([("Ada", "Oslo", 5, 8), ("Ada", "Nobody", 1, 2)], EDGE)
    store.load(later, more)
    want_nodes = [("Ada", "PERSON"), ("Lab", "-"), ("Nobody", "PERSON"), ("Oslo", "CITY")]
    want_edges = [("Ada", "Nobody", 1, 2), ("Ada", "Oslo", 5, 8), ("Lab", "Oslo", 1, 1)]
    for _ in range(2):
        assert rows(store.nodes().na.fill("-")) == want_nodes
        assert rows(store.edges()) == want_edges
        store.load(later, more)
    assert ("Ada", "PERSON", "Oslo", "CITY", 5, 8) in rows(store.triples())
    # Another session object finds the same graph, and its number of buckets.
    other = GraphStore(spark.newSession(), store.root, buckets=99)
    assert rows(other.edges()) == want_edges
    other.load(later, more.limit(0), replace=True)
    assert rows(store.edges()) == [] and rows(store.nodes().na.fill("-")) == want_nodes


def test_a_broken_or_late_load_changes_nothing(spark, store, monkeypatch):
    nodes = spark.createDataFrame([("a", "ORG"), ("b", "ORG")], NODE)
    pairs = spark.createDataFrame([("a", "b", 1, 1)], EDGE)
    store.load(nodes, pairs)
    broken = pairs.withColumn("video_count", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        store.load(nodes.withColumn("entity_type", F.lit("GPE")), broken)
    assert rows(store.nodes()) == [("a", "ORG"), ("b", "ORG")]
    assert rows(store.edges()) == [("a", "b", 1, 1)]
    begun = store._last()
    store.load(nodes, pairs.withColumn("video_count", F.lit(2).cast("bigint")))
    late = GraphStore(spark, store.root)
    seen = iter([begun])
    current = late._last
    monkeypatch.setattr(late, "_last", lambda: next(seen, None) or current())
    with pytest.raises(CommitConflict):
        late.load(nodes, pairs.withColumn("video_count", F.lit(7).cast("bigint")))
    assert rows(store.edges()) == [("a", "b", 2, 1)]


def test_a_merge_reads_stored_buckets_in_place(spark, store):
    nodes = spark.createDataFrame([(f"n{i}", "ORG") for i in range(50)], NODE)
    pairs = spark.createDataFrame([(f"n{i}", f"n{i + 1}", 1, 1) for i in range(40)], EDGE)
    store.load(nodes, pairs)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for merged, kind in (
            (merge_nodes(store.nodes(), nodes), "nodes"),
            (merge_edges(store.edges(), pairs), "edges"),
        ):
            plan = merged._jdf.queryExecution().executedPlan().toString()
            # One exchange, of the fresh rows; the stored scan keeps its buckets.
            assert plan.count("Exchange hashpartitioning") == 1, plan
            assert "Bucketed: true" in plan and f"loquent_{kind}_" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Merged rows stay in their buckets: a file for each, as before.
    store.load(nodes, pairs)
    for kind in ("nodes", "edges"):
        folder = Path(store.root) / store._last()["version"] / kind
        assert 1 <= len(list(folder.glob("*.parquet"))) <= 4
