"""The entity graph, stored: node and edge tables that a load is merged into.

Both tables are bucketed by their keys, so a merge shuffles the new rows to the
buckets of the stored ones, which are read in place. A load writes new tables and
then adds an entry that names them; readers take the last entry, so they see a
load whole or not at all. Loading the same rows again gives the same tables.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loquent import model
from loquent.operators.graph import ends_known, graph_nodes, graph_triples
from loquent.sources.warehouse import CommitConflict

#: Buckets of a new graph; later loads keep the number that it began with.
BUCKETS = 64
_ENTRY = "version STRING, buckets INT, seq LONG"
_TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    "nodes": (model.GRAPH_NODES, ["entity_text"]),
    "edges": (model.GRAPH_EDGES, ["entity_a", "entity_b"]),
}


def merge_nodes(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored nodes with the types of fresh ones, and the new nodes."""
    new = fresh.select("entity_text", F.col("entity_type").alias("_type"))
    return stored.join(new, "entity_text", "full_outer").select(
        "entity_text", F.coalesce("_type", "entity_type").alias("entity_type")
    )


def merge_edges(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored edges with the counts of fresh ones, and the new edges."""
    ends, counts = ["entity_a", "entity_b"], ["video_count", "segment_count"]
    new = fresh.select(*ends, F.struct(*counts).alias("_new"))

    def count(name: str):
        seen = F.col("_new").isNotNull()
        return F.when(seen, F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name)

    return stored.join(new, ends, "full_outer").select(*ends, *[count(c) for c in counts])


class GraphStore:
    """The graph below ``root``.

    The tables are also declared in the session's catalog, as external ones, since
    Spark knows buckets of declared tables only.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def _last(self) -> dict | None:
        try:
            entries = self.spark.read.schema(_ENTRY).json(f"{self.root}/loads")
            last = entries.orderBy(F.desc("seq")).first()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None
        return None if last is None else last.asDict()

    def _declared(self, kind: str, version: str, buckets: int) -> str:
        """Name of a stored table in the catalog."""
        schema, keys = _TABLES[kind]
        name = f"loquent_{kind}_{version}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        listed = ", ".join(keys)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            "OPTIONS (compression 'zstd') "
            f"CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS "
            f"LOCATION '{self.root}/{version}/{kind}'"
        )
        return name

    def _read(self, kind: str) -> DataFrame:
        last = self._last()
        if last is None:
            return self.spark.createDataFrame([], _TABLES[kind][0])
        return self.spark.table(self._declared(kind, last["version"], last["buckets"]))

    def nodes(self) -> DataFrame:
        """(entity_text, entity_type) as of the last load."""
        return self._read("nodes")

    def edges(self) -> DataFrame:
        """(entity_a, entity_b, video_count, segment_count) as of the last load."""
        return self._read("edges")

    def triples(self) -> DataFrame:
        """Every edge with the types of both ends."""
        return graph_triples(self.nodes(), self.edges())

    def load(self, entities: DataFrame, pairs: DataFrame, *, replace: bool = False) -> None:
        """Merge entities as nodes and pairs as edges between known nodes.

        A node seen again gets its new type, an edge seen again its new counts;
        pairs with an end that is no node are left out, repeated pairs must not
        occur. Older edges stay, unless ``replace``. Null texts are no nodes. Of
        two loads that began at one entry the second fails with
        ``CommitConflict`` and changes nothing.
        """
        last = self._last()
        version = uuid.uuid4().hex
        buckets = self.buckets if last is None else last["buckets"]
        fresh = graph_nodes(entities.filter(F.col("entity_text").isNotNull()))
        if last is not None:
            fresh = merge_nodes(self.nodes(), fresh)
        self._write("nodes", fresh, version, buckets, merged=last is not None)
        nodes = self.spark.table(self._declared("nodes", version, buckets))
        found = ends_known(pairs.select(model.GRAPH_EDGES.fieldNames()), nodes)
        merged = last is not None and not replace
        if merged:
            found = merge_edges(self.edges(), found)
        self._write("edges", found, version, buckets, merged=merged)
        seq = 0 if last is None else last["seq"] + 1
        entry = self.spark.createDataFrame([(version, buckets)], "version STRING, buckets INT")
        try:
            entry.coalesce(1).write.json(f"{self.root}/loads/seq={seq}")
        except AnalysisException as error:
            raise CommitConflict(f"load {seq} of {self.root} exists") from error

    def _write(
        self, kind: str, rows: DataFrame, version: str, buckets: int, *, merged: bool
    ) -> None:
        """Rows by bucket, a file each. Merged rows are where the stored ones were,
        so they are not shuffled once more."""
        schema, keys = _TABLES[kind]
        rows = rows.select(*schema.fieldNames())
        if not merged:
            rows = rows.repartition(buckets, *keys)
        rows.write.insertInto(self._declared(kind, version, buckets))
