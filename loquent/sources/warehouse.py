"""The stored tables: plain zstd parquet folders and a log of commits.

Every batch writes its rows into folders of its own, ``<table>/batch=<name>``, and
then adds one entry to the log. Readers take the folders that the log names, so
rows of a batch that broke are never seen, a table is replaced by pointing at
another folder, and nothing is deleted before its successor is there. Deleting
writes the keys of the videos; readers leave out their older rows, and ``compact``
writes a table anew without them. The log also carries the next free ids, so a
batch reads nothing that earlier ones stored to number its rows.

Inside a batch, video-keyed tables are partitioned by a hash bucket of the video
id, so reading one video touches its bucket only. Writes gather buckets with a
rebalance, which splits a large bucket (one long video, say) over several tasks
and files; files are sorted by video and segment, so min/max statistics skip the
row groups of other videos.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loquent import model
from loquent.plans.skew import restrict_to_videos, salted_join

#: Part of the stored layout; must not change for an existing warehouse.
BUCKETS = 32
BUCKET = "video_bucket"
BATCH = "batch"

_SORT_COLUMNS = ("video_id", "segment_id", "entity_id")
_COMMITS, _DELETED = "commits", "deleted"
_LOG = (
    "batch STRING, replaces BOOLEAN, tables ARRAY<STRING>, deleted ARRAY<STRING>, "
    "next_segment_id LONG, next_entity_id LONG, committed_at TIMESTAMP, seq LONG"
)
_KEYS = "table STRING, video_id STRING, batch STRING"


class CommitConflict(RuntimeError):
    """Another batch was committed since this one began; run it again."""


@dataclass(frozen=True)
class Commit:
    """An entry of the log: the tables a batch wrote, and those it deleted from."""

    seq: int
    batch: str
    replaces: bool
    tables: tuple[str, ...]
    deleted: tuple[str, ...]
    next_segment_id: int
    next_entity_id: int


def _bucket(video_id: Column) -> Column:
    return F.pmod(F.xxhash64(video_id), F.lit(BUCKETS)).cast("int")


def _is_keyed(schema: T.StructType) -> bool:
    return "video_id" in schema.fieldNames()


def live(name: str, log: Sequence[Commit]) -> list[Commit]:
    """The entries whose rows make up a table."""
    wrote = [c for c in log if name in c.tables]
    whole = [i for i, c in enumerate(wrote) if c.replaces]
    return wrote[whole[-1] :] if whole else wrote


class Batch:
    """Rows that become visible together.

    Nothing of it is seen before ``commit``; without one, its folders are never
    read. Ids from ``next_segment_id`` and ``next_entity_id`` on are free.
    """

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.log = warehouse.commits()
        last = self.log[-1] if self.log else Commit(-1, "", False, (), (), 0, 0)
        self.seq = last.seq + 1
        # Names sort as commits do, also beside a broken batch of one place.
        self.name = f"{self.seq:012d}-{uuid.uuid4().hex[:8]}"
        self.next_segment_id = last.next_segment_id
        self.next_entity_id = last.next_entity_id
        self._tables: list[str] = []
        self._deleted: list[str] = []

    def append(self, name: str, df: DataFrame) -> None:
        """Write rows of a table; an empty frame is fine."""
        house = self.warehouse
        rows = house._laid_out(house._conform(name, df))
        house._writer(rows).save(house.batch_path(name, self.name))
        if name not in self._tables:
            self._tables.append(name)

    def delete(self, ids: DataFrame, names: Sequence[str]) -> None:
        """Leave out all rows of these videos that earlier batches stored."""
        table = F.explode(F.array(*[F.lit(n) for n in names])).alias("table")
        keys = ids.select("video_id").distinct().select(table, "video_id")
        path = self.warehouse.batch_path(_DELETED, self.name)
        keys.write.mode("append").option("compression", "zstd").parquet(path)
        self._deleted += [n for n in names if n not in self._deleted]

    def after_loose_rows(self) -> bool:
        """Whether some rows are stored apart from the rows of their videos."""
        return any(
            "videos" not in c.tables and not c.replaces
            for name in ("segments", "entities")
            for c in live(name, self.log)
        )

    def _after(self, name: str, column: str, free: int) -> int:
        """The next free id; only this batch's own rows are read."""
        if name not in self._tables:
            return free
        spark = self.warehouse.spark
        path = self.warehouse.batch_path(name, self.name)
        top = spark.read.schema(f"{column} LONG").parquet(path).agg(F.max(column)).first()[0]
        return free if top is None else max(free, top + 1)

    def commit(self, *, replaces: bool = False) -> None:
        """Make the batch visible, with ``replaces`` instead of all older rows.

        The entry is one file at a path that must not exist yet: of two batches
        that began at the same entry the second fails with ``CommitConflict``.
        """
        house = self.warehouse
        entry = (
            self.name,
            replaces,
            self._tables,
            self._deleted,
            self._after("segments", "segment_id", self.next_segment_id),
            self._after("entities", "entity_id", self.next_entity_id),
            dt.datetime.now(dt.timezone.utc),
        )
        schema = T.StructType.fromDDL(_LOG).fields[:-1]
        frame = house.spark.createDataFrame([entry], T.StructType(schema)).coalesce(1)
        try:
            frame.write.json(f"{house.path(_COMMITS)}/seq={self.seq}")
        except AnalysisException as error:
            raise CommitConflict(f"entry {self.seq} of {house.root} exists") from error


class Warehouse:
    """The tables below ``root``. The caller owns the session."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def create_tables(self) -> None:
        """Begin the log if there is none yet; tables need no more."""
        if not self.commits():
            try:
                self.begin().commit()
            except CommitConflict:
                pass  # another session was quicker

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def batch_path(self, name: str, batch: str) -> str:
        return f"{self.path(name)}/{BATCH}={batch}"

    def commits(self) -> list[Commit]:
        """The log, oldest entry first: one small row for every batch."""
        try:
            rows = self.spark.read.schema(_LOG).json(self.path(_COMMITS)).collect()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return []
        found = [
            Commit(
                r["seq"], r["batch"], r["replaces"], tuple(r["tables"] or ()),
                tuple(r["deleted"] or ()), r["next_segment_id"], r["next_entity_id"],
            )
            for r in rows
        ]
        return sorted(found, key=lambda c: c.seq)

    def begin(self) -> Batch:
        return Batch(self)

    @staticmethod
    def _stored_schema(schema: T.StructType) -> T.StructType:
        own = [T.StructField(BATCH, T.StringType())]
        if _is_keyed(schema):
            own.append(T.StructField(BUCKET, T.IntegerType()))
        return T.StructType([*schema.fields, *own])

    @staticmethod
    def _writer(df: DataFrame):
        writer = df.write.format("parquet").option("compression", "zstd").mode("append")
        return writer.partitionBy(BUCKET) if BUCKET in df.columns else writer

    def _conform(self, name: str, df: DataFrame) -> DataFrame:
        """Columns by name and in table order, cast to the table's types."""
        schema = model.TABLES[name]
        missing = set(schema.fieldNames()) - set(df.columns)
        required = {f.name for f in schema.fields if not f.nullable}
        if missing & required:
            raise ValueError(f"{name}: missing columns {sorted(missing & required)}")
        columns = []
        for field in schema.fields:
            value = F.lit(None) if field.name in missing else F.col(field.name)
            if not field.nullable and df.schema[field.name].nullable:
                problem = F.lit(f"{name}.{field.name} must not be null")
                value = F.coalesce(value, F.raise_error(problem))
            columns.append(value.cast(field.dataType).alias(field.name))
        return df.select(*columns)

    def _laid_out(self, df: DataFrame) -> DataFrame:
        """Rows of one bucket together and sorted; large buckets are split."""
        if "video_id" not in df.columns:
            return df
        order = [c for c in _SORT_COLUMNS if c in df.columns]
        bucketed = df.withColumn(BUCKET, _bucket(F.col("video_id")))
        return bucketed.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(
            BUCKET, *order
        )

    def append(self, name: str, df: DataFrame) -> None:
        """Append rows as a batch of their own; an empty frame is fine."""
        batch = self.begin()
        batch.append(name, df)
        batch.commit()

    def append_segments(self, segments: DataFrame) -> None:
        self.append("segments", segments)

    def append_entities(self, entities: DataFrame) -> None:
        self.append("entities", entities)

    def append_videos(self, videos: DataFrame) -> None:
        """Append videos. A video row marks it as complete."""
        self.append("videos", with_time(videos, "processed_at"))

    def replace_co_occurrences(self, pairs: DataFrame) -> None:
        """Replace the whole table; an empty frame empties it.

        ``pairs`` may read the stored table: readers see it until the commit.
        """
        batch = self.begin()
        batch.append("co_occurrences", pairs)
        batch.commit(replaces=True)

    def read(self, name: str, video_id: str | None = None) -> DataFrame:
        """A whole table as it is committed now, or the rows of one video."""
        schema = model.TABLES[name]
        log = self.commits()
        parts = live(name, log)
        if not parts:
            return self.spark.createDataFrame([], schema)
        rows = (
            self.spark.read.schema(self._stored_schema(schema))
            .option("basePath", self.path(name))
            .parquet(*[self.batch_path(name, c.batch) for c in parts])
        )
        if video_id is not None:
            here = F.col(BUCKET) == _bucket(F.lit(video_id))
            rows = rows.filter(here & (F.col("video_id") == video_id))
        later = [c for c in log if name in c.deleted and c.seq > parts[0].seq]
        if later:
            rows = self._without(rows, name, later)
        return rows.select(*schema.fieldNames())

    def _without(self, rows: DataFrame, name: str, later: Sequence[Commit]) -> DataFrame:
        """Rows but for those stored before their video was last deleted."""
        keys = (
            self.spark.read.schema(_KEYS)
            .option("basePath", self.path(_DELETED))
            .parquet(*[self.batch_path(_DELETED, c.batch) for c in later])
        )
        until = keys.filter(F.col("table") == name).groupBy("video_id")
        until = until.agg(F.max(BATCH).alias("_until"))
        # A video with very many rows is spread over tasks by segment.
        spread = "segment_id" if "segment_id" in rows.columns else "video_id"
        marked = salted_join(rows, until, ["video_id"], [spread], "left")
        return marked.filter(F.col("_until").isNull() | (F.col(BATCH) >= F.col("_until")))

    def compact(self, name: str) -> None:
        """Write a table anew, as one batch without the deleted rows.

        The folders it had before may be removed once no running job reads them.
        """
        batch = self.begin()
        batch.append(name, self.read(name))
        batch.commit(replaces=True)

    def read_finished(self, name: str) -> DataFrame:
        """Rows of videos whose video row is there, that is, whose run has ended."""
        return restrict_to_videos(self.read(name), self.read_videos())

    def read_videos(self) -> DataFrame:
        return self.read("videos")

    def read_segments(self, video_id: str | None = None) -> DataFrame:
        return self.read("segments", video_id)

    def read_entities(self, video_id: str | None = None) -> DataFrame:
        return self.read("entities", video_id)

    def read_co_occurrences(self) -> DataFrame:
        return self.read("co_occurrences")

    def read_failures(self) -> DataFrame:
        """(video_id, error, failed_at): one row for every failed attempt."""
        return self.read("failures")

    def register_views(self, prefix: str = "") -> None:
        """Make the tables visible to SQL as temporary views."""
        for name in model.TABLES:
            self.read(name).createOrReplaceTempView(prefix + name)

    def video_exists(self, video_id: str) -> bool:
        return not self.read("videos", video_id).limit(1).isEmpty()

    def skip_processed(self, ids: DataFrame) -> DataFrame:
        """Rows of ``ids`` whose video is not stored yet."""
        return ids.join(self.read_videos().select("video_id"), "video_id", "left_anti")

    def delete_videos(
        self, ids: DataFrame, names: tuple[str, ...] = ("entities", "segments", "videos")
    ) -> None:
        """Delete videos from the video-keyed tables, all at once.

        Only the ids are written. A job killed at any point leaves either all
        rows or none of them to readers; ``compact`` frees the space.
        """
        batch = self.begin()
        batch.delete(ids, names)
        batch.commit()


def with_time(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with the present time, unless they have one."""
    return rows if column in rows.columns else rows.withColumn(column, F.current_timestamp())
