"""Tables laid out by segment, so that joins by segment leave the text in place.

Enrichment brings labels, sizes and summaries to the segments. All of them are
narrow, the text is not. A table bucketed by (video, segment) is shuffled once, when
it is written; every later join by segment moves the other side only, or nothing if
that is laid out alike. The key names one row, so a video that holds most of a
corpus is spread over all buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from loquent.session import scratch_path

SEGMENT = ["video_id", "segment_id"]
#: Spark refuses more buckets than this (spark.sql.sources.bucketing.maxBuckets).
MOST_BUCKETS = 100_000


def write_by_segment(df: DataFrame, label: str, buckets: int | None = None) -> DataFrame:
    """``df`` written to the shared folder by segment, and read back.

    ``buckets`` is the session's number of shuffle partitions unless given; frames
    that are to be joined in place need the same one. The rows keep their columns and
    types; null keys stay, and repeated rows are repeated.
    """
    buckets = _buckets(df) if buckets is None else buckets
    return _bucketed(df.repartition(buckets, *SEGMENT), SEGMENT, label, buckets)


def write_by_video(df: DataFrame, label: str) -> DataFrame:
    """``df``, of one row per video, written to the shared folder by video and read back.

    What is made of the rows stays in place in groups, windows and joins by video.
    """
    return _bucketed(df, ["video_id"], label, _buckets(df))


def _buckets(df: DataFrame) -> int:
    return min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)


def _bucketed(df: DataFrame, keys: list[str], label: str, buckets: int) -> DataFrame:
    spark = df.sparkSession
    name = f"loquent_{label}_{uuid.uuid4().hex}"
    (
        df.write.format("parquet")
        .option("compression", "zstd")
        .option("path", scratch_path(spark, label))
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )
    rows = spark.table(name)
    rows.schema  # resolved now: the plan has the files and their buckets
    # The catalog was only needed to tell the buckets. The files stay.
    spark.sql(f"DROP TABLE {name}")
    return rows
