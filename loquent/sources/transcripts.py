"""Transcript and URL-list sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loquent.functions.text import strip, word_count
from loquent.functions.urls import canonical_url
from loquent.plans.ordered import CHUNK_SIZE, running_sum

SEGMENT_JSON = "segment_id BIGINT, text STRING"
SECONDS_PER_WORD = 0.4


def segments_from_text(
    transcripts: DataFrame,
    *,
    video: str = "video_id",
    text: str = "text",
    separator: str = "\n",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per line of a whole transcript, with 0-based local ids."""
    return transcripts.select(
        F.col(video).cast("string").alias("video_id"),
        *keep,
        F.posexplode(F.split(text, separator)).alias("segment_id", "text"),
    ).select(
        "video_id",
        *keep,
        F.col("segment_id").cast("bigint").alias("segment_id"),
        strip(F.col("text")).alias("text"),
    )


def with_times(
    segments: DataFrame,
    *,
    seconds_per_word: float = SECONDS_PER_WORD,
    size: int = CHUNK_SIZE,
    chunks: DataFrame | None = None,
    keep: str | None = None,
) -> DataFrame:
    """Add start_time and end_time from the words spoken so far.

    For transcripts which come without timings. ``chunks`` is that of ``running_sum``;
    with it words are counted once. ``keep`` names a column that is to hold them.
    """
    counted = segments.withColumn("_words", word_count(F.col("text")))
    summed = running_sum(
        counted, ["video_id"], "segment_id", F.col("_words"), "_so_far", size=size, chunks=chunks
    )
    rate = F.lit(seconds_per_word)
    timed = summed.withColumn("start_time", (F.col("_so_far") - F.col("_words")) * rate)
    timed = timed.withColumn("end_time", F.col("_so_far") * rate).drop("_so_far")
    return timed.drop("_words") if keep is None else timed.withColumnRenamed("_words", keep)


def read_segments_json(
    spark: SparkSession,
    path: str,
    *,
    multi_line: bool = True,
    video_from_file: bool = False,
) -> DataFrame:
    """Segments from JSON arrays of ``{segment_id, text}`` objects.

    By default each file holds one array. With ``multi_line=False`` each line
    holds one, which lets Spark split large files. With ``video_from_file`` the
    name of a file, without its ending, becomes the ``video_id`` of its rows.
    """
    reader = spark.read.schema(SEGMENT_JSON).option("multiLine", multi_line)
    segments = reader.json(path)
    if not video_from_file:
        return segments
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return segments.select(name.alias("video_id"), "segment_id", "text")


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed non-blank lines as (position, url), in file order.

    ``position`` grows along each file; it has gaps, which no operator minds.
    """
    lines = spark.read.text(path)
    return (
        lines.select(
            F.monotonically_increasing_id().alias("position"),
            strip(F.col("value")).alias("url"),
        )
        .filter(F.length("url") > 0)
    )


def expand_list(lists: DataFrame, *, list_id: str, entries: str) -> DataFrame:
    """Flatten lists of entries into (list_id, entry_index, url).

    ``entries`` is ARRAY<STRUCT<id, ...>>. Entries without an id are left out;
    a null list has none.
    """
    return (
        lists.select(
            F.col(list_id).alias("list_id"),
            F.posexplode(entries).alias("entry_index", "entry"),
        )
        .filter(F.coalesce(F.col("entry.id"), F.lit("")) != "")
        .select(
            "list_id",
            F.col("entry_index").cast("bigint").alias("entry_index"),
            canonical_url(F.col("entry.id")).alias("url"),
        )
    )
