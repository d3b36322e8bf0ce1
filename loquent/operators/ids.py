"""Global ids and positions without a single-task ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loquent.plans.ordered import CHUNK, CHUNK_SIZE, attach, running_sum, with_chunk
from loquent.session import write_out

# 32 hash bits in 4,096 chunks: the ordinal for videos that come without one.
_HASH_CHUNK = 1 << 20


def max_id(df: DataFrame, column: str) -> DataFrame:
    """One row ``max_id``: the largest id, or -1 for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(-1)).cast("bigint").alias("max_id"))


def next_id(df: DataFrame, column: str) -> int:
    return max_id(df, column).first()["max_id"] + 1


def chunk_sizes(
    segments: DataFrame, *, position: str | None = None, size: int = CHUNK_SIZE
) -> DataFrame:
    """(video_id, chunk, size, ordinal): a row per chunk of a video, written out."""
    if position is None:
        ordinal = F.conv(F.substring(F.md5("video_id"), 1, 8), 16, 10).cast("bigint")
    else:
        ordinal = F.col(position)
    sized = with_chunk(segments, "segment_id", size).groupBy("video_id", CHUNK).agg(
        (F.max("segment_id") + 1).alias("_size"), F.min(ordinal).alias("_ordinal")
    )
    return write_out(sized, "chunk_sizes")


def global_segment_ids(
    segments: DataFrame,
    *,
    position: str | None = None,
    start: int = 0,
    size: int = CHUNK_SIZE,
    parts: DataFrame | None = None,
    by_video: bool = False,
) -> DataFrame:
    """Replace local segment ids, 0 or more, by ids that are unique over all videos.

    A video takes as many ids as its largest local id says, so gaps stay gaps and
    no two segments meet; ids are dense where the local ones are.

    Videos are numbered in the order of the BIGINT column ``position`` (equal
    for all rows of a video), or of a hash of the video id without one. A
    video's segments stay consecutive.

    The segments are read once for a row per chunk of a video, which is written out;
    offsets come from these rows, and a second reading brings them to the chunks.
    These rows may be given in ``parts`` (see ``chunk_sizes``). With ``by_video`` the
    offsets are brought to videos: segments that lie by video stay in place.
    """
    chunked = with_chunk(segments, "segment_id", size)
    if parts is None:
        parts = chunk_sizes(segments, position=position, size=size)
    sizes = parts.groupBy("video_id").agg(
        F.max("_size").alias("_size"), F.min("_ordinal").alias("_ordinal")
    )
    ends = running_sum(
        write_out(sizes, "video_sizes"),
        [],
        "_ordinal",
        F.col("_size"),
        "_end",
        ties=["video_id"],
        size=_HASH_CHUNK if position is None else size,
    )
    offsets = write_out(
        ends.select("video_id", (F.col("_end") - F.col("_size") + start).alias("_offset")),
        "offsets",
    )
    if by_video:
        placed = chunked.join(offsets, "video_id", "left")
    else:
        placed = chunked.join(
            parts.select("video_id", CHUNK).join(offsets, "video_id"), ["video_id", CHUNK], "left"
        )
    numbered = placed.withColumn("segment_id", F.col("segment_id") + F.col("_offset"))
    return numbered.select(*segments.columns)


def global_entity_ids(
    entities: DataFrame, *, start: int = 0, size: int = CHUNK_SIZE
) -> DataFrame:
    """Add dense entity ids in segment order, then order of mention.

    ``segment_id`` must be global. ``position`` is the place in the segment.
    The entities are written out: totals and ranks read them three times.
    """
    numbered = running_sum(
        write_out(entities, "entities"),
        [],
        "segment_id",
        F.lit(1).cast("bigint"),
        "_rank",
        ties=["position", "entity_text", "entity_type"],
        size=size,
    )
    return numbered.withColumn("entity_id", F.col("_rank") - 1 + start).drop("_rank")


def list_position(
    entries: DataFrame, *, size: int = CHUNK_SIZE
) -> DataFrame:
    """Add 1-based ``position`` in its list and the list's ``total``."""
    ranked = running_sum(
        entries, ["list_id"], "entry_index", F.lit(1).cast("bigint"), "position",
        size=size,
    )
    totals = entries.groupBy("list_id").agg(F.count("*").alias("total"))
    return attach(ranked, totals, ["list_id"], "entry_index", size=size)
