"""Which entities occur in the same segment, over the whole corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.functions.reporting import pair_line

#: Entities in a block of a segment; a task pairs two blocks.
BLOCK = 512

_SEGMENT = ["video_id", "segment_id"]


def entity_mentions(entities: DataFrame) -> DataFrame:
    """Distinct (segment, video, text); the type is dropped on purpose, so a
    text under two types cannot pair with itself."""
    return entities.select("segment_id", "video_id", "entity_text").distinct()


def entity_pairs(entities: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """(entity_a, entity_b, video_id, segment_id) with entity_a < entity_b.

    Each segment's distinct texts are gathered, duplicates merged before they
    are sent, and cut into blocks. Every two blocks of a segment, and every block
    with itself, go to a task of their own, which holds no more than these two. So
    the pairs of a long segment are made by many tasks and never held at once, and
    no block carries more than another one with it. Only the list of a segment's
    distinct texts is in one row, which is small where its pairs can be stored.
    """
    texts = entities.groupBy(*_SEGMENT).agg(
        F.sort_array(F.collect_set("entity_text")).alias("texts")
    )
    last = ((F.size("texts") - 1) / block).cast("int")

    def cut(number: str) -> Column:
        return F.slice("texts", F.col(number) * block + 1, F.lit(block))

    # Numbers first, slices after: a row holds its two blocks, not all of them.
    blocks = (
        texts.filter(F.size("texts") > 1)
        .withColumn("_last", last)
        .withColumn("_first", F.explode(F.sequence(F.lit(0), F.col("_last"))))
        .withColumn("_second", F.explode(F.sequence(F.col("_first"), F.col("_last"))))
        .select(
            *_SEGMENT,
            "_first",
            "_second",
            cut("_first").alias("firsts"),
            F.when(F.col("_first") < F.col("_second"), cut("_second")).alias("seconds"),
        )
        .repartition(*_SEGMENT, "_first", "_second")
    )
    later = F.slice("firsts", F.col("_place") + 2, F.lit(block))
    return (
        blocks.select(
            *_SEGMENT, "firsts", "seconds", F.posexplode("firsts").alias("_place", "entity_a")
        )
        .select(
            *_SEGMENT, "entity_a", F.explode(F.coalesce("seconds", later)).alias("entity_b")
        )
        .select("entity_a", "entity_b", *_SEGMENT)
    )


def co_occurrences(entities: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """(entity_a, entity_b, video_count, segment_count), unfiltered.

    Segments are first counted per pair and video, both before and after the
    shuffle, so a pair that is everywhere is spread over its videos.
    """
    per_video = (
        entity_pairs(entities, block=block)
        .groupBy("entity_a", "entity_b", "video_id")
        .agg(F.count("*").alias("segments"))
    )
    return per_video.groupBy("entity_a", "entity_b").agg(
        F.count("*").alias("video_count"), F.sum("segments").alias("segment_count")
    )


def with_support(pairs: DataFrame, min_videos: int = 2) -> DataFrame:
    """Pairs found in at least ``min_videos`` videos."""
    return pairs.filter(F.col("video_count") >= min_videos)


def top_pairs(pairs: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` pairs with most segments; equal counts go by name."""
    return pairs.orderBy(F.desc("segment_count"), "entity_a", "entity_b").limit(n)


def pair_lines(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        pair_line(
            F.col("entity_a"),
            F.col("entity_b"),
            F.col("video_count"),
            F.col("segment_count"),
        ).alias("line")
    )
