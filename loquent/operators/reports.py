"""Report queries over the stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loquent.functions.reporting import averages_line, entity_line
from loquent.functions.text import format_time, prefix, title_or_default
from loquent.plans.skew import restrict_to_videos

# How much the reports show.
MAX_TOPICS_SHOWN = 30
TIMELINE_PREFIX = 160
DIVERGENT_PREFIX = 70
TOP_ENTITIES = 10


def in_videos(df: DataFrame, ids: Sequence[str] | DataFrame | None) -> DataFrame:
    """Rows of the given videos: an id list, a ``video_id`` frame, or all."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return restrict_to_videos(df, ids)
    return df.filter(F.col("video_id").isin(list(ids)))


def history(videos: DataFrame) -> DataFrame:
    """Videos, newest first, with a stand-in for missing titles."""
    return videos.select(
        title_or_default(F.col("title")).alias("title"), "processed_at", "video_id"
    ).orderBy(F.desc("processed_at"), "video_id")


def _averages() -> list:
    return [
        F.avg("compression_ratio").alias("avg_compression_ratio"),
        F.avg("semantic_similarity").alias("avg_semantic_similarity"),
    ]


def video_stats(segments: DataFrame) -> DataFrame:
    """Segments, topics and average metrics of every video."""
    stats = segments.groupBy("video_id").agg(
        F.count("*").alias("segments"),
        F.countDistinct("topic_label").alias("topics"),
        *_averages(),
    )
    return stats.withColumn(
        "averages",
        averages_line(
            F.col("avg_compression_ratio"), F.col("avg_semantic_similarity")
        ),
    )


def corpus_stats(
    segments: DataFrame,
    ids: Sequence[str] | DataFrame | None = None,
    *,
    label_only: bool = False,
) -> DataFrame:
    """The same numbers over the chosen videos together, as one row.

    Topic labels restart in every video, so topics are counted per video;
    ``label_only`` counts distinct labels instead.
    """
    chosen = in_videos(segments, ids)
    labelled = F.col("topic_label").isNotNull()
    video = F.lit("") if label_only else F.col("video_id")
    topic = F.when(labelled, F.struct(video, F.col("topic_label")))
    return chosen.agg(
        F.count("*").alias("segments"),
        F.countDistinct(topic).alias("topics"),
        *_averages(),
    )


def topic_timeline(segments: DataFrame) -> DataFrame:
    """Start, end, size and summary of every topic."""
    return segments.groupBy("video_id", "topic_label").agg(
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.count("*").alias("segments"),
        F.min_by("abs_summary", "segment_id").alias("summary"),
        F.min("segment_id").alias("first_segment"),
    )


def topic_timeline_capped(
    segments: DataFrame, limit: int = MAX_TOPICS_SHOWN
) -> DataFrame:
    """The first ``limit`` topics of each video, and how many are left out."""
    topics = topic_timeline(segments)
    order = Window.partitionBy("video_id").orderBy("start_time", "first_segment")
    shown = topics.withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= limit
    )
    totals = segments.groupBy("video_id").agg(
        # A missing label is a topic of its own here, as in the timeline.
        F.countDistinct(F.struct("topic_label")).alias("topics")
    )
    return shown.join(totals, "video_id").select(
        "video_id",
        F.col("place").cast("bigint").alias("place"),
        format_time(F.col("start_time")).alias("start"),
        format_time(F.col("end_time")).alias("end"),
        "segments",
        prefix(F.col("summary"), TIMELINE_PREFIX).alias("summary"),
        F.greatest(F.col("topics") - limit, F.lit(0)).cast("bigint").alias("hidden"),
    )


def entity_frequency(entities: DataFrame) -> DataFrame:
    """Mentions per (video, text, type)."""
    return entities.groupBy("video_id", "entity_text", "entity_type").agg(
        F.count("*").alias("mentions")
    )


def top_entities(entities: DataFrame, n: int = TOP_ENTITIES) -> DataFrame:
    """The ``n`` most frequent entities of each video; ties go by name."""
    order = Window.partitionBy("video_id").orderBy(
        F.desc("mentions"), "entity_text", "entity_type"
    )
    ranked = entity_frequency(entities).withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") <= n).select(
        "video_id",
        F.col("place").cast("bigint").alias("place"),
        "entity_text",
        "entity_type",
        "mentions",
        entity_line(
            F.col("entity_text"), F.col("entity_type"), F.col("mentions")
        ).alias("line"),
    )


def unique_entities(
    entities: DataFrame,
    ids: Sequence[str] | DataFrame | None = None,
    *,
    approximate: bool = False,
) -> DataFrame:
    """Number of distinct entity texts in the chosen videos."""
    chosen = in_videos(entities, ids)
    count = F.approx_count_distinct if approximate else F.countDistinct
    return chosen.agg(count("entity_text").alias("unique_entities"))


def most_divergent(
    segments: DataFrame, ids: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """The one segment whose two summaries agree least."""
    return (
        in_videos(segments, ids)
        .filter(F.col("semantic_similarity").isNotNull())
        .select(
            "video_id",
            "segment_id",
            "semantic_similarity",
            prefix(F.col("ext_summary"), DIVERGENT_PREFIX).alias("extractive"),
            prefix(F.col("abs_summary"), DIVERGENT_PREFIX).alias("abstractive"),
        )
        .orderBy("semantic_similarity", "video_id", "segment_id")
        .limit(1)
    )


def most_divergent_per_video(segments: DataFrame) -> DataFrame:
    """The least agreeing segment of every video that has a similarity."""
    row = F.struct(
        "segment_id",
        "semantic_similarity",
        prefix(F.col("ext_summary"), DIVERGENT_PREFIX).alias("extractive"),
        prefix(F.col("abs_summary"), DIVERGENT_PREFIX).alias("abstractive"),
    )
    return (
        segments.filter(F.col("semantic_similarity").isNotNull())
        .groupBy("video_id")
        .agg(F.min_by(row, F.struct("semantic_similarity", "segment_id")).alias("_row"))
        .select("video_id", "_row.*")
    )


def batch_summary(outcomes: DataFrame) -> DataFrame:
    """Total, succeeded and failed URLs of a batch."""
    return outcomes.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


def failed_outcomes(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("error").isNotNull())
