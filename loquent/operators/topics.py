"""Topic segmentation with a threshold fitted to each video.

A new topic starts where the distance to the segment before is larger than
mean + k * stdev of the video's own distances.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loquent.functions.text import tokens
from loquent.functions.vectors import bag, cosine_from_parts, cosines, counted, dot, norm
from loquent.plans.located import write_by_segment
from loquent.plans.ordered import (
    CHUNK,
    CHUNK_SIZE,
    attach,
    running_sum,
    with_handed,
    with_previous,
)
from loquent.plans.skew import listed_only
from loquent.session import write_out

# Distances within this of the threshold count as equal to it: sums taken in
# another order may differ in their last bits.
TOLERANCE = 1e-9


def term_counts(segments: DataFrame) -> DataFrame:
    """Token counts per segment: (video_id, segment_id, term, tf)."""
    counted = segments.select(
        "video_id", "segment_id", bag(tokens(F.col("text"))).alias("_bag")
    )
    entries = F.arrays_zip(
        F.col("_bag.terms").alias("term"), F.col("_bag.counts").alias("tf")
    )
    return counted.select("video_id", "segment_id", F.inline(entries)).withColumn(
        "tf", F.col("tf").cast("bigint")
    )


def term_norms(segments: DataFrame) -> DataFrame:
    """Length of each segment's term vector; 0 for a segment without tokens."""
    squares = bag(tokens(F.col("text")))["squares"]
    return segments.select(
        "video_id", "segment_id", F.coalesce(F.sqrt(squares), F.lit(0.0)).alias("norm")
    )


_DISTANCES = "video_id STRING, segment_id BIGINT, distance DOUBLE"


def _lexical(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distances of rows to the row before, where both have one group.

    Batches of (video_id, chunk, segment_id, handed, words) in, rows that were not
    handed on out. The last row of a batch is kept for the next one.
    """
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if kept is None else pa.concat_batches([kept, batch])
        codes = [c.dictionary_encode().indices.fill_null(-1).to_numpy() for c in rows.columns[:2]]
        first = np.ones(rows.num_rows, bool)
        first[1:] = np.any([c[1:] != c[:-1] for c in codes], axis=0)
        keys, n, row, many = counted(rows.column(4))
        squares = np.bincount(row, n * n, minlength=rows.num_rows)
        place = np.searchsorted(keys, keys - many)
        both = keys[place] == keys - many
        products = np.bincount(row[both], n[both] * n[place[both]], minlength=rows.num_rows)
        distance = 1.0 - cosines(squares, np.roll(squares, 1), products)
        wanted = ~rows.column(3).to_numpy(zero_copy_only=False)
        wanted[: rows.num_rows - batch.num_rows] = False
        found = [rows.column(0), rows.column(2), pa.array(distance, mask=first)]
        named = pa.RecordBatch.from_arrays(found, ["video_id", "segment_id", "distance"])
        kept = rows.slice(rows.num_rows - 1)
        yield named.filter(pa.array(wanted))


def adjacent_distance(
    segments: DataFrame,
    *,
    embedding: str | None = None,
    size: int = CHUNK_SIZE,
) -> DataFrame:
    """(video_id, segment_id, distance): 1 - cosine to the segment before.

    Distances are lexical unless ``embedding`` names a column of dense vectors.
    The first segment of a video has none (null). Texts are about half as large as
    their term counts, so they are what moves; words are counted where they meet, with
    NumPy for many rows at a time.
    """
    source = F.col("_code")
    given = segments.select(
        "video_id", "segment_id", F.col(embedding or "text").alias("_code")
    )
    if embedding is None:
        group = ["video_id", CHUNK]
        met = with_handed(given, "video_id", "segment_id", size=size).repartition(*group)
        met = met.sortWithinPartitions(*group, "segment_id")
        coded = met.select(*group, "segment_id", "_handed", tokens(source))
        return coded.mapInArrow(_lexical, _DISTANCES)
    code = F.struct(source.alias("vector"), norm(source).alias("norm"))
    paired = with_previous(
        given, "video_id", "segment_id", "_code", "_before", code=code, size=size
    )
    now, before = F.col("_code"), F.col("_before")
    product = dot(now["vector"], before["vector"])
    cosine = cosine_from_parts(product, now["norm"], before["norm"])
    return paired.select(
        "video_id",
        "segment_id",
        F.when(before.isNotNull(), 1 - cosine).alias("distance"),
    )


def topic_threshold(distances: DataFrame, k: float = 1.0) -> DataFrame:
    """Per video: count, mean and sample stdev of the distances, and threshold.

    Fewer than two distances have no spread; their threshold is infinite.
    """
    stats = distances.groupBy("video_id").agg(
        F.count("distance").alias("n_distances"),
        F.avg("distance").alias("mean_distance"),
        F.stddev_samp("distance").alias("stdev_distance"),
    )
    enough = F.col("n_distances") >= 2
    fitted = F.col("mean_distance") + F.lit(float(k)) * F.col("stdev_distance")
    return stats.withColumn(
        "threshold", F.when(enough, fitted).otherwise(F.lit(float("inf")))
    )


def label_topics(
    distances: DataFrame, k: float = 1.0, *, size: int = CHUNK_SIZE
) -> DataFrame:
    """(video_id, segment_id, topic_label) from adjacent distances.

    Videos that span less than ``size`` ids meet in one task, which fits the threshold
    and counts the topics in windows; the others, a few, are cut into chunks.
    """
    named = distances.filter(F.col("video_id").isNotNull())
    spans = named.groupBy("video_id").agg(
        (F.max("segment_id") - F.min("segment_id")).alias("_span")
    )
    long = write_out(spans.filter(F.col("_span") >= size).select("video_id"), "long_videos")
    parted = [named, long, ["video_id"], ["segment_id"]]
    near = named if long.isEmpty() else listed_only(*parted, "left_anti")
    video = Window.partitionBy("video_id")
    limit = F.when(
        F.count("distance").over(video) >= 2,
        F.avg("distance").over(video) + F.lit(float(k)) * F.stddev_samp("distance").over(video),
    ).otherwise(F.lit(float("inf")))
    limited = near.withColumn("threshold", limit)
    over = F.col("distance") > F.col("threshold") + TOLERANCE
    starts = F.when(over & F.col("segment_id").isNotNull(), 1).otherwise(0)
    so_far = video.orderBy("segment_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = limited.withColumn("_topic", F.sum(starts.cast("bigint")).over(so_far))
    if not long.isEmpty():
        far = _counted_by_chunk(listed_only(*parted, "left_semi"), k, size)
        counted = counted.unionByName(far)
    return counted.filter(F.col("segment_id").isNotNull()).select(
        "video_id",
        "segment_id",
        F.concat(F.lit("topic_"), F.col("_topic").cast("string")).alias("topic_label"),
    )


def _counted_by_chunk(distances: DataFrame, k: float, size: int) -> DataFrame:
    """``distances`` with threshold and _topic, without a video in one task."""
    limits = topic_threshold(distances, k).select("video_id", "threshold")
    limited = attach(distances, limits, ["video_id"], "segment_id", size=size)
    starts = F.col("distance") > F.col("threshold") + TOLERANCE
    return running_sum(
        limited,
        ["video_id"],
        "segment_id",
        F.when(starts, 1).otherwise(0).cast("bigint"),
        "_topic",
        size=size,
    )


def segment_topics(
    segments: DataFrame,
    *,
    k: float = 1.0,
    embedding: str | None = None,
    size: int = CHUNK_SIZE,
) -> DataFrame:
    """(video_id, segment_id, topic_label) for every segment.

    The distances are written out once: threshold, boundaries and counts all
    read them, and only they need the text. So are the labels, by segment, since a
    pipeline joins them more than once. Both are narrow next to the text.
    """
    distances = adjacent_distance(segments, embedding=embedding, size=size)
    labels = label_topics(write_out(distances, "distances"), k, size=size)
    return write_by_segment(labels, "topics")
