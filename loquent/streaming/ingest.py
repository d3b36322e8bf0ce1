"""Transcripts picked up as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loquent.operators.batch import process_videos
from loquent.operators.registry import Processor
from loquent.plans.located import write_by_video
from loquent.sources.transcripts import segments_from_text
from loquent.sources.warehouse import Warehouse

TRANSCRIPTS = "video_id STRING, url STRING, title STRING, text STRING"


def incremental_ingest(
    spark: SparkSession,
    warehouse: Warehouse,
    source: str,
    checkpoint: str,
    processors: Sequence[Processor] | None = None,
    *,
    store: Callable[..., object] = partial(process_videos, by_video=True),
) -> StreamingQuery:
    """Process all transcript files not seen yet, then stop.

    ``source`` holds parquet files of whole transcripts, one row per video. The
    stream remembers its files in ``checkpoint``; a video that comes again in
    another file, or in a batch run again after a failure, is skipped because
    its row is already stored. Videos that fail are in the table ``failures``.
    """

    def handle(batch: DataFrame, _: int) -> None:
        # One row per video, the same one however often this is worked out;
        # copies are merged before they are sent and before any text is split.
        # New ones are written out by video: text is split where they lie, and
        # moves but once more, to its place by segment.
        copy = F.min(F.struct("url", "title", "text")).alias("copy")
        videos = batch.groupBy("video_id").agg(copy).select("video_id", "copy.*")
        videos = write_by_video(warehouse.skip_processed(videos), "arrived")
        store(
            warehouse,
            videos.select("video_id", "url", "title"),
            segments_from_text(videos),
            processors,
        )

    return (
        spark.readStream.schema(TRANSCRIPTS)
        .parquet(source)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
