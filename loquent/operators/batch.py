"""Whole batches: from a URL list and transcripts to the stored tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loquent.functions import urls as U
from loquent.functions.reporting import outcome_line
from loquent.operators.cooccurrence import co_occurrences, top_pairs, with_support
from loquent.operators.embed import OpenEncoder, embed
from loquent.operators.enrich import VECTOR, WORDS, merge_nlp, unique_names, vector_processors
from loquent.operators.ids import chunk_sizes, global_entity_ids, global_segment_ids, list_position
from loquent.operators.registry import ENTITIES, Processor, row_results, run_all
from loquent.plans.located import write_by_segment
from loquent.plans.skew import restrict_to_videos, salted_join
from loquent.session import write_out
from loquent.sources.transcripts import expand_list, with_times
from loquent.sources.warehouse import CommitConflict, Warehouse, with_time

NO_ID_MESSAGE = "No video id in URL: "
NO_TRANSCRIPT_MESSAGE = "No transcript for video: "
#: Halvings of a batch before its error is taken for one of the system.
MAX_SPLITS = 64
_ERROR_LINE = re.compile(r"^[\w.]*(?:Error|Exception|Interrupt|Exit)\b")


def result_errors(results: Mapping[str, DataFrame]) -> DataFrame | None:
    """(video_id, error) of the videos some processor reports an error for.

    A result may have a column ``error``; None if none has. The smallest message
    of a video stands for all.
    """
    found = None
    for result in results.values():
        if "error" in result.columns:
            own = result.filter(F.col("error").isNotNull()).select("video_id", "error")
            found = own if found is None else found.unionByName(own)
    if found is None:
        return None
    return write_out(found.groupBy("video_id").agg(F.min("error").alias("error")), "errors")


def process_segments(
    warehouse: Warehouse,
    videos: DataFrame,
    segments: DataFrame,
    processors: Sequence[Processor] | None = None,
    *,
    open_encoder: OpenEncoder | None = None,
    by_video: bool = False,
) -> DataFrame | None:
    """Store new videos with their segments and entities, as one commit.

    ``videos`` has (video_id, url, title[, position]), one row per video;
    ``segments`` (video_id, segment_id, text[, start_time, end_time]) with
    local ids. Videos already stored are left out. A run that breaks before its
    commit leaves nothing that a reader sees, so it can be repeated.

    A video for which a processor reports an error (see ``result_errors``) is not
    stored; its message goes to the table ``failures`` and is returned as
    (video_id, error). Its ids stay unused. For ``open_encoder`` see
    ``enrich_segments``. With ``by_video`` the segments are made of rows that
    ``write_by_video`` wrote; choice, times and ids then leave them in place.
    """
    new = write_out(warehouse.skip_processed(videos), "new_videos")
    if new.limit(1).isEmpty():
        return None
    batch = warehouse.begin()
    if batch.after_loose_rows():
        batch.delete(new, ("entities", "segments"))

    columns = ["video_id", *(["position"] if "position" in new.columns else [])]
    if by_video:
        mine = segments.join(new.select(columns), "video_id")
    else:
        mine = salted_join(segments, new.select(columns), ["video_id"], ["segment_id"])
        mine = write_out(mine, "new_segments")
    position = "position" if "position" in new.columns else None
    parts = chunk_sizes(mine, position=position)
    stored = ["segment_id", "video_id", "start_time", "end_time", "text"]
    if "start_time" not in segments.columns:
        mine = with_times(mine, chunks=parts, keep=WORDS)
        parts = parts.na.drop(subset=["_size"])
        stored.append(WORDS)
    placed = global_segment_ids(
        mine,
        position=position,
        start=batch.next_segment_id,
        parts=parts,
        by_video=by_video,
    )
    placed = placed.select(*stored)
    if open_encoder is not None:
        placed = embed(placed, {"text": VECTOR}, open_encoder)
        processors = vector_processors() if processors is None else processors
    base = write_by_segment(placed, "segments")
    results = run_all(base, processors)
    errors = result_errors(results)
    if errors is not None and errors.isEmpty():
        errors = None

    def sound(rows: DataFrame) -> DataFrame:
        return rows if errors is None else restrict_to_videos(rows, errors, "left_anti")

    enriched = merge_nlp(
        base,
        results,
        unique=unique_names(processors),
        rows=row_results(processors),
        open_encoder=open_encoder,
    )
    batch.append("segments", sound(enriched))
    found = global_entity_ids(sound(results[ENTITIES]), start=batch.next_entity_id)
    batch.append("entities", found)
    batch.append("videos", with_time(sound(new.select("video_id", "url", "title")), "processed_at"))
    if errors is not None:
        batch.append("failures", with_time(errors, "failed_at"))
    batch.commit()
    return errors


def reason(error: Exception) -> str:
    """The line of an error that names it: of a worker's traceback, the last one."""
    lines = [line.strip() for line in str(error).splitlines() if line.strip()]
    if any(line.startswith("Traceback") for line in lines):
        lines = [line for line in lines if _ERROR_LINE.match(line)][-1:] or lines
    return (lines or [type(error).__name__])[0]


def process_videos(
    warehouse: Warehouse,
    videos: DataFrame,
    segments: DataFrame,
    processors: Sequence[Processor] | None = None,
    *,
    max_splits: int = MAX_SPLITS,
    open_encoder: OpenEncoder | None = None,
    by_video: bool = False,
) -> list[DataFrame]:
    """``process_segments``, going on past videos that make a processor raise.

    Where a job fails, its videos are halved and both halves are tried again, so
    one bad video costs some three times the work of its batch, and all others
    are stored. A video that fails alone goes to the table ``failures``. After
    ``max_splits`` halvings the error is raised: then it is hardly the videos'.
    Returns frames of (video_id, error).
    """
    options = {} if open_encoder is None else {"open_encoder": open_encoder}
    if by_video:
        options["by_video"] = True
    place = F.xxhash64("video_id")
    waiting = [write_out(videos, "videos")]
    failed: list[DataFrame] = []
    splits = 0
    while waiting:
        part = waiting.pop()
        try:
            errors = process_segments(warehouse, part, segments, processors, **options)
            failed += [] if errors is None else [errors]
        except CommitConflict:
            raise
        except Exception as error:
            row = part.agg(
                F.count_distinct("video_id").alias("n"),
                F.percentile_approx(place, 0.5, F.lit(10_000)).alias("middle"),
                F.max(place).alias("top"),
            ).first()
            if row["n"] <= 1:
                message = F.lit(reason(error)).alias("error")
                errors = write_out(part.select("video_id", message).distinct(), "errors")
                warehouse.append("failures", with_time(errors, "failed_at"))
                failed.append(errors)
            elif splits >= max_splits or row["middle"] == row["top"]:
                raise
            else:
                splits += 1
                waiting += [part.filter(place > row["middle"]), part.filter(place <= row["middle"])]
    return failed


def batch_outcomes(
    warehouse: Warehouse,
    batch: DataFrame,
    titles: DataFrame,
    *,
    hosts: Sequence[str] = U.VIDEO_HOSTS,
) -> DataFrame:
    """The columns of ``batch`` with video_id and error, for every URL.

    ``batch`` has (position, url), ``titles`` one row per video that has a
    transcript. A stored video is fine whatever its host.
    """
    named = batch.withColumn("video_id", U.video_id(F.col("url")))
    known = warehouse.read_videos().select("video_id", F.lit(True).alias("_stored"))
    have = titles.select("video_id", F.lit(True).alias("_have"))
    checked = salted_join(named, known, ["video_id"], ["position"], "left")
    checked = salted_join(checked, have, ["video_id"], ["position"], "left")
    error = (
        F.when(F.col("_stored"), F.lit(None))
        .when(
            ~U.host_allowed(F.col("url"), hosts),
            F.concat(F.lit(U.WRONG_HOST_MESSAGE), "url"),
        )
        .when(
            F.col("video_id").isNull(), F.concat(F.lit(NO_ID_MESSAGE), "url")
        )
        .when(
            F.col("_have").isNull(), F.concat(F.lit(NO_TRANSCRIPT_MESSAGE), "video_id")
        )
    )
    return checked.select(*batch.columns, "video_id", error.alias("error"))


def process_batch(
    warehouse: Warehouse,
    batch: DataFrame,
    titles: DataFrame,
    segments: DataFrame,
    processors: Sequence[Processor] | None = None,
    *,
    hosts: Sequence[str] = U.VIDEO_HOSTS,
    open_encoder: OpenEncoder | None = None,
) -> DataFrame:
    """Process a URL list as one job; returns the outcome of every URL.

    Neither a bad URL nor a video that a processor fails on stops the batch; its
    error is kept in its row. A video
    named twice is processed once, one titled twice takes the smallest title,
    and one without segments has no transcript, whatever its title.
    """
    titles = restrict_to_videos(
        titles.groupBy("video_id").agg(F.min("title").alias("title")), segments
    )
    outcomes = write_out(
        batch_outcomes(warehouse, batch, titles, hosts=hosts), "outcomes"
    )
    # Copies of one URL are merged before the shuffle; the first one counts.
    wanted = (
        outcomes.filter(F.col("error").isNull())
        .groupBy("video_id")
        .agg(F.min(F.struct("position", "url")).alias("_first"))
        .select("video_id", "_first.*")
    )
    videos = wanted.join(titles.select("video_id", "title"), "video_id")
    failed = process_videos(warehouse, videos, segments, processors, open_encoder=open_encoder)
    if not failed:
        return outcomes
    messages = reduce(DataFrame.unionByName, failed).withColumnRenamed("error", "_failed")
    known = salted_join(outcomes, messages, ["video_id"], ["position"], "left")
    return known.withColumn("error", F.coalesce("error", "_failed")).drop("_failed")


def process_lists(
    warehouse: Warehouse,
    lists: DataFrame,
    titles: DataFrame,
    segments: DataFrame,
    processors: Sequence[Processor] | None = None,
    *,
    list_id: str = "list_id",
    entries: str = "entries",
    hosts: Sequence[str] = U.VIDEO_HOSTS,
) -> DataFrame:
    """Process lists of videos as one job; returns the outcome of every entry.

    Entries have their place in their list and its length, so ``outcome_lines``
    takes the result. A video on several lists is processed once.
    """
    placed = list_position(expand_list(lists, list_id=list_id, entries=entries))
    batch = placed.select("list_id", "position", "total", "url")
    return process_batch(warehouse, batch, titles, segments, processors, hosts=hosts)


def outcome_lines(outcomes: DataFrame) -> DataFrame:
    """Progress lines of a list whose rows carry position and total."""
    line = outcome_line(
        F.col("position"), F.col("total"), F.col("video_id"), F.col("error")
    )
    return outcomes.select(line.alias("line"))


def co_occurrence_job(
    warehouse: Warehouse, *, min_videos: int = 2, top_n: int = 30
) -> DataFrame:
    """Recompute the stored pairs; returns the top ones from the saved table.

    Videos whose run has not ended are left out.
    ``min_videos`` limits what is stored, ``top_n`` only what is returned.
    """
    pairs = with_support(
        co_occurrences(warehouse.read_finished("entities")), min_videos
    )
    warehouse.replace_co_occurrences(pairs)
    return top_pairs(warehouse.read_co_occurrences(), top_n)
