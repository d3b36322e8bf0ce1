"""Processor results and metrics joined onto the segments."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.functions.binding import let
from loquent.functions.metrics import (
    ratio_of_counts,
    semantic_similarity,
    textrank_lookup,
)
from loquent.functions.text import word_count
from loquent.operators.abstractive import with_topic_key
from loquent.operators.embed import OpenEncoder, embed, vector_similarity
from loquent.operators.registry import (
    ABSTRACTIVE,
    EXTRACTIVE,
    TOPICS,
    Processor,
    TopicSegmenter,
    attach_topic,
    default_processors,
    row_results,
    run_all,
)
from loquent.plans.located import SEGMENT as _KEYS
from loquent.plans.located import write_by_segment
from loquent.plans.ordered import CHUNK_SIZE, attach
from loquent.session import write_out

#: Vectors of the segments' texts, while they are enriched.
VECTOR = "_text_vector"
#: Numbers of words of the segments' texts, where they were counted before.
WORDS = "_text_words"


def last_rows(result: DataFrame, order: str = "order") -> DataFrame:
    """The last row of every segment: of the largest ``order`` if the result has
    that column, else the one that stands last in the frame."""
    place = F.col(order) if order in result.columns else F.monotonically_increasing_id()
    others = [c for c in result.columns if c not in _KEYS]
    row = F.struct(*[F.col(c) for c in others])
    numbered = result.select(*_KEYS, place.alias("_place"), row.alias("_row"))
    last = numbered.groupBy(*_KEYS).agg(F.max_by("_row", "_place").alias("_row"))
    return last.select(*_KEYS, "_row.*")


def unique_names(processors: Sequence[Processor] | None) -> set[str]:
    """Names of the processors that promise one row per segment."""
    chosen = default_processors() if processors is None else processors
    return {p.name for p in chosen if getattr(p, "one_per_segment", False)}


def _sized(segments: DataFrame, topics: DataFrame, size: int) -> DataFrame:
    """(video_id, segment_id, topic_label, original_words): what a topic's words are.

    Only counts of words leave the segments. Joining texts by newlines never merges
    words, so the counts add up.
    """
    words = F.col(WORDS) if WORDS in segments.columns else word_count(F.col("text"))
    counted = segments.select(*_KEYS, words.alias("_words"))
    keyed = write_out(with_topic_key(attach_topic(counted, topics)), "topic_keys")
    topic = ["video_id", "topic_key"]
    words = keyed.groupBy(*topic).agg(
        F.sum("_words").alias("original_words"),
        (F.max("segment_id") - F.min("segment_id")).alias("_span"),
    )
    words = write_out(words, "topic_words")
    # Only a topic over many ids has too many segments for one task.
    if words.filter(F.col("_span") >= size).isEmpty():
        sized = keyed.drop("_words").join(words, topic, "left")
    else:
        sized = attach(keyed.drop("_words"), words, topic, "segment_id", size=size)
    return write_by_segment(sized.select(*_KEYS, "topic_label", "original_words"), "sizes")


def merge_nlp(
    segments: DataFrame,
    results: Mapping[str, DataFrame],
    *,
    unique: Collection[str] = (),
    rows: Mapping[str, Column] | None = None,
    open_encoder: OpenEncoder | None = None,
    size: int = CHUNK_SIZE,
) -> DataFrame:
    """Segments with topic, summaries and the three metrics.

    Where a result has several rows of a segment the last one counts (see
    ``last_rows``); those named in ``unique`` have one each. The extractive result
    may be given in ``rows`` instead, as a STRUCT over the segment's columns. Missing
    summaries become '', a missing topic null. The compression ratio compares a
    topic's summary with the whole topic's text, so only word counts are summed per
    topic; the text itself is not gathered. Everything is brought to the segments:
    segments written by ``write_by_segment`` are not shuffled.

    The similarity of the summaries is lexical, or that of their vectors by
    ``open_encoder``.
    """
    rows = rows or {}

    def result(name: str, *columns: Column) -> DataFrame:
        found = results[name] if name in unique else last_rows(results[name])
        return found.select(*_KEYS, *columns)

    topics = result(TOPICS, F.col("topic_label"))
    abstractive = result(ABSTRACTIVE, F.col("summary").alias("_abs"))
    kept = [c for c in segments.columns if c not in ("topic_label", WORDS)]
    joined = segments.select(*kept).join(_sized(segments, topics, size), _KEYS, "left")
    joined = joined.join(abstractive, _KEYS, "left")
    if EXTRACTIVE in rows:

        def renamed(own: Column) -> Column:
            return F.struct(own["summary"].alias("_ext"), own["sentence_scores"].alias("_scores"))

        joined = joined.select("*", F.inline(F.array(let(rows[EXTRACTIVE], renamed))))
    else:
        extractive = result(
            EXTRACTIVE, F.col("summary").alias("_ext"), F.col("sentence_scores").alias("_scores")
        )
        joined = joined.join(extractive, _KEYS, "left")
    merged = joined.withColumn("ext_summary", F.coalesce("_ext", F.lit(""))).withColumn(
        "abs_summary", F.coalesce("_abs", F.lit(""))
    )
    ext_summary, abs_summary = F.col("ext_summary"), F.col("abs_summary")
    if open_encoder is None:
        similarity = semantic_similarity(ext_summary, abs_summary)
    else:
        vectors = {"ext_summary": "_ext_vector", "abs_summary": "_abs_vector"}
        merged = embed(merged, vectors, open_encoder)
        similarity = vector_similarity(
            ext_summary, abs_summary, F.col("_ext_vector"), F.col("_abs_vector")
        )
    return merged.select(
        *kept,
        "topic_label",
        "ext_summary",
        "abs_summary",
        textrank_lookup(F.col("_scores"), ext_summary).alias("textrank_score"),
        ratio_of_counts(F.col("original_words"), word_count(abs_summary)).alias(
            "compression_ratio"
        ),
        similarity.alias("semantic_similarity"),
    )


def vector_processors(gazetteer: DataFrame | None = None) -> list[Processor]:
    """The default processors, but topics by the vectors of ``enrich_segments``."""
    return [
        TopicSegmenter(embedding=VECTOR) if p.name == TOPICS else p
        for p in default_processors(gazetteer)
    ]


def enrich_segments(
    segments: DataFrame,
    processors: Sequence[Processor] | None = None,
    *,
    open_encoder: OpenEncoder | None = None,
) -> DataFrame:
    """Run the processors and merge their results.

    The segments are first written by segment, the only time that text is shuffled;
    processors read them there. With ``open_encoder`` they get the vectors of the
    texts as a column ``VECTOR``, worked out once; topics follow them unless other
    processors are given, and the similarity of the summaries is that of vectors.
    """
    given = segments
    if open_encoder is not None:
        given = embed(segments, {"text": VECTOR}, open_encoder)
        processors = vector_processors() if processors is None else processors
    base = write_by_segment(given, "enriched")
    merged = merge_nlp(
        base,
        run_all(base, processors),
        unique=unique_names(processors),
        rows=row_results(processors),
        open_encoder=open_encoder,
    )
    return merged.drop(VECTOR)
