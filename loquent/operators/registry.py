"""Segment processors and their dispatch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Protocol, runtime_checkable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.operators.abstractive import (
    INSTRUCTION,
    MAIN_TERMS,
    BatchSummariser,
    topic_summary,
)
from loquent.operators.entities import ALLOWED_TYPES, DEFAULT_PATTERNS, extract_entities
from loquent.operators.extractive import TOP_TERMS, summary_and_scores
from loquent.operators.topics import segment_topics
from loquent.plans.located import SEGMENT
from loquent.plans.ordered import CHUNK_SIZE

EXTRACTIVE = "extractive_summary"
ENTITIES = "entities"
TOPICS = "topic_segmenter"
ABSTRACTIVE = "abstractive_summary"


@runtime_checkable
class Processor(Protocol):
    """Turns segments into rows keyed by (video_id, segment_id).

    A result may have a column ``error``; a video with one is not stored. A
    processor with a true ``one_per_segment`` gives one row per segment at most.
    """

    name: str

    def transform(self, segments: DataFrame) -> DataFrame: ...


class RowProcessor:
    """A processor that needs nothing but the segment's own row.

    ``row`` is its result as a STRUCT over the columns of the segments. Enrichment
    works it out where the segment is, so the result is never joined. A subclass
    with a ``transform`` of its own is run like any other processor.
    """

    one_per_segment = True

    def row(self) -> Column:
        raise NotImplementedError

    def transform(self, segments: DataFrame) -> DataFrame:
        return segments.select(*SEGMENT, F.inline(F.array(self.row())))


@dataclass
class ExtractiveSummarizer(RowProcessor):
    limit: int = TOP_TERMS
    name: str = EXTRACTIVE
    one_per_segment: bool = True

    def row(self) -> Column:
        return summary_and_scores(F.col("text"), self.limit)


@dataclass
class EntityExtractor:
    gazetteer: DataFrame | None = None
    patterns: dict = field(default_factory=lambda: dict(DEFAULT_PATTERNS))
    allowlist: Sequence[str] = ALLOWED_TYPES
    pattern_words: int | None = None
    name: str = ENTITIES

    def transform(self, segments: DataFrame) -> DataFrame:
        return extract_entities(
            segments,
            self.gazetteer,
            patterns=self.patterns,
            allowlist=self.allowlist,
            pattern_words=self.pattern_words,
        )


@dataclass
class TopicSegmenter:
    std_multiplier: float = 1.0
    embedding: str | None = None
    size: int = CHUNK_SIZE
    name: str = TOPICS
    one_per_segment: bool = True

    def transform(self, segments: DataFrame) -> DataFrame:
        return segment_topics(
            segments, k=self.std_multiplier, embedding=self.embedding, size=self.size
        )


@dataclass
class AbstractiveSummarizer:
    summarise: BatchSummariser | None = None
    instruction: str = INSTRUCTION
    partitions: int | None = None
    n_terms: int = MAIN_TERMS
    block: int | None = None
    name: str = ABSTRACTIVE
    one_per_segment: bool = True

    def transform(self, segments: DataFrame) -> DataFrame:
        return topic_summary(
            segments,
            summarise=self.summarise,
            instruction=self.instruction,
            partitions=self.partitions,
            n_terms=self.n_terms,
            block=self.block,
        )


def default_processors(gazetteer: DataFrame | None = None) -> list[Processor]:
    return [
        ExtractiveSummarizer(),
        EntityExtractor(gazetteer),
        TopicSegmenter(),
        AbstractiveSummarizer(),
    ]


def row_results(processors: Sequence[Processor] | None = None) -> dict[str, Column]:
    """What the processors of one row give, by name; of equal names the last counts."""
    chosen = default_processors() if processors is None else processors
    last = {p.name: p for p in chosen}
    return {
        name: p.row()
        for name, p in last.items()
        if isinstance(p, RowProcessor) and type(p).transform is RowProcessor.transform
    }


def attach_topic(segments: DataFrame, topics: DataFrame) -> DataFrame:
    """Segments with the topic_label found for them, null where none was."""
    plain = segments.drop("topic_label")
    return plain.join(topics, ["video_id", "segment_id"], "left")


def run_all(
    segments: DataFrame, processors: Sequence[Processor] | None = None
) -> dict[str, DataFrame]:
    """Run the processors in order; results by processor name.

    All get the same segments, except that the abstractive summariser also gets
    the topic labels if the topic segmenter ran before it.
    """
    chosen = default_processors() if processors is None else processors
    results: dict[str, DataFrame] = {}
    for processor in chosen:
        given = segments
        if processor.name == ABSTRACTIVE and TOPICS in results:
            given = attach_topic(segments, results[TOPICS])
        results[processor.name] = processor.transform(given)
    return results
