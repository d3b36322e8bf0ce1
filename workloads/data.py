"""The test tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loquent.functions.binding import let
from loquent.functions.text import sentences, strip, surface_tokens, words
from loquent.functions.urls import canonical_url
from loquent.operators.registry import (
    EXTRACTIVE,
    AbstractiveSummarizer,
    EntityExtractor,
    ExtractiveSummarizer,
    Processor,
    RowProcessor,
    TopicSegmenter,
)
from loquent.session import scratch_path
from loquent.sources.transcripts import segments_from_text
from loquent.sources.warehouse import Warehouse

# Entity types of gazetteer phrases, by phrase length; the last
# one is not on the allowlist.
GAZETTEER_TYPES = ("PERSON", "ORG", "GPE", "DATE", "PRODUCT", "NORP")
LONG_WORD = 8
PAIRED_WORD = 6
LETTERS = "etaoinsr"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def doc_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as whole transcripts.

    Splits of a file say nothing of its row groups, and a row group is read by one
    task. A table in fewer files than there are cores is spread by row; one in more
    files, as any large one is, is read where it lies.
    """
    rows = table(spark, folder, "documents")
    cores = spark.sparkContext.defaultParallelism
    if len(rows.inputFiles()) < cores:
        rows = rows.repartition(max(cores, rows.rdd.getNumPartitions()), "doc_id")
    return rows.select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.col("doc_id").alias("position"),
        canonical_url(F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("title"),
        "text",
    )


def doc_segments(spark: SparkSession, folder: str) -> DataFrame:
    """(video_id, segment_id, text): one segment per line of a document."""
    return segments_from_text(doc_transcripts(spark, folder))


def placed_doc_segments(spark: SparkSession, folder: str) -> DataFrame:
    return segments_from_text(doc_transcripts(spark, folder), keep=["position"])


def talk_segments(spark: SparkSession, folder: str) -> DataFrame:
    """(video_id, segment_id, text): one segment per turn of a conversation."""
    return table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("video_id"),
        F.col("turn").alias("segment_id"),
        strip(F.col("text")).alias("text"),
    )


def talk_videos(spark: SparkSession, folder: str) -> DataFrame:
    """One video per conversation; titles are the first sentence, if any ends."""
    opening = F.min_by("text", "turn")
    return (
        table(spark, folder, "conversations")
        .groupBy("conv_id")
        .agg(opening.alias("opening"))
        .select(
            F.col("conv_id").cast("string").alias("video_id"),
            F.col("conv_id").alias("position"),
            canonical_url(F.col("conv_id").cast("string")).alias("url"),
            F.regexp_extract("opening", r"^([^.!?,]*)[.!?]", 1).alias("title"),
            F.expr(
                "timestamp '2024-01-01 00:00:00' + make_dt_interval(0, 0, conv_id)"
            ).alias("processed_at"),
        )
    )


def vector_segments(spark: SparkSession, folder: str) -> DataFrame:
    """(video_id, segment_id, embedding): one video per label."""
    return table(spark, folder, "embeddings").select(
        F.col("label").cast("string").alias("video_id"),
        F.col("vec_id").alias("segment_id"),
        "embedding",
    )


def star_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Parts on orders as entity mentions: order = segment, customer = video."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.select(
        F.col("l_orderkey").alias("segment_id"),
        F.col("o_custkey").cast("string").alias("video_id"),
        F.col("p_brand").alias("entity_text"),
        F.col("p_type").alias("entity_type"),
    )


def _kind(phrase: Column) -> Column:
    types = F.array(*[F.lit(t) for t in GAZETTEER_TYPES])
    return F.get(types, F.length(phrase) % len(GAZETTEER_TYPES))


def gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """Long words, pairs of neighbouring longer words, and runs of four words
    between longer ones, of the benchmark."""
    token_lists = table(spark, folder, "benchmark").select(
        F.transform(surface_tokens(F.col("text")), lambda w: F.lower(w)).alias("w")
    )
    pairs = F.zip_with("w", F.slice("w", 2, F.size("w")), lambda a, b: F.struct(a, b))
    single = token_lists.select(F.explode("w").alias("phrase")).filter(
        F.length("phrase") >= LONG_WORD
    )
    double = (
        token_lists.select(F.inline(pairs).alias("a", "b"))
        .filter((F.length("a") >= PAIRED_WORD) & (F.length("b") >= PAIRED_WORD))
        .select(F.concat_ws(" ", "a", "b").alias("phrase"))
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - 3, F.lit(1)))
    runs = F.transform(starts, lambda i: F.slice("w", i, 4))
    four = (
        token_lists.select(F.explode(runs).alias("r"))
        .filter(F.size("r") == 4)
        .filter(F.length(F.get("r", F.lit(0))) >= PAIRED_WORD)
        .filter(F.length(F.get("r", F.lit(3))) >= PAIRED_WORD)
        .select(F.concat_ws(" ", "r").alias("phrase"))
    )
    return (
        single.unionByName(double)
        .unionByName(four)
        .distinct()
        .select("phrase", _kind(F.col("phrase")).alias("entity_type"))
    )


class LeadSentence(RowProcessor):
    """A caller's own extractive processor: every sentence scores minus its place."""

    name = EXTRACTIVE

    def row(self) -> Column:
        def result(said: Column) -> Column:
            scored = F.transform(
                said,
                lambda s, i: F.struct(
                    s.alias("sentence"), (-i).cast("double").alias("score")
                ),
            )
            lead = F.coalesce(F.get(said, F.lit(0)), F.lit(""))
            return F.struct(lead.alias("summary"), scored.alias("sentence_scores"))

        return let(sentences(F.col("text")), result)


class LetterCounts:
    """A caller's own encoder: how often a text has each of ``LETTERS``."""

    def __call__(self):
        return lambda texts: [[t.count(c) for c in LETTERS] for t in texts]


def light_processors(k: float = 1.0) -> list[Processor]:
    """Processors without TextRank and entities."""
    return [LeadSentence(), TopicSegmenter(k), AbstractiveSummarizer()]


def light_entity_processors() -> list[Processor]:
    return [*light_processors(), EntityExtractor()]


def full_processors(spark: SparkSession, folder: str) -> list[Processor]:
    return [
        ExtractiveSummarizer(),
        EntityExtractor(gazetteer(spark, folder)),
        TopicSegmenter(),
        AbstractiveSummarizer(),
    ]


def lead_of(text: Column, n: int) -> Column:
    return F.array_join(F.slice(words(text), 1, n), " ")


def new_warehouse(spark: SparkSession) -> Warehouse:
    """An empty warehouse at a fresh place in the shared folder."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.create_tables()
    return warehouse
