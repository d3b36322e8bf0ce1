"""the steps of an incremental ingest, against the slower ways of the same."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loquent.functions.text import tokens
from loquent.functions.vectors import bag, bag_cosine, token_cosine
from loquent.operators import abstractive, entities, ids, topics
from loquent.plans.located import write_by_video
from loquent.sources.transcripts import segments_from_text, with_times
from tests.test_located import no_broadcast, shuffled  # noqa: F401

WORDS = ["boat", "Fog", "herring", "salt", "eight", "Ägir", "otto", "a", "1999", "Σας"]


@pytest.fixture(scope="module")
def texts(spark):
    """Three videos of short texts with ties, empty texts and a repeated segment."""
    rng = random.Random(5)
    rows = []
    for video, n in (("v0", 60), ("v1", 1), ("v2", 25)):
        for i in range(n):
            said = [" ".join(rng.choices(WORDS, k=rng.randrange(1, 6))) for _ in range(rng.randrange(0, 4))]
            rows.append((video, i * 3, ". ".join(said)))
    rows += [rows[7], ("v2", 3, "salt fog salt. boat")]
    return spark.createDataFrame(rows, "video_id STRING, segment_id BIGINT, text STRING")


def told(df):
    return sorted(map(str, df.collect()))


def test_cosines_of_tokens_equal_those_of_bags(texts):
    a, b = tokens(F.col("text")), tokens(F.reverse(F.col("text")))
    both = texts.select(token_cosine(a, b).alias("fast"), bag_cosine(bag(a), bag(b)).alias("slow"))
    rows = both.collect()
    assert [r["fast"] for r in rows] == [r["slow"] for r in rows]
    assert len({r["fast"] for r in rows}) > 5


@pytest.mark.parametrize("batch", [1, 7, 10_000])
@pytest.mark.parametrize("size", [6, 65_536])
def test_distances_equal_cosines_of_neighbours(spark, texts, size, batch):
    rows = texts.dropDuplicates(["video_id", "segment_id"]).cache()
    order = Window.partitionBy("video_id").orderBy("segment_id")
    coded = rows.withColumn("b", bag(tokens(F.col("text"))))
    before = coded.withColumn("p", F.lag("b").over(order))
    slow = F.when(F.col("p").isNotNull(), 1 - bag_cosine(F.col("b"), F.col("p")))
    want = told(before.select("video_id", "segment_id", slow.alias("distance")))
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, batch)
    try:
        assert told(topics.adjacent_distance(rows, size=size)) == want
    finally:
        spark.conf.unset(setting)
        rows.unpersist()


@pytest.mark.parametrize("size", [1, 9, 40])
def test_labels_do_not_depend_on_the_span_of_a_task(texts, size):
    rows = texts.dropDuplicates(["video_id", "segment_id"])
    distances = topics.adjacent_distance(rows)
    whole = told(topics.label_topics(distances, 0.5))
    assert told(topics.label_topics(distances, 0.5, size=size)) == whole
    assert len({r.split("topic_label=")[1] for r in whole}) > 3


@pytest.mark.parametrize("batch", [1, 7, 10_000])
@pytest.mark.parametrize("size", [1, 40])
def test_summaries_of_gathered_topics_equal_those_by_main_terms(spark, texts, size, batch):
    label = F.concat(F.lit("t"), (F.col("segment_id") / 24).cast("int").cast("string"))
    named = texts.withColumn("topic_label", F.when(F.col("segment_id") != 6, label))
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, batch)
    try:
        # With spans of one id no topic of several segments is gathered.
        assert told(abstractive.central_summary(named)) == told(abstractive.central_summary(named, size=size))
        each = abstractive.topic_summary(named)
        assert told(each) == told(abstractive.topic_summary(named, size=size))
        assert each.count() == named.count()
    finally:
        spark.conf.unset(setting)


def test_texts_split_where_they_lie_are_timed_and_numbered_there(spark, no_broadcast):  # noqa: F811
    rows = [(f"v{i}", "one two\nthree\n four five six"[: 3 + i]) for i in range(20)]
    whole = spark.createDataFrame(rows, "video_id STRING, text STRING")
    lying = segments_from_text(write_by_video(whole.repartition(2, "video_id"), "whole"))
    parts = ids.chunk_sizes(lying)
    timed = with_times(lying, chunks=parts, keep="n")
    placed = ids.global_segment_ids(timed, start=5, parts=parts, by_video=True)
    assert not [c for c in shuffled(placed) if "text" in c]
    plain = ids.global_segment_ids(with_times(segments_from_text(whole)), start=5)
    assert told(placed.select(*plain.columns)) == told(plain)
    assert {(r["text"], r["n"]) for r in placed.collect()} >= {("one two", 2), ("three", 1)}


@pytest.mark.parametrize("size", [9, 65_536])
def test_times_add_up_over_chunks_and_rows_without_an_id(spark, texts, size):
    rows = texts.dropDuplicates(["video_id", "segment_id"])
    lost = [("v1", None, "lost words"), ("v3", None, "lost"), (None, 1, "lost")]
    rows = rows.unionByName(spark.createDataFrame(lost, texts.schema))
    parts = ids.chunk_sizes(rows, size=size)
    got = told(with_times(rows, size=size, chunks=parts))
    assert got == told(with_times(rows))
    assert any("'v1'" in r and "start_time=0.8" in r for r in got)


def test_texts_without_digits_are_not_searched_for_dates(spark, texts, capsys):
    found = entities.find_mentions(texts)
    found.explain()
    assert "[0-9]" in capsys.readouterr().out
    assert {r["entity_text"] for r in found.collect()} == {"1999"}
    kinds = {"ORG": ["salt"], "DATE": entities.DATE_PATTERNS}
    both = {r["entity_text"] for r in entities.find_mentions(texts, patterns=kinds).collect()}
    assert both == {"1999", "salt"}


@pytest.mark.parametrize("pattern", [r"\d*x", r"a|\d", r"[\dx]", r"[^\d]", r"(?i)\d", r"(?=\d)x", r"\p{Lu}\d", r"x(\d)?", r"\Q\d\E", r"[a&&[\d]]"])
def test_patterns_that_may_do_without_a_digit(pattern):
    assert not entities._needs_digit(pattern)
    assert all(entities._needs_digit(p) for p in (*entities.DATE_PATTERNS, r"(?:\d|x\d)+", r"v\d{1,3}"))
