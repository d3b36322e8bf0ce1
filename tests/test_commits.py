"""Commits, deletes, failing videos and repeated results."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loquent import model
from loquent.operators import batch, reports
from loquent.operators.abstractive import guarded
from loquent.operators.enrich import enrich_segments, last_rows, merge_nlp
from loquent.operators.registry import (
    ABSTRACTIVE,
    EXTRACTIVE,
    TOPICS,
    AbstractiveSummarizer,
    EntityExtractor,
    TopicSegmenter,
)
from loquent.sources.warehouse import CommitConflict, Warehouse
from tests.test_store import BASE, PEOPLE, inputs, segment_frame, urls, video_frame


class Choking:
    """An extractive processor whose job breaks on one text."""

    name = EXTRACTIVE

    def __init__(self, word):
        self.word = word

    def transform(self, segments):
        problem = F.raise_error(F.concat(F.lit("ValueError: cannot read "), "video_id")).cast("string")
        summary = F.when(F.col("text").contains(self.word), problem).otherwise(F.col("text"))
        scores = F.array().cast("array<struct<sentence:string,score:double>>")
        return segments.select("video_id", "segment_id", summary.alias("summary"), scores.alias("sentence_scores"))


def processors(spark):
    """Quick ones: no sentence ranking."""
    names = spark.createDataFrame(PEOPLE, "phrase STRING, entity_type STRING")
    return [Choking("\u0000"), EntityExtractor(names), TopicSegmenter(), AbstractiveSummarizer()]


def stored(rows):
    return sorted((r["video_id"], r["segment_id"], r["text"]) for r in rows.collect())


# --- the log -------------------------------------------------------------------


def test_an_open_batch_is_seen_by_nobody(spark, warehouse):
    broken = warehouse.begin()
    broken.append("segments", segment_frame(spark, 1, 2, video="lost"))
    broken.append("videos", video_frame(spark, "lost").withColumn("processed_at", F.current_timestamp()))
    broken.delete(video_frame(spark, "kept"), ("segments", "videos"))
    warehouse.append_segments(segment_frame(spark, 7, video="kept"))
    assert [r[0] for r in stored(warehouse.read_segments())] == ["kept"]
    assert not warehouse.video_exists("lost")
    assert warehouse.read_finished("segments").count() == 0
    assert all("batch=" in f and broken.name not in f for f in warehouse.read_segments().inputFiles())


def test_of_two_batches_from_one_entry_the_second_fails(spark, warehouse):
    first, second = warehouse.begin(), warehouse.begin()
    for b, i in ((first, 1), (second, 2)):
        b.append("segments", segment_frame(spark, i))
    first.commit()
    with pytest.raises(CommitConflict):
        second.commit()
    assert [r[1] for r in stored(warehouse.read_segments())] == [1]
    assert [c.seq for c in warehouse.commits()] == [0, 1]


def test_the_log_carries_free_ids(spark, warehouse):
    assert warehouse.begin().next_segment_id == 0
    warehouse.append_segments(segment_frame(spark, 3, 41, 5))
    warehouse.append_segments(segment_frame(spark, 2))
    entity = [(9, 3, "v", "Ann", "PERSON")]
    warehouse.append_entities(spark.createDataFrame(entity, model.ENTITIES))
    warehouse.append_entities(spark.createDataFrame([], model.ENTITIES))
    again = Warehouse(spark, warehouse.root).begin()
    assert (again.next_segment_id, again.next_entity_id) == (42, 10)


def test_a_warehouse_without_a_log_reads_as_empty(spark, tmp_path):
    bare = Warehouse(spark, str(tmp_path / "nothing"))
    assert bare.commits() == [] and bare.read_segments().count() == 0
    bare.append_segments(segment_frame(spark, 1))
    assert bare.read_segments().count() == 1


def test_a_batch_reads_nothing_that_earlier_ones_stored_but_their_videos(
    spark, warehouse, monkeypatch
):
    titles, segments = inputs(spark, "id1", "id2")
    batch.process_batch(warehouse, urls(spark, BASE + "id1"), titles, segments, processors(spark))
    old = set(warehouse.read_segments().inputFiles()) | set(warehouse.read_entities().inputFiles())
    seen = []
    read = Warehouse.read

    def noted(self, name, video_id=None):
        seen.append(name)
        return read(self, name, video_id)

    monkeypatch.setattr(Warehouse, "read", noted)
    batch.process_batch(
        warehouse, urls(spark, BASE + "id1", BASE + "id2"), titles, segments, processors(spark)
    )
    assert set(seen) == {"videos"} and old
    rows = warehouse.read_segments().collect()
    assert sorted(r["segment_id"] for r in rows) == list(range(12))
    assert len(warehouse.commits()) == 3  # creation and one entry for each batch


def test_a_run_that_breaks_before_its_commit_can_be_repeated(spark, warehouse, monkeypatch):
    titles, segments = inputs(spark, "id1", "id2")
    wanted = urls(spark, BASE + "id1", BASE + "id2")

    def stopped(self, *, replaces=False):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr("loquent.sources.warehouse.Batch.commit", stopped)
        with pytest.raises(KeyboardInterrupt):
            batch.process_batch(warehouse, wanted, titles, segments, processors(spark))
    for name in model.TABLES:
        assert warehouse.read(name).count() == 0
    batch.process_batch(warehouse, wanted, titles, segments, processors(spark))
    assert sorted(r["segment_id"] for r in warehouse.read_segments().collect()) == list(range(12))
    entities = warehouse.read_entities().collect()
    assert sorted(r["entity_id"] for r in entities) == list(range(6))


def test_deleting_writes_keys_and_compaction_frees_rows(spark, warehouse):
    warehouse.append_segments(segment_frame(spark, 1, 2, video="a"))
    warehouse.append_segments(segment_frame(spark, 3, video="b"))
    files = set(warehouse.read_segments().inputFiles())
    warehouse.delete_videos(video_frame(spark, "a", "absent"), ("segments",))
    assert files <= set(warehouse.read_segments().inputFiles())
    assert [r[0] for r in stored(warehouse.read_segments())] == ["b"]
    assert warehouse.read_segments("a").count() == 0
    # What is stored later under the same id is there.
    warehouse.append_segments(segment_frame(spark, 8, video="a"))
    assert [r[:2] for r in stored(warehouse.read_segments())] == [("a", 8), ("b", 3)]
    warehouse.compact("segments")
    assert not files & set(warehouse.read_segments().inputFiles())
    assert [r[:2] for r in stored(warehouse.read_segments())] == [("a", 8), ("b", 3)]
    warehouse.delete_videos(video_frame(spark, "b"), ("segments",))
    assert [r[:2] for r in stored(warehouse.read_segments())] == [("a", 8)]
    assert warehouse.begin().next_segment_id == 9


def test_a_table_may_be_replaced_by_rows_read_from_it(spark, warehouse):
    rows = [("Ann", "Bo", 1, 2), ("Cy", "Di", 3, 5)]
    warehouse.replace_co_occurrences(spark.createDataFrame(rows, model.CO_OCCURRENCES))
    held = warehouse.read_co_occurrences()
    warehouse.replace_co_occurrences(held.filter("video_count > 1"))
    assert [r["entity_a"] for r in warehouse.read_co_occurrences().collect()] == ["Cy"]
    # A reader that began before keeps what it began with.
    assert held.count() == 2


# --- failing videos ------------------------------------------------------------


def prompts(*texts):
    return pd.DataFrame({"video_id": ["v"] * len(texts), "topic_key": list(texts), "prompt": list(texts)})


def answers(summarise, *frames):
    made = list(guarded(summarise)(iter(frames)))
    rows = pd.concat(made) if made else pd.DataFrame(columns=["topic_key", "summary", "error"])
    return {r.topic_key: (r.summary, r.error) for r in rows.itertuples()}, len(rows)


def test_prompts_that_raise_are_found_by_halving():
    calls = []

    def summarise(frames):
        calls.append("open")
        for frame in frames:
            if frame["prompt"].str.contains("bad").any():
                raise ValueError("no model for this")
            yield frame[["video_id", "topic_key"]].assign(summary=frame["prompt"].str.upper())

    good, n = answers(summarise, prompts("a", "b"), prompts("c"))
    assert good == {"a": ("A", None), "b": ("B", None), "c": ("C", None)} and calls == ["open"]
    mixed, n = answers(
        summarise, prompts("a"), prompts("b", "bad1", "c", "d", "bad2"), prompts("e"), prompts("bad3")
    )
    assert n == 8
    for key in "abcde":
        assert mixed[key] == (key.upper(), None)
    for key in ("bad1", "bad2", "bad3"):
        assert mixed[key] == (None, "ValueError: no model for this")


def test_a_hook_that_never_opens_fails_every_prompt_and_ends():
    def closed(frames):
        raise ConnectionError("down")
        yield

    got, n = answers(closed, prompts("a", "b"), prompts("c"))
    assert n == 3 and {e for _, e in got.values()} == {"ConnectionError: down"}
    assert answers(closed) == ({}, 0)


def test_answers_given_before_an_exception_stay():
    asked = []

    def late(frames):
        for frame in frames:
            asked.extend(frame["prompt"])
            for i in range(len(frame)):
                row = frame.iloc[i : i + 1]
                if row["prompt"].iloc[0] == "bad":
                    raise RuntimeError("stop")
                yield row[["video_id", "topic_key"]].assign(summary="s")

    got, n = answers(late, prompts("a", "bad", "b"))
    assert n == 3 and got["bad"] == (None, "RuntimeError: stop") and got["a"][0] == got["b"][0] == "s"
    assert asked.count("a") == 1


def raising_hook(frames):
    for frame in frames:
        if frame["prompt"].str.contains("forbidden").any():
            raise ValueError("refused")
        yield frame[["video_id", "topic_key"]].assign(summary="fine")


def three_videos(spark, second):
    titles = spark.createDataFrame([(v, v) for v in ("id1", "id2", "id3")], "video_id STRING, title STRING")
    rows = [("id1", 0, "Mira Holt sails."), ("id2", 0, "Fine."), ("id2", 1, second), ("id3", 0, "Otto Lind.")]
    return titles, spark.createDataFrame(rows, "video_id STRING, segment_id BIGINT, text STRING")


def test_a_hook_that_raises_for_one_video_leaves_the_others_stored(spark, warehouse):
    titles, segments = three_videos(spark, "a forbidden word")
    chosen = [*processors(spark)[:3], AbstractiveSummarizer(summarise=raising_hook)]
    wanted = urls(spark, BASE + "id1", BASE + "id2", BASE + "id3", "https://example.com/x")
    outcomes = batch.process_batch(warehouse, wanted, titles, segments, chosen)
    errors = {r["position"]: r["error"] for r in outcomes.collect()}
    assert errors[0] is None and errors[2] is None and "example" in errors[3]
    assert errors[1] == "ValueError: refused"
    assert tuple(reports.batch_summary(outcomes).first()) == (4, 2, 2)
    for rows in (warehouse.read_videos(), warehouse.read_segments()):
        assert {r["video_id"] for r in rows.collect()} == {"id1", "id3"}
    assert {r["video_id"] for r in warehouse.read_entities().collect()} == {"id1", "id3"}
    failed = warehouse.read_failures().collect()
    assert [(r["video_id"], r["error"]) for r in failed] == [("id2", "ValueError: refused")]
    assert len(warehouse.commits()) == 2
    # Once the cause is gone the video is processed; the others are skipped.
    later = batch.process_batch(warehouse, wanted, titles, segments, processors(spark))
    assert later.filter("error IS NULL").count() == 3
    assert warehouse.read_segments().count() == 4
    ids = [r["segment_id"] for r in warehouse.read_segments().collect()]
    assert len(set(ids)) == 4


def test_a_job_that_breaks_is_halved_down_to_the_video(spark, warehouse, monkeypatch):
    tried = []

    def store(house, part, segments, processors):
        ids = sorted(r["video_id"] for r in part.collect())
        tried.append(ids)
        if {"bad1", "bad2"} & set(ids):
            raise RuntimeError("Traceback\nValueError: cannot read it")
        house.append_videos(part)

    monkeypatch.setattr(batch, "process_segments", store)
    videos = video_frame(spark, "a", "b", "bad1", "c", "bad2", "d", "e")
    failed = batch.process_videos(warehouse, videos, None)
    assert sorted(tuple(r) for f in failed for r in f.collect()) == [
        ("bad1", "ValueError: cannot read it"),
        ("bad2", "ValueError: cannot read it"),
    ]
    assert sorted(r["video_id"] for r in warehouse.read_videos().collect()) == list("abcde")
    assert {r["video_id"] for r in warehouse.read_failures().collect()} == {"bad1", "bad2"}
    assert len(tried[0]) == 7 and len(tried) <= 11
    # An error of the system is raised once so many halvings did not help.
    with pytest.raises(RuntimeError):
        batch.process_videos(warehouse, videos, None, max_splits=0)


def test_a_processor_that_raises_stores_nothing_of_the_run(spark, warehouse):
    titles, segments = three_videos(spark, "a forbidden word")
    chosen = [Choking("forbidden"), *processors(spark)[1:]]
    with pytest.raises(Exception, match="cannot read id2"):
        batch.process_segments(warehouse, titles.withColumn("url", F.lit("u")), segments, chosen)
    assert warehouse.read_videos().count() == warehouse.read_segments().count() == 0


def test_reasons_name_the_error():
    text = "An exception was thrown\nTraceback (most recent call last):\n  File x\nValueError: odd\n"
    assert batch.reason(RuntimeError(text)) == "ValueError: odd"
    assert batch.reason(RuntimeError("plain")) == "plain"
    assert batch.reason(RuntimeError()) == "RuntimeError"


# --- repeated results ------------------------------------------------------------


def test_the_last_of_repeated_results_counts(spark, talk):
    twice = spark.createDataFrame(
        [("v1", 1, "first"), ("v1", 3, "only"), ("v1", 1, "second")],
        "video_id STRING, segment_id BIGINT, summary STRING",
    ).coalesce(1)
    got = {r["segment_id"]: r["summary"] for r in last_rows(twice).collect()}
    assert got == {1: "second", 3: "only"}
    ordered = twice.withColumn("order", F.when(F.col("summary") == "first", 2).otherwise(1))
    assert {r["summary"] for r in last_rows(ordered).collect()} == {"first", "only"}
    labels = talk.select("video_id", "segment_id", F.lit("topic_0").alias("topic_label"))
    scores = F.array(F.struct(F.lit("second").alias("sentence"), F.lit(0.25).alias("score")))
    results = {
        TOPICS: labels.unionByName(labels.withColumn("topic_label", F.lit("topic_1"))),
        EXTRACTIVE: twice.withColumn("sentence_scores", scores),
        ABSTRACTIVE: twice,
    }
    rows = {r["segment_id"]: r for r in merge_nlp(talk, results).collect()}
    assert len(rows) == 6 and rows[1]["abs_summary"] == rows[1]["ext_summary"] == "second"
    assert rows[1]["textrank_score"] == 0.25 and rows[2]["abs_summary"] == ""


class Repeating(AbstractiveSummarizer):
    def transform(self, segments):
        self.one_per_segment = False
        rows = super().transform(segments)
        return rows.unionByName(rows)


def test_enrichment_of_repeated_results_keeps_the_segments(spark, talk):
    chosen = [processors(spark)[0], TopicSegmenter(), Repeating()]
    assert enrich_segments(talk, chosen).count() == 6
