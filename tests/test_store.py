import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from loquent import model, session
from loquent.operators import batch, reports
from loquent.operators.registry import (
    ABSTRACTIVE,
    ENTITIES,
    EXTRACTIVE,
    TOPICS,
    EntityExtractor,
    Processor,
    TopicSegmenter,
    default_processors,
    run_all,
)
from loquent.operators.enrich import enrich_segments, merge_nlp
from loquent.sources import transcripts
from loquent.sources.warehouse import BUCKET, Warehouse
from loquent.streaming.ingest import incremental_ingest
from tests.conftest import TALK


def segment_frame(spark, *ids, video="v"):
    rows = [(i, video, 0.0, 1.0, "text") for i in ids]
    return spark.createDataFrame(
        rows,
        "segment_id BIGINT, video_id STRING, start_time DOUBLE, end_time DOUBLE, text STRING",
    )


def video_frame(spark, *ids):
    return spark.createDataFrame(
        [(i, f"https://youtu.be/{i}", f"Title {i}") for i in ids],
        "video_id STRING, url STRING, title STRING",
    )


# --- warehouse --------------------------------------------------------------


def test_new_tables_are_empty_and_keep_their_schema(spark, warehouse):
    for name, schema in model.TABLES.items():
        rows = warehouse.read(name)
        assert rows.columns == schema.fieldNames()
        assert [f.dataType for f in rows.schema] == [f.dataType for f in schema]
        assert rows.count() == 0


def test_creating_again_keeps_the_rows(spark, warehouse):
    warehouse.append_segments(segment_frame(spark, 1))
    warehouse.create_tables()
    assert Warehouse(spark, warehouse.root).read_segments().count() == 1


def test_null_metrics_survive_a_round_trip(spark, warehouse):
    warehouse.append_segments(segment_frame(spark, 20, video="none"))
    row = warehouse.read_segments("none").first()
    assert row["text"] == "text" and row["end_time"] == 1.0
    assert row["textrank_score"] is None and row["compression_ratio"] is None


def test_appends_add_up_and_filter_by_video(spark, warehouse):
    warehouse.append_segments(segment_frame(spark, 5, 10, 3))
    warehouse.append_segments(segment_frame(spark, 30, video="other"))
    assert warehouse.read_segments().count() == 4
    assert [r["segment_id"] for r in warehouse.read_segments("other").collect()] == [30]


def test_one_video_is_read_from_its_bucket(spark, warehouse):
    warehouse.append_segments(segment_frame(spark, 5))
    plan = warehouse.read_segments("v")._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")
    assert BUCKET in filters[0] and "EqualTo(video_id,v)" in filters[1]


def test_empty_entities_can_be_appended(spark, warehouse):
    warehouse.append_entities(spark.createDataFrame([], model.ENTITIES))
    assert warehouse.read_entities().count() == 0


def test_wrong_rows_are_refused(spark, warehouse):
    with pytest.raises(ValueError):
        warehouse.append_segments(spark.createDataFrame([(1,)], "segment_id BIGINT"))
    broken = segment_frame(spark, 1).withColumn("video_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="must not be null"):
        warehouse.append_segments(broken)


def test_pairs_are_replaced_also_by_nothing(spark, warehouse):
    for row in (("Ann", "Bo", 1, 2), ("Cy", "Di", 3, 5)):
        warehouse.replace_co_occurrences(
            spark.createDataFrame([row], model.CO_OCCURRENCES)
        )
    assert [tuple(r) for r in warehouse.read_co_occurrences().collect()] == [
        ("Cy", "Di", 3, 5)
    ]
    warehouse.replace_co_occurrences(spark.createDataFrame([], model.CO_OCCURRENCES))
    assert warehouse.read_co_occurrences().count() == 0


def test_video_exists_takes_any_id(spark, warehouse):
    warehouse.append_videos(video_frame(spark, "a", "it's"))
    assert warehouse.video_exists("a") and warehouse.video_exists("it's")
    assert not warehouse.video_exists("x' OR '1'='1")
    left = warehouse.skip_processed(video_frame(spark, "a", "b"))
    assert [r["video_id"] for r in left.collect()] == ["b"]
    assert warehouse.read_videos().filter("processed_at IS NULL").count() == 0


def test_delete_leaves_other_videos_even_in_the_same_bucket(spark, warehouse):
    names = [f"v{i}" for i in range(80)]
    for name in names[:1]:
        warehouse.append_segments(segment_frame(spark, 1, 2, video=name))
    rest = None
    for name in names[1:]:
        part = segment_frame(spark, 3, video=name)
        rest = part if rest is None else rest.unionByName(part)
    warehouse.append_segments(rest.coalesce(2))
    warehouse.append_videos(video_frame(spark, *names))
    warehouse.delete_videos(video_frame(spark, "v0", "v7", "absent"))
    kept = {n for n in names if n not in ("v0", "v7")}
    assert {r["video_id"] for r in warehouse.read_segments().collect()} == kept
    assert {r["video_id"] for r in warehouse.read_videos().collect()} == kept


def test_delete_can_empty_a_bucket(spark, warehouse):
    warehouse.append_segments(segment_frame(spark, 1, 2, video="only"))
    warehouse.delete_videos(video_frame(spark, "only"))
    assert warehouse.read_segments().count() == 0
    warehouse.append_segments(segment_frame(spark, 1, video="only"))
    assert warehouse.read_segments("only").count() == 1


def test_views(spark, warehouse):
    warehouse.append_segments(segment_frame(spark, 1))
    warehouse.register_views("w_")
    assert spark.sql("SELECT count(*) AS n FROM w_segments").first()["n"] == 1


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


# --- sources ----------------------------------------------------------------


def test_json_segments(spark, tmp_path):
    file = tmp_path / "talk.json"
    file.write_text(json.dumps([{"segment_id": i, "text": t} for i, t in TALK], indent=1))
    rows = transcripts.read_segments_json(spark, str(file)).collect()
    assert sorted((r["segment_id"], r["text"]) for r in rows) == TALK


def test_json_segments_know_their_file(spark, tmp_path):
    for name in ("talk.one", "two"):
        (tmp_path / f"{name}.json").write_text('[{"segment_id": 0, "text": "a"}]')
    found = transcripts.read_segments_json(spark, str(tmp_path), video_from_file=True)
    assert sorted(r["video_id"] for r in found.collect()) == ["talk.one", "two"]


def test_url_list(spark, tmp_path):
    file = tmp_path / "urls.txt"
    file.write_text("  b \n\n\t\na\nb\n")
    rows = transcripts.read_url_list(spark, str(file)).orderBy("position").collect()
    assert [r["url"] for r in rows] == ["b", "a", "b"]


@pytest.mark.parametrize("size", [2, 1000])
def test_segment_source_and_times(spark, size):
    df = spark.createDataFrame([("v", " a b \n\nc\nd e f")], "video_id STRING, text STRING")
    segments = transcripts.segments_from_text(df)
    rows = transcripts.with_times(segments, seconds_per_word=0.5, size=size).collect()
    got = sorted((r["segment_id"], r["text"], r["start_time"], r["end_time"]) for r in rows)
    assert got == [(0, "a b", 0.0, 1.0), (1, "", 1.0, 1.0), (2, "c", 1.0, 1.5), (3, "d e f", 1.5, 3.0)]


def test_expand_list_skips_entries_without_id(spark):
    df = spark.createDataFrame(
        [("l", [("n1", "x"), (None, "y"), ("", "z"), ("n4", "w")]), ("m", None)],
        "list STRING, entries ARRAY<STRUCT<id STRING, title STRING>>",
    )
    rows = transcripts.expand_list(df, list_id="list", entries="entries").collect()
    assert [(r["entry_index"], r["url"]) for r in rows] == [
        (0, "https://www.youtube.com/watch?v=n1"),
        (3, "https://www.youtube.com/watch?v=n4"),
    ]


# --- dispatch and merge -----------------------------------------------------


class Fake:
    """A processor that repeats a value, noting what it was given."""

    def __init__(self, name, value="x", column="summary", copies=1):
        self.name, self.value, self.column, self.copies = name, value, column, copies
        self.columns = None

    def transform(self, segments):
        self.columns = segments.columns
        rows = segments.select(
            "video_id", "segment_id", F.lit(self.value).alias(self.column)
        )
        return rows.withColumn(
            "n", F.explode(F.sequence(F.lit(1), F.lit(self.copies)))
        ).drop("n")


def test_results_are_keyed_by_name_and_may_vary_in_length(spark, talk):
    first, second = Fake("one"), Fake("two", copies=3)
    assert isinstance(first, Processor)
    results = run_all(talk, [first, second])
    assert list(results) == ["one", "two"]
    assert results["one"].count() == 6 and results["two"].count() == 18


def test_topics_reach_the_summariser_only_if_they_ran_before(spark, talk):
    topic, summary, other = (
        Fake(TOPICS, "topic_0", "topic_label"),
        Fake(ABSTRACTIVE),
        Fake(EXTRACTIVE),
    )
    run_all(talk, [topic, other, summary])
    assert "topic_label" in summary.columns and "topic_label" not in other.columns
    run_all(talk, [summary, topic])
    assert "topic_label" not in summary.columns


def test_default_processors():
    names = [p.name for p in default_processors()]
    assert names == [EXTRACTIVE, ENTITIES, TOPICS, ABSTRACTIVE]


def test_golden_ratios(spark, talk):
    # Topics are the first two segments and the other four; a summary is the
    # segment's first six words.
    labels = talk.select(
        "video_id",
        "segment_id",
        F.when(F.col("segment_id") <= 2, "topic_0").otherwise("topic_1").alias("topic_label"),
    )
    first_six = talk.select(
        "video_id",
        "segment_id",
        F.array_join(F.slice(F.split("text", " "), 1, 6), " ").alias("summary"),
    )
    scores = F.array(F.struct(F.col("text").alias("sentence"), F.lit(0.5).alias("score")))
    whole = talk.select(
        "video_id", "segment_id", F.col("text").alias("summary"), scores.alias("sentence_scores")
    )
    results = {TOPICS: labels, ABSTRACTIVE: first_six, EXTRACTIVE: whole}
    rows = {r["segment_id"]: r for r in merge_nlp(talk, results, size=2).collect()}
    words = {i: len(t.split()) for i, t in TALK}
    totals = {"topic_0": words[1] + words[2], "topic_1": sum(words[i] for i in range(3, 7))}
    assert len(rows) == 6
    for i, row in rows.items():
        expected = min(words[i], 6) / totals[row["topic_label"]]
        assert row["compression_ratio"] == pytest.approx(expected)
        assert row["textrank_score"] == (0.5 if words[i] else None)
    assert rows[2]["semantic_similarity"] == 1.0


def test_missing_results_become_empty(spark, talk):
    results = {
        TOPICS: Fake(TOPICS, "topic_0", "topic_label").transform(talk).limit(0),
        ABSTRACTIVE: Fake(ABSTRACTIVE).transform(talk).limit(0),
        EXTRACTIVE: Fake(EXTRACTIVE)
        .transform(talk)
        .withColumn(
            "sentence_scores", F.array().cast("array<struct<sentence:string,score:double>>")
        )
        .limit(0),
    }
    rows = merge_nlp(talk, results).collect()
    assert len(rows) == 6
    for row in rows:
        assert row["ext_summary"] == "" and row["abs_summary"] == ""
        assert row["topic_label"] is None and row["textrank_score"] is None
        # Without a topic every segment stands alone.
        assert row["compression_ratio"] == (None if row["segment_id"] == 2 else 0.0)


def test_enrich_runs_the_default_processors(spark, talk):
    rows = enrich_segments(talk).collect()
    assert len(rows) == 6
    assert all(r["topic_label"].startswith("topic_") for r in rows)
    assert all((r["textrank_score"] is None) == (r["segment_id"] == 2) for r in rows)


# --- reports ----------------------------------------------------------------


@pytest.fixture
def scored(spark):
    rows = [
        ("a", 1, 0.0, 1.0, "topic_0", "e1", "s0", 0.5, 0.9),
        ("a", 2, 1.0, 2.0, "topic_0", "e2", "s0", 0.5, 0.1),
        ("a", 3, 2.0, 65.5, "topic_1", "e3", "s1", None, None),
        ("b", 4, 0.0, 1.0, "topic_0", "e4", "s2", 1.0, 0.2),
    ]
    return spark.createDataFrame(
        rows,
        "video_id STRING, segment_id BIGINT, start_time DOUBLE, end_time DOUBLE, "
        "topic_label STRING, ext_summary STRING, abs_summary STRING, "
        "compression_ratio DOUBLE, semantic_similarity DOUBLE",
    )


def test_stats(spark, scored):
    rows = {r["video_id"]: r for r in reports.video_stats(scored).collect()}
    assert (rows["a"]["segments"], rows["a"]["topics"]) == (3, 2)
    assert rows["a"]["avg_compression_ratio"] == 0.5
    assert rows["a"]["averages"].endswith("0.50")
    whole = reports.corpus_stats(scored).first()
    assert (whole["segments"], whole["topics"]) == (4, 3)
    assert reports.corpus_stats(scored, label_only=True).first()["topics"] == 2
    assert reports.corpus_stats(scored, ["b"]).first()["segments"] == 1
    chosen = scored.select("video_id").filter("video_id = 'a'")
    assert reports.corpus_stats(scored, chosen).first()["segments"] == 3


def test_timeline(spark, scored):
    rows = reports.topic_timeline_capped(scored, 1).orderBy("video_id").collect()
    assert [tuple(r) for r in rows] == [
        ("a", 1, "0:00", "0:02", 2, "s0", 1),
        ("b", 1, "0:00", "0:01", 1, "s2", 0),
    ]


def test_most_divergent(spark, scored):
    assert reports.most_divergent(scored).first()["segment_id"] == 2
    assert reports.most_divergent(scored, ["b"]).first()["segment_id"] == 4
    per_video = reports.most_divergent_per_video(scored).collect()
    assert {(r["video_id"], r["segment_id"]) for r in per_video} == {("a", 2), ("b", 4)}


def test_entities_reports(spark):
    rows = [("a", "x", "ORG")] * 3 + [("a", "w", "ORG")] * 3 + [("a", "y", "GPE"), ("b", "x", "ORG")]
    df = spark.createDataFrame(rows, "video_id STRING, entity_text STRING, entity_type STRING")
    top = reports.top_entities(df, 2).filter("video_id = 'a'").orderBy("place").collect()
    assert [r["line"] for r in top] == ["w (ORG): 3", "x (ORG): 3"]
    assert reports.unique_entities(df).first()[0] == 3
    assert reports.unique_entities(df, ["b"]).first()[0] == 1
    assert reports.unique_entities(df, approximate=True).first()[0] == 3


def test_history(spark):
    rows = [("a", None, dt.datetime(2024, 1, 1)), ("b", "B", dt.datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "video_id STRING, title STRING, processed_at TIMESTAMP")
    assert [r["title"] for r in reports.history(df).collect()] == ["B", "(untitled)"]


# --- batches ----------------------------------------------------------------


def inputs(spark, *videos):
    titles = spark.createDataFrame([(v, f"T {v}") for v in videos], "video_id STRING, title STRING")
    rows = [(v, i, t) for v in videos for i, (_, t) in enumerate(TALK)]
    return titles, spark.createDataFrame(rows, "video_id STRING, segment_id BIGINT, text STRING")


def urls(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "position BIGINT, url STRING")


BASE = "https://www.youtube.com/watch?v="
PEOPLE = [("mira holt", "PERSON"), ("otto lind", "PERSON")]


def processors(spark):
    names = spark.createDataFrame(PEOPLE, "phrase STRING, entity_type STRING")
    chosen = default_processors(names)
    assert isinstance(chosen[1], EntityExtractor) and isinstance(chosen[2], TopicSegmenter)
    return chosen


def test_batch_goes_on_past_bad_urls_and_skips_what_is_stored(spark, warehouse):
    titles, segments = inputs(spark, "id1", "id2")
    first = urls(spark, BASE + "id1", "https://example.com/x", BASE + "id9", BASE, BASE + "id1")
    outcomes = batch.process_batch(warehouse, first, titles, segments, processors(spark))
    errors = {r["position"]: r["error"] for r in outcomes.collect()}
    assert errors[0] is None and errors[4] is None
    assert errors[1] == "Not a YouTube URL: https://example.com/x"
    assert "id9" in errors[2] and errors[3].startswith("No video id")
    summary = reports.batch_summary(outcomes).first()
    assert tuple(summary) == (5, 2, 3)
    assert reports.failed_outcomes(outcomes).count() == 3
    assert warehouse.read_segments().count() == 6
    assert warehouse.read_entities().count() == 3

    batch.process_batch(
        warehouse, urls(spark, BASE + "id1", "https://youtu.be/id2"), titles, segments, processors(spark)
    )
    rows = warehouse.read_segments().collect()
    assert sorted(r["segment_id"] for r in rows) == list(range(12))
    assert all(r["video_id"] == "id1" for r in rows if r["segment_id"] < 6)
    entity_ids = [r["entity_id"] for r in warehouse.read_entities().collect()]
    assert sorted(entity_ids) == list(range(6))
    videos = {r["video_id"]: r["title"] for r in warehouse.read_videos().collect()}
    assert videos == {"id1": "T id1", "id2": "T id2"}


def test_leftovers_of_a_broken_run_do_not_stay(spark, warehouse):
    titles, segments = inputs(spark, "id1")
    broken = segment_frame(spark, 0, 1, 2, video="id1")
    warehouse.append_segments(broken)
    batch.process_batch(warehouse, urls(spark, BASE + "id1"), titles, segments, processors(spark))
    assert warehouse.read_segments().count() == 6


def test_unfinished_videos_are_not_counted(spark, warehouse):
    rows = [(0, 0, "v", "a", "ORG"), (1, 0, "v", "b", "ORG")]
    schema = "entity_id BIGINT, segment_id BIGINT, video_id STRING, entity_text STRING, entity_type STRING"
    warehouse.append_entities(spark.createDataFrame(rows, schema))
    assert batch.co_occurrence_job(warehouse, min_videos=1).count() == 0
    warehouse.append_videos(video_frame(spark, "v"))
    assert batch.co_occurrence_job(warehouse, min_videos=1).count() == 1


def test_titles_alone_are_no_transcript_and_lists_report_each_entry(spark, warehouse):
    titles, segments = inputs(spark, "id1", "id2")
    more = spark.createDataFrame([("id3", "t"), ("id1", "zz")], "video_id STRING, title STRING")
    lists = spark.createDataFrame(
        [("l", [("id1", "a"), (None, "b"), ("id3", "c")]), ("m", [("id2", "d"), ("id1", "e")])],
        "list_id STRING, entries ARRAY<STRUCT<id STRING, title STRING>>",
    )
    titles = titles.select("video_id", "title").unionByName(more)
    outcomes = batch.process_lists(warehouse, lists, titles, segments, processors(spark))
    lines = [r["line"].split(" ", 1)[1] for r in batch.outcome_lines(outcomes).collect()]
    assert sorted(lines) == ["1/2 id1 ok", "1/2 id2 ok", "2/2 id1 ok", "2/2 id3 failed"]
    assert sorted(r["video_id"] for r in warehouse.read_videos().collect()) == ["id1", "id2"]


def test_co_occurrence_job_twice_gives_the_same_table(spark, warehouse):
    titles, segments = inputs(spark, "id1", "id2")
    batch.process_batch(
        warehouse, urls(spark, BASE + "id1", BASE + "id2"), titles, segments, processors(spark)
    )
    for _ in range(2):
        top = batch.co_occurrence_job(warehouse).collect()
        assert [tuple(r) for r in top] == [("Mira Holt", "Otto Lind", 2, 2)]
        assert warehouse.read_co_occurrences().count() == 1
    batch.co_occurrence_job(warehouse, min_videos=3)
    assert warehouse.read_co_occurrences().count() == 0


def test_stream_handles_only_unseen_videos(spark, warehouse, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "progress")

    def arrive(*videos):
        rows = [(v, BASE + v, v, "Mira Holt is here.\nSo is Otto Lind.") for v in videos]
        df = spark.createDataFrame(rows, "video_id STRING, url STRING, title STRING, text STRING")
        df.coalesce(1).write.mode("append").parquet(source)
        incremental_ingest(
            spark, warehouse, source, checkpoint, processors(spark)
        ).awaitTermination()

    arrive("a", "b")
    arrive("b", "c", "c")
    counts = warehouse.read_segments().groupBy("video_id").count().collect()
    assert {tuple(r) for r in counts} == {("a", 2), ("b", 2), ("c", 2)}
    assert warehouse.read_videos().count() == 3
    ids = [r["segment_id"] for r in warehouse.read_segments().collect()]
    assert sorted(ids) == list(range(6))
