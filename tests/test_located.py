"""Rows laid out by segment, fused processors, vectors, and the plans they give."""

import re

import pytest
from pyspark.sql import functions as F

from loquent.operators import cooccurrence, ids
from loquent.operators.abstractive import central_summary
from loquent.operators.embed import embed, vector_similarity
from loquent.operators.enrich import VECTOR, enrich_segments, merge_nlp
from loquent.operators.registry import (
    ABSTRACTIVE,
    EXTRACTIVE,
    TOPICS,
    AbstractiveSummarizer,
    ExtractiveSummarizer,
    TopicSegmenter,
    attach_topic,
    row_results,
    run_all,
)
from loquent.plans.located import write_by_segment


@pytest.fixture
def no_broadcast(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    yield
    spark.conf.set(setting, before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled(df) -> list[set[str]]:
    """The columns of every exchange of the plan, by the formatted explanation."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    inputs = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    return [{re.sub(r"#\d+L?", "", c).strip() for c in i.split(",")} for i in inputs]


def two_videos(spark):
    rows = [("v1", i, f"Line {i}. Fish and ships come in.") for i in range(30)]
    rows += [("v2", 5, None), ("v2", 9, ""), (None, 1, "lost"), ("v2", None, "too")]
    return spark.createDataFrame(rows, "video_id STRING, segment_id BIGINT, text STRING")


def test_rows_by_segment_are_the_rows(spark):
    rows = two_videos(spark).withColumn("more", F.array(F.struct(F.lit(1).alias("x"))))
    rows = rows.unionByName(rows.filter("segment_id = 3"))
    kept = write_by_segment(rows, "kept", 3)
    assert kept.dtypes == rows.dtypes
    assert sorted(map(str, kept.collect())) == sorted(map(str, rows.collect()))
    assert write_by_segment(rows.limit(0), "none").count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("loquent_kept")]


def test_joins_by_segment_move_the_other_side_only(spark, no_broadcast):
    rows = two_videos(spark)
    left, right = write_by_segment(rows, "left"), write_by_segment(rows.drop("text"), "right")
    alike = left.join(right, ["video_id", "segment_id"], "left")
    assert shuffled(alike) == []
    other = left.join(rows.drop("text"), ["video_id", "segment_id"], "left")
    assert shuffled(other) == [{"video_id", "segment_id"}]
    assert alike.count() == other.count() == 34


def test_enrichment_leaves_the_text_in_place(spark, no_broadcast):
    base = write_by_segment(two_videos(spark).na.drop(subset=["video_id", "segment_id"]), "base")
    chosen = [ExtractiveSummarizer(), TopicSegmenter(), AbstractiveSummarizer()]
    results = run_all(base, chosen)
    merged = merge_nlp(
        base, results, unique={TOPICS, ABSTRACTIVE}, rows=row_results(chosen)
    )
    moved = shuffled(merged)
    assert len(moved) <= 8 and plan(merged).count("Exchange hashpartitioning") == len(moved)
    assert not [c for c in moved if c & {"text", "sentence_scores", "_scores"}]
    central = central_summary(attach_topic(base, results[TOPICS]))
    assert not [c for c in shuffled(central) if "text" in c]
    assert merged.count() == 32


def test_fused_results_equal_joined_ones(spark, talk):
    chosen = [ExtractiveSummarizer(), TopicSegmenter(), AbstractiveSummarizer()]
    results = run_all(talk, chosen)
    joined = merge_nlp(talk, results, unique={TOPICS, ABSTRACTIVE, EXTRACTIVE})
    fused = enrich_segments(talk, chosen)
    assert fused.columns == joined.columns
    assert sorted(map(str, fused.collect())) == sorted(map(str, joined.collect()))


class Shouting(ExtractiveSummarizer):
    def transform(self, segments):
        return super().transform(segments).withColumn("summary", F.upper("summary"))


def test_a_transform_of_its_own_is_run(spark, talk):
    assert row_results([ExtractiveSummarizer(), Shouting()]) == {}
    assert list(row_results([Shouting(), ExtractiveSummarizer()])) == [EXTRACTIVE]
    rows = enrich_segments(talk, [Shouting(), TopicSegmenter(), AbstractiveSummarizer()]).collect()
    assert all(r["ext_summary"] == r["ext_summary"].upper() for r in rows)
    assert any(r["ext_summary"] for r in rows)


# --- vectors -------------------------------------------------------------------


def opened():
    """Vectors that tell how often the encoder was asked, and for how many texts."""
    calls = []

    def encode(texts):
        calls.append(texts)
        return [[len(t), len(calls), len(texts)] for t in texts]

    return encode


def test_a_text_is_encoded_once_and_null_never(spark):
    rows = spark.createDataFrame(
        [(i, t, u) for i, (t, u) in enumerate([("aa", "b"), (None, "aa"), ("aa", ""), ("", "b")])],
        "id INT, t STRING, u STRING",
    ).coalesce(1)
    got = {r["id"]: r for r in embed(rows, {"t": "tv", "u": "uv"}, opened).collect()}
    assert got[1]["tv"] is None
    assert got[0]["tv"] == got[2]["tv"] == got[1]["uv"] == [2.0, 1.0, 2.0]
    assert got[3]["tv"] == got[2]["uv"] == [0.0, 1.0, 2.0]
    assert got[0]["uv"] == got[3]["uv"] == [1.0, 2.0, 1.0]
    assert embed(rows.limit(0), {"t": "tv"}, opened).count() == 0
    assert embed(rows, {"t": "u"}, opened).columns == ["id", "t", "u"]


def test_an_encoder_that_loses_texts_is_an_error(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "t STRING").coalesce(1)
    with pytest.raises(Exception, match="2 texts, 1 vectors"):
        embed(rows, {"t": "v"}, lambda: lambda texts: [[1.0]]).collect()


def test_similarity_of_vectors(one):
    schema = "a STRING, b STRING, v ARRAY<DOUBLE>, w ARRAY<DOUBLE>"
    value = vector_similarity(*[F.col(c) for c in "abvw"])
    assert one(value, schema, "x", "y", [1.0, 1.0], [1.0, 0.0]) == pytest.approx(0.5**0.5)
    assert one(value, schema, "", "", [1.0], [-1.0]) == 1.0
    assert one(value, schema, "", "y", [1.0], [1.0]) == 0.0
    assert one(value, schema, "x", "y", [0.0], [1.0]) == 0.0


def first_word_length():
    return lambda texts: [[float(t.startswith("A")), float(not t.startswith("A"))] for t in texts]


def test_topics_and_similarity_follow_the_vectors(spark, talk):
    rows = enrich_segments(talk, open_encoder=first_word_length).collect()
    assert VECTOR not in rows[0].asDict()
    # Only the last text begins with an A, so only it is another topic.
    labels = {r["segment_id"]: r["topic_label"] for r in rows}
    assert {labels[i] for i in range(1, 6)} == {"topic_0"} and labels[6] == "topic_1"
    found = {r["segment_id"]: r["semantic_similarity"] for r in rows}
    assert found[6] == pytest.approx(1.0) and found[2] == 0.0


# --- ids and pairs ---------------------------------------------------------------


@pytest.mark.parametrize("position", [None, "position"])
def test_ids_take_four_exchanges(spark, no_broadcast, position):
    rows = two_videos(spark).na.drop(subset=["video_id", "segment_id"])
    placed = ids.global_segment_ids(rows.withColumn("position", F.lit(3).cast("bigint")), position=position, size=4)
    assert plan(placed).count("Exchange ") <= 4
    found = placed.collect()
    assert len({r["segment_id"] for r in found}) == len(found) == 32
    assert placed.columns == ["video_id", "segment_id", "text", "position"]


@pytest.mark.parametrize("block", [1, 7, 512])
def test_pairs_of_blocks_are_all_pairs(spark, block):
    names = [f"n{i:03d}" for i in range(40)]
    rows = [("v", s, n, t) for s, count in ((1, 40), (2, 1), (3, 8)) for n in names[:count] for t in "xy"]
    entities = spark.createDataFrame(
        rows, "video_id STRING, segment_id BIGINT, entity_text STRING, entity_type STRING"
    )
    got = cooccurrence.entity_pairs(entities, block=block).collect()
    want = {(a, b, s) for s, c in ((1, 40), (3, 8)) for a in names[:c] for b in names[:c] if a < b}
    assert len(got) == len(want)
    assert {(r["entity_a"], r["entity_b"], r["segment_id"]) for r in got} == want


def test_a_task_gets_two_blocks_of_a_long_segment(spark):
    """What is sent to the tasks are two blocks, not the list of texts."""
    entities = spark.range(3000).select(
        F.lit("v").alias("video_id"),
        F.lit(1).cast("bigint").alias("segment_id"),
        F.col("id").cast("string").alias("entity_text"),
    )
    pairs = cooccurrence.entity_pairs(entities, block=100)
    moved = [c for c in shuffled(pairs) if "firsts" in c]
    assert len(moved) == 1 and "texts" not in moved[0]
    assert pairs.count() == 3000 * 2999 // 2
