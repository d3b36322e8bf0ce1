import random
import re

import pytest
from pyspark.sql import functions as F

from loquent.operators.ids import global_entity_ids
from loquent.operators.topics import adjacent_distance
from loquent.plans.ordered import attach, running_sum, with_previous
from loquent.plans.skew import listed_join, salted_join
from workloads.data import doc_transcripts


@pytest.fixture(scope="module")
def uneven():
    """Groups of very different size, ids with gaps; g0 holds most rows."""
    rng = random.Random(3)
    rows = []
    for group, size in (("g0", 60), ("g1", 1), ("g2", 7), ("g3", 2)):
        for i in sorted(rng.sample(range(0, 200), size)):
            rows.append((group, i, rng.randrange(0, 9)))
    return rows


def frame(spark, rows):
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    return spark.createDataFrame(shuffled, "g STRING, i BIGINT, x BIGINT")


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_running_sum_matches_a_loop(spark, uneven, size):
    got = running_sum(frame(spark, uneven), ["g"], "i", F.col("x"), "s", size=size)
    found = {(r["g"], r["i"]): r["s"] for r in got.collect()}
    total = {}
    for g, i, x in uneven:
        total[g] = total.get(g, 0) + x
        assert found[(g, i)] == total[g]
    assert len(found) == len(uneven)


@pytest.mark.parametrize("size", [3, 1000])
def test_running_sum_over_everything(spark, size):
    df = spark.createDataFrame([(i, 1) for i in range(50)], "i BIGINT, x BIGINT")
    got = running_sum(df, [], "i", F.col("x"), "s", size=size).collect()
    assert {r["i"]: r["s"] for r in got} == {i: i + 1 for i in range(50)}


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_previous_row_crosses_chunks(spark, uneven, size):
    got = with_previous(frame(spark, uneven), "g", "i", "x", "p", size=size)
    found = {(r["g"], r["i"]): r["p"] for r in got.collect()}
    last = {}
    for g, i, x in uneven:
        assert found[(g, i)] == last.get(g)
        last[g] = x
    assert len(found) == len(uneven)


@pytest.mark.parametrize("size", [4, 1000])
def test_attach_keeps_every_row(spark, uneven, size):
    values = spark.createDataFrame([("g0", "a"), ("g2", "b")], "g STRING, v STRING")
    got = attach(frame(spark, uneven), values, ["g"], "i", size=size).collect()
    assert len(got) == len(uneven)
    assert all(r["v"] == {"g0": "a", "g2": "b"}.get(r["g"]) for r in got)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, uneven, how):
    left = frame(spark, uneven)
    right = spark.createDataFrame(
        [("g0", 1), ("g0", 2), ("g3", 3), (None, 4)], "g STRING, v BIGINT"
    )
    salted = salted_join(left, right, ["g"], ["i"], how)
    plain = left.join(right, ["g"], how)
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_salted_join_refuses_other_joins(spark, uneven):
    with pytest.raises(ValueError):
        salted_join(frame(spark, uneven), frame(spark, uneven), ["g"], ["i"], "full_outer")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_copies_are_not_broadcast(spark, uneven, how, capsys):
    """the copies of 900,000 videos were estimated as one and broadcast."""
    right = spark.createDataFrame([("g0", 1)], "g STRING, v BIGINT")
    salted_join(frame(spark, uneven), right, ["g"], ["i"], how).explain()
    assert "Broadcast" not in capsys.readouterr().out


@pytest.mark.parametrize("short", [0, 10])
def test_listed_join_equals_plain_join(spark, uneven, short, monkeypatch):
    monkeypatch.setattr("loquent.plans.skew.SHORT", short)
    left = frame(spark, uneven)
    right = spark.createDataFrame([("g0", 1), ("g0", 2), (None, 4)], "g STRING, v BIGINT")
    listed = listed_join(left, right, ["g"], ["i"])
    assert sorted(map(str, listed.collect())) == sorted(map(str, left.join(right, "g").collect()))


def test_entities_are_worked_out_once_for_their_ids(spark):
    """the join and aggregate below the ids ran three times."""
    rows = [("v", 1, "a", "ORG", 0), ("v", 9, "b", "ORG", 2)]
    schema = "video_id STRING, segment_id BIGINT, entity_text STRING, entity_type STRING, position BIGINT"
    placed = global_entity_ids(spark.createDataFrame(rows, schema))
    assert placed.inputFiles() and all("/entities/" in f for f in placed.inputFiles())
    assert [r["entity_id"] for r in placed.orderBy("segment_id").collect()] == [0, 1]


def test_distances_shuffle_texts_and_not_their_codes(spark, talk, capsys):
    """F11 to F14: every video's last term counts were gathered, and all were shuffled."""
    distances = adjacent_distance(talk, size=2)
    distances.explain("formatted")
    text = capsys.readouterr().out
    assert "max_by" not in text
    # The exchange before the windows comes below the codes: one reads texts.
    assert re.search(r"REPARTITION_BY_COL", text)
    whole = {r["segment_id"]: r["distance"] for r in adjacent_distance(talk).collect()}
    assert {r["segment_id"]: r["distance"] for r in distances.collect()} == whole


def test_rows_of_one_row_group_are_spread(spark, tmp_path):
    """a file with more splits than cores was taken to be spread already."""
    rows = spark.range(400).selectExpr(
        "id AS doc_id", "repeat(uuid(), 20) AS text", "'en' AS lang", "'web' AS source"
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        places = doc_transcripts(spark, str(tmp_path)).select(F.spark_partition_id()).distinct()
        assert places.count() >= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
