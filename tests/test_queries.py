"""Entry points, and some queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, difference

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "co_occurrences",
    "extract_entities",
    "global_segment_ids",
    "json_segments",
    "sentence_scores",
    "topic_segments_dense",
    "topic_timeline_capped",
    "url_video_id",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_its_sql():
    from workloads.oracles import ORACLES
    from workloads.queries import QUERIES

    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert len(got) > 0
    assert difference(got, want) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
