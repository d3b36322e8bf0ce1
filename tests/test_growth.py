"""Steps of the summaries that grew faster than they had to."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loquent.functions.metrics import textrank_lookup
from loquent.operators.abstractive import _central_sentence, main_terms


@pytest.fixture(scope="module")
def said():
    """Topics of several lengths in two videos, one of them null."""
    rng = random.Random(5)
    words = ["crate", "herring", "slate", "\u00e9tude", "\U0001d510agic", "\uffdcxyz", "harbour", "of"]
    rows = [
        (v, i, f"t{i // 7 if i < 40 else 6}", " ".join(rng.choices(words, k=rng.randrange(0, 9))))
        for v in ("v1", "v2", None)
        for i in range(90)
    ]
    return rows + [("v3", 1, "t0", None), ("v3", 2, "t1", "of"), ("v3", 3, None, "alone here")]


@pytest.mark.parametrize("size", [1, 8, 65_536])
@pytest.mark.parametrize("batch", [3, 10_000])
def test_main_terms_by_chunk_are_those_of_the_topic(spark, said, size, batch):
    """F7, F8, F9, F17: every term count of every topic was shuffled, twice."""
    counts = {}
    for video, segment, label, text in said:
        own = counts.setdefault((video, label or f"\0{segment}"), Counter())
        own.update(w.lower() for w in (text or "").split() if len(w) > 2)
    wanted = {
        key: [(i + 1, t, n) for i, (t, n) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[:3])]
        for key, c in counts.items()
        if c
    }
    rows = spark.createDataFrame(said, "video_id STRING, segment_id BIGINT, topic_label STRING, text STRING")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(batch))
    try:
        got = main_terms(rows, n_terms=3, size=size).collect()
    finally:
        spark.conf.set(setting, before)
    assert len(got) == len(wanted)
    assert {(r["video_id"], r["topic_key"]): [tuple(t) for t in r["main_terms"]] for r in got} == wanted


def test_terms_of_a_topic_stay_where_they_are_counted(spark, said, capsys):
    rows = spark.createDataFrame(said, "video_id STRING, segment_id BIGINT, topic_label STRING, text STRING")
    main_terms(rows).explain()
    assert capsys.readouterr().out.count("Exchange") == 1


def test_sentences_are_searched_for_terms_once(spark):
    """F7, F8, F9, F17: once for every main term."""
    main = F.array(F.struct(F.lit("fish").alias("term"), F.lit(2).cast("bigint").alias("n")))
    column = _central_sentence(F.col("text"), main)
    frame = spark.createDataFrame([("No. Fish come. Ships.",)], "text STRING").select(column.alias("b"))
    assert tuple(frame.first()["b"]) == (2, -1, "Fish come.")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    # Bound by a transform of its own, inside the one over the sentences.
    assert plan.count("transform(array(regexp_extract_all") == 1, plan


def test_target_is_trimmed_once(spark):
    """once for every sentence."""
    scores = F.array(*[F.struct(F.lit(s).alias("sentence"), F.lit(x).alias("score")) for s, x in (("a", 1.0), ("a", 2.0), ("", 3.0))])
    frame = spark.createDataFrame([(" a ",), ("",), ("b",), (None,)], "t STRING")
    got = [r["s"] for r in frame.select(textrank_lookup(scores, F.col("t")).alias("s")).collect()]
    assert got == [2.0, None, None, None]
