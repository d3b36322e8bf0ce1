"""Patterns of a caller's own, beyond three tokens."""

from loquent.operators.entities import find_mentions

OWN = {"ORG": [r"^Bank of the North Sea$"]}


def found(spark, gazetteer, **more):
    schema = "video_id STRING, segment_id BIGINT, text STRING"
    rows = [("v", 1, "Ask Bank of the North Sea in May"), ("v", 2, "")]
    mentions = find_mentions(spark.createDataFrame(rows, schema), gazetteer, **more)
    return [(r.position, r.entity_text, r.entity_type) for r in mentions.collect()]


def test_own_patterns_do_not_depend_on_the_gazetteer(spark):
    schema = "phrase STRING, entity_type STRING"
    short = spark.createDataFrame([("nobody", "PERSON")], schema)
    long = spark.createDataFrame([("a b c d e f", "PERSON")], schema)
    for gazetteer in (None, short, long):
        assert found(spark, gazetteer, patterns=OWN) == [(1, "Bank of the North Sea", "ORG")]
        assert found(spark, gazetteer, patterns=OWN, pattern_words=4) == []


def hits(spark, text, gazetteer=None, **more):
    schema = "video_id STRING, segment_id BIGINT, text STRING"
    listed = spark.createDataFrame(gazetteer, "phrase STRING, entity_type STRING") if gazetteer else None
    rows = find_mentions(spark.createDataFrame([("v", 1, text)], schema), listed, **more).collect()
    return sorted((r.position, r.entity_text, r.entity_type) for r in rows)


def test_matches_know_their_tokens(spark):
    text = "2024, then March 5 2024; March 5 and 1999 again 2024"
    assert hits(spark, text) == [
        (0, "2024", "DATE"),
        (2, "March 5 2024", "DATE"),
        (5, "March 5", "DATE"),
        (8, "1999", "DATE"),
        (10, "2024", "DATE"),
    ]
    own = {"ORG": [r"Port \w+", r"\w+ Authority$"], "GPE": [r"^Port \w+"]}
    # Matches that only overlap both stay; equal spans keep all their types.
    assert hits(spark, "the Port Harbour Authority", patterns=own) == [
        (1, "Port Harbour", "GPE"),
        (1, "Port Harbour", "ORG"),
        (2, "Harbour Authority", "ORG"),
    ]
    assert hits(spark, "", patterns=own) == hits(spark, "x", patterns={"E": [r"x*y*z*"]})[1:] == []
    assert hits(spark, "Ports Porto", patterns={"GPE": ["Port"]}) == []


def test_the_gazetteer_is_walked_from_head_to_phrase(spark):
    listed = [
        ("sea", "GPE"),
        ("north sea", "GPE"),
        ("north sea bank", "ORG"),
        ("north sea bank of the far isles", "ORG"),
        ("north sea bank", "PRODUCT"),
        ("2024", "DATE"),
    ]
    assert hits(spark, "North Sea Bank of sea North Sea 2024", listed) == [
        (0, "North Sea Bank", "ORG"),
        (0, "North Sea Bank", "PRODUCT"),
        (4, "sea", "GPE"),
        (5, "North Sea", "GPE"),
        (7, "2024", "DATE"),
    ]
    whole = "the north sea bank of the far isles"
    assert hits(spark, whole, listed, patterns={}) == [(1, whole[4:], "ORG")]
    assert hits(spark, "nothing here", listed, patterns={}) == hits(spark, "x", patterns={}) == []
