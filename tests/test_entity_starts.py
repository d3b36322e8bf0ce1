"""Which tokens leave the first join with the gazetteer."""

from loquent.operators.entities import find_mentions


def test_only_first_tokens_of_phrases_are_cut_out(spark, capsys):
    """F10, F16, F18: runs were cut from every token before any join."""
    schema = "video_id STRING, segment_id BIGINT, text STRING"
    text = "Blue Fin tuna in 1999, not blue whale nor BLUE. Tuna in May 5 2001 or 2010-02-03x"
    listed = spark.createDataFrame(
        [("blue fin tuna", "ORG"), ("blue", "GPE"), ("tuna", "PRODUCT"), (" x", "ORG"), ("", "ORG"), (None, "ORG")],
        "phrase STRING, entity_type STRING",
    )
    rows = spark.createDataFrame([("v", 1, text), ("v", 2, None), ("v", 3, "")], schema)
    found = find_mentions(rows, listed)
    got = sorted((r["segment_id"], r["position"], r["entity_text"], r["entity_type"]) for r in found.collect())
    assert got == [
        (1, 0, "Blue Fin tuna", "ORG"),
        (1, 4, "1999", "DATE"),
        (1, 6, "blue", "GPE"),
        (1, 9, "BLUE", "GPE"),
        (1, 10, "Tuna", "PRODUCT"),
        (1, 12, "May 5 2001", "DATE"),
    ]
    found.explain()
    assert "/firsts" in capsys.readouterr().out or any("/firsts" in f for f in found.inputFiles())
