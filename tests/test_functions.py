import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loquent.functions import metrics, reporting, text, urls, vectors

C = F.col


@pytest.mark.parametrize(
    "value, expected",
    [("", 0), (None, 0), ("  ", 0), ("a b", 2), (" a b\x1cc\n", 3)],
)
def test_word_count(one, value, expected):
    assert one(text.word_count(C("t")), "t STRING", value) == expected


def test_strip_cuts_all_white_space(one):
    assert one(text.strip(C("t")), "t STRING", " \n a b \x1f") == "a b"


def test_sentences_keep_punctuation_and_order(one):
    got = one(text.sentences(C("t")), "t STRING", " One. Two?  Three!\nv1.2 four ")
    assert got == ["One.", "Two?", "Three!", "v1.2 four"]
    assert one(text.sentences(C("t")), "t STRING", "") == []


@pytest.mark.parametrize(
    "seconds, shown", [(0.0, "0:00"), (59.9, "0:59"), (61.0, "1:01"), (7325.0, "122:05")]
)
def test_format_time(one, seconds, shown):
    assert one(text.format_time(C("s")), "s DOUBLE", seconds) == shown


def test_prefix_and_title(one):
    assert one(text.prefix(C("t"), 3), "t STRING", "abcdef") == "abc"
    assert one(text.prefix(C("t"), 3), "t STRING", None) == ""
    assert one(text.title_or_default(C("t")), "t STRING", "") == "(untitled)"
    assert one(text.title_or_default(C("t")), "t STRING", "x") == "x"


@pytest.mark.parametrize(
    "original, summary, ratio",
    [
        # Any white space parts words; only their number counts.
        ("salt\tfog\nkelp  tide", "x", 0.25),
        ("salt fog kelp", "salt-fog kelp", 2 / 3),
        ("one", "much longer than its one word", 6.0),
        ("salt fog", " \n ", 0.0),
        ("\u2003\n", "anything", None),
        (None, None, None),
    ],
)
def test_compression_ratio(one, original, summary, ratio):
    got = one(
        metrics.compression_ratio(C("o"), C("s")), "o STRING, s STRING", original, summary
    )
    assert got == (None if ratio is None else pytest.approx(ratio))


def similarity(one, a, b):
    return one(metrics.semantic_similarity(C("a"), C("b")), "a STRING, b STRING", a, b)


def test_semantic_similarity(one):
    assert similarity(one, "The cat sat", "the cat SAT.") > 0.99
    assert similarity(one, "the cat sat", "stocks fell sharply") < 0.5
    assert 0.5 < similarity(one, "the cat sat", "the cat ran") < 0.99
    assert similarity(one, "", "") == 1.0
    assert similarity(one, "", "word") == 0.0


def test_bag_cosine_equals_brute_force(spark):
    rng = random.Random(5)
    bags = [
        [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 30))] for _ in range(60)
    ]
    rows = [(bags[i], bags[(i + 1) % len(bags)]) for i in range(len(bags))]
    df = spark.createDataFrame(rows, "a ARRAY<STRING>, b ARRAY<STRING>")

    def expected(a, b):
        if not a or not b:
            return float(a == b)
        ca, cb = Counter(a), Counter(b)
        length = math.sqrt(sum(n * n for n in ca.values()))
        length *= math.sqrt(sum(n * n for n in cb.values()))
        return sum(ca[t] * cb[t] for t in ca) / length

    cosine = vectors.bag_cosine(vectors.bag(C("a")), vectors.bag(C("b")))
    got = df.select("a", "b", cosine.alias("c")).collect()
    for row in got:
        assert row["c"] == pytest.approx(expected(row["a"], row["b"]))


def test_dense_cosine(one):
    schema = "a ARRAY<FLOAT>, b ARRAY<FLOAT>"
    cosine = vectors.dense_cosine(C("a"), C("b"))
    assert one(cosine, schema, [1.0, 0.0], [1.0, 0.0]) == pytest.approx(1)
    assert one(cosine, schema, [1.0, 0.0], [0.0, 2.0]) == 0
    assert one(cosine, schema, [0.0, 0.0], [0.0, 2.0]) == 0


SCORES = "s ARRAY<STRUCT<sentence STRING, score DOUBLE>>, t STRING"


@pytest.mark.parametrize(
    "scores, target, expected",
    [
        # Of equal sentences the last counts, also between others.
        ([("Tar.", 3.0), ("Rope.", 1.5), ("Tar.", 0.25), ("Oil.", 9.0)], "Tar.", 0.25),
        # A part of a sentence, or more than it, is another sentence.
        ([("Tar and rope.", 1.0)], "Tar and", None),
        ([("Tar", 1.0)], "Tar and rope.", None),
        ([("tar.", 1.0)], "Tar.", None),
        # The target is trimmed, the keys are not; white space is no sentence.
        ([("Tar.", 1.0), ("Tar.\n", 2.0)], "\tTar.\n", 1.0),
        ([(" ", 1.0), ("", 2.0)], " ", None),
        ([("Tar.", 0.0)], "Tar.", 0.0),
        (None, "Tar.", None),
        ([("Tar.", 1.0)], None, None),
    ],
)
def test_textrank_lookup(one, scores, target, expected):
    assert one(metrics.textrank_lookup(C("s"), C("t")), SCORES, scores, target) == expected


def test_compute_all_routes_its_arguments(spark):
    df = spark.createDataFrame(
        [("a b c d", "a b.", "a b", [("a b.", 0.7)])],
        "o STRING, e STRING, a STRING, s ARRAY<STRUCT<sentence STRING, score DOUBLE>>",
    )
    computed = metrics.compute_all(C("o"), C("e"), C("a"), C("s"))
    row = df.select(*[c.alias(n) for n, c in computed.items()]).first()
    assert row["compression_ratio"] == 0.5
    assert row["semantic_similarity"] == pytest.approx(1)
    assert row["textrank_score"] == 0.7


@pytest.mark.parametrize(
    "url, allowed, is_list, video",
    [
        ("https://www.youtube.com/playlist?list=PLq9", True, True, None),
        ("https://www.youtube.com/watch?v=q7Zw01", True, False, "q7Zw01"),
        ("https://youtu.be/q7Zw01", True, False, "q7Zw01"),
        ("https://youtu.be/", True, False, None),
        ("https://www.youtube.com/watch", True, False, None),
        ("https://m.youtube.com/watch?a=1&v=x%20y&v=z", True, False, "x y"),
        ("https://example.com/video", False, False, None),
        ("https://notyoutube.com/watch?v=a", False, False, "a"),
        ("https://youtube.com.evil.org/?v=a", False, False, "a"),
        ("https://user:pw@YouTube.com:443/watch?v=&v=b#v=c", True, False, "b"),
        ("https://a_b.youtu.be/x/y", True, False, "x/y"),
        ("not a url", False, False, None),
        (None, False, False, None),
    ],
)
def test_url_parts(spark, url, allowed, is_list, video):
    row = (
        spark.createDataFrame([(url,)], "u STRING")
        .select(
            urls.host_allowed(C("u")).alias("allowed"),
            urls.is_list_url(C("u")).alias("is_list"),
            urls.video_id(C("u")).alias("video"),
        )
        .first()
    )
    assert (row["allowed"], row["is_list"], row["video"]) == (allowed, is_list, video)


@pytest.mark.parametrize(
    "url, ok, kind",
    [
        (" https://www.youtube.com/watch?v=abc ", True, "video"),
        ("https://youtu.be/abc", True, "video"),
        ("https://youtube.com/playlist?list=PL1", True, "playlist"),
        ("https://www.youtube.com/watch?v=abc&list=PL1", True, "playlist"),
        ("http://www.youtube.com/watch?v=abc", False, urls.WRONG_URL_MESSAGE),
        ("https://m.youtube.com/watch?v=abc", False, urls.WRONG_URL_MESSAGE),
        ("  ", False, urls.EMPTY_URL_MESSAGE),
        (None, False, urls.EMPTY_URL_MESSAGE),
    ],
)
def test_validate(one, url, ok, kind):
    assert one(urls.validate(C("u")), "u STRING", url) == (ok, kind)


def test_outcome_lines_round_trip(spark):
    df = spark.createDataFrame(
        [(1, 3, "id1", None), (2, 3, "id2", "boom"), (3, 3, None, None)],
        "position BIGINT, total BIGINT, video_id STRING, error STRING",
    )
    line = reporting.outcome_line(C("position"), C("total"), C("video_id"), C("error"))
    lines = df.select(line.alias("line"))
    assert [r["line"] for r in lines.collect()] == [
        "VIDEO_DONE 1/3 id1 ok",
        "VIDEO_DONE 2/3 id2 failed",
        "VIDEO_DONE 3/3 unknown ok",
    ]
    got = [tuple(r["o"]) for r in lines.select(reporting.parse_outcome(C("line")).alias("o")).collect()]
    assert got == [(1, 3, "id1", True), (2, 3, "id2", False), (3, 3, "unknown", True)]


def test_other_lines_are_no_outcomes(one):
    assert one(reporting.parse_outcome(C("l")), "l STRING", "VIDEO_DONE 1 of 2") is None


def test_report_lines(one):
    schema = "a STRING, b STRING, v BIGINT, s BIGINT"
    line = reporting.pair_line(C("a"), C("b"), C("v"), C("s"))
    assert one(line, schema, "A", "B", 2, 5) == "A <-> B: 2 videos, 5 segments"
    averages = reporting.averages_line(C("x"), C("y"))
    shown = one(averages, "x DOUBLE, y DOUBLE", 0.125, 0.5)
    assert shown == "Avg compression ratio: 0.12 · Avg semantic similarity: 0.50"
    shown = one(averages, "x DOUBLE, y DOUBLE", 0.375, 0.126)
    assert shown == "Avg compression ratio: 0.38 · Avg semantic similarity: 0.13"
    assert one(averages, "x DOUBLE, y DOUBLE", None, 0.5) == ""
    for x in (0.075, 0.145, 1.005, 2.675, -0.125, 0.004, 0.0, 9.995, 12.125, 20000.5):
        shown = one(averages, "x DOUBLE, y DOUBLE", x, x)
        assert shown == f"Avg compression ratio: {x:.2f} · Avg semantic similarity: {x:.2f}"


def test_only_texts_with_outer_space_meet_the_pattern(one):
    """word_count and strip looked at every inner space twice."""
    for said in ("", " ", "a", " a  b　", "\x1ca b", "a ", "​a", "a \n\n b\x85", "\n\t"):
        assert one(text.strip(F.col("t")), "t STRING", said) == said.strip()
        assert one(text.word_count(F.col("t")), "t STRING", said) == len(said.split())
    assert one(text.strip(F.col("t")), "t STRING", None) is None
    assert one(text.word_count(F.col("t")), "t STRING", None) == 0
