import itertools
import math
import random
import re
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loquent.operators import abstractive, cooccurrence, entities, extractive, graph, ids
from loquent.operators import topics

SEGMENT = "video_id STRING, segment_id BIGINT, text STRING"


def by_id(df, column):
    return {r["segment_id"]: r[column] for r in df.collect()}


# --- topics -----------------------------------------------------------------


def vectors(spark, *rows, video="v"):
    return spark.createDataFrame(
        [(video, i, v) for i, v in rows],
        "video_id STRING, segment_id BIGINT, vec ARRAY<FLOAT>",
    )


#: Small turns, a right angle after id 12, a smaller one after id 30.
TURNS = [(11, 0), (12, 5), (20, 95), (30, 97), (44, 130), (45, 133)]


@pytest.mark.parametrize(
    "k, starts", [(-0.2, {20, 44}), (0.5, {20}), (1.5, {20}), (1.8, set())]
)
def test_topics_start_where_the_turn_passes_the_threshold(spark, k, starts):
    rows = [(i, [math.cos(math.radians(a)), math.sin(math.radians(a))]) for i, a in TURNS]
    turns = [1 - math.cos(math.radians(b - a)) for (_, a), (_, b) in zip(TURNS, TURNS[1:])]
    limit = statistics.mean(turns) + k * statistics.stdev(turns)
    assert {i for (i, _), t in zip(TURNS[1:], turns) if t > limit} == starts
    labels = by_id(topics.segment_topics(vectors(spark, *rows), k=k, embedding="vec"), "topic_label")
    number = 0
    for i, _ in TURNS:
        number += i in starts
        assert labels[i] == f"topic_{number}"


@pytest.mark.parametrize("count", [0, 1, 2])
def test_few_segments_never_split(spark, count):
    rows = [(i, [float(i), 1.0]) for i in range(count)]
    got = topics.segment_topics(vectors(spark, *rows), k=0.0, embedding="vec")
    assert by_id(got, "topic_label") == {i: "topic_0" for i in range(count)}


def test_each_video_has_its_own_threshold_and_numbering(spark):
    rng = random.Random(2)
    parts = [
        vectors(spark, *[(i, [rng.random(), rng.random()]) for i in range(20)], video=v)
        for v in ("a", "b")
    ]
    together = topics.segment_topics(parts[0].unionByName(parts[1]), embedding="vec")
    for video, part in zip("ab", parts):
        alone = by_id(topics.segment_topics(part, embedding="vec"), "topic_label")
        mine = together.filter(F.col("video_id") == video)
        assert by_id(mine, "topic_label") == alone


def test_chunks_do_not_change_topics(spark):
    rng = random.Random(4)
    words = "sun moon star sky rain wind cloud snow".split()
    rows = [
        ("v", i, " ".join(rng.choices(words, k=rng.randrange(0, 6)))) for i in range(60)
    ]
    df = spark.createDataFrame(rows, SEGMENT)
    whole = by_id(topics.segment_topics(df, k=0.5), "topic_label")
    assert by_id(topics.segment_topics(df, k=0.5, size=7), "topic_label") == whole
    numbers = [int(whole[i].removeprefix("topic_")) for i in range(60)]
    assert numbers[0] == 0 and max(numbers) > 0
    assert all(b - a in (0, 1) for a, b in zip(numbers, numbers[1:]))


# --- extractive -------------------------------------------------------------


def reference_ranks(text):
    """TextRank by plain loops."""
    words = re.findall(r"[^\W\d_]{3,}", text.lower())
    weight = Counter()
    for i, a in enumerate(words):
        for b in words[i + 1 : i + 4]:
            if a != b:
                weight[a, b] += 1
                weight[b, a] += 1
    names = sorted(set(words))
    leaving = {a: sum(w for (x, _), w in weight.items() if x == a) for a in names}
    rank = {a: 1 / len(names) for a in names}
    for _ in range(10):
        rank = {
            a: 0.15 / len(names)
            + 0.85
            * sum(rank[b] * w / leaving[b] for (b, x), w in weight.items() if x == a)
            for a in names
        }
    return rank


def test_ranks_match_plain_loops(spark, talk):
    got = talk.select("text", extractive.ranked_terms(F.col("text")).alias("r")).collect()
    for row in got:
        expected = reference_ranks(row["text"])
        assert [t["term"] for t in row["r"]] == sorted(expected)
        for term in row["r"]:
            assert term["rank"] == pytest.approx(expected[term["term"]])


def test_ranks_of_odd_texts(spark):
    texts = ["", "ab cd", "word word word", "word", "one two"]
    df = spark.createDataFrame([("v", i, t) for i, t in enumerate(texts)], SEGMENT)
    got = by_id(df.select("segment_id", extractive.ranked_terms(F.col("text")).alias("r")), "r")
    assert [len(got[i]) for i in range(5)] == [0, 0, 1, 1, 2]
    assert got[4][0]["rank"] == pytest.approx(0.5)


def test_one_summary_per_segment_taken_from_its_sentences(spark, talk):
    rows = extractive.extractive_summary(talk).collect()
    assert len(rows) == 6
    for row in rows:
        sentences = [s["sentence"] for s in row["sentence_scores"]]
        if row["segment_id"] == 2:
            assert row["summary"] == "" and sentences == []
        else:
            assert row["summary"] in sentences
            best = max(s["score"] for s in row["sentence_scores"])
            first = next(s for s in row["sentence_scores"] if s["score"] == best)
            assert row["summary"] == first["sentence"]


def test_single_sentence_is_its_own_summary(spark, talk):
    row = extractive.extractive_summary(talk.filter("segment_id = 3")).first()
    assert row["summary"] == "Mira Holt keeps the ledger of every catch."
    assert len(row["sentence_scores"]) == 1


def test_text_without_terms_gives_its_first_sentence(spark):
    df = spark.createDataFrame([("v", 0, "A b. C d.")], SEGMENT)
    row = extractive.extractive_summary(df).first()
    assert row["summary"] == "A b."
    assert [s["score"] for s in row["sentence_scores"]] == [0.0, 0.0]


def test_extractive_needs_no_shuffle(spark, talk):
    plan = extractive.extractive_summary(talk)._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()


# --- entities ---------------------------------------------------------------


@pytest.fixture
def names(spark):
    return spark.createDataFrame(
        [
            ("mira holt", "PERSON"),
            ("holt", "GPE"),
            ("otto lind", "PERSON"),
            ("herring", "PRODUCT"),
            ("winter", "SEASON"),
        ],
        "phrase STRING, entity_type STRING",
    )


def test_entities_of_the_talk(spark, talk, names):
    rows = entities.extract_entities(talk, names).collect()
    found = {(r["segment_id"], r["entity_text"], r["entity_type"]) for r in rows}
    assert found == {
        (3, "Mira Holt", "PERSON"),
        (4, "herring", "PRODUCT"),
        (4, "Otto Lind", "PERSON"),
        (4, "Mira Holt", "PERSON"),
    }
    assert len(rows) == len(found)


def test_first_mention_order(spark, talk, names):
    rows = entities.extract_entities(talk.filter("segment_id = 4"), names).collect()
    ordered = [r["entity_text"] for r in sorted(rows, key=lambda r: r["position"])]
    assert ordered == ["herring", "Otto Lind", "Mira Holt"]


def test_patterns_and_types(spark):
    df = spark.createDataFrame(
        [("v", 0, "On 2024-05-01, or May 3 1999; in 2020 not 20201. Acme")], SEGMENT
    )
    both = spark.createDataFrame(
        [("acme", "ORG"), ("acme", "PERSON")], "phrase STRING, entity_type STRING"
    )
    rows = entities.extract_entities(df, both).collect()
    assert {(r["entity_text"], r["entity_type"]) for r in rows} == {
        ("2024-05-01", "DATE"),
        ("May 3 1999", "DATE"),
        ("2020", "DATE"),
        ("Acme", "ORG"),
        ("Acme", "PERSON"),
    }


def test_phrases_of_any_length(spark):
    text = "On January 5 2024 the Old Salt Harbour Board met"
    df = spark.createDataFrame([("v", 0, text)], SEGMENT)
    board = spark.createDataFrame(
        [("old salt harbour board", "ORG"), ("harbour", "GPE")],
        "phrase STRING, entity_type STRING",
    )
    found = {r["entity_text"] for r in entities.extract_entities(df, board).collect()}
    assert found == {"January 5 2024", "Old Salt Harbour Board"}


def test_global_ids_do_not_meet_when_local_ids_have_gaps(spark):
    rows = [("a", i) for i in (0, 5)] + [("b", i) for i in range(1, 4)] + [("c", 0)]
    df = spark.createDataFrame(rows, "video_id STRING, segment_id BIGINT")
    found = [r["segment_id"] for r in ids.global_segment_ids(df, size=2).collect()]
    assert len(set(found)) == len(rows)


def test_no_gazetteer_and_no_patterns(spark, talk):
    assert entities.extract_entities(talk, patterns={}).count() == 0


# --- abstractive ------------------------------------------------------------


def topic_rows(spark):
    return spark.createDataFrame(
        [
            ("v", 1, "a b c", "topic_0"),
            ("v", 2, "", "topic_0"),
            ("v", 3, "d e f g", "topic_0"),
            ("v", 4, "x", "topic_1"),
            ("v", 5, "", "topic_2"),
            ("v", 6, "own", None),
            ("v", 7, "self", None),
            ("w", 1, "other", "topic_0"),
        ],
        SEGMENT + ", topic_label STRING",
    )


@pytest.mark.parametrize("size", [2, 1000])
def test_topic_text(spark, size):
    rows = abstractive.topic_text(topic_rows(spark), size=size).collect()
    texts = {(r["video_id"], r["topic_key"]): r["topic_text"] for r in rows}
    assert texts[("v", "topic_0")] == "a b c\nd e f g"
    assert texts[("v", "topic_1")] == "x" and texts[("w", "topic_0")] == "other"
    assert ("v", "topic_2") not in texts
    assert sorted(texts.values()) == ["a b c\nd e f g", "other", "own", "self", "x"]


def test_summary_without_terms_is_the_first_sentence(spark):
    got = abstractive.topic_summary(topic_rows(spark)).collect()
    summaries = {(r["video_id"], r["segment_id"]): r["summary"] for r in got}
    assert summaries == {
        ("v", 1): "a b c",
        ("v", 2): "a b c",
        ("v", 3): "a b c",
        ("v", 4): "x",
        ("v", 5): "",
        ("v", 6): "own",
        ("v", 7): "self",
        ("w", 1): "other",
    }


def test_summary_has_most_of_the_main_terms_of_the_whole_topic(spark):
    rows = [
        ("v", 1, "Hello there. Nothing yet.", "topic_0"),
        ("v", 70_000, "The harbour floods. We go on!", "topic_0"),
        ("v", 140_000, "Every harbour floods when the harbour wall breaks. Well.", "topic_0"),
        ("v", 140_001, "A wall is a wall. Harbour walls, harbour floods.", "topic_0"),
        ("v", 140_002, None, "topic_1"),
        ("v", 140_003, "12 34. 56", "topic_2"),
    ]
    schema = "video_id STRING, segment_id LONG, text STRING, topic_label STRING"
    segments = spark.createDataFrame(rows, schema)
    # harbour 5, floods 3, wall 3, the 2; all others once, in order of the term.
    main = {r["topic_key"]: r["main_terms"] for r in abstractive.main_terms(segments).collect()}
    assert [(t["term"], t["n"]) for t in main["topic_0"]][:4] == [
        ("harbour", 5), ("floods", 3), ("wall", 3), ("the", 2),
    ]
    assert len(main["topic_0"]) == 10 and "topic_2" not in main
    per_topic = {r["topic_key"]: r["summary"] for r in abstractive.central_summary(segments).collect()}
    assert per_topic == {
        "topic_0": "Every harbour floods when the harbour wall breaks.",
        "topic_1": "",
        "topic_2": "12 34.",
    }
    few = abstractive.topic_summary(segments, n_terms=1, size=2).collect()
    # With the term harbour alone, the first sentence that has it.
    assert {r["summary"] for r in few if r["segment_id"] <= 140_001} == {"The harbour floods."}


def test_tree_of_partial_summaries(spark):
    rows = [("v", i, f"w{i}", "topic_0") for i in range(40)]
    rows += [("v", 100, "alone", "topic_1"), ("v", 101, None, "topic_2")]
    rows += [("w", 5 * i, f"bad{i}" if i == 7 else f"x{i}", "topic_0") for i in range(9)]
    schema = "video_id STRING, segment_id LONG, text STRING, topic_label STRING"
    segments = spark.createDataFrame(rows, schema)

    def short(batches):
        for b in batches:
            body = b["prompt"].str.split("\n\n", n=1).str[1]
            if body.str.contains("bad").any():
                raise ValueError("refused")
            assert (body.str.count("\n") < 3).all()
            told = "[" + body.str.replace("\n", " ") + "]"
            yield b[["video_id", "topic_key"]].assign(summary=told)

    def first_word(batches):
        for b in batches:
            yield b[["video_id", "topic_key"]].assign(summary=b["prompt"].str[:1])

    by_topic = {(r["video_id"], r["topic_key"]): r for r in abstractive.tree_summary(
        segments, short, block=3, fan_in=3).collect()}
    whole = by_topic["v", "topic_0"]
    assert whole["error"] is None
    # Every text once, in order, at most three to a prompt: four levels.
    assert whole["summary"].replace("[", "").replace("]", "").split() == [f"w{i}" for i in range(40)]
    assert whole["summary"].startswith("[[[[w0 w1 w2] [w3 w4 w5] [w6 w7 w8]]")
    assert by_topic["v", "topic_1"]["summary"] == "[alone]"
    assert by_topic["v", "topic_2"]["summary"] == "[]"
    assert by_topic["w", "topic_0"]["summary"] is None
    assert by_topic["w", "topic_0"]["error"] == "ValueError: refused"
    spread = abstractive.topic_summary(segments, summarise=first_word, block=50)
    assert spread.count() == len(rows)
    with pytest.raises(ValueError):
        abstractive.tree_summary(segments, short, block=0)


def test_topic_words_count_the_whole_topic(spark):
    rows = abstractive.topic_words(topic_rows(spark)).collect()
    counts = {(r["video_id"], r["topic_key"]): r["original_words"] for r in rows}
    assert counts[("v", "topic_0")] == 7 and counts[("v", "topic_2")] == 0


def test_hook_gets_one_prompt_per_topic(spark):
    def describe(batches):
        for b in batches:
            text = b["prompt"].str.len().astype(str) + ":" + b["prompt"]
            yield b[["video_id", "topic_key"]].assign(summary=text)

    got = abstractive.topic_summary(
        topic_rows(spark), summarise=describe, instruction="Do it."
    )
    summaries = {(r["video_id"], r["segment_id"]): r["summary"] for r in got.collect()}
    assert summaries[("v", 1)] == summaries[("v", 3)] == (
        f"{len('Do it.') + 2 + 13}:Do it.\n\na b c\nd e f g"
    )
    assert summaries[("v", 5)] == "8:Do it.\n\n"
    assert summaries[("v", 6)].endswith("own")


# --- pairs and graph --------------------------------------------------------

ENTITY = "segment_id BIGINT, video_id STRING, entity_text STRING, entity_type STRING"


def test_two_types_of_one_text_make_no_pair(spark):
    df = spark.createDataFrame(
        [(1, "v", "Acme", "ORG"), (1, "v", "Acme", "PERSON")], ENTITY
    )
    assert cooccurrence.co_occurrences(df).count() == 0


@pytest.mark.parametrize("block", [1, 3, 256])
def test_pairs_match_brute_force(spark, block):
    rng = random.Random(8)
    rows = []
    for segment in range(30):
        # One segment names far more entities than the others.
        count = 40 if segment == 7 else rng.randrange(0, 6)
        for _ in range(count):
            rows.append((segment, f"v{segment % 4}", f"e{rng.randrange(25):02d}", "ORG"))
    texts = defaultdict(set)
    for segment, video, text, _ in rows:
        texts[segment, video].add(text)
    segments, videos = Counter(), defaultdict(set)
    for (_, video), names in texts.items():
        for pair in itertools.combinations(sorted(names), 2):
            segments[pair] += 1
            videos[pair].add(video)
    got = cooccurrence.co_occurrences(spark.createDataFrame(rows, ENTITY), block=block)
    found = {
        (r["entity_a"], r["entity_b"]): (r["video_count"], r["segment_count"])
        for r in got.collect()
    }
    assert found == {p: (len(videos[p]), n) for p, n in segments.items()}


def test_support_and_top_pairs(spark):
    pairs = spark.createDataFrame(
        [("a", "b", 1, 9), ("a", "c", 2, 5), ("a", "d", 3, 5), ("b", "c", 2, 7)],
        "entity_a STRING, entity_b STRING, video_count BIGINT, segment_count BIGINT",
    )
    top = cooccurrence.top_pairs(cooccurrence.with_support(pairs), 2).collect()
    assert [(r["entity_a"], r["entity_b"]) for r in top] == [("b", "c"), ("a", "c")]
    lines = cooccurrence.pair_lines(pairs.limit(1)).first()["line"]
    assert lines == "a <-> b: 1 videos, 9 segments"


def test_graph_upserts(spark):
    mentions = spark.createDataFrame(
        [(1, "v", "a", "ORG"), (2, "v", "a", "GPE"), (1, "v", "b", "ORG")], ENTITY
    )
    old = spark.createDataFrame(
        [("a", "DATE"), ("z", "DATE")], "entity_text STRING, entity_type STRING"
    )
    nodes = graph.graph_nodes(mentions, old)
    assert {tuple(r) for r in nodes.collect()} == {
        ("a", "GPE"),
        ("b", "ORG"),
        ("z", "DATE"),
    }
    schema = "entity_a STRING, entity_b STRING, video_count BIGINT, segment_count BIGINT"
    pairs = spark.createDataFrame([("a", "b", 2, 3), ("a", "q", 1, 1)], schema)
    before = spark.createDataFrame([("a", "b", 1, 1), ("a", "z", 4, 4)], schema)
    merged = graph.graph_edges(pairs, nodes, before)
    assert {tuple(r) for r in merged.collect()} == {("a", "b", 2, 3), ("a", "z", 4, 4)}
    replaced = graph.graph_edges(pairs, nodes, before, replace=True)
    assert {tuple(r) for r in replaced.collect()} == {("a", "b", 2, 3)}
    triples = graph.graph_triples(nodes, merged).collect()
    assert {tuple(r) for r in triples} == {
        ("a", "GPE", "b", "ORG", 2, 3),
        ("a", "GPE", "z", "DATE", 4, 4),
    }


# --- ids --------------------------------------------------------------------


@pytest.mark.parametrize("size", [2, 1000])
@pytest.mark.parametrize("position", [None, "position"])
def test_segment_ids_are_dense_and_keep_videos_together(spark, size, position):
    sizes = {"a": 5, "b": 1, "c": 9, "d": 3}
    rows = [
        (v, 10 - p, i, f"{v}{i}")
        for p, (v, n) in enumerate(sizes.items())
        for i in range(n)
    ]
    df = spark.createDataFrame(
        rows, "video_id STRING, position BIGINT, segment_id BIGINT, text STRING"
    )
    got = ids.global_segment_ids(df, position=position, start=100, size=size).collect()
    assert sorted(r["segment_id"] for r in got) == list(range(100, 118))
    ordered = [r["text"] for r in sorted(got, key=lambda r: r["segment_id"])]
    for video, n in sizes.items():
        first = ordered.index(f"{video}0")
        assert ordered[first : first + n] == [f"{video}{i}" for i in range(n)]
    if position:
        assert ordered[:3] == ["d0", "d1", "d2"]


@pytest.mark.parametrize("size", [2, 1000])
def test_entity_ids(spark, size):
    rows = [(100 + i, "v", t, "ORG", p) for i in range(5) for p, t in ((4, "b"), (9, "a"))]
    df = spark.createDataFrame(rows, ENTITY + ", position BIGINT")
    got = ids.global_entity_ids(df, start=50, size=size).collect()
    ordered = sorted(got, key=lambda r: r["entity_id"])
    assert [r["entity_id"] for r in ordered] == list(range(50, 60))
    assert [r["entity_text"] for r in ordered] == ["b", "a"] * 5
    assert [r["segment_id"] for r in ordered] == [100 + i // 2 for i in range(10)]


def test_max_id_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "segment_id BIGINT")
    assert ids.max_id(empty, "segment_id").first()["max_id"] == -1
    assert ids.next_id(empty, "segment_id") == 0


def test_list_position(spark):
    rows = [("x", i * 3, str(i)) for i in range(7)] + [("y", 5, "only")]
    df = spark.createDataFrame(rows, "list_id STRING, entry_index BIGINT, url STRING")
    got = ids.list_position(df, size=4).collect()
    found = {(r["list_id"], r["url"]): (r["position"], r["total"]) for r in got}
    assert found[("y", "only")] == (1, 1)
    assert all(found[("x", str(i))] == (i + 1, 7) for i in range(7))
