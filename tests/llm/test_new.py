"""Whitening, the quality classifier and spelling variants against brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from loquent.llm import classifier, queries, variants, whitening

SMALL = "/root/testdata/sf0.01"

# --- whitening ---------------------------------------------------------------


def vectors_frame(spark, rows):
    schema = "vec_id LONG, embedding ARRAY<FLOAT>, row STRING, vector STRING, deviation STRING"
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], schema).repartition(3)


def some_vectors(size=5, n=40):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(k, 1 + k) for k in range(size)]) for i in range(n)]
    return [*rows, *rows[:3]]


def test_whitening_equals_brute_force(spark):
    good = some_vectors()
    broken = [
        (90, None),
        (91, [1.0, None, 0.0, 0.0, 0.0]),
        (92, [math.nan, 0.0, 0.0, 0.0, 0.0]),
        (93, [0.0, 0.0, 0.0, 0.0, -math.inf]),
        (94, []),
        (95, [1.0, 2.0]),
    ]
    frame = vectors_frame(spark, good + broken)
    model = whitening.fit(frame)
    x = np.array([[math.floor(64 * float(np.float32(v))) + 1_000_000 for v in r] for _, r in good])
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    spread = centred.T @ centred / n
    values = np.linalg.eigvalsh(spread)[::-1]
    assert (model.n, model.sums) == (n, tuple(sums))
    assert np.allclose(model.values, values)
    assert np.allclose(spread @ model.vectors, model.vectors * model.values)
    assert sum(model.shares(5)) == pytest.approx(1)
    assert whitening.identity_error(frame, model) < 1e-9
    found = whitening.whiten(frame, model)
    assert found.schema["row"].dataType.names == frame.columns
    got = defaultdict(list)
    for r in found.collect():
        got[r["row"]["vec_id"]].append((int(r["deviation"]), r["whitened"]))
    assert {k: len(v) for k, v in got.items()} == Counter(i for i, _ in good)
    deviation = ((n * x - sums) ** 2).sum(1)
    whitened = centred @ model.vectors / np.sqrt(model.values)
    for (i, _), d, w in zip(good, deviation, whitened, strict=True):
        for exact, projected in got[i]:
            assert exact == d and np.allclose(projected, w)
    kept = whitening.whiten(frame, model, components=2, keep=["vec_id"]).first()
    assert kept["row"].asDict().keys() == {"vec_id"} and len(kept["whitened"]) == 2


def test_polarised_covariance_is_exact():
    rng = random.Random(5)
    x = [[rng.randrange(10**6) for _ in range(4)] for _ in range(9)]
    n, sums = len(x), tuple(sum(r[i] for r in x) for i in range(4))
    z = [[v - s // n for v, s in zip(r, sums)] for r in x]
    pairs = [sum((r[i] + r[j]) ** 2 for r in z) for i in range(4) for j in range(i + 1, 4)]
    got = whitening.covariance(
        n, sums, [sum(c) for c in zip(*z)], [sum(v * v for v in c) for c in zip(*z)], pairs
    )
    for i in range(4):
        for j in range(4):
            want = sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x)
            assert got[i, j] == float(Fraction(want, n**3))


def test_whitening_without_variance_rows_or_bounds(spark):
    nothing = vectors_frame(spark, [(1, None)])
    assert whitening.fit(nothing) is None
    assert whitening.whiten(nothing, None).count() == 0
    same = vectors_frame(spark, [(i, [1.0, 2.0, float(i % 2)]) for i in range(4)])
    model = whitening.fit(same)
    assert whitening.identity_error(same, model) < 1e-9
    row = whitening.whiten(same, model).first()
    assert abs(row["whitened"][0]) == pytest.approx(1) and row["whitened"][1:] == [None, None]
    flat = vectors_frame(spark, [(1, [3.0, 4.0])])
    model = whitening.fit(flat)
    assert whitening.identity_error(flat, model) == 0 and model.shares(2) == [0, 0]
    assert whitening.whiten(flat, model).first()["whitened"] == [None, None]
    huge = vectors_frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 4.0])])
    model = whitening.fit(huge)
    assert model.n == 3 and whitening.whiten(huge, model).count() == 3


def test_op11_returns_every_component(spark):
    rows = queries.QUERIES["op11_whitening"](spark, "/root/testdata/sf0.001")
    assert rows.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ]
    assert rows.count() == 500 * 32 and rows.filter("identity_error > 0.0001").count() == 0


# --- quality classifier --------------------------------------------------------


def codes(text):
    return classifier.indicators(text)


def test_indicators_are_presence_and_shapes():
    assert list(codes("")) == []
    assert set(codes("Und Und")) == set(codes("Und Und")) and len(codes("a")) == 2
    # Words of one shape give the same shape n-grams; a repeat is marked.
    high = {c for c in codes("Ab cd") if c >> np.uint64(63)}
    assert high == {c for c in codes("Xyz efgh") if c >> np.uint64(63)}
    assert high != {c for c in codes("cd cd") if c >> np.uint64(63)}
    long = "word " * 40_000
    assert len(codes(long)) < 40


def test_descent_meets_the_optimum_conditions():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 4))
    y = np.where(x @ [1, -2, 0.5, 0] + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    prices = np.full(60, 0.7)
    rows = [(np.arange(4), r) for r in x]
    w, bias = classifier.descend(rows, y, prices, 4, rounds=3_000)

    def loss(v, b):
        return (v @ v + b * b) / 2 + (prices * np.maximum(0, 1 - y * (x @ v + b))).sum()

    best = loss(w, bias)
    for _ in range(200):
        step = rng.normal(size=5) * 10.0 ** rng.uniform(-4, 0)
        assert loss(w + step[:4], bias + step[4]) >= best - 1e-3


def test_classifier_fits_one_class_no_rows_and_ties():
    assert classifier.fit([]).height == 0
    assert classifier.fit([(codes("a"), 1)] * 3).height > 0 > classifier.fit([(codes("a"), 0)]).height
    tied = classifier.fit([(codes("a b"), k) for k in (0, 1)] * 6)
    z = tied.slope * classifier.margin(codes("a b"), tied) + tied.height
    assert abs(z) < 1
    rows = [(codes(f"good text {i}"), 1) for i in range(20)]
    rows += [(codes(f"bad$$$ text%%% {i}"), 0) for i in range(20)]
    once, again = classifier.fit(rows), classifier.fit(rows[::-1])
    assert once.bias == again.bias and (once.weights == again.weights).all()
    assert classifier.margin(codes("fine text"), once) > classifier.margin(codes("odd$$$"), once)


def test_sample_keeps_to_clear_labels(spark):
    docs = spark.createDataFrame(
        [(1, "one"), (2, None), (3, "x"), (4, "y"), (5, "z"), (5, "a"), (None, "n"), (7, "w " * 50_000)],
        "doc_id LONG, text STRING",
    )
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 0), (3, 0), (3, 1), (4, None), (5, 1), (None, 1), (7, 0), (9, 1), (4, 2)],
        "doc_id LONG, quality INT",
    )
    got = classifier.sample(docs, labels, F.lit(True))
    want = [("one", 1), ("", 0), ("a", 1), ("w " * 50_000, 0)]
    assert sorted((g.tobytes(), y) for g, y in got) == sorted((codes(t).tobytes(), y) for t, y in want)
    few = classifier.sample(docs, labels, F.lit(True), grams=4)
    assert sorted(len(g) for g, _ in few) == sorted(min(4, len(codes(t))) for t, _ in want)
    assert {c for g, _ in few for c in g} <= {c for g, _ in got for c in g}
    assert len(classifier.sample(docs, labels, F.lit(True), rows=1)) == 2
    assert classifier.sample(docs, labels.limit(0), F.lit(True)) == []


def test_scores_on_rows_of_all_kinds(spark):
    model = classifier.fit(
        [(codes(f"good text {i}"), 1) for i in range(20)]
        + [(codes(f"bad$$$ text%%% {i}"), 0) for i in range(20)]
    )
    frame = spark.createDataFrame(
        [(1, None, "k"), (2, "", "k"), (3, "x " * 100_000, "k"), (4, "good text", "k"), (4, "good text", "k")],
        "doc_id LONG, text STRING, score STRING",
    )
    rows = classifier.score(frame, model).collect()
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add(r.score)
        assert 0 <= r.score <= 1
    assert len(rows) == 5 and all(len(s) == 1 for s in by_id.values()) and by_id[1] == by_id[2]
    assert classifier.score(frame.limit(0), model).count() == 0


def test_op12_learns_from_its_rows_and_is_right_on_others(spark):
    rows = queries.QUERIES["op12_quality_classifier"](spark, SMALL).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(y == p for y, p in held) / len(held) >= 0.97


# --- spelling variants -----------------------------------------------------------


def near_brute(words):
    near = defaultdict(set)
    for a in words:
        for b in words:
            if a != b and abs(len(a) - len(b)) <= 1 and simple_distance(a, b) == 1:
                near[a].add(b)
    return near


def simple_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def random_words(n, seed=1):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(n)}
    words |= {w + "x" * 60 for w in list(words)[: n // 10]}
    return sorted(words)


@pytest.mark.parametrize("shard, block, chunk", [(2_000, 20_000, 100_000), (5, 7, 11)])
def test_near_pairs_equal_brute_force(spark, monkeypatch, shard, block, chunk):
    monkeypatch.setattr(variants, "SHARD", shard)
    monkeypatch.setattr(variants, "BLOCK", block)
    monkeypatch.setattr(variants, "CHUNK", chunk)
    words = random_words(150)
    rng = random.Random(4)
    counts = {w: rng.choice([1, 2, 3, 40, 500, 9000]) for w in words}
    rows = [(w, n) for w, n in counts.items()] + [(None, 5), ("gone", None)]
    rows += [(words[0], 7)]
    counts[words[0]] += 7
    frame = spark.createDataFrame(rows, "word STRING, n LONG")
    got = {r.word: r for r in variants.variants(frame).collect()}
    known = {w: n for w, n in counts.items() if n >= 2}
    near = near_brute(known)
    assert got.keys() == known.keys()
    form = {}
    for w, n in known.items():
        top = min(near[w], key=lambda v: (-known[v], v), default=None)
        form[w] = top if top is not None and known[top] >= 10 * n else None
    for w, r in got.items():
        root = w
        while form[root]:
            root = form[root]
        want = (form[w], root, known[w], len(near[w]), known.get(form[w]))
        assert (r.form, r.root, r.n, r.n_near, r.form_n) == want
    assert any(form.values()) and any(form[f] for f in form.values() if f)


def test_one_apart_on_long_words():
    long = "ab" * 50_000
    assert variants.one_apart(long, long[:70_000] + long[70_001:])
    assert variants.one_apart(long, "x" + long[1:]) and variants.one_apart(long, long + "x")
    assert not variants.one_apart(long, long) and not variants.one_apart("ab", "ba")
    assert not variants.one_apart("abc", "a")


def test_words_slip_by_document(spark):
    texts = [(i, f"Letterhead Straße ÀÉÎÕÜÝÞ it's éclairant{i} Seven77 letters") for i in range(40)]
    texts += [(None, "Letterhead letterhead"), (3, texts[3][1]), (5, None), (6, ""), (7, "z" * 60_000)]
    frame = spark.createDataFrame(texts, "doc_id LONG, text STRING").repartition(3)
    want = Counter()
    slips = 0
    for i, t in texts:
        run = ""
        for c in (t or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
                continue
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if run and h % 31 == 0:
                run, slips = run[: h % len(run)] + run[h % len(run) + 1 :], slips + 1
            if len(run) >= 7:
                want[run] += 1
            run = ""
    got = {r.word: r.n for r in variants.slipped_words(frame).collect()}
    assert got == want and slips > 0
    assert variants.slipped_words(frame.limit(0)).count() == 0
    assert variants.variants(variants.slipped_words(frame.limit(0))).count() == 0
