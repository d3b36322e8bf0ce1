"""Operators against brute force on small fixtures, and their edge cases."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loquent.llm import (
    bpe,
    exact,
    katz,
    langid,
    mixing,
    pii,
    quality,
    simhash,
    toxicity,
    warc,
)

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, extra STRING"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
TEXTS = [
    (1, "One two three four five"),
    (2, "one TWO three four five"),
    (3, None),
    (4, ""),
    (5, "É é one"),
    (5, "É é one"),
    (None, "one two three four five"),
    (7, LONG),
    (8, "  \n\t "),
    (9, "a@b.co 1.2.3.4 4111 1111 1111 1111 +1 (555) 123-4567"),
]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "en", "s", 0, "x") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return (text or "").encode().lower().decode()


def test_exact_duplicates(docs, none):
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[lower(t)].append(i)
    got = exact.exact_duplicates(docs, largest=True).collect()
    want = Counter()
    for ids in groups.values():
        best = max((i for i in ids if i is not None), default=None)
        want.update((i, best, len(ids), i == best) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == want
    assert exact.exact_duplicates(none).count() == 0
    kept = exact.drop_exact_duplicates(docs, largest=True)
    assert kept.columns == docs.columns
    assert Counter(lower(r.text) for r in kept.collect()) == Counter(list(groups))


def simple_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints():
    for _, t in TEXTS:
        assert simhash.fingerprint(t) == simple_fingerprint(t)


def test_masks_cover_every_pair_within_the_radius():
    masks = [m & simhash._FULL for m in simhash.covering_masks()]
    rng = random.Random(1)
    for _ in range(2000):
        flipped = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(flipped & m == 0 for m in masks)
        mask = rng.choice(masks)
        while finer := simhash.finer_masks(simhash._signed(mask)):
            inside = flipped & ~mask
            assert any(inside & m == 0 for m in finer)
            mask = rng.choice(finer) & simhash._FULL


@pytest.mark.parametrize("small", [512, 3])
def test_near_links_join_the_same_classes_as_brute_force(spark, small):
    rng = random.Random(5)
    fps = set()
    for _ in range(12):
        seed = rng.getrandbits(64)
        for _ in range(10):
            for b in rng.sample(range(64), rng.randint(0, 2)):
                seed ^= 1 << b
            fps.add(seed)
    fps = sorted(fps)
    root = {f: f for f in fps}
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 3 and root[a] != root[b]:
                old, new = root[a], root[b]
                root = {f: new if r == old else r for f, r in root.items()}
    frame = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp LONG")
    links = simhash.near_links(frame, small=small).collect()
    assert all(((r.a ^ r.b) & simhash._FULL).bit_count() <= 3 for r in links)
    own = {f: f for f in fps}
    for r in links:
        old, new = own[r.a & simhash._FULL], own[r.b & simhash._FULL]
        own = {f: new if x == old else x for f, x in own.items()}
    parts = lambda d: {frozenset(f for f in fps if d[f] == v) for v in d.values()}
    assert parts(own) == parts(root)


def test_near_duplicates(docs, none):
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert {(1, 1), (2, 1), (None, 1), (3, 3), (4, 3), (8, 3), (5, 5), (7, 7)} <= found
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 7, 9]
    assert kept.columns == docs.columns


def test_bpe_equals_the_library(docs, none):
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(bpe.default_path())
    own = bpe.tokenizer(bpe.default_path())
    rng = random.Random(2)
    pieces = ["a", "the", " ", "  ", "\n", "ä", "漢", "🙂", "'s", "22", "!!", "-", "<|endoftext|>", "\x85"]
    for _ in range(800):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == theirs.decode(ids, skip_special_tokens=False) == text
    trips = bpe.round_trip(docs).collect()
    assert all(
        r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() for r in trips
    )
    back = bpe.decode_column(bpe.encode_column(docs).drop("text"))
    assert Counter(r.text for r in back.collect()) == Counter(t or "" for _, t in TEXTS)
    assert bpe.round_trip(none).count() == 0


def test_quality_figures_and_rules(docs, none):
    assert quality.repeated_words("a b c a b c x".split()) == 6
    assert quality.repeated_words("a a a a".split()) == 4
    assert quality.repeated_words("a b c d".split()) == 0
    assert quality.figures("a\n a\na\n\n\n#|") == (4, 5, 2, 1, 0, 0, 3, 0, 4)
    assert quality.with_figures(none).count() == 0
    assert {r.n_words for r in quality.with_figures(docs).collect()} >= {0, 5, 30_000}
    rng = random.Random(4)
    rows = []
    for i in range(600):
        row = {k: rng.random() for k in quality.RATES}
        row["bad"] = int(i % 3 == 0)
        row["symbols_per_word"] = 0.7 + rng.random() if row["bad"] else 0.5 * rng.random()
        rows.append(row)
    rules = quality.learn(rows)
    hit = lambda r: any(all(c.holds(r) for c in rule) for rule in rules)
    assert [hit(r) for r in rows] == [bool(r["bad"]) for r in rows]
    assert quality.learn([]) == []


def brute_spans(text):
    def card(hit):
        d = [int(c) for c in hit if c.isdigit()][::-1]
        total = sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(d))
        return 13 <= len(d) <= 19 and total % 10 == 0

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda h: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda h: all(int(x) < 256 for x in h.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", card),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda h: 9 <= sum(c.isdigit() for c in h) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m[0])]


def test_personal_data(spark, docs, none):
    rng = random.Random(9)
    parts = ["a@b.co", "_", "@", ".", "x", "1.2.3.4", "999", "4111 1111 1111 1111", "+", "(", ")", " ", "-", "é", "🙂", "4", "12", "\n", "a.b@c-d.e.f"]
    texts = ["".join(rng.choice(parts) for _ in range(25)) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, None), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    for r in pii.find_personal(frame).collect():
        assert [tuple(s) for s in r.base] == brute_spans(r.text or "")
        assert set(map(tuple, r.base)) <= set(map(tuple, r.found))
    assert pii.find_personal(none).count() == 0
    nine = pii.find_personal(docs).filter("doc_id = 9").first()
    assert [tuple(s) for s in nine.base] == brute_spans(nine.text)


def test_targets_and_flow(spark, docs, none):
    assert list(map(int, mixing.targets([10, 100, 100], [5, 2, 1]))) == [30, 120, 60]
    flow = mixing.route([(frozenset("a"), 10), (frozenset("ab"), 10)], {"a": 30, "b": 10})
    assert sum(v for (_, s), v in flow.items() if s == "b") == 10
    assert sum(v for (_, s), v in flow.items() if s == "a") == 30
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "b", None])) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")
    found = mixing.mix(frame).collect()
    assert found == mixing.mix(frame).collect() or sorted(map(str, found)) == sorted(map(str, mixing.mix(frame).collect()))
    source = {i: s for i, _, s in rows}
    taken, target = Counter(), {}
    for r in found:
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - t) <= 60 for s, t in target.items())
    assert mixing.mix(none).count() == 0
    assert mixing.mix(docs).count() == len(TEXTS)
    assert mixing.take_mix(docs).columns == docs.columns


def test_mixing_of_any_number_of_sources(spark):
    rng = random.Random(3)
    rows = [
        (i, f"s{i % 6000:05d}" if i % 6000 else None, "w " * rng.randint(0, 9))
        for i in range(14_000)
    ]
    rows += [(20_000 + i, "s00001", "w " * rng.randint(1, 60)) for i in range(5_000)]
    frame = spark.createDataFrame(rows, "doc_id LONG, source STRING, text STRING")
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    names = sorted(sizes, key=lambda s: (s is None, s))
    weights = [(5, 2, 1)[i % 3] for i in range(len(names))]
    wanted = dict(zip(names, mixing.targets([sizes[s] for s in names], weights), strict=True))
    taken, source_of = dict.fromkeys(names, 0), {i: s for i, s, _ in rows}
    found = mixing.mix(frame).collect()
    assert len(found) == len(rows)
    for r in found:
        source = source_of[r["doc_id"]]
        taken[source] += r["taken"]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(float(wanted[source]), rel=1e-12)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
    # Nine words at most to a document; the large source has many to choose from.
    assert all(abs(taken[s] - wanted[s]) <= 9 for s in names)
    assert abs(taken["s00001"] - wanted["s00001"]) <= 1


def test_mixing_fills_the_gap_behind_a_long_document(spark):
    rows = [(i, "a", "w " * (5_000 if i % 20 == 3 else 7 + i % 11)) for i in range(200)]
    rows += [(1_000 + i, "b", "w " * 40) for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id LONG, source STRING, text STRING")
    found = mixing.mix(frame).collect()
    for low, high in ((0, 999), (1_000, 9_999)):
        own = [r for r in found if low <= r["doc_id"] <= high]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 40


def test_mixing_of_overlapping_sources(spark):
    rows = [(i, ["a"], "w " * 10) for i in range(30)]
    rows += [(100 + i, ["b", "a"], "w " * 10) for i in range(30)]
    rows += [(200 + i, ["c"], "w " * 10) for i in range(30)]
    rows += [(300, [], "w w"), (301, None, "w"), (302, [None], "w")]
    frame = spark.createDataFrame(rows, "doc_id LONG, held ARRAY<STRING>, text STRING")
    found = {r["doc_id"]: r for r in mixing.mix(frame, sources=F.col("held")).collect()}
    assert len(found) == len(rows)
    # 904 words; a holds 600, b 300, c 300, no source 4 of weight 5, at most 12.
    shares = mixing.targets([600, 300, 300, 4], [5, 2, 1, 5], total=904)
    want = dict(zip("abcn", map(float, shares), strict=True))
    assert found[0]["target"] == found[100]["target"] == pytest.approx(want["a"])
    assert found[200]["target"] == pytest.approx(want["c"])
    assert {found[i]["source_size"] for i in (300, 301, 302)} == {4}
    total = sum(r["taken"] for i, r in found.items() if i < 200)
    assert abs(total - want["a"] - want["b"]) <= 10
    assert sum(found[i]["taken"] for i in (300, 301, 302)) == 12


def test_katz_sums_to_one_and_equals_brute_force(spark, docs, none):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 30)))) for i in range(80)]
    rows += [(None, None), (80, "zz Zz a")]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    held = F.coalesce(F.col("doc_id"), F.lit(0)) % 4 == 0
    got = katz.score(frame, held, block_bytes=200, shard_tokens=100).collect()
    assert len(got) == len(rows)
    tokens = {i: [*lower(t).split(), None] for i, t in rows}
    one, two = Counter(), Counter()
    for i, t in tokens.items():
        if (i or 0) % 4:
            one.update(t)
            two.update(zip(["<s>", *t], t))
    n = sum(one.values())
    many = lambda c: [sum(v == k for v in c.values()) for k in range(1, 7)]
    d1, d2 = katz.discounts(many(one)), katz.discounts(many(two))
    d = lambda t, c: t[c - 1] if c <= 5 else 1.0
    left = sum((1 - d1[r - 1]) * r * m for r, m in enumerate(many(one)[:5], 1))
    scale, lost = (1.0, left / n) if left else (n / (n + 1), 1 / (n + 1))
    p1 = lambda w: scale * d(d1, one[w]) * one[w] / n if one[w] else lost
    follow = defaultdict(dict)
    for (h, w), c in two.items():
        follow[h][w] = c

    def p2(h, w):
        own, c = follow[h], one[None] if h == "<s>" else one[h]
        small = [x for x in own.values() if x <= 5]
        aside = h == "<s>" or not small
        if w in own:
            return d(d2, own[w]) * own[w] / (c + aside)
        mass = (sum((1 - d(d2, x)) * x for x in small) + aside) / (c + aside)
        return mass / (1 - sum(map(p1, own))) * p1(w)

    for h in ["<s>", "a", "zz"]:
        assert math.isclose(sum(p2(h, w) for w in [*one, "unknown"]), 1)
    for r in got:
        t = tokens[r.doc_id]
        want = sum(math.log10(p2(h, w)) for h, w in zip(["<s>", *t], t))
        assert math.isclose(r.score, want, rel_tol=1e-9)
        assert r.train_tokens == n and r.n_known == sum(one[w] > 0 for w in t)
    assert katz.score(none, F.col("doc_id") == 0).count() == 0
    assert katz.score(docs, F.lit(True)).count() == len(TEXTS)


def test_language(spark, docs, none):
    rng = random.Random(6)
    make = {"x": "abcde", "y": "fghij", "z": "äöüß"}
    rows = [
        (k, " ".join("".join(rng.choice(a) for _ in range(5)) for _ in range(30)))
        for k, a in make.items()
        for _ in range(30)
    ]
    model = langid.fit([(t, k) for k, t in rows[::2]])
    frame = spark.createDataFrame(rows + [("und", None), ("und", "123 -")], "want STRING, text STRING")
    found = langid.predict(frame, model).collect()
    assert all(r.want == r.lang_pred and 0 <= r.score <= 1 for r in found)
    assert langid.predict(none, model).count() == 0
    assert langid.predict(docs, langid.fit([])).filter("lang_pred <> 'und'").count() == 0
    a, b = (set(langid.presence(t).tolist()) for t in ("one", "one one"))
    assert a <= b and len(a) == 3 + 4 + 3


def test_toxicity(spark, docs, none):
    rng = random.Random(7)
    common = ["".join(rng.choice("aeioustrnlm") for _ in range(6)) for _ in range(400)]
    rows = []
    for i in range(240):
        words = [rng.choice(common) for _ in range(60)]
        if i % 3 == 0:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["zorkwex", "vuxqab", "kyxzzig"])
        rows.append((" ".join(words), int(i % 3 == 0)))
    model = toxicity.fit(rows[:160])
    frame = spark.createDataFrame(rows[160:], "text STRING, want INT")
    found = toxicity.score(frame, model).collect()
    assert np.mean([(r.score >= 0.5) == r.want for r in found]) > 0.9
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.drop_toxic(none, model).columns == none.columns
    assert toxicity.drop_toxic(docs, toxicity.fit([])).count() == len(TEXTS)


def test_archives(spark, tmp_path):
    rows = [(1, "u", "aa"), (2, "u\r\nX: y", "aa"), (2, "u", "aa"), (3, None, None), (None, "v", "aa"), (5, "z", LONG), (6, "z", "é" * 9)]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING").withColumn("payload", F.lit(1))
    path = str(tmp_path / "a")
    warc.write_pages(pages, path)
    found = warc.read_archives(spark, path, verify="true").filter("record_type <> 'warcinfo'").collect()
    assert len(found) == len(rows)
    for r in found:
        page = r.record_id.removeprefix("urn:page:")
        html = next((h or "") for i, _, h in rows if str(i) == page or (i is None and page == "null"))
        assert r.payload_bytes == len(html.encode())
        assert r.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        again = html == "aa" and page != "1"
        assert r.record_type == ("revisit" if again else "response")
        assert r.refers_to == ("urn:page:1" if again else None)
        assert again or bytes(r.payload) == html.encode()
    few = warc.read_archives(spark, path).filter("record_type = 'revisit'")
    assert few.count() == 3
    empty = str(tmp_path / "b")
    warc.write_pages(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).filter("record_type = 'response'").count() == 0
    plain = tmp_path / "c"
    plain.mkdir()
    record = warc.record("urn:x", "http://e/", None, b"body\r\n\r\nmore")
    (plain / "x.warc").write_bytes(record * 3)
    assert [bytes(r.payload) for r in warc.read_archives(spark, str(plain)).collect()] == [b"body\r\n\r\nmore"] * 3


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = out.collect()
    assert rows and max(Counter(r.doc_id for r in rows).values()) <= 3
    assert all(r.decoded_sha256 == hashlib.sha256(source[r.doc_id].encode()).hexdigest() for r in rows)


def test_pipeline_stages_equal_brute_force(spark):
    import corpus_pipeline
    from tokenizers import Tokenizer

    from loquent.llm.queries import toxicity_model
    from loquent.session import write_out

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity_model(spark, folder, docs)
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        made = write_out(stage(spark, outputs[-1] if outputs else docs, folder), name)
        outputs.append(made)
    assert all(o.columns == docs.columns for o in outputs[:-1])
    ids = [Counter(r.doc_id for r in o.select("doc_id").collect()) for o in outputs]
    texts = {r.doc_id: r.text for r in docs.collect()}

    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(scores) == len(texts)
    assert ids[0] == Counter(i for i in texts if scores[i] < 0.5)

    copies = defaultdict(list)
    for i in ids[0]:
        copies[lower(texts[i])].append(i)
    assert ids[1] == Counter(max(same) for same in copies.values())

    prints = {i: simple_fingerprint(texts[i]) for i in ids[1]}
    group = {i: i for i in prints}
    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 3 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    assert ids[2] == Counter(set(group.values()))

    source = {r.doc_id: r.source for r in docs.collect()}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", texts[i] or "")) for i in ids[2]}
    names = sorted({source[i] for i in ids[2]}, key=lambda s: (s is None, s or ""))
    own = [sum(size[i] for i in ids[2] if source[i] == s) for s in names]
    weights = [(5, 2, 1)[k % 3] for k in range(len(names))]
    wanted = mixing.targets(own, weights)
    assert max(ids[3].values()) <= 3 and set(ids[3]) <= set(ids[2])
    for s, target in zip(names, wanted, strict=True):
        taken = sum(size[i] * n for i, n in ids[3].items() if source[i] == s)
        assert abs(taken - target) <= max(size[i] for i in ids[2] if source[i] == s)

    whole = Tokenizer.from_file(bpe.default_path())
    whole.no_truncation()
    whole.no_padding()
    got = outputs[-1].collect()
    assert Counter(r.doc_id for r in got) == ids[3]
    for r in got:
        want = whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        raw = np.array(want, dtype="<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(raw).hexdigest())
        decoded = whole.decode(want, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    again = corpus_pipeline.run(spark, folder).collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in got)


CLASHING = (
    "row STRUCT<a:INT>, text STRING, doc_id LONG, source STRING, _fp STRING, _known STRING, "
    "_none STRING, _digest STRING, _bytes STRING, _check STRING, target STRING, last STRING, "
    "turns STRING, _size STRING, _order STRING, _turn STRING, _pattern STRING, sources STRING, "
    "_copies STRING, _toxicity STRING, `a.b` STRING, keep_id STRING, fp STRING"
)


def test_stages_keep_columns_of_any_name(spark):
    names = [f.name for f in spark.createDataFrame([], CLASHING).schema]
    rows = [((1,), f"words of text {i}", i, "s", *["mine"] * (len(names) - 4)) for i in (1, 2)]
    frame = spark.createDataFrame(rows, CLASHING)
    model = toxicity.Model(b"", b"", 0.0, (-6.0, 0.0, 0.0, 0.0))
    for made in (
        exact.drop_exact_duplicates(frame),
        simhash.drop_near_duplicates(frame),
        mixing.take_mix(frame),
        toxicity.drop_toxic(frame, model),
    ):
        assert made.schema.names == names
        got = Counter(tuple(r) for r in made.collect())
        assert got and set(got) <= {tuple(r) for r in frame.collect()}
        assert made.limit(0).count() == 0
