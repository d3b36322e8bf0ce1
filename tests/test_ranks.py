import random

import pyarrow as pa

from loquent.operators.extractive import DAMPING, ROUNDS, WINDOW, best_terms


def loop(words):
    """TextRank of one list, link by link."""
    links = {w: [] for w in words}
    for i, a in enumerate(words):
        for j in range(max(i - WINDOW, 0), min(i + WINDOW + 1, len(words))):
            if words[j] != a:
                links[a].append(words[j])
    ranks = dict.fromkeys(links, 1 / max(len(links), 1))
    for _ in range(ROUNDS):
        ranks = {
            w: (1 - DAMPING) / len(links) + DAMPING * sum(ranks[o] / len(links[o]) for o in own)
            for w, own in links.items()
        }
    return sorted(ranks.items(), key=lambda t: (-round(t[1], 9), t[0]))


def test_many_rows_are_ranked_as_one_by_one():
    """ranks are worked out for many rows at a time."""
    rng = random.Random(5)
    rows = [[], ["a"], ["a", "a"], ["é", "z", "é"]]
    rows += [[rng.choice("abcdefghij") * 3 for _ in range(n)] for n in (0, 2, 3, 40, 200)]
    for limit in (1, 4, 10):
        got = best_terms(pa.array(rows, pa.list_(pa.string())), limit).to_pylist()
        for row, found in zip(rows, got, strict=True):
            wanted = loop(row)[:limit]
            assert [f["term"] for f in found] == [w for w, _ in wanted]
            assert all(abs(f["rank"] - r) < 1e-12 for f, (_, r) in zip(found, wanted, strict=True))


def test_no_rows_and_parts_of_an_array():
    kind = pa.list_(pa.string())
    assert best_terms(pa.array([], kind), 3).to_pylist() == []
    assert best_terms(pa.array([[], []], kind), 3).to_pylist() == [[], []]
    part = pa.array([["x"], ["b", "c"], ["d"]], kind).slice(1)
    assert [[t["term"] for t in row] for row in best_terms(part, 3).to_pylist()] == [["b", "c"], ["d"]]
