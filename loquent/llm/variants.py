"""Spelling variants by a trie of frequency vectors.

Letters fall into groups; a word's frequency vector counts its letters of each
group. Words stand in a trie whose levels are the successive counts. One inserted,
deleted or replaced letter adds one to at most one count and takes one from at most
one count, so a depth-first search from a word spends a surplus of one and a deficit
of one at most; only words at the leaves it reaches are compared letter by letter.
Of two words the one whose vector comes first makes the search, so that a surplus
is always spent before a deficit and every pair is found once.

The first levels of the trie part the words into shards, which go to separate
tasks; a word visits every shard that its budgets reach. Crowded shards are cut into
blocks of words and chunks of visitors, every block meeting every chunk. The groups
whose counts vary most make the first levels.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.session import write_out

#: Letter groups, and so levels of the trie: a letter's group is its code point
#: modulo this.
GROUPS = 12
#: Runs of so many code points at least; words seen so often at least.
SHORTEST = 7
SEEN = 2
#: Times that a form is at least as frequent as its variant.
TIMES = 10
#: One in so many runs of a document loses a code point.
SLIPS = 31
#: Words of a shard that the levels aim at, of a block, and visitors of a chunk.
SHARD = 5_000
BLOCK = 20_000
CHUNK = 50_000
#: Words a task counts before it hands them on, and pairs compared at once.
_HELD = 300_000
_PAIRS = 100_000
#: What a visitor may spend next, by what it has spent; 99 is never met.
_NEXT = np.array([1, -1, 99], np.int16)
#: Longer words are compared as strings, not as rows of a matrix.
_WIDE = 48


def slipped_words(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    slips: int = SLIPS,
) -> DataFrame:
    """(word, n): the words of all whole texts and how often they occur.

    Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z in lower case. Let h be
    the crc32 of ``<doc_id>:<run>``; where ``slips`` divides h, the code point at
    h % length is left out, as a writer's slip. A null text has none, a null
    identifier counts as ''. Repeated rows count each. Tasks add up what they
    read before anything is shuffled.
    """
    least = re.compile(f"[A-Za-zÀ-ÿ]{{{max(shortest, 1)},}}")

    def handed(held: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for name, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Lower-casing bytes leaves all letters beyond A-Z as they are.
                plain = value.encode().lower().decode()
                start = zlib.crc32(f"{'' if name is None else name}:".encode())
                for word, times in Counter(least.findall(plain)).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % slips == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < shortest:
                            continue
                    held[word] += times
                if len(held) >= _HELD:
                    yield handed(held)
                    held = Counter()
        if held:
            yield handed(held)

    own = docs.filter(F.col(text).isNotNull()).select(
        F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")
    )
    parts = own.mapInArrow(run, "word STRING, n LONG")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def vectors(words: list[str], order: Sequence[int]) -> np.ndarray:
    """The frequency vector of every word, one row each, groups in this order."""
    groups = len(order)
    lengths = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    places = np.repeat(np.arange(len(words)), lengths) * groups + points % groups
    counts = np.bincount(places, minlength=len(words) * groups).reshape(len(words), groups)
    kind = np.int16 if lengths.max(initial=0) < 1 << 15 else np.int64
    return counts[:, list(order)].astype(kind)


def level_order(words: DataFrame, groups: int = GROUPS) -> list[int]:
    """The letter groups by falling variance of their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = vectors(batch.column(0).to_pylist(), range(groups)).astype(float)
            sums = [pa.array(x) for x in (range(groups), [float(len(c))] * groups, c.sum(0), (c * c).sum(0))]
            yield pa.RecordBatch.from_arrays(sums, names=["i", "n", "s", "q"])

    parts = words.select("word").mapInArrow(run, "i LONG, n DOUBLE, s DOUBLE, q DOUBLE")
    variance = F.sum("q") / F.sum("n") - F.pow(F.sum("s") / F.sum("n"), F.lit(2))
    # One row for every group.
    rows = parts.groupBy("i").agg(F.round(variance, 9).alias("v")).collect()
    found = {r["i"]: r["v"] for r in rows}
    return sorted(range(groups), key=lambda g: (-(found.get(g) or 0.0), g))


def _reached(prefix: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Prefixes from this one on that a surplus and a deficit of one reach."""
    found = [prefix]
    for up in range(-1, len(prefix)):
        for down in range(-1, len(prefix)):
            if up != down and (down < 0 or prefix[down] > 0):
                moved = list(prefix)
                if up >= 0:
                    moved[up] += 1
                if down >= 0:
                    moved[down] -= 1
                if tuple(moved) > prefix:
                    found.append(tuple(moved))
    return found


def _name(prefix: tuple[int, ...]) -> str:
    return ".".join(map(str, prefix))


def _sharded(words: DataFrame, levels: int, order: Sequence[int]) -> DataFrame:
    """(word, n, shard, visits) of every word."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[int, ...], list[str]] = {}
        for frame in frames:
            counts = vectors(list(frame["word"]), order)[:, :levels]
            prefixes = [tuple(map(int, row)) for row in counts]
            for p in set(prefixes) - known.keys():
                known[p] = [_name(q) for q in _reached(p)]
            frame["shard"] = [_name(p) for p in prefixes]
            frame["visits"] = [known[p] for p in prefixes]
            yield frame
            if len(known) > _HELD // 10:
                known.clear()

    return words.select("word", "n").mapInPandas(
        run, "word STRING, n LONG, shard STRING, visits ARRAY<STRING>"
    )


def one_apart(a: str, b: str) -> bool:
    """Whether two words differ by one inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    low, high = 0, len(a)
    while low < high:  # the longest common start, by halving
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


class _Words:
    """Words of one group of rows with their vectors and letters."""

    def __init__(self, words: list[str], order: Sequence[int]):
        self.words = words
        self.counts = vectors(words, order)
        self.lengths = np.array([len(w) for w in words], np.int64)
        short = self.lengths <= _WIDE
        letters = "".join(w for w in words if len(w) <= _WIDE)
        points = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.where(short, self.lengths, 0)
        rows = np.repeat(np.arange(len(words)), sizes)
        first = np.cumsum(sizes) - sizes
        # One byte a letter, and no more columns, where the words need no more.
        kind = np.uint8 if points.max(initial=0) < 256 else np.uint32
        self.letters = np.zeros((len(words), _WIDE + 2), kind)
        self.letters[rows, np.arange(len(points)) - first[rows]] = points


def _verified(a: _Words, b: _Words, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """Which of the pairs (a[ia], b[ib]) are one code point apart."""
    left, right = a.lengths[ia], b.lengths[ib]
    gap = right - left
    near = np.zeros(len(ia), bool)
    wide = (left > _WIDE) | (right > _WIDE)
    width = min(_WIDE, int(max(left.max(initial=0), right.max(initial=0)))) + 1
    for k in np.flatnonzero(wide & (np.abs(gap) <= 1)):
        near[k] = one_apart(a.words[ia[k]], b.words[ib[k]])
    same = np.flatnonzero(~wide & (gap == 0))
    near[same] = (a.letters[ia[same], :width] != b.letters[ib[same], :width]).sum(1) == 1
    for sign, (x, ix), (y, iy) in ((1, (a, ia), (b, ib)), (-1, (b, ib), (a, ia))):
        some = np.flatnonzero(~wide & (gap == sign))
        short, long = x.letters[ix[some], :width], y.letters[iy[some], : width + 1]
        start = (short != long[:, :-1]).argmax(1)[:, None]
        after = np.arange(width)[None, :] >= start
        near[some] = ~((short != long[:, 1:]) & after).any(1)
    return near


def search(words: _Words, visitors: _Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, visitor) numbers of all pairs one code point apart, words of one
    vector both ways.

    Of two vectors the visitor's comes first or equals the word's. Depth first over the trie of
    ``words``: a node is a slice of the words in the order of their vectors and
    holds the visitors that can still reach it, each with what it has spent: 0
    nothing, 1 the surplus, 2 the deficit as well.
    """
    order = np.lexsort(words.counts.T[::-1])
    counts = words.counts[order]
    levels = counts.shape[1]
    nobody = np.zeros(len(visitors.words), np.int8)
    stack = [(0, len(order), 0, np.arange(len(visitors.words)), nobody)]
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def compared() -> tuple[np.ndarray, np.ndarray]:
        left = np.concatenate([k[0] for k in kept])
        right = np.concatenate([k[1] for k in kept])
        near = _verified(words, visitors, left, right)
        return left[near], right[near]

    while stack:
        low, high, level, who, spent = stack.pop()
        if high - low == 1 and level < levels:
            # One word is left: all its other counts at once.
            who = _fitting(counts[low, level:], visitors.counts[who, level:], who, spent)
            level = levels
        if level == levels:
            # At most _PAIRS pairs at a time, however full a leaf is.
            step = max(1, _PAIRS // (high - low))
            for at in range(0, len(who), step):
                some = who[at : at + step]
                kept.append((np.repeat(order[low:high], len(some)), np.tile(some, high - low)))
                size += len(kept[-1][0])
                if size >= _PAIRS:
                    yield compared()
                    kept, size = [], 0
            continue
        here = counts[low:high, level]
        cuts = (np.flatnonzero(here[1:] != here[:-1]) + (low + 1)).tolist()
        own = visitors.counts[who, level]
        for a, b in zip([low, *cuts], [*cuts, high]):
            change = counts[a, level] - own
            # Nothing changes, or the next thing is spent: the surplus, the deficit.
            can = np.flatnonzero((change == 0) | (change == _NEXT[spent]))
            if len(can):
                left = who[can], spent[can] + (change[can] != 0).astype(np.int8)
                stack.append((a, b, level + 1, *left))
    if kept:
        yield compared()


def _fitting(word: np.ndarray, own: np.ndarray, who: np.ndarray, spent: np.ndarray) -> np.ndarray:
    """The visitors whose other counts fit one word's."""
    change = word[None, :] - own
    size = np.abs(change).sum(1)
    some = np.flatnonzero(size <= 2 - spent)
    change, size, spent = change[some], size[some], spent[some]
    first = change[np.arange(len(some)), (change != 0).argmax(1)]
    total = change.sum(1)
    fits = (size == 0) | (
        np.where(spent == 1, (size == 1) & (total == -1), (first == 1) & (total == 2 - size))
    )
    return who[some[fits]]


def near_pairs(words: DataFrame, groups: int = GROUPS) -> DataFrame:
    """(a, na, b, nb): every pair of near words once, with their numbers.

    ``words`` has (word, n), one row per word, and should be a written table.
    """
    total = words.count()
    levels = min(groups, max(1, math.ceil(math.log(max(total / SHARD, 1), 3))))
    order = level_order(words, groups)
    placed = write_out(_sharded(words, levels, order), "shards")
    sizes = placed.groupBy("shard").agg(F.count("*").alias("held"))
    visits = placed.select(F.explode("visits").alias("at"))
    visits = visits.groupBy("at").agg(F.count("*").alias("come")).withColumnRenamed("at", "shard")
    plan = sizes.join(visits, "shard").select(
        F.col("shard").alias("at"),
        F.ceil(F.col("held") / BLOCK).alias("blocks"),
        F.ceil(F.col("come") / CHUNK).alias("chunks"),
    )
    plan = write_out(plan, "plan")

    def dealt(parts: str) -> Column:
        return F.pmod(F.xxhash64("word"), F.col(parts))

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))

    held = placed.withColumnRenamed("shard", "at").join(plan, "at")
    held = held.select("at", dealt("blocks").alias("block"), every("chunks").alias("chunk"), "word", "n")
    come = placed.select(F.explode("visits").alias("at"), "word", "n").join(plan, "at")
    come = come.select(
        F.col("at").alias("to"),
        every("blocks").alias("of"),
        dealt("chunks").alias("part"),
        F.col("word").alias("visitor"),
        F.col("n").alias("times"),
    )

    def meet(name: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            words_, visitors = _Words(list(left["word"]), order), _Words(list(right["visitor"]), order)
            for ia, ib in search(words_, visitors):
                # Words of one vector meet both ways; the smaller one's visit counts.
                same = (words_.counts[ia] == visitors.counts[ib]).all(1)
                once = [
                    not s or visitors.words[j] < words_.words[i] for s, i, j in zip(same, ia, ib)
                ]
                ia, ib = ia[once], ib[once]
                found.append(
                    pd.DataFrame(
                        {
                            "a": right["visitor"].to_numpy()[ib],
                            "na": right["times"].to_numpy()[ib],
                            "b": left["word"].to_numpy()[ia],
                            "nb": left["n"].to_numpy()[ia],
                        }
                    )
                )
        return pd.concat(found) if found else pd.DataFrame({"a": [], "na": [], "b": [], "nb": []})

    return held.groupBy("at", "block", "chunk").cogroup(come.groupBy("to", "of", "part")).applyInPandas(
        meet, "a STRING, na LONG, b STRING, nb LONG"
    )


def _followed(forms: DataFrame) -> DataFrame:
    """(word, root): the last form of each word that has one.

    A form is ``TIMES`` times as frequent as its word, so chains are short; every
    round doubles the steps followed.
    """
    now = write_out(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = write_out(moved, "roots")
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def variants(
    words: DataFrame, seen: int = SEEN, times: int = TIMES, groups: int = GROUPS
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word seen ``seen`` times.

    ``words`` has (word, n). Rows that repeat a word are added up; a null word, or
    a null n, is left out. Two words are near if they differ by exactly one
    inserted, deleted or replaced code point. A word's form is its near word of
    largest n (ties: the smallest in code-point order), if that is at least
    ``times`` its own n; ``root`` follows forms to the last. An empty table gives
    no rows.
    """
    known = words.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    known = write_out(known.filter(F.col("n") >= seen), "vocabulary")
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n")),
    )
    links = near_pairs(known, groups).select(F.inline(both))
    best = links.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    best = best.select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")
    )
    joined = known.join(best, "word", "left")
    fits = F.col("near_n") >= times * F.col("n")
    named = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("near")).alias("form"),
        F.when(fits, F.col("near_n")).alias("form_n"),
    )
    named = write_out(named, "forms")
    roots = _followed(named.filter("form IS NOT NULL"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
