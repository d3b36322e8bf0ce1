"""Scores of texts under a Katz back-off model of word pairs.

A token's probability after a history h is, recursively:

    p(w | h) = d(c) c(h w) / c(h)        if the pair was seen c = c(h w) > 0 times
             = alpha(h) p(w)             else
    p(w)     = d(c) c(w) / N             if the word was seen c = c(w) > 0 times
             = b                         else, all unseen words being one outcome

d are Good-Turing discounts (1 above five occurrences); alpha(h) and b are what
makes each distribution sum to one exactly.

The work is dealt over blocks of documents and shards of n-grams. A block (some
megabytes of text) holds its distinct words once, as hashes, and its tokens as
places in that list, so a word or pair travels once per block however often it
occurs. Shards add up the blocks' counts and answer with what a block or a
document needs. Word tables are written by shard. Pairs are sharded by
history; a history with over a thousandth of all tokens is spread over all shards
by its next word, and its few sums are put together at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.llm.common import whole
from loquent.session import write_out

#: Bytes of text in a block, and tokens of training per shard, about.
BLOCK_BYTES = 10 << 20
SHARD_TOKENS = 2 << 20
#: Good-Turing: counts above this are taken as they are.
RELIABLE = 5
#: A history with more than this share of all tokens is spread by its next word.
HOT_SHARE = 1e-3
#: Stand-ins for the start and the end of a text among word hashes.
START, END = np.uint64(1), np.uint64(2)
_SEED = 42

BLOCK = (
    "block STRING, docs LONG, ids BINARY, known BINARY, held BINARY, lengths BINARY,"
    " keys BINARY, counts BINARY, totals BINARY, stream BINARY"
)


def pack(values: np.ndarray) -> bytes:
    """Numbers in as few bytes as zstandard makes of them, byte planes apart."""
    values = np.ascontiguousarray(values)
    if values.dtype.kind in "ui" and len(values):
        top = int(values.max())
        if values.min() >= 0:
            for kind in ("u1", "u2", "u4"):
                if top < 1 << (8 * np.dtype(kind).itemsize):
                    values = values.astype(kind)
                    break
    size = values.dtype.itemsize
    planes = values.view(np.uint8).reshape(-1, size).T if len(values) else values.view(np.uint8)
    body = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())
    return values.dtype.name.encode() + b"|" + len(values).to_bytes(8, "little") + body


def unpack(data: bytes) -> np.ndarray:
    kind, _, rest = bytes(data).partition(b"|")
    n = int.from_bytes(rest[:8], "little")
    dtype = np.dtype(kind.decode())
    raw = zstandard.ZstdDecompressor().decompress(rest[8:], max_output_size=max(1, n * dtype.itemsize))
    planes = np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def word_hashes(text: str) -> list[int]:
    digest = xxhash.xxh64_intdigest
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return [digest(w, _SEED) for w in words]


def _by_count(counts: np.ndarray) -> np.ndarray:
    """Places of the counts, largest count first."""
    return np.argsort(-counts.astype(np.int64), kind="stable")


def _block(name: str, docs: list[tuple]) -> dict:
    lengths = np.array([len(h) for _, _, h in docs], np.int64)
    held = np.array([h for _, h, _ in docs], bool)
    streams = [np.concatenate([h, [END]]) for _, _, h in docs]
    tokens = np.concatenate(streams)
    keys, stream = np.unique(tokens, return_inverse=True)
    training = np.repeat(~held, lengths + 1)
    counts = np.bincount(stream[training], minlength=len(keys))
    totals = np.bincount(stream)
    # Tokens are places in the order of frequency, which makes them short.
    places = np.empty(len(keys), np.uint32)
    places[_by_count(totals)] = np.arange(len(keys), dtype=np.uint32)
    ids = np.array([0 if i is None else i for i, _, _ in docs], np.int64)
    return {
        "block": name,
        "docs": len(docs),
        "ids": ids.tobytes(),
        "known": pack(np.array([i is not None for i, _, _ in docs], np.uint8)),
        "held": pack(held.astype(np.uint8)),
        "lengths": pack(lengths + 1),
        "keys": keys.tobytes(),
        "counts": pack(counts),
        "totals": pack(totals),
        "stream": pack(places[stream]),
    }


def encode_blocks(docs: DataFrame, held: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of documents (doc_id, text), tokens as places among the block's words."""
    rows = docs.select("doc_id", whole(F.col("text")).alias("text"), held.alias("held"))
    names = BLOCK.split(", ")
    kinds = {"STRING": pa.string(), "LONG": pa.int64(), "BINARY": pa.binary()}
    schema = pa.schema([(n.split()[0], kinds[n.split()[1]]) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, size = TaskContext.get().partitionId(), 0, 0
        waiting: list[tuple] = []
        for batch in batches:
            for i, text, h in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                waiting.append((i, h, np.array(word_hashes(text), np.uint64)))
                size += len(text)
                if size >= block_bytes:
                    yield pa.RecordBatch.from_pylist([_block(f"{part}-{made}", waiting)], schema)
                    waiting, size, made = [], 0, made + 1
        if waiting:
            yield pa.RecordBatch.from_pylist([_block(f"{part}-{made}", waiting)], schema)

    return rows.mapInArrow(run, BLOCK)


def _frames(run: Callable[[dict], Iterator[dict]]) -> Callable:
    """A function on pandas batches that handles row by row."""

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                rows = list(run(row))
                if rows:
                    yield pd.DataFrame(rows)

    return mapped


def _names(schema: str) -> list[str]:
    return [n.split()[0] for n in schema.split(", ")]


def _slices(sorted_keys: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of sorted hashes; shards are equal ranges of hashes."""
    bounds = [(s << 64) // shards for s in range(shards)]
    at = np.searchsorted(sorted_keys, np.array(bounds, np.uint64)).tolist() + [len(sorted_keys)]
    for s in range(shards):
        if at[s] < at[s + 1]:
            yield s, at[s], at[s + 1]


def _histogram(counts: np.ndarray) -> list[int]:
    """How many n-grams occur 1, 2, ... RELIABLE + 1 times."""
    return np.bincount(counts[counts <= RELIABLE + 1], minlength=RELIABLE + 2)[1:].tolist()


WORDS = (
    "shard INT, block STRING, counts BINARY, ranks BINARY, histogram ARRAY<LONG>,"
    " tokens LONG, distinct_words LONG, hot ARRAY<STRUCT<key:STRING,rank:LONG,n:LONG>>, ends LONG"
)


def count_words(blocks: DataFrame, shards: int) -> DataFrame:
    """Per shard a row of sums, and per shard and block the counts of its words."""

    def deal(row: dict) -> Iterator[dict]:
        keys, counts = np.frombuffer(row["keys"], np.uint64), unpack(row["counts"])
        for s, a, b in _slices(keys, shards):
            yield {"shard": s, "block": row["block"], "keys": keys[a:b].tobytes(), "counts": pack(counts[a:b])}

    dealt = blocks.select("block", "keys", "counts").mapInPandas(
        _frames(deal), "shard INT, block STRING, keys BINARY, counts BINARY"
    )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        own = [np.frombuffer(k, np.uint64) for k in frame["keys"]]
        keys, at = np.unique(np.concatenate(own), return_inverse=True)
        weights = np.concatenate([unpack(c) for c in frame["counts"]])
        totals = np.bincount(at, weights, len(keys)).astype(np.int64)
        # Frequent words come first, so their ranks are short.
        ranks = np.empty(len(keys), np.int64)
        ranks[_by_count(totals)] = np.arange(len(keys))
        rows, low = [], 0
        for block, k in zip(frame["block"], own, strict=True):
            place = at[low : low + len(k)]
            low += len(k)
            rows.append({"shard": shard, "block": block, "counts": pack(totals[place]), "ranks": pack(ranks[place])})
        # At most 1 / HOT_SHARE words hold such a share of all tokens.
        top = _by_count(totals)[: int(2 / HOT_SHARE)]
        ends = totals[keys == END]
        rows.append(
            {
                "shard": shard,
                "histogram": _histogram(totals[totals > 0]),
                "tokens": int(totals.sum()),
                "distinct_words": int((totals > 0).sum()),
                "hot": [
                    {"key": str(keys[i]), "rank": r, "n": int(totals[i])}
                    for r, i in enumerate(top.tolist())
                    if totals[i] > 1000
                ],
                "ends": int(ends[0]) if len(ends) else 0,
            }
        )
        return pd.DataFrame(rows, columns=_names(WORDS)).astype(object).where(lambda f: f.notna(), None)

    return dealt.groupBy("shard").applyInPandas(add, WORDS)


def discounts(histogram: Sequence[int]) -> list[float]:
    """Good-Turing discounts of counts 1 to RELIABLE, in Katz's form.

    Where the counts of counts give none between 0 and 1, the discount is kept
    within these bounds, so that mass is always left for unseen events.
    """
    n = [0, *histogram]
    k = RELIABLE
    cut = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    found = []
    for r in range(1, k + 1):
        value = 1.0
        if n[r] and cut < 1:
            value = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut)
        found.append(min(0.99, max(0.05, value)))
    return found


@dataclass(frozen=True)
class Unigrams:
    """What all tasks know of the words: sums, discounts, and the hot histories."""

    tokens: int
    distinct_words: int
    texts: int
    discount: tuple[float, ...]
    unseen: float
    scale: float
    #: Hashes and codes of hot histories.
    hot: tuple[int, ...]
    hot_codes: tuple[int, ...]

    def log10(self, counts: np.ndarray) -> np.ndarray:
        """log10 p(w) by the counts of words."""
        return np.log10(self.probability(counts))

    def probability(self, counts: np.ndarray) -> np.ndarray:
        small = np.array([0.0, *self.discount, 1.0])
        d = small[np.minimum(counts, RELIABLE + 1)]
        p = self.scale * d * counts / max(self.tokens, 1)
        return np.where(counts > 0, p, self.unseen)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.distinct_words + 1)))


def unigrams(words: DataFrame, shards: int) -> Unigrams:
    sums = words.filter("block is null").agg(
        *[F.sum(F.element_at("histogram", i + 1)).alias(f"n{i + 1}") for i in range(RELIABLE + 1)],
        F.sum("tokens").alias("tokens"),
        F.sum("distinct_words").alias("words"),
        F.sum("ends").alias("texts"),
    ).first()
    histogram = [sums[f"n{i + 1}"] or 0 for i in range(RELIABLE + 1)]
    tokens = sums["tokens"] or 0
    d = discounts(histogram)
    left = sum((1 - d[r - 1]) * r * histogram[r - 1] for r in range(1, RELIABLE + 1))
    # Without a rare word one more token is set aside for unseen ones.
    scale = 1.0 if left > 0 else tokens / (tokens + 1)
    unseen = left / tokens if left > 0 else 1 / (tokens + 1)
    limit = max(1000, int(HOT_SHARE * tokens))
    hot = (
        words.filter("block is null")
        .select("shard", F.inline("hot"))
        .filter(F.col("n") > limit)
        .collect()
    )
    keys = tuple(int(r["key"]) for r in hot)
    codes = tuple(r["rank"] * shards + r["shard"] + 1 for r in hot)
    return Unigrams(
        tokens, sums["words"] or 0, sums["texts"] or 0, tuple(d), unseen, scale, keys, codes
    )


def _answers(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a block with the counts and codes that the shards answered.

    A word's code is unique among all words; 0 stands for the start of a text.
    """
    keys = np.frombuffer(row["keys"], np.uint64)
    counts, codes = [], []
    for part in sorted(row["answers"], key=lambda p: p["shard"]):
        counts.append(unpack(part["counts"]).astype(np.int64))
        codes.append(unpack(part["ranks"]).astype(np.int64) * row["shards"] + part["shard"] + 1)
    none = [np.zeros(0, np.int64)]
    return keys, np.concatenate(counts or none), np.concatenate(codes or none)


REQUEST = (
    "shard INT, block STRING, histories BINARY, sizes BINARY, starts BINARY,"
    " codes BINARY, words BINARY, counts BINARY, repeats BINARY, docs BINARY,"
    " ids BINARY, base BINARY"
)


def request_pairs(answered: DataFrame, known: Unigrams, shards: int) -> DataFrame:
    """Pairs of each block dealt to shards, and one row of what is known already."""
    hot_keys = np.array(known.hot, np.uint64)

    def deal(row: dict) -> Iterator[dict]:
        row["shards"] = shards
        keys, counts, codes = _answers(row)
        lengths = unpack(row["lengths"]).astype(np.int64)
        held = unpack(row["held"]).astype(bool)
        stream = _by_count(unpack(row["totals"]))[unpack(row["stream"])]
        docs = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        n_known = np.bincount(docs, counts[stream] > 0, len(lengths))
        base = np.bincount(docs, known.base(counts)[stream], len(lengths))
        table = np.stack([lengths, n_known, base, held, unpack(row["known"])]).astype(float)
        yield {
            "shard": int(keys[0] % np.uint64(shards)),
            "block": row["block"],
            "ids": row["ids"],
            "base": table.tobytes(),
        }
        # The start of a text precedes all words in the order of histories.
        history = np.empty_like(stream)
        history[1:] = stream[:-1] + 1
        history[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = 0
        width = len(keys)
        history *= width
        history += stream
        del stream
        order = np.argsort(history, kind="stable")
        history = history[order]
        new = np.concatenate([[True], history[1:] != history[:-1]])
        pairs = history[new]
        at = np.cumsum(new, dtype=np.int32) - 1
        ordered, first = docs[order], np.flatnonzero(new)
        del history, new
        h, w = pairs // width, pairs % width
        trained = np.bincount(at, ~held[ordered], len(pairs)).astype(np.int64)
        repeats = np.bincount(at, minlength=len(pairs))
        del at, order, docs
        own_keys = np.concatenate([[START], keys])[h]
        # By ranges of hashes: of the history, or of the next word if it is hot.
        dealt_by = np.where(np.isin(own_keys, hot_keys) | (h == 0), keys[w], own_keys)
        shard = np.searchsorted(
            np.array([(s << 64) // shards for s in range(shards)], np.uint64), dealt_by, "right"
        ) - 1
        history_counts = np.concatenate([[known.texts], counts])
        history_codes = np.concatenate([[0], codes])
        by_shard = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[by_shard], np.arange(shards + 1))
        for s in range(shards):
            mine = by_shard[cuts[s] : cuts[s + 1]]
            if not len(mine):
                continue
            own, start, size = np.unique(h[mine], return_index=True, return_counts=True)
            size_of = repeats[mine]
            shift = first[mine] - np.concatenate([[0], np.cumsum(size_of)[:-1]])
            events = np.repeat(shift, size_of) + np.arange(int(size_of.sum()))
            yield {
                "shard": s,
                "block": row["block"],
                "histories": pack(history_codes[own]),
                "sizes": pack(size),
                "starts": pack(history_counts[own]),
                "codes": pack(codes[w[mine]]),
                "words": pack(counts[w[mine]]),
                "counts": pack(trained[mine]),
                "repeats": pack(size_of),
                "docs": pack(ordered[events]),
            }

    names = _names(REQUEST)

    def run(row: dict) -> Iterator[dict]:
        for out in deal(row):
            yield {n: out.get(n) for n in names}

    return answered.mapInPandas(_frames(run), REQUEST)


PARTIAL = (
    "shard INT, block STRING, docs BINARY, sums BINARY, seen BINARY, histogram ARRAY<LONG>,"
    " histories BINARY, figures BINARY, at BINARY, unseen_docs BINARY, unseen BINARY,"
    " hot BINARY, hot_figures BINARY, ids BINARY, base BINARY"
)


def score_pairs(requests: DataFrame, known: Unigrams) -> DataFrame:
    """Per shard and block: sums of seen pairs, and the unseen events with what
    their back-off weights are made of.

    The discounts of pairs are not known yet, since counts of counts are only
    complete when all shards are done; seen pairs are therefore also counted by
    their number of occurrences.
    """
    hot_codes = np.array([0, *known.hot_codes])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        parts, rows = [], []
        known_rows = frame[frame["base"].notna()]
        for row in known_rows.to_dict("records"):
            rows.append({c: row[c] for c in ("shard", "block", "ids", "base")})
        frame = frame[frame["base"].isna()]
        if not len(frame):
            return pd.DataFrame(rows, columns=_names(PARTIAL)).astype(object)
        for row in frame.to_dict("records"):
            sizes = unpack(row["sizes"])
            parts.append(
                (
                    np.repeat(unpack(row["histories"]).astype(np.int64), sizes),
                    unpack(row["codes"]).astype(np.int64),
                    unpack(row["counts"]).astype(np.int64),
                    unpack(row["words"]).astype(np.int64),
                    np.repeat(unpack(row["starts"]).astype(np.int64), sizes),
                )
            )
        h, code, trained, word, start = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((code, h))
        new_h = np.concatenate([[True], h[order][1:] != h[order][:-1]])
        new = new_h | np.concatenate([[True], code[order][1:] != code[order][:-1]])
        pair = np.empty(len(h), np.int64)
        pair[order] = np.cumsum(new) - 1
        histories = h[order][new_h]
        of = (np.cumsum(new_h) - 1)[new]
        total = np.bincount(pair, trained, int(new.sum())).astype(np.int64)
        p = known.probability(word[order][new])
        c = start[order][new_h]
        # By history: pairs of each small count, probability of all seen words,
        # occurrences, and whether one of these is set aside for unseen words.
        seen = total > 0
        figures = np.zeros((RELIABLE + 3, len(histories)))
        for r in range(1, RELIABLE + 1):
            figures[r - 1] = np.bincount(of, total == r, len(histories))
        figures[RELIABLE] = np.bincount(of, p * seen, len(histories))
        is_hot = np.isin(histories, hot_codes)
        aside = is_hot | (figures[:RELIABLE].sum(0) == 0)
        figures[RELIABLE + 1] = c + aside
        figures[RELIABLE + 2] = aside
        value = np.zeros(len(total))
        value[seen] = np.log10(total[seen] / figures[RELIABLE + 1, of[seen]])
        low = 0
        for row, part in zip(frame.to_dict("records"), parts, strict=True):
            mine = pair[low : low + len(part[0])]
            low += len(part[0])
            event = np.repeat(mine, unpack(row["repeats"]))
            docs = unpack(row["docs"]).astype(np.int64)
            n = int(docs.max()) + 1
            there = seen[event]
            sums = np.bincount(docs[there], value[event[there]], n)
            small = np.zeros((RELIABLE, n), np.int64)
            for r in range(1, RELIABLE + 1):
                small[r - 1] = np.bincount(docs, total[event] == r, n)
            present = np.flatnonzero(np.bincount(docs[there], minlength=n))
            lost = event[~there]
            own, at = np.unique(of[lost], return_inverse=True)
            rows.append(
                {
                    "shard": row["shard"],
                    "block": row["block"],
                    "docs": pack(present),
                    "sums": sums[present].tobytes(),
                    "seen": pack(small[:, present].ravel()),
                    "histories": pack(histories[own]),
                    "figures": figures[:, own].tobytes(),
                    "at": pack(at),
                    "unseen_docs": pack(docs[~there]),
                    "unseen": np.log10(p[lost]).astype(np.float64).tobytes(),
                }
            )
        rows.append(
            {
                "histogram": _histogram(total[seen]),
                "hot": pack(histories[is_hot]),
                "hot_figures": figures[:, is_hot].tobytes(),
            }
        )
        table = pd.DataFrame(rows, columns=_names(PARTIAL)).astype(object)
        return table.where(table.notna(), None)

    return requests.groupBy("shard").applyInPandas(add, PARTIAL)


def log10_alpha(figures: np.ndarray, discount: Sequence[float]) -> np.ndarray:
    """log10 of the back-off weight, from the figures of histories (columns).

    A history without any pair of a small count leaves no discounted mass; one
    more occurrence is set aside for it, as for one never seen and for hot ones.
    """
    small, p, c, aside = (*np.split(figures, [RELIABLE, RELIABLE + 1, RELIABLE + 2]),)
    r = np.arange(1, RELIABLE + 1)[:, None]
    left = (r * (1 - np.array(discount)[:, None]) * small).sum(0)
    return np.log10((left + aside[0]) / c[0]) - np.log10(1 - p[0])


SCORES = (
    "doc_id LONG, held_out BOOLEAN, n_tokens LONG, n_known LONG, base_score DOUBLE,"
    " score DOUBLE"
)


def _finish(discount: Sequence[float], hot: dict[int, np.ndarray]) -> Callable:
    """Scores of a block's documents from what the shards say of its pairs."""
    log_d = np.log10(np.array(discount))

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame[frame["base"].notna()].iloc[0]
        n, n_known, base, held, known = np.frombuffer(own["base"]).reshape(5, -1)
        ids = pd.array(np.frombuffer(own["ids"], np.int64).copy(), dtype="Int64")
        ids[known == 0] = pd.NA
        score = np.zeros(len(n))
        for row in frame[frame["base"].isna()].sort_values("shard").to_dict("records"):
            docs = unpack(row["docs"]).astype(np.int64)
            seen = unpack(row["seen"]).reshape(RELIABLE, -1).astype(float)
            score[docs] += np.frombuffer(row["sums"]) + log_d @ seen
            lost = unpack(row["unseen_docs"]).astype(np.int64)
            if len(lost):
                figures = np.frombuffer(row["figures"]).reshape(RELIABLE + 3, -1).copy()
                for i, h in enumerate(unpack(row["histories"]).tolist()):
                    if h in hot:
                        figures[:, i] = hot[h]
                alpha = log10_alpha(figures, discount)[unpack(row["at"])]
                unseen = np.frombuffer(row["unseen"]) + alpha
                score += np.bincount(lost, unseen, len(n))
        return pd.DataFrame(
            {
                "doc_id": ids,
                "held_out": held > 0,
                "n_tokens": n.astype(np.int64),
                "n_known": n_known.astype(np.int64),
                "base_score": base,
                "score": score,
            }
        )

    return finish


def _hot_figures(partials: DataFrame) -> dict[int, np.ndarray]:
    """Figures of hot histories added up over shards: at most 1 / HOT_SHARE + 1."""

    def rows(row: dict) -> Iterator[dict]:
        keys = unpack(row["hot"])
        figures = np.frombuffer(row["hot_figures"]).reshape(RELIABLE + 3, -1)
        for key, own in zip(keys.tolist(), figures.T, strict=True):
            yield {"key": str(key), **{f"f{i}": float(x) for i, x in enumerate(own)}}

    schema = "key STRING, " + ", ".join(f"f{i} DOUBLE" for i in range(RELIABLE + 3))
    apart = partials.filter("hot is not null").select("hot", "hot_figures")
    sums = [F.sum(f"f{i}").alias(f"f{i}") for i in range(RELIABLE + 1)]
    same = [F.max(f"f{i}").alias(f"f{i}") for i in (RELIABLE + 1, RELIABLE + 2)]
    added = apart.mapInPandas(_frames(rows), schema).groupBy("key").agg(*sums, *same)
    return {
        int(r["key"]): np.array([r[f"f{i}"] for i in range(RELIABLE + 3)])
        for r in added.collect()
    }


def score(
    docs: DataFrame,
    held: Column,
    block_bytes: int = BLOCK_BYTES,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    The model learns from all rows of (doc_id, text) for which ``held`` is false
    and scores every row. Tokens are words, A-Z in lower case, and one end per
    text; a null text is empty, so its only token is the end. Every row is
    scored, repeated ones too, and null identifiers stay null. Without training
    rows every token is unseen and has probability 1 as the only outcome. Words
    are told apart by 64-bit hashes. An empty table gives no rows; further
    columns are not read.
    """
    blocks = write_out(encode_blocks(docs, held, block_bytes), "blocks")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // (6 * shard_tokens)))
    words = write_out(count_words(blocks, shards), "words")
    known = unigrams(words, shards)
    answers = (
        words.filter("block is not null")
        .groupBy("block")
        .agg(F.collect_list(F.struct("shard", "counts", "ranks")).alias("answers"))
    )
    answered = blocks.join(answers, "block").drop("counts", "docs")
    partials = write_out(score_pairs(request_pairs(answered, known, shards), known), "partials")
    sums = partials.filter("histogram is not null").agg(
        *[F.sum(F.element_at("histogram", i + 1)).alias(f"n{i}") for i in range(RELIABLE + 1)]
    )
    histogram = [n or 0 for n in sums.first()]
    finish = _finish(discounts(histogram), _hot_figures(partials))
    scored = (
        partials.filter("block is not null")
        .drop("histogram", "hot", "hot_figures")
        .groupBy("block")
        .applyInPandas(finish, SCORES)
    )
    tokens = F.lit(known.tokens).cast("long").alias("train_tokens")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", tokens, "base_score", "score"
    )
