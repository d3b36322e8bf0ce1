"""Toxic text by compression distance.

Two zstandard dictionaries are made from labelled rows. Both hold the same
ordinary windows; the toxic one holds, before them, the words that toxic texts
have and ordinary ones lack. A window that needs fewer bytes under the toxic
dictionary therefore owes that to such words, or to parts of them.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.llm.common import boxed, map_columns, pick, whole

#: Words of a window.
WINDOW = 24
#: Rows of each class that are fitted on at most, and the longest text used.
SAMPLE_ROWS = 3_000
SAMPLE_LENGTH = 20_000
#: Size of the ordinary part, and of the toxic part at most, in bytes.
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 16_384
#: Standard errors by which a toxic word is more frequent in toxic texts.
DISTINCT = 5.0
#: Times that it is at least as frequent there.
TIMES = 6
#: Share of ordinary windows above the window threshold.
ABOVE = 0.002


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    threshold: float
    weights: tuple[float, ...]


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    """The text in lower case, cut after every ``size`` words."""
    words = text.lower().encode("utf-8", "surrogatepass").split()
    return [
        b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)
    ]


def _length(content: bytes) -> Callable[[bytes], int]:
    """Compressed length of a window under a dictionary."""
    settings = zstandard.ZstdCompressionParameters(
        window_log=17,
        chain_log=16,
        hash_log=16,
        search_log=4,
        min_match=4,
        target_length=16,
        strategy=zstandard.STRATEGY_LAZY,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    if len(content) < 8:
        content = b" " * 8
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(compression_params=settings)
    compress = zstandard.ZstdCompressor(compression_params=settings, dict_data=words).compress
    return lambda window: len(compress(window))


def savings(model: Model) -> Callable[[str], np.ndarray]:
    """Bytes that each window of a text saves under the toxic dictionary."""
    toxic, ordinary = _length(model.toxic + model.ordinary), _length(model.ordinary)

    def saved(text: str) -> np.ndarray:
        return np.array([ordinary(w) - toxic(w) for w in windows(text)], float)

    return saved


def _features(saved: np.ndarray, threshold: float) -> list[float]:
    if not len(saved):
        return [1.0, 0.0, 0.0, 0.0]
    return [1.0, saved.mean(), saved.max() / 4, float((saved > threshold).mean())]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression, by Newton steps."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + keep * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return w


def _toxic_words(toxic: Sequence[str], ordinary: Sequence[str]) -> list[bytes]:
    """Words found in more toxic texts than chance explains, the clearest last.

    A toxic text counts for a word only if it has it between neighbours not seen
    before, so that near copies of one text do not lift the words they share.
    """
    a, b = Counter(), Counter()
    seen: set[int] = set()
    for text in toxic:
        words = text.lower().encode("utf-8", "surrogatepass").split()
        places = zip([b"", *words], words, [*words[1:], b""])
        new = {hash(place): place[1] for place in places}
        a.update({w for h, w in new.items() if h not in seen})
        seen.update(new)
    for text in ordinary:
        b.update(set(text.lower().encode("utf-8", "surrogatepass").split()))
    n, m = len(toxic), len(ordinary)

    def excess(word: bytes) -> float:
        p = (a[word] + b[word] + 0.5) / (n + m + 1)
        error = math.sqrt(p * (1 - p) * (1 / n + 1 / m))
        return (a[word] / n - b[word] / m) / error

    common = {w for w, c in a.items() if c > 2 and c / n > TIMES * b[w] / m}
    ranked = sorted((excess(w), w) for w in common)
    return [w for z, w in ranked if z > DISTINCT]


def fit(rows: Sequence[tuple[str, int]], seed: int = 7) -> Model:
    """The model of labelled texts; with one class only, all scores are its share.

    Two thirds of the distinct texts make the dictionaries, the rest set the
    threshold of a window and the weights of a text's figures.
    """
    texts = sorted({(t, int(y)) for t, y in rows})
    random.Random(seed).shuffle(texts)
    toxic = [t for t, y in texts if y]
    ordinary = [t for t, y in texts if not y]
    if not toxic or not ordinary:
        share = 6.0 if toxic else -6.0
        return Model(b"", b"", 0.0, (share, 0.0, 0.0, 0.0))
    some_toxic, some_ordinary = len(toxic) * 2 // 3 or 1, len(ordinary) * 2 // 3 or 1
    words = _toxic_words(toxic[:some_toxic], ordinary[:some_ordinary])
    pieces = sorted({w for t in ordinary[:some_ordinary] for w in windows(t)[:20]})
    random.Random(seed).shuffle(pieces)
    common = b"".join(pieces[: ORDINARY_BYTES // 64])[:ORDINARY_BYTES]
    special = (b" " + b" ".join(words) + b" ")[-TOXIC_BYTES:]
    saved = savings(Model(special, common, 0.0, ()))
    later = [(saved(t), 1) for t in toxic[some_toxic:] or toxic]
    later += [(saved(t), 0) for t in ordinary[some_ordinary:] or ordinary]
    usual = np.concatenate([s for s, y in later if not y] or [np.zeros(1)])
    threshold = float(np.quantile(usual, 1 - ABOVE)) if len(usual) else 0.0
    x = np.array([_features(s, threshold) for s, _ in later])
    y = np.array([y for _, y in later], float)
    return Model(special, common, threshold, tuple(map(float, _logistic(x, y))))


def sample(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = SAMPLE_ROWS,
    length: int = SAMPLE_LENGTH,
) -> list[tuple[str, int]]:
    """Up to ``rows`` labelled texts of each class, picked by a hash of the key.

    ``usable`` is a condition on the key column ``doc_id``. Texts of more than
    ``length`` characters serve no fitting. An identifier with both labels, or
    with none, is left out.
    """
    known = (
        labels.filter(F.col(label).isNotNull())
        .groupBy(F.col("doc_id").alias("_key"))
        .agg(F.min(label).alias("_y"), F.max(label).alias("_y2"))
        .filter("_y = _y2")
        .select("_key", "_y")
    )
    texts = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("text"))
    texts = texts.filter(usable & (F.char_length("text") <= length))
    rows_of = texts.select("doc_id").join(known, F.col("doc_id") == F.col("_key"))
    return pick(rows_of.filter("_y in (0, 1)"), "_y", rows, texts)


def score(
    docs: DataFrame, model: Model, text: str = "text", out: str = "score"
) -> DataFrame:
    """``docs`` with the probability (0 to 1) that each whole text is toxic.

    Null and empty texts have no window and get the score of no saving at all.
    """

    def make() -> Callable:
        saved, weights = savings(model), np.array(model.weights)

        def probability(t: str | None) -> float:
            z = float(np.dot(_features(saved(t or ""), model.threshold), weights))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return lambda texts: [[probability(t) for t in texts]]

    return map_columns(docs, [text], f"{out} DOUBLE", make)


def drop_toxic(
    docs: DataFrame, model: Model, text: str = "text", cut: float = 0.5
) -> DataFrame:
    """Rows of ``docs`` whose score is below ``cut``; columns of any name stay.

    Nulls and empty texts score as in ``score``; equal texts fare alike.
    """
    own = boxed(docs, F.col(text).alias("text"))
    kept = score(own, model).filter(F.col("score") < cut)
    return kept.select("row.*")
