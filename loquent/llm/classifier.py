"""Text quality by a naive Bayes support vector machine.

A text has the indicators of its n-grams: of characters, and of word shapes, in
which runs of capitals, of other letters and of digits shrink to one sign and a word
that repeats the one before is marked. Each indicator is scaled by the log-count
ratio of its n-gram between the classes; a linear model with hinge loss is then
fitted by dual coordinate descent, and a logistic curve turns its margin into a
probability.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.llm.common import map_columns, whole

#: Lengths of the n-grams of characters and of word shapes.
CHARACTERS = (1, 2, 3)
SHAPES = (1, 2, 3)
#: Rows of each class that are fitted on at most, and n-grams of a row, those of
#: the smallest mixed codes, that teach. Scores use all n-grams of a text.
SAMPLE_ROWS = 2_000
SAMPLE_GRAMS = 4_096
#: Added to every count, the price of a violated margin, and rounds of descent.
SMOOTH = 1.0
PRICE = 1.0
ROUNDS = 40
#: Mixes codes so that the smallest ones are a fair sample.
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CLASSES = (("X", r"\p{Lu}"), ("x", r"[\p{L}--\p{Lu}]"), ("9", r"\p{N}"))
_signs: list[np.ndarray] = []


@dataclass(frozen=True)
class Model:
    #: Codes of known n-grams in order, and the weight of each.
    grams: np.ndarray
    weights: np.ndarray
    bias: float
    #: Slope and height of the logistic curve over margins.
    slope: float
    height: float


def signs() -> np.ndarray:
    """The shape sign of every code point; itself for all but letters and digits."""
    if not _signs:
        table = np.arange(0x110000, dtype=np.uint32)
        points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for sign, kind in _CLASSES:
            found = "".join(regex.findall(kind, points, flags=regex.V1))
            table[np.frombuffer(found.encode("utf-32-le"), "<u4")] = ord(sign)
        _signs.append(table)
    return _signs[0]


def _shapes(points: np.ndarray, words: list[str]) -> list[str]:
    signed = signs()[points]
    runs = np.isin(signed, [ord(s) for s, _ in _CLASSES])
    runs[1:] &= signed[1:] == signed[:-1]
    runs[:1] = False
    shapes = signed[~runs].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split()
    before = [None, *words[:-1]] if words else []
    return [s + "=" if a == b else s for s, a, b in zip(shapes, words, before, strict=True)]


def indicators(text: str) -> np.ndarray:
    """Distinct codes of the n-grams of a whole text, in order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    wide = points.astype(np.uint64)
    found = []
    for n in CHARACTERS:
        if len(wide) >= n:
            code = np.full(len(wide) - n + 1, n, np.uint64)
            for k in range(n):
                # 20 bits tell all assigned characters apart but private planes.
                code = (code << np.uint64(20)) | (wide[k : len(wide) - n + 1 + k] & np.uint64(0xFFFFF))
            found.append(code)
    shapes = _shapes(points, text.split())
    parted = set()
    for n in SHAPES:
        parted.update(zip(*(shapes[k:] for k in range(n))))
    digest = xxhash.xxh64_intdigest
    hashed = [digest(" ".join(p).encode("utf-8", "surrogatepass")) | 1 << 63 for p in parted]
    found.append(np.array(hashed, np.uint64))
    return np.unique(np.concatenate(found))


def _vector(grams: np.ndarray, model: Model) -> tuple[np.ndarray, float]:
    """Places of the known n-grams, and the length that all of the text's have."""
    if not len(model.grams):
        return np.zeros(0, np.int64), 1.0
    at = np.searchsorted(model.grams, grams)
    at[at == len(model.grams)] = 0
    return at[model.grams[at] == grams], math.sqrt(max(len(grams), 1))


def margin(grams: np.ndarray, model: Model) -> float:
    at, length = _vector(grams, model)
    return float(model.weights[at].sum()) / length + model.bias


def descend(
    rows: Sequence[tuple[np.ndarray, np.ndarray]], y: np.ndarray, prices: np.ndarray, size: int,
    rounds: int = ROUNDS, seed: int = 7,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a hinge-loss model, by dual coordinate descent.

    Each step solves one row's dual variable, between 0 and its price, exactly.
    """
    shuffle = random.Random(seed)
    w, bias = np.zeros(size), 0.0
    dual = np.zeros(len(rows))
    curve = [float(v @ v) + 1.0 for _, v in rows]
    order = list(range(len(rows)))
    for _ in range(rounds):
        shuffle.shuffle(order)
        largest = 0.0
        for k in order:
            at, v = rows[k]
            slope = y[k] * (float(w[at] @ v) + bias) - 1.0
            new = min(max(dual[k] - slope / curve[k], 0.0), prices[k])
            step = new - dual[k]
            if step:
                w[at] += step * y[k] * v
                bias += step * y[k]
                dual[k] = new
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return w, bias


def _curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and height of the logistic curve of margins, by Newton steps.

    Targets are drawn in from 0 and 1 by the number of rows, so that margins that
    part the classes wholly give no infinite slope.
    """
    good, bad = float((y > 0).sum()), float((y <= 0).sum())
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margins, np.ones_like(margins)], 1)
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + 1e-6 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.clip(np.linalg.solve(bend, slope), -2, 2)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(rows: Sequence[tuple[np.ndarray, int]], seed: int = 7) -> Model:
    """The model of labelled rows of n-gram codes.

    Four fifths of the rows teach counts and weights, the rest the curve. Both
    classes weigh alike in the hinge loss. With one class only, or no rows, every
    score is the same: the share of label 1 drawn in by one row of each class.
    """
    rows = sorted(rows, key=lambda r: (r[1], r[0].tobytes()))
    random.Random(seed).shuffle(rows)
    good = sum(y for _, y in rows)
    if not good or good == len(rows):
        height = math.log((good + 1) / (len(rows) - good + 1))
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, 0.0, height)
    of_class = {k: [r for r in rows if r[1] == k] for k in (0, 1)}
    taught, later = [], []
    for same in of_class.values():
        cut = max(1, len(same) * 4 // 5)
        taught += same[:cut]
        later += same[cut:] or same
    grams, place = np.unique(np.concatenate([g for g, _ in taught]), return_inverse=True)
    label = np.repeat([y for _, y in taught], [len(g) for g, _ in taught])
    counts = [np.bincount(place[label == k], minlength=len(grams)) + SMOOTH for k in (1, 0)]
    ratios = np.log((counts[0] / counts[0].sum()) / (counts[1] / counts[1].sum()))
    bare = Model(grams, ratios, 0.0, 1.0, 0.0)
    vectors = []
    for g, _ in taught:
        at, length = _vector(g, bare)
        vectors.append((at, ratios[at] / length))
    y = np.array([1.0 if k else -1.0 for _, k in taught])
    share = np.where(y > 0, (y > 0).mean(), (y <= 0).mean())
    w, bias = descend(vectors, y, PRICE / (2 * share), len(grams), seed=seed)
    model = Model(grams, w * ratios, bias, 1.0, 0.0)
    margins = np.array([margin(g, model) for g, _ in later])
    return Model(grams, w * ratios, bias, *_curve(margins, np.array([k for _, k in later])))


def sample(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = SAMPLE_ROWS,
    grams: int = SAMPLE_GRAMS,
) -> list[tuple[np.ndarray, int]]:
    """Up to ``rows`` labelled rows of each class as n-gram codes.

    Rows are picked by a hash of the key; ``usable`` is a condition on the column
    ``doc_id``. An identifier with both labels, with another label than 0 or 1, or
    with none, is left out, as is a null one. Where an identifier has several
    texts, the smallest counts. A text of any length teaches with the ``grams`` of
    its n-grams whose mixed codes are smallest. At most 2 * rows * grams codes of
    8 bytes come to the driver; the texts are read once.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("y2"))
        .filter("y = y2")
        .filter(usable)
        .select("doc_id", "y")
    )
    chosen = None
    for k in (0, 1):
        own = known.filter(F.col("y") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = own if chosen is None else chosen.unionByName(own)
    texts = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("text"))
    # At most 2 * rows identifiers.
    found = texts.join(F.broadcast(chosen), "doc_id")
    once = found.groupBy("doc_id", "y").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for t in batch.column(1).to_pylist():
                all_ = indicators(t)
                if len(all_) > grams:
                    all_ = np.sort(all_[np.argsort(all_ * _MIX, kind="stable")[:grams]])
                codes.append(all_.tobytes())
            columns = [batch.column(0), pa.array(codes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["y", "codes"])

    taught = once.select(F.col("y").cast("int").alias("y"), "text")
    taught = taught.mapInArrow(run, "y INT, codes BINARY")
    return [(np.frombuffer(r["codes"], np.uint64), r["y"]) for r in taught.collect()]


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability (0 to 1) that each whole text has label 1.

    Null and empty texts have no n-gram and get the score of the bias alone. Equal
    texts score alike; an added column replaces one of the same name.
    """

    def make() -> Callable:
        def probability(t: str | None) -> float:
            z = model.slope * margin(indicators(t or ""), model) + model.height
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return lambda texts: [[probability(t) for t in texts]]

    return map_columns(docs, [text], f"{out} DOUBLE", make)
