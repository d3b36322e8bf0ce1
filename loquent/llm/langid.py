"""Language of a text by a blended-spectrum string kernel.

The kernel of two texts counts the letter n-grams (n = 1, 2, 3) that both have,
divided by the root of the product of how many each has. Landmark texts span a
Nyström feature map; one kernel ridge regression per language against the rest
is solved on it. As the kernel is a dot product of presence vectors, landmarks
and weights fold into one matrix from n-grams to languages, and a batch of texts
is scored by one matrix product.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.llm.common import map_columns, pick

#: Rows of each language that are fitted on at most, and the longest text used.
SAMPLE_ROWS = 600
SAMPLE_LENGTH = 20_000
#: Landmark texts of each language at most.
LANDMARKS = 96
RIDGE = 1e-3
#: Unknown language: a text without letters.
UNKNOWN = "und"
LETTERS = 64
GRAMS = LETTERS + LETTERS**2 + LETTERS**3
_LETTER = regex.compile(r"\p{L}")
_alphabet: list[np.ndarray] = []


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: Weight of each n-gram for each language, float32, and its n-grams.
    grams: np.ndarray
    weights: np.ndarray
    sharpness: float


def alphabet() -> np.ndarray:
    """Letter code of every code point: 0 no letter, 1 to 26 a to z, else hashed."""
    if not _alphabet:
        codes = np.zeros(0x110000, np.uint8)
        points = [*range(0xD800), *range(0xE000, 0x110000)]
        for match in regex.finditer(r"\p{L}", "".join(map(chr, points))):
            low = match[0].lower()[0]
            if "a" <= low <= "z":
                code = ord(low) - 96
            else:
                code = 27 + ord(low) * 40503 % 65536 * (LETTERS - 27) // 65536
            codes[ord(match[0])] = code
        _alphabet.append(codes)
    return _alphabet[0]


def presence(text: str) -> np.ndarray:
    """Sorted codes of the n-grams that a whole text has, none for no letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    codes = alphabet()[points].astype(np.int32)
    gap = codes == 0
    codes = np.concatenate([[0], codes[~(gap & np.concatenate([[True], gap[:-1]]))], [0]])
    seen = np.zeros(GRAMS, bool)
    seen[codes] = True
    two = codes[:-1] * LETTERS + codes[1:]
    seen[LETTERS + two] = True
    three = two[:-1] * LETTERS + codes[2:]
    seen[LETTERS + LETTERS**2 + three] = True
    seen[0] = False
    seen[LETTERS] = False
    return np.flatnonzero(seen) if codes.any() else np.zeros(0, np.int64)


def _matrix(texts: list[np.ndarray], grams: np.ndarray) -> np.ndarray:
    """Presence rows over ``grams``, each of length one in the kernel's space."""
    rows = np.zeros((len(texts), len(grams)), np.float32)
    for row, found in zip(rows, texts, strict=True):
        if len(found):
            at = np.searchsorted(grams, found)
            at[at == len(grams)] = 0
            known = grams[at] == found
            row[at[known]] = 1 / np.sqrt(len(found))
    return rows


def fit(rows: Sequence[tuple[str, str]], landmarks: int = LANDMARKS) -> Model:
    """The model of labelled texts; texts without letters serve no fitting."""
    found = sorted({(y, t) for t, y in rows if t and _LETTER.search(t)})
    languages = tuple(sorted({y for y, _ in found}))
    if not found:
        return Model((), np.zeros(0, np.int64), np.zeros((0, 0), np.float32), 1.0)
    grams_of = [presence(t) for _, t in found]
    grams = np.unique(np.concatenate(grams_of))
    x = _matrix(grams_of, grams)
    y = np.array([[1.0 if y == k else -1.0 for k in languages] for y, _ in found])
    marks = []
    for k in languages:
        own = [i for i, (y_, _) in enumerate(found) if y_ == k]
        marks += own[:: max(1, -(-len(own) // landmarks))]
    # Nyström: features K(x, L) (K(L, L) + eps)^(-1/2).
    base = x[marks]
    values, vectors = np.linalg.eigh((base @ base.T).astype(float))
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = (x @ base.T) @ root
    # Each language counts alike, whatever its number of texts.
    share = {k: 1 / sum(1 for y_, _ in found if y_ == k) for k in languages}
    w = np.array([share[y_] for y_, _ in found])
    curve = (features * w[:, None]).T @ features + RIDGE * np.eye(features.shape[1])
    solved = np.linalg.solve(curve, (features * w[:, None]).T @ y)
    weights = (base.T @ (root @ solved)).astype(np.float32)
    return Model(languages, grams, weights, 6.0)


def sample(
    docs: DataFrame,
    usable: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows: int = SAMPLE_ROWS,
    length: int = SAMPLE_LENGTH,
) -> list[tuple[str, str]]:
    """Up to ``rows`` labelled texts of each language, picked by a hash of the key.

    ``usable`` is a condition on the key column ``doc_id``. Null languages, and
    texts of more than ``length`` characters, serve no fitting.
    """
    own = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    own = own.filter(
        usable & F.col("lang").isNotNull() & (F.char_length("text") <= length)
    )
    return pick(own, "lang", rows, own.select("doc_id", "text"))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) of each whole text.

    A null text, or one without a letter, is ``und`` with score 1; so is every
    text, with score 0, if nothing was learned. Ties go to the first language by
    name.
    """

    def make() -> Callable:
        def batch(texts: list) -> list:
            names, scores = [], []
            for low in range(0, len(texts), 64):
                part = texts[low : low + 64]
                grams_of = [presence(t or "") for t in part]
                if not model.languages:
                    names += [UNKNOWN] * len(part)
                    scores += [0.0 if len(g) else 1.0 for g in grams_of]
                    continue
                margins = _matrix(grams_of, model.grams) @ model.weights
                odds = np.exp(model.sharpness * (margins - margins.max(1, keepdims=True)))
                odds /= odds.sum(1, keepdims=True)
                for g, row in zip(grams_of, odds, strict=True):
                    best = int(row.argmax())
                    names.append(model.languages[best] if len(g) else UNKNOWN)
                    scores.append(float(row[best]) if len(g) else 1.0)
            return [names, scores]

        return batch

    return map_columns(docs, [text], "lang_pred STRING, score DOUBLE", make)
