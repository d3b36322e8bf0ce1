"""Extractive summaries: TextRank over each segment's own term graph.

After Mihalcea and Tarau (2004). Terms at most ``WINDOW`` places apart are
linked, ranks come from a fixed number of weighted PageRank rounds, and the
sentence nearest to the ten best terms is the summary.

A segment's graph depends on its own text only and is no larger than that, so
there is no shuffle, no join, no lineage growing by the round. Terms, sentences and
scores are built-in expressions over the row. Graphs are ranked by an Arrow function
for many rows at a time, whose steps are NumPy's: links are two arrays of nodes, a
round is one weighted count. Every step sorts or reads arrays in order, so a row
costs n log n in its number of terms.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.functions.binding import let
from loquent.functions.text import sentences, terms

WINDOW = 3
ROUNDS = 10
DAMPING = 0.85
TOP_TERMS = 10
RANK_DIGITS = 9
SCORE_DIGITS = 9

_KEYS = ["video_id", "segment_id"]


def sentence_split(segments: DataFrame) -> DataFrame:
    """(video_id, segment_id, position, sentence)."""
    return segments.select(
        *_KEYS, F.posexplode(sentences(F.col("text"))).alias("position", "sentence")
    ).withColumn("position", F.col("position").cast("bigint"))


def _ranks(node: np.ndarray, row: np.ndarray, node_row: np.ndarray) -> np.ndarray:
    """Ranks after ``ROUNDS`` rounds; ``node`` and ``row`` are those of every place.

    Nodes within ``WINDOW`` places are linked once per meeting, both ways, so a
    node passes on its rank in equal parts, one for each of its links.
    """
    sources, targets = [], []
    for step in range(1, WINDOW + 1):
        a, b = node[:-step], node[step:]
        met = (row[:-step] == row[step:]) & (a != b)
        sources += [a[met], b[met]]
        targets += [b[met], a[met]]
    source, target = np.concatenate(sources), np.concatenate(targets)
    n = len(node_row)
    links = np.maximum(np.bincount(source, minlength=n), 1)
    count = np.bincount(node_row)[node_row]
    rank, base = 1.0 / count, (1.0 - DAMPING) / count
    for _ in range(ROUNDS):
        rank = base + DAMPING * np.bincount(target, (rank / links)[source], minlength=n)
    return rank


def best_terms(words: pa.ListArray, limit: int | None = None) -> pa.Array:
    """The best terms of every list with their ranks; equal ranks go by term.

    Without a limit all of its terms, in term order.
    """
    coded = words.flatten().dictionary_encode()
    in_order = pc.sort_indices(coded.dictionary)
    listed = coded.dictionary.take(in_order)
    place = np.empty(len(listed), dtype=np.int64)
    place[in_order.to_numpy()] = np.arange(len(listed))
    row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy())
    codes = place[coded.indices.to_numpy()]
    nodes, node = np.unique(row * max(len(listed), 1) + codes, return_inverse=True)
    node_row, term = np.divmod(nodes, max(len(listed), 1))
    rank = _ranks(node, row, node_row)
    sizes = np.bincount(node_row, minlength=len(words))
    best = np.arange(len(nodes))
    if limit is not None:
        # Halves go up, as in Spark's round().
        shown = np.floor(rank * 10.0**RANK_DIGITS + 0.5)
        best = np.lexsort((term, -shown, node_row))
        first = np.cumsum(sizes) - sizes
        best = best[np.arange(len(best)) - first[node_row[best]] < limit]
        sizes = np.minimum(sizes, limit)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    found = pa.StructArray.from_arrays(
        [listed.take(pa.array(term[best])), pa.array(rank[best])], ["term", "rank"]
    )
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)


@cache
def _best_terms(limit: int | None = None):
    @F.arrow_udf("array<struct<term: string, rank: double>>")
    def best(words: pa.Array) -> pa.Array:
        return best_terms(words, limit)

    return best


def ranked_terms(text: Column) -> Column:
    """ARRAY<STRUCT<term, rank>> of all terms of a text, in term order."""
    return _best_terms()(terms(text))


def top_terms(text: Column, limit: int = TOP_TERMS) -> Column:
    """The best terms with ranks scaled to sum 1; equal ranks go by term."""

    def scaled(best: Column) -> Column:
        total = F.aggregate(best, F.lit(0.0), lambda s, t: s + t["rank"])
        return let(
            total,
            lambda whole: F.transform(
                best,
                lambda t: F.struct(
                    t["term"].alias("term"), (t["rank"] / whole).alias("rank")
                ),
            ),
        )

    return let(_best_terms(limit)(terms(text)), scaled)


def key_terms(segments: DataFrame, *, limit: int = TOP_TERMS) -> DataFrame:
    """(video_id, segment_id, term, rank): each segment's best terms."""
    return segments.select(*_KEYS, F.inline(top_terms(F.col("text"), limit)))


def _scored(text: Column, top: Column) -> Column:
    """Sentences with score = minus the distance to the top-term vector."""
    split = F.transform(
        sentences(text),
        lambda s: F.struct(s.alias("sentence"), terms(s).alias("words")),
    )

    def score(item: Column) -> Column:
        missing = F.filter(top, lambda t: ~F.array_contains(item["words"], t["term"]))
        squares = F.aggregate(
            missing, F.lit(0.0), lambda total, t: total + t["rank"] * t["rank"]
        )
        return F.struct(
            item["sentence"].alias("sentence"),
            (F.lit(0.0) - F.round(F.sqrt(squares), SCORE_DIGITS)).alias("score"),
        )

    return F.transform(split, score)


def _best_sentence(scores: Column) -> Column:
    """Sentence with the highest score, the first of equals; '' if none."""
    placed = F.transform(
        scores,
        lambda s, i: F.struct(
            s["score"].alias("score"), (-i).alias("place"), s["sentence"].alias("text")
        ),
    )
    return F.coalesce(F.array_max(placed)["text"], F.lit(""))


def summary_and_scores(text: Column, limit: int = TOP_TERMS) -> Column:
    """STRUCT<summary, sentence_scores> of one text."""

    def result(scores: Column) -> Column:
        return F.struct(
            _best_sentence(scores).alias("summary"), scores.alias("sentence_scores")
        )

    scores = let(top_terms(text, limit), lambda top: _scored(text, top))
    return let(scores, result)


def extractive_summary(segments: DataFrame, *, limit: int = TOP_TERMS) -> DataFrame:
    """(video_id, segment_id, summary, sentence_scores), one row per segment."""
    return segments.select(
        *_KEYS, F.inline(F.array(summary_and_scores(F.col("text"), limit)))
    )


def sentence_scores(segments: DataFrame, *, limit: int = TOP_TERMS) -> DataFrame:
    """(video_id, segment_id, position, sentence, score)."""
    return (
        extractive_summary(segments, limit=limit)
        .select(*_KEYS, F.posexplode("sentence_scores").alias("position", "_s"))
        .select(
            *_KEYS,
            F.col("position").cast("bigint").alias("position"),
            F.col("_s.sentence").alias("sentence"),
            F.col("_s.score").alias("score"),
        )
    )
