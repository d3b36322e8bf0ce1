"""Summary quality metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loquent.functions.binding import let
from loquent.functions.text import strip, tokens, word_count
from loquent.functions.vectors import dense_cosine, token_cosine


def ratio_of_counts(original_words: Column, summary_words: Column) -> Column:
    """Summary words per original word; null when the original has none."""
    return F.when(original_words > 0, summary_words.cast("double") / original_words)


def compression_ratio(original: Column, summary: Column) -> Column:
    return ratio_of_counts(word_count(original), word_count(summary))


def semantic_similarity(text_a: Column, text_b: Column) -> Column:
    """Lexical cosine of two texts; ('', '') is 1.0."""
    # Equal texts need no counting: bags of no tokens are equal, too.
    differ = F.coalesce(text_a, F.lit("")) != F.coalesce(text_b, F.lit(""))
    a, b = (F.when(differ, tokens(text)) for text in (text_a, text_b))
    return token_cosine(a, b)


def embedding_similarity(vector_a: Column, vector_b: Column) -> Column:
    """Cosine of vectors the caller's own encoder made."""
    return dense_cosine(vector_a, vector_b)


def textrank_lookup(scores: Column, target: Column) -> Column:
    """Score stored for ``target``, an exact match after trimming the target.

    ``scores`` is ARRAY<STRUCT<sentence, score>>. The last of equal sentences
    counts; an empty target or a miss gives null. The keys are not trimmed.
    """
    wanted = strip(F.coalesce(target, F.lit("")))
    hits = let(wanted, lambda w: F.filter(scores, lambda s: (s["sentence"] == w) & (w != "")))
    return F.try_element_at(hits, F.lit(-1))["score"]


def compute_all(
    original: Column, ext_summary: Column, abs_summary: Column, scores: Column
) -> dict[str, Column]:
    """The three metrics of one segment, by column name."""
    return {
        "compression_ratio": compression_ratio(original, abs_summary),
        "semantic_similarity": semantic_similarity(ext_summary, abs_summary),
        "textrank_score": textrank_lookup(scores, ext_summary),
    }
