"""Vectors of texts by a caller's own encoder.

The encoder is opened once per partition and asked for lists of texts, each text
once as long as it is remembered. Texts stay in their rows, so nothing is shuffled,
and a text that is everywhere is known everywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.functions.metrics import embedding_similarity

#: Opens an encoder: the function it returns takes a list of texts and gives as many
#: vectors of one length. It must be importable or picklable on the executors.
OpenEncoder = Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]]

#: Vectors a task remembers; when they are that many, it begins anew.
REMEMBERED = 10_000


class _Memory:
    """Answers of an encoder by digest of the text."""

    def __init__(self, open_encoder: OpenEncoder, remembered: int):
        self.encode = open_encoder()
        self.remembered = remembered
        self.known: dict[bytes, list[float]] = {}

    def vectors(self, texts: pd.Series) -> list[list[float] | None]:
        keys = [
            None if t is None else blake2b(t.encode(), digest_size=16).digest() for t in texts
        ]
        if len(self.known) >= self.remembered:
            self.known = {}
        new = {k: t for k, t in zip(keys, texts) if k is not None and k not in self.known}
        if new:
            answers = self.encode(list(new.values()))
            if len(answers) != len(new):
                raise ValueError(f"{len(new)} texts, {len(answers)} vectors")
            self.known.update(
                (k, [float(x) for x in vector]) for k, vector in zip(new, answers)
            )
        return [None if k is None else self.known[k] for k in keys]


def embed(
    rows: DataFrame,
    columns: Mapping[str, str],
    open_encoder: OpenEncoder,
    *,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """``rows`` with a vector column for every text column named in ``columns``.

    A null text has a null vector and is not given to the encoder; an empty one is.
    """
    schema = ", ".join(f"v{i} ARRAY<DOUBLE>" for i in range(len(columns)))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = _Memory(open_encoder, remembered)
        for batch in batches:
            vectors = {f"v{i}": memory.vectors(batch[c]) for i, c in enumerate(batch.columns)}
            yield pd.DataFrame({k: pd.Series(v, dtype=object) for k, v in vectors.items()})

    texts = F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate(columns)])
    made = F.pandas_udf(encode, schema)(texts)
    kept = [c for c in rows.columns if c not in columns.values()]
    vectors = [F.col(f"_vectors.v{i}").alias(out) for i, out in enumerate(columns.values())]
    return rows.withColumn("_vectors", made).select(*kept, *vectors)


def vector_similarity(text_a: Column, text_b: Column, vector_a: Column, vector_b: Column) -> Column:
    """Cosine of the vectors of two texts; ('', '') is 1.0, one empty text 0.0."""
    return (
        F.when((text_a == "") & (text_b == ""), F.lit(1.0))
        .when((text_a == "") | (text_b == ""), F.lit(0.0))
        .otherwise(embedding_similarity(vector_a, vector_b))
    )
