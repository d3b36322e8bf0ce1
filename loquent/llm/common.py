"""Helpers the operators share: tables, words, and column mapping in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# The white space that parts words, as characters.
WHITE = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Rows that are Python values at a time; a batch of Arrow's holds many more.
ROWS = 512


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are.

    Spark's quick ``lower`` does the same where every character is ASCII.
    """
    plain = F.char_length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def boxed(docs: DataFrame, *more: Column) -> DataFrame:
    """The rows of ``docs`` as one struct ``row``, with the columns ``more``.

    The caller's names, whatever they are, then meet no name of ours;
    ``select("row.*")`` gives them back.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*own).alias("row"), *more)


def map_columns(
    df: DataFrame,
    inputs: Sequence[str],
    added: str,
    make: Callable[[], Callable[..., Sequence[Sequence]]],
) -> DataFrame:
    """``df`` with further columns computed in Python over Arrow batches.

    ``make`` runs once in every task and returns the function that maps the
    input columns, as lists, to one list per column of the schema ``added``. An
    added column replaces one of the same name. The lists are at most ``ROWS``
    long, so that a worker never holds a whole batch as Python values.
    """
    fields = T.StructType.fromDDL(added)
    kept = [f for f in df.schema if f.name not in fields.fieldNames()]
    schema = T.StructType([*kept, *fields])
    types = [f.type for f in to_arrow_schema(fields)]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, ROWS):
                batch = whole_batch.slice(start, ROWS)
                columns = [batch.column(batch.schema.get_field_index(c)) for c in inputs]
                results = function(*[c.to_pylist() for c in columns])
                old = [batch.column(batch.schema.get_field_index(c)) for c in names]
                new = [pa.array(r, type=t) for r, t in zip(results, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*old, *new], names=schema.fieldNames())

    return df.mapInArrow(run, schema)


def row_of(aggregate: DataFrame) -> dict:
    """The one row of an aggregate over everything."""
    return aggregate.first().asDict()


def pick(rows: DataFrame, group: str, most: int, texts: DataFrame) -> list[tuple]:
    """(text, group) of up to ``most`` rows of each group, picked by a hash.

    ``rows`` has ``doc_id`` and the group; ``texts`` has ``doc_id`` and ``text``.
    Only identifiers are ordered; texts of the picked ones are then looked up, so
    at most ``most`` texts per group come to the driver, one per identifier.
    """
    found: list[tuple] = []
    once = rows.select("doc_id", group).distinct()
    names = sorted(r[group] for r in once.select(group).distinct().collect())
    for name in names:
        own = once.filter(F.col(group) == name)
        chosen = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        joined = texts.join(F.broadcast(chosen.select("doc_id")), "doc_id")
        least = joined.groupBy("doc_id").agg(F.min("text").alias("text"))
        found += [(r["text"], name) for r in least.select("text").collect()]
    return found
