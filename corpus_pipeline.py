"""A corpus pipeline of five operators.

Toxic documents go, one document of each group of equal texts and of near
duplicates stays, sources are mixed to target weights (a document taken twice is
there twice), and what is left is encoded and decoded again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loquent.llm import bpe, exact, mixing, simhash, toxicity
from loquent.llm.common import table
from loquent.llm.queries import toxicity_model
from loquent.session import write_out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity is below 0.5, by the model of the labelled documents.

    Null and empty texts have the score of a text that saves nothing; equal rows
    fare alike; an empty table gives none.
    """
    labelled = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.drop_toxic(docs, toxicity_model(spark, sf_dir, labelled))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case), the row with the largest doc_id.

    A null text equals an empty one. Of rows that repeat text and doc_id one
    stays; a null doc_id stays only where its text has no other.
    """
    return exact.drop_exact_duplicates(docs, largest=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of SimHash near-duplicates, the smallest doc_id.

    Shingles of three words, at most 3 bits apart; links reach on over other
    documents. Texts without words, null ones included, have fingerprint zero.
    """
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix of sources takes it, three times at most.

    A null source is a source of its own. Texts without words count no word, so
    they follow the turns of their source.
    """
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, and the digests of ids and decoded text of each row.

    A null text is encoded as an empty one; repeated rows get a row each.
    """
    return bpe.round_trip(docs.select("doc_id", "source", "text")).drop("text")


STAGES = [
    ("drop_toxic", drop_toxic),
    ("drop_copies", drop_copies),
    ("drop_near_copies", drop_near_copies),
    ("mix_sources", mix_sources),
    ("encode", encode),
]
#: SQL cannot fit the model of the first stage; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_out(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
