"""Exact duplicates: a tree of merges over sorted runs of digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.llm.common import boxed, lower_ascii, whole
from loquent.session import write_out

#: Two texts are taken as equal when all three agree: the digest, the length,
#: and a second hash of another family.
KEY = ("digest", "bytes", "check")
RUNS = 64
FAN_IN = 8


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, bytes, check) of every row; a null text counts as empty."""
    normal = docs.select(
        F.col(doc_id).alias("doc_id"), lower_ascii(whole(F.col(text))).alias("normal")
    )
    return normal.select(
        "doc_id",
        F.unhex(F.sha2("normal", 256)).alias("digest"),
        F.octet_length("normal").alias("bytes"),
        F.xxhash64("normal").alias("check"),
    )


def merge_runs(
    rows: DataFrame, runs: int = RUNS, fan_in: int = FAN_IN, largest: bool = False
) -> DataFrame:
    """(digest, bytes, check, keep_id, group_size): one row per text.

    Rows are dealt to ``runs`` runs. Each run is reduced to its own digests,
    map side first, so a text that fills a third of all rows leaves one entry
    per run and task. Then runs meet in rounds, ``fan_in`` at a time, as in a
    tree: what has the same digest, length and second hash is merged, and the
    retained identifier (smallest, or largest) and the sum of rows go on. A run
    is spread over tasks by digest and sorted there; no task holds a whole run.
    """
    best = F.max if largest else F.min
    level = rows.select(
        *KEY,
        F.pmod(F.xxhash64("doc_id", "digest"), F.lit(runs)).alias("run"),
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
    )
    left = runs
    merged = [best("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")]
    level = level.groupBy("run", *KEY).agg(*merged)
    while left > 1:
        left = -(-left // fan_in)
        level = (
            level.withColumn("run", F.expr(f"run div {fan_in}"))
            .repartition("run", "digest")
            .sortWithinPartitions("run", *KEY)
            .groupBy("run", *KEY)
            .agg(*merged)
        )
    return level.drop("run")


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", largest: bool = False
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the
    row with the smallest identifier stays, or with ``largest`` the largest. A
    null text counts as empty. A null identifier is retained only where a group
    has no other. Rows that repeat identifier and text are counted one by one
    and marked alike. An empty table gives no rows; further columns are not read.
    """
    rows = write_out(digests(docs, doc_id, text), "digests")
    winners = merge_runs(rows, largest=largest)
    return rows.join(winners, list(KEY)).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
    )


def _key(text: Column) -> list[Column]:
    normal = lower_ascii(whole(text))
    return [
        F.unhex(F.sha2(normal, 256)).alias("_digest"),
        F.octet_length(normal).alias("_bytes"),
        F.xxhash64(normal).alias("_check"),
    ]


def drop_exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", largest: bool = False
) -> DataFrame:
    """``docs`` with one row per text, all columns kept, whatever their names.

    The retained row is that of ``exact_duplicates``; where its identifier and
    text are repeated, one of the repeated rows stays.
    """
    winners = merge_runs(digests(docs, doc_id, text), largest=largest)
    known, none = F.coalesce("keep_id", F.lit(0)), F.col("keep_id").isNull()
    winners = winners.select(
        *[F.col(k).alias(f"_{k}") for k in KEY], known.alias("_known"), none.alias("_none")
    )
    own = F.col(doc_id)
    keyed = boxed(
        docs,
        *_key(F.col(text)),
        F.coalesce(own, F.lit(0)).alias("_known"),
        own.isNull().alias("_none"),
    )
    # The same columns join and tell repeated rows apart: texts move once.
    same = [*[f"_{k}" for k in KEY], "_known", "_none"]
    once = keyed.join(winners, same, "left_semi").dropDuplicates(same)
    return once.select("row.*")
