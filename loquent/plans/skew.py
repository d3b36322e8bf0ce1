"""Joins whose left side may hold very many rows for one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16
#: Rows of a list that every task may hold.
SHORT = 50_000


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Equi join that spreads each left key over ``salts`` tasks.

    The salt is a hash of the left columns ``spread``, so it is the same when a
    task is run again. The right side, small next to the left, is repeated once
    per salt. Every left row meets each right row once: inner, left, left_semi
    and left_anti joins keep their meaning.

    The copies are never broadcast: Spark's estimate of their size does not know
    that rows are repeated, and the driver would have to hold them all.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    every_salt = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    copies = right.withColumn("_salt", F.explode(every_salt)).hint("merge")
    added = [c for c in right.columns if c not in on] if how in ("inner", "left") else []
    return salted.join(copies, [*on, "_salt"], how).select(*left.columns, *added)


def listed_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread: Sequence[str]
) -> DataFrame:
    """Inner join with a written list: broadcast where short, salted where long.

    Its length is read from the files, so neither choice rests on an estimate.
    """
    if right.count() > SHORT:
        return salted_join(left, right, on, spread)
    added = [c for c in right.columns if c not in on]
    return left.join(F.broadcast(right), list(on)).select(*left.columns, *added)


def listed_only(
    left: DataFrame, listed: DataFrame, on: Sequence[str], spread: Sequence[str], how: str
) -> DataFrame:
    """Rows that are (left_semi) or are not (left_anti) in a written list: broadcast
    where short, salted where long, as in ``listed_join``."""
    if listed.count() > SHORT:
        return salted_join(left, listed, on, spread, how)
    return left.join(F.broadcast(listed), list(on), how)


def restrict_to_videos(
    df: DataFrame, keys: DataFrame, how: str = "left_semi"
) -> DataFrame:
    """Rows of ``df`` whose video is (left_semi) or is not (left_anti) in ``keys``.

    A video with very many segments is spread over tasks by segment.
    """
    names = keys.select("video_id").distinct()
    if "segment_id" not in df.columns:
        return df.join(names, "video_id", how)
    return salted_join(df, names, ["video_id"], ["segment_id"], how)
