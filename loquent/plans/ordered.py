"""Ordered computations that do not put one group into one task.

A window partitioned by video sorts a whole video in one task, which fails when
one video holds a large share of all rows. Here a group is cut into chunks of
consecutive ids, windows run inside (group, chunk), and only one small row per
chunk goes through a window over the group. Ids are unique inside a group, so a
chunk holds at most ``size`` rows. Ids that leave wide gaps only give emptier
chunks; results stay the same.

Joins back to the rows also use (group, chunk), so they are as balanced as the
windows and reuse their partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loquent.plans.skew import listed_only
from loquent.session import write_out

CHUNK_SIZE = 65_536
CHUNK = "_chunk"


def with_chunk(df: DataFrame, order: str, size: int = CHUNK_SIZE) -> DataFrame:
    return df.withColumn(CHUNK, F.expr(f"`{order}` div {size}"))


def _sums_before(totals: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """``_total`` replaced by ``_before``: the sum of the totals before it."""
    earlier = (
        Window.partitionBy(*by)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_total").over(earlier), F.lit(0))
    return totals.withColumn("_before", before).drop("_total")


def running_sum(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    value: Column,
    out: str,
    *,
    ties: Sequence[str] = (),
    size: int = CHUNK_SIZE,
    chunks: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over this row and all earlier ones.

    ``by`` may be empty for one running sum over everything. The chunk totals
    are then summed in chunks once more, so that the one window without a
    partition has a row per ``size * size`` consecutive ids.

    ``chunks`` may hold the chunks of every group (``by`` and chunk), written out: the
    totals of a group that is one chunk are not needed then, nor worked out.
    """
    chunked = with_chunk(df, order, size).withColumn("_value", value)
    group = [*by, CHUNK]
    inside = (
        Window.partitionBy(*group)
        .orderBy(order, *ties)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = F.sum("_value").over(inside)
    if by and chunks is not None:
        ends = chunks.groupBy(*by).agg(
            F.min(CHUNK).alias("_first"),
            F.max(CHUNK).alias("_last"),
            F.count_if(F.col(CHUNK).isNull()).alias("_none"),
        )
        # Rows without an id are a chunk of their own, before the others.
        several = ends.filter("_first < _last OR _none > 0").select(*by)
        several = write_out(several, "several_chunks")
        kept = chunked.na.drop(subset=group).withColumn("_local", local)
        if several.isEmpty():
            return kept.withColumn(out, F.col("_local")).select(*df.columns, out)
        summed = listed_only(chunked, several, by, [order], "left_semi")
        totals = summed.groupBy(*group).agg(F.sum("_value").alias("_total"))
        sums = _sums_before(totals, by, CHUNK)
        placed = kept.join(sums, group, "left")
        total = F.coalesce("_before", F.lit(0)) + F.col("_local")
        return placed.withColumn(out, total).select(*df.columns, out)
    totals = chunked.groupBy(*group).agg(F.sum("_value").alias("_total"))
    if by:
        sums = _sums_before(totals, by, CHUNK)
    else:
        parts = with_chunk(totals.withColumnRenamed(CHUNK, "_part"), "_part", size)
        wholes = parts.groupBy(CHUNK).agg(F.sum("_total").alias("_total"))
        outer = _sums_before(wholes, [], CHUNK).withColumnRenamed("_before", "_outer")
        inner = _sums_before(parts, [CHUNK], "_part").join(outer, CHUNK)
        sums = inner.select(
            F.col("_part").alias(CHUNK),
            (F.col("_before") + F.col("_outer")).alias("_before"),
        )
    return (
        chunked.withColumn("_local", local)
        .join(sums, group)
        .withColumn(out, F.col("_before") + F.col("_local"))
        .select(*df.columns, out)
    )


def attach(
    df: DataFrame,
    values: DataFrame,
    by: Sequence[str],
    order: str,
    *,
    size: int = CHUNK_SIZE,
) -> DataFrame:
    """Left join of one ``values`` row per group onto the rows of the group.

    The values first go to the chunks of their group and from there to the
    rows, so a hot group is spread over its chunks.
    """
    chunked = with_chunk(df, order, size)
    per_chunk = chunked.select(*by, CHUNK).distinct().join(values, list(by))
    added = [c for c in values.columns if c not in by]
    return chunked.join(per_chunk, [*by, CHUNK], "left").select(*df.columns, *added)


def with_handed(df: DataFrame, by: str, order: str, *, size: int = CHUNK_SIZE) -> DataFrame:
    """Rows with their chunk, and the last row of each chunk also in the next one.

    The latter have a true ``_handed``. Which rows that are, one small row per chunk
    that has a next one, is written out: nothing else is gathered for them.
    """
    chunked = with_chunk(df, order, size)
    lasts = chunked.groupBy(by, CHUNK).agg(F.max(order).alias(order))
    following = F.lead(CHUNK).over(Window.partitionBy(by).orderBy(CHUNK))
    ends = lasts.withColumn("_next", following).filter(F.col("_next").isNotNull())
    ends = write_out(ends.select(by, order, "_next"), "chunk_ends")
    handed = chunked.join(ends, [by, order]).withColumn(CHUNK, F.col("_next")).drop("_next")
    return chunked.withColumn("_handed", F.lit(False)).unionByName(
        handed.withColumn("_handed", F.lit(True))
    )


def with_previous(
    df: DataFrame,
    by: str,
    order: str,
    payload: str,
    out: str,
    *,
    code: Column | None = None,
    size: int = CHUNK_SIZE,
) -> DataFrame:
    """Add ``out``: ``payload`` of the row before, null on a group's first row.

    ``payload`` names a column; with ``code`` it becomes that expression over it once
    the rows are where their windows run, so the column, not the code, is shuffled.
    The last row of each chunk is also handed to the group's next chunk, where
    it only serves the row after it and is then dropped.
    """
    both = with_handed(df, by, order, size=size)
    if code is not None:
        both = both.repartition(by, CHUNK).withColumn(payload, code)
    inside = Window.partitionBy(by, CHUNK).orderBy(order)
    return (
        both.withColumn(out, F.lag(payload).over(inside))
        .filter(~F.col("_handed"))
        .drop(CHUNK, "_handed")
    )
