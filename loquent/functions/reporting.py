"""Report lines and the batch outcome line format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OUTCOME_MARKER = "VIDEO_DONE"


# The formats of the lines below.
def pair_line(a: Column, b: Column, videos: Column, segments: Column) -> Column:
    return F.format_string("%s <-> %s: %d videos, %d segments", a, b, videos, segments)


def entity_line(text: Column, kind: Column, count: Column) -> Column:
    return F.format_string("%s (%s): %d", text, kind, count)


def _two_decimals(value: Column) -> Column:
    """Text with two decimals, rounded from the exact binary value, halves to the
    even digit.

    A double below 8 is a whole number of 2**-60 (smaller bits are far from any
    half), one below 2**14 of 2**-49, so halves are told apart in whole numbers.
    """
    size = F.abs(value)
    unit = F.when(size < 8, F.lit(1 << 60)).otherwise(F.lit(1 << 49))
    below = F.floor(size * 100)
    exact = (size * unit).try_cast("bigint").cast("decimal(19,0)") * 200
    half = (below * 2 + 1).cast("decimal(12,0)") * unit.cast("decimal(19,0)")
    up = (exact > half) | ((exact == half) & (below % 2 == 1))
    hundredths = below + F.when(up, 1).otherwise(0)
    shown = F.format_string(
        "%s%d.%02d",
        F.when(value < 0, F.lit("-")).otherwise(F.lit("")),
        F.floor(hundredths / 100),
        hundredths % 100,
    )
    return F.when(size < 1 << 14, shown).otherwise(F.format_string("%.2f", value))


def averages_line(avg_ratio: Column, avg_similarity: Column) -> Column:
    """Both averages with two decimals, halves to the even digit; '' if either
    is missing."""
    line = F.format_string(
        "Avg compression ratio: %s · Avg semantic similarity: %s",
        _two_decimals(avg_ratio),
        _two_decimals(avg_similarity),
    )
    both = avg_ratio.isNotNull() & avg_similarity.isNotNull()
    return F.when(both, line).otherwise(F.lit(""))


def outcome_line(
    position: Column, total: Column, identifier: Column, error: Column
) -> Column:
    """One line per finished list entry; an unreadable id becomes 'unknown'."""
    return F.format_string(
        f"{OUTCOME_MARKER} %d/%d %s %s",
        position,
        total,
        F.coalesce(identifier, F.lit("unknown")),
        F.when(error.isNull(), F.lit("ok")).otherwise(F.lit("failed")),
    )


def parse_outcome(line: Column, marker: str = OUTCOME_MARKER) -> Column:
    """STRUCT<position, total, video_id, ok>, or null if the line is no outcome."""
    pattern = rf"{marker} (\d+)/(\d+) (\S+) (ok|failed)"

    def part(group: int) -> Column:
        return F.regexp_extract(line, pattern, group)

    parsed = F.struct(
        part(1).try_cast("bigint").alias("position"),
        part(2).try_cast("bigint").alias("total"),
        part(3).alias("video_id"),
        (part(4) == "ok").alias("ok"),
    )
    return F.when(line.rlike(pattern), parsed)
