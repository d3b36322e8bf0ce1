"""Text helpers as column expressions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.split() and str.strip() treat as
# white space. Java's Unicode \s leaves out the four separators 1c-1f.
_SPACE = r"[\s\x1c-\x1f]"
_SPACES = rf"(?U){_SPACE}+"
_OUTER_SPACES = rf"(?U)^{_SPACE}+|{_SPACE}+$"
# The same ones by name, for a look at single characters.
_BLANKS = [
    chr(c)
    for c in (
        *range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
]

_TOKEN = r"[\p{L}\p{N}]+"
_TERM = r"\p{L}{3,}"
_SURFACE_TOKEN = r"[\p{L}\p{N}]+(?:[-'][\p{L}\p{N}]+)*"
_SENTENCE_END = r"([.!?])\s+"
_MARK = "\u0001"


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    """Text without outer white space. The pattern, which looks at every space inside
    too, only sees texts that have some."""
    first, last = F.substring(text, 1, 1), F.substring(text, -1, 1)
    outer = first.isin(_BLANKS) | last.isin(_BLANKS)
    return F.when(outer, F.regexp_replace(text, _OUTER_SPACES, "")).otherwise(text)


def words(text: Column) -> Column:
    """White-space separated words, in order."""
    return F.filter(F.split(_text(text), _SPACES), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of white-space separated words; 0 for empty or null text."""
    stripped = strip(_text(text))
    none = F.when(stripped == "", 1).otherwise(0)
    return (F.size(F.split(stripped, _SPACES)) - none).cast("bigint")


def tokens(text: Column) -> Column:
    """Lower-case letter or digit runs: the vocabulary of the lexical encoder."""
    return F.regexp_extract_all(F.lower(_text(text)), F.lit(_TOKEN), F.lit(0))


def terms(text: Column) -> Column:
    """Lower-case letter runs of three or more: the vocabulary of TextRank."""
    return F.regexp_extract_all(F.lower(_text(text)), F.lit(_TERM), F.lit(0))


def surface_tokens(text: Column) -> Column:
    """Tokens as written, inner hyphens and apostrophes kept."""
    return F.regexp_extract_all(_text(text), F.lit(_SURFACE_TOKEN), F.lit(0))


def sentences(text: Column) -> Column:
    """Sentences in order; a sentence ends at ``.``, ``!`` or ``?`` plus space."""
    marked = F.regexp_replace(strip(_text(text)), _SENTENCE_END, f"$1{_MARK}")
    return F.filter(F.split(marked, _MARK), lambda s: s != "")


def prefix(text: Column, length: int) -> Column:
    """First ``length`` characters; null becomes ''."""
    return F.substring(_text(text), 1, length)


def title_or_default(title: Column, default: str = "(untitled)") -> Column:
    return F.coalesce(F.nullif(title, F.lit("")), F.lit(default))


def format_time(seconds: Column) -> Column:
    """Seconds as ``m:ss``, fraction cut off, minutes unbounded."""
    whole = seconds.cast("bigint")
    minutes = F.floor(whole / 60).cast("string")
    return F.concat(minutes, F.lit(":"), F.lpad((whole % 60).cast("string"), 2, "0"))
