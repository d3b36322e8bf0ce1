"""Entity mentions from a gazetteer and from patterns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loquent.functions.binding import let
from loquent.functions.text import surface_tokens
from loquent.plans.skew import listed_join
from loquent.session import write_out

# The entity types kept.
ALLOWED_TYPES = ("PERSON", "ORG", "GPE", "DATE", "PRODUCT")

DATE_PATTERNS = (
    r"^(?:19|20)\d{2}$",
    r"^\d{4}-\d{2}-\d{2}$",
    r"^(?:January|February|March|April|May|June|July|August|September|October"
    r"|November|December) \d{1,2}(?: (?:19|20)\d{2})?$",
)
DEFAULT_PATTERNS: Mapping[str, Sequence[str]] = {"DATE": DATE_PATTERNS}

_KEYS = ["video_id", "segment_id"]


def allowed(types: Column, allowlist: Sequence[str] = ALLOWED_TYPES) -> Column:
    return types.isin(list(allowlist))


#: More than the tokens of any text: spans sort by start, longer ones first.
_SPAN = 1 << 31
_MARK = "\u0001"


def _whole_tokens(pattern: str) -> str:
    """A regular expression that is empty where a run of whole tokens begins that
    ``pattern`` matches; its first group is the run."""
    body = re.sub(r"(?<!\\)\$$", "", pattern.removeprefix("^"))
    return rf"(?<![^ ])(?=((?:{body}))(?![^ ]))"


def _somewhere(pattern: str) -> str:
    """A regular expression found in a text exactly if ``_whole_tokens`` is. It looks
    for the space before a token, not back from every character."""
    body = re.sub(r"(?<!\\)\$$", "", pattern.removeprefix("^"))
    return rf"(?:^| )(?:{body})(?![^ ])"


def _needs_digit(pattern: str) -> bool:
    """Whether a match surely holds one of the digits 0 to 9: the pattern has a ``\\d``
    outside of any choice or class that may not be left out. False where that is not
    plain, as with flags or what only Java's expressions know."""
    if re.search(r"\(\?(?!:)|\[[^\]]*(?:\[|&&)", pattern):
        return False

    def needed(items) -> bool:
        for kind, value in items:
            name = str(kind)
            if name == "IN" and [(str(a), str(b)) for a, b in value] == [("CATEGORY", "CATEGORY_DIGIT")]:
                return True
            if name == "SUBPATTERN" and needed(value[-1]):
                return True
            if name.endswith("REPEAT") and value[0] > 0 and needed(value[-1]):
                return True
            if name == "BRANCH" and all(needed(branch) for branch in value[1]):
                return True
        return False

    try:
        return needed(re._parser.parse(pattern))
    except re.error:
        return False


_HIT = "ARRAY<STRUCT<position: INT, length: INT, phrase: STRING, kind: STRING>>"


def _pattern_hits(words: Column, patterns: Mapping[str, Sequence[str]]) -> Column | None:
    """Runs of tokens that patterns match, as (position, length, phrase, kind).

    The patterns run over the tokens joined by spaces. Marks put in where they
    match say which tokens that is: the k-th marked token begins the k-th match.
    Most texts have no match, which one search tells.
    """

    def of_pattern(joined: Column, kind: str, pattern: str) -> Column:
        rule = F.lit(_whole_tokens(pattern))
        runs = F.regexp_extract_all(joined, rule, F.lit(1))
        marked = F.split(F.regexp_replace(joined, rule, F.lit(_MARK)), " ")
        starts = F.filter(
            F.transform(marked, lambda t, i: F.when(t.startswith(_MARK), i)),
            lambda i: i.isNotNull(),
        )
        hits = F.zip_with(
            starts,
            runs,
            lambda start, run: F.struct(
                start.alias("position"),
                F.size(F.split(run, " ")).alias("length"),
                run.alias("phrase"),
                F.lit(kind).alias("kind"),
            ),
        )
        hits = F.filter(hits, lambda h: h["phrase"] != "")
        none = F.expr(f"CAST(ARRAY() AS {_HIT})")
        return F.when(joined.rlike(_somewhere(pattern)), hits).otherwise(none)

    rules = [(kind, pattern) for kind, own in patterns.items() for pattern in own]
    if not rules:
        return None
    return let(
        F.array_join(words, " "),
        lambda joined: F.concat(*[of_pattern(joined, k, p) for k, p in rules]),
    )


def _gazetteer_hits(words: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Listed phrases in texts, as rows (keys, position, length, phrase, kind).

    The list is walked as a trie from table to table: a token meets the first tokens
    of listed phrases; where one meets, it and the pair it begins meet the heads of
    phrases; where one meets, the phrase lengths known for that head are cut out and
    met with whole phrases. What leaves the first join are beginnings of listed
    phrases, and only for them are runs of tokens cut. Whether a table is broadcast
    follows from its length; else common tokens and heads are salted.
    """
    listed = gazetteer.filter(F.col("phrase").isNotNull() & F.col("entity_type").isNotNull())
    parts = F.split("phrase", " ")
    head = F.array_join(F.slice(parts, 1, 2), " ")
    heads = listed.groupBy(head.alias("_head")).agg(F.collect_set(F.size(parts)).alias("_lengths"))
    # Written out, their lengths are known, and short ones are broadcast: texts then
    # meet them where they are read.
    heads = write_out(heads, "heads")
    firsts = write_out(listed.select(F.get(parts, F.lit(0)).alias("_first")).distinct(), "firsts")
    longest = listed.agg(F.max(F.size(parts))).first()[0] or 1
    whole = listed.select(F.col("phrase").alias("_key"), F.col("entity_type").alias("kind")).distinct()
    whole = write_out(whole, "phrases")

    # An outer explode: else Spark asks for the number of tokens in a filter, for which
    # they are looked for twice.
    placed = words.select(*_KEYS, "_words", F.posexplode_outer("_words").alias("position", "_word"))
    run = F.slice("_words", F.col("position") + 1, longest)
    starts = placed.select(*_KEYS, "position", run.alias("_run"), F.lower("_word").alias("_first"))
    starts = listed_join(starts, firsts, ["_first"], [*_KEYS, "position"])
    pair = F.when(F.size("_run") > 1, F.lower(F.array_join(F.slice("_run", 1, 2), " ")))
    begun = starts.select(
        *_KEYS, "position", "_run", F.explode(F.array("_first", pair)).alias("_head")
    ).filter(F.col("_head").isNotNull())
    begun = listed_join(begun, heads, ["_head"], [*_KEYS, "position"])
    lengths = F.filter("_lengths", lambda n: n <= F.size("_run"))
    cut = begun.select(*_KEYS, "position", "_run", F.explode(lengths).alias("length"))
    phrase = F.array_join(F.slice("_run", 1, F.col("length")), " ")
    cut = cut.select(*_KEYS, "position", "length", phrase.alias("phrase"))
    cut = cut.withColumn("_key", F.lower("phrase"))
    found = listed_join(cut, whole, ["_key"], [*_KEYS, "position"])
    return found.select(*_KEYS, "position", "length", "phrase", "kind")


def find_mentions(
    segments: DataFrame,
    gazetteer: DataFrame | None = None,
    *,
    patterns: Mapping[str, Sequence[str]] = DEFAULT_PATTERNS,
    pattern_words: int | None = None,
) -> DataFrame:
    """Every typed phrase as (video_id, segment_id, position, entity_text,
    entity_type), all types included.

    ``gazetteer`` has (phrase, entity_type) with lower-case phrases of
    space-separated tokens, of any number. Patterns are regular expressions over
    tokens joined by single spaces; a match is whole tokens, any number of them or
    up to ``pattern_words``, so ``^`` and ``$`` around a pattern change nothing. From
    each token a pattern has one match, the one that the expression prefers. Groups
    may not be referred to by number. A phrase inside a longer matched one is
    dropped. What patterns find does not depend on the gazetteer, nor the reverse,
    but for that.
    """
    words = segments.select(*_KEYS, surface_tokens(F.col("text")).alias("_words"))
    hits = _pattern_hits(F.col("_words"), patterns)
    found = None
    if hits is not None:
        # Where every pattern asks for a digit, texts without one are not looked into.
        inside = segments
        if all(_needs_digit(p) for own in patterns.values() for p in own):
            inside = segments.filter(F.col("text").rlike("[0-9]"))
        inside = inside.select(*_KEYS, surface_tokens(F.col("text")).alias("_words"))
        found = inside.select(*_KEYS, F.inline(hits))
        if pattern_words is not None:
            found = found.filter(F.col("length") <= pattern_words)
    if gazetteer is not None:
        listed = _gazetteer_hits(words, gazetteer)
        found = listed if found is None else found.unionByName(listed)
    if found is None:
        found = words.limit(0).select(
            *_KEYS, F.expr("0 AS position"), F.expr("0 AS length"), F.expr("'' AS phrase"), F.expr("'' AS kind")
        )
    start = F.col("position").cast("bigint")
    spans = found.withColumn("_span", start * _SPAN + (_SPAN - F.col("length")))
    # Spans sort by start, longer first, so a span lies in another one exactly if
    # a span before it reaches its end. Equal spans are not before each other.
    by_segment = Window.partitionBy(*_KEYS)
    before = by_segment.orderBy("_span").rangeBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.col("position") + F.col("length")).over(before)
    twin = F.lag(F.struct("_span", "kind")).over(by_segment.orderBy("_span", "kind"))
    kept = spans.withColumn("_reach", reach).withColumn("_twin", twin)
    return kept.filter(
        (F.col("_reach").isNull() | (F.col("_reach") < F.col("position") + F.col("length")))
        & ~F.col("_twin").eqNullSafe(F.struct("_span", "kind"))
    ).select(
        *_KEYS,
        start.alias("position"),
        F.col("phrase").alias("entity_text"),
        F.col("kind").alias("entity_type"),
    )


def first_mentions(mentions: DataFrame) -> DataFrame:
    """One row per (segment, text, type), at its first position."""
    return mentions.groupBy(*_KEYS, "entity_text", "entity_type").agg(
        F.min("position").alias("position")
    )


def extract_entities(
    segments: DataFrame,
    gazetteer: DataFrame | None = None,
    *,
    patterns: Mapping[str, Sequence[str]] = DEFAULT_PATTERNS,
    allowlist: Sequence[str] = ALLOWED_TYPES,
    pattern_words: int | None = None,
) -> DataFrame:
    """Distinct mentions of the allowed types, 0..n rows per segment."""
    found = find_mentions(
        segments, gazetteer, patterns=patterns, pattern_words=pattern_words
    )
    return first_mentions(found.filter(allowed(F.col("entity_type"), allowlist)))
