"""Personal data in text: weak labelers, their reliabilities, a span classifier.

Base patterns find what is certain. Wider patterns propose candidates; labelers
(regular expressions, word lists, neighbouring characters) vote on each or
abstain. Expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is, and a logistic classifier is trained on the resulting
probabilities. It becomes a Spark expression and adds spans. All work on texts is
in Spark functions; the driver sees one row per vote pattern, at most
``len(WIDE) * 3 ** 4``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.llm.common import whole

# Kinds in order, and their patterns. Quantifiers are possessive
# and starts are bound to the start of a run where that changes no match, so
# that long runs take linear time.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: What a text must contain for a pattern to be tried.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
ALL_KINDS = (*KINDS, "secret")
#: Patterns of candidates beyond the base, and the kind they are of.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+(])\(?[0-9](?:[ ().-]{0,2}+[0-9]){6,18}+",
    "secret": r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{20,}+",
}
WIDE_NEEDS = {"email": r"[\[(](?:at|AT)[\])]", "phone": "[0-9]{2}", "secret": "[A-Za-z0-9_]{20}"}
#: Words before a span that speak for and against personal data.
FOR = "call phone tel telephone mobile fax card visa credit mail email contact token password passwd key secret api ssn iban".split()
AGAINST = "page pages year version chapter section isbn figure table line no nr number id".split()
BEFORE = 24
_SPAN = "array<struct<start:int,end:int,hit:string>>"


def spans(text: Column, pattern: str, needs: str) -> Column:
    """Matches of a pattern as (start, end, hit), in code points, end exclusive.

    The parts between matches give their places: a match starts where all parts
    and matches before it end.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(
        hits, gaps, lambda hit, gap: F.struct(hit.alias("hit"), F.length(gap).alias("gap"))
    )
    empty = F.array().cast(_SPAN)

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("hit"))
        return F.struct(
            end.alias("at"), F.concat(state["found"], F.array(span)).alias("found")
        )

    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))
    found = F.aggregate(
        F.filter(pairs, lambda p: p["hit"].isNotNull()), start, add, lambda s: s["found"]
    )
    return F.when(text.rlike(needs), found).otherwise(empty)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check of card numbers."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))

    def weighed(value: Column, i: Column) -> Column:
        twice = value * 2
        return F.when(i % 2 == 0, value).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.transform(values, weighed), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    size = F.length(_digits(hit))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return hit.rlike(f"^{_PART}(?:[.]{_PART}){{3}}$")
    if kind == "card":
        return F.when(size.between(13, 19), luhn(_digits(hit))).otherwise(F.lit(False))
    return size.between(9, 15)


def _holds_good(kind: str) -> Callable[[Column], Column]:
    return lambda span: _valid(kind, span["hit"])


def _placed(kind: Column | None = None) -> Callable[[Column], Column]:
    """A span as (kind, start, end)."""

    def place(span: Column) -> Column:
        own = span["kind"] if kind is None else kind
        return F.struct(
            own.alias("kind"), span["start"].alias("start"), span["end"].alias("end")
        )

    return place


def of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def base_spans(text: Column) -> list[Column]:
    """One column per kind: the spans of the base patterns that hold good."""
    return [
        F.filter(spans(text, BASE[k], NEEDS[k]), _holds_good(k)).alias(f"_{k}")
        for k in KINDS
    ]


def _votes(kind: str, text: Column, s: Column) -> list[Column]:
    """Votes of the labelers on a candidate: 1 for, 0 against, null abstains."""
    size = F.length(_digits(s["hit"]))
    first = F.greatest(s["start"] - BEFORE, F.lit(0))
    before = text.substr(first + 1, s["start"] - first)
    left = text.substr(s["start"], F.when(s["start"] > 0, 1).otherwise(0))
    right = text.substr(s["end"] + 1, F.lit(1))
    word = F.lower(F.regexp_extract(before, r"([A-Za-z]+)[^A-Za-z]*$", 1))
    if kind == "email":
        shape = F.when(s["hit"].rlike(r"[.\])] ?[A-Za-z]{2,6}$"), 1).otherwise(0)
        form = F.when(s["hit"].rlike("[0-9]"), 1)
    elif kind == "phone":
        shape = F.when(
            s["hit"].rlike(r"^\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}$"), 1
        ).when(s["hit"].rlike("^[0-9]+$"), 0)
        form = F.when(size >= 13, F.when(luhn(_digits(s["hit"])), 1).otherwise(0)).when(
            size < 9, 0
        )
    else:
        shape = F.when(s["hit"].rlike("^(?:[0-9a-f]{20,}|[A-Za-z0-9]{20,})$") & s["hit"].rlike("[0-9]"), 1).otherwise(0)
        form = F.when(s["hit"].rlike("[0-9].*[A-Za-z].*[0-9]"), 1).when(~s["hit"].rlike("[0-9]"), 0)
    listed = F.when(word.isin(FOR), 1).when(word.isin(AGAINST), 0)
    beside = F.when(left.rlike("[A-Za-z0-9_]") | right.rlike("[A-Za-z0-9_]"), 0).when(
        left.rlike("[=:\"'(]"), 1
    )
    return [v.cast("int") for v in (shape, form, listed, beside)]


def _voted(kind: str, text: Column) -> Callable[[Column], Column]:
    """A candidate span with its kind and votes."""

    def voted(s: Column) -> Column:
        votes = [v.alias(f"v{i}") for i, v in enumerate(_votes(kind, text, s))]
        of = F.lit(kind)
        if kind == "phone":
            long = F.length(_digits(s["hit"])) >= 13
            of = F.when(long, "card").otherwise("phone")
        return F.struct(
            of.alias("kind"),
            F.lit(kind).alias("wide"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            *votes,
        )

    return voted


def _candidates(text: Column) -> Column:
    """All candidates of a text with their votes, base matches not excluded."""
    parts = [
        F.transform(spans(text, pattern, WIDE_NEEDS[kind]), _voted(kind, text))
        for kind, pattern in WIDE.items()
    ]
    return F.concat(*parts)


@dataclass(frozen=True)
class Model:
    """Per wide kind: intercept and a weight for each labeler's vote for and against."""

    weights: dict[str, tuple[float, ...]]


def _expect(patterns: Sequence[tuple[tuple, int]]) -> list[float]:
    """Probability that candidates of each vote pattern are personal data.

    Dawid and Skene's model for two classes: each labeler votes for, against, or
    abstains with probabilities of the class; started from the share of votes
    for, and smoothed.
    """
    labelers = range(len(patterns[0][0])) if patterns else range(0)
    belief = []
    for votes, _ in patterns:
        cast = [v for v in votes if v is not None]
        belief.append((sum(cast) + 0.5) / (len(cast) + 1))
    for _ in range(60):
        mass = [0.0, 0.0]
        table = [[{1: 0.5, 0: 0.5, None: 0.5} for _ in labelers] for _ in (0, 1)]
        for (votes, n), b in zip(patterns, belief, strict=True):
            for y, share in ((1, b), (0, 1 - b)):
                mass[y] += n * share
                for j in labelers:
                    table[y][j][votes[j]] += n * share
        new = []
        for votes, _ in patterns:
            score = [0.0, 0.0]
            for y in (0, 1):
                score[y] = math.log((mass[y] + 1) / (sum(mass) + 2))
                for j in labelers:
                    own = table[y][j]
                    score[y] += math.log(own[votes[j]] / sum(own.values()))
            new.append(1 / (1 + math.exp(max(-50, min(50, score[0] - score[1])))))
        belief = new
    return belief


def _features(votes: tuple) -> list[float]:
    return [1.0] + [float(v == y) for v in votes for y in (1, 0)]


def _train(patterns: Sequence[tuple[tuple, int]], belief: Sequence[float]) -> tuple[float, ...]:
    """Logistic weights on the votes, by gradient steps on the beliefs."""
    total = sum(n for _, n in patterns) or 1
    width = len(_features(patterns[0][0])) if patterns else 9
    w = [0.0] * width
    for _ in range(2000):
        slope = [0.02 * x / total for x in w]
        for (votes, n), b in zip(patterns, belief, strict=True):
            x = _features(votes)
            z = sum(p * q for p, q in zip(w, x, strict=True))
            gap = (1 / (1 + math.exp(-z)) - b) * n / total
            slope = [s + gap * q for s, q in zip(slope, x, strict=True)]
        w = [max(-20.0, min(20.0, p - 2.0 * s)) for p, s in zip(w, slope, strict=True)]
    return tuple(w)


def fit(docs: DataFrame, text: str = "text") -> Model:
    """The classifier learned, without labels, from the candidates of all texts."""
    found = docs.select(F.inline(_candidates(whole(F.col(text)))))
    counted = found.groupBy("wide", "v0", "v1", "v2", "v3").count().collect()
    weights = {}
    for kind in WIDE:
        patterns = sorted(
            (((r["v0"], r["v1"], r["v2"], r["v3"]), r["count"]) for r in counted if r["wide"] == kind),
            key=str,
        )
        weights[kind] = _train(patterns, _expect(patterns)) if patterns else (-1.0,) + (0.0,) * 8
    return Model(weights)


def _accepted(model: Model, c: Column) -> Column:
    test = F.lit(False)
    for kind, w in model.weights.items():
        z = F.lit(w[0])
        for j in range(4):
            vote = c[f"v{j}"]
            z = z + F.when(vote == 1, w[1 + 2 * j]).when(vote == 0, w[2 + 2 * j]).otherwise(0.0)
        test = test | ((c["wide"] == kind) & (z >= 0.0))
    return test


def find_personal(docs: DataFrame, model: Model | None = None, text: str = "text") -> DataFrame:
    """``docs`` with base spans and the spans of the classifier.

    ``base`` and ``found`` are arrays of (kind, start, end), by kind as listed
    and then by start, code points, end exclusive. A span that the classifier
    adds never overlaps a base span. Null texts count as empty and have none;
    every row is kept, repeated ones too.
    """
    model = model or fit(docs, text)
    body = whole(F.col(text))
    step = docs.withColumns({f"_{k}": c for k, c in zip(KINDS, base_spans(body), strict=True)})
    step = step.withColumn("_wide", F.filter(_candidates(body), lambda c: _accepted(model, c)))
    plain = [F.transform(f"_{k}", _placed(F.lit(k))) for k in KINDS]
    step = step.withColumn("base", F.concat(*plain))
    clear = F.filter(
        "_wide",
        lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    added = F.transform(clear, _placed())
    step = step.withColumn("_all", F.concat("base", added))
    by_kind = [F.array_sort(F.filter("_all", of_kind(k))) for k in ALL_KINDS]
    return step.withColumn("found", F.concat(*by_kind)).drop(
        *[f"_{k}" for k in KINDS], "_wide", "_all"
    )


def joined(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
