"""Quality rules: a learned decision list over figures of a text.

Sequential covering: a rule is a conjunction of thresholds. It is grown on two
thirds of the labelled rows by the condition of best information gain, pruned on
the rest, and what it covers is taken out before the next rule. The list becomes
one Spark ``CASE`` expression, its rules in order.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.llm.common import LOWER, UPPER, WHITE, map_columns

#: Labelled rows that are fitted on at most.
SAMPLE_ROWS = 20_000
#: Thresholds tried per figure, conditions per rule, rules per list.
CUTS, CONDITIONS, RULES = 32, 4, 16
#: Least share of bad rows among those a rule covers, growing and pruning.
PRECISION = 0.9
FIGURES = (
    "n_words LONG, word_chars LONG, n_symbols LONG, n_dup_lines LONG,"
    " n_repeat_words LONG, n_upper LONG, n_lower LONG, n_marks LONG, n_lines LONG"
)
#: Figures that rules speak of, as Spark SQL; a text without words divides by 1.
RATES = {
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines_per_line": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(n_upper + n_lower, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "n_words": "cast(n_words as double)",
}
_SPACE = WHITE.encode()


@dataclass(frozen=True)
class Condition:
    figure: str
    above: bool
    cut: float

    def holds(self, row: dict) -> bool:
        return row[self.figure] >= self.cut if self.above else row[self.figure] <= self.cut


Rule = tuple[Condition, ...]


def repeated_words(words: Sequence[bytes]) -> int:
    """Words inside windows of three that the text has twice or more."""
    found = list(zip(words, words[1:], words[2:]))
    if len(set(found)) == len(found):
        return 0
    times = Counter(found)
    total = end = 0
    for i, window in enumerate(found):
        if times[window] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def figures(text: str | None) -> tuple[int, ...]:
    """The figures of a whole text; those of a null text are zero."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()

    def count(some: bytes) -> int:
        return len(raw) - len(raw.translate(None, some))

    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text or "") - count(_SPACE),
        count(b"#*$%&|<>"),
        len(lines) - len(set(lines)),
        repeated_words(words),
        count(UPPER.encode()),
        count(LOWER.encode()),
        count(b"!?"),
        len(lines),
    )


def with_figures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the figures of each whole text as long columns."""

    def make() -> Callable:
        return lambda texts: list(zip(*map(figures, texts))) or [()] * 9

    return map_columns(docs, [text], FIGURES, make)


def _covered(rule: Rule, rows: list[dict]) -> list[dict]:
    return [r for r in rows if all(c.holds(r) for c in rule)]


def _bad(rows: list[dict]) -> int:
    return sum(r["bad"] for r in rows)


def _cuts(values: list[float]) -> list[float]:
    """Thresholds half-way between neighbouring distinct quantiles."""
    ordered = sorted(values)
    picked = sorted({ordered[i * (len(ordered) - 1) // CUTS] for i in range(CUTS + 1)})
    return [(a + b) / 2 for a, b in pairwise(picked)]


def _grow(rows: list[dict]) -> Rule:
    rule: Rule = ()
    while len(rule) < CONDITIONS:
        p, n = _bad(rows), len(rows)
        if p == 0 or p == n:
            break
        best, gain = None, 1e-9
        for figure in RATES:
            for cut in _cuts([r[figure] for r in rows]):
                for above in (True, False):
                    condition = Condition(figure, above, cut)
                    new = _covered((condition,), rows)
                    q = _bad(new)
                    if q:
                        worth = q * (math.log2(q / len(new)) - math.log2(p / n))
                        if worth > gain:
                            best, gain = condition, worth
        if best is None:
            break
        rule += (best,)
        rows = _covered(rule, rows)
    return rule


def _prune(rule: Rule, rows: list[dict]) -> Rule:
    """The rule without the last conditions that the pruning rows do not support."""

    def worth(r: Rule) -> float:
        covered = _covered(r, rows)
        p = _bad(covered)
        return (p - (len(covered) - p)) / len(covered) if covered else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def learn(rows: Sequence[dict], seed: int = 3) -> list[Rule]:
    """The decision list of rows with all ``RATES`` and ``bad`` (0 or 1).

    Without bad rows, or without good ones, no rule is learned.
    """
    left = sorted(rows, key=lambda r: [*map(r.get, RATES), r["bad"]])
    random.Random(seed).shuffle(left)
    rules: list[Rule] = []
    while len(rules) < RULES and 0 < _bad(left) < len(left):
        growing = [r for i, r in enumerate(left) if i % 3]
        pruning = [r for i, r in enumerate(left) if i % 3 == 0]
        rule = _prune(_grow(growing), pruning)
        covered = _covered(rule, left) if rule else []
        if not covered or _bad(covered) < PRECISION * len(covered) or _bad(covered) < 3:
            break
        rules.append(rule)
        left = [r for r in left if not all(c.holds(r) for c in rule)]
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """True to keep: the rules in order as one conditional over the figures."""
    result = F
    for rule in rules:
        test = F.lit(True)
        for c in rule:
            rate = F.expr(RATES[c.figure])
            test = test & (rate >= c.cut if c.above else rate <= c.cut)
        result = result.when(test, F.lit(False))
    return F.lit(True) if result is F else result.otherwise(F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * 50
    )


def fit(
    stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """Rules from up to ``rows`` labelled rows, picked by a hash of the key.

    ``stats`` has the figures; ``labels`` has ``doc_id`` and ``quality`` (0 bad).
    Rows that fail the base test teach nothing. Null labels are skipped; of
    contrary labels of one identifier the good one counts.
    """
    known = labels.filter("quality is not null").groupBy(F.col("doc_id").alias("_key"))
    known = known.agg(F.max("quality").alias("_quality"))
    rated = [F.expr(e).alias(n) for n, e in RATES.items()]
    joined = stats.filter(~base_failed()).join(known, F.col(doc_id) == F.col("_key"))
    picked = joined.orderBy(F.xxhash64(doc_id)).limit(rows)
    bad = (F.col("_quality") == 0).cast("int").alias("bad")
    return learn([r.asDict() for r in picked.select(*rated, bad).collect()])
