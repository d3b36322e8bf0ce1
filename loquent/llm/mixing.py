"""Mixing sources to target weights as a min-cost flow over membership patterns.

Documents with the same set of sources share a pattern; only patterns, sources
and their sums of words enter the flow. A pattern offers its words once per
allowed repetition, every further repetition at a higher cost; a source takes up
to its target. The cheapest flow of the largest amount says how many words each
pattern gives to each source; documents are then picked in a seeded order.

Sources, sizes and targets are tables, so there may be any number of sources. A
source that overlaps with no other has one arc, and its flow is its target; only
overlapping sources and their patterns go through the network on the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loquent.llm.common import boxed, word_count
from loquent.plans.ordered import running_sum
from loquent.plans.skew import salted_join
from loquent.session import write_out

# The weights of sources in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
REPEATS = 3
#: Patterns of two or more sources that the flow takes at most; their number does
#: not grow with the documents but with the combinations of sources in use.
PATTERNS = 5_000
#: The plan has one row of some 100 bytes per pattern; it is broadcast up to here
#: and joined by salted keys beyond.
BROADCAST = 5_000
#: Documents, chosen by size, that close the gap left by the seeded order.
FILLS = 2
#: Parts into which the seeded order of a pattern is cut to find the last
#: document of a turn without sorting the pattern.
PARTS = 65_536
#: Parts summed in one window.
CHUNK_PARTS = 256
RANGE = 1 << 40
SEED = 11


def targets(
    sizes: Sequence[int],
    weights: Sequence[int],
    repeats: int = REPEATS,
    total: int | None = None,
) -> list[Fraction]:
    """Targets of sources, given their sizes: shares of all words by weight.

    A target stops at ``repeats`` times its source's size; the excess is shared
    again by weight among the others until none is above.
    """
    found = [Fraction(0)] * len(sizes)
    open_ = set(range(len(sizes)))
    rest = Fraction(sum(sizes) if total is None else total)
    while open_ and rest > 0:
        unit = rest / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > repeats * sizes[i]]
        if not full:
            for i in open_:
                found[i] = unit * weights[i]
            break
        for i in full:
            found[i] = Fraction(repeats * sizes[i])
            rest -= found[i]
            open_.discard(i)
    return found


class _Flow:
    """Successive cheapest paths on a small directed network."""

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def add(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.arcs[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def run(self, start: int, end: int) -> None:
        rise = [0] * len(self.arcs)
        while True:
            far = {start: 0}
            via: dict[int, int] = {}
            done = set()
            queue = [(0, start)]
            while queue:
                d, a = heapq.heappop(queue)
                if a in done:
                    continue
                done.add(a)
                for i in self.arcs[a]:
                    b = self.to[i]
                    if self.room[i] > 0:
                        step = d + self.cost[i] + rise[a] - rise[b]
                        if b not in far or step < far[b]:
                            far[b] = step
                            via[b] = i
                            heapq.heappush(queue, (step, b))
            if end not in far:
                return
            for node, d in far.items():
                rise[node] += min(d, far[end])
            for node in range(len(rise)):
                if node not in far:
                    rise[node] += far[end]
            amount, at = None, end
            while at != start:
                i = via[at]
                amount = self.room[i] if amount is None else min(amount, self.room[i])
                at = self.to[i ^ 1]
            at = end
            while at != start:
                i = via[at]
                self.room[i] -= amount
                self.room[i ^ 1] += amount
                at = self.to[i ^ 1]


def route(
    patterns: Sequence[tuple[frozenset, int]],
    quotas: dict[object, int],
    repeats: int = REPEATS,
) -> dict[tuple[int, object], int]:
    """Words that the pattern of each index gives to each source.

    The k-th use of a pattern's words costs k - 1 per word. All capacity that
    the quotas can take is used.
    """
    names = list(quotas)
    place = {s: 2 + len(patterns) + i for i, s in enumerate(names)}
    net = _Flow(2 + len(patterns) + len(names))
    given = {}
    for i, (members, size) in enumerate(patterns):
        for use in range(repeats):
            net.add(0, 2 + i, size, use)
        for s in sorted(members, key=str):
            given[i, s] = net.add(2 + i, place[s], repeats * size, 0)
    for s in names:
        net.add(place[s], 1, quotas[s], 0)
    net.run(0, 1)
    return {key: net.room[arc ^ 1] for key, arc in given.items() if net.room[arc ^ 1]}


def _placed(
    docs: DataFrame, doc_id: str, text: str, sources: Column | None, seed: int
) -> DataFrame:
    """``docs`` with _size, _sources, _pattern and _order."""
    members = F.array(F.col("source")) if sources is None else sources
    held = F.when(F.size(members) > 0, members).otherwise(F.array(F.lit(None)))
    order = F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id), F.col("_size")), F.lit(RANGE))
    return (
        docs.withColumn("_size", word_count(F.col(text)))
        .withColumn("_sources", F.array_sort(F.array_distinct(held)))
        .withColumn("_pattern", F.to_json("_sources"))
        .withColumn("_order", order)
    )


def source_targets(
    listed: DataFrame, weights: Sequence[int], repeats: int = REPEATS
) -> DataFrame:
    """(source, source_size, target, quota) from patterns (_sources, words).

    The same as ``targets`` for any number of sources. They are numbered in code
    point order, null last, range by range. A source stops at ``repeats`` times its
    size once the words per weight are beyond that; these only rise, so a round
    needs no more than two sums, and the rounds end when no source is added.
    """
    last = [F.col("source").isNull(), F.col("source")]
    sizes = (
        listed.select(F.explode("_sources").alias("source"), "words")
        .groupBy("source")
        .agg(F.sum("words").alias("source_size"))
        .repartitionByRange(*last)
        .withColumn("_range", F.spark_partition_id())
    )
    sizes = write_out(sizes, "sources")
    ranges = sizes.groupBy("_range").agg(F.count(F.lit(1)).alias("_many"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "_range", F.coalesce(F.sum("_many").over(ahead), F.lit(0)).alias("_first")
    )
    inside = Window.partitionBy("_range").orderBy(*last)
    place = F.col("_first") + F.row_number().over(inside) - 1
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    weight = F.get(cycle, F.pmod(place, F.lit(len(weights))).cast("int"))
    weighed = sizes.join(ranges, "_range").select(
        "source", "source_size", weight.alias("weight")
    )
    weighed = write_out(weighed, "weights")
    # Words are counted once, also where sources overlap.
    total = listed.agg(F.sum("words")).first()[0] or 0
    whole = weighed.agg(F.sum("weight")).first()[0] or 0
    rest, shared = total, whole

    def number(value: Column | int) -> Column:
        value = value if isinstance(value, Column) else F.lit(value)
        return value.cast("decimal(19,0)")

    def full() -> Column:
        most = number(F.col("source_size")) * number(repeats * shared)
        return most < number(rest) * number(F.col("weight"))

    while shared and rest:
        stopped = weighed.filter(full()).agg(F.sum("source_size"), F.sum("weight")).first()
        left = whole - (stopped[1] or 0)
        if left == shared:
            break
        rest, shared = total - repeats * (stopped[0] or 0), left
    most = F.lit(repeats) * F.col("source_size")
    if not shared or not rest:
        return weighed.select(
            "source", "source_size", most.cast("double").alias("target"), most.alias("quota")
        )
    part = F.lit(rest) * F.col("weight")
    over = F.pmod(part, F.lit(shared))
    floor = F.expr(f"({rest}L * weight) div {shared}L")
    up = (2 * over > shared) | ((2 * over == shared) & (floor % 2 == 1))
    return weighed.select(
        "source",
        "source_size",
        F.when(full(), most.cast("double")).otherwise(part / F.lit(shared)).alias("target"),
        F.when(full(), most).otherwise(floor + F.when(up, 1).otherwise(0)).alias("quota"),
    )


_PLANNED = "_pattern STRING, source_size LONG, target DOUBLE, turns LONG, extra LONG"


def _overlapping(listed: DataFrame, known: DataFrame, repeats: int) -> list[tuple]:
    """Rows of ``_PLANNED`` for the patterns of sources that overlap with others."""
    several = listed.filter(F.size("_sources") > 1).limit(PATTERNS + 1).collect()
    if len(several) > PATTERNS:
        raise ValueError(f"more than {PATTERNS} combinations of two or more sources")
    if not several:
        return []
    names = sorted({s for r in several for s in r["_sources"] if s is not None})
    found = F.broadcast(listed.sparkSession.createDataFrame([(s,) for s in names], "_name STRING"))
    some_null = any(None in r["_sources"] for r in several)

    def among(frame: DataFrame, source: Column) -> list:
        named = frame.join(found, source == F.col("_name"), "left_semi")
        rows = named.collect()
        return rows + (frame.filter(source.isNull()).collect() if some_null else [])

    alone = among(listed.filter(F.size("_sources") == 1), F.get("_sources", F.lit(0)))
    sources = {r["source"]: r for r in among(known, F.col("source"))}
    rows = [*several, *alone]
    patterns = [(frozenset(r["_sources"]), r["words"]) for r in rows]
    flow = route(patterns, {s: r["quota"] for s, r in sources.items()}, repeats)
    given = [0] * len(rows)
    for (i, _), amount in flow.items():
        given[i] += amount
    out = []
    for r, amount in zip(rows, given, strict=True):
        words = r["words"]
        first = sources[r["_sources"][0]]
        turns = min(repeats, amount // words) if words else 0
        extra = amount - turns * words if turns < repeats else 0
        out.append((r["_pattern"], first["source_size"], first["target"], turns, extra))
    return out


def _planned(listed: DataFrame, weights: Sequence[int], repeats: int) -> DataFrame:
    """Per pattern: size and target of its first source, whole turns, extra words."""
    known = write_out(source_targets(listed, weights, repeats), "targets")
    rows = _overlapping(listed, known, repeats)
    network = listed.sparkSession.createDataFrame(rows, _PLANNED)
    alone = listed.filter(F.size("_sources") == 1)
    if rows:
        alone = alone.join(F.broadcast(network.select("_pattern")), "_pattern", "left_anti")
    one = F.get("_sources", F.lit(0))
    amount = F.least(F.col("quota"), repeats * F.col("words"))
    turns = F.when(F.col("words") > 0, F.expr(f"least({repeats}L, _amount div words)"))
    singles = (
        alone.join(known, one.eqNullSafe(F.col("source")))
        .withColumn("_amount", amount)
        .withColumn("turns", F.coalesce(turns, F.lit(0).cast("long")))
        .withColumn(
            "extra",
            F.when(F.col("turns") < repeats, F.col("_amount") - F.col("turns") * F.col("words"))
            .otherwise(F.lit(0).cast("long")),
        )
        .select("_pattern", "source_size", "target", "turns", "extra")
    )
    return write_out(singles.unionByName(network), "planned")


def _with_plan(rows: DataFrame, plan: DataFrame, few: bool, spread: str) -> DataFrame:
    """Rows with their pattern's plan; one pattern may have a third of all rows."""
    if few:
        return rows.join(F.broadcast(plan), "_pattern")
    return salted_join(rows, plan, ["_pattern"], [spread])


def _filled(placed: DataFrame, plan: DataFrame, few: bool) -> DataFrame:
    """The plan with one more document of each pattern that has words to go.

    It is the one nearest in size to what is left, if that makes the gap smaller.
    """
    open_ = plan.filter("gap > 0").select("_pattern", "last", "gap", "fills")
    this = F.struct(F.col("_order").alias("order"), F.col("_size").alias("size"))
    free = (F.col("_order") > F.col("last")) & ~F.array_contains("fills", this)
    closer = (F.col("_size") > 0) & (F.col("_size") < 2 * F.col("gap"))
    near = F.struct(F.abs(F.col("_size") - F.col("gap")).alias("away"), this.alias("this"))
    found = (
        _with_plan(placed, open_, few, "_order")
        .filter(free & closer)
        .groupBy("_pattern")
        .agg(F.min(near)["this"].alias("_this"))
    )
    more = plan.join(found, "_pattern", "left")
    taken = F.coalesce("_this.size", F.lit(0))
    added = F.when(F.col("_this").isNull(), F.col("fills")).otherwise(
        F.array_append("fills", F.col("_this"))
    )
    kept = [c for c in plan.columns if c not in ("gap", "fills")]
    more = more.select(*kept, (F.col("gap") - taken).alias("gap"), added.alias("fills"))
    return write_out(more, "filled")


def plan_mix(
    placed: DataFrame, weights: Sequence[int], repeats: int
) -> tuple[DataFrame, bool]:
    """Per pattern: source size, target, turns, the last place of one more turn, and
    the documents that fill the gap; and whether the plan is small."""
    parted = placed.withColumn("_part", F.expr(f"_order div {RANGE // PARTS}"))
    sums = parted.groupBy("_pattern", "_sources", "_part").agg(F.sum("_size").alias("words"))
    sums = write_out(sums, "sums")
    listed = sums.groupBy("_pattern", "_sources").agg(F.sum("words").alias("words"))
    planned = _planned(write_out(listed, "patterns"), weights, repeats)
    few = planned.count() <= BROADCAST
    # The part in which the extra words of a pattern run out. Parts are summed in
    # chunks, so that no task takes all the parts of a pattern.
    summed = running_sum(
        sums, ["_pattern"], "_part", F.col("words"), "_end", size=CHUNK_PARTS
    ).withColumn("before", F.col("_end") - F.col("words"))
    extra = planned.filter("extra > 0").select("_pattern", "extra")
    cut = (
        _with_plan(summed, extra, few, "_part")
        .filter("before < extra and before + words >= extra")
        .select("_pattern", "_part", (F.col("extra") - F.col("before")).alias("left"))
    )
    # Inside that part: documents are taken while they fit.
    earlier = Window.partitionBy("_pattern").orderBy("_order").rangeBetween(
        Window.unboundedPreceding, 0
    )
    close = parted.select("_pattern", "_part", "_order", "_size").join(cut, ["_pattern", "_part"])
    fits = F.sum("_size").over(earlier) <= F.col("left")
    part_start = F.min("_part") * (RANGE // PARTS)
    last = (
        close.withColumn("_fits", fits)
        .groupBy("_pattern")
        .agg(
            F.max(F.when(F.col("_fits"), F.col("_order"))).alias("fits"),
            (part_start - 1).alias("none"),
            (F.min("left") - F.sum(F.when(F.col("_fits"), F.col("_size")).otherwise(0))).alias("gap"),
        )
        .select("_pattern", F.coalesce("fits", "none").alias("last"), "gap")
    )
    nothing = F.array().cast("array<struct<order:bigint,size:bigint>>")
    plan = planned.join(last, "_pattern", "left").select(
        *["_pattern", "source_size", "target", "turns"],
        F.coalesce("last", F.lit(-1)).alias("last"),
        F.coalesce("gap", F.lit(0)).alias("gap"),
        nothing.alias("fills"),
    )
    plan = write_out(plan, "plan")
    for _ in range(FILLS):
        plan = _filled(placed, plan, few)
    return plan, few


def _decided(
    docs: DataFrame,
    doc_id: str,
    text: str,
    sources: Column | None,
    weights: Sequence[int],
    repeats: int,
    seed: int,
) -> DataFrame:
    placed = _placed(docs, doc_id, text, sources, seed)
    small = write_out(placed.select("_pattern", "_sources", "_order", "_size"), "sizes")
    plan, few = plan_mix(small, weights, repeats)
    this = F.struct(F.col("_order").alias("order"), F.col("_size").alias("size"))
    once_more = (F.col("_order") <= F.col("last")) | F.array_contains("fills", this)
    copies = F.col("turns") + F.when(once_more, 1).otherwise(0)
    return _with_plan(placed, plan, few, "_order").withColumn("_copies", copies)


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sources: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of every row.

    ``sources`` is an array of the sources that hold a document; by default the
    column ``source`` alone, null being a source of its own; so is no source at all. ``source_size`` and
    ``target`` are those of the first source by code point. The words a pattern
    gives are split over its documents as whole turns of the text: all documents
    are taken the same number of times, and the first in a seeded order once
    more; two further documents, nearest in size, close the gap to the target. No document exceeds ``repeats`` turns. The order is a hash of seed,
    identifier and size, so reruns agree, and rows alike in these are taken
    alike. Null and empty texts have size 0. An empty table gives no rows;
    further columns are not read.
    """
    own = docs.select(doc_id, text, "source") if sources is None else docs
    decided = _decided(own, doc_id, text, sources, weights, repeats, seed)
    return decided.select(
        F.col(doc_id).alias("doc_id"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * F.col("_copies")).alias("taken"),
        F.col("_copies").cast("int").alias("copies"),
    )


def take_mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sources: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix`` takes it.

    All columns stay, whatever their names. Nulls, ties, empty texts and tables
    are treated as in ``mix``.
    """
    held = F.array(F.col("source")) if sources is None else sources
    own = boxed(
        docs,
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        held.alias("sources"),
    )
    decided = _decided(own, "doc_id", "text", F.col("sources"), weights, repeats, seed)
    turns = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    taken = decided.filter("_copies > 0").select("row", turns)
    return taken.select("row.*")

