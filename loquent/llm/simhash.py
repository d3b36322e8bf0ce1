"""Near-duplicates by SimHash and covering locality-sensitive hashing.

A fingerprint has 64 bits. For a radius r every bit gets a vector of r + 1 bits
that is not zero, and every other such vector v names a table whose mask covers
the bits i with <m(i), v> = 1 (mod 2). Two fingerprints that differ in at most r
bits agree under some mask: the vectors of r bits cannot span all r + 1
dimensions, so some v is orthogonal to all of them. No pair is lost by chance.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquent.llm.common import boxed, map_columns
from loquent.llm.components import components
from loquent.session import write_out

BITS = 64
RADIUS = 3
SHINGLE = 3
#: Buckets of up to so many fingerprints are compared inside one row; larger
#: ones are split by further masks, without loss, until they are small.
SMALL = 512
_FULL = (1 << BITS) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a text, A-Z in lower case.

    A bit is set if it is set in over half the XXH64 hashes (seed 42) of the
    shingles, repeats counted. Fewer words than a shingle make one shingle; no
    word, or a null text, gives zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    n = len(words) - width + 1
    count = np.zeros(BITS, np.int64)
    for low in range(0, n, 4096):
        spans = zip(starts[low : min(low + 4096, n)], ends[low + width - 1 :])
        hashes = [digest(joined[a : b - 1], 42) for a, b in spans]
        rows = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(rows, axis=1, bitorder="little").sum(0, np.int64)
    bits = np.packbits(count * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def with_fingerprints(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE, out: str = "fp"
) -> DataFrame:
    """``docs`` with the fingerprint as a signed long."""

    def make() -> Callable:
        return lambda texts: [[_signed(fingerprint(t, shingle)) for t in texts]]

    return map_columns(docs, [text], f"{out} LONG", make)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The masks of all tables, as signed longs."""
    vectors = [1 + i % ((1 << (radius + 1)) - 1) for i in range(BITS)]
    masks = []
    for v in range(1, 1 << (radius + 1)):
        odd = [i for i, m in enumerate(vectors) if (m & v).bit_count() % 2]
        masks.append(_signed(sum(1 << i for i in odd)))
    return masks


def finer_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """Masks that split a bucket of ``mask`` further.

    The free bits are cut into radius + 1 parts; fingerprints that differ in up
    to ``radius`` of them agree on a whole part. With no more free bits than the
    radius all members are near each other and the mask is final.
    """
    free = [i for i in range(BITS) if not (mask >> i) & 1]
    if len(free) <= radius:
        return []
    parts = [free[k :: radius + 1] for k in range(radius + 1)]
    return [_signed((mask & _FULL) | sum(1 << i for i in p)) for p in parts]


def _spanning(radius: int) -> Callable:
    """Links that join what is near inside one small bucket, one per merge."""

    def links(buckets: pd.Series) -> pd.Series:
        found = []
        for bucket in buckets:
            fps = np.asarray(bucket, np.int64).view(np.uint64)
            near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
            left = np.ones(len(fps), bool)
            out = []
            while left.any():
                wave = [int(np.flatnonzero(left)[0])]
                left[wave[0]] = False
                while wave:
                    a = wave.pop()
                    new = np.flatnonzero(near[a] & left)
                    left[new] = False
                    wave.extend(map(int, new))
                    out.extend({"a": int(bucket[a]), "b": int(bucket[i])} for i in new)
            found.append(out)
        return pd.Series(found)

    return links


def _refined(members: DataFrame, radius: int) -> DataFrame:
    def finer(masks: pd.Series) -> pd.Series:
        known = {m: finer_masks(int(m), radius) for m in masks.unique()}
        return masks.map(known)

    split = F.pandas_udf(finer, "array<long>")
    return members.select(F.explode(split("mask")).alias("mask"), "fp")


def near_links(fingerprints: DataFrame, radius: int = RADIUS, small: int = SMALL) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that join all near ones.

    Every link is between fingerprints at most ``radius`` bits apart, and any
    two such fingerprints are joined by a path of links. Buckets beyond
    ``small`` members go to finer masks level by level; the work per member is
    bounded by the number of masks, never by the square of a bucket.
    """
    spark = fingerprints.sparkSession
    masks = F.array(*[F.lit(m).cast("long") for m in covering_masks(radius)])
    members = fingerprints.select(F.explode(masks).alias("mask"), "fp")
    key: list[Column] = [F.col("mask"), F.col("fp").bitwiseAND(F.col("mask")).alias("key")]
    span = F.pandas_udf(_spanning(radius), "array<struct<a:long,b:long>>")
    found = None
    while True:
        sizes = members.groupBy(*key).agg(F.count("*").alias("n"), F.min("fp").alias("least"))
        sizes = write_out(sizes.filter("n > 1"), "buckets")
        joined = members.select("*", key[1]).join(sizes, ["mask", "key"])
        joined = write_out(joined.select("mask", "key", "fp", "n", "least"), "members")
        packed = joined.filter(F.col("n") <= small).groupBy("mask", "key")
        packed = packed.agg(F.collect_list("fp").alias("fps"))
        links = packed.select(F.inline(span("fps")))
        crowded = joined.filter(F.col("n") > small)
        final = BITS - F.bit_count("mask") <= radius
        stars = crowded.filter(final & (F.col("fp") != F.col("least")))
        links = links.unionByName(stars.select(F.col("fp").alias("a"), F.col("least").alias("b")))
        found = links if found is None else found.unionByName(links)
        members = crowded.filter(~final).select("mask", "fp")
        if members.isEmpty():
            return found
        members = write_out(_refined(members, radius).distinct(), "finer")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    shingle: int = SHINGLE,
) -> DataFrame:
    """(doc_id, fp, component_id, root) of every row of ``docs``.

    ``component_id`` is the smallest identifier reachable over links, the row's
    own included; it is null only where a component has no identifier. ``root``
    is the component's smallest fingerprint. Equal fingerprints are one node, so copies are never paired. Null
    and empty texts have fingerprint zero and link like any other. Repeated
    rows get a row each; an empty table gives none; further columns are not read.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = write_out(
        with_fingerprints(plain, shingle=shingle).select("doc_id", "fp"), "fingerprints"
    )
    nodes = write_out(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    roots = components(near_links(nodes.select("fp"), radius))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root")
    )
    placed = write_out(placed, "placed")
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = placed.join(least, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id", "root")


def hex_of(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    shingle: int = SHINGLE,
) -> DataFrame:
    """``docs`` with one row of each component: a row its identifier names.

    All columns stay, whatever their names. Where that identifier is repeated
    inside the component, one row of it stays; a component without any
    identifier keeps one row.
    """
    classes = near_duplicates(docs, doc_id, text, radius, shingle)
    own = F.col("doc_id")
    chosen = (
        classes.filter(own.eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("fp").alias("_fp"), F.min("doc_id").alias("named"))
        .select("_fp", *_known(F.col("named")))
    )
    plain = boxed(docs, F.col(text).alias("text"), *_known(F.col(doc_id)))
    marked = with_fingerprints(plain, shingle=shingle, out="_fp").drop("text")
    # The same columns join and tell repeated rows apart: texts move once.
    same = ["_fp", "_known", "_none"]
    once = marked.join(chosen, same, "left_semi").dropDuplicates(same)
    return once.select("row.*")


def _known(doc_id: Column) -> list[Column]:
    """An identifier as columns that are never null."""
    return [F.coalesce(doc_id, F.lit(0)).alias("_known"), doc_id.isNull().alias("_none")]
