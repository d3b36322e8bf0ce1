"""Cosine of dense vectors and of token bags, inside one row."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from loquent.functions.binding import let


def dot(a: Column, b: Column) -> Column:
    """Dot product in DOUBLE."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_from_parts(product: Column, norm_a: Column, norm_b: Column) -> Column:
    """Cosine from its parts; a zero vector gives 0."""
    scale = norm_a * norm_b
    return F.when(scale > 0, product / scale).otherwise(
        F.when(scale.isNotNull(), F.lit(0.0))
    )


def dense_cosine(a: Column, b: Column) -> Column:
    return cosine_from_parts(dot(a, b), norm(a), norm(b))


def bag(tokens: Column) -> Column:
    """Term counts of a token array: STRUCT<terms, counts, squares>.

    ``terms`` are distinct and sorted, ``squares`` is the sum of the squared
    counts. The sorted tokens are read once: a term starts where the token
    before differs.
    """

    def from_sorted(ordered: Column) -> Column:
        places = F.transform(ordered, lambda _, i: i)
        starts = F.filter(
            places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        )

        def from_starts(firsts: Column) -> Column:
            terms = F.transform(firsts, lambda i: F.get(ordered, i))
            counts = F.transform(
                firsts,
                lambda i, k: F.coalesce(F.get(firsts, k + 1), F.size(ordered)) - i,
            )
            return let(counts, lambda c: _bag_of(terms, c))

        return let(starts, from_starts)

    return let(F.sort_array(tokens), from_sorted)


def _bag_of(terms: Column, counts: Column) -> Column:
    squares = F.aggregate(
        counts, F.lit(0.0), lambda total, n: total + n.cast("double") * n
    )
    return F.struct(
        terms.alias("terms"), counts.alias("counts"), squares.alias("squares")
    )


def bag_dot(a: Column, b: Column) -> Column:
    """Dot product of two bags, sorted together: a shared term has two entries
    in a row."""

    def entries(bag_: Column) -> Column:
        return F.arrays_zip(bag_["terms"].alias("term"), bag_["counts"].alias("n"))

    def from_sorted(both: Column) -> Column:
        # The second copy starts one entry later; its last partner is null.
        after = F.slice(both, 2, F.greatest(F.size(both), F.lit(1)))
        products = F.zip_with(
            both,
            after,
            lambda x, y: F.when(
                x["term"] == y["term"], x["n"].cast("double") * y["n"]
            ).otherwise(0.0),
        )
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    return let(F.sort_array(F.concat(entries(a), entries(b))), from_sorted)


def bag_cosine(a: Column, b: Column) -> Column:
    """Cosine of two bags. Two empty bags are equal (1.0); one empty bag
    matches nothing (0.0)."""
    aa, bb = a["squares"], b["squares"]
    return (
        F.when((aa == 0) & (bb == 0), F.lit(1.0))
        .when((aa == 0) | (bb == 0), F.lit(0.0))
        .otherwise(bag_dot(a, b) / F.sqrt(aa * bb))
    )


def counted(words: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The words of every list by number: their keys in order, how often each is
    there, the list it is in, and how many words there are.

    The key of a word is that of the same word in the list before plus that number.
    """
    coded = words.flatten().dictionary_encode()
    many = max(len(coded.dictionary), 1)
    sizes = pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(words)), sizes)
    keys, n = np.unique(row * many + coded.indices.to_numpy(), return_counts=True)
    return keys, n.astype(np.float64), keys // many, many


def cosines(a: np.ndarray, b: np.ndarray, products: np.ndarray) -> np.ndarray:
    """Cosines from squares and products; see ``bag_cosine``."""
    some = (a > 0) & (b > 0)
    found = np.where((a == 0) & (b == 0), 1.0, 0.0)
    found[some] = products[some] / np.sqrt(a[some] * b[some])
    return found


def token_cosines(a: pa.Array, b: pa.Array) -> pa.Array:
    """Cosines of the bags of two arrays of token lists, list by list."""
    size = len(a)
    keys, n, row, many = counted(pa.concat_arrays([a, b.cast(a.type)]))
    squares = np.bincount(row, n * n, minlength=2 * size)
    # A list of b stands ``size`` lists after its partner.
    middle = np.searchsorted(keys, size * many)
    first, second = keys[:middle], keys[middle:] - size * many
    _, i, j = np.intersect1d(first, second, assume_unique=True, return_indices=True)
    products = np.bincount(row[i], n[i] * n[middle + j], minlength=size)
    return pa.array(cosines(squares[:size], squares[size:], products))


@cache
def _token_cosine():
    @F.arrow_udf("double")
    def cosine(a: pa.Array, b: pa.Array) -> pa.Array:
        return token_cosines(a, b)

    return cosine


def token_cosine(a: Column, b: Column) -> Column:
    """``bag_cosine`` of the bags of two token arrays, counted with NumPy for many
    rows at a time."""
    return _token_cosine()(a, b)
