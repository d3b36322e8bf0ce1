"""Whitening of embeddings by polarisation covariance.

No product of two dimensions is ever formed. For every dimension i, and for the
sum of every pair of dimensions i and j, the squared centred values are summed:

    cov(i, j) = (var(i + j) - var(i) - var(j)) / 2

All sums are exact whole numbers. Entries are put on a grid of whole numbers x; with
n rows and per-dimension sums S the centred value is n * x - S, again whole. Tasks
write it as n * z - r, where z = x - S div n is small and r = S mod n, so that

    sum (n z - r)^2 = n^2 sum z^2 - 2 n r sum z + n r^2

takes only sums of z and of its squares from the rows. Sums grow with the
dimensions alone; rows never leave their tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loquent.llm.common import boxed
from loquent.session import write_out

#: Grid steps for 1.0, and the whole number at 0.
SCALE = 64
OFFSET = 1_000_000
#: Largest grid step: beyond it a double is no exact whole number.
LARGEST = 1 << 53
#: Components that rows are projected on.
COMPONENTS = 32
#: Sums of 64-bit numbers are taken as such below this, else as Python's numbers.
_SAFE = 1 << 62
#: Rows that are worked on at once in a task.
_ROWS = 1_024
#: Dimension of the entry that counts rows.
_COUNT = -1


@dataclass(frozen=True)
class Model:
    #: Rows of the fit list, and their sum for each dimension.
    n: int
    sums: tuple[int, ...]
    #: Falling eigenvalues of the covariance, its trace, eigenvectors by column.
    values: np.ndarray
    trace: float
    vectors: np.ndarray

    @property
    def size(self) -> int:
        return len(self.sums)

    def shares(self, components: int) -> list[float]:
        """Each component's part of the whole variance; 0 where there is none."""
        return [float(e) / self.trace if self.trace else 0.0 for e in self.values[:components]]

    def usable(self) -> np.ndarray:
        """Which components have a variance beyond rounding."""
        least = self.size * np.finfo(float).eps * max(self.values.max(initial=0.0), 0.0)
        return self.values > least


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All entries as doubles (null: NaN), starts, lengths, and which rows remain.

    A row remains if it is not null and all its entries are finite numbers.
    """
    entries = column.values.cast(pa.float64())
    values = entries.to_numpy(zero_copy_only=False)
    if entries.null_count:
        values = np.where(entries.is_null().to_numpy(zero_copy_only=False), np.nan, values)
    ends = column.offsets.to_numpy()
    starts, lengths = ends[:-1].astype(np.int64), np.diff(ends).astype(np.int64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    whole = bad[starts + lengths] == bad[starts]
    return values, starts, lengths, whole & column.is_valid().to_numpy(zero_copy_only=False)


def _on_grid(values: np.ndarray) -> np.ndarray:
    """Whole numbers, the grid steps held to +-2^53."""
    return np.clip(np.floor(SCALE * values), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def _tables(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, grid values) of the rows that remain, per length and block."""
    values, starts, lengths, good = _lists(column)
    for length in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == length))
        for low in range(0, len(rows), _ROWS):
            some = rows[low : low + _ROWS]
            yield some, _on_grid(values[starts[some][:, None] + np.arange(length)])


def _narrow(x: np.ndarray) -> np.ndarray:
    """``x``, as Python's numbers where a sum of squares might leave 64 bits."""
    most = int(np.abs(x).max(initial=0))
    return x.astype(object) if 4 * most * most * max(x.shape) >= _SAFE else x


def _added(total: dict, key: tuple, amounts: np.ndarray) -> None:
    whole = amounts.astype(object)
    total[key] = total[key] + whole if key in total else whole


def _summed(df: DataFrame, make: Callable[[], Callable[[dict, np.ndarray], None]]) -> DataFrame:
    """(length, name, i, total): what tasks sum up, added up."""
    fields = "length INT, name STRING, i INT, total DECIMAL(38,0)"
    arrow = to_arrow_schema(T.StructType.fromDDL(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, total = make(), {}
        for batch in batches:
            for _, x in _tables(batch.column(0)):
                add(total, x)
        for (length, name), amounts in total.items():
            size = len(amounts)
            places = range(size) if name != "n" else [_COUNT]
            columns = [[length] * size, [name] * size, list(places), list(map(int, amounts))]
            made = [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(made, schema=arrow)

    parts = df.mapInArrow(run, fields)
    # A number for every dimension pair and task: a small part of what tasks read.
    return parts.groupBy("length", "name", "i").agg(F.sum("total").alias("total"))


def _first() -> Callable[[dict, np.ndarray], None]:
    """Rows, and sums of every dimension."""

    def add(total: dict, x: np.ndarray) -> None:
        length = x.shape[1]
        _added(total, (length, "n"), np.array([len(x)]))
        _added(total, (length, "x"), _narrow(x).sum(0))

    return add


def _second(sums: tuple[int, ...], n: int) -> Callable[[], Callable[[dict, np.ndarray], None]]:
    """Sums of z, of squares of z, and of squares of the sum of every two z."""
    middle = np.array([s // n for s in sums], np.int64)
    size = len(sums)

    def make() -> Callable[[dict, np.ndarray], None]:
        def add(total: dict, x: np.ndarray) -> None:
            if x.shape[1] != size:
                return
            z = np.ascontiguousarray(_narrow(x - middle).T)
            _added(total, (size, "z"), z.sum(1))
            _added(total, (size, "zz"), (z * z).sum(1))
            pairs = [np.zeros(0, z.dtype)]
            for i in range(size - 1):
                both = z[i] + z[i + 1 :]
                pairs.append((both * both).sum(1))
            _added(total, (size, "pair"), np.concatenate(pairs))

        return add

    return make


def covariance(n: int, sums: tuple[int, ...], z: list, zz: list, pair: list) -> np.ndarray:
    """The covariance matrix, divisor ``n``, by polarisation; each entry rounded once."""
    size = len(sums)
    rest = [s % n for s in sums]

    def centred(total_square: int, total: int, r: int) -> int:
        return n * n * total_square - 2 * n * r * total + n * r * r

    own = [centred(zz[i], z[i], rest[i]) for i in range(size)]
    matrix = np.zeros((size, size))
    at = 0
    for i in range(size):
        matrix[i, i] = own[i] / n**3
        for j in range(i + 1, size):
            both = centred(pair[at], z[i] + z[j], rest[i] + rest[j])
            matrix[i, j] = matrix[j, i] = (both - own[i] - own[j]) / (2 * n**3)
            at += 1
    return matrix


def fit(df: DataFrame, vector: str = "embedding") -> Model | None:
    """The model of all vectors that remain; None without any.

    A vector that is null, or holds null or non-finite entries, is left out, as is
    one whose length is not the most frequent one (of equally frequent, the
    longest) or is 0. Rows that repeat count each. Two passes over the vectors; the
    driver gets one number per dimension and pair of dimensions.
    """
    own = df.select(F.col(vector).alias("vector"))
    first = write_out(_summed(own, _first), "sums")
    counts = first.filter("name = 'n' and length > 0")
    top = counts.orderBy(F.desc("total"), F.desc("length")).first()
    if top is None:
        return None
    size, n = top["length"], int(top["total"])

    def numbers(rows: DataFrame, name: str) -> list[int]:
        chosen = rows.filter((F.col("name") == name) & (F.col("length") == size))
        return [int(r["total"]) for r in chosen.orderBy("i").collect()]

    sums = tuple(numbers(first, "x"))
    second = write_out(_summed(own, _second(sums, n)), "squares")
    v = covariance(n, sums, *(numbers(second, k) for k in ("z", "zz", "pair")))
    values, vectors = np.linalg.eigh(v)
    return Model(n, sums, values[::-1].copy(), float(np.trace(v)), vectors[:, ::-1].copy())


def _projector(model: Model, components: int) -> Callable[[np.ndarray], tuple]:
    """Grid values to exact deviations and whitened rows (NaN: no variance)."""
    n, size = model.n, model.size
    middle = np.array([s // n for s in model.sums], np.int64)
    rest = np.array([s % n for s in model.sums], np.int64)
    rests = sum(int(r) ** 2 for r in rest)
    k = min(components, size)
    usable = model.usable()[:k]
    scale = np.where(usable, 1 / np.sqrt(np.where(usable, model.values[:k], 1.0)), np.nan)
    basis = model.vectors[:, :k] * scale
    shift = np.array([int(r) / n for r in rest])

    def project(x: np.ndarray) -> tuple[list[int], np.ndarray]:
        z = x - middle
        wide = _narrow(z)
        squares = (wide * wide).sum(1).astype(object)
        crossing = int(np.abs(z).max(initial=0)) * int(rest.max(initial=0)) * size
        crossed = (z if crossing < _SAFE else z.astype(object)) @ rest
        deviations = n * n * squares - 2 * n * crossed.astype(object) + rests
        return list(deviations), (z - shift) @ basis

    return project


def _moments(model: Model, components: int) -> Callable:
    """Per task: the sums of whitened values and of their products."""
    k = int(model.usable()[: min(components, model.size)].sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project = _projector(model, components)
        total, product = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in _tables(batch.column(0)):
                if x.shape[1] == model.size:
                    w = project(x)[1][:, :k]
                    total += w.sum(0)
                    product += w.T @ w
        flat = np.concatenate([total, product.ravel()])
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(range(len(flat)), pa.int32()), "total": pa.array(flat)}
        )

    return run


def identity_error(
    df: DataFrame, model: Model, vector: str = "embedding", components: int = COMPONENTS
) -> float:
    """Largest entry of the whitened rows' covariance minus the identity.

    Only components with a variance count, which are the first ones.
    """
    own = df.select(F.col(vector).alias("vector"))
    parts = own.mapInArrow(_moments(model, components), "i INT, total DOUBLE")
    rows = parts.groupBy("i").agg(F.sum("total").alias("total")).orderBy("i").collect()
    flat = np.array([r["total"] for r in rows])
    k = int(round((np.sqrt(4 * len(flat) + 1) - 1) / 2))
    if not k:
        return 0.0
    mean = flat[:k] / model.n
    spread = flat[k:].reshape(k, k) / model.n - np.outer(mean, mean)
    return float(np.abs(spread - np.eye(k)).max())


def whiten(
    df: DataFrame,
    model: Model | None,
    vector: str = "embedding",
    components: int = COMPONENTS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """(row, deviation, whitened) of every row of ``df`` that remains.

    ``row`` is a struct of the columns ``keep``, by default of all, so that no name
    can clash. ``deviation`` is
    the exact sum of squares of n * x - S as DECIMAL(38,0). ``whitened`` holds the
    first ``components`` components, by falling eigenvalue; an entry is null if its
    component has no variance. Rows that remain are those that ``fit`` counts; an
    empty table, or none that remain, gives no rows.
    """
    kept = df.select(vector, *[c for c in keep if c != vector]) if keep else df
    own = boxed(kept, F.col(vector).alias("vector"))
    if keep:
        own = own.withColumn("row", F.struct(*[F.col("row")[c].alias(c) for c in keep]))
    added = "deviation DECIMAL(38,0), whitened ARRAY<DOUBLE>"
    schema = T.StructType([own.schema["row"], *T.StructType.fromDDL(added)])
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    types = [f.type for f in to_arrow_schema(T.StructType.fromDDL(added))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project = _projector(model, components)
        for batch in batches:
            for rows, x in _tables(batch.column(1)):
                if x.shape[1] != model.size:
                    continue
                deviations, w = project(x)
                entries = pa.array(w.ravel(), from_pandas=True)
                ends = np.arange(len(rows) + 1, dtype=np.int32) * w.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), entries)
                columns = [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(deviations, type=types[0]),
                    lists.cast(types[1]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return own.mapInArrow(run, schema)
