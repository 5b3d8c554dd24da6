"""Embedding whitening with an exact covariance from bit-sliced scatter.

Entries become integers on a grid of 1/256. Every different vector counts once. A batch of
such vectors is shifted by each dimension's least value, so that entries are not negative,
and cut into bit planes: plane b of dimension i holds bit b of entry i of every row, packed 64
rows to a word. Then

    sum of u_i * u_j  =  sum over planes a, b of  2^(a + b) * popcount(plane_ia AND plane_jb)

and sums are weighted popcounts of single planes. Undoing the shift gives exact sums and
cross-products as integers of any size; n * sum(x_i x_j) - S_i S_j is the exact covariance
times n^2, centred before anything is rounded. `eigh` sees its quotients.

The rows meet in no task: each partition of the different vectors emits one row per pair of
dimensions and limb of 32 bits, which Spark adds up, and the driver gets the sums of the
pairs, whose number depends on the dimensions alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import kept, prepared, unused

# Entries are cut to a grid of 1/GRID.
GRID = 256
COMPONENTS = 4

# Rows whose planes are made at once: 128 words a plane.
BATCH_ROWS = 8192

# Sums travel as limbs of so many bits, whose totals fit a long.
LIMB = 32

# Eigenvalues below this share of the largest are rounding errors of zero.
NO_VARIANCE = 1e-12

LONG_MAX = 2**63 - 1


@dataclass(frozen=True)
class Whitening:
    """What was fitted. `components` has a row per component, by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    @property
    def scaled(self) -> np.ndarray:
        """(dimensions, components): projection and division by the root of the eigenvalue."""
        return (self.components / np.sqrt(self.values)[:, None]).T


def on_grid(vector: str) -> Column:
    """floor(GRID * entry) as longs, saturating; null unless every entry is there and finite.

    An empty vector is an empty array.
    """
    entry = F.col(vector)
    infinite = float("inf")

    def finite(c: Column) -> Column:
        d = c.cast("double")
        return c.isNotNull() & ~F.isnan(d) & (F.abs(d) != F.lit(infinite))

    grid = F.transform(entry, lambda c: F.floor(c.cast("double") * F.lit(float(GRID))))
    return F.when(F.forall(entry, finite), grid)


# --- inside tasks ----------------------------------------------------------------------


def _matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of longs; vectors shorter than `dims` end in zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == dims).all():
        return flat.reshape(len(lists), dims)
    out = np.zeros((len(lists), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _planes(u: np.ndarray, bits: int) -> np.ndarray:
    """(bits, words): the bit planes of one dimension, 64 rows to a word."""
    rows = -(-len(u) // 64) * 64
    column = np.zeros(rows, np.uint64)
    column[: len(u)] = u
    ones = (column >> np.arange(bits, dtype=np.uint64)[:, None]) & np.uint64(1)
    return np.packbits(ones.astype(np.uint8), axis=1).view(np.uint64)


def scatter(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums and cross-products of the columns of a matrix of longs, as Python integers."""
    rows, dims = x.shape
    least = x.min(axis=0)
    u = x.view(np.uint64) - least.view(np.uint64)  # wraps to the right difference
    bits = [int(m).bit_length() for m in u.max(axis=0)]
    ends = np.cumsum([0, *bits])
    words = -(-rows // 64)
    planes = np.concatenate([np.zeros((0, words), np.uint64), *[_planes(u[:, i], b) for i, b in enumerate(bits)]])
    exponent = np.concatenate([np.arange(b) for b in bits] + [np.zeros(0, int)])
    wide = 2 * max(bits, default=0) + rows.bit_length() + max(bits, default=0).bit_length() * 2 >= 62
    weight = np.array([1 << int(e) for e in exponent], dtype=object if wide else np.int64)

    def added(counts: np.ndarray) -> list[int]:
        """Weighted counts of the planes of each dimension, added up."""
        weighted = counts.astype(weight.dtype) * weight
        return [int(weighted[a:b].sum()) for a, b in zip(ends, ends[1:])]

    shifted = added(np.bitwise_count(planes).sum(axis=1, dtype=np.int64))
    cross = [[0] * dims for _ in range(dims)]
    for i in range(dims):
        later = planes[ends[i] :]
        total = np.zeros(len(later), weight.dtype)
        for b in range(bits[i]):
            counts = np.bitwise_count(later & planes[ends[i] + b]).sum(axis=1, dtype=np.int64)
            total += counts.astype(weight.dtype) * (1 << b)
        weighted = total * weight[ends[i] :]
        for j in range(i, dims):
            cross[i][j] = int(weighted[ends[j] - ends[i] : ends[j + 1] - ends[i]].sum())
    m = [int(v) for v in least]
    sums = [s + rows * v for s, v in zip(shifted, m)]
    for i in range(dims):
        for j in range(i, dims):
            cross[i][j] += m[j] * shifted[i] + m[i] * shifted[j] + rows * m[i] * m[j]
    return sums, cross


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(number, limb) of an integer; limbs carry its sign and add up to it."""
    sign, value, at = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield at, sign * (value & ((1 << LIMB) - 1))
        value >>= LIMB
        at += 1


SUMS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())])


def _scatter_rows(dims: int):
    """A partition's exact sums (j = -1), cross-products and number of rows (i = j = -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        sums = np.zeros(dims, object)
        cross = np.zeros((dims, dims), object)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                x = _matrix(batch.column(0).slice(at, BATCH_ROWS), dims)
                s, c = scatter(x)
                n += len(x)
                sums = sums + np.array(s, object)
                cross = cross + np.array(c, object).reshape(dims, dims)
        found = [(-1, -1, n)]
        found += [(i, -1, int(sums[i])) for i in range(dims)]
        found += [(i, j, int(cross[i, j])) for i in range(dims) for j in range(i, dims)]
        rows = [(i, j, k, v) for i, j, value in found for k, v in _limbs(value)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), SUMS)], schema=SUMS
            )

    return run


def _projected(model: Whitening, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
    """(whitened, deviation) of rows of longs; a deviation beyond a long is null."""
    sums = np.array(model.sums, object)
    most = max([abs(s) for s in model.sums], default=0) + model.n * int(np.abs(x.astype(float)).max(initial=0) + 1)
    if most < 2**31 and most * most * max(1, x.shape[1]) < LONG_MAX:
        centred = x * np.int64(model.n) - sums.astype(np.int64)
        deviation = (centred * centred).sum(axis=1).tolist()
    else:
        centred = x.astype(object) * model.n - sums
        found = [sum(int(v) * int(v) for v in row) for row in centred]
        deviation = [v if v <= LONG_MAX else None for v in found]
    return (centred / model.n).astype(np.float64) @ model.scaled, deviation


def _moments(model: Whitening, dims: int):
    """(rows, sum, second moments about the partition's mean) of whitened rows."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            w, _ = _projected(model, _matrix(batch.column(0), dims))
            mean = w.mean(axis=0)
            about = (w - mean).T @ (w - mean)
            # Moments about zero of the means, so that batches can be added up.
            values = np.concatenate([len(w) * mean, (about + len(w) * np.outer(mean, mean)).ravel()])
            yield pa.RecordBatch.from_pydict(
                {"at": pa.array(range(k + k * k), pa.int32()), "value": pa.array(values, pa.float64())}
            )

    return run


# --- fitting ---------------------------------------------------------------------------


def _vectors(df: DataFrame, vector: str) -> DataFrame:
    return df.select(on_grid(vector).alias("x")).where("x IS NOT NULL")


def _distinct(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Each different grid vector once, padded to the longest length, and that length."""
    found = kept(_vectors(df, vector).distinct(), "grid-vectors")
    low, high = found.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    dims = high or 0
    if low == high:
        return found, dims
    missing = F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("x"))
    return kept(found.select(F.concat("x", missing).alias("x")).distinct(), "grid-vectors"), dims


def covariance(n: int, sums: list[int], cross: np.ndarray) -> np.ndarray:
    """The covariance as doubles, each the quotient of two exact integers."""
    dims = len(sums)
    out = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            out[i, j] = out[j, i] = (n * cross[i, j] - sums[i] * sums[j]) / (n * n)
    return out


def _scatter_of(distinct: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    schema = "i int, j int, limb int, value long"
    found = (
        distinct.mapInArrow(_scatter_rows(dims), schema)
        .groupBy("i", "j", "limb")
        .agg(F.sum("value").alias("value"))
        .collect()  # dims^2 rows and no more, whatever the table holds
    )
    n, sums, cross = 0, [0] * dims, np.zeros((dims, dims), object)
    for i, j, limb, value in found:
        value <<= LIMB * limb
        if i < 0:
            n += value
        elif j < 0:
            sums[i] += value
        else:
            cross[i, j] += value
    return n, sums, cross


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[Whitening, float]:
    """(what was fitted, identity error) of the different grid vectors of a table.

    Vectors that are null or hold null, NaN or infinite entries are left out. Shorter vectors
    end in zeros. The identity error is the largest entry of the whitened vectors' covariance
    minus the identity, measured on those vectors. Components without variance do not exist:
    one vector, or none, has no components.
    """
    prepared(df.sparkSession)
    distinct, dims = _distinct(df, vector)
    n, sums, cross = _scatter_of(distinct, dims)
    if not n or not dims:
        return Whitening(n, tuple(sums), np.zeros((0, dims)), np.zeros(0), np.zeros(0)), 0.0
    v = covariance(n, sums, cross)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(values.max() * NO_VARIANCE, 0.0)]
    found = vectors.T[order]
    largest = np.abs(found).argmax(axis=1)
    found = found * np.sign(found[np.arange(len(found)), largest])[:, None]
    model = Whitening(n, tuple(sums), found, values[order], values[order] / np.trace(v))
    return model, _identity_error(distinct, model, dims)


def _identity_error(distinct: DataFrame, model: Whitening, dims: int) -> float:
    k = len(model.values)
    if not k:
        return 0.0
    total = np.zeros(k + k * k)
    sums = distinct.mapInArrow(_moments(model, dims), "at int, value double").groupBy("at").agg(F.sum("value"))
    for at, value in sums.collect():  # k + k^2 rows
        total[at] = value
    mean, second = total[:k] / model.n, total[k:].reshape(k, k) / model.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whitened(df: DataFrame, model: Whitening, vector: str = "embedding") -> tuple[DataFrame, str]:
    """Rows with a whole vector and a struct (deviation, whitened array), and its name.

    All other columns and repeated rows stay. `deviation` is the exact sum over dimensions of
    (n * x - S)^2, null where it is beyond a long. The column is `whitened`, or that behind
    underscores where it is taken.
    """
    prepared(df.sparkSession)
    name, grid = unused(df, "whitened"), unused(df, "_grid")
    dims = len(model.sums)

    def project(column: pa.Array) -> pa.Array:
        if pa.types.is_large_list(column.type):
            column = column.cast(pa.list_(pa.int64()))
        w, deviation = _projected(model, _matrix(column, dims))
        values = pa.array(w.ravel(), pa.float64())
        offsets = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(offsets, values)],
            ["deviation", "components"],
        )

    kind = "deviation long, components array<double>"
    rows = df.withColumn(grid, on_grid(vector)).where(F.col(grid).isNotNull())
    return rows.withColumn(name, F.arrow_udf(project, kind)(grid)).drop(grid), name
