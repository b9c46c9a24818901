"""Embedding whitening with a bit-sliced scatter matrix (operator 12).

Vectors become integers, x = floor(256 * c). The fit list holds every distinct x
once. Its scatter matrix is exact:

* Every dimension is shifted by its minimum, so that its values are natural
  numbers of as many bits as its range needs.
* Blocks of ``ROWS`` rows are sliced: bit b of dimension i, over all rows of the
  block, is packed into 64-bit words, one bit plane for each (i, b).
* The sum of products of dimensions i and j is the sum over their planes of
  2^(a+b) times the number of bits that planes (i, a) and (j, b) both have set:
  an AND and a popcount, without one multiplication of entries.
* Products of the whole list are summed by Spark, as digits of ``DIGIT`` bits, and
  put together as unbounded integers. n * sum(x_i x_j) - S_i S_j is n^2 times
  the covariance, exactly; only then are there doubles, and ``eigh``.

How rows are dealt: the fit list is a distinct over the encoded vectors
(partial, so a vector that a third of all rows share is one row per task);
everything else is a scan with sums. The driver gets sums per dimension and
pair of dimensions, never rows. Memory of a task: one block's planes and one
square matrix of the dimensions. The fit list and the encoded rows are written
to the shared checkpoint folder.

Defined cases: vectors that are null or hold a null or a non-finite entry are
dropped; null and repeated ids are rows like others; vectors of each length are
whitened apart, with a fit list of their own; vectors without entries have no
components; entries beyond 64 bits (after the factor) are the nearest long;
components without variance (an eigenvalue of at most the rounding error of the
largest, as with equal vectors or a single one) are left out, so that there may
be fewer than ``COMPONENTS``; a deviation beyond 64 bits is null; an empty table
gives an empty result; extra columns are left behind.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import column_batches, cut

SCALE = 256
COMPONENTS = 4
#: Rows whose planes are built at a time.
ROWS = 8192
#: Bits of a digit in which products leave a task.
DIGIT = 24
_WIDTHS = (np.dtype("<i1"), np.dtype("<i2"), np.dtype("<i4"), np.dtype("<i8"))
_TOP = 2 ** 63 - 1


def _packed(row: np.ndarray) -> bytes:
    """A row of longs in the smallest width that holds it: equal rows have equal bytes."""
    low, high = (int(row.min()), int(row.max())) if len(row) else (0, 0)
    width = next(w for w in _WIDTHS if np.iinfo(w).min <= low and high <= np.iinfo(w).max)
    return bytes([width.itemsize]) + row.astype(width).tobytes()


def _matrix(column: pa.Array) -> np.ndarray:
    """The packed rows of one length as a matrix of longs."""
    rows = [np.frombuffer(b, f"<i{b[0]}", offset=1) for b in column.to_pylist()]
    return np.stack(rows).astype(np.int64)


def _by_length(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batch by length of vector; column ``at`` has the lengths."""
    dims = batch.column(at).to_numpy(zero_copy_only=False)
    for dim in np.unique(dims):
        yield int(dim), batch.filter(pa.array(dims == dim))


def encode(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """vec_id, dim and x (packed) of every row that takes part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, out = [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not v.is_valid:
                    continue
                c = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if v.values.null_count or not np.isfinite(c).all():
                    continue
                with np.errstate(over="ignore"):
                    y = np.floor(scale * c)
                x = np.clip(y, -(2.0 ** 63), 2.0 ** 62).astype(np.int64)
                x[y > 2.0 ** 62] = [int(min(e, _TOP)) for e in y[y > 2.0 ** 62]]
                ids.append(i), dims.append(len(x)), out.append(_packed(x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], ["vec_id", "dim", "x"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        run, "vec_id long, dim int, x binary")


def planes(y: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bit planes of the columns of ``y`` (unsigned): one row of words for
    every bit of every column, the lowest bit of the first column first."""
    out = np.zeros((sum(bits), -(-len(y) // 64) * 8), dtype=np.uint8)
    at = 0
    for i, n in enumerate(bits):
        own = y[:, i]
        for b in range(n):
            row = np.packbits((own >> np.uint64(b)).astype(np.uint8) & 1, bitorder="little")
            out[at, :len(row)] = row
            at += 1
    return out.view(np.uint64)


def _digits(bits: list[int]) -> int:
    return max(1, -(-(2 * max(bits, default=0)) // DIGIT))


def scatter(y: np.ndarray, bits: list[int], into: np.ndarray) -> None:
    """Adds the sums of products of all pairs of columns to ``into`` (digits,
    columns, columns); only pairs i <= j are filled."""
    p = planes(y, bits)
    owner = np.repeat(np.arange(len(bits)), bits)
    weight = np.concatenate([np.arange(n) for n in bits]) if bits else np.empty(0, int)
    for k in range(len(p)):
        both = np.bitwise_count(p[k:] & p[k]).sum(axis=1, dtype=np.int64)
        # of a column's own planes each pair is met once, but counts twice
        both[1:][owner[k + 1:] == owner[k]] *= 2
        shift = weight[k:] + weight[k]
        np.add.at(into, (shift // DIGIT, owner[k], owner[k:]), both << (shift % DIGIT))


@dataclass
class Model:
    """What whitens the vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S as integers: longs where they fit."""
        far = self.n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, self.sums), default=0)
        if far * far * max(1, x.shape[1]) <= _TOP:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        near = (centred / self.n).astype(np.float64)
        return near @ self.vectors / np.sqrt(self.values)


def covariance(products: list[list[int]], sums: list[int], n: int) -> list[list[int]]:
    """n^2 times the covariance, from the sums and the sums of products."""
    d = range(len(sums))
    return [[n * products[min(i, j)][max(i, j)] - sums[i] * sums[j] for j in d] for i in d]


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """The model of every length of ``fit_list`` (dim, x: distinct rows)."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own in _by_length(batch, 0):
                x = _matrix(own.column(1))
                total = [sum(map(int, c)) if len(c) and np.abs(c.astype(np.float64)).max() > 2 ** 40 else int(c.sum()) for c in x.T]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([len(x)] * dim, pa.int64()),
                     pa.array(x.min(axis=0)), pa.array(x.max(axis=0)), pa.array([str(t) for t in total])],
                    ["dim", "i", "n", "low", "high", "total"])

    found = fit_list.filter("dim > 0").mapInArrow(ranges, "dim int, i int, n long, low long, high long, total string").groupBy("dim", "i").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("dim", "i").collect()
    lows, bits, size, sums = defaultdict(list), defaultdict(list), {}, defaultdict(list)
    for r in found:
        lows[r["dim"]].append(r["low"])
        bits[r["dim"]].append((r["high"] - r["low"]).bit_length())
        size[r["dim"]] = r["n"]
        sums[r["dim"]].append(int(r["total"]))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums_of: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in column_batches([batch], ROWS):
                for dim, own in _by_length(part, 0):
                    into = sums_of.setdefault(dim, np.zeros((_digits(bits[dim]), dim, dim), dtype=np.int64))
                    y = _matrix(own.column(1)).view(np.uint64) - np.array(lows[dim], dtype=np.int64).view(np.uint64)
                    scatter(y, bits[dim], into)
        for dim, into in sums_of.items():
            digit, i, j = np.nonzero(into)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), dim, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(digit.astype(np.int32)), pa.array(into[digit, i, j])], ["dim", "i", "j", "digit", "part"])

    # bounded by the dimensions: one number for each pair of them and digit
    total = fit_list.filter("dim > 0").mapInArrow(products, "dim int, i int, j int, digit int, part long").groupBy(
        "dim", "i", "j", "digit").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect()
    products_of = {dim: [[0] * dim for _ in range(dim)] for dim in size}
    for r in total:
        products_of[r["dim"]][r["i"]][r["j"]] += int(r["part"]) << (DIGIT * r["digit"])

    models = {}
    for dim, n in size.items():
        shifted = [s - n * low for s, low in zip(sums[dim], lows[dim], strict=True)]
        v = np.array([[e / (n * n) for e in row] for row in covariance(products_of[dim], shifted, n)])
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1], vectors[:, ::-1]
        some = int((values > dim * np.finfo(float).eps * values[0]).sum()) if values[0] > 0 else 0
        some = min(some, components)
        models[dim] = Model(n, sums[dim], values[:some], vectors[:, :some], float(np.trace(v)))
    return models


def identity_errors(fit_list: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """The largest absolute entry of whitened's covariance minus the identity, per length."""

    def pass_(means: dict[int, np.ndarray] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for dim, own in _by_length(batch, 0):
                    m = models[dim]
                    z = m.whitened(m.centred(_matrix(own.column(1))))
                    if means is None:
                        part, kind = z.sum(axis=0), np.arange(z.shape[1])
                    else:
                        z = z - means[dim]
                        part, kind = (z.T @ z).ravel(), np.arange(z.shape[1] ** 2)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(kind), dim, np.int32)), pa.array(kind.astype(np.int32)), pa.array(part)], ["dim", "k", "part"])
        return fit_list.filter("dim > 0").mapInArrow(run, "dim int, k int, part double").groupBy("dim", "k").agg(F.sum("part").alias("part")).collect()

    means = {dim: np.zeros(len(m.values)) for dim, m in models.items()}
    for r in pass_(None):
        means[r["dim"]][r["k"]] = r["part"] / models[r["dim"]].n
    off = {dim: np.zeros(len(m.values) ** 2) for dim, m in models.items()}
    for r in pass_(means):
        off[r["dim"]][r["k"]] = r["part"] / models[r["dim"]].n
    return {dim: float(np.abs(o - np.eye(len(models[dim].values)).ravel()).max(initial=0.0)) for dim, o in off.items()}


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for
    every row that takes part and every component with variance, up to
    ``components``."""
    rows = cut(encode(vectors, scale), "whitening-rows")
    fit_list = cut(rows.select("dim", "x").distinct(), "whitening-fit")
    models = fit(fit_list, components)
    for dim, error in identity_errors(fit_list, models).items():
        models[dim].error = error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own in _by_length(batch, 1):
                m = models[dim]
                k = len(m.values)
                centred = m.centred(_matrix(own.column(2)))
                deviation = [int(d) for d in (centred * centred).sum(axis=1)]
                kept = pa.array([d if d <= _TOP else None for d in deviation], pa.int64())
                take = pa.array(np.repeat(np.arange(own.num_rows), k))
                yield pa.RecordBatch.from_arrays(
                    [own.column(0).take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), own.num_rows)),
                     pa.array(np.full(len(take), m.n, np.int64)), kept.take(take), pa.array(m.whitened(centred).ravel()),
                     pa.array(np.tile(m.values / m.trace, own.num_rows)), pa.array(np.full(len(take), m.error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.filter("dim > 0").mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
