"""Whitening of embeddings by the singular values of their centred rows.

The rows never meet as a covariance: tasks reduce blocks of centred rows to a
triangular factor by QR, the factors are reduced in turn until one is left, and
its singular values and right vectors (see :mod:`bidiagonal`) are the
components.  Entries are whole numbers, so sums and deviations are exact."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitstop.llm.bidiagonal import EPS, right_directions
from pitstop.llm.scratch import stage

SCALE = 64
COMPONENTS = 16
MOST = 2**62                  # entries saturate there
BLOCK_ROWS = 4096
FACTORS = 16                  # triangular factors that one task reduces to one


def _pack(values: np.ndarray) -> pa.Array:
    """Rows of whole numbers as binaries: the width, then the entries in the
    least width (2, 4 or 8 bytes) that holds them all; equal rows, equal bytes."""
    n, dims = values.shape
    least, most = values.min(axis=1, initial=0), values.max(axis=1, initial=0)
    width = np.where((least >= -2**15) & (most < 2**15), 2, np.where((least >= -2**31) & (most < 2**31), 4, 8))
    sizes = 1 + width * dims
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    data = np.empty(int(offsets[-1]), np.uint8)
    for w in np.unique(width):
        mine = np.flatnonzero(width == w)
        rows = np.empty((len(mine), 1 + w * dims), np.uint8)
        rows[:, 0] = w
        rows[:, 1:] = values[mine].astype(f"<i{w}").view(np.uint8).reshape(len(mine), -1)
        data[(offsets[mine][:, None] + np.arange(1 + w * dims)).ravel()] = rows.ravel()
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _unpack(column: pa.Array, dims: int) -> np.ndarray:
    """The rows of :func:`_pack`, with zeros behind shorter ones."""
    out = np.zeros((len(column), dims), np.int64)
    if not len(column):
        return out
    wide = pa.types.is_large_binary(column.type)
    _, where, body = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8)
    kinds = np.diff(offsets) * 16 + data[offsets[:-1]]
    for kind in np.unique(kinds):
        mine, size, w = np.flatnonzero(kinds == kind), int(kind) // 16 - 1, int(kind) % 16
        if size:
            rows = np.ascontiguousarray(data[offsets[mine][:, None] + 1 + np.arange(size)])
            out[mine, :size // w] = rows.view(f"<i{w}")
    return out


def whole_numbers(rows: DataFrame, columns: Sequence[str] = ("vec_id", "embedding"), scale: int = SCALE) -> DataFrame:
    """vec_id, dims, x (packed floor(scale * entry)) of the rows whose vector
    is not null and holds no null, NaN or infinite entry."""
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column(1)
            flat = vec.flatten()
            values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float, copy=True)
            if flat.null_count:
                values[flat.is_null().to_numpy(zero_copy_only=False)] = np.nan
            given = vec.is_valid().to_numpy(zero_copy_only=False)
            sizes = np.where(given, vec.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
            starts = np.cumsum(sizes) - sizes
            good = given.copy()
            good[np.repeat(np.arange(len(sizes)), sizes)[~np.isfinite(values)]] = False
            whole = np.clip(np.floor(scale * np.where(np.isfinite(values), values, 0.0)), -MOST, MOST).astype(np.int64)
            for size in np.unique(sizes[good]):
                mine = np.flatnonzero(good & (sizes == size))
                block = whole[starts[mine][:, None] + np.arange(size)] if size else np.zeros((len(mine), 0), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(mine)), pa.array(np.full(len(mine), size, np.int32)), _pack(block)],
                    ["vec_id", "dims", "x"])

    vec_id, vector = columns
    return (rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>"))
            .mapInArrow(take, "vec_id long, dims int, x binary"))


class Fit:
    """What the rows of the fit list are centred by: their number and sums."""

    def __init__(self, n: int, sums: Sequence[int]):
        self.n, self.sums = n, [int(s) for s in sums]
        self.dims = len(self.sums)
        self._far = max([abs(s) for s in self.sums], default=0)

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: Python's whole numbers where 64 bits could be too few."""
        most = int(np.abs(x).max(initial=0))
        if most * self.n + self._far < MOST:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(float) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        a = self.numerators(x)
        if a.dtype != object and int(np.abs(a).max(initial=0)) ** 2 * max(self.dims, 1) < 2**63:
            return (a * a).sum(axis=1).tolist()
        out = [sum(int(v) ** 2 for v in row) for row in a]
        return [v if v < 2**63 else None for v in out]


def _per_task(rows: DataFrame, dims: int, work: Callable[[Iterator[np.ndarray]], pa.RecordBatch], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield work(_unpack(b.column(0), dims) for b in batches if b.num_rows)
    return rows.select("x").mapInArrow(run, schema)


def fit_sums(fit: DataFrame, dims: int) -> Fit:
    """The number of rows and the exact sum of each dimension (a row a
    dimension and task, summed in Spark)."""
    def add(blocks):
        total, n = [0] * dims, 0
        for x in blocks:
            n += len(x)
            step = x if int(np.abs(x).max(initial=0)) < 2**40 else x.astype(object)
            total = [a + int(b) for a, b in zip(total, step.sum(axis=0))]
        return pa.RecordBatch.from_arrays(
            [pa.array(range(-1, dims), pa.int32()), pa.array([n, *total], pa.decimal128(38, 0))], ["dim", "total"])

    rows = (_per_task(fit, dims, add, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total"))
            .orderBy("dim").collect())                       # one row a dimension
    n, *sums = [int(r["total"]) for r in rows] or [0]
    return Fit(n, sums)


def _reduce(factor: np.ndarray, block: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack([factor, block]), mode="r")


def triangular_factor(fit: DataFrame, centre: Fit) -> np.ndarray:
    """R of the QR of all centred rows, by blocks: one factor a task, then
    rounds in which a task reduces ``FACTORS`` of them."""
    dims = centre.dims
    schema = "part int, r binary"

    def as_batch(part: int, factor: np.ndarray) -> pa.RecordBatch:
        kept = [factor.tobytes()] if len(factor) else []
        return pa.RecordBatch.from_arrays([pa.array([part] * len(kept), pa.int32()), pa.array(kept, pa.binary())], ["part", "r"])

    def first(blocks):
        factor = np.zeros((0, dims))
        for x in blocks:
            for at in range(0, len(x), BLOCK_ROWS):
                factor = _reduce(factor, centre.centred(x[at:at + BLOCK_ROWS]))
        return as_batch(TaskContext.get().partitionId(), factor)

    def combine(batches):
        factor, part = np.zeros((0, dims)), 0
        for batch in batches:
            for p, r in zip(batch.column(0).to_pylist(), batch.column(1)):
                part, factor = p // FACTORS, _reduce(factor, np.frombuffer(r.as_buffer(), float).reshape(-1, dims))
        yield as_batch(part, factor)

    factors = stage(_per_task(fit, dims, first, schema), "whiten-factors")
    most = factors.agg(F.max("part")).first()[0] or 0
    while most:
        most //= FACTORS
        dealt = factors.withColumn("_to", F.expr(f"part div {FACTORS}").cast("int")).repartitionById(most + 1, "_to")
        factors = stage(dealt.sortWithinPartitions("part").select("part", "r").mapInArrow(combine, schema), "whiten-factors")
    rows = factors.collect()                                 # one factor: dims x dims at most
    return np.frombuffer(rows[0]["r"], float).reshape(-1, dims) if rows else np.zeros((0, dims))


def identity_error(fit: DataFrame, centre: Fit, directions: np.ndarray) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    k = directions.shape[1]

    def add(blocks):
        total = np.zeros((k + 1, k))
        for x in blocks:
            w = centre.centred(x) @ directions
            total += np.vstack([w.T @ w, w.sum(axis=0)])
        return pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["cell", "total"])

    rows = (_per_task(fit, centre.dims, add, "cell int, total double").groupBy("cell").agg(F.sum("total").alias("total"))
            .orderBy("cell").collect())                      # k * (k + 1) rows
    total = np.array([r["total"] for r in rows]).reshape(k + 1, k) / centre.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(rows: DataFrame, components: int = COMPONENTS, columns: Sequence[str] = ("vec_id", "embedding"),
           scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error
    for each row with a vector and each of the first ``components``.

    Rows whose vector is null or holds null or non-finite entries go.  An
    entry becomes floor(scale * entry); a constant added to all entries (the
    contract's 1000000) changes neither sums' differences nor covariances and
    is left out.  The fit list has each vector once, pre-aggregated before it
    is shuffled, so copies neither weigh nor gather.  Shorter vectors count as
    zeros behind their end (a null id, ties, repeated rows: rows like others);
    entries saturate at 2**62; a deviation beyond the range of long is null.
    Components without variance cannot be whitened and have no rows, so one
    distinct vector, empty vectors or an empty table give none.

    What is held in a task or on the driver: matrices of dims x dims."""
    taken = stage(whole_numbers(rows, columns, scale), "whiten-rows")
    dims, least = taken.agg(F.max("dims"), F.min("dims")).first()
    dims = dims or 0
    spark, schema = rows.sparkSession, ("vec_id long, component int, n long, deviation long, whitened double, "
                                        "explained double, identity_error double")
    if least != dims:                                        # one form for vectors of different lengths

        def pad(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0), _pack(_unpack(b.column(1), dims))], ["vec_id", "x"])

        taken = stage(taken.select("vec_id", "x").mapInArrow(pad, "vec_id long, x binary"), "whiten-padded")
    fit = stage(taken.select("x").distinct(), "whiten-fit")
    centre = fit_sums(fit, dims)
    factor = triangular_factor(fit, centre) if centre.n and dims else np.zeros((0, dims))
    square = np.zeros((dims, dims))
    square[:len(factor)] = factor
    values, found = right_directions(square, min(components, dims)) if dims else (np.zeros(0), np.zeros((0, 0)))
    rank = int((values[:components] > values[:1].max(initial=0.0) * EPS * 16 * max(dims, 16)).sum())
    if not rank:
        return spark.createDataFrame([], schema)
    directions = found[:, :rank] * (np.sqrt(centre.n) / values[:rank])
    explained = values[:rank] ** 2 / (values ** 2).sum()
    error = identity_error(fit, centre, directions)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = _unpack(part.column(1), dims)
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), rank))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(each), pa.array(np.tile(np.arange(1, rank + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * rank, centre.n)), pa.array(centre.deviations(x), pa.int64()).take(each),
                     pa.array((centre.centred(x) @ directions).ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * rank, error))], [c.split(" ")[0] for c in schema.split(", ")])

    return taken.select("vec_id", "x").mapInArrow(project, schema)
