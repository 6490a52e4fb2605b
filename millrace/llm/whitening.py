"""Whitening of embeddings.

Components are read in steps of 1/256. The fit list holds each different vector once; its sums are exact, its covariance
is summed from centred vectors in a second pass and taken apart by spectral divide and conquer (``qdwh``) on the
driver: one matrix of dimension times dimension, whatever the number of rows. The whitening itself is a pass over the
rows with a broadcast matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import appended, fresh, over_batches, with_columns
from millrace.llm.qdwh import EPS, eigen
from millrace.session import cut_lineage

#: Steps of a component per unit.
SCALE = 256
#: Components by default.
COMPONENTS = 4
#: Tasks the partitions' sums of one dimension meet in before they meet in one.
MEETING = 32
#: Steps that are taken for a long.
WIDEST = float(1 << 62)


@dataclass(frozen=True)
class Whitening:
    """What rows are whitened with. ``directions`` holds a unit vector per line, ``values`` their eigenvalues."""

    dimensions: int
    n: int
    sums: list[int]
    directions: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums]) if self.n else np.zeros(self.dimensions)


def stepped(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of numbers as steps, which lists are usable, and where each begins in the steps.

    Usable are lists without null or non-finite entries whose steps fit a long.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    flat = column.flatten().cast(pa.float64())
    values = np.floor(flat.to_numpy(zero_copy_only=False) * SCALE) if len(flat) else np.zeros(0)
    good = np.abs(values) < WIDEST  # false for what is null, which reads as not a number
    bad = np.concatenate([[0], np.cumsum(~good)])
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (bad[starts[1:]] == bad[starts[:-1]])
    return np.where(good, values, 0).astype(np.int64), usable, starts


def packed(vector: np.ndarray) -> bytes:
    """A vector of steps in the narrowest integers that hold it; equal vectors give equal bytes."""
    top = max(int(vector.max()), -1 - int(vector.min())) if len(vector) else 0
    kind = next(k for k in ("<i2", "<i4", "<i8") if top < 1 << (8 * int(k[2]) - 1))
    return vector.astype(kind).tobytes()


def _distinct(column: str):
    """(dimensions, packed vector) of the usable rows, once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps, usable, starts = stepped(batch.column(batch.schema.get_field_index(column)))
            rows = np.flatnonzero(usable)
            each = {(int(starts[i + 1] - starts[i]), packed(steps[starts[i] : starts[i + 1]])) for i in rows.tolist()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in each], pa.int32()), pa.array([v for _, v in each], pa.binary())], names=["d", "v"]
            )

    return run


def _unpacked(batch: pa.RecordBatch, dimensions: int) -> Iterator[np.ndarray]:
    """The vectors of a batch, by the width they are packed in."""
    values = batch.column(0).to_pylist()
    for width in (2, 4, 8):
        own = [v for v in values if len(v) == width * dimensions]
        if own:
            yield np.frombuffer(b"".join(own), f"<i{width}").reshape(len(own), dimensions).astype(np.int64)


def _summed(dimensions: int):
    """(dimension, sum) of a partition, exact; dimension -1 counts the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, n = [0] * dimensions, 0
        for batch in batches:
            for x in _unpacked(batch, dimensions):
                n += len(x)
                # Steps stay below 2^62; 31 bits at a time, no sum of a batch overflows.
                low, high = x & ((1 << 31) - 1), x >> 31
                for i, (a, b) in enumerate(zip(low.sum(axis=0).tolist(), high.sum(axis=0).tolist(), strict=True)):
                    totals[i] += a + (b << 31)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, dimensions), pa.int32()), pa.array([Decimal(t) for t in (n, *totals)], pa.decimal128(38, 0))], names=["i", "s"]
        )

    return run


def _products(shared, dimensions: int):
    """Lines of the sum of centred products over a partition; with directions, of the whitened vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, matrix = shared.value
        size = dimensions if matrix is None else matrix.shape[1]
        total = np.zeros((size, size))
        for batch in batches:
            for x in _unpacked(batch, dimensions):
                centred = x - mean
                own = centred if matrix is None else centred @ matrix
                total += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of all partitions added up, per dimension."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        for i, row in zip(batch.column(0).to_pylist(), rows, strict=True):
            total[i] = total[i] + row if i in total else row.copy()
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], names=["i", "row"]
    )


def _covariance(fit: DataFrame, n: int, mean: np.ndarray, matrix: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the fit list, or of its vectors whitened by ``matrix``; each partition sends one line per dimension."""
    size = len(mean) if matrix is None else matrix.shape[1]
    shared = fit.sparkSession.sparkContext.broadcast((mean, matrix))
    lines = over_batches(fit, _products(shared, len(mean)), "i int, row array<double>")
    # First within some of the partitions, so that no task adds up the lines of all.
    some = lines.withColumn("p", F.pmod(F.spark_partition_id(), F.lit(MEETING))).repartition("i", "p").select("i", "row")
    lines = over_batches(some, _added, "i int, row array<double>")
    rows = over_batches(lines.repartition("i"), _added, "i int, row array<double>").collect()  # one line per dimension
    total = np.zeros((size, size))
    for r in rows:
        total[r.i] = r.row
    return total / n


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Means, components and eigenvalues of the different vectors of ``df``; None without a usable vector.

    Of vectors of several lengths those of the commonest count (ties: the longest). Components whose eigenvalue is
    nothing but rounding are left out, so there may be fewer than asked for.
    """
    each = over_batches(df.select(vector), _distinct(vector), "d int, v binary").distinct()
    each = cut_lineage(each)
    common = each.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not common:
        return None
    dimensions = common[0].d
    fit = each.filter(F.col("d") == dimensions).select("v")
    if not dimensions:
        return Whitening(0, common[0]["count"], [], np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0)
    sums = over_batches(fit, _summed(dimensions), "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    exact = {r.i: int(r.s) for r in sums}  # one per dimension
    n, sums = exact[-1], [exact[i] for i in range(dimensions)]
    mean = np.array([s / n for s in sums])
    covariance = _covariance(fit, n, mean)
    values, vectors = eigen(covariance)
    trace = float(np.trace(covariance))
    kept = int((values[:components] > EPS * dimensions * max(trace, 0.0)).sum())
    values, vectors = values[:kept], vectors[:, :kept]
    error = 0.0
    if kept:
        error = float(np.abs(_covariance(fit, n, mean, vectors / np.sqrt(values)) - np.eye(kept)).max())
    return Whitening(dimensions, n, sums, vectors.T, values, values / trace if kept else values, error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of (n x - S)^2, exact; null beyond a long."""
    top = max((max(abs(n * int(a) - s), abs(n * int(b) - s)) for a, b, s in zip(x.min(axis=0), x.max(axis=0), sums, strict=True)), default=0)
    if len(sums) * top * top < 1 << 63 and n * int(np.abs(x).max(initial=0)) < 1 << 62 and max(map(abs, sums), default=0) < 1 << 62:
        moved = x * n - np.array(sums, np.int64)
        return (moved * moved).sum(axis=1).tolist()
    each = (sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
    return [v if v < 1 << 63 else None for v in each]


def whiten(df: DataFrame, model: Whitening | None, vector: str = "embedding") -> DataFrame:
    """The usable rows of ``df`` with ``whitened`` (array of one number per component) and ``deviation``.

    Rows whose vector is null, of another length, beyond the range of a long, or holds null or non-finite entries go.
    Equal vectors get equal results, an empty table gives no rows, and taken column names make the new ones
    end in an underscore. A sum of squares beyond a long is null.
    """
    names = fresh(df, "whitened", "deviation")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        if fitted is None:
            return
        matrix = (fitted.directions / np.sqrt(fitted.values)[:, None]).T if len(fitted.values) else np.zeros((fitted.dimensions, 0))
        mean = fitted.mean
        for batch in batches:
            steps, usable, starts = stepped(batch.column(batch.schema.get_field_index(vector)))
            rows = np.flatnonzero(usable & (np.diff(starts) == fitted.dimensions))
            if not len(rows):
                continue
            x = steps[starts[rows][:, None] + np.arange(fitted.dimensions)]
            whitened = (x - mean) @ matrix
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(rows) + 1) * whitened.shape[1], pa.int32()), pa.array(whitened.reshape(-1), pa.float64())
            )
            deviation = pa.array(_deviations(x, fitted.n, fitted.sums), pa.int64())
            yield appended(batch.take(pa.array(rows)), **dict(zip(names, (lists, deviation), strict=True)))

    return over_batches(df, run, with_columns(df, **dict(zip(names, ("array<double>", "long"), strict=True))))


def op12_whitening(embeddings: DataFrame) -> DataFrame:
    """A row per usable vector and component."""
    rows = embeddings.select("vec_id", "embedding")
    model = fit_whitening(rows)
    whitened = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = [float(e) for e in model.explained] if model is not None else []
    share = F.get(F.array(*[F.lit(e) for e in explained]).cast("array<double>"), F.col("at"))
    return whitened.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation",
        "whitened", share.alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
