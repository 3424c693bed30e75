"""Whitening of embeddings from an exact covariance that is counted on bit planes.

Entries become whole numbers. Each dimension is shifted by its least value, and every bit of the rest is a plane: the
bits of a block of rows, packed into machine words. The cross-product of two dimensions is the sum, over pairs of their
planes, of the population count of both planes' conjunction, weighted by the two powers of two. Tasks emit one such sum
per pair of dimensions; their totals are centred as integers, and only the finished covariance becomes floating point.

What reaches the driver is one row per pair of dimensions, however many vectors there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024, 100_000  # x = floor(SCALE * entry) + OFFSET
COMPONENTS = 8
BLOCK_ROWS = 4096  # rows of a block of planes
WIDE_BITS = 21  # planes of more bits than these are weighted as Python integers
_FOLD_ROWS = 1 << 20  # rows whose weighted counts surely fit 64 bits below WIDE_BITS
_DECIMAL = pa.decimal128(38, 0)

OUTPUT = (
    "vec_id {id}, component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double, deviation_exact decimal(38,0)"
)


def whole_numbers(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, x) for each length among the usable vectors of a list array of doubles; x is int64, rows by
    dimensions. Null vectors, and those with null or non-finite entries or entries whose x passes 64 bits, are left
    out."""
    lengths = np.array([-1 if k is None else k for k in pc.list_value_length(vectors).to_pylist()], dtype=np.int64)
    flat = pc.list_flatten(vectors)
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64) if len(flat) else np.zeros(0)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values * SCALE)
        good = np.abs(scaled) < 2.0**62  # false for NaN, infinities and nulls, which numpy has as NaN
    ends = np.cumsum(np.maximum(lengths, 0))
    bad_before = np.concatenate([[0], np.cumsum(~good)])
    starts = ends - np.maximum(lengths, 0)
    usable = (lengths > 0) & (bad_before[ends] == bad_before[starts])
    for d in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == d))
        yield d, rows, scaled[starts[rows][:, None] + np.arange(d)].astype(np.int64) + OFFSET


def column_sums(x: np.ndarray) -> list[int]:
    """Exact sums of the columns of an int64 matrix, as Python integers."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(k) for h, k in zip(high, low)]


def bit_planes(x: np.ndarray, least: np.ndarray, bits: list[int]) -> np.ndarray:
    """Planes (all bits of dimension 0, low to high, then of 1, ...) by words of 64 rows each."""
    shifted = np.zeros((-(-len(x) // 64) * 64, x.shape[1]), dtype=np.uint64)
    shifted[: len(x)] = x.view(np.uint64) - least.view(np.uint64)  # wraps around to the right difference
    columns = np.ascontiguousarray(shifted.T)
    planes = np.concatenate(
        [(columns[j] >> np.arange(b, dtype=np.uint64)[:, None]).astype(np.uint8) & 1 for j, b in enumerate(bits) if b]
        or [np.zeros((0, columns.shape[1]), dtype=np.uint8)]
    )
    return np.packbits(planes, axis=1, bitorder="little").view(np.uint64)


def cross_products(planes: np.ndarray, bits: list[int]) -> np.ndarray:
    """Sums over rows of products of dimensions i <= j; int64, or Python integers for wide dimensions."""
    d, starts = len(bits), np.cumsum([0, *bits])
    wide = max(bits, default=0) > WIDE_BITS
    out = np.zeros((d, d), dtype=object if wide else np.int64)
    used = [j for j in range(d) if bits[j]]
    weights = np.concatenate([np.arange(b, dtype=np.int64) for b in bits])
    weights = np.array([1 << int(w) for w in weights], dtype=object) if wide else np.int64(1) << weights
    for i in used:
        later = [j for j in used if j >= i]
        cuts = starts[later] - starts[i]
        for b in range(bits[i]):
            both = planes[starts[i] + b] & planes[starts[i] :]
            counts = np.bitwise_count(both).sum(axis=1, dtype=np.int64) * weights[starts[i] :]
            out[i, later] += np.add.reduceat(counts, cuts) * (1 << b)
    return out


def _decimals(numbers: list[int]) -> pa.Array:
    return pa.array([Decimal(k) for k in numbers], _DECIMAL)


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length and dimension of a task's vectors: number, least, greatest and sum of x."""
    held: dict[int, tuple[int, np.ndarray, np.ndarray, list[int]]] = {}
    for batch in batches:
        for d, _, x in whole_numbers(batch.column(0)):
            low, high, total = x.min(axis=0), x.max(axis=0), column_sums(x)
            if d in held:
                n, a, b, s = held[d]
                held[d] = n + len(x), np.minimum(a, low), np.maximum(b, high), [p + q for p, q in zip(s, total)]
            else:
                held[d] = len(x), low, high, total
    for d, (n, low, high, total) in held.items():
        columns = [pa.array(np.full(d, d)), pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n))]
        columns += [pa.array(low), pa.array(high), _decimals(total)]
        yield pa.RecordBatch.from_arrays(columns, ["d", "j", "n", "low", "high", "total"])


class Fit:
    """What is learned from all vectors of one length: shifts, sums, covariance, axes. Small: by dimensions only."""

    def __init__(self, rows: list):
        self.d, self.n = len(rows), int(rows[0].n)
        self.low = np.array([r.low for r in rows], dtype=np.int64)
        self.high = [int(r.high) for r in rows]
        self.sums = [int(r.total) for r in rows]
        self.bits = [(h - int(k)).bit_length() for h, k in zip(self.high, self.low)]
        spread = [max(self.n * h - s, s - self.n * int(k)) for h, k, s in zip(self.high, self.low, self.sums)]
        reach = max(self.n * max(abs(h), abs(int(k))) + abs(s) for h, k, s in zip(self.high, self.low, self.sums))
        self.narrow = reach < 2**62 and sum(s * s for s in spread) < 2**63
        self.axes = np.zeros((self.d, 0))
        self.values = np.zeros(0)
        self.explained: list[float | None] = []

    def set_axes(self, products: dict[tuple[int, int], int]) -> None:
        """Eigenvectors by falling eigenvalue, from the exact integers n * (sum of products) - (product of sums)."""
        shifted = [s - self.n * int(k) for s, k in zip(self.sums, self.low)]
        covariance, trace = np.zeros((self.d, self.d)), 0
        for i in range(self.d):
            for j in range(i, self.d):
                centred = self.n * products.get((i, j), 0) - shifted[i] * shifted[j]
                covariance[i, j] = covariance[j, i] = centred / (self.n * self.n)
                trace += centred if i == j else 0
        values, vectors = np.linalg.eigh(covariance)
        k = min(COMPONENTS, self.d)
        self.values, self.axes = values[::-1][:k], np.ascontiguousarray(vectors[:, ::-1][:, :k])
        total = trace / (self.n * self.n)
        self.explained = [float(v) / total if total else None for v in self.values]
        floor = self.d * np.finfo(np.float64).eps * max(float(self.values[0]), 0.0)
        self.live = self.values > floor  # other components have no spread to divide by

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: int64, or Python integers where these would not do."""
        if self.narrow:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """Projections on the components over their standard deviations; NaN for components without spread."""
        at = (centred / self.n).astype(np.float64)
        root = np.where(self.live, np.sqrt(np.where(self.live, self.values, 1.0)), np.nan)
        return at @ self.axes / root


def fit(vectors: DataFrame) -> Fit | None:
    """The fit of `vectors(embedding)`; None without a usable vector. Of several lengths the commonest counts, the
    longest of equally common ones."""
    spark = vectors.sparkSession
    stats = vectors.mapInArrow(_bounds, "d bigint, j int, n bigint, low bigint, high bigint, total decimal(38,0)")
    stats = stats.groupBy("d", "j").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total")
    )
    widest = stats.orderBy(F.desc("n"), F.desc("d")).select("d").first()
    if widest is None:
        return None
    found = Fit(stats.where(F.col("d") == widest.d).orderBy("j").collect())
    shared = spark.sparkContext.broadcast(found)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        total, held, folded = np.zeros((f.d, f.d), dtype=object), np.zeros((f.d, f.d), dtype=np.int64), 0
        waiting: list[np.ndarray] = []

        def count(rows: np.ndarray) -> None:
            nonlocal held, folded, total
            if folded + len(rows) > _FOLD_ROWS:
                total, held, folded = total + held, np.zeros_like(held), 0
            held, folded = held + cross_products(bit_planes(rows, f.low, f.bits), f.bits), folded + len(rows)

        size = 0
        for batch in batches:
            for d, _, x in whole_numbers(batch.column(0)):
                if d == f.d:
                    waiting.append(x)
                    size += len(x)
            while size >= BLOCK_ROWS:
                joined = np.concatenate(waiting)
                count(joined[:BLOCK_ROWS])
                waiting, size = [joined[BLOCK_ROWS:]], size - BLOCK_ROWS
        if size:
            count(np.concatenate(waiting))
        i, j = np.triu_indices(f.d)
        numbers = [int(v) for v in (total + held)[i, j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), _decimals(numbers)], ["i", "j", "product"]
        )

    sums = vectors.mapInArrow(products, "i int, j int, product decimal(38,0)").groupBy("i", "j").agg(F.sum("product").alias("p"))
    found.set_axes({(r.i, r.j): int(r.p) for r in sums.toLocalIterator()})  # one row per pair of dimensions
    return found


def identity_error(vectors: DataFrame, found: Fit) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured over all vectors."""
    shared = vectors.sparkSession.sparkContext.broadcast(found)
    live = np.flatnonzero(found.live)
    if not len(live):
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, k = shared.value, len(live)
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            for d, _, x in whole_numbers(batch.column(0)):
                if d == f.d:
                    w = np.column_stack([np.ones(len(x)), f.whitened(f.centred(x))[:, live]])
                    total += w.T @ w
        i, j = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "m"])

    rows = vectors.mapInArrow(moments, "i int, j int, m double").groupBy("i", "j").agg(F.sum("m").alias("m")).collect()
    m = np.zeros((len(live) + 1,) * 2)
    for r in rows:
        m[r.i, r.j] = r.m
    mean = m[0, 1:] / found.n
    return float(np.abs(m[1:, 1:] / found.n - np.outer(mean, mean) - np.eye(len(live))).max())


def whiten(table: DataFrame) -> DataFrame:
    """One row per usable vector of `table(vec_id, embedding)` and component: vec_id, component, n, deviation, whitened,
    explained, identity_error, deviation_exact.

    Vectors that are null, empty, or hold null or non-finite entries give no row (an entry whose x passes 64 bits counts
    as non-finite). All others are the fit list. Vectors of another length than the commonest are not in it and give
    one row with nulls beside their id. `deviation` is null where it passes 64 bits; `deviation_exact` has it up to 38
    digits. A component without spread has null whitened values, and null explained where nothing has spread. Null ids
    and repeated rows stay; other columns are ignored; no vectors give no rows.
    """
    spark = table.sparkSession
    schema = OUTPUT.format(id=table.schema["vec_id"].dataType.simpleString())
    given = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    found = fit(given.select("embedding"))
    if found is None:
        return spark.createDataFrame([], schema)
    error = identity_error(given.select("embedding"), found)
    shared = spark.sparkContext.broadcast(found)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        names = [part.split(" ")[0] for part in OUTPUT.split(", ")]
        for batch in batches:
            for d, places, x in whole_numbers(batch.column(1)):
                k = len(f.values) if d == f.d else 1
                ids = batch.column(0).take(pa.array(np.repeat(places, k)))
                if d != f.d:
                    empty = [pa.nulls(len(ids), t) for t in (pa.int32(), pa.int64(), pa.int64(), *[pa.float64()] * 3, _DECIMAL)]
                    yield pa.RecordBatch.from_arrays([ids, *empty], names)
                    continue
                centred = f.centred(x)
                exact = (centred * centred).sum(axis=1).tolist()
                again = pa.array(np.repeat(np.arange(len(x)), k))
                white = f.whitened(centred).ravel()
                columns = [
                    ids,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(ids), f.n)),
                    pa.array([v if v < 2**63 else None for v in exact], pa.int64()).take(again),
                    pa.array(white, mask=np.isnan(white)),
                    pa.array(f.explained * len(x), pa.float64()),
                    pa.array(np.full(len(ids), error)),
                    pa.array([Decimal(v) if v < 10**38 else None for v in exact], _DECIMAL).take(again),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return given.mapInArrow(rows, schema)
