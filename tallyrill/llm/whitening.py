"""Whitening of vectors by Chebyshev-filtered subspace iteration.

Vectors become whole numbers, so counts, sums and traces are exact. The covariance is never formed: a pass
over the staged rows gives its product with a block of at most ``components + GUARDS`` columns, from centred rows, and
that block is all that comes to the driver. A polynomial recurrence of such passes damps the unwanted part
of the spectrum, then QR and Rayleigh-Ritz turn the block, until residuals are at rounding level and a round
from fresh guard columns finds nothing that was missed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrill.llm.base import staged

ROWS = 4096  # vectors in a staged block
GUARDS = 16  # columns beside the wanted ones
LANCZOS = 10  # steps that place the lower end of the spectrum
GAIN = 1e10  # the most that one round amplifies by, so that columns stay apart
MOST_DEGREE, MOST_ROUNDS = 24, 200
LARGEST = 1 << 52  # of a whole number
FLAT = 1e-12  # an eigenvalue under this share of the largest counts as none


def _blocks(width: int, scale: int):
    """Rows of ``ids`` and the matrix ``y = floor(scale * entry)`` as bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, ROWS):
                some = batch.slice(part, ROWS)
                some = some.filter(pc.fill_null(pc.equal(pc.list_value_length(some.column(1)), width), False))
                values = some.column(1).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
                good = np.isfinite(values).all(axis=1)
                y = np.floor(values[good] * scale)
                if not len(y):
                    continue
                if np.abs(y).max() >= LARGEST:
                    raise ValueError(f"an entry is beyond {LARGEST} / {scale}")
                ids = some.column(0).filter(pa.array(good))
                yield pa.RecordBatch.from_arrays([pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([y.astype("<i8").tobytes()])], ["ids", "y"])

    return run


def _matrices(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for ids, y in zip(batch.column(0), batch.column(1), strict=True):
            yield ids.values, np.frombuffer(y.as_py(), "<i8").reshape(-1, width)


def _sums(width: int):
    """``dim``, ``rows``, the sum and the sum of squares of each dimension, and its largest entry."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total, squares, peak = 0, [0] * width, [0] * width, [0] * width
        for _, y in _matrices(batches, width):
            top = np.abs(y).max(axis=0)
            wide = y if int(top.max()) ** 2 * len(y) < 1 << 62 else y.astype(object)
            rows += len(y)
            total = [a + int(b) for a, b in zip(total, wide.sum(axis=0), strict=True)]
            squares = [a + int(b) for a, b in zip(squares, (wide * wide).sum(axis=0), strict=True)]
            peak = [max(a, int(b)) for a, b in zip(peak, top, strict=True)]
        if rows:
            whole = [pa.array(map(Decimal, x), pa.decimal128(38, 0)) for x in (total, squares)]
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([rows] * width, pa.int64()), *whole, pa.array(peak, pa.int64())], ["dim", "rows", "total", "squares", "peak"])

    return run


class Table:
    """Staged whole-number vectors with their exact count, sums and trace."""

    def __init__(self, df: DataFrame, id_col: str, vec_col: str, scale: int, shift: int):
        lengths = df.select(F.size(vec_col).alias("width")).where(f"`{vec_col}` IS NOT NULL AND width > 0").groupBy("width").count()
        most = lengths.orderBy(F.desc("count"), F.desc("width")).first()
        self.n, self.width = 0, most.width if most else 0
        if not most:
            return
        own = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vector"))
        self.blocks = staged(own.mapInArrow(_blocks(self.width, scale), "ids array<long>, y binary"), "vectors")
        made = self.blocks.mapInArrow(_sums(self.width), "dim int, rows long, total decimal(38,0), squares decimal(38,0), peak long")
        sums = made.groupBy("dim").agg(*(F.sum(c).alias(c) for c in ("rows", "total", "squares")), F.max("peak").alias("peak")).orderBy("dim").collect()
        if not sums:
            return
        self.n = sums[0].rows
        self.totals = [int(r.total) for r in sums]  # of y; x is y + shift
        self.sums = [t + self.n * shift for t in self.totals]
        #: the sum over rows of (n * x - S) ** 2, which is n ** 3 times the trace of the covariance
        self.deviations = sum(self.n**2 * int(r.squares) - self.n * int(r.total) ** 2 for r in sums)
        self.exact = 2 * self.n * max(r.peak for r in sums) < 1 << 62
        self.plain = (2 * self.n * max(r.peak for r in sums)) ** 2 * self.width < 1 << 62

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        """From ``y`` to ``n * x - S``, exact."""
        n, totals = self.n, np.array(self.totals, np.int64 if self.exact else object)
        return (lambda y: y * n - totals) if self.exact else (lambda y: y.astype(object) * n - totals)

    def summed(self, rows: int, columns: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all vectors of a ``rows`` x ``columns`` matrix that ``part`` gives for centred ones."""
        width, n, centred = self.width, self.n, self.centred()

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((rows, columns))
            for _, y in _matrices(batches, width):
                total += part(centred(y).astype(float) / n)
            yield pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int32()), *(pa.array(c) for c in total.T)], ["at", *names])

        names = [f"c{i}" for i in range(columns)]
        made = self.blocks.mapInArrow(run, "at int, " + ", ".join(f"{c} double" for c in names))
        found = made.groupBy("at").agg(*(F.sum(c).alias(c) for c in names)).collect()
        out = np.zeros((rows, columns))
        for row in found:
            out[row["at"]] = row[1:]
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times ``q``: one pass."""
        return self.summed(*q.shape, lambda x: x.T @ (x @ q)) / self.n


def _lower_end(times: Callable[[np.ndarray], np.ndarray], width: int, rng: np.random.Generator) -> float:
    """About where the spectrum begins, by Lanczos steps with full reorthogonalisation."""
    basis = [rng.normal(size=width)]
    basis[0] /= np.linalg.norm(basis[0])
    diagonal, beside = [], []
    for _ in range(min(LANCZOS, width)):
        w = times(basis[-1][:, None])[:, 0]
        diagonal.append(basis[-1] @ w)
        for _ in range(2):
            for v in basis:
                w = w - (v @ w) * v
        beside.append(np.linalg.norm(w))
        if beside[-1] <= 1e-12 * max(map(abs, diagonal)):
            break
        basis.append(w / beside[-1])
    ritz, turned = np.linalg.eigh(np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1))
    return max(0.0, ritz[0] - beside[-1] * abs(turned[-1, 0]))


def _filtered(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of the covariance times ``q``: at most 1 in size from ``low`` to ``high``, scaled at ``top``."""
    half, middle = (high - low) / 2, (high + low) / 2
    s = first = half / (top - middle)
    before, now = q, (times(q) - middle * q) * (s / half)
    for _ in range(degree - 1):
        next_s = 1 / (2 / first - s)
        before, now = now, (times(now) - middle * now) * (2 * next_s / half) - (s * next_s) * before
        s = next_s
    return now


def _turned(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """QR and Rayleigh-Ritz: values falling, vectors, and the norm of each residual."""
    q = np.linalg.qr(q)[0]
    w = times(q)
    h = q.T @ w
    values, turn = np.linalg.eigh((h + h.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q, w = q @ turn, w @ turn
    return values, q, np.linalg.norm(w - q * values, axis=0)


def leading(times: Callable[[np.ndarray], np.ndarray], width: int, components: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns, of what ``times`` multiplies by.

    Certified: residuals at rounding level, and the same values after a round whose guard columns are new.
    """
    rng = np.random.default_rng(seed)
    want, block = min(components, width), min(width, components + GUARDS)
    values, q, off = _turned(times, rng.normal(size=(width, block)))
    if block < width:
        low = _lower_end(times, width, rng)
        worst, sure = math.inf, None
        for _ in range(MOST_ROUNDS):
            left = off[:want].max()
            if left <= 2e-15 * math.sqrt(width) * values[0] or left <= 1e-12 * values[0] and left > worst / 2:
                if sure is not None and np.abs(sure - values[:want]).max() <= 1e-12 * values[0]:
                    break
                sure, worst = values[:want], math.inf
                q[:, want:] = rng.normal(size=(width, block - want))
                q = np.linalg.qr(q)[0]
            else:
                worst = left
            low, high = min(low, values[-1]), values[-1]
            if high - low > FLAT * values[0]:
                reach = math.acosh(max(1 + 1e-9, (2 * values[0] - high - low) / (high - low)))
                degree = max(2, min(MOST_DEGREE, int(math.log(2 * GAIN) / reach)))
                filtered = _filtered(times, q, low, high, values[0], degree)
            else:
                filtered = times(q)  # nothing to damp by a polynomial
            values, q, off = _turned(times, filtered)
        else:
            raise RuntimeError(f"not settled after {MOST_ROUNDS} rounds: {off[:want]}")
    values, q = values[:want], q[:, :want]
    q = q * np.where(q[np.abs(q).argmax(axis=0), np.arange(want)] < 0, -1.0, 1.0)
    kept = values > FLAT * max(values[0], 0)
    return values[kept], q[:, kept]


def whitened(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """Each vector on the leading components of all of them, in units of their standard deviation.

    Entries become ``x = floor(scale * entry) + shift``. Rows: ``vec_id``, ``component`` (from 1, by falling
    eigenvalue), ``n``, ``deviation`` (the sum of ``(n * x - S) ** 2``, exact, up to 38 digits), ``whitened``,
    ``explained`` (share of the trace) and ``identity_error`` (largest entry of whitened's covariance less the
    identity). Vectors that are null or hold null or non-finite entries take no part, nor do those of another
    length than the most common one (of equally common ones the longest). Null and repeated ids are rows of their own. Components
    without variance aren't given, so vectors that are all equal, one vector or an empty table give no rows.
    """
    spark = df.sparkSession
    kind = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    table = Table(df, id_col, vec_col, scale, shift)
    if table.n == 0 or table.deviations == 0:
        return spark.createDataFrame([], kind)
    values, axes = leading(table.times, table.width, components)
    k, n, width = len(values), table.n, table.width
    onto = axes / np.sqrt(values)
    error = float(np.abs(table.summed(k, k, lambda x: (x @ onto).T @ (x @ onto)) / n - np.eye(k)).max())
    trace = table.deviations / n**3
    centred, plain = table.centred(), table.plain

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, y in _matrices(batches, width):
            apart = centred(y)
            wide = apart if plain else apart.astype(object)
            squares = pa.array([Decimal(int(s)) for s in (wide * wide).sum(axis=1)], pa.decimal128(38, 0))
            each = np.repeat(np.arange(len(y)), k)
            own = (apart.astype(float) / n) @ onto
            columns = [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))), squares.take(pa.array(each)), pa.array(own.ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "deviation", "whitened"])

    made = table.blocks.mapInArrow(run, "vec_id long, component int, deviation decimal(38,0), whitened double")
    shares = F.array(*(F.lit(float(v / trace)) for v in values))
    return made.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.element_at(shares, F.col("component")).alias("explained"), F.lit(error).alias("identity_error"))
