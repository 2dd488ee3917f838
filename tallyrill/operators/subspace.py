"""Principal components of wide, sparse vectors by randomised subspace iteration.

No width x width matrix is made. A pass multiplies all rows by a thin matrix; the triangular factor of the
tall product comes from factors of its parts, joined as a tree, and a second pass carries it back to the
columns. The driver holds a few thin matrices of one row per column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 512  # rows that are multiplied at a time


class _Part:
    """Some rows: places and values of their cells, row after row."""

    def __init__(self, sizes: np.ndarray, places: np.ndarray, values: np.ndarray):
        self.sizes, self.places, self.values = sizes, places, values

    def times(self, q: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.sizes), q.shape[1]))
        full = np.flatnonzero(self.sizes)
        if len(full):
            starts = (np.cumsum(self.sizes) - self.sizes)[full]
            out[full] = np.add.reduceat(self.values[:, None] * q[self.places], starts, axis=0)
        return out

    def back(self, g: np.ndarray, width: int) -> np.ndarray:
        each = np.repeat(g, self.sizes, axis=0) * self.values[:, None]
        return np.stack([np.bincount(self.places, each[:, c], minlength=width) for c in range(g.shape[1])], axis=1)


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[_Part]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            dense = np.asarray(pc.is_null(some.column(0)))
            for kind in (True, False):
                rows = some.filter(pa.array(dense == kind))
                if not rows.num_rows:
                    continue
                sizes = np.asarray(pc.list_value_length(rows.column(1))).astype(np.int64)
                values = rows.column(1).flatten().to_numpy(zero_copy_only=False)
                places = np.tile(np.arange(width), rows.num_rows) if kind else rows.column(0).flatten().to_numpy(zero_copy_only=False)
                yield _Part(sizes, places, values)


def _cells(df: DataFrame, column: str) -> DataFrame:
    """(indices, values) of vectors, without making sparse ones dense; null vectors are left out."""
    return df.where(F.col(column).isNotNull()).select(F.unwrap_udt(F.col(column)).alias("u")).select("u.indices", "u.values")


class WideComponents:
    """Mean, axes (columns, unit length, most variance first), variances and the shares of the total that they explain."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray, variances: np.ndarray, total: float):
        self.mean, self.axes, self.variances, self.total = mean, axes, variances, total

    @property
    def shares(self) -> np.ndarray:
        return self.variances / self.total if self.total > 0 else np.zeros(len(self.variances))

    def transform(self, df: DataFrame, column: str, out: str = "reduced") -> DataFrame:
        """``df`` with each vector's place on the axes; a null vector has none."""
        axes, shift, width = self.axes, self.mean @ self.axes, len(self.mean)

        @F.pandas_udf("array<double>")
        def placed(cells: pd.DataFrame) -> pd.Series:
            if not len(cells):
                return pd.Series([], dtype=object)
            found = []
            for indices, values in zip(cells["indices"], cells["values"], strict=True):
                if values is None:
                    found.append(None)
                    continue
                values = np.asarray(values, float)
                found.append(values @ (axes[: len(values)] if indices is None else axes[np.asarray(indices, int)]) - shift)
            return pd.Series(found)

        assert axes.shape[0] == width
        u = F.unwrap_udt(F.col(column))
        return df.withColumn(out, array_to_vector(placed(F.struct(u["indices"].alias("indices"), u["values"].alias("values")))))


def _triangle(cells: DataFrame, width: int, part: Callable[[_Part], np.ndarray], size: int) -> np.ndarray:
    """The triangular factor of the tall matrix that ``part`` gives row by row: parts, then groups of parts, then all."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = np.zeros((0, size))
        for some in _parts(batches, width):
            r = np.linalg.qr(np.vstack((r, part(some))), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], ["part", "r"])

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        r = np.zeros((0, size))
        for own in rows.sort_values("part")["r"]:
            r = np.linalg.qr(np.vstack((r, np.reshape(own, (-1, size)))), mode="r")
        return pd.DataFrame({"part": [rows["part"].min()], "r": [r.ravel()]})

    tops = cells.mapInArrow(local, "part int, r array<double>").groupBy(F.expr("part % 32")).applyInPandas(joined, "part int, r array<double>")
    rows = sorted(tops.collect(), key=lambda r: r["part"])  # at most 32
    return np.linalg.qr(np.vstack([np.zeros((0, size)), *[np.reshape(r["r"], (-1, size)) for r in rows]]), mode="r")


def _summed(cells: DataFrame, width: int, part: Callable[[_Part], np.ndarray], size: int) -> np.ndarray:
    """The sum of the width x size matrices that ``part`` gives; rows of zeros don't travel."""
    names = [f"c{i}" for i in range(size)]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, size))
        for some in _parts(batches, width):
            total += part(some)
        used = np.flatnonzero(np.abs(total).max(axis=1) > 0)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *[pa.array(c) for c in total[used].T]], ["at", *names])

    sums = cells.mapInArrow(local, "at int, " + ", ".join(f"{c} double" for c in names)).groupBy("at").agg(*[F.sum(c).alias(c) for c in names])
    out = np.zeros((width, size))
    for row in sums.collect():  # a row for each column of the vectors
        out[row["at"]] = row[1:]
    return out


def wide_components(df: DataFrame, column: str, k: int, extra: int = 10, rounds: int = 6, seed: int = 7) -> WideComponents:
    """The first ``k`` principal components of a vector column, sparse or dense.

    ``rounds`` passes there and back turn a random matrix of ``k + extra`` columns towards them. Vectors have one width; null ones are left out.
    ``df`` is read about ``2 * rounds + 3`` times, so give a stored table. Without rows there are no components.
    """
    first = df.where(F.col(column).isNotNull()).select(F.unwrap_udt(F.col(column)).alias("u")).select(F.coalesce("u.size", F.size("u.values")).alias("n")).first()
    if not first:
        return WideComponents(np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0)
    width, cells = first["n"], _cells(df, column)
    n = cells.count()
    moments = _summed(cells, width, lambda p: np.stack([np.bincount(p.places, p.values**i, minlength=width) for i in (1, 2)], axis=1), 2)
    mean = moments[:, 0] / n
    # the spread around the mean, by a second pass over the cells that are there
    apart = _summed(cells, width, lambda p: np.stack([np.bincount(p.places, (p.values - mean[p.places]) ** 2, minlength=width), np.bincount(p.places, minlength=width)], axis=1), 2)
    total = float((apart[:, 0] + (n - apart[:, 1]) * mean**2).sum() / n)
    size = min(k + extra, width)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0]
    for turn in range(rounds + 1):
        shift = mean @ q
        r = _triangle(cells, width, lambda p, q=q, shift=shift: p.times(q) - shift, size)
        u, s, v = np.linalg.svd(np.vstack((r, np.zeros((max(0, size - len(r)), size)))), full_matrices=False)
        if turn == rounds or s[0] == 0:
            break
        # the tall product times this has orthonormal columns; directions without spread are left out
        inverse = v.T * np.where(s > 1e-12 * s[0], 1 / np.maximum(s, 1e-300), 0.0)
        onto, moved = q @ inverse, shift @ inverse
        both = _summed(cells, width, lambda p, onto=onto, moved=moved: p.back(p.times(onto) - moved, width), size)
        # centred: the columns of the tall product sum to zero
        q = np.linalg.qr(both)[0]
    keep = min(k, int((s > 1e-12 * max(s[0], 1e-300)).sum()))
    axes = (q @ v.T)[:, :keep]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(keep)] < 0, -1.0, 1.0)
    return WideComponents(mean, axes, s[:keep] ** 2 / n, total)
