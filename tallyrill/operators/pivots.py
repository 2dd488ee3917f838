"""Exact k nearest rows by pivot cells.

Rows go to the nearest of a bounded number of pivots, and within such a cell to rings of distance from it.
For a query, the triangle inequality bounds from below how near the rows of a ring can be: by the ring's
inner and outer distance, and by how far the query is from the plane between the two pivots. A first pass
searches the nearest rings that hold ``k`` rows; its k-th distance tells which others the second pass has
to visit. Rings of many rows, copies of one vector for instance, are cut into salted parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrill.operators.recommend import top_per
from tallyrill.session import stage

SLACK = 1e-6  # of the largest length: what rounding can do to a distance from sums of squares
CELLS = 1 << 20  # distances or bounds that a task holds at a time
FOUND = "query_id bigint, train_id bigint, label double, distance double"


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float) if len(column) else np.zeros((0, width))


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    d2 = (q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2.0 * (q @ x.T)
    return np.sqrt(np.maximum(d2, 0.0))


def _pieces(rows: int, columns: int) -> Iterator[slice]:
    step = max(1, CELLS // max(1, columns))
    return (slice(at, at + step) for at in range(0, rows, step))


def _best_of(k: int, width: int):
    """The ``k`` nearest rows of one part for each of its queries, none beyond the query's bound."""

    def search(train: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        parts = []
        x, q = _matrix(train["v"], width), _matrix(queries["v"], width)
        ids, labels = train["train_id"].to_numpy(), train["label"].to_numpy()
        asked, bound = queries["query_id"].to_numpy(), queries["bound"].to_numpy()
        for some in _pieces(len(q), len(x)) if len(x) else ():
            d = _distances(q[some], x)
            rough = SLACK * (np.sqrt((q[some] ** 2).sum(1)) + np.sqrt((x * x).sum(1).max()))[:, None]
            kth = np.partition(d, k - 1, axis=1)[:, k - 1 : k] if len(x) > k else np.full((len(d), 1), np.inf)
            a, r = np.nonzero((d <= kth + rough) & (d <= bound[some][:, None] + rough))
            exact = np.zeros(len(a))
            for at in _pieces(len(a), width):
                exact[at] = np.sqrt(((q[some][a[at]] - x[r[at]]) ** 2).sum(1))
            order = np.lexsort((ids[r], exact, a))
            a, r, exact = a[order], r[order], exact[order]
            starts = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, int)
            rank = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))
            a, r, exact = a[rank < k], r[rank < k], exact[rank < k]
            parts.append(pd.DataFrame({"query_id": asked[some][a], "train_id": ids[r], "label": labels[r], "distance": exact}))
        none = pd.DataFrame({"query_id": np.zeros(0, "int64"), "train_id": np.zeros(0, "int64"), "label": np.zeros(0), "distance": np.zeros(0)})
        return pd.concat(parts) if parts else none

    return search


class PivotCells:
    """Training rows (``train_id``, ``label``, ``v``) in cells and rings, staged once for any number of searches.

    At most ``pivots`` pivots are taken (the first rows by a hash of their id, one for each ``cell_rows`` rows), and a
    cell has at most ``rings`` rings; that table is what the driver and the tasks hold. All rows are in a cell,
    but those without a vector, which no search finds. Vectors have one length.
    """

    def __init__(self, train: DataFrame, pivots: int = 256, cell_rows: int = 500, rings: int = 16, part_rows: int = 20_000):
        rows = train.where("v IS NOT NULL").select("train_id", F.col("label").cast("double").alias("label"), F.col("v").cast("array<double>").alias("v"))
        self.n = rows.count()
        chosen = rows.select("v", F.xxhash64("train_id").alias("h"), "train_id").orderBy("h", "train_id").limit(max(1, min(pivots, self.n // cell_rows))).collect()
        self.empty = not chosen
        if self.empty:
            return
        self.pivots = np.unique(np.array([r.v for r in chosen], float), axis=0)
        self.width = self.pivots.shape[1]
        places, width = self.pivots, self.width

        def nearest_pivot(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                v = _matrix(batch["v"], width)
                cell, far = np.zeros(len(v), np.int32), np.zeros(len(v))
                for some in _pieces(len(v), len(places)):
                    d = _distances(v[some], places)
                    cell[some] = d.argmin(axis=1)
                    far[some] = d[np.arange(len(d)), cell[some]]
                yield batch.assign(cell=cell, far=far, size=np.sqrt((v * v).sum(1)))

        kind = "train_id bigint, label double, v array<double>, cell int, far double, size double"
        placed = stage(rows.mapInPandas(nearest_pivot, kind), "placed")
        shares = [i / rings for i in range(1, rings)]
        cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("far", shares).alias("cuts"), F.max("size").alias("size")).collect()
        self.largest = max(r["size"] for r in cells)
        cuts = {}
        for r in cells:
            parts = max(1, min(rings, math.ceil(r["n"] / cell_rows)))
            cuts[r["cell"]] = np.unique([r["cuts"][i * rings // parts - 1] for i in range(1, parts)])

        def ringed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                cell, far, at = batch["cell"].to_numpy(), batch["far"].to_numpy(), np.zeros(len(batch), np.int32)
                for c in np.unique(cell):
                    at[cell == c] = c * rings + np.searchsorted(cuts[c], far[cell == c])  # equal distances are in one ring
                yield batch[["train_id", "label", "v", "far"]].assign(at=at)

        found = stage(placed.mapInPandas(ringed, "train_id bigint, label double, v array<double>, far double, at int"), "ringed")
        sizes = found.groupBy("at").agg(F.min("far"), F.max("far"), F.count(F.lit(1))).collect()
        #: number, cell, least and most distance from the pivot, rows, parts
        self.rings = sorted((r[0], r[0] // rings, r[1], r[2], r[3], math.ceil(r[3] / part_rows)) for r in sizes)
        parts = train.sparkSession.createDataFrame([(r[0], r[5]) for r in self.rings], "at int, parts int")
        # a row for each ring
        self.rows = found.join(F.broadcast(parts), "at").select("train_id", "label", "v", "at", F.pmod(F.xxhash64("train_id"), F.col("parts")).cast("int").alias("part"))

    def _visits(self, queries: DataFrame, k: int, first: bool) -> DataFrame:
        """``query_id``, ``v``, ``bound``, ``at``, ``part``: the rings that a query has to see in this pass.

        First the nearest rings that hold ``k`` rows; then, from the bound that these gave, what else can be within it.
        """
        pivots, width, largest = self.pivots, self.width, self.largest
        number, cell, inner, outer, count, parts = (np.array(c) for c in zip(*self.rings, strict=True))
        between = _distances(pivots, pivots)

        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                q, bound = _matrix(batch["v"], width), batch["bound"].to_numpy()
                for some in _pieces(len(q), 4 * int(parts.sum())):
                    d = _distances(q[some], pivots)
                    rough = SLACK * (np.sqrt((q[some] ** 2).sum(1)) + largest)[:, None]
                    own = d.argmin(axis=1)
                    apart = between[own]
                    plane = np.where(apart > 1e-3 * largest, (d**2 - d.min(axis=1)[:, None] ** 2) / (2 * np.maximum(apart, 1e-300)), 0.0)
                    near = d[:, cell]
                    least = np.maximum(np.maximum(inner - near, near - outer), np.maximum(plane[:, cell], 0.0))
                    order = np.lexsort((near, least), axis=-1)
                    before = np.cumsum(count[order], axis=1) - count[order]
                    seen = np.zeros(least.shape, bool)
                    np.put_along_axis(seen, order, before < k, axis=1)
                    a, r = np.nonzero(seen if first else ~seen & (least <= bound[some][:, None] + rough))
                    part = np.concatenate([np.arange(p) for p in parts[r]]) if len(r) else np.zeros(0, int)
                    a, r = np.repeat(a, parts[r]), np.repeat(r, parts[r])
                    # each visit has its query's vector, so a few go out at a time
                    for few in _pieces(len(a), width):
                        yield batch.iloc[some].iloc[a[few]].assign(at=number[r[few]].astype(np.int32), part=part[few].astype(np.int32))

        return queries.mapInPandas(route, "query_id bigint, v array<double>, bound double, at int, part int")

    def _searched(self, visits: DataFrame, k: int, slices: int) -> DataFrame:
        keys = ["at", "part", "slice"]
        asked = visits.withColumn("slice", F.pmod(F.xxhash64("query_id"), F.lit(slices)).cast("int")).groupBy(*keys)
        rows = self.rows.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).groupBy(*keys)
        return top_per(rows.cogroup(asked).applyInPandas(_best_of(k, self.width), FOUND), ["query_id"], [F.col("distance"), F.col("train_id")], k)

    def search(self, queries: DataFrame, k: int, slice_rows: int = 5_000) -> tuple[DataFrame, DataFrame]:
        """The ``k`` nearest rows of each of ``queries`` (``query_id``, ``v``), and the visits of both passes.

        Nearest comes first, ties by training id. Queries without a vector have no rows.
        """
        asked = queries.where("v IS NOT NULL").select("query_id", F.col("v").cast("array<double>").alias("v"))
        slices = max(1, math.ceil(asked.count() / slice_rows))
        own = self._visits(asked.withColumn("bound", F.lit(math.inf)), k, True)
        near = stage(self._searched(own, k, slices), "near")
        bounds = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"))
        bounded = asked.join(bounds, "query_id", "left").select("query_id", "v", F.when(F.col("n") >= k, F.col("far")).otherwise(F.lit(math.inf)).alias("bound"))
        others = stage(self._visits(bounded, k, False), "visits")
        found = near.unionByName(self._searched(others, k, slices))
        return top_per(found, ["query_id"], [F.col("distance"), F.col("train_id")], k), own.unionByName(others)

    def compared(self, visits: DataFrame) -> int:
        """Pairs of a query and a row whose distance the visits work out."""
        sizes = self.rows.groupBy("at", "part").agg(F.count(F.lit(1)).alias("rows"))
        return visits.groupBy("at", "part").agg(F.count(F.lit(1)).alias("n")).join(sizes, ["at", "part"]).agg(F.sum(F.col("n") * F.col("rows")).alias("pairs")).first().pairs or 0
