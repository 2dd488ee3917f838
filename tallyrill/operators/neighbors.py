"""k nearest neighbours: exactly, by pivot cells, or among rows that share a hashed bucket."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrill.operators.pivots import FOUND, PivotCells
from tallyrill.operators.recommend import top_per


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    d2 = (q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2.0 * (q @ x.T)
    return np.sqrt(np.maximum(d2, 0.0))


def _block_search(k: int):
    def search(train: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        cols = ["query_id", "train_id", "label", "distance"]
        if train.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "train_id": [], "label": [], "distance": []})
        train = train.sort_values("train_id")
        x = np.stack(train["v"].to_numpy()).astype(float)
        ids, labels = train["train_id"].to_numpy(), train["label"].to_numpy()
        parts = []
        for at in range(0, len(queries), 256):
            some = queries.iloc[at : at + 256]
            d = _distances(np.stack(some["v"].to_numpy()).astype(float), x)
            best = np.argsort(d, axis=1, kind="stable")[:, :k]
            rows = np.repeat(np.arange(len(some)), best.shape[1])
            at_ = best.ravel()
            q = np.stack(some["v"].to_numpy()).astype(float)
            exact = np.sqrt(((q[rows] - x[at_]) ** 2).sum(1))
            parts.append(
                pd.DataFrame({"query_id": some["query_id"].to_numpy()[rows], "train_id": ids[at_], "label": labels[at_], "distance": exact})
            )
        return pd.concat(parts)[cols]

    return search


def _rows(train: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    return train.select("train_id", F.col("label").cast("double").alias("label"), "v"), queries.select("query_id", "v")


def nearest(train: DataFrame, queries: DataFrame, k: int, part_rows: int = 20_000, slice_rows: int = 5_000) -> DataFrame:
    """k nearest training rows of every query by Euclidean distance, exactly; ties by training id.

    ``train`` has (train_id, label, v) and ``queries`` (query_id, v), v an array of numbers. Rows lie in cells
    around pivots, and a query meets only those parts of cells that the triangle inequality doesn't rule
    out (``pivots.PivotCells``). Of vectors without any structure these are nearly all, in parts of at
    most about ``part_rows`` rows and ``slice_rows`` queries; ``nearest_hashed`` is the approximate form for such.
    """
    cells = PivotCells(train, part_rows=part_rows)
    if cells.empty:
        return train.sparkSession.createDataFrame([], FOUND)
    return cells.search(queries, k, slice_rows)[0]


def nearest_hashed(train: DataFrame, queries: DataFrame, k: int, width: int, bits: int = 8, tables: int = 24, block_rows: int = 20_000, seed: int = 11) -> DataFrame:
    """k nearest among the training rows that share a bucket with the query; approximate.

    A bucket is the signs of ``bits`` random projections of a vector of ``width`` numbers, in one of
    ``tables`` tables. Buckets of more than ``block_rows`` training rows are cut into blocks that all see
    the bucket's queries. Measure the recall against ``nearest`` before choosing the parameters.
    """
    planes = np.random.default_rng(seed).normal(size=(tables, bits, width))

    @F.pandas_udf("array<bigint>")
    def buckets(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy()).astype(float) if len(v) else np.zeros((0, width))
        codes = ((np.einsum("tbw,nw->ntb", planes, x) > 0) << np.arange(bits)).sum(2)
        return pd.Series(list(codes))

    t, q = _rows(train, queries)
    t, q = (df.select("*", F.posexplode(buckets("v")).alias("table", "bucket")) for df in (t, q))
    keys = ["table", "bucket"]
    sizes = t.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    # a row for each bucket: at most tables x 2 ^ bits
    t = t.join(F.broadcast(sizes), keys).withColumn("block", F.pmod(F.xxhash64("train_id"), "blocks")).drop("blocks")
    q = q.join(F.broadcast(sizes), keys).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).drop("blocks")
    found = (
        t.groupBy(*keys, "block")
        .cogroup(q.groupBy(*keys, "block"))
        .applyInPandas(_block_search(k), "query_id bigint, train_id bigint, label double, distance double")
    )
    # a pair may meet in several tables
    once = found.groupBy("query_id", "train_id", "label").agg(F.min("distance").alias("distance"))
    return top_per(once, ["query_id"], [F.col("distance"), F.col("train_id")], k)


def vote(neighbours: DataFrame) -> DataFrame:
    """Majority label; a tie goes to the label with the nearest row, then the smallest."""
    per = neighbours.groupBy("query_id", "label").agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("near"))
    best = F.min(F.struct((-F.col("n")).alias("m"), "near", "label")).alias("b")
    return per.groupBy("query_id").agg(best).select("query_id", F.col("b.label").alias("prediction"))
