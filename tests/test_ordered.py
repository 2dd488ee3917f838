"""Ordered primitives against pandas, with one key that holds most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyrill.operators import series as TS
from tallyrill.operators.evaluate import area_under_roc
from tallyrill.operators.ordered import exact_quantiles, fill_forward, over_blocks, with_position, with_running


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(5)
    n = 900
    key = np.where(rng.random(n) < 0.5, "hot", rng.choice(list("abc"), n))
    return pd.DataFrame({"k": key, "t": rng.permutation(n), "y": np.where(rng.random(n) < 0.2, None, rng.integers(0, 40, n))}).astype({"y": "float"})


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "k string, t bigint, y double")


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_position_and_running_sum(spark, df, pdf, shuffles, parts):
    shuffles(parts)
    got = with_position(df, ["k"], ["t"]).toPandas().sort_values("t")
    want = pdf.sort_values("t")
    assert (got["position"].to_numpy() == want.groupby("k").cumcount().to_numpy() + 1).all()
    assert (got["n_rows"].to_numpy() == want.groupby("k")["t"].transform("size").to_numpy()).all()
    run = with_running(df, ["k"], ["t"], F.col("t")).toPandas().sort_values("t")
    assert (run["running"].to_numpy() == want.groupby("k")["t"].cumsum().to_numpy()).all()
    assert (run["total"].to_numpy() == want.groupby("k")["t"].transform("sum").to_numpy()).all()


def test_position_without_keys_and_null_key(spark, shuffles):
    shuffles(5)
    rows = spark.createDataFrame([(None if i % 3 else "x", i) for i in range(60)], "k string, t int")
    whole = with_position(rows, [], ["t"]).toPandas()
    assert (whole["position"] == whole["t"] + 1).all() and (whole["n_rows"] == 60).all()
    keyed = with_position(rows, ["k"], ["t"]).toPandas()
    assert keyed[keyed["k"].isna()]["position"].max() == 40


@pytest.mark.parametrize("parts,block", [(1, 7), (4, 50), (17, 1000)])
def test_blocks_equal_plain_windows(df, pdf, shuffles, parts, block):
    shuffles(parts)
    placed = with_position(df, ["k"], ["t"])
    build = lambda w: {"m": F.avg("y").over(w.rowsBetween(-9, 0)), "l": F.lag("y", 12).over(w)}
    got = over_blocks(placed, ["k"], "position", 12, build, block).toPandas().sort_values("t")
    want = pdf.sort_values("t")
    rolled = want.groupby("k")["y"].transform(lambda s: s.rolling(10, min_periods=1).mean())
    np.testing.assert_allclose(got["m"].astype(float), rolled, equal_nan=True)
    np.testing.assert_allclose(got["l"].astype(float), want.groupby("k")["y"].shift(12), equal_nan=True)
    assert len(got) == len(pdf)


@pytest.mark.parametrize("block", [3, 64, 5000])
def test_fill_forward(df, pdf, shuffles, block):
    shuffles(4)
    holes = df.withColumn("y", F.when(F.col("y") > 30, F.col("y")))
    got = fill_forward(with_position(holes, ["k"], ["t"]), ["k"], "position", "y", block=block).toPandas().sort_values("t")
    want = pdf.sort_values("t")
    np.testing.assert_allclose(got["y"].astype(float), want["y"].where(want["y"] > 30).groupby(want["k"]).ffill(), equal_nan=True)


@pytest.mark.parametrize("parts", [1, 6])
def test_exact_quantiles(df, pdf, shuffles, parts):
    shuffles(parts)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, ["k"], "y", probs).toPandas().set_index(["k", "prob"])["value"].sort_index()
    want = pdf.groupby("k")["y"].quantile(probs).sort_index()
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy())


def test_area_under_roc_with_ties(spark):
    rng = np.random.default_rng(1)
    label, score = rng.integers(0, 2, 300), rng.integers(0, 20, 300) / 20
    pos, neg = score[label == 1], score[label == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    df = spark.createDataFrame(pd.DataFrame({"label": label, "score": score}))
    assert abs(area_under_roc(df).first()["auc"] - want) < 1e-12


def test_long_series_equal_bounded_ones(spark, pdf):
    df = spark.createDataFrame(pdf.assign(y=pdf["y"].fillna(1.0)))
    for fn in (
        lambda long: TS.acf(df, ["k"], ["t"], "y", 5, long).select("k", "lag", F.round("r", 10).alias("v")),
        lambda long: TS.bands(df, ["k"], ["t"], "y", 20, 2, long).select("k", "t", "ave"),
        lambda long: TS.split_by_position(df, ["k"], ["t"], 0.7, long).select("k", "t", "split"),
    ):
        assert sorted(map(tuple, fn(True).collect()), key=str) == sorted(map(tuple, fn(False).collect()), key=str)
