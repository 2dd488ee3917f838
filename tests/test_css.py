"""Multiplicative seasonal orders: planted models, plain recurrences, and blocks against whole series."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrill.operators import arima as A
from tallyrill.operators import css

SPEC = dict(p=1, d=1, q=1, sp=1, sd=0, sq=1, order_id=0)


def simulated(rng, n, ar, sar, ma, sma, s=12, burn=300):
    """(1 - ar B)(1 - sar B^s) z = (1 + ma B)(1 + sma B^s) e, summed up once."""
    e, z = rng.normal(size=n + burn), np.zeros(n + burn)
    for t in range(s + 1, n + burn):
        z[t] = ar * z[t - 1] + sar * z[t - s] - ar * sar * z[t - s - 1] + e[t] + ma * e[t - 1] + sma * e[t - s] + ma * sma * e[t - s - 1]
    return np.cumsum(z[burn:])


def table(spark, series):
    return spark.createDataFrame([(k, t, None if v != v else float(v)) for k, y in series.items() for t, v in enumerate(y)], "key string, t int, y double")


def plain_errors(y, beta, start, s=12):
    """The recurrence for (1,1,1)(1,0,1), row by row; errors before ``start`` are zero."""
    ar, sar, ma, sma = beta
    z = np.concatenate(([np.nan], np.diff(y)))
    e = np.zeros(len(y))
    for t in range(start, len(y)):
        u = z[t] - ar * z[t - 1] - sar * z[t - s] + ar * sar * z[t - s - 1]
        e[t] = u - ma * e[t - 1] - sma * e[t - s] - ma * sma * e[t - s - 1]
    return e[start:]


def test_planted_model_is_recovered_and_sse_is_that_of_the_recurrence(spark):
    rng = np.random.default_rng(1)
    series = {"a": simulated(rng, 2500, 0.5, 0.6, 0.4, -0.5), "b": simulated(rng, 2500, -0.3, 0.4, 0.5, 0.3)}
    want = {"a": (0.5, 0.6, 0.4, -0.5), "b": (-0.3, 0.4, 0.5, 0.3)}
    got = css.conditional_fits(table(spark, series), ["key"], ["t"], "y", [SPEC], 12, block_rows=4000).collect()
    assert len(got) == 2
    for r in got:
        assert r["status"] == "ok" and r["ar_ok"] and r["ma_ok"]
        assert np.abs(np.array(r["coef"]) - want[r["key"]]).max() < 0.1
        assert all(abs(c - w) < 4 * se for c, w, se in zip(r["coef"], want[r["key"]], r["se"], strict=True))
        e = plain_errors(series[r["key"]], r["coef"], 14)
        assert r["n"] == len(e) and abs(r["sse"] - e @ e) < 1e-6 * r["sse"]
        assert r["sse"] <= r["start_sse"]
        # a least value: moving any parameter makes it worse
        for i in range(4):
            for move in (-0.01, 0.01):
                moved = np.array(r["coef"]) + move * np.eye(4)[i]
                other = plain_errors(series[r["key"]], moved, 14)
                assert other @ other > r["sse"]
        assert abs(r["bic"] - (r["n"] * (math.log(2 * math.pi * r["sse"] / r["n"]) + 1) + 5 * math.log(r["n"]))) < 1e-6


@pytest.mark.parametrize("long", [False, True])
def test_blocks_give_what_the_whole_series_gives(spark, long, monkeypatch):
    monkeypatch.setattr(css, "CHUNK", 3)
    rng = np.random.default_rng(2)
    y = simulated(rng, 700, 0.5, 0.3, 0.7, -0.6)
    gap = simulated(rng, 640, 0.2, 0.3, 0.4, 0.2)
    gap[200:205] = np.nan
    grid = [SPEC, dict(p=0, d=1, q=2, sp=0, sd=0, sq=1, order_id=1), dict(p=2, d=0, q=0, sp=0, sd=0, sq=0, order_id=2)]
    df = table(spark, {"a": y, "b": gap, "c": y[:40]})
    whole = {(r["key"], r["order_id"]): r for r in css.conditional_fits(df, ["key"], ["t"], "y", grid, 12, trend="c", most_steps=4, block_rows=1000).collect()}
    cut = {(r["key"], r["order_id"]): r for r in css.conditional_fits(df, ["key"], ["t"], "y", grid, 12, trend="c", most_steps=4, block_rows=50, long=long).collect()}
    assert set(whole) == set(cut) and len(whole) == 9
    for at, r in whole.items():
        assert (r["status"], r["n"]) == (cut[at]["status"], cut[at]["n"])
        if r["status"] != "too short":
            assert abs(r["sse"] - cut[at]["sse"]) < 1e-6 * r["sse"]
            assert np.allclose(r["coef"], cut[at]["coef"], atol=1e-4)


def test_no_sse_is_above_that_of_the_regression_on_lags(spark):
    rng = np.random.default_rng(3)
    series = {f"s{i}": simulated(rng, n, 0.4, 0.2, 0.3, 0.3) for i, n in enumerate((30, 60, 90, 140, 400))}
    series["flat"], series["one"] = np.full(80, 3.0), np.array([1.0])
    grid = A.order_grid(range(3), range(2), range(2), range(2), range(2), range(2))
    got = css.conditional_fits(table(spark, series), ["key"], ["t"], "y", grid, 12, most_steps=20).collect()
    assert len(got) == len(series) * len(grid)
    by = {}
    for r in got:
        by.setdefault(r["key"], []).append(r)
        if r["status"] == "ok":
            assert r["sse"] <= r["start_sse"] * (1 + 1e-12)
    assert {r["status"] for r in by["one"]} == {"too short"}
    assert len({r["status"] for r in by["flat"]} - {"too short"}) >= 1
    assert sum(r["status"] == "ok" for r in by["s4"]) >= 0.75 * len(grid)
    # one sample for all orders of a series
    assert len({r["n"] for r in by["s4"]}) == 1


def test_autoregression_has_its_closed_form(spark):
    rng = np.random.default_rng(4)
    y = np.zeros(500)
    for t in range(1, 500):
        y[t] = 0.6 * y[t - 1] + rng.normal()
    r = css.conditional_fits(table(spark, {"a": y}), ["key"], ["t"], "y", A.order_grid([1], [0], [0])).first()
    assert abs(r["coef"][0] - (y[1:] @ y[:-1]) / (y[:-1] @ y[:-1])) < 1e-8
    with pytest.raises(ValueError, match="block"):
        css.conditional_fits(table(spark, {"a": y}), ["key"], ["t"], "y", [SPEC], 12, block_rows=10)
    assert css.conditional_fits(table(spark, {"a": y}).filter(F.col("t") < 0), ["key"], ["t"], "y", [SPEC]).count() == 0
