"""Predictive mean matching against all pairs, and Rubin's rules against their closed form."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrill.operators import matching as MT


def plain(receivers, donors, k):
    out = set()
    for draw, key, at in receivers:
        if at is None:
            continue
        near = sorted((abs(d - at), d, i) for i, d in donors if d is not None)[:k]
        out |= {(draw, key, place, i, d) for place, (_, d, i) in enumerate(near, 1)}
    return out


@pytest.mark.parametrize(("k", "slices"), [(1, 1), (3, 12), (5, 40)])
def test_donors_are_those_of_all_pairs(spark, shuffles, k, slices):
    shuffles(slices)
    rng = np.random.default_rng(k)
    big = 1 << 60  # ids that a double would not hold
    donors = [(big + i, round(float(v), 2)) for i, v in enumerate(rng.normal(size=150))] + [(big + 900 + i, 0.5) for i in range(60)] + [(5, None)]
    receivers = [(i % 3, big + 1 + i, round(float(v), 2)) for i, v in enumerate(rng.normal(size=90) * 2)] + [(0, 7, None), (1, 8, 99.0), (1, 9, 0.5)]
    a = spark.createDataFrame(receivers, "draw int, receiver long, at double")
    b = spark.createDataFrame(donors, "donor long, at double")
    got = {tuple(r) for r in MT.nearest_donors(a, b, k).select("draw", "receiver", "place", "donor", "near").collect()}
    assert got == plain(receivers, donors, k)


def test_few_donors(spark):
    a = spark.createDataFrame([(0, "x", 1.0), (0, "y", 5.0)], "draw int, receiver string, at double")
    b = spark.createDataFrame([("p", 2.0)], "donor string, at double")
    assert {tuple(r) for r in MT.nearest_donors(a, b, 4).collect()} == {(0, "x", 1, "p", 2.0), (0, "y", 1, "p", 2.0)}
    assert MT.nearest_donors(a, b.limit(0), 4).count() == 0
    assert MT.nearest_donors(a.limit(0), b, 4).count() == 0


@pytest.fixture(scope="module")
def gaps(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=800)
    y = 2 * x + rng.normal(size=800) * 0.5 + 10
    rows = [(i, None if rng.random() < 0.3 else float(b), None if i % 50 == 0 else float(a)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id long, y double, x double").repartition(4), rows


def test_draws_are_observed_values_and_repeatable(spark, gaps):
    df, rows = gaps
    observed = {i: y for i, y, _ in rows if y is not None}
    missing = [i for i, y, _ in rows if y is None]
    drawn = [tuple(r) for r in MT.matched_draws(df, "id", "y", ["x"], draws=4, donors=5).collect()]
    assert sorted((d, i) for d, i, *_ in drawn) == sorted((d, i) for d in range(5) for i in missing)
    assert all(observed[donor] == value for _, _, donor, value in drawn)
    again = [tuple(r) for r in MT.matched_draws(df.repartition(7), "id", "y", ["x"], draws=4, donors=5).collect()]
    assert sorted(drawn) == sorted(again)
    of = {d: dict((i, v) for e, i, _, v in drawn if e == d) for d in range(5)}
    assert all(of[a] != of[b] for a in range(1, 5) for b in range(a))
    # the true slope is there in every completed table
    tables = MT.completed(df, "id", "y", MT.matched_draws(df, "id", "y", ["x"], draws=4)).where("x IS NOT NULL")
    for r in tables.groupBy("draw").agg(F.regr_slope("y", "x").alias("b"), F.count("y").alias("n")).collect():
        assert abs(r["b"] - 2) < 0.1 and r["n"] == sum(x is not None for *_, x in rows)
    assert MT.matched_draws(df.where("y IS NOT NULL"), "id", "y", ["x"]).count() == 0
    with pytest.raises(ValueError, match="no observed row"):
        MT.matched_draws(df.where("y IS NULL"), "id", "y", ["x"])


def test_rubins_rules(spark):
    q, u = [1.0, 1.4, 0.9, 1.3], [0.2, 0.25, 0.22, 0.19]
    df = spark.createDataFrame([("a", i, a, b) for i, (a, b) in enumerate(zip(q, u, strict=True))] + [("b", 0, 1.0, 0.5), ("c", 0, 1.0, 0.5), ("c", 1, 1.0, 0.7)], "name string, draw int, estimate double, variance double")
    got = {r["name"]: r for r in MT.pooled(df, ["name"]).collect()}
    within, between = np.mean(u), np.var(q, ddof=1)
    total = within + 1.25 * between
    assert math.isclose(got["a"]["estimate"], np.mean(q)) and math.isclose(got["a"]["total"], total)
    assert math.isclose(got["a"]["degrees"], 3 * (1 + within / (1.25 * between)) ** 2)
    assert got["b"]["between"] is None and got["b"]["total"] is None
    assert math.isclose(got["c"]["total"], 0.6) and got["c"]["degrees"] is None


def test_pooled_mean_of_all_draws_against_a_closed_form(spark):
    """All donors are equal to their receivers' predictions, so draws can't differ: no variance between."""
    rows = [(i, float(i % 4) if i % 3 else None, float(i % 4)) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, y double, x double")
    tables = MT.completed(df, "id", "y", MT.matched_draws(df, "id", "y", ["x"], draws=3, donors=1).where("draw > 0"))
    each = tables.groupBy("draw").agg(F.avg("y").alias("estimate"), (F.var_samp("y") / F.count("y")).alias("variance"))
    r = MT.pooled(each).first()
    x = np.array([float(i % 4) for i in range(240)])
    assert math.isclose(r["estimate"], 1.5) and r["between"] < 1e-20 and math.isclose(r["total"], x.var(ddof=1) / 240)
