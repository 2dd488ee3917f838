"""Coefficient tables against plain reweighted least squares and closed forms."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrill.operators.glm import coefficient_table


def plain(x, y, family):
    beta = np.zeros(x.shape[1])
    beta[0] = {"binomial": lambda m: math.log(m / (1 - m)), "poisson": math.log, "gaussian": float}[family](y.mean())
    for _ in range(60):
        eta = x @ beta
        mu = {"binomial": 1 / (1 + np.exp(-eta)), "poisson": np.exp(eta), "gaussian": eta}[family]
        w = {"binomial": mu * (1 - mu), "poisson": mu, "gaussian": np.ones(len(y))}[family]
        z = eta + (y - mu) / w
        beta = np.linalg.solve(x.T @ (x * w[:, None]), x.T @ (w * z))
    return beta, np.linalg.inv(x.T @ (x * w[:, None])), mu


@pytest.mark.parametrize("family", ["binomial", "poisson", "gaussian"])
def test_equals_plain_least_squares(spark, family):
    rng = np.random.default_rng(6)
    n = 1500
    a, f, g = rng.normal(50, 10, n).round(1), rng.integers(0, 4, n), rng.integers(0, 2, n)
    eta = 0.05 * (a - 50) + np.array([0.0, 0.5, -0.4, 0.2])[f] + 0.3 * g
    y = {"binomial": lambda: (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(float), "poisson": lambda: rng.poisson(np.exp(eta)).astype(float), "gaussian": lambda: eta + rng.normal(size=n)}[family]()
    rows = [(float(v), float(w), "abcd"[i], bool(j)) for v, w, i, j in zip(y, a, f, g, strict=True)] + [(None, 1.0, "a", True), (1.0, None, "b", True), (0.0, 2.0, None, False)]
    df = spark.createDataFrame(rows, "y double, a double, f string, g boolean").repartition(4)
    got = coefficient_table(df, "y", ["a"], ["f", "g"], family).collect()
    assert [r["term"] for r in got] == ["(Intercept)", "a", "fb", "fc", "fd", "gtrue"]
    x = np.column_stack([np.ones(n), a, f == 1, f == 2, f == 3, g]).astype(float)
    beta, cover, mu = plain(x, y, family)
    np.testing.assert_allclose([r["estimate"] for r in got], beta, rtol=1e-6, atol=1e-7)
    spread = ((y - mu) ** 2).sum() / (n - 6) if family == "gaussian" else 1.0
    np.testing.assert_allclose([r["error"] for r in got], np.sqrt(np.diag(cover) * spread), rtol=1e-6)
    if family == "binomial":
        logs = (y * np.log(mu) + (1 - y) * np.log(1 - mu)).sum()
        assert math.isclose(got[0]["deviance"], -2 * logs, rel_tol=1e-9) and math.isclose(got[0]["aic"], -2 * logs + 12, rel_tol=1e-9)
        m = y.mean()
        assert math.isclose(got[0]["null_deviance"], -2 * n * (m * math.log(m) + (1 - m) * math.log(1 - m)), rel_tol=1e-9)
    if family == "poisson":
        logs = (y * np.log(mu) - mu).sum() - sum(math.lgamma(v + 1) for v in y)
        assert math.isclose(got[0]["aic"], -2 * logs + 12, rel_tol=1e-8)
    assert all(r["n"] == n and 0 <= r["p"] <= 1 for r in got)


def test_terms_that_others_determine_and_errors(spark):
    df = spark.range(200).select((F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 5).cast("double").alias("a"), (F.col("id") % 5).cast("string").alias("f"), F.lit("k").alias("one"))
    got = {r["term"]: r["estimate"] for r in coefficient_table(df, "y", ["a"], ["f", "one"]).collect()}
    assert [t for t, e in got.items() if e is None] == ["f4"] and len(got) == 6
    with pytest.raises(ValueError, match="vary"):
        coefficient_table(df.where("y = 1"), "y", ["a"])
    with pytest.raises(ValueError, match="too few"):
        coefficient_table(df.limit(0), "y", ["a"])
    with pytest.raises(ValueError, match="family"):
        coefficient_table(df, "y", ["a"], family="gamma")
    apart = df.withColumn("a", F.col("y") * 2.0)
    with pytest.raises(RuntimeError, match="settled"):
        coefficient_table(apart, "y", ["a"], most_steps=8)
