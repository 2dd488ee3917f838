"""Wide components against a dense solver; stratified gradient steps against a plain loop."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyrill.operators import strata as SG
from tallyrill.operators.subspace import wide_components


def exact(x):
    c = x - x.mean(0)
    values, axes = np.linalg.eigh(c.T @ c / len(x))
    return values[::-1], axes[:, ::-1]


def test_shares_and_axes_equal_the_exact_ones(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 30)) * np.exp(-np.arange(30) / 6) + 5
    x[rng.random(x.shape) < 0.3] = 0
    rows = [(i, Vectors.dense(v) if i % 3 else Vectors.sparse(30, {j: float(c) for j, c in enumerate(v) if c})) for i, v in enumerate(x)]
    df = spark.createDataFrame([*rows, (999, None)], ["id", "x"]).repartition(5)
    got = wide_components(df, "x", 6, rounds=20)
    values, axes = exact(x)
    np.testing.assert_allclose(got.shares, values[:6] / values.sum(), atol=1e-4)
    assert np.abs(np.abs(np.sum(got.axes[:, :3] * axes[:, :3], axis=0)) - 1).max() < 1e-3
    placed = {r["id"]: r["y"] for r in got.transform(df, "x").where("x IS NOT NULL").select("id", vector_to_array("reduced").alias("y")).collect()}
    want = (x - x.mean(0)) @ got.axes
    assert max(np.abs(np.array(placed[i]) - want[i]).max() for i in range(400)) < 1e-9


def test_ten_thousand_sparse_columns(spark):
    """Three planted directions in sparse rows of 10,000 columns."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        cells = {int(j): float(v) for j, v in zip(rng.integers(0, 10_000, 20), rng.normal(size=20) * 0.1, strict=True)}
        for d, size in enumerate((6.0, 4.0, 2.0)):
            a = rng.normal() * size
            for j in range(5):
                cells[d * 100 + j] = a
        rows.append((i, Vectors.sparse(10_000, cells)))
    df = spark.createDataFrame(rows, ["id", "x"]).repartition(4)
    got = wide_components(df, "x", 3, extra=5, rounds=3)
    x = np.zeros((600, 10_000))
    for i, v in rows:
        x[i, v.indices] = v.values
    s = np.linalg.svd(x - x.mean(0), compute_uv=False)
    total = s @ s
    np.testing.assert_allclose(got.shares, s[:3] ** 2 / total, atol=1e-3)
    assert abs(got.total - total / 600) < 1e-9 * total


def test_no_rows_and_no_spread(spark):
    df = spark.createDataFrame([(1, Vectors.dense([1.0, 2.0])), (2, Vectors.dense([1.0, 2.0]))], ["id", "x"])
    assert wide_components(df.limit(0), "x", 2).axes.size == 0
    assert len(wide_components(df, "x", 2).variances) == 0


def plain(ratings, block_of, order, blocks, p, q, rate, penalty, epochs):
    errors = []
    for _ in range(epochs):
        for turn in range(blocks):
            for b in range(blocks):
                some = sorted((r for r in ratings if block_of["user"][r[0]] == b and block_of["item"][r[1]] == (b + turn) % blocks), key=lambda r: (order[r[:2]], r[0], r[1]))
                for u, i, r in some:
                    a, c = p[u].copy(), q[i].copy()
                    e = 2 * (r - a @ c)
                    p[u], q[i] = a + rate * (e * c - penalty * a), c + rate * (e * a - penalty * c)
        errors.append(sum((r - p[u] @ q[i]) ** 2 + penalty / 2 * (p[u] @ p[u] + q[i] @ q[i]) for u, i, r in ratings))
    return errors


def test_equals_a_plain_loop_over_the_same_strata(spark):
    rng = np.random.default_rng(5)
    ratings = [(int(u), int(i) + 100, float(rng.integers(1, 6))) for u in range(25) for i in rng.choice(18, 7, replace=False)]
    df = spark.createDataFrame(ratings, "userid bigint, itemid bigint, rating double")
    blocks = 3
    got = SG.factorise_by_strata(df, rank=2, blocks=blocks, rate=0.01, penalty=0.02, epochs=4)
    block_of = {k: {r[0]: r[1] for r in df.select(f"{k}id", F.pmod(F.xxhash64(f"{k}id"), F.lit(blocks))).distinct().collect()} for k in ("user", "item")}
    order = {(r[0], r[1]): r[2] for r in df.select("userid", "itemid", F.xxhash64("userid", "itemid", F.lit(7))).collect()}
    p, q = ({r[0]: np.array(r[1]) for r in df.select(F.col(f"{k}id").alias("id")).distinct().select("id", F.array(*[SG.hash_unit([F.lit(k), F.col("id"), F.lit(i)], 7) for i in range(2)])).collect()} for k in ("user", "item"))
    want = plain(ratings, block_of, order, blocks, p, q, 0.01, 0.02, 4)
    np.testing.assert_allclose(got.errors, want, rtol=1e-9)
    for kind, side in (("user", p), ("item", q)):
        for r in got.table.where(F.col("kind") == kind).collect():
            np.testing.assert_allclose(r["v"], side[r["id"]], rtol=1e-9)
    assert all(b < a for a, b in zip(got.errors, got.errors[1:], strict=False)) and got.stopped == "epochs"
    scored = got.score(df).count()
    assert scored == len(ratings)


def test_stop_rule_and_odd_tables(spark):
    exact_one = spark.createDataFrame([(1, 1, 0.25), (None, 1, 3.0), (2, 1, None)], "userid bigint, itemid bigint, rating double")
    got = SG.factorise_by_strata(exact_one, rank=1, blocks=2, rate=0.2, penalty=0.0, epochs=60)
    assert got.stopped == "enough" and got.errors[-1] < 0.001 and (len(got.errors) == 1 or got.errors[-2] >= 0.001)
    assert SG.factorise_by_strata(exact_one.limit(0)).stopped == "no ratings"
    wild = spark.createDataFrame([(u, i, 5.0) for u in range(6) for i in range(6)], "userid bigint, itemid bigint, rating double")
    with pytest.raises(RuntimeError, match="smaller rate"):
        SG.factorise_by_strata(wild, blocks=1, rate=50.0, epochs=20)


def test_waves_share_no_row_and_keep_the_order():
    rng = np.random.default_rng(4)
    users, items, ratings = rng.integers(0, 300, 5000), rng.integers(0, 40, 5000), rng.normal(size=5000)
    p, q = rng.random((300, 3)), rng.random((40, 3))
    found = SG.waves(users, items)
    assert sorted(np.concatenate(found)) == list(range(5000)) and len(found) < 1500
    for at in found:
        assert len(set(users[at])) == len(set(items[at])) == len(at)
    a, b = p.copy(), q.copy()
    for u, i, r in zip(users, items, ratings, strict=True):
        x, e = a[u].copy(), 2.0 * (r - a[u] @ b[i])
        a[u] += 0.01 * (e * b[i] - 0.02 * x)
        b[i] += 0.01 * (e * x - 0.02 * b[i])
    SG.walked(users, items, ratings, p, q, 0.01, 0.02)
    assert np.allclose(a, p, rtol=0, atol=1e-12) and np.allclose(b, q, rtol=0, atol=1e-12)
    assert SG.waves(users[:0], items[:0]) == []
