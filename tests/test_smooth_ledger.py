"""Local regression against its definition; grids that go on where they were cut off."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyrill.operators import ledger as G
from tallyrill.operators.smooth import local_regression
from tallyrill.session import owned_path


def plain(x, y, knots, share, degree):
    out = []
    for at in [x.min() + (x.max() - x.min()) * i / (knots - 1) for i in range(knots)]:
        far = np.abs(x - at)
        reach = np.sort(far)[min(max(int(len(x) * share), degree + 1), len(x)) - 1]
        w = np.where(far < reach, (1 - (far / reach) ** 3) ** 3, 0.0)
        used = w > 0
        coef = np.polyfit((x - at)[used], y[used], degree, w=np.sqrt(w[used]))
        out.append((at, reach, int(used.sum()), coef[-1]))
    return np.array(out)


@pytest.mark.parametrize("degree", [1, 2])
def test_equals_weighted_least_squares(spark, degree):
    rng = np.random.default_rng(degree)
    x = np.round(rng.gamma(2, 3, 900), 1)  # many equal x
    y = np.sin(x) + rng.normal(size=900) * 0.2
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y, strict=True)] + [(None, 1.0), (2.0, None)], "x double, y double").repartition(5)
    got = np.array([tuple(r)[1:] for r in local_regression(df, "x", "y", 15, 0.4, degree).orderBy("knot").collect()])
    np.testing.assert_allclose(got, plain(x, y, 15, 0.4, degree), rtol=1e-7, atol=1e-7)


def test_parabola_is_found_and_odd_tables(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (3 + F.col("id") * 2 - F.col("id") * F.col("id") * 0.5).alias("y"))
    for r in local_regression(df, "x", "y", 7, 0.5, 2).collect():
        assert abs(r["fit"] - (3 + 2 * r["x"] - 0.5 * r["x"] ** 2)) < 1e-8
    same = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "x double, y double")
    assert {r["fit"] for r in local_regression(same, "x", "y", 3).collect()} == {2.0}
    assert local_regression(same.limit(0), "x", "y").count() == 0
    with pytest.raises(ValueError, match="degree"):
        local_regression(same, "x", "y", degree=3)


def test_a_grid_that_was_cut_off_goes_on(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(240, 3))
    rows = [(i, v.tolist(), float(v[0] > 0), i % 3) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, v array<double>, label double, fold int").select("id", array_to_vector("v").alias("features"), "label", "fold")
    made = []

    def make(point):
        made.append(point)
        return DecisionTreeClassifier(seed=1, **point)

    grid = {"maxDepth": [1, 2, 3], "minInstancesPerNode": [1, 60]}
    score = MulticlassClassificationEvaluator(metricName="accuracy")
    path, other = owned_path(spark, "ledger"), owned_path(spark, "ledger")
    part = G.run_grid(df, make, "tree", grid, score, path, parallelism=3, most=7)
    assert part.count() == 7 == len(made)
    assert G.grid_scores(part).count() == 2  # whole points only
    whole = G.run_grid(df, make, "tree", grid, score, path, parallelism=3)
    assert len(made) == 18 and whole.count() == 18
    assert G.run_grid(df, make, "tree", grid, score, path).count() == 18 and len(made) == 18
    uncut = G.run_grid(df, make, "tree", grid, score, other, parallelism=6)
    assert len(made) == 36
    assert sorted(map(tuple, whole.drop("seconds").collect())) == sorted(map(tuple, uncut.drop("seconds").collect()))
    # another grid in the same ledger has fits of its own, and a fit written twice counts once
    wider = G.run_grid(df, make, "tree", {**grid, "maxBins": [8]}, score, path, parallelism=6)
    assert wider.count() == 18 and len(made) == 54
    uncut.limit(4).write.mode("append").parquet(path)
    assert G.run_grid(df, make, "tree", grid, score, path).count() == 18
    scores = G.grid_scores(whole).collect()
    assert len(scores) == 6 and min(r["place"] for r in scores) == 1
    by = {(r["params"], r["fold"]): r["score"] for r in whole.collect()}
    for r in scores:
        assert abs(r["mean_score"] - np.mean([by[r["params"], f] for f in range(3)])) < 1e-12


def test_depths_of_a_grid_come_from_one_tree(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(600, 4)), 1)
    y = (x[:, 0] * x[:, 1] > 0.2) + (x[:, 2] + rng.normal(size=600) > 1)
    df = spark.createDataFrame([(v.tolist(), float(c), i % 3) for i, (v, c) in enumerate(zip(x, y, strict=True))], "v array<double>, label double, fold int")
    df = df.select(array_to_vector("v").alias("features"), "label", "fold")
    made = []

    def make(point):
        made.append(point)
        return DecisionTreeClassifier(seed=1, **point)

    grid = {"maxDepth": [0, 1, 2, 4, 6], "minInstancesPerNode": [1, 40], "maxBins": [8, 32]}
    score = MulticlassClassificationEvaluator(metricName="f1")
    rows = lambda fits: sorted(map(tuple, fits.drop("seconds").collect()))
    each = G.run_grid(df, make, "tree", grid, score, owned_path(spark, "ledger"), parallelism=8)
    assert len(made) == 60 and len({r["score"] for r in each.collect()}) > 20
    made.clear()
    path = owned_path(spark, "ledger")
    # cut off within the depths of a tree
    assert G.run_grid(df, make, "tree", grid, score, path, parallelism=8, most=20, depths="maxDepth").count() == 20 and len(made) == 12
    assert rows(G.run_grid(df, make, "tree", grid, score, path, parallelism=8, depths="maxDepth")) == rows(each) and len(made) == 24
    with pytest.raises(Exception, match="probability"):
        G.run_grid(df, make, "loss", grid, MulticlassClassificationEvaluator(metricName="logLoss"), owned_path(spark, "ledger"), depths="maxDepth", most=2)
