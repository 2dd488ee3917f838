"""Bags, out-of-bag error and importance against plain counts and planted columns."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tallyrill.operators import forest


@pytest.fixture(scope="module")
def planted(spark):
    """Two columns decide, the others are noise; one label in ten is wrong."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 6))
    y = ((x[:, 0] + 0.7 * x[:, 3] > 0) ^ (rng.random(3000) < 0.1)).astype(float)
    df = spark.createDataFrame([(i, v.tolist(), float(c)) for i, (v, c) in enumerate(zip(x, y, strict=True))], "id long, v array<double>, label double")
    return df.select("id", array_to_vector("v").alias("features"), "label").repartition(4)


def test_bags_are_poisson_and_repeatable(spark):
    df = spark.range(20_000).withColumn("w", forest.bag_weight("id", 3))
    share = {r["w"]: r["count"] / 20_000 for r in df.groupBy("w").count().collect()}
    for k in range(4):
        assert abs(share[k] - math.exp(-1) / math.factorial(k)) < 0.012
    again = spark.range(20_000).repartition(7).withColumn("w", forest.bag_weight("id", F.lit(3)))
    assert df.exceptAll(again).isEmpty()
    other = spark.range(20_000).withColumn("w", forest.bag_weight("id", 4))
    both = df.join(other.withColumnRenamed("w", "v"), "id")
    assert abs(both.agg(F.corr("w", "v")).first()[0]) < 0.03


def test_error_is_that_of_rows_outside_the_bags(spark, planted):
    parts = planted.withColumn("held", F.col("id") % 4 == 0)
    train, held = parts.filter("NOT held").drop("held"), parts.filter("held").drop("held")
    got = forest.fit_bagged(train, "id", trees=16, depth=5, subset="all", shuffles=0)
    rows, error = got.error("id").first()
    assert rows == 2250 or rows >= 2245  # nearly every row is outside some bag
    # every vote is from a tree that didn't see the row, and all of these vote
    want = train.select("id", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("tree")).filter(forest.bag_weight("id", F.col("tree")) == 0)
    assert got.votes.select("id", "tree").exceptAll(want).isEmpty() and want.exceptAll(got.votes.select("id", "tree")).isEmpty()
    scored = held
    for i, tree in enumerate(got.trees):
        scored = tree.transform(scored).withColumnRenamed("prediction", f"p{i}").drop("rawPrediction", "probability")
    votes = sum(F.col(f"p{i}") for i in range(16))
    outside = scored.agg(F.avg(((votes > 8).cast("double") != F.col("label")).cast("double"))).first()[0]
    assert abs(error - outside) < 0.035 and error < 0.2
    with pytest.raises(ValueError, match="donors"):
        got.importance()


def test_importance_finds_the_columns_that_decide(spark, planted):
    got = forest.fit_bagged(planted, "id", trees=12, depth=5, subset="all", shuffles=2)
    by = {r["feature"]: r for r in got.importance().collect()}
    assert by[0]["importance"] > by[3]["importance"] > 0.05
    assert all(abs(by[i]["importance"]) < 0.01 for i in (1, 2, 4, 5) if i in by)
    names = {r["input"]: r["importance"] for r in forest.named(got.importance(), list("abcdef")).collect()}
    assert names["a"] == by[0]["importance"] and set(names) == set("abcdef")
    # the loss of one tree, by hand
    tree, feature, rows, drop = got.drops.filter("feature = 0").orderBy("tree").first()
    outside = planted.filter(forest.bag_weight("id", tree) == 0)
    assert rows == outside.count() and 0 < drop < rows


def test_donors_are_rows_of_the_table(spark, planted):
    some = planted.filter("id < 200")
    out = forest.with_donors(some, "id", "features", 2, 7).collect()
    own = sorted(tuple(r["features"]) for r in out)
    for i in range(2):
        assert sorted(tuple(r["donors"][i]) for r in out) == own
        assert sum(tuple(r["donors"][i]) == tuple(r["features"]) for r in out) < 10


def test_draws_are_made_once_for_all_trees(spark, planted, monkeypatch):
    made, plain = [], forest.bag_weight
    monkeypatch.setattr(forest, "bag_weight", lambda *a: made.append(a) or plain(*a))
    got = forest.fit_bagged(planted.filter("id < 400"), "id", trees=3, depth=2, subset="all", shuffles=0)
    assert len(made) == 1
    want = planted.filter("id < 400").select("id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("tree")).filter(plain("id", F.col("tree")) == 0)
    assert got.votes.select("id", "tree").exceptAll(want).isEmpty() and want.exceptAll(got.votes.select("id", "tree")).isEmpty()
