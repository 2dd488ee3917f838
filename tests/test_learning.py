"""Planted models, brute-force neighbours, stages, tuning, persistence and streaming."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyrill.operators import arima as A
from tallyrill.operators import features as FE
from tallyrill.operators import impute as I
from tallyrill.operators import models as M
from tallyrill.operators import neighbors as N
from tallyrill.operators import recommend as RC
from tallyrill.operators import splits as SP
from tallyrill.streaming import score as ST


def planted(spark, phi=0.6, keys=20, n=500, theta=0.0, d=0):
    rng = np.random.default_rng(11)
    frames = []
    for k in range(keys):
        e, y = rng.standard_normal(n), np.zeros(n)
        for t in range(1, n):
            y[t] = phi * y[t - 1] + e[t] + theta * e[t - 1]
        frames.append(pd.DataFrame({"key": k, "t": range(n), "y": np.cumsum(y) if d else y}))
    return spark.createDataFrame(pd.concat(frames))


def test_planted_autoregression_is_found(spark):
    df = planted(spark)
    grid = A.order_grid(range(3), [0], range(2))
    best = A.best_orders(A.order_search(df, ["key"], ["t"], "y", grid, 1), ["key"], 1).toPandas()
    assert len(best) == 20 and (best["p"] == 1).mean() >= 0.8
    coef = A.order_search(df, ["key"], ["t"], "y", A.order_grid([1], [0], [0])).toPandas()["coef"]
    assert abs(np.mean([c[0] for c in coef]) - 0.6) < 0.05


def test_planted_mixed_model_and_difference(spark):
    df = planted(spark, 0.5, 6, 2000, 0.4, d=1)
    fit = A.order_search(df, ["key"], ["t"], "y", A.order_grid([1], [1], [1])).toPandas()
    c = np.array(fit["coef"].tolist())
    assert abs(c[:, 0].mean() - 0.5) < 0.08 and abs(c[:, 1].mean() - 0.4) < 0.08
    assert fit["ar_ok"].all() and fit["ma_ok"].all()


def test_search_in_blocks_equals_plain_windows(spark):
    df = planted(spark, keys=2, n=300)
    grid = A.order_grid(range(2), range(2), range(2))
    a = A.order_search(df, ["key"], ["t"], "y", grid).toPandas().sort_values(["key", "order_id"])
    b = A.order_search(df, ["key"], ["t"], "y", grid, long=True).toPandas().sort_values(["key", "order_id"])
    np.testing.assert_allclose(a["bic"], b["bic"])


def test_sums_equal_least_squares(spark):
    df = planted(spark, keys=1, n=400)
    y = df.orderBy("t").toPandas()["y"].to_numpy()
    got = A.order_search(df, ["key"], ["t"], "y", A.order_grid([2], [0], [0]), trend="c").first()
    start = 2 + 2  # long lag of the search: largest lag plus two
    x = np.column_stack([np.ones(len(y) - start), y[start - 1 : -1], y[start - 2 : -2]])
    want = np.linalg.lstsq(x, y[start:], rcond=None)[0]
    np.testing.assert_allclose(got["coef"], want, atol=1e-9)


def test_partial_autocorrelation_and_unit_root(spark):
    df = planted(spark, keys=3)
    p = A.pacf(df, ["key"], ["t"], "y", 5).toPandas()
    assert (p[p["lag"] == 0]["pacf"] == 1).all()
    assert (abs(p[p["lag"] == 1]["pacf"] - 0.6) < 0.12).all() and (abs(p[p["lag"] > 2]["pacf"]) < 0.15).all()
    still = A.unit_root(df, ["key"], ["t"], "y").toPandas()
    walk = A.unit_root(planted(spark, 0.0, 3, 500, d=1), ["key"], ["t"], "y").toPandas()
    assert still["stationary"].all() and not walk["stationary"].all()


def test_forecast_of_a_pure_trend_and_season(spark):
    rows = [("k", t, 3.0 * t + [0.0, 5.0, -2.0, 1.0][t % 4]) for t in range(80)]
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(k, t, y + float(e)) for (k, t, y), e in zip(rows, rng.normal(0, 0.01, 80))], "key string, t int, y double")
    out = A.fit_and_predict(df, ["key"], ["t"], "y", {"p": 1, "d": 0, "q": 0, "sd": 1}, 8, 4, trend="c").toPandas()
    ahead = out[out["is_forecast"]].sort_values("step")
    want = [3.0 * t + [0.0, 5.0, -2.0, 1.0][t % 4] for t in range(80, 88)]
    assert list(ahead["step"]) == list(range(81, 89))
    np.testing.assert_allclose(ahead["yhat"], want, atol=0.15)


@pytest.mark.parametrize("block,slice_", [(20_000, 5_000), (15, 7)])
def test_neighbours_against_brute_force(spark, block, slice_):
    rng = np.random.default_rng(3)
    x, q = rng.normal(0, 1, (240, 3)), rng.normal(0, 1.5, (60, 3))
    x[:90] = 0.01 * x[:90]  # a hot corner
    train = spark.createDataFrame([(i, float(i % 3), v.tolist()) for i, v in enumerate(x)], "train_id bigint, label double, v array<double>")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id bigint, v array<double>")
    got = N.nearest(train, asked, 5, block, slice_).toPandas().sort_values(["query_id", "distance"])
    d = np.sqrt(((q[:, None] - x[None]) ** 2).sum(2))
    assert len(got) == 300
    np.testing.assert_array_equal(got["train_id"].to_numpy().reshape(60, 5), np.argsort(d, axis=1, kind="stable")[:, :5])


def test_hashed_neighbours(spark):
    """Planted neighbours are found."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 16))
    q = x[:40] + rng.normal(0, 0.05, (40, 16))
    train = spark.createDataFrame([(i, 0.0, v.tolist()) for i, v in enumerate(x)], "train_id bigint, label double, v array<double>")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id bigint, v array<double>")
    got = {r["query_id"]: r["train_id"] for r in N.nearest_hashed(train, asked, 1, 16, block_rows=50).collect()}
    assert sum(got.get(i) == i for i in range(40)) >= 36


def test_vote_ties(spark):
    n = spark.createDataFrame([(1, 1, 2.0, 0.5), (1, 2, 1.0, 0.7), (2, 3, 2.0, 0.5), (2, 4, 1.0, 0.5)], "query_id int, train_id int, label double, distance double")
    assert {r[0]: r[1] for r in N.vote(n).collect()} == {1: 2.0, 2: 1.0}


def test_splits_are_stable_and_complete(spark):
    df = spark.range(2000).withColumn("label", (F.col("id") < 700).cast("int"))
    a = {r["id"]: r["split"] for r in SP.random_split(df, "id", 0.7).collect()}
    b = {r["id"]: r["split"] for r in SP.random_split(df.repartition(13), "id", 0.7).collect()}
    assert a == b and 1300 < sum(v == "train" for v in a.values()) < 1500
    s = SP.stratified_split(df, "id", "label", 0.8).groupBy("label", "split").count().collect()
    assert {(r[0], r[1]): r[2] for r in s} == {(0, "train"): 1040, (0, "test"): 260, (1, "train"): 560, (1, "test"): 140}
    assert SP.shuffled_head(df, "id", 150).filter("split = 'train'").count() == 150


def test_components_and_scaling(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 1, (300, 2))
    x = np.column_stack([base[:, 0], base[:, 0] * 2 + 0.01 * base[:, 1], base[:, 1]])
    df = FE.assemble(["a", "b", "c"], "raw").transform(spark.createDataFrame(pd.DataFrame(x, columns=list("abc"))))
    scaled = FE.standardise("raw", "x", "population").fit(df).transform(df)
    got = np.array([r[0] for r in scaled.select(vector_to_array("x")).collect()])
    np.testing.assert_allclose(got, (x - x.mean(0)) / x.std(0), atol=1e-9)
    model, shares = FE.components_for(scaled, "x", 0.90)
    assert len(model.stages[-1].getIndices()) == 2 and abs(sum(shares) - 1) < 1e-9


def test_stages_fit_on_train_keep_their_codes(spark):
    train = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (3.0, "b")], "n double, c string")
    other = spark.createDataFrame([(2.0, "b"), (2.0, "new")], "n double, c string")
    fitted = FE.mixed_stages(["n"], ["c"]).fit(train)
    got = [r[0] for r in fitted.transform(other).select(vector_to_array("features")).collect()]
    assert got == [[0.0, 0.0, 1.0, 0.0], [0.0, 0.0, 0.0, 1.0]]


def test_saved_stages(spark, tmp_path):
    df = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "c string")
    chain = Pipeline(stages=[I.CategoryImputer(inputCols=["c"]), FE.ColumnSelector(inputCols=["c"])]).fit(df)
    chain.write().overwrite().save(str(tmp_path / "m"))
    got = PipelineModel.load(str(tmp_path / "m")).transform(df).groupBy("c").count().collect()
    assert {r[0]: r[1] for r in got} == {"x": 3, "y": 1}


def test_chained_fill_recovers_a_line(spark):
    rows = [(float(i), 2.0 * i + 1 if i % 5 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "x double, y double")
    for method in ("linear", "forest"):
        out = I.fill_chained(df, ["y"], ["x"], rounds=1, method=method).toPandas()
        assert out["y"].notna().all()
        if method == "linear":
            np.testing.assert_allclose(out["y"], 2 * out["x"] + 1, atol=1e-6)


def test_factors_of_large_ids(spark):
    ids = 3_000_000_000
    r = spark.createDataFrame([(ids + i, -ids * 3 + j, float(1 + (i * j) % 5)) for i in range(8) for j in range(9) if i or j < 7], "userid bigint, itemid bigint, rating double")
    titles = r.select("itemid", F.lit("t").alias("title")).distinct()
    top = RC.factor_unseen_top(RC.factorise(r, steps=3), r, spark.createDataFrame([(ids,), (ids + 1,), (5,)], "userid bigint"), titles, 3).collect()
    assert {(t["active"], t["itemid"] + ids * 3) for t in top} == {(ids, 7), (ids, 8)}


def test_factor_error_falls(spark):
    rng = np.random.default_rng(6)
    u, v = rng.random((30, 2)) + 0.5, rng.random((20, 2)) + 0.5
    r = spark.createDataFrame([(i, j, float(u[i] @ v[j])) for i in range(30) for j in range(20) if (i + j) % 4], "userid bigint, itemid bigint, rating double")
    errors = []
    for steps in (1, 12):
        scored = RC.factorise(r, 2, 0.001, steps).score(r)
        errors.append(scored.agg(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).first()[0])
    assert errors[1] < errors[0] and errors[1] < 0.01
    titles = spark.createDataFrame([(j, f"t{j}") for j in range(20)], "itemid bigint, title string")
    top = RC.factor_unseen_top(RC.factorise(r), r, spark.createDataFrame([(0,), (1,)], "userid bigint"), titles, 3).collect()
    seen = {(a, b) for a, b, _ in r.collect()}
    assert len(top) == 6 and not {(t["active"], t["itemid"]) for t in top} & seen


def test_factor_blocks_hold_so_many_ratings(spark):
    r = spark.createDataFrame([(i, j, float(1 + (i * j) % 5)) for i in range(60) for j in range(10)], "userid bigint, itemid bigint, rating double")
    for block_rows, blocks in ((30, 20), (600, 10)):
        m = RC.factorise(r, steps=1, block_rows=block_rows).model
        for factors in (m.userFactors, m.itemFactors):
            assert factors.rdd.getNumPartitions() == blocks
        assert m.userFactors.count() == 60 and m.itemFactors.count() == 10
    assert RC.factorise(r, steps=1).model.userFactors.rdd.getNumPartitions() == 10


@pytest.fixture(scope="module")
def two_classes(spark):
    rng = np.random.default_rng(8)
    y = rng.integers(0, 2, 400)
    pdf = pd.DataFrame({"id": range(400), "label": y.astype(float), "a": y + rng.normal(0, 0.4, 400), "b": rng.normal(0, 1, 400)})
    return FE.assemble(["a", "b"]).transform(spark.createDataFrame(pdf)).cache()


def test_tuning_in_steps(spark, two_classes):
    rows = M.with_folds(two_classes, "id", 3)

    def make(**frozen):
        learner = LogisticRegression(maxIter=5)
        for name, value in frozen.items():
            learner.set(learner.getParam(name), value)
        return learner

    steps = [("penalty", {"regParam": [0.0, 5.0]}), ("mix", {"elasticNetParam": [0.0, 1.0]})]
    frozen, log = M.tune_in_steps(rows, make, steps, MulticlassClassificationEvaluator(metricName="logLoss"), 3)
    assert frozen["regParam"] == 0.0 and log.count() == 4
    assert {r["place"] for r in log.filter("gridsearch = 'penalty'").collect()} == {1, 2}
    assert M.halved_rates(100, 0.1, 2) == [(100, 0.1), (200, 0.05), (400, 0.025)]
    with pytest.raises(ValueError):
        M.boosting(reg_alpha=1)


def test_importance_finds_the_useful_input(spark, two_classes):
    model = Pipeline(stages=[FE.assemble(["a", "b"], "x"), LogisticRegression(featuresCol="x")]).fit(two_classes)
    score = lambda df: model.transform(df).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    got = {r[0]: r[1] for r in M.permutation_importance(two_classes.select("id", "label", "a", "b"), "id", ["a", "b"], score).collect()}
    assert got["a"] > 0.2 > abs(got["b"])


def test_rounds_stop_and_resume(spark, two_classes):
    rows = SP.random_split(two_classes, "id", 0.8)
    train, held = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    model, log = M.fit_in_rounds(train, held, [2, 4, 2], rounds=8, patience=1)
    assert 1 <= len(log) <= 8 and model.transform(held).count() == held.count()
    again, more = M.fit_in_rounds(train, held, [2, 4, 2], rounds=1, resume=log[-1]["path"])
    assert len(more) == 1


def test_stream_scores_like_a_table(spark, tmp_path):
    docs = spark.createDataFrame([(i, ("good fine happy " if i % 2 else "bad sad awful ") * (1 + i % 3), float(i % 2)) for i in range(40)], "doc_id bigint, text string, label double")
    ready = docs.withColumn("length", F.length("text").cast("double"))
    model = Pipeline(stages=[*FE.text_only_stages(), NaiveBayes()]).fit(ready)
    inbox = str(tmp_path / "in")
    docs.select("doc_id", "text").repartition(5).write.json(inbox)
    stream = ST.arriving_texts(spark, inbox, "doc_id bigint, text string", 2)
    ST.score_stream(stream, model, str(tmp_path / "out"), str(tmp_path / "marks")).awaitTermination()
    got = {r["doc_id"]: r["sentiment"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["doc_id"]: r["sentiment"] for r in ST.scored(docs, model).collect()}
    assert got == want and len(got) == 40
