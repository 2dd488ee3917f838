"""Queries for feature stages, models, tuning, persistence and streaming."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    ClusteringEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import CountVectorizerModel, HashingTF, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import functions as F

from tallyrill.functions import scalars as S
from tallyrill.operators import evaluate as E
from tallyrill.operators import features as FE
from tallyrill.operators import forest as FO
from tallyrill.operators import impute as I
from tallyrill.operators import ledger as G
from tallyrill.operators import models as M
from tallyrill.operators import text as X
from tallyrill.operators.glm import coefficient_table
from tallyrill.operators.splits import random_split
from tallyrill.operators.subspace import wide_components
from tallyrill.plans import standins as D
from tallyrill.plans.mining import COUNTS, lexicon
from tallyrill.plans.registry import query, table
from tallyrill.plans.tables import fresh
from tallyrill.session import owned_path, stage
from tallyrill.streaming import score as ST


# --- feature stages -----------------------------------------------------------------------
CATS = ["v24", "v47", "v79"]


@query(
    "fea01_category_index",
    f"WITH t AS (SELECT * FROM {D.CLAIMS}) SELECT id, "
    + ", ".join(
        f"CAST(CASE WHEN {c} IS NULL THEN (SELECT count(DISTINCT {c}) FROM t) ELSE dense_rank() OVER (ORDER BY {c} NULLS LAST) - 1 END AS DOUBLE) AS {c}_idx"
        for c in CATS
    )
    + " FROM t",
)
def fea01(spark, sf):
    c = D.claims(spark, sf)
    return FE.category_index(CATS).fit(c).transform(c).select("id", *[f"{x}_idx" for x in CATS])


@query(
    "fea02_one_hot",
    f"""SELECT CAST(CASE WHEN v47 IS NULL THEN (SELECT count(DISTINCT v47) FROM {D.CLAIMS}) ELSE
        (SELECT count(DISTINCT x.v47) FROM {D.CLAIMS} x WHERE x.v47 < c.v47) END AS INTEGER) AS slot, count(*) AS n FROM {D.CLAIMS} c GROUP BY v47""",
)
def fea02(spark, sf):
    c = D.claims(spark, sf)
    stages = Pipeline(stages=[FE.category_index(["v47"]), FE.one_hot(["v47_idx"])])
    hot = stages.fit(c).transform(c).select(F.posexplode(vector_to_array("v47_idx_hot")).alias("slot", "x"))
    return hot.groupBy("slot").agg(F.sum("x").cast("bigint").alias("n")).filter("n > 0")


@query(
    "fea03_contrasts",
    f"""SELECT sum(CASE WHEN embarked = 'M' THEN 1 ELSE 0 END)::BIGINT AS m, sum(CASE WHEN embarked = 'F' THEN 1 ELSE 0 END)::BIGINT AS f,
        sum(CASE WHEN embarked = 'B' THEN 1 ELSE 0 END)::BIGINT AS b, sum(CASE WHEN embarked = 'A' THEN 1 ELSE 0 END)::BIGINT AS a,
        count(*) AS n FROM {D.PASSENGERS}""",
)
def fea03(spark, sf):
    """Blank and levels A, B, F, M: four slots, the first level is the base."""
    p = D.passengers(spark, sf).replace("", "(blank)", ["embarked"])
    out = FE.treatment_contrasts("embarked", "x").fit(p).transform(p).select(vector_to_array("x").alias("x"))
    sums = [F.sum(F.col("x")[i]).cast("bigint").alias(n) for i, n in enumerate(("m", "f", "b", "a"))]
    return out.agg(*sums, F.count(F.lit(1)).alias("n"))


@query(
    "fea04_assemble",
    f"SELECT id, v10 AS x0, v12 AS x1, CAST(v14 AS DOUBLE) AS x2 FROM {D.CLAIMS} WHERE v10 IS NOT NULL AND v12 IS NOT NULL",
)
def fea04(spark, sf):
    v = FE.assemble(["v10", "v12", "v14"], invalid="skip").transform(D.claims(spark, sf))
    x = vector_to_array("features")
    return v.select("id", *[x[i].alias(f"x{i}") for i in range(3)])


SCALE_SRC = "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS a, l_extendedprice AS b FROM lineitem)"


def scaled(spark, sf, mode):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    v = FE.assemble(["l_quantity", "l_extendedprice"], "raw").transform(li)
    x = vector_to_array("x")
    out = FE.standardise("raw", "x", mode).fit(v).transform(v)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(x[0], 6).alias("a"), F.round(x[1], 6).alias("b"))


@query(
    "fea05_standardise_sample",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(a / (SELECT stddev_samp(a) FROM {SCALE_SRC}), 6) AS a,
        round(b / (SELECT stddev_samp(b) FROM {SCALE_SRC}), 6) AS b FROM {SCALE_SRC}""",
)
def fea05(spark, sf):
    return scaled(spark, sf, "sample")


@query(
    "fea05_standardise_population",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((a - (SELECT avg(a) FROM {SCALE_SRC})) / (SELECT stddev_pop(a) FROM {SCALE_SRC}), 6) AS a,
        round((b - (SELECT avg(b) FROM {SCALE_SRC})) / (SELECT stddev_pop(b) FROM {SCALE_SRC}), 6) AS b FROM {SCALE_SRC}""",
)
def fea05b(spark, sf):
    return scaled(spark, sf, "population")


def vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("label").cast("double").alias("label"), array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("raw"))


@query("fea06_components")
def fea06(spark, sf):
    """Components for 90 % of the variance: number kept, and the share each explains."""
    v = vectors(spark, sf)
    v = FE.standardise("raw", "x", "population").fit(v).transform(v)
    model, shares = FE.components_for(v, "x", 0.90)
    reduced = model.transform(v).select(vector_to_array("reduced").alias("y"))
    kept = len(model.stages[-1].getIndices())
    spread = reduced.agg(*[F.var_samp(F.col("y")[i]).alias(f"c{i}") for i in range(kept)])
    cells = F.array(*[F.struct(F.lit(i).alias("component"), F.lit(float(shares[i])).alias("share"), F.col(f"c{i}").alias("variance")) for i in range(kept)])
    return spread.select(F.inline(cells))


@query("fea06_wide_components")
def fea06b(spark, sf):
    """Components of the word counts of all texts, hashed to 8,192 columns: the share that each explains."""
    tokens = D.all_texts(spark, sf).select("doc_id", F.coalesce(X.plain_tokens("text"), F.array().cast("array<string>")).alias("tokens"))
    counts = HashingTF(inputCol="tokens", outputCol="x", numFeatures=1 << 13).transform(tokens)
    made = wide_components(stage(counts.select("doc_id", "x"), "wide"), "x", 5, rounds=3)
    return spark.createDataFrame([(i, float(v), float(s)) for i, (v, s) in enumerate(zip(made.variances, made.shares))], "component int, variance double, share double")


@query("fea09_count_vector", f"SELECT term, count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM {COUNTS} GROUP BY 1")
def fea09b(spark, sf):
    """Sparse counts per document, of all terms, summed up by term where they are."""
    counts = X.term_counts(D.all_texts(spark, sf), "doc_id", X.plain_tokens("text"))
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total"))


@query("fea13_column_selector", f"SELECT id, v79, v14 FROM {D.CLAIMS}")
def fea13(spark, sf):
    return FE.ColumnSelector(inputCols=["id", "v79", "v14"]).transform(D.claims(spark, sf))


def claim_rows(spark, sf):
    """Claims without gaps, split by hash of the id."""
    c = I.fill_mean(D.claims(spark, sf), ["v10", "v12"]).na.fill("NA", ["v24", "v47"])
    return random_split(c, "id", 0.8)


TRAIN_SQL = f"(SELECT id, coalesce(v10, (SELECT avg(v10) FROM {D.CLAIMS})) AS v10, {S.hash_unit_sql('id', 45)} < 0.8 AS train FROM {D.CLAIMS})"


@query(
    "fea14_fit_once",
    f"""SELECT id, round((v10 - (SELECT avg(v10) FROM {TRAIN_SQL} WHERE train)) / (SELECT stddev_pop(v10) FROM {TRAIN_SQL} WHERE train), 5) AS x0 FROM {TRAIN_SQL}""",
)
def fea14(spark, sf):
    """Stages fitted on the training part transform both parts with the same codes and scales."""
    rows = claim_rows(spark, sf)
    fitted = FE.mixed_stages(["v10", "v12"], ["v24", "v47"]).fit(rows.filter("split = 'train'"))
    return fitted.transform(rows).select("id", F.round(vector_to_array("features")[0], 5).alias("x0"))


@query("udf01_saved_stages", f"SELECT id, coalesce(v24, 'NA') AS v24, coalesce(v47, 'NA') AS v47 FROM {D.CLAIMS}")
def udf01(spark, sf):
    """Own stages in a fitted chain survive saving and loading."""
    c = D.claims(spark, sf)
    chain = Pipeline(stages=[I.CategoryImputer(inputCols=["v24", "v47"], strategy="constant"), FE.ColumnSelector(inputCols=["id", "v24", "v47"])])
    path = fresh(spark, "stages")
    chain.fit(c).write().overwrite().save(path)
    return PipelineModel.load(path).transform(c)


# --- regression ---------------------------------------------------------------------------
PRICED = f"(SELECT l_quantity AS x, l_extendedprice AS y, {S.hash_unit_sql('l_orderkey', 45)} < 0.7 AS train FROM lineitem)"


def priced(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("label"))
    return FE.assemble(["x"]).transform(random_split(li, "l_orderkey", 0.7))


@query(
    "ml01_linear_regression",
    f"SELECT round(regr_slope(y, x), 4) AS slope, round(regr_intercept(y, x), 3) AS intercept, count(*) AS n FROM {PRICED} WHERE train",
)
def ml01(spark, sf):
    train = priced(spark, sf).filter("split = 'train'")
    m = LinearRegression(solver="normal").fit(train)
    fitted = [F.lit(round(m.coefficients[0], 4)).alias("slope"), F.lit(round(m.intercept, 3)).alias("intercept")]
    return train.agg(F.count(F.lit(1)).alias("n")).select(*fitted, "n")


@query(
    "ml02_rmse_and_r2",
    f"""WITH f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM {PRICED} WHERE train)
        SELECT round(sqrt(avg(power(y - a - b * x, 2))), 3) AS rmse, round(1 - sum(power(y - a - b * x, 2)) / (count(*) * var_pop(y)), 6) AS r2 FROM {PRICED}, f WHERE NOT train""",
)
def ml02(spark, sf):
    rows = priced(spark, sf)
    m = LinearRegression(solver="normal").fit(rows.filter("split = 'train'"))
    gap = F.pow(F.col("label") - F.col("prediction"), 2)
    return m.transform(rows.filter("split = 'test'")).agg(
        F.round(F.sqrt(F.avg(gap)), 3).alias("rmse"),
        F.round(1 - F.sum(gap) / (F.count(F.lit(1)) * F.var_pop("label")), 6).alias("r2"),
    )


# --- classifiers --------------------------------------------------------------------------
def prepared(spark, sf):
    """Claims as feature vectors with label and split, written once for repeated passes."""
    rows = claim_rows(spark, sf).drop("v12")
    stages = FE.mixed_stages(["v10", "v14"], ["v24", "v47"]).fit(rows.filter("split = 'train'"))
    out = stages.transform(rows).withColumn("label", F.col("target").cast("double"))
    return stage(out.select("id", "label", "split", "features"), "claims")


def metric_rows(scored_rows):
    return scored_rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), E.accuracy().alias("accuracy"))


def fit_and_compare(rows, learner):
    """Train and test accuracy of one learner, from one scored pass."""
    return metric_rows(learner.fit(rows.filter("split = 'train'")).transform(rows))


@query("ml03_logistic_regression")
def ml03(spark, sf):
    return fit_and_compare(prepared(spark, sf), LogisticRegression(maxIter=20))


@query(
    "ml03_check_score_equations",
    f"""SELECT CAST(slot AS INTEGER) AS slot, (SELECT count(*) FROM {TRAIN_SQL} WHERE train) AS n, true AS balanced FROM
        (SELECT unnest(range((SELECT 4 + count(DISTINCT v24) + count(DISTINCT v47) +
          max(CASE WHEN v24 IS NULL THEN 1 ELSE 0 END) + max(CASE WHEN v47 IS NULL THEN 1 ELSE 0 END) FROM {D.CLAIMS}))) AS slot)""",
)
def ml03b(spark, sf):
    """At the optimum of the plain model the errors sum to nothing over each feature."""
    train = prepared(spark, sf).filter("split = 'train'")
    fitted = LogisticRegression(maxIter=500, tol=1e-12).fit(train).transform(train)
    gap = vector_to_array("probability")[1] - F.col("label")
    each = fitted.select(F.posexplode(F.transform(vector_to_array("features"), lambda x: x * gap)).alias("slot", "g"))
    return each.groupBy("slot").agg(F.count(F.lit(1)).alias("n"), (F.abs(F.avg("g")) < 1e-4).alias("balanced"))


@query("ml04_binomial_coefficients")
def ml04(spark, sf):
    """Coefficient table: estimate, standard error, t value and p value."""
    rows = prepared(spark, sf)
    shaped = rows.select("id", "label", F.expr("1").alias("w"), vector_to_array("features").alias("x"))
    few = FE.assemble(["a", "b"]).transform(shaped.select("label", F.col("x")[0].alias("a"), F.col("x")[1].alias("b")))
    m = GeneralizedLinearRegression(family="binomial", link="logit", maxIter=25).fit(few)
    s = m.summary
    values = zip(["a", "b", "intercept"], [*m.coefficients, m.intercept], s.coefficientStandardErrors, s.tValues, s.pValues)
    table_rows = [tuple([n, *map(float, v)]) for n, *v in values]
    return spark.createDataFrame(table_rows, "term string, estimate double, std_error double, t_value double, p_value double")


@query("ml04_whole_formula")
def ml04b(spark, sf):
    """Outcome by age, fare, company, class, sex and port: every contrast with its error, deviance and AIC."""
    p = D.passengers(spark, sf).filter(F.col("survived").isNotNull())
    return coefficient_table(p, "survived", ["age", "fare", "sibsp"], ["pclass", "sex", "embarked"])


@query(
    "ml04_check_factor",
    f"""WITH g AS (SELECT CAST(pclass AS VARCHAR) AS f, sum(survived) AS a, count(*) - sum(survived) AS b FROM {D.PASSENGERS} WHERE survived IS NOT NULL AND pclass IS NOT NULL GROUP BY 1),
        z AS (SELECT * FROM g ORDER BY f LIMIT 1), d AS (SELECT -2 * sum(a * ln(a / (a + b)) + b * ln(b / (a + b))) AS deviance, count(*) AS k FROM g)
        SELECT CASE WHEN g.f = z.f THEN '(Intercept)' ELSE 'pclass' || g.f END AS term, round(ln(g.a / g.b) - CASE WHEN g.f = z.f THEN 0 ELSE ln(z.a / z.b) END, 6) AS estimate,
        round(sqrt(1.0 / g.a + 1.0 / g.b + CASE WHEN g.f = z.f THEN 0 ELSE 1.0 / z.a + 1.0 / z.b END), 6) AS error, round(deviance, 4) AS deviance, round(deviance + 2 * k, 4) AS aic FROM g, z, d""",
)
def ml04c(spark, sf):
    """One factor alone has a closed form: differences of logits, and errors from the counts."""
    p = D.passengers(spark, sf).filter(F.col("survived").isNotNull())
    made = coefficient_table(p, "survived", factors=["pclass"])
    return made.select("term", *[F.round(c, d).alias(c) for c, d in (("estimate", 6), ("error", 6), ("deviance", 4), ("aic", 4))])


def labelled_vectors(spark, sf):
    v = random_split(vectors(spark, sf), "vec_id", 0.8)
    return stage(v.withColumnRenamed("raw", "features"), "vectors")


@query("ml05_random_forest")
def ml05(spark, sf):
    rows = labelled_vectors(spark, sf)
    m = RandomForestClassifier(numTrees=40, maxDepth=6, seed=500).fit(rows.filter("split = 'train'"))
    imp = [(i, float(v)) for i, v in enumerate(m.featureImportances.toArray())]
    return spark.createDataFrame(imp, "feature int, importance double")


@query(
    "ml05_check_importances",
    "SELECT count(*) AS n, 1.0::DOUBLE AS total, true AS none_negative FROM (SELECT unnest(embedding) FROM (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1))",
)
def ml05b(spark, sf):
    """One importance per feature, none below zero, one in sum."""
    return ml05(spark, sf).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("importance"), 6).alias("total"), F.every(F.col("importance") >= 0).alias("none_negative"))


@query("ml06_permutation_importance")
def ml06(spark, sf):
    p = D.passengers(spark, sf).filter(F.col("survived").isNotNull())
    inputs = ["age", "fare", "sibsp"]
    p = I.fill_mean(p, ["age", "fare"]).select("passenger_id", F.col("survived").cast("double").alias("label"), *inputs)
    rows = stage(p, "forest-rows")
    model = Pipeline(stages=[FE.assemble(inputs), RandomForestClassifier(numTrees=20, maxDepth=5, seed=7)]).fit(rows)
    return M.permutation_importance(rows, "passenger_id", inputs, lambda df: model.transform(df).agg(E.accuracy().alias("a")).first()["a"])


def forest_rows(spark, sf):
    """Known outcomes with three inputs and a column of noise."""
    p = D.passengers(spark, sf).filter(F.col("survived").isNotNull())
    inputs = ["age", "fare", "sibsp", "noise"]
    p = I.fill_mean(p, ["age", "fare"]).withColumn("noise", S.hash_unit("passenger_id", 77))
    rows = FE.assemble(inputs).transform(p.withColumn("sibsp", F.col("sibsp").cast("double")))
    return stage(rows.select("passenger_id", F.col("survived").cast("double").alias("label"), "features"), "forest"), inputs


@query("ml05_out_of_bag_error")
def ml05c(spark, sf):
    """Error by the trees that didn't see a row, beside the share of the rarer class."""
    rows, _ = forest_rows(spark, sf)
    bagged = FO.fit_bagged(rows, "passenger_id", trees=12, depth=4, subset="all", shuffles=0)
    rarer = rows.agg(F.least(F.avg("label"), 1 - F.avg("label")).alias("p")).scalar()
    return bagged.error("passenger_id").withColumn("rarer_class", rarer)


@query(
    "ml05_check_bags",
    f"SELECT tree, {FO.bag_weight_sql('passenger_id', 'tree')} AS weight, count(*) AS n FROM {D.PASSENGERS}, (SELECT CAST(unnest(range(5)) AS INTEGER) AS tree) GROUP BY 1, 2",
)
def ml05d(spark, sf):
    """How many rows are how often in the first bags."""
    each = D.passengers(spark, sf).select("passenger_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("tree"))
    return each.groupBy("tree", FO.bag_weight("passenger_id", F.col("tree")).alias("weight")).agg(F.count(F.lit(1)).alias("n"))


@query("ml06_out_of_bag_importance")
def ml06b(spark, sf):
    """Loss of accuracy outside the bags, per input."""
    rows, inputs = forest_rows(spark, sf)
    return FO.named(FO.fit_bagged(rows, "passenger_id", trees=8, depth=4, subset="all").importance(), inputs)


@query("ml07_boosted_trees")
def ml07(spark, sf):
    return fit_and_compare(prepared(spark, sf), M.boosting(n_estimators=10, learning_rate=0.1, max_depth=3, subsample=0.9))


def text_rows(spark, sf):
    docs = D.texts(spark, sf).withColumn("length", F.length("text").cast("double"))
    return random_split(docs, "doc_id", 0.7)


@query("ml08_naive_bayes_text")
def ml08(spark, sf):
    rows = text_rows(spark, sf)
    stages = FE.text_stages().fit(rows.filter("split = 'train'"))
    out = stage(stages.transform(rows).select("doc_id", "label", "split", "features"), "text")
    scored_rows = NaiveBayes().fit(out.filter("split = 'train'")).transform(out)
    f1 = MulticlassClassificationEvaluator().evaluate(scored_rows.filter("split = 'test'"))
    return metric_rows(scored_rows).withColumn("test_f1", F.lit(float(f1)))


def presence_rows(spark, sf):
    """Presence of 3,000 vocabulary words and the lexicon score as one sparse vector per labelled text."""
    rows = text_rows(spark, sf)
    vocab = stage(X.top_words(X.words(rows.filter("split = 'train'"), "text"), 3000), "words")
    hits = X.vocabulary_hits(rows, "doc_id", "text", vocab, 3000).groupBy("doc_id").agg(F.collect_list("term").alias("found"))
    terms = sorted(r["term"] for r in vocab.collect())
    scores = X.lexicon_scores(rows, "doc_id", "text", stage(lexicon(spark, sf), "lexicon"))
    both = rows.join(hits, "doc_id", "left").join(scores, "doc_id").withColumn("found", F.coalesce("found", F.array().cast("array<string>")))
    marked = CountVectorizerModel.from_vocabulary(terms, "found", "present").setBinary(True).transform(both)
    vector = VectorAssembler(inputCols=["present", "compound"], outputCol="features").transform(marked)
    label = F.when(F.col("class") == "pos", 1.0).otherwise(0.0)
    return stage(vector.select("doc_id", "split", label.alias("label"), "features"), "presence")


@query("ml09_gaussian_bayes_text")
def ml09(spark, sf):
    return fit_and_compare(presence_rows(spark, sf), NaiveBayes(modelType="gaussian"))


@query("ml10_linear_svm_text")
def ml10(spark, sf):
    rows = presence_rows(spark, sf)
    n = rows.filter("split = 'train'").count()
    return fit_and_compare(rows, M.linear_svm(0.01, n, maxIter=30))


@query("ml11_decision_tree_text")
def ml11(spark, sf):
    return fit_and_compare(presence_rows(spark, sf), DecisionTreeClassifier(maxDepth=30, seed=1))


@query("ml12_cluster_sizes")
def ml12(spark, sf):
    """Two and three clusters of the scaled vectors: sizes and the silhouette of each."""
    v = vectors(spark, sf)
    x = stage(FE.standardise("raw", "features").fit(v).transform(v).select("vec_id", "features"), "scaled")
    out = None
    for k in (2, 3):
        grouped = KMeans(k=k, seed=1).fit(x).transform(x)
        quality = ClusteringEvaluator().evaluate(grouped)
        sizes = grouped.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))
        part = sizes.select(F.lit(k).alias("k"), "prediction", "n", F.lit(float(quality)).alias("silhouette"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "ml12_check_centres",
    "SELECT CAST(k AS INTEGER) AS k, (SELECT count(*) FROM embeddings) AS n, true AS centres_are_means FROM (SELECT unnest([2, 3]) AS k)",
)
def ml12b(spark, sf):
    """Every vector is in one cluster, and the centres are the means of their members."""
    v = vectors(spark, sf)
    x = stage(FE.standardise("raw", "features").fit(v).transform(v).select("vec_id", "features"), "scaled")
    out = None
    for k in (2, 3):
        model = KMeans(k=k, seed=1, maxIter=500, tol=0.0).fit(x)
        slots = model.transform(x).select("prediction", F.posexplode(vector_to_array("features")).alias("slot", "v"))
        centres = spark.createDataFrame([(c, i, float(v)) for c, at in enumerate(model.clusterCenters()) for i, v in enumerate(at)], "prediction int, slot int, centre double")
        means = slots.groupBy("prediction", "slot").agg(F.avg("v").alias("mean"), F.count(F.lit(1)).alias("n")).join(centres, ["prediction", "slot"])
        part = means.agg(F.sum(F.when(F.col("slot") == 0, F.col("n"))).alias("n"), F.every(F.abs(F.col("mean") - F.col("centre")) < 1e-6).alias("centres_are_means"))
        part = part.select(F.lit(k).alias("k"), "n", "centres_are_means")
        out = part if out is None else out.unionByName(part)
    return out


@query("ml14_grid_cross_validation")
def ml14(spark, sf):
    rows = M.with_folds(prepared(spark, sf).filter("split = 'train'"), "id", 3)
    rf = RandomForestClassifier(seed=5)
    tuned = M.cross_validate(rows, rf, {"maxDepth": [2, 4], "numTrees": [5, 10]}, BinaryClassificationEvaluator(), 3)
    return M.grid_table(tuned, spark, "forest")


@query("ml14_grid_ledger")
def ml14b(spark, sf):
    """144 points in three folds, each written down as its fit ends, six depths from one tree; a second run finds nothing left to fit."""
    rows = M.with_folds(prepared(spark, sf).filter("split = 'train'"), "id", 3)
    grid = {"maxDepth": [1, 2, 3, 4, 5, 6], "minInstancesPerNode": [1, 2, 4, 8, 16, 32], "maxBins": [8, 16, 32, 64]}
    path = owned_path(spark, "ledger")
    fits = G.run_grid(rows, lambda p: _set(DecisionTreeClassifier(seed=5), p), "tree", grid, MulticlassClassificationEvaluator(metricName="f1"), path, parallelism=8, depths="maxDepth")
    return G.grid_scores(fits).drop("grid")


@query("ml16_cross_validated_score")
def ml16(spark, sf):
    rows = M.with_folds(prepared(spark, sf).filter("split = 'train'"), "id", 3)
    loss = MulticlassClassificationEvaluator(metricName="logLoss")
    plain = M.cross_validate(rows, M.boosting(n_estimators=5, max_depth=3), {"stepSize": [0.1]}, loss, 3)
    return M.grid_table(plain, spark, "score", larger_is_better=False)


@query("ml17_stepwise_tuning")
def ml17(spark, sf):
    """First trees and rate, then depth, then a halved rate with doubled trees."""
    rows = stage(M.with_folds(prepared(spark, sf).filter("split = 'train'"), "id", 3), "folds")
    loss = MulticlassClassificationEvaluator(metricName="logLoss")

    def make(**frozen):
        return _set(M.boosting(), frozen)

    steps = [
        ("trees and rate", {"maxIter": [3, 5], "stepSize": [0.1, 0.3]}),
        ("depth", {"maxDepth": [2, 3]}),
    ]
    frozen, log = M.tune_in_steps(rows, make, steps, loss, 3)
    trees, rate = M.halved_rates(frozen["maxIter"], frozen["stepSize"], 1)[-1]
    _, last = M.tune_in_steps(rows, lambda **kw: make(**{**frozen, **kw}), [("halved rate", {"maxIter": [trees], "stepSize": [rate]})], loss, 3)
    return log.unionByName(last)


def _set(learner, params):
    for name, value in params.items():
        learner.set(learner.getParam(name), value)
    return learner


@query("ml18_feed_forward")
def ml18(spark, sf):
    rows = labelled_vectors(spark, sf)
    net = MultilayerPerceptronClassifier(layers=[64, 32, 16, 10], maxIter=40, seed=42)
    return fit_and_compare(rows, net)


@query("ml19_early_stopping")
def ml19(spark, sf):
    rows = labelled_vectors(spark, sf)
    train, held = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    _, log = M.fit_in_rounds(train, held, [64, 16, 10], rounds=6, patience=2)
    return spark.createDataFrame([(r["round"], r["score"]) for r in log], "round int, score double")


@query("ml20_class_probability")
def ml20(spark, sf):
    rows = prepared(spark, sf)
    m = LogisticRegression(maxIter=10).fit(rows.filter("split = 'train'"))
    probs = M.class_probability(m.transform(rows.filter("split = 'test'")), ["predicted_prob_0", "predicted_prob_1"])
    return probs.select("id", "predicted_prob_0", "predicted_prob_1")


@query("ml22_top_1_hit")
def ml22(spark, sf):
    rows = labelled_vectors(spark, sf)
    m = LogisticRegression(maxIter=20).fit(rows.filter("split = 'train'"))
    p = vector_to_array("probability")
    best = F.array_position(p, F.array_max(p)) - 1
    return m.transform(rows).groupBy("split").agg(F.avg((best == F.col("label")).cast("double")).alias("hit_rate"))


@query("snk08_saved_model", f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS different FROM {D.CLAIMS}")
def snk08(spark, sf):
    """Scores of a model before saving and after loading agree on every row."""
    rows = prepared(spark, sf)
    model = Pipeline(stages=[LogisticRegression(maxIter=5)]).fit(rows.filter("split = 'train'"))
    path = fresh(spark, "model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = model.transform(rows).select("id", F.col("prediction").alias("a"))
    b = again.transform(rows).select("id", F.col("prediction").alias("b"))
    return a.join(b, "id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") != F.col("b")).alias("different"))


# --- streaming ----------------------------------------------------------------------------
@query("str01_scored_stream")
def str01(spark, sf):
    """Texts arrive as files, are scored by the fitted stages, and land in a table."""
    rows = text_rows(spark, sf).withColumn("label", F.when(F.col("class") == "pos", 1.0).otherwise(0.0))
    model = Pipeline(stages=[*FE.text_only_stages(), NaiveBayes()]).fit(rows.filter("split = 'train'"))
    inbox, out, marks = fresh(spark, "inbox"), fresh(spark, "scored"), fresh(spark, "marks")
    table(spark, sf, "documents").select("doc_id", "text").write.json(inbox)
    stream = ST.arriving_texts(spark, inbox, "doc_id bigint, text string")
    ST.score_stream(stream, model, out, marks).awaitTermination()
    return spark.read.parquet(out)


@query("str01_check_equals_batch", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS different FROM documents")
def str01b(spark, sf):
    """Every document is scored once in the stream, with the label that the same model gives it in a batch."""
    rows = text_rows(spark, sf).withColumn("label", F.when(F.col("class") == "pos", 1.0).otherwise(0.0))
    model = Pipeline(stages=[*FE.text_only_stages(), NaiveBayes()]).fit(rows.filter("split = 'train'"))
    inbox, out, marks = fresh(spark, "inbox"), fresh(spark, "scored"), fresh(spark, "marks")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    docs.write.json(inbox)
    ST.score_stream(ST.arriving_texts(spark, inbox, "doc_id bigint, text string"), model, out, marks).awaitTermination()
    batch = ST.scored(docs, model).select("doc_id", F.col("prediction").alias("b"))
    both = spark.read.parquet(out).join(batch, "doc_id", "full")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("prediction").eqNullSafe(F.col("b"))).alias("different"))
