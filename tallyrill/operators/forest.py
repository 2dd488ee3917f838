"""Bagged trees with out-of-bag error and out-of-bag importance.

A row's weight in a tree's bag is a Poisson draw by hash of row and tree, so who is outside a bag is known
wherever the rows lie and needs no stored sample. Each tree is fitted on weighted rows and judged only by
those outside its bag.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.functions.scalars import hash_unit, hash_unit_sql
from tallyrill.operators.ordered import with_position
from tallyrill.session import owned_path, stage

#: The chances of at most 0, 1, 2 ... draws of mean one; a row is drawn more often with chance under 1e-12.
CUTS = [sum(math.exp(-1) / math.factorial(k) for k in range(m + 1)) for m in range(15)]


def bag_weight(key: str, tree: int | Column, seed: int = 7) -> Column:
    """How often the row with ``key`` is in the bag of ``tree``: Poisson of mean one, the same on every run."""
    u = hash_unit([key, F.lit(tree) if isinstance(tree, int) else tree], seed)
    # the cuts rise, so a draw is the number of cuts that aren't above it
    return F.size(F.filter(F.array(*map(F.lit, CUTS)), lambda cut: cut <= u)).cast("double")


def bag_weight_sql(key: str, tree: str, seed: int = 7) -> str:
    """The same draw as SQL text."""
    u = hash_unit_sql(f"concat_ws('|', {key}, {tree})", seed)
    return f"CAST(len(list_filter([{', '.join(f'{c!r}::DOUBLE' for c in CUTS)}], lambda c: c <= {u})) AS DOUBLE)"


@dataclass(frozen=True)
class Bagged:
    """Fitted trees with what was learnt outside their bags."""

    trees: list[Model]
    votes: DataFrame  # key, tree, label, prediction: rows outside the tree's bag
    drops: DataFrame | None  # tree, feature, rows, drop: loss of right answers when the feature is shuffled

    def predictions(self, key: str) -> DataFrame:
        """``key``, ``label``, ``prediction`` and ``votes`` of the trees that didn't see the row; ties go to the smaller class.

        A row that is in every bag, one in e ^ -T of them, has none.
        """
        counts = self.votes.groupBy(key, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
        best = F.min(F.struct((-F.col("n")).alias("m"), "prediction"))
        return counts.groupBy(key, "label").agg(best.alias("b"), F.sum("n").alias("votes")).select(key, "label", F.col("b.prediction").alias("prediction"), "votes")

    def error(self, key: str) -> DataFrame:
        """``rows`` that have votes and the share of them that the votes get wrong."""
        wrong = F.avg((F.col("prediction") != F.col("label")).cast("double"))
        return self.predictions(key).agg(F.count(F.lit(1)).alias("rows"), wrong.alias("error"))

    def importance(self) -> DataFrame:
        """``feature``, mean loss of accuracy over all trees, its standard error and their ratio.

        A tree that doesn't use a feature loses nothing. The ratio is null where all trees lose the same.
        """
        if self.drops is None:
            raise ValueError("the trees were fitted without donors for their features")
        share = F.col("drop") / F.col("rows")
        n = len(self.trees)
        sums = self.drops.groupBy("feature").agg(F.sum(share).alias("s"), F.sum(share * share).alias("q"))
        mean = F.col("s") / n
        error = F.sqrt(F.greatest(F.col("q") / n - mean * mean, F.lit(0.0)) / n)
        return sums.select("feature", mean.alias("importance"), error.alias("error"), F.try_divide(mean, error).alias("ratio"))


def with_donors(rows: DataFrame, key: str, features: str, shuffles: int, seed: int) -> DataFrame:
    """``rows`` with ``donors``: the features of ``shuffles`` other rows, each a different order by hash."""
    out = rows
    for i in range(shuffles):
        a = with_position(out.withColumn("__u", hash_unit(key, seed + 100 + i)), [], ["__u", key], "__a", "__n").drop("__u", "__n")
        b = with_position(rows.select(key, features).withColumn("__u", hash_unit(key, seed + 200 + i)), [], ["__u", key], "__a", "__n")
        out = stage(a.join(b.select("__a", vector_to_array(features).alias(f"__d{i}")), "__a").drop("__a"), "donors")
    return out.withColumn("donors", F.array(*[f"__d{i}" for i in range(shuffles)])).drop(*[f"__d{i}" for i in range(shuffles)])


def fit_bagged(
    rows: DataFrame, key: str, features: str = "features", label: str = "label", trees: int = 20, depth: int = 5,
    subset: str = "sqrt", seed: int = 7, shuffles: int = 2, parallelism: int = 4,
) -> Bagged:
    """Trees on Poisson bags of ``rows``, whose ``key`` is unique and whose ``label`` is a class from 0.

    With ``shuffles`` each tree's accuracy outside its bag is taken again with each feature that it uses replaced by that of another row,
    of one of so many orders of all rows; 0 leaves importance out. Trees are fitted ``parallelism`` at a time. What comes to
    the driver is the trees and a number for each tree and feature.
    """
    # all draws of a row are made once; the passes of a fit read them
    bags = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: bag_weight(key, tree, seed).cast("tinyint"))
    base = stage(rows.select(F.col(key), F.col(features).alias("features"), F.col(label).cast("double").alias("label"), bags.alias("__bags")), "bagged")
    given = with_donors(base, key, "features", shuffles, seed) if shuffles else base
    spark, path = rows.sparkSession, owned_path(rows.sparkSession, "votes")

    def one(tree: int) -> tuple[Model, list[tuple]]:
        learner = RandomForestClassifier(numTrees=1, bootstrap=False, subsamplingRate=1.0, maxDepth=depth, featureSubsetStrategy=subset, weightCol="bag", seed=seed + tree)
        weight = F.get("__bags", F.lit(tree))
        model = learner.fit(base.select("features", "label", weight.cast("double").alias("bag")).filter("bag > 0"))
        outside = given.filter(weight == 0)
        # a folder for each tree: fits that run side by side don't share one
        model.transform(outside).select(key, "label", "prediction").write.parquet(f"{path}/tree={tree}")
        used = [int(i) for i in model.featureImportances.indices] if shuffles else []
        if not used:
            return model, []
        own = vector_to_array("features")
        donor = F.col("donors")[tree % shuffles]
        slots = F.explode(F.array(*map(F.lit, [-1, *used]))).alias("feature")
        each = outside.select("label", own.alias("own"), donor.alias("donor"), slots)
        moved = F.when(F.col("feature") < 0, F.col("own")).otherwise(
            F.transform("own", lambda x, i: F.when(i == F.col("feature"), F.get("donor", i)).otherwise(x))
        )
        judged = model.transform(each.select("label", "feature", array_to_vector(moved).alias("features")))
        right = judged.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("prediction") == F.col("label")).cast("long")).alias("right")).collect()
        plain = {r["feature"]: r["right"] for r in right}
        return model, [(tree, r["feature"], r["n"], plain[-1] - r["right"]) for r in right if r["feature"] >= 0]

    with ThreadPoolExecutor(parallelism) as pool:
        done = list(pool.map(one, range(trees)))
    lost = spark.createDataFrame([d for _, some in done for d in some], "tree int, feature int, rows long, drop long") if shuffles else None
    votes = spark.read.parquet(path).select(key, F.col("tree").cast("int").alias("tree"), "label", "prediction")
    return Bagged([m for m, _ in done], votes, lost)


def named(importance: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """``importance`` with the inputs' names; inputs that no tree uses have 0."""
    names = importance.sparkSession.createDataFrame(list(enumerate(inputs)), "feature int, input string")
    return names.join(importance, "feature", "left").select("input", F.coalesce("importance", F.lit(0.0)).alias("importance"), F.coalesce("error", F.lit(0.0)).alias("error"))
