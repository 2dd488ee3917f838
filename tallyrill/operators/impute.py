"""Missing data: constants, means, modes, group values, and chained regressions."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.operators.ordered import exact_quantiles
from tallyrill.operators.profile import group_mode, modes
from tallyrill.operators.relational import join_back
from tallyrill.session import stage


def fill_constant(df: DataFrame, value, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(value, subset=list(columns))


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column means, as doubles: filling a whole-number column would cut the mean."""
    means = df.select(*columns).agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means.getField(c)) for c in columns})


def numeric_mode_imputer(columns: Sequence[str]) -> Imputer:
    """Estimator that fills numeric columns with their mode, the smallest on ties."""
    return Imputer(strategy="mode", inputCols=list(columns), outputCols=list(columns))


class _CategoryParams(HasInputCols):
    strategy = Param(Params._dummy(), "strategy", "mode or constant", TypeConverters.toString)
    filler = Param(Params._dummy(), "filler", "text for the constant strategy", TypeConverters.toString)


class CategoryImputer(Estimator, _CategoryParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fill missing categories with each column's mode, or with one constant."""

    @keyword_only
    def __init__(self, *, inputCols=None, strategy="mode", filler="NA"):
        super().__init__()
        self._setDefault(strategy="mode", filler="NA")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CategoryImputerModel:
        columns = self.getInputCols()
        if self.getOrDefault(self.strategy) == "mode":
            # one row per column
            fills = {r["column"]: r["mode"] for r in modes(dataset, columns).collect()}
        else:
            fills = {c: self.getOrDefault(self.filler) for c in columns}
        return CategoryImputerModel(inputCols=columns, fills=json.dumps(fills))


class CategoryImputerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    fills = Param(Params._dummy(), "fills", "JSON object of column to fill value", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, fills=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = json.loads(self.getOrDefault(self.fills))
        return dataset.na.fill({c: fills[c] for c in self.getInputCols() if c in fills})


def fill_blank_by_frequent(df: DataFrame, column: str, among: Column) -> DataFrame:
    """Blank text becomes the most frequent value among the rows of a condition."""
    best = group_mode(df.filter(among & (F.col(column) != "")), [], column, "__m").select("__m").scalar()
    return df.withColumn(column, F.when(F.col(column) == "", best).otherwise(F.col(column)))


def fill_group_median(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Null becomes the exact median of the row's group."""
    med = exact_quantiles(df, keys, column, [0.5]).select(*keys, F.col("value").alias("__med"))
    filled = join_back(df, med, keys)
    return filled.withColumn(column, F.coalesce(F.col(column).cast("double"), "__med")).drop("__med")


def fill_chained(
    df: DataFrame,
    columns: Sequence[str],
    helpers: Sequence[str] = (),
    rounds: int = 2,
    method: str = "linear",
    seed: int = 7,
) -> DataFrame:
    """Chained regressions: each column with gaps is predicted from all the others, in turn.

    Starts from column means. A round fits one regression per column on its observed rows and renews
    the missing cells; the table is written once per column, so no fit runs earlier predictions again.
    One completed table results, not several draws.
    """
    gaps = {c: f"__gap_{c}" for c in columns}
    work = df.withColumns({g: F.col(c).isNull() for c, g in gaps.items()})
    work = fill_mean(work, columns)
    for _ in range(rounds):
        for c in columns:
            inputs = [x for x in [*columns, *helpers] if x != c]
            shaped = VectorAssembler(inputCols=inputs, outputCol="__x", handleInvalid="error").transform(work)
            if method == "linear":
                learner = LinearRegression(featuresCol="__x", labelCol=c, predictionCol="__p", solver="normal")
            else:
                learner = RandomForestRegressor(featuresCol="__x", labelCol=c, predictionCol="__p", numTrees=10, seed=seed)
            model = learner.fit(shaped.filter(~F.col(gaps[c])))
            renewed = F.when(F.col(gaps[c]), F.col("__p")).otherwise(F.col(c))
            work = stage(model.transform(shaped).withColumn(c, renewed).drop("__x", "__p"), "chained")
    return work.drop(*gaps.values())
