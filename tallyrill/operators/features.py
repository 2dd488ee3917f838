"""Feature stages: factories over Spark's own stages, and the few that Spark lacks."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    IDF,
    PCA,
    CountVectorizer,
    ElementwiseProduct,
    OneHotEncoder,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrill.operators.text import STOP_SIGNS, STOP_WORDS


class ColumnSelector(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Keep the named columns only."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(*self.getInputCols())


class PopulationScaler(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Centre and divide by the population sd (divisor n); a constant slot becomes 0."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        """The sample form, then every slot times the root of n / (n - 1)."""
        sample = f"__{self.getOutputCol()}"
        scaler = StandardScaler(inputCol=self.getInputCol(), outputCol=sample, withMean=True, withStd=True).fit(dataset)
        n = dataset.count()
        factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
        scale = ElementwiseProduct(scalingVec=Vectors.dense([factor] * len(scaler.mean)), inputCol=sample, outputCol=self.getOutputCol())
        return PipelineModel(stages=[scaler, scale])


def category_index(columns: Sequence[str], suffix: str = "_idx", by: str = "alphabetAsc") -> StringIndexer:
    """Sorted category codes from 0; unseen and missing values share one further code."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[c + suffix for c in columns], stringOrderType=by, handleInvalid="keep"
    )


def one_hot(columns: Sequence[str], suffix: str = "_hot") -> OneHotEncoder:
    """One slot per code, none dropped."""
    return OneHotEncoder(inputCols=list(columns), outputCols=[c + suffix for c in columns], dropLast=False)


def treatment_contrasts(column: str, out: str) -> Pipeline:
    """One slot per level but the first in sorted order; complete rows only."""
    index = StringIndexer(inputCol=column, outputCol=f"__{column}", stringOrderType="alphabetDesc", handleInvalid="skip")
    return Pipeline(stages=[index, OneHotEncoder(inputCol=f"__{column}", outputCol=out, dropLast=True)])


def assemble(columns: Sequence[str], out: str = "features", invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=invalid)


def standardise(column: str, out: str, mode: str = "sample"):
    """'sample': divide by the sample sd, no centring. 'population': centre, population sd."""
    if mode == "sample":
        return StandardScaler(inputCol=column, outputCol=out, withMean=False, withStd=True)
    return PopulationScaler(inputCol=column, outputCol=out)


def mixed_stages(numeric: Sequence[str], categories: Sequence[str], out: str = "features") -> Pipeline:
    """Scaled numbers and one-hot categories in one vector; fit it once, on the training part."""
    index = category_index(categories)
    hot = one_hot([c + "_idx" for c in categories])
    return Pipeline(
        stages=[
            index,
            hot,
            assemble(numeric, "__numbers"),
            PopulationScaler(inputCol="__numbers", outputCol="__scaled"),
            assemble(["__scaled", *[c + "_idx_hot" for c in categories]], out),
        ]
    )


def components_for(df: DataFrame, column: str, share: float = 0.90, out: str = "reduced", limit: int | None = None):
    """Principal components that together explain ``share`` of the variance.

    Returns a model that gives that many components, and the explained shares of all. The vector has to
    be centred already; the work on the driver is of the size width x width.
    """
    width = len(df.select(column).first()[0])
    whole = f"__{out}"
    model = PCA(k=min(width, limit or width), inputCol=column, outputCol=whole).fit(df)
    shares = list(model.explainedVariance.toArray())
    keep = min(int(np.searchsorted(np.cumsum(shares), share)) + 1, len(shares))
    first = VectorSlicer(inputCol=whole, outputCol=out, indices=list(range(keep)))
    return PipelineModel(stages=[model, first]), shares


def text_stages(text: str = "text", label: str = "class", length: str = "length", vocab_size: int = 1 << 18) -> Pipeline:
    """Label code, tokens, stop words, counts, weights, and the text length in one vector."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep"),
            *text_only_stages(text, length, vocab_size),
        ]
    )


def text_only_stages(text: str = "text", length: str = "length", vocab_size: int = 1 << 18) -> list:
    return [
        Tokenizer(inputCol=text, outputCol="__tokens"),
        StopWordsRemover(inputCol="__tokens", outputCol="__kept", stopWords=[*STOP_WORDS, *STOP_SIGNS]),
        CountVectorizer(inputCol="__kept", outputCol="__counts", vocabSize=vocab_size),
        IDF(inputCol="__counts", outputCol="__weights"),
        VectorAssembler(inputCols=["__weights", length], outputCol="features"),
    ]
