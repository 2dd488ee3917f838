"""Writers and schema listings."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def expand_vector(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """One double column per vector slot, named by the caller; the vector is dropped."""
    values = vector_to_array(column)
    return df.withColumns({n: values[i] for i, n in enumerate(names)}).drop(column)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV folder. Vectors have to be expanded first, as text has no form for them."""
    vectors = [f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)]
    if vectors:
        raise ValueError(f"expand vector columns first: {vectors}")
    df.write.mode("overwrite").option("header", header).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.NumericType):
        return "numeric"
    if isinstance(dtype, T.StringType):
        return "string"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    return dtype.typeName()


def schema_listing(df: DataFrame) -> DataFrame:
    """Column, kind and number of filled cells, from one pass over the table."""
    cells = F.array(
        *[
            F.struct(F.lit(f.name).alias("column"), F.lit(kind_of(f.dataType)).alias("kind"), F.col(f"__n_{i}").alias("filled"))
            for i, f in enumerate(df.schema.fields)
        ]
    )
    counts = df.agg(*[F.count(c).alias(f"__n_{i}") for i, c in enumerate(df.columns)])
    return counts.select(F.inline(cells))
