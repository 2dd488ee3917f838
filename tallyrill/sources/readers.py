"""Readers. Schemas are declared; inference is for exploration only, as it adds a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrill.operators.relational import nan_to_null, stack_rows


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    columns: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Delimited text. Without a schema types are inferred; without a header names are _c0, _c1."""
    reader = spark.read.options(header=header, sep=sep, **options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return nan_to_null(df.select(*columns) if columns else df)


def read_text_columns(spark: SparkSession, path: str, names: Sequence[str], sep: str = ",") -> DataFrame:
    """Delimited text with a header in which every column stays a string."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return read_csv(spark, path, schema, sep)


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return nan_to_null(reader.json(path))


def read_labelled_json(spark: SparkSession, paths: dict[str, str], schema: T.StructType | str) -> DataFrame:
    """One JSON corpus per label, stacked, with the label as a column."""
    parts = [read_json(spark, p, schema).withColumn("label", F.lit(label)) for label, p in paths.items()]
    return stack_rows(*parts)


def read_series_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, time: str, pattern: str, sep: str = ","
) -> DataFrame:
    """Delimited text whose text column ``time`` becomes a timestamp key."""
    return read_csv(spark, path, schema, sep).withColumn(time, F.try_to_timestamp(time, F.lit(pattern)))


def read_keyed_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """Table plus the names of its feature columns; the key columns are not features."""
    df = read_csv(spark, path, schema)
    return df, [c for c in df.columns if c not in set(keys)]


def read_matching(spark: SparkSession, folder: str, glob: str, pattern: str, fmt: str = "csv", schema=None, **options) -> DataFrame:
    """Files below a folder by glob and by regular expression on the name, with ``file_name``."""
    reader = spark.read.format(fmt).options(**options).option("pathGlobFilter", glob)
    reader = reader.option("recursiveFileLookup", True)
    reader = reader.schema(schema) if schema is not None else reader
    df = reader.load(folder)
    return df.select("*", F.col("_metadata.file_name").alias("file_name")).filter(F.col("file_name").rlike(pattern))
