"""Filters, joins, set operations and reshaping."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def columns_by_type(df: DataFrame, kind: str) -> list[str]:
    """Names of 'numeric', 'string' or 'date' columns, from the schema."""
    kinds = {
        "numeric": (T.NumericType,),
        "string": (T.StringType,),
        "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
    }
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds[kind])]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column; the blank string stays a value."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def share_where(df: DataFrame, predicate: Column, alias: str = "share") -> DataFrame:
    """Per cent of rows passing a predicate, in one pass."""
    return df.agg((F.avg(F.when(predicate, 1.0).otherwise(0.0)) * 100).alias(alias))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join in which a null key matches a null key, keeping one copy of the keys."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in on})
    cond = F.lit(True)
    for k in on:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    if how in ("left_semi", "left_anti"):
        return left.join(renamed, cond, how)
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in on])


def natural_left_join(left: DataFrame, right: DataFrame, null_safe: bool = True) -> DataFrame:
    """Left join on every shared column name, in the order of the left table."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column name")
    if null_safe:
        return null_safe_join(left, right, shared)
    return left.join(right, shared, "left")


def join_back(
    df: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    rows: str | None = None,
    share: float = 1e-4,
) -> DataFrame:
    """Give every row the values of its key, from a table with one row per key; null keys match.

    A per-key table that was aggregated on the join keys keeps their partitioning, and then a hot key
    can not be split by the engine. So a key gets one salt for each ``share`` of all rows that it has:
    its values are repeated per salt, its rows spread over them. Keys of one salt need not be
    named; the table of the others has at most 1 / share rows and is broadcast. ``rows`` names the row
    count of the key in ``per_key``; without it the rows are counted here.
    """
    keys = list(keys)
    sized = per_key.withColumn("__rows", F.col(rows)) if rows else null_safe_join(
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")), per_key, keys, "left"
    )
    total = sized.agg(F.sum("__rows")).scalar()
    salts = F.greatest(F.lit(1), F.ceil(F.col("__rows") / (total * share))).cast("int")
    salted = sized.withColumn("__salts", salts).drop("__rows")
    hot = salted.filter("__salts > 1").select(*keys, "__salts")
    # any salt of a key has the key's values, so which one a row gets doesn't matter
    spread = null_safe_join(df, F.broadcast(hot), keys, "left").withColumn(
        "__salt", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("__salts")).cast("int"), F.lit(0))
    )
    each = salted.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")
    return null_safe_join(spread.drop("__salts"), each, [*keys, "__salt"], "inner").drop("__salt")


def keep_members(df: DataFrame, members: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(members, on, "left_semi")


def drop_members(df: DataFrame, members: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(members, on, "left_anti")


def point_update(df: DataFrame, where: Column, column: str, value) -> DataFrame:
    """Set one column on the rows that meet a condition."""
    return df.withColumn(column, F.when(where, F.lit(value)).otherwise(F.col(column)))


def stack_rows(*tables: DataFrame) -> DataFrame:
    """Union all by column name; columns missing on one side become null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def category_drift(first: DataFrame, second: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Categories that occur on one side only, for several columns.

    Both sides are reduced to distinct (column, value) pairs before they meet.
    """

    def pairs(df: DataFrame) -> DataFrame:
        return long_form(df, list(columns)).filter(F.col("value").isNotNull()).distinct()

    a, b = pairs(first), pairs(second)
    return (
        a.withColumn("__a", F.lit(1))
        .join(b.withColumn("__b", F.lit(1)), ["column", "value"], "full")
        .filter(F.col("__a").isNull() | F.col("__b").isNull())
        .select("column", "value", F.when(F.col("__b").isNull(), "first").otherwise("second").alias("only_in"))
    )


def long_form(df: DataFrame, columns: Sequence[str], kind: str = "string", keep: Sequence[str] = ()) -> DataFrame:
    """(column, value) rows, one per cell; the input is read once."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns]
    )
    return df.select(*keep, F.inline(cells))


def pivot_mean(
    df: DataFrame, rows: Sequence[str], columns: str, values: Sequence, measure: str
) -> DataFrame:
    """Long to wide with the column values given, so that no extra scan is needed."""
    return df.groupBy(*rows).pivot(columns, list(values)).agg(F.avg(measure))


def with_group_size(df: DataFrame, keys: Sequence[str], alias: str = "party") -> DataFrame:
    """Rows sharing a key, on every row: counted first, then joined, so a hot key is split."""
    return join_back(df, df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias)), keys, alias)


def collapse_rare(df: DataFrame, column: str, at_most: int, label: str) -> DataFrame:
    """Replace the values of a column that occur on no more than ``at_most`` rows."""
    sized = with_group_size(df, [column], "__size")
    return sized.withColumn(
        column, F.when(F.col("__size") <= at_most, F.lit(label)).otherwise(F.col(column))
    ).drop("__size")
