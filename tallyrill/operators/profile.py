"""Column profiles, frequency tables, correlations and distribution summaries."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.operators.ordered import exact_quantiles
from tallyrill.operators.relational import join_back, long_form


def frequency(df: DataFrame, columns: Sequence[str], drop_null: bool = False, alias: str = "n") -> DataFrame:
    """Rows per combination. ``drop_null`` leaves out rows with a null, as a factor table does."""
    src = df.dropna(how="any", subset=list(columns)) if drop_null else df
    return src.groupBy(*columns).agg(F.count(F.lit(1)).alias(alias))


def shares(df: DataFrame, columns: Sequence[str], alias: str = "share") -> DataFrame:
    """Part of all rows per combination; the total is a scalar, so nothing is gathered."""
    counts = frequency(df, columns)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn(alias, F.col("n") / total)


def column_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null and blank cells of every column, long form, in one aggregate over the table."""
    columns = list(columns or df.columns)
    aggs: list[Column] = []
    for i, c in enumerate(columns):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"__n_{i}"))
        aggs.append(F.count_if(F.col(c).cast("string") == "").alias(f"__b_{i}"))
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"__n_{i}").alias("nulls"), F.col(f"__b_{i}").alias("blanks"))
            for i, c in enumerate(columns)
        ]
    )
    return df.agg(*aggs).select(F.inline(cells))


def value_counts(df: DataFrame, columns: Sequence[str], keep_null: bool = True) -> DataFrame:
    """(column, value, n) for several columns from one scan and one shuffle.

    Repeated values are counted before the shuffle, so a value that fills a third of a
    column costs one row per task.
    """
    cells = long_form(df, columns)
    if not keep_null:
        cells = cells.filter(F.col("value").isNotNull())
    return cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column, null counted as one value."""
    if approximate:
        aggs = [
            (F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in columns
        ]
        one = df.agg(*aggs)
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_distinct")) for c in columns])
        return one.select(F.inline(cells))
    return value_counts(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column, the smallest on ties, nulls left out.

    Values are text here; numbers that need a numeric tie rule go through ``group_mode``.
    """
    counts = value_counts(df, columns, keep_null=False)
    # max over (n, then smallest value): min_by over a struct of negated count
    return counts.groupBy("column").agg(
        F.min(F.struct((-F.col("n")).alias("m"), "value")).alias("best")
    ).select("column", F.col("best.value").alias("mode"), (-F.col("best.m")).alias("n"))


def group_mode(df: DataFrame, keys: Sequence[str], column: str, alias: str = "mode") -> DataFrame:
    """Most frequent value of one column per key, smallest on ties, typed as the column."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("m"), F.col(column).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("__best")).select(*keys, F.col("__best.v").alias(alias))


def missing_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per combination of filled (1) and missing (0) columns."""
    flags = [F.col(c).isNotNull().cast("int").alias(c) for c in columns]
    return df.groupBy(*flags).agg(F.count(F.lit(1)).alias("n"))


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sd, min, max of numeric columns in long form, from one aggregate."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"__c{i}"),
            F.avg(x).alias(f"__m{i}"),
            F.stddev_samp(x).alias(f"__s{i}"),
            F.min(x).alias(f"__l{i}"),
            F.max(x).alias(f"__h{i}"),
        ]
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"__c{i}").alias("count"),
                F.col(f"__m{i}").alias("mean"),
                F.col(f"__s{i}").alias("stddev"),
                F.col(f"__l{i}").alias("min"),
                F.col(f"__h{i}").alias("max"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return df.agg(*aggs).select(F.inline(cells))


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for all pairs over rows complete in every column; null without variance.

    One aggregate of plain sums. Values are taken from those of some one row, so that a
    column far from zero keeps its precision.
    """
    complete = df.dropna(how="any", subset=list(columns))
    origin = complete.select(F.struct(*columns)).limit(1).scalar()
    step = {c: F.col(c).cast("double") - origin.getField(c).cast("double") for c in columns}
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    moved = complete.select(*[step[c].alias(f"__d{i}") for i, c in enumerate(columns)])
    # SQL text here: hundreds of small column calls would take longer than the query
    sums = moved.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.expr(f"sum(__d{i}) AS __s{i}") for i in range(len(columns))],
        *[F.expr(f"sum(__d{i} * __d{j}) AS __p{i}_{j}") for i, j in pairs],
    )

    def spread(i: int, j: int) -> str:
        return f"(__n * __p{i}_{j} - __s{i} * __s{j})"

    cells = [
        f"named_struct('a', {i}, 'b', {j}, 'r', try_divide({spread(i, j)}, sqrt({spread(i, i)}) * sqrt({spread(j, j)})))"
        for i, j in pairs
    ]
    names = F.array(*[F.lit(c) for c in columns])
    return sums.select(F.expr(f"inline(array({', '.join(cells)}))")).select(
        names[F.col("a")].alias("a"), names[F.col("b")].alias("b"), "r"
    )


def line_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line: slope, intercept and r squared."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(
        F.regr_slope(b, a).alias("slope"), F.regr_intercept(b, a).alias("intercept"), F.regr_r2(b, a).alias("r2")
    )


def _bin_of(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin of equal width; the last one is closed on the right, no width means bin 0."""
    raw = F.coalesce(F.floor(F.try_divide(x - lo, hi - lo) * bins), F.lit(0))
    return F.least(raw, F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 25, keys: Sequence[str] = ()) -> DataFrame:
    """Counts in equal-width bins between the smallest and largest value, per key if given."""
    src = df.filter(F.col(column).isNotNull())
    ends = src.groupBy(*keys).agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    if keys:
        placed = join_back(src, ends, keys)
    else:
        span = ends.select(F.struct("__lo", "__hi")).scalar()
        placed = src.withColumns({"__lo": span.getField("__lo"), "__hi": span.getField("__hi")})
    x = F.col(column).cast("double")
    return (
        placed.withColumn("bin", _bin_of(x, F.col("__lo"), F.col("__hi"), bins))
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
        .select(
            *keys,
            "bin",
            (F.col("__lo") + F.col("bin") * (F.col("__hi") - F.col("__lo")) / bins).alias("left"),
            "n",
        )
    )


def binned_trend(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Mean and sd of y in equal-width bins of x: the numbers under a smoothed scatter."""
    src = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    span = src.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    xd = F.col(x).cast("double")
    return (
        src.withColumn("bin", _bin_of(xd, span.getField("lo"), span.getField("hi"), bins))
        .groupBy("bin")
        .agg(F.avg(y).alias("mean_y"), F.stddev_samp(y).alias("sd_y"), F.count(F.lit(1)).alias("n"))
    )


def box_numbers(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Quartiles and whiskers (furthest point within 1.5 box lengths) per key, exact."""
    quart = exact_quantiles(df, keys, column, [0.25, 0.5, 0.75])
    box = quart.groupBy(*keys).agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
    )
    v = F.col(column)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return (
        join_back(df.filter(v.isNotNull()), box, keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(v >= F.col("q1") - reach, v)).alias("low"),
            F.max(F.when(v <= F.col("q3") + reach, v)).alias("high"),
        )
    )
