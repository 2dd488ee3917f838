"""Order-dependent work that stays balanced when one key holds most rows.

A window partitioned by a hot key puts that key into one task. Here rows are first cut into
range slices over (keys, order), so a hot key spreads over many slices; a slice then needs
only one number from the slices before it. At most one key can continue from one slice into
the next, so the table of carried numbers has no more rows than there are slices and is safe
to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrill.session import stage

_SLICE = "__slice"
_BLOCK = "__block"
_OWN = "__own"


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    weight: Column | None = None,
    running: str = "running",
    total: str = "total",
) -> DataFrame:
    """Add the running sum of ``weight`` in ``order`` inside each key, and the key's total.

    With no weight this is the 1-based row position and the row count. ``order`` has to be a
    total order: end it with a unique column.
    """
    weight = F.lit(1).cast("long") if weight is None else weight
    order_cols = _cols(order)
    sliced = (
        df.withColumn("__w", weight)
        .repartitionByRange(*(_cols(keys) + order_cols))
        .withColumn(_SLICE, F.spark_partition_id())
    )
    staged = stage(sliced, "slices")
    # one row per key and slice, then only keys that cross a slice border: <= 2 per slice
    sums = staged.groupBy(*keys, _SLICE).agg(F.sum("__w").alias("__s"))
    per_key = Window.partitionBy(*keys)
    before = per_key.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sums.withColumn("__before", F.coalesce(F.sum("__s").over(before), F.col("__s") * 0))
        .withColumn("__all", F.sum("__s").over(per_key))
        .withColumn("__n", F.count(F.lit(1)).over(per_key))
        .filter(F.col("__n") > 1)
        .select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(_SLICE).alias("__cs"), "__before", "__all")
    )
    inside = Window.partitionBy(_SLICE, *keys)
    local = staged.withColumn(
        "__r",
        F.sum("__w").over(inside.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)),
    ).withColumn("__t", F.sum("__w").over(inside))
    cond = F.col(_SLICE) == F.col("__cs")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    joined = local.join(F.broadcast(carried), cond, "left")
    return joined.select(
        *df.columns,
        (F.col("__r") + F.coalesce("__before", F.col("__r") * 0)).alias(running),
        F.coalesce("__all", "__t").alias(total),
    )


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    position: str = "position",
    total: str = "n_rows",
) -> DataFrame:
    """1-based position in a declared order, and the row count of the key."""
    return with_running(df, keys, order, None, position, total)


def blocked(df: DataFrame, position: str, before: int, block: int = 50_000) -> DataFrame:
    """Cut positions into blocks; each block also gets the ``before`` rows ahead of it.

    ``__own`` is false on the copied rows. A window over (keys, block) sees every row it
    needs and never more than ``block + before`` rows.
    """
    own = F.floor((F.col(position) - 1) / F.lit(block))
    last = F.floor((F.col(position) - 1 + F.lit(before)) / F.lit(block))
    return (
        df.withColumn("__b0", own)
        .withColumn(_BLOCK, F.explode(F.sequence(F.col("__b0"), last)))
        .withColumn(_OWN, F.col(_BLOCK) == F.col("__b0"))
        .drop("__b0")
    )


def over_blocks(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    before: int,
    build,
    block: int = 50_000,
) -> DataFrame:
    """Add columns made by ``build(window)`` where the window reaches ``before`` rows back.

    ``build`` gets an ordered window specification and returns a name -> Column mapping.
    """
    spec = Window.partitionBy(*keys, _BLOCK).orderBy(position)
    out = blocked(df, position, before, block).withColumns(build(spec))
    return out.filter(_OWN).drop(_BLOCK, _OWN)


def fill_forward(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    column: str,
    out: str | None = None,
    block: int = 50_000,
) -> DataFrame:
    """Last non-null value up to each row, for keys of any length.

    Inside a block it is a plain window; across blocks the last value of each block is
    carried by a table with one row per key and block.
    """
    out = out or column
    cut = df.withColumn(_BLOCK, F.floor((F.col(position) - 1) / F.lit(block)))
    here = Window.partitionBy(*keys, _BLOCK).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    ends = cut.groupBy(*keys, _BLOCK).agg(
        F.max_by(column, F.when(F.col(column).isNotNull(), F.col(position))).alias("__end")
    )
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        F.col(_BLOCK).alias("__kb"),
        F.last("__end", ignorenulls=True).over(earlier).alias("__carry"),
    ).filter(F.col("__carry").isNotNull())
    cond = F.col(_BLOCK) == F.col("__kb")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    filled = cut.withColumn("__here", F.last(column, ignorenulls=True).over(here)).join(carry, cond, "left")
    keep = [c for c in df.columns if c != out]
    return filled.select(*keep, F.coalesce("__here", "__carry").alias(out))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    probs: Sequence[float],
    prob: str = "prob",
    value: str = "value",
) -> DataFrame:
    """Exact linear-interpolated quantiles, one row per key and probability.

    Equal values are counted before the shuffle; ranks come from range slices, so neither a
    hot key nor a hot value ends in one task. Nulls are left out.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*keys, F.col(column).cast("double").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__c"))
    )
    ranked = with_running(counts, keys, ["__v"], F.col("__c"), "__hi", "__n")
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    hits = (
        ranked.withColumn("__p", F.explode(wanted))
        .withColumn("__h", F.col("__p") * (F.col("__n") - 1))
        .withColumn("__lo_hit", (F.floor("__h") < F.col("__hi")) & (F.floor("__h") >= F.col("__hi") - F.col("__c")))
        .withColumn("__up_hit", (F.ceil("__h") < F.col("__hi")) & (F.ceil("__h") >= F.col("__hi") - F.col("__c")))
        .filter(F.col("__lo_hit") | F.col("__up_hit"))
    )
    ends = hits.groupBy(*keys, F.col("__p").alias(prob)).agg(
        F.max(F.when(F.col("__lo_hit"), F.col("__v"))).alias("__a"),
        F.max(F.when(F.col("__up_hit"), F.col("__v"))).alias("__b"),
        F.max("__h").alias("__h"),
    )
    return ends.select(
        *keys,
        prob,
        (F.col("__a") + (F.col("__b") - F.col("__a")) * (F.col("__h") - F.floor("__h"))).alias(value),
    )
