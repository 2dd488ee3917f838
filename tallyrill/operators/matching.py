"""Several imputations by predictive mean matching, and Rubin's pooling of what they give.

A missing cell takes the value of an observed row whose prediction is near its own, so imputed values are
always observed ones. Donors and receivers lie in one order of predictions, cut into range slices; a slice
also gets the nearest donors beyond its borders, so no donor is missed and no task sees all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrill.functions.scalars import hash_unit
from tallyrill.operators import arima as A
from tallyrill.operators.impute import fill_mean
from tallyrill.session import stage

PLACES = 9  # decimals of a prediction: which donor is near must not hang on the order of summation


def _lenders(donors_in: dict[int, int], slices: list[int], most: int) -> list[tuple[int, int]]:
    """(from, to): the slices beside each one that together hold ``most`` donors, on either side."""
    pairs, have = [], sorted(donors_in)
    for to in slices:
        for side in ([s for s in reversed(have) if s < to], [s for s in have if s > to]):
            found = 0
            for near in side:
                pairs.append((near, to))
                found += donors_in[near]
                if found >= most:
                    break
    return pairs


def nearest_donors(receivers: DataFrame, donors: DataFrame, k: int) -> DataFrame:
    """(draw, receiver, place, donor, near): for each receiver the ``k`` donors whose ``at`` is nearest to its own.

    ``receivers`` has (draw, receiver, at), the first two a unique key; ``donors`` (donor, at), at a number. Nearest first,
    ties by ``at``, then by donor; fewer come where there are fewer. Rows with a null ``at`` neither give nor receive.
    """
    spark, kinds = donors.sparkSession, (receivers.schema["receiver"].dataType, donors.schema["donor"].dataType)
    # of equal predictions only the first k donors can be chosen
    first = Window.partitionBy("at").orderBy("donor")
    few = donors.where("at IS NOT NULL").withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= k)
    place = F.col("at").cast("double").alias("at")
    given = few.select(F.lit(True).alias("gives"), F.lit(-1).alias("draw"), F.lit("0").cast(kinds[0]).alias("receiver"), "donor", place)
    asked = receivers.where("at IS NOT NULL").select(F.lit(False).alias("gives"), F.col("draw").cast("int").alias("draw"), "receiver", F.lit("0").cast(kinds[1]).alias("donor"), place)
    sliced = asked.unionByName(given).repartitionByRange("at", "gives", "donor", "draw", "receiver").withColumn("slice", F.spark_partition_id())
    rows = stage(sliced, "matched")
    # at either end of a slice: k values of at most k donors each
    most = k * k
    own = rows.where("gives")
    ends = None
    for order in ((F.col("at"), F.col("donor")), (F.desc("at"), F.desc("donor"))):
        side = own.withColumn("__r", F.row_number().over(Window.partitionBy("slice").orderBy(*order))).where(F.col("__r") <= most).drop("__r")
        ends = side if ends is None else ends.unionByName(side)
    ends = stage(ends.distinct(), "edges")
    # a number for each slice
    sizes = {r["slice"]: min(r["count"], most) for r in ends.groupBy("slice").count().collect()}
    wanted = sorted(r["slice"] for r in rows.where("NOT gives").select("slice").distinct().collect())
    pairs = spark.createDataFrame(_lenders(sizes, wanted, most), "slice int, to int")
    lent = ends.join(F.broadcast(pairs), "slice").drop("slice").withColumnRenamed("to", "slice")

    def matched(part: pd.DataFrame) -> pd.DataFrame:
        have = part[part["gives"]].sort_values(["at", "donor"])
        want = part[~part["gives"]]
        at, ids, own_at = have["at"].to_numpy(), have["donor"].to_numpy(), want["at"].to_numpy()
        names, keys = ["draw", "receiver", "place", "donor", "near"], want["receiver"].to_numpy()
        if not len(want) or not len(have):
            return pd.DataFrame(dict(zip(names, [want["draw"].to_numpy()[:0], keys[:0], np.zeros(0, int), ids[:0], at[:0]], strict=True)))
        out = []
        for some in range(0, len(want), 20_000):
            here = own_at[some : some + 20_000]
            # the first at or above, and up to k values below
            places = np.searchsorted(at, here, side="left")[:, None] + np.arange(-most, k)[None, :]
            there = (places >= 0) & (places < len(at))
            places = np.clip(places, 0, len(at) - 1)
            far = np.where(there, np.abs(at[places] - here[:, None]), np.inf)
            order = np.lexsort((places, far), axis=-1)[:, :k]
            chosen, kept = np.take_along_axis(places, order, 1), np.take_along_axis(there, order, 1)
            r, c = np.nonzero(kept)
            columns = [want["draw"].to_numpy()[some:][r], keys[some:][r], c + 1, ids[chosen[r, c]], at[chosen[r, c]]]
            out.append(pd.DataFrame(dict(zip(names, columns, strict=True))))
        return pd.concat(out)

    kind = f"draw int, receiver {kinds[0].simpleString()}, place int, donor {kinds[1].simpleString()}, near double"
    return rows.unionByName(lent.select(*rows.columns)).groupBy("slice").applyInPandas(matched, kind)


def _regression(observed: DataFrame, column: str, inputs: Sequence[str]) -> tuple[np.ndarray, float, int, np.ndarray]:
    """Coefficients, error sum, rows and inverse matrix from one pass of sums."""
    columns = [column, "__one", *inputs]
    row = A.sums_of_products(observed.withColumn("__one", F.lit(1.0)), [], columns).first()
    if not row or not row["n"]:
        raise ValueError(f"{column} has no observed row")
    coef, sse, inverse = A._solve(A._square(np.asarray(row["xx"], float)), range(1, len(columns)))
    return coef, max(sse, 0.0), row["n"], inverse


def matched_draws(df: DataFrame, key: str, column: str, helpers: Sequence[str], draws: int = 5, donors: int = 5, seed: int = 7) -> DataFrame:
    """(draw, key, donor, value): for each missing cell of ``column`` an observed value, ``draws`` times.

    Observed rows are predicted by the least-squares coefficients, missing ones by coefficients drawn around them
    (draw 0 has none: the coefficients themselves). One of the ``donors`` nearest observed rows gives its value, by hash of key and
    draw; with one donor it is the nearest. Gaps of the helpers count as their means. ``key`` is unique. Without missing
    cells there are no rows, and a column without observed rows is an error.
    """
    rows = stage(fill_mean(df.select(key, F.col(column).cast("double").alias(column), *helpers), list(helpers)), "to-match")
    inputs = [f"__x{i}" for i in range(len(helpers))]
    means = rows.agg(*[F.avg(c).alias(c) for c in helpers]).first() if helpers else ()
    rows = rows.withColumns({x: F.col(c) - F.lit(float(m or 0.0)) for x, c, m in zip(inputs, helpers, means, strict=True)})
    observed, missing = rows.where(F.col(column).isNotNull()), rows.where(F.col(column).isNull())
    coef, sse, n, inverse = _regression(observed, column, inputs)
    rng = np.random.default_rng(seed)

    def predicted(beta: np.ndarray):
        total = F.lit(float(beta[0]))
        for b, x in zip(beta[1:], inputs, strict=True):
            total = total + F.lit(float(b)) * F.col(x)
        return F.round(total, PLACES)

    root = np.linalg.cholesky(inverse + 1e-300 * np.eye(len(inverse))) if sse > 0 else np.zeros_like(inverse)
    asked = None
    for draw in range(draws + 1):
        beta = coef
        if draw:
            spread = np.sqrt(sse / rng.chisquare(max(n - len(coef), 1)))
            beta = coef + spread * (root @ rng.normal(size=len(coef)))
        each = missing.select(F.lit(draw).alias("draw"), F.col(key).alias("receiver"), predicted(beta).alias("at"))
        asked = each if asked is None else asked.unionByName(each)
    near = nearest_donors(asked, observed.select(F.col(key).alias("donor"), predicted(coef).alias("at")), donors)
    of = Window.partitionBy("draw", "receiver")
    chosen = F.floor(hash_unit(["receiver", "draw"], seed) * F.count(F.lit(1)).over(of)) + 1
    picked = near.withColumn("__c", F.when(F.col("draw") > 0, chosen).otherwise(1)).where("place = __c")
    values = observed.select(F.col(key).alias("donor"), F.col(column).alias("value"))
    return picked.join(values, "donor").select("draw", F.col("receiver").alias(key), "donor", "value")


def completed(df: DataFrame, key: str, column: str, drawn: DataFrame) -> DataFrame:
    """``df`` once for each draw, with ``draw`` and the gaps of ``column`` filled; draws without gaps don't occur."""
    numbers = drawn.select("draw").distinct()
    whole = df.withColumn("__d", F.lit(1)).join(F.broadcast(numbers.withColumn("__d", F.lit(1))), "__d").drop("__d")  # a few draws
    filled = whole.join(drawn.select("draw", key, F.col("value").alias("__v")), ["draw", key], "left")
    return filled.withColumn(column, F.coalesce(F.col(column).cast("double"), "__v")).drop("__v")


def pooled(estimates: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rubin's rules over (draw, estimate, variance): mean, within, between and total variance, degrees of freedom.

    With one draw the variance between is null, and so are the total and the degrees; with none between, the degrees are null.
    """
    m = F.col("draws")
    sums = estimates.groupBy(*keys).agg(F.count(F.lit(1)).alias("draws"), F.avg("estimate").alias("estimate"), F.avg("variance").alias("within"), F.var_samp("estimate").alias("between"))
    extra = (1 + 1 / m) * F.col("between")
    return sums.withColumns({"total": F.col("within") + extra, "degrees": (m - 1) * F.pow(1 + F.try_divide(F.col("within"), extra), 2)})
