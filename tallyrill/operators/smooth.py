"""Local regression at knots: tricube weights over the nearest share of the points, from sums of moments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.operators.ordered import with_running
from tallyrill.session import stage


def _solved(degree: int) -> tuple[Column, Column]:
    """Value at the knot and the determinant it needs, from s0..s4 and t0..t2 by Cramer's rule."""
    s, t = [F.col(f"s{i}") for i in range(2 * degree + 1)], [F.col(f"t{i}") for i in range(degree + 1)]
    if degree == 1:
        return t[0] * s[2] - t[1] * s[1], s[0] * s[2] - s[1] * s[1]
    a, b, c = s[2] * s[4] - s[3] * s[3], s[1] * s[4] - s[2] * s[3], s[1] * s[3] - s[2] * s[2]
    top = t[0] * a - s[1] * (t[1] * s[4] - s[3] * t[2]) + s[2] * (t[1] * s[3] - s[2] * t[2])
    return top, s[0] * a - s[1] * b + s[2] * c


def local_regression(df: DataFrame, x: str, y: str, knots: int = 20, share: float = 0.75, degree: int = 2) -> DataFrame:
    """(knot, x, reach, points, fit): a smooth line through y at equally spaced x.

    Each knot sees the nearest ``share`` of all points (at least one more than ``degree``): ``reach`` is its exact
    distance to the last of them, and a point at distance u of it has weight (1 - u^3)^3. A line or a parabola is
    fitted there. Equal x are summed first; then one pass gives the moments of all knots, and ``knots`` rows
    are solved in closed form. Rows with a null x or y are left out. Where the points of a knot
    don't determine the curve (all at its reach or too few different x), ``fit`` is their weighted mean, or null without weight.
    """
    if degree not in (1, 2):
        raise ValueError("degree has to be 1 or 2")
    src = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    points = stage(src.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy")), "points")
    lo, hi, rows = points.agg(F.min("x"), F.max("x"), F.sum("n")).first()
    if not rows:
        return df.sparkSession.createDataFrame([], "knot int, x double, reach double, points bigint, fit double")
    places = [lo + (hi - lo) * k / max(knots - 1, 1) for k in range(knots)]
    needed = min(max(int(rows * share), degree + 1), rows)

    def met(cells: list[dict[str, Column]]) -> DataFrame:
        """Each point beside each knot."""
        listed = F.array(*[F.struct(*[c.alias(name) for name, c in cell.items()]) for cell in cells])
        return points.select("*", F.inline(listed))

    far = met([{"knot": F.lit(k), "at": F.lit(at)} for k, at in enumerate(places)]).withColumn("far", F.abs(F.col("x") - F.col("at")))
    ranked = with_running(far.groupBy("knot", "far").agg(F.sum("n").alias("n")), ["knot"], ["far"], F.col("n"), "upto", "whole")
    reaches = dict(ranked.where(F.col("upto") >= needed).groupBy("knot").agg(F.min("far")).collect())
    cells = [{"knot": F.lit(k), "at": F.lit(at), "reach": F.lit(reaches[k])} for k, at in enumerate(places)]
    near = met(cells)
    d = F.try_divide(F.col("x") - F.col("at"), F.col("reach"))
    near = near.withColumn("d", F.coalesce(d, F.when(F.col("x") == F.col("at"), F.lit(0.0)))).where("abs(x - at) < reach OR x = at")
    cube = 1 - F.abs("d") * F.abs("d") * F.abs("d")
    near = near.withColumn("w", cube * cube * cube)

    def power(i: int) -> Column:
        out = F.col("w")
        for _ in range(i):
            out = out * F.col("d")
        return out

    moments = [F.sum(power(i) * F.col("n")).alias(f"s{i}") for i in range(2 * degree + 1)]
    moments += [F.sum(power(i) * F.col("sy")).alias(f"t{i}") for i in range(degree + 1)]
    wide = df.sparkSession.createDataFrame([(k, at, reaches[k]) for k, at in enumerate(places)], "knot int, at double, reach double")
    sums = wide.join(near.groupBy("knot").agg(F.sum("n").alias("points"), *moments), "knot", "left")
    top, bottom = _solved(degree)
    size = F.pow("s0", F.lit(degree + 1))
    fit = F.when(bottom > 1e-10 * size, top / bottom).otherwise(F.try_divide(F.col("t0"), F.col("s0")))
    return sums.select("knot", F.col("at").alias("x"), "reach", F.coalesce("points", F.lit(0)).alias("points"), fit.alias("fit"))
