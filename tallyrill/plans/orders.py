"""Queries for partial autocorrelation, unit roots, order search and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyrill.operators import arima as A
from tallyrill.operators import css as C
from tallyrill.operators import series as TS
from tallyrill.plans import standins as D
from tallyrill.plans.registry import query
from tallyrill.plans.timeseries import DIFFS, MONTHLY_ACF, diffs

GRID = A.order_grid(range(7), range(2), range(7), range(2), range(2), range(2))


def log_monthly(spark, sf):
    """Every month of each segment's calendar, in logs."""
    return TS.densify(D.monthly(spark, sf), ["key"], "t", "y", "month").select("key", "t", F.ln("y").alias("y"))


@query(
    "ts08_partial_autocorrelation",
    f"""WITH r AS (SELECT key, max(CASE WHEN lag = 1 THEN r END) AS r1, max(CASE WHEN lag = 2 THEN r END) AS r2, max(n) AS n FROM {MONTHLY_ACF} GROUP BY 1)
        SELECT key, 0 AS lag, 1.0 AS pacf, round(1.96 / sqrt(n), 6) AS band FROM r UNION ALL
        SELECT key, 1 AS lag, round(r1, 6) AS pacf, round(1.96 / sqrt(n), 6) AS band FROM r UNION ALL
        SELECT key, 2 AS lag, round((r2 - r1 * r1) / (1 - r1 * r1), 6) AS pacf, round(1.96 / sqrt(n), 6) AS band FROM r""",
)
def ts08(spark, sf):
    out = A.pacf(D.monthly(spark, sf), ["key"], ["t"], "y", 2)
    return out.withColumns({"pacf": F.round("pacf", 6), "band": F.round("band", 6)})


@query("ts08_partial_autocorrelation_20")
def ts08b(spark, sf):
    return A.pacf(D.monthly(spark, sf), ["key"], ["t"], "y", 20)


@query("ts09_unit_root")
def ts09(spark, sf):
    return A.unit_root(log_monthly(spark, sf), ["key"], ["t"], "y")


@query(
    "ts09_unit_root_no_lags",
    f"""SELECT key, n, round(b / sqrt((syy - b * sxy) / (n - 2) / sxx), 4) AS stat FROM (SELECT key, count(*) AS n, regr_slope(dy, x) AS b,
        regr_sxx(dy, x) AS sxx, regr_sxy(dy, x) AS sxy, regr_syy(dy, x) AS syy FROM (SELECT key, e - lag(e) OVER (PARTITION BY key ORDER BY t) AS dy,
        lag(e) OVER (PARTITION BY key ORDER BY t) AS x FROM {DIFFS}) WHERE dy IS NOT NULL GROUP BY 1)""",
)
def ts09b(spark, sf):
    out = A.unit_root(diffs(spark, sf), ["key"], ["t"], "e", max_lag=0)
    return out.select("key", "n", F.round("stat", 4).alias("stat"))


@query("ts10_order_search")
def ts10(spark, sf):
    found = A.order_search(log_monthly(spark, sf), ["key"], ["t"], "y", GRID, 12)
    return found.select("key", "order_id", *A.ORDER, "n", "k", "aic", "bic", F.col("ar_ok").alias("arroots_gt_1"), F.col("ma_ok").alias("maroots_gt_1"), "status")


@query("ts11_best_orders")
def ts11(spark, sf):
    """The ten best orders per segment with the checks of their residuals."""
    best = A.searched_table(log_monthly(spark, sf), ["key"], ["t"], "y", GRID, 12)
    return best.select("key", "place", *A.ORDER, "aic", "bic", "het_p", "norm_p", "sercor_p", "dw_stat", "ar_ok", "ma_ok")


@query(
    "ts12_autoregression",
    f"""SELECT key, n, round(sxy / sxx, 6) AS ar1 FROM (SELECT key, count(*) AS n, sum(e * x) AS sxy, sum(x * x) AS sxx FROM
        (SELECT key, e, lag(e) OVER (PARTITION BY key ORDER BY t) AS x, row_number() OVER (PARTITION BY key ORDER BY t) AS i FROM {DIFFS})
        WHERE i > 3 GROUP BY 1)""",
)
def ts12(spark, sf):
    """A pure autoregression of the differences has a closed form on its common sample."""
    rows = diffs(spark, sf)
    fit = A.order_search(rows, ["key"], ["t"], "e", A.order_grid([1], [0], [0]), 12)
    return fit.select("key", "n", F.round(F.col("coef")[0], 6).alias("ar1"))


@query("ts10_multiplicative_orders")
def ts10b(spark, sf):
    """All orders of the grid with seasonal factors that multiply, by conditional least squares."""
    found = C.conditional_fits(log_monthly(spark, sf), ["key"], ["t"], "y", GRID, 12, most_steps=15)
    return found.select("key", "order_id", *A.ORDER, "n", "k", "sse", "start_sse", "aic", "bic", "ar_ok", "ma_ok", "steps", "status")


@query(
    "ts12_check_conditional",
    f"""SELECT key, n, round(sxy / sxx, 5) AS ar1, round(syy - sxy * sxy / sxx, 4) AS sse FROM (SELECT key, count(*) AS n, sum(e * x) AS sxy, sum(x * x) AS sxx, sum(e * e) AS syy FROM
        (SELECT key, e, lag(e) OVER (PARTITION BY key ORDER BY t) AS x FROM {DIFFS}) WHERE x IS NOT NULL GROUP BY 1)""",
)
def ts12b(spark, sf):
    """Without error lags the least conditional sum of squares has a closed form."""
    fit = C.conditional_fits(diffs(spark, sf), ["key"], ["t"], "e", A.order_grid([1], [0], [0]), 12)
    return fit.select("key", "n", F.round(F.col("coef")[0], 5).alias("ar1"), F.round("sse", 4).alias("sse"))


CHOSEN = {"p": 1, "d": 1, "q": 1, "sp": 1, "sd": 0, "sq": 1}


@query("ts12_multiplicative_fit")
def ts12c(spark, sf):
    """Parameters of the chosen order with their standard errors."""
    names = F.array(*map(F.lit, ["ar1", "seasonal ar1", "ma1", "seasonal ma1"]))
    fit = C.conditional_fits(log_monthly(spark, sf), ["key"], ["t"], "y", [{**CHOSEN, "order_id": 0}], 12)
    each = F.inline(F.arrays_zip(names.alias("term"), F.col("coef").alias("estimate"), F.col("se").alias("error")))
    return fit.filter("status = 'ok'").select("key", "n", "sse", each)


@query("ts13_predictions")
def ts13(spark, sf):
    return A.fit_and_predict(log_monthly(spark, sf), ["key"], ["t"], "y", CHOSEN, 9, 12)


@query("ts14_forecast_error")
def ts14(spark, sf):
    """Fit on all but the last nine months, forecast them, compare after undoing the log."""
    full = TS.split_by_position(log_monthly(spark, sf), ["key"], ["t"], 1.0)
    train = full.filter(F.col("position") <= F.col("n_rows") - 9).select("key", "t", "y")
    ahead = A.fit_and_predict(train, ["key"], ["t"], "y", CHOSEN, 9, 12).filter("is_forecast")
    held = full.filter(F.col("position") > F.col("n_rows") - 9)
    both = held.join(ahead.withColumnRenamed("step", "position"), ["key", "position"])
    return TS.rmse(both.withColumns({"y": F.exp("y"), "yhat": F.exp("yhat")}), ["key"], "y", "yhat")
