"""Queries for windows and time series."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyrill.operators import series as TS
from tallyrill.operators.ordered import with_position
from tallyrill.operators.profile import box_numbers
from tallyrill.operators.recommend import favourites
from tallyrill.operators.relational import with_group_size
from tallyrill.functions.scalars import month_short
from tallyrill.plans import standins as D
from tallyrill.plans.registry import query, table

ROWS_SQL = f"(SELECT *, row_number() OVER (PARTITION BY key ORDER BY {D.LINE_ORDER_SQL}) AS position FROM {D.LINES})"
WIN_SQL = f"OVER (PARTITION BY key ORDER BY {D.LINE_ORDER_SQL}"


# --- windows over raw rows: series of any length ------------------------------------------
@query(
    "win01_rolling_mean",
    f"""SELECT key, l_orderkey, l_linenumber, l_partkey, CASE WHEN count(y) {WIN_SQL} ROWS 19 PRECEDING) = 20
        THEN round(avg(y) {WIN_SQL} ROWS 19 PRECEDING), 4) END AS rolling_mean FROM {D.LINES}""",
)
def win01(spark, sf):
    rolled = TS.rolling(D.lines(spark, sf), ["key"], D.LINE_ORDER, "y", 20, long=True)
    return rolled.select("key", "l_orderkey", "l_linenumber", "l_partkey", F.round("rolling_mean", 4).alias("rolling_mean"))


@query(
    "win02_rolling_sd",
    f"""SELECT key, l_orderkey, l_linenumber, l_partkey, CASE WHEN count(y) {WIN_SQL} ROWS 19 PRECEDING) = 20
        THEN round(stddev_samp(y) {WIN_SQL} ROWS 19 PRECEDING), 4) END AS rolling_sd FROM {D.LINES}""",
)
def win02(spark, sf):
    rolled = TS.rolling(D.lines(spark, sf), ["key"], D.LINE_ORDER, "y", 20, long=True)
    return rolled.select("key", "l_orderkey", "l_linenumber", "l_partkey", F.round("rolling_sd", 4).alias("rolling_sd"))


@query(
    "win03_lag_difference",
    f"SELECT key, l_orderkey, l_linenumber, l_partkey, round(y - lag(y, 2) {WIN_SQL}), 2) AS diff FROM {D.LINES}",
)
def win03(spark, sf):
    out = TS.lag_difference(D.lines(spark, sf), ["key"], D.LINE_ORDER, "y", 2, long=True)
    return out.select("key", "l_orderkey", "l_linenumber", "l_partkey", F.round("diff", 2).alias("diff"))


@query(
    "win04_forward_fill",
    f"""SELECT key, l_orderkey, l_linenumber, l_partkey,
        last_value(CASE WHEN y >= 50000 THEN y END IGNORE NULLS) {WIN_SQL} ROWS UNBOUNDED PRECEDING) AS y FROM {D.LINES}""",
)
def win04(spark, sf):
    holes = D.lines(spark, sf).withColumn("y", F.when(F.col("y") >= 50000, F.col("y")))
    filled = TS.forward_fill(holes, ["key"], D.LINE_ORDER, "y", long=True)
    return filled.select("key", "l_orderkey", "l_linenumber", "l_partkey", "y")


@query("win05_party_size", f"SELECT passenger_id, count(*) OVER (PARTITION BY ticket) AS party FROM {D.PASSENGERS}")
def win05(spark, sf):
    return with_group_size(D.passengers(spark, sf), ["ticket"], "party").select("passenger_id", "party")


@query(
    "win06_top_n_per_user",
    f"""SELECT userid, title, round(rating, 6) AS rating FROM (SELECT userid, title, rating,
        row_number() OVER (PARTITION BY userid ORDER BY rating DESC, title) AS r FROM {D.RATINGS} JOIN {D.TITLES} USING (itemid)) WHERE r <= 3""",
)
def win06(spark, sf):
    return favourites(D.ratings(spark, sf), D.titles(spark, sf), 3).select("userid", "title", F.round("rating", 6).alias("rating"))


@query("win07_row_position", f"SELECT key, l_orderkey, l_linenumber, l_partkey, position FROM {ROWS_SQL}")
def win07(spark, sf):
    placed = with_position(D.lines(spark, sf), ["key"], D.LINE_ORDER)
    return placed.select("key", "l_orderkey", "l_linenumber", "l_partkey", "position")


@query(
    "win08_rank_of_scores",
    """SELECT n_regionkey, n_name, score, rank() OVER (PARTITION BY n_regionkey ORDER BY score DESC) AS place
       FROM (SELECT n_regionkey, n_name, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS score FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)""",
)
def win08(spark, sf):
    """Rank after the aggregation: one row per nation enters the window."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    exact = F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))
    g = c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_regionkey", "n_name").agg(exact.alias("score"))
    return g.withColumn("place", F.rank().over(Window.partitionBy("n_regionkey").orderBy(F.col("score").desc_nulls_last())))


# --- bands --------------------------------------------------------------------------------
def even3(expr: str) -> str:
    return f"round_even({expr}, 3)"


def band_sql(source: str) -> str:
    return f"""(SELECT key, t, y, CASE WHEN n = 20 THEN {even3('m')} END AS ave, CASE WHEN n = 20 THEN {even3('m + 2 * s')} END AS upper,
  CASE WHEN n = 20 THEN {even3('m - 2 * s')} END AS lower FROM (SELECT key, t, y, count(y) OVER w AS n, avg(y) OVER w AS m,
  stddev_samp(y) OVER w AS s FROM {source} WINDOW w AS (PARTITION BY key ORDER BY t ROWS 19 PRECEDING)))"""


BAND_SQL = band_sql(D.DAILY)
LOG_DAILY = f"(SELECT key, t, ln(y) AS y FROM {D.DAILY})"


@query(
    "ts01_bands",
    f"SELECT key, strftime(t, '%Y-%m-%d') AS t, ave, upper, lower FROM {band_sql(LOG_DAILY)}",
)
def ts01(spark, sf):
    b = TS.bands(D.daily(spark, sf).withColumn("y", F.ln("y")), ["key"], ["t"], "y")
    return b.select("key", F.col("t").cast("string").alias("t"), "ave", "upper", "lower")


@query(
    "ts02_band_violations",
    f"SELECT key, count(*) FILTER (WHERE y > upper OR y < lower) AS violations, count(ave) AS n FROM {BAND_SQL} GROUP BY 1",
)
def ts02(spark, sf):
    return TS.band_violations(TS.bands(D.daily(spark, sf), ["key"], ["t"], "y"), ["key"], "y")


@query(
    "ts03_daily_calendar",
    f"""WITH s AS (SELECT * FROM {D.DAILY}), e AS (SELECT key, min(t) AS lo, max(t) AS hi FROM s GROUP BY 1),
        c AS (SELECT key, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS t FROM e)
        SELECT c.key, strftime(c.t, '%Y-%m-%d') AS t, last_value(s.y IGNORE NULLS) OVER (PARTITION BY c.key ORDER BY c.t ROWS UNBOUNDED PRECEDING) AS y
        FROM c LEFT JOIN s ON c.key = s.key AND c.t = s.t""",
)
def ts03(spark, sf):
    full = TS.densify(D.daily(spark, sf), ["key"], "t", "y", "day")
    return full.select("key", F.col("t").cast("string").alias("t"), "y")


@query(
    "ts04_split_by_position",
    f"""SELECT key, split, count(*) AS n, strftime(min(t), '%Y-%m') AS lo, strftime(max(t), '%Y-%m') AS hi FROM (SELECT key, t,
        CASE WHEN row_number() OVER (PARTITION BY key ORDER BY t) <= floor(0.95 * count(*) OVER (PARTITION BY key)) + 1 THEN 'train' ELSE 'test' END AS split
        FROM {D.MONTHLY}) GROUP BY 1, 2""",
)
def ts04(spark, sf):
    s = TS.split_by_position(D.monthly(spark, sf), ["key"], ["t"], 0.95)
    return s.groupBy("key", "split").agg(
        F.count(F.lit(1)).alias("n"),
        F.date_format(F.min("t"), "yyyy-MM").alias("lo"),
        F.date_format(F.max("t"), "yyyy-MM").alias("hi"),
    )


@query(
    "ts04_split_of_long_series",
    f"""SELECT key, split, count(*) AS n FROM (SELECT key, CASE WHEN position <= floor(0.70 * count(*) OVER (PARTITION BY key)) + 1
        THEN 'train' ELSE 'test' END AS split FROM {ROWS_SQL}) GROUP BY 1, 2""",
)
def ts04b(spark, sf):
    s = TS.split_by_position(D.lines(spark, sf), ["key"], D.LINE_ORDER, 0.70, long=True)
    return s.groupBy("key", "split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ts05_log_difference",
    f"""SELECT key, t, log_y, diff FROM (SELECT key, strftime(t, '%Y-%m') AS t, round(ln(y), 6) AS log_y,
        round(ln(y) - lag(ln(y), 1) OVER (PARTITION BY key ORDER BY t), 6) AS diff FROM {D.MONTHLY}) WHERE diff IS NOT NULL""",
)
def ts05(spark, sf):
    d = TS.log_difference(D.monthly(spark, sf), ["key"], ["t"], "y")
    return d.select("key", F.date_format("t", "yyyy-MM").alias("t"), F.round("log_y", 6).alias("log_y"), F.round("diff", 6).alias("diff"))


@query(
    "ts06_monthly_box",
    f"""WITH p AS (SELECT strftime(t, '%b') AS month, y FROM {D.MONTHLY}),
        q AS (SELECT month, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS median, quantile_cont(y, 0.75) AS q3 FROM p GROUP BY 1)
        SELECT month, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
        min(y) FILTER (WHERE y >= q1 - 1.5 * (q3 - q1)) AS low, max(y) FILTER (WHERE y <= q3 + 1.5 * (q3 - q1)) AS high
        FROM p JOIN q USING (month) GROUP BY month, q1, median, q3""",
)
def ts06(spark, sf):
    m = D.monthly(spark, sf).select(month_short("t").alias("month"), "y")
    return box_numbers(m, ["month"], "y").withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


def acf_sql(source: str, lags: int) -> str:
    return f"""(WITH s AS (SELECT key, row_number() OVER (PARTITION BY key ORDER BY {{order}}) AS i,
      y - avg(y) OVER (PARTITION BY key) AS d, count(*) OVER (PARTITION BY key) AS n FROM {source}),
      c AS (SELECT a.key, CAST(b.i - a.i AS INTEGER) AS lag, sum(a.d * b.d) AS c, max(a.n) AS n FROM s a JOIN s b
      ON a.key = b.key AND b.i BETWEEN a.i AND a.i + {lags} GROUP BY 1, 2),
      r AS (SELECT c.key, c.lag, c.c / z.c AS r, c.n FROM c JOIN c z ON c.key = z.key AND z.lag = 0)
      SELECT key, lag, r, n, CASE WHEN lag > 0 THEN 1.96 * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN r * r END)
      OVER (PARTITION BY key ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END AS band FROM r)"""


MONTHLY_ACF = acf_sql(D.MONTHLY, 20).format(order="t")


@query("ts07_autocorrelation", f"SELECT key, lag, round(r, 6) AS r, round(band, 6) AS band, n FROM {MONTHLY_ACF}")
def ts07(spark, sf):
    a = TS.acf(D.monthly(spark, sf), ["key"], ["t"], "y", 20)
    return a.withColumns({"r": F.round("r", 6), "band": F.round("band", 6)})


@query(
    "ts07_autocorrelation_long",
    f"SELECT key, lag, round(r, 6) AS r, round(band, 6) AS band, n FROM {acf_sql(D.LINES, 40).format(order=D.LINE_ORDER_SQL)}",
)
def ts07b(spark, sf):
    a = TS.acf(D.lines(spark, sf), ["key"], D.LINE_ORDER, "y", 40, long=True)
    return a.withColumns({"r": F.round("r", 6), "band": F.round("band", 6)})


DIFFS = f"""(SELECT key, t, e FROM (SELECT key, t, ln(y) - lag(ln(y)) OVER (PARTITION BY key ORDER BY t) AS e FROM {D.MONTHLY}) WHERE e IS NOT NULL)"""


def diffs(spark, sf):
    return TS.log_difference(D.monthly(spark, sf), ["key"], ["t"], "y").select("key", "t", F.col("diff").alias("e"))


@query(
    "ts14_holdout_rmse",
    f"""SELECT key, round(sqrt(avg(power(y - ave, 2))), 2) AS rmse, count(ave) AS n FROM (SELECT key, y, ave,
        row_number() OVER (PARTITION BY key ORDER BY t) AS i, count(*) OVER (PARTITION BY key) AS n FROM {BAND_SQL})
        WHERE i > floor(0.95 * n) + 1 GROUP BY 1""",
)
def ts14(spark, sf):
    """Error of the rolling mean on the held-out end of each series."""
    b = TS.split_by_position(TS.bands(D.daily(spark, sf), ["key"], ["t"], "y"), ["key"], ["t"], 0.95)
    out = TS.rmse(b.filter("split = 'test'"), ["key"], "y", "ave")
    return out.withColumn("rmse", F.round("rmse", 2))


@query(
    "ts15_durbin_watson",
    f"""SELECT key, round(sum(step * step) / sum(e * e), 6) AS dw FROM
        (SELECT key, e, e - lag(e) OVER (PARTITION BY key ORDER BY t) AS step FROM {DIFFS}) GROUP BY 1""",
)
def ts15(spark, sf):
    return TS.durbin_watson(diffs(spark, sf), ["key"], ["t"], "e").withColumn("dw", F.round("dw", 6))


E_SERIES = f"(SELECT key, t, e AS y FROM {DIFFS})"


@query(
    "ts16_ljung_box",
    f"""SELECT key, round(q, 4) AS q, round(exp(-q / 2) * list_sum(list_transform(range(10), lambda i: power(q / 2, i) / gamma(i + 1))), 6) AS p
        FROM (SELECT key, max(n * (n + 2)) * sum(r * r / (n - lag)) AS q FROM {acf_sql(E_SERIES, 20).format(order='t')} WHERE lag > 0 GROUP BY 1)""",
)
def ts16(spark, sf):
    out = TS.ljung_box(diffs(spark, sf), ["key"], ["t"], "e", 20)
    return out.withColumns({"q": F.round("q", 4), "p": F.round("p", 6)})


@query(
    "ts17_jarque_bera",
    f"""SELECT key, n, round(skew, 6) AS skew, round(excess, 6) AS excess, round(n / 6 * (skew * skew + excess * excess / 4), 4) AS jb,
        round(exp(-n / 6 * (skew * skew + excess * excess / 4) / 2), 6) AS p FROM (SELECT key, count(*) AS n,
        avg(power(d, 3)) / power(avg(d * d), 1.5) AS skew, avg(power(d, 4)) / power(avg(d * d), 2) - 3 AS excess
        FROM (SELECT key, e - avg(e) OVER (PARTITION BY key) AS d FROM {DIFFS}) GROUP BY 1)""",
)
def ts17(spark, sf):
    out = TS.jarque_bera(diffs(spark, sf), ["key"], "e")
    return out.withColumns({"skew": F.round("skew", 6), "excess": F.round("excess", 6), "jb": F.round("jb", 4), "p": F.round("p", 6)})


@query(
    "ts18_break_variance",
    f"""SELECT key, round(n / 3.0) AS h, round(sum(CASE WHEN i > n - round(n / 3.0) THEN e * e END) / sum(CASE WHEN i <= round(n / 3.0) THEN e * e END), 6) AS stat
        FROM (SELECT key, e, row_number() OVER (PARTITION BY key ORDER BY t) AS i, count(*) OVER (PARTITION BY key) AS n FROM {DIFFS}) GROUP BY key, n""",
)
def ts18(spark, sf):
    return TS.break_variance(diffs(spark, sf), ["key"], ["t"], "e").withColumn("stat", F.round("stat", 6))
