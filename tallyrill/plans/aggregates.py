"""Queries for aggregates, sorts and profiles."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from tallyrill.functions import scalars as S
from tallyrill.operators import profile as P
from tallyrill.operators.ordered import exact_quantiles
from tallyrill.operators.relational import collapse_rare, columns_by_type, natural_left_join
from tallyrill.operators.smooth import local_regression
from tallyrill.plans import standins as D
from tallyrill.plans.registry import query, table


@query("agg01_global", f"SELECT round(avg(close), 4) AS mean_close, max(volume) AS max_volume, min(volume) AS min_volume FROM {D.BARS}")
def agg01(spark, sf):
    return D.bars(spark, sf).agg(
        F.round(F.avg("close"), 4).alias("mean_close"), F.max("volume").alias("max_volume"), F.min("volume").alias("min_volume")
    )


@query("agg02_counts", f"SELECT count(*) AS n_rows, count(sales) AS n_sales FROM {D.SALES}")
def agg02(spark, sf):
    return D.sales(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"), F.count("sales").alias("n_sales"))


@query("agg03_frequency", f"SELECT survived, count(*) AS n FROM {D.PASSENGERS} WHERE survived IS NOT NULL GROUP BY 1")
def agg03(spark, sf):
    return P.frequency(D.passengers(spark, sf), ["survived"], drop_null=True)


@query(
    "agg04_all_numeric_means",
    f"""SELECT CAST(month(day) AS INTEGER) AS month, round(avg(open), 4) AS open, round(avg(high), 4) AS high, round(avg(low), 4) AS low,
        round(avg(close), 4) AS close, round(avg(volume), 4) AS volume, max(open) AS max_open, max(high) AS max_high, max(low) AS max_low,
        max(close) AS max_close, max(volume) AS max_volume FROM {D.BARS} GROUP BY 1""",
)
def agg04(spark, sf):
    """Mean and greatest value of every numeric column, as the schema names them."""
    b = D.bars(spark, sf)
    numeric = columns_by_type(b, "numeric")
    means = [F.round(F.avg(c), 4).alias(c) for c in numeric]
    return b.groupBy(F.month("day").alias("month")).agg(*means, *[F.max(c).alias(f"max_{c}") for c in numeric])


@query("agg05_dictionary", f"SELECT company, max(sales) AS max_sales, min(person) AS min_person FROM {D.SALES} GROUP BY 1")
def agg05(spark, sf):
    g = D.sales(spark, sf).groupBy("company").agg({"sales": "max", "person": "min"})
    return g.withColumnsRenamed({"max(sales)": "max_sales", "min(person)": "min_person"})


def two_delays(df, keys):
    late = df.filter((F.col("arr_delay") >= 0) & (F.col("dep_delay") >= 0))
    return late.groupBy(*keys).agg(F.round(F.avg("arr_delay") + F.avg("dep_delay"), 6).alias("avg_delay"))


def two_delays_sql(keys: str) -> str:
    return (
        f"SELECT {keys}, round(avg(arr_delay) + avg(dep_delay), 6) AS avg_delay FROM {D.FLIGHTS} "
        f"WHERE arr_delay >= 0 AND dep_delay >= 0 GROUP BY {keys}"
    )


@query("agg06_worst_day_delay", two_delays_sql("month, day"))
def agg06(spark, sf):
    return two_delays(D.flights(spark, sf), ["month", "day"]).orderBy(F.col("avg_delay").desc_nulls_last(), "month", "day")


@query("agg06_worst_origin_day", two_delays_sql("origin, month, day"))
def agg06b(spark, sf):
    return two_delays(D.flights(spark, sf), ["origin", "month", "day"])


@query(
    "agg06_delay_by_hour",
    f"""SELECT CASE WHEN hour = 24 THEN 0 ELSE hour END AS hour, round(avg(arr_delay) + avg(dep_delay), 6) AS avg_delay
        FROM {D.FLIGHTS} WHERE arr_delay >= 0 AND dep_delay >= 0 GROUP BY 1""",
)
def agg06c(spark, sf):
    f = D.flights(spark, sf).withColumn("hour", S.clean_hour("hour"))
    return two_delays(f, ["hour"]).dropna()


@query(
    "agg07_total_per_origin",
    f"SELECT origin, round(sum(avg_delay), 4) AS total_delay FROM ({two_delays_sql('origin, month, day')}) GROUP BY 1",
)
def agg07(spark, sf):
    by_day = two_delays(D.flights(spark, sf), ["origin", "month", "day"])
    return by_day.groupBy("origin").agg(F.round(F.sum("avg_delay"), 4).alias("total_delay"))


AIRCRAFT = f"""(SELECT tailnum, avg((dep_delay + arr_delay) / nullif(air_time, 0)) AS avg_pi FROM {D.FLIGHTS} GROUP BY 1)"""


def aircraft(spark, sf):
    f = D.flights(spark, sf)
    pi = S.ratio(F.col("dep_delay") + F.col("arr_delay"), "air_time")
    return f.groupBy("tailnum").agg(F.avg(pi).alias("avg_pi"))


@query(
    "agg07_index_per_seats",
    f"""SELECT seats, round(avg(avg_pi), 4) AS pi FROM {AIRCRAFT} a LEFT JOIN {D.PLANES} p
        ON a.tailnum IS NOT DISTINCT FROM p.tailnum GROUP BY 1""",
)
def agg07b(spark, sf):
    detail = natural_left_join(aircraft(spark, sf), D.planes(spark, sf))
    return detail.groupBy("seats").agg(F.round(F.avg("avg_pi"), 4).alias("pi"))


@query(
    "agg07_index_per_maker",
    f"""SELECT manufacturer, round(avg(avg_pi), 4) AS pi FROM {AIRCRAFT} a LEFT JOIN {D.PLANES} p
        ON a.tailnum IS NOT DISTINCT FROM p.tailnum GROUP BY 1 HAVING avg(avg_pi) IS NOT NULL AND manufacturer IS NOT NULL""",
)
def agg07c(spark, sf):
    detail = natural_left_join(aircraft(spark, sf), D.planes(spark, sf))
    return detail.groupBy("manufacturer").agg(F.round(F.avg("avg_pi"), 4).alias("pi")).dropna()


@query(
    "agg08_speed_per_carrier",
    f"SELECT carrier, round(avg(distance / nullif(air_time, 0) * 60), 2) AS avg_speed FROM {D.FLIGHTS} GROUP BY 1",
)
def agg08(spark, sf):
    speed = S.ratio("distance", "air_time") * 60
    return D.flights(spark, sf).groupBy("carrier").agg(F.round(F.avg(speed), 2).alias("avg_speed"))


def summary_sql(columns):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
            CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM {D.BARS}"""
        for c in columns
    )


BAR_NUMBERS = ["open", "high", "low", "close", "volume"]


@query("agg09_summary", summary_sql(BAR_NUMBERS))
def agg09(spark, sf):
    out = P.summary(D.bars(spark, sf), BAR_NUMBERS)
    return out.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query(
    "agg10_formatted_summary",
    f"SELECT \"column\", format('{{:,.2f}}', mean) AS mean, format('{{:,.2f}}', min) AS min, format('{{:,.2f}}', max) AS max, "
    f"CAST(floor(max) AS BIGINT) AS whole_max FROM ({summary_sql(BAR_NUMBERS)})",
)
def agg10(spark, sf):
    out = P.summary(D.bars(spark, sf), BAR_NUMBERS).withColumn("mean", F.round("mean", 4))
    return out.select(
        "column",
        F.format_number("mean", 2).alias("mean"),
        F.format_number("min", 2).alias("min"),
        F.format_number("max", 2).alias("max"),
        F.col("max").cast("bigint").alias("whole_max"),
    )


PAX = ["passenger_id", "survived", "pclass", "name", "sex", "age", "sibsp", "parch", "ticket", "fare", "embarked"]


@query(
    "agg11_null_and_blank_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS nulls,
            count(*) FILTER (WHERE CAST({c} AS VARCHAR) = '') AS blanks FROM {D.PASSENGERS}"""
        for c in PAX
    ),
)
def agg11(spark, sf):
    return P.column_counts(D.passengers(spark, sf), PAX)


@query(
    "agg12_blank_count",
    f"SELECT count(*) FILTER (WHERE embarked = '') AS embarked, count(*) FILTER (WHERE name = '') AS name FROM {D.PASSENGERS}",
)
def agg12(spark, sf):
    return D.passengers(spark, sf).agg(*[F.count_if(F.col(c) == "").alias(c) for c in ("embarked", "name")])


@query(
    "agg13_distinct_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_distinct FROM {D.PASSENGERS}"""
        for c in PAX
    ),
)
def agg13(spark, sf):
    return P.distinct_counts(D.passengers(spark, sf), PAX)


@query(
    "agg14_conditional_median",
    f"SELECT round(median(fare), 4) AS median_fare FROM {D.PASSENGERS} WHERE pclass = 3 AND embarked = 'M'",
)
def agg14(spark, sf):
    some = D.passengers(spark, sf).filter("pclass = 3 AND embarked = 'M'")
    return exact_quantiles(some, [], "fare", [0.5]).select(F.round("value", 4).alias("median_fare"))


@query(
    "agg15_modes",
    " UNION ALL ".join(
        f"""SELECT "column", mode, n FROM (SELECT '{c}' AS "column", {c} AS mode, count(*) AS n,
            row_number() OVER (ORDER BY count(*) DESC, {c}) AS r FROM {D.CLAIMS} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE r = 1"""
        for c in ("v24", "v47", "v79")
    ),
)
def agg15(spark, sf):
    return P.modes(D.claims(spark, sf), ["v24", "v47", "v79"])


@query(
    "agg16_proportions",
    f"""SELECT survived, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS share
        FROM {D.PASSENGERS} WHERE survived IS NOT NULL GROUP BY 1""",
)
def agg16(spark, sf):
    known = D.passengers(spark, sf).filter(F.col("survived").isNotNull())
    return P.shares(known, ["survived"]).withColumn("share", F.round(F.col("share") * 100, 1))


@query("agg17_cross_table", f"SELECT pclass, sex, survived, count(*) AS n FROM {D.PASSENGERS} GROUP BY 1, 2, 3")
def agg17(spark, sf):
    return P.frequency(D.passengers(spark, sf), ["pclass", "sex", "survived"])


@query(
    "agg17_wide_cross_table",
    f"""SELECT pclass, count(*) FILTER (WHERE survived = 0) AS died, count(*) FILTER (WHERE survived = 1) AS lived
        FROM {D.PASSENGERS} GROUP BY 1""",
)
def agg17b(spark, sf):
    wide = D.passengers(spark, sf).groupBy("pclass").pivot("survived", [0, 1]).count().na.fill(0)
    return wide.withColumnsRenamed({"0": "died", "1": "lived"})


@query(
    "agg18_missing_patterns",
    f"""SELECT CAST(survived IS NOT NULL AS INTEGER) AS survived, CAST(age IS NOT NULL AS INTEGER) AS age,
        CAST(fare IS NOT NULL AS INTEGER) AS fare, count(*) AS n FROM {D.PASSENGERS} GROUP BY 1, 2, 3""",
)
def agg18(spark, sf):
    return P.missing_patterns(D.passengers(spark, sf), ["survived", "age", "fare"])


@query("agg19_correlation", "SELECT round(corr(o_totalprice, c_acctbal), 8) AS r FROM orders JOIN customer ON o_custkey = c_custkey")
def agg19(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).agg(F.round(S.safe_corr("o_totalprice", "c_acctbal"), 8).alias("r"))


COR = ["total_delay", "temp", "humid", "wind_speed", "pressure", "visib"]
COR_SQL = f"""(SELECT * FROM (SELECT greatest(arr_delay, 0) + greatest(dep_delay, 0) AS total_delay, temp, humid, wind_speed, pressure, visib
  FROM {D.FLIGHTS} f LEFT JOIN {D.WEATHER} w ON f.day = w.day) WHERE temp IS NOT NULL)"""


def delay_weather(spark, sf):
    joined = natural_left_join(D.flights(spark, sf), D.weather(spark, sf))
    total = S.at_least_zero("arr_delay") + S.at_least_zero("dep_delay")
    return joined.select(total.alias("total_delay"), *COR[1:])


@query(
    "agg20_correlation_pairs",
    f"WITH t AS (SELECT * FROM {COR_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM t" for a, b in combinations_with_replacement(COR, 2)
    ),
)
def agg20(spark, sf):
    return P.correlation_pairs(delay_weather(spark, sf), COR).withColumn("r", F.round("r", 6))


@query(
    "agg21_line_of_grouped",
    f"""SELECT round(regr_slope(pi, seats), 6) AS slope, round(regr_intercept(pi, seats), 4) AS intercept, round(regr_r2(pi, seats), 6) AS r2
        FROM (SELECT seats, avg(avg_pi) AS pi FROM {AIRCRAFT} a LEFT JOIN {D.PLANES} p ON a.tailnum IS NOT DISTINCT FROM p.tailnum GROUP BY 1)""",
)
def agg21(spark, sf):
    d = natural_left_join(aircraft(spark, sf), D.planes(spark, sf)).groupBy("seats").agg(F.avg("avg_pi").alias("pi"))
    fit = P.line_fit(d, "seats", "pi")
    return fit.select(F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), F.round("r2", 6).alias("r2"))


@query(
    "agg22_binned_trend",
    f"""WITH t AS (SELECT * FROM {COR_SQL}), s AS (SELECT min(total_delay) AS lo, max(total_delay) AS hi FROM t)
        SELECT CAST(least(floor(CAST(total_delay - (SELECT lo FROM s) AS DOUBLE) / ((SELECT hi FROM s) - (SELECT lo FROM s)) * 20), 19) AS INTEGER) AS bin,
        round(avg(humid), 4) AS mean_y, round(stddev_samp(humid), 4) AS sd_y, count(*) AS n FROM t GROUP BY 1""",
)
def agg22(spark, sf):
    out = P.binned_trend(delay_weather(spark, sf), "total_delay", "humid", 20)
    return out.withColumns({"mean_y": F.round("mean_y", 4), "sd_y": F.round("sd_y", 4)})


def smooth_sql(source: str, x: str, y: str, knots: int, share: float) -> str:
    """Local parabolas with the same weights, every point against every knot."""
    moments = ", ".join([f"sum(w * d ** {i}) AS s{i}" for i in range(5)] + [f"sum(w * d ** {i} * y) AS t{i}" for i in range(3)])
    top = "t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)"
    bottom = "s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2)"
    return f"""WITH p AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
      g AS (SELECT min(x) AS lo, max(x) AS hi, least(greatest(floor(count(*) * {share}), 3), count(*)) AS needed FROM p),
      k AS (SELECT CAST(knot AS INTEGER) AS knot, lo + (hi - lo) * knot / {knots - 1} AS mid, needed FROM g, (SELECT unnest(range({knots})) AS knot)),
      f AS (SELECT knot, mid, x, y, abs(x - mid) AS far, needed, row_number() OVER (PARTITION BY knot ORDER BY abs(x - mid)) AS i FROM k, p),
      r AS (SELECT knot, mid, max(far) AS reach FROM f WHERE i <= needed GROUP BY 1, 2),
      w AS (SELECT r.knot, r.mid, reach, (x - r.mid) / reach AS d, (1 - (far / reach) ** 3) ** 3 AS w, y FROM f JOIN r USING (knot) WHERE far < reach),
      m AS (SELECT knot, mid, reach, count(*) AS points, {moments} FROM w GROUP BY 1, 2, 3)
      SELECT knot, round(mid, 6) AS x, round(reach, 6) AS reach, points, round(CASE WHEN {bottom} > 1e-10 * s0 ** 3 THEN ({top}) / ({bottom}) ELSE t0 / s0 END, 4) AS fit FROM m"""


@query("agg22_smoothed_trend", smooth_sql(COR_SQL, "total_delay", "humid", 20, 0.75))
def agg22b(spark, sf):
    """Local parabolas at 20 delays, each over the nearest three quarters of the flights."""
    out = local_regression(delay_weather(spark, sf), "total_delay", "humid")
    return out.select("knot", F.round("x", 6).alias("x"), F.round("reach", 6).alias("reach"), "points", F.round("fit", 4).alias("fit"))


@query(
    "agg23_histogram",
    """WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
       SELECT bin, round((SELECT lo FROM s) + bin * ((SELECT hi FROM s) - (SELECT lo FROM s)) / 25, 4) AS "left", n FROM (
       SELECT CAST(least(floor((l_extendedprice - (SELECT lo FROM s)) / ((SELECT hi FROM s) - (SELECT lo FROM s)) * 25), 24) AS INTEGER) AS bin,
       count(*) AS n FROM lineitem GROUP BY 1)""",
)
def agg23(spark, sf):
    return P.histogram(table(spark, sf, "lineitem"), "l_extendedprice").withColumn("left", F.round("left", 4))


@query(
    "agg24_box_numbers",
    f"""WITH p AS (SELECT pclass, survived, fare FROM {D.PASSENGERS} WHERE fare IS NOT NULL AND survived IS NOT NULL),
        q AS (SELECT pclass, survived, quantile_cont(fare, 0.25) AS q1, quantile_cont(fare, 0.5) AS median, quantile_cont(fare, 0.75) AS q3 FROM p GROUP BY 1, 2)
        SELECT pclass, survived, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
        min(fare) FILTER (WHERE fare >= q1 - 1.5 * (q3 - q1)) AS low, max(fare) FILTER (WHERE fare <= q3 + 1.5 * (q3 - q1)) AS high
        FROM p JOIN q USING (pclass, survived) GROUP BY pclass, survived, q1, median, q3""",
)
def agg24(spark, sf):
    p = D.passengers(spark, sf).filter(F.col("survived").isNotNull()).select("pclass", "survived", "fare")
    box = P.box_numbers(p, ["pclass", "survived"], "fare")
    return box.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


FAMILY_SQL = f"""(SELECT passenger_id, CASE WHEN sibsp + parch + 1 <= 2 THEN 'Small'
  ELSE concat(CAST(sibsp + parch + 1 AS VARCHAR), name) END AS family FROM {D.PASSENGERS})"""


@query(
    "agg25_collapse_rare",
    f"""SELECT CASE WHEN n <= 2 THEN 'Small' ELSE family END AS family, CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT family, count(*) AS n FROM {FAMILY_SQL} GROUP BY 1) GROUP BY 1""",
)
def agg25(spark, sf):
    """Families of one or two become 'Small' first; what is then still rare joins them."""
    p = D.passengers(spark, sf)
    size = F.col("sibsp") + F.col("parch") + 1
    family = F.when(size <= 2, "Small").otherwise(F.concat(size.cast("string"), F.col("name")))
    collapsed = collapse_rare(p.select("passenger_id", family.alias("family")), "family", 2, "Small")
    return P.frequency(collapsed, ["family"])


@query("agg28_mean_per_user", f"SELECT userid, round(avg(rating), 6) AS mean_rating FROM {D.RATINGS} GROUP BY 1")
def agg28(spark, sf):
    return D.ratings(spark, sf).groupBy("userid").agg(F.round(F.avg("rating"), 6).alias("mean_rating"))


# --- sorts and top-k ----------------------------------------------------------------------
@query("srt01_sort_descending", f"SELECT carrier, round(avg(distance), 4) AS mean_distance FROM {D.FLIGHTS} GROUP BY 1 ORDER BY 2 DESC, 1")
def srt01(spark, sf):
    g = D.flights(spark, sf).groupBy("carrier").agg(F.round(F.avg("distance"), 4).alias("mean_distance"))
    return g.orderBy(F.col("mean_distance").desc_nulls_last(), "carrier")


@query(
    "srt02_sort_ascending",
    f"SELECT CAST(month(day) AS INTEGER) AS month, round(avg(close), 4) AS close FROM {D.BARS} GROUP BY 1 ORDER BY 1",
)
def srt02(spark, sf):
    g = D.bars(spark, sf).groupBy(F.month("day").alias("month")).agg(F.round(F.avg("close"), 4).alias("close"))
    return g.orderBy("month")


@query("srt03_mixed_order", f"SELECT userid, itemid, round(rating, 6) AS rating FROM {D.RATINGS} ORDER BY userid DESC, itemid")
def srt03(spark, sf):
    r = D.ratings(spark, sf).withColumn("rating", F.round("rating", 6))
    return r.orderBy(F.col("userid").desc(), F.col("itemid").asc())


@query(
    "srt04_arg_max",
    f"SELECT strftime(day, '%Y-%m-%d') AS day, high FROM {D.BARS} ORDER BY high DESC, day LIMIT 1",
)
def srt04(spark, sf):
    """Day of the highest price, the earliest day on ties, as one aggregate."""
    best = F.min(F.struct((-F.col("high")).alias("h"), "day")).alias("b")
    return D.bars(spark, sf).agg(best).select(F.col("b.day").cast("string").alias("day"), (-F.col("b.h")).alias("high"))


@query(
    "srt05_top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def srt05(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc_nulls_last(), "o_orderkey").limit(10)
