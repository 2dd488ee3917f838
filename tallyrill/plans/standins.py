"""Analysis tables derived from the given tables, each with its SQL text.

Every stand-in is a function (spark, folder) -> DataFrame and a SQL subquery that gives the
same rows, so that a query and its twin start from one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.plans.registry import table

# Columns that together name one lineitem row.
LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


# --- daily price bars ---------------------------------------------------------------------
def bars(spark: SparkSession, folder: str) -> DataFrame:
    first = F.struct(*LINE_ID)
    price = F.col("l_extendedprice")
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("day"))
        .agg(
            F.min_by(price, first).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, first).alias("close"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
    )


BARS = """(SELECT CAST(l_shipdate AS DATE) AS day,
  arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS open,
  max(l_extendedprice) AS high, min(l_extendedprice) AS low,
  arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS close,
  CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lineitem GROUP BY 1)"""


# --- sales by company ---------------------------------------------------------------------
def sales(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order; orders that are still pending have no sales figure."""
    o = table(spark, folder, "orders")
    c = table(spark, folder, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_mktsegment").alias("company"),
        F.col("c_name").alias("person"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("sales"),
        "o_orderkey",
    )


SALES = """(SELECT c_mktsegment AS company, c_name AS person,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS sales, o_orderkey
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


# --- flights, weather, planes -------------------------------------------------------------
def flights(spark: SparkSession, folder: str) -> DataFrame:
    """Shipped lines as flights; negative delays and zero air times occur."""
    li = table(spark, folder, "lineitem")
    o = table(spark, folder, "orders")
    s = table(spark, folder, "supplier")
    n = table(spark, folder, "nation")
    delay = F.datediff("l_shipdate", "o_orderdate")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(s, li.l_suppkey == s.s_suppkey)
        .join(n, s.s_nationkey == n.n_nationkey)
        .select(
            F.year("o_orderdate").alias("year"),
            F.month("o_orderdate").alias("month"),
            F.dayofmonth("o_orderdate").alias("day"),
            delay.alias("dep_delay"),
            (delay + F.col("l_quantity").cast("int") - 25).alias("arr_delay"),
            F.least(F.floor(F.col("l_quantity") / 2), F.lit(24)).cast("int").alias("hour"),
            F.col("n_name").alias("origin"),
            F.col("l_suppkey").alias("carrier"),
            F.nullif(F.col("l_suppkey"), F.lit(7)).alias("tailnum"),
            F.round(F.col("l_discount") * 100).alias("air_time"),
            F.col("l_extendedprice").alias("distance"),
        )
    )


FLIGHTS = """(SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(day(o_orderdate) AS INTEGER) AS day,
  CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS dep_delay,
  CAST(date_diff('day', o_orderdate, l_shipdate) + CAST(l_quantity AS INTEGER) - 25 AS INTEGER) AS arr_delay,
  CAST(least(floor(l_quantity / 2), 24) AS INTEGER) AS hour,
  n_name AS origin, l_suppkey AS carrier, nullif(l_suppkey, 7) AS tailnum,
  round(l_discount * 100) AS air_time, l_extendedprice AS distance
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """Event averages per day of the month, one column per event type."""
    e = table(spark, folder, "events")

    def mean_of(kind: str):
        return F.round(F.avg(F.when(F.col("event_type") == kind, F.col("value"))), 6)

    return e.groupBy(F.dayofmonth("ts").alias("day")).agg(
        mean_of("view").alias("temp"),
        mean_of("click").alias("humid"),
        mean_of("purchase").alias("wind_speed"),
        mean_of("signup").alias("pressure"),
        mean_of("error").alias("visib"),
    )


WEATHER = """(SELECT CAST(day(ts) AS INTEGER) AS day,
  round(avg(value) FILTER (WHERE event_type = 'view'), 6) AS temp,
  round(avg(value) FILTER (WHERE event_type = 'click'), 6) AS humid,
  round(avg(value) FILTER (WHERE event_type = 'purchase'), 6) AS wind_speed,
  round(avg(value) FILTER (WHERE event_type = 'signup'), 6) AS pressure,
  round(avg(value) FILTER (WHERE event_type = 'error'), 6) AS visib
  FROM events GROUP BY 1)"""


def planes(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as aircraft; one has no tail number."""
    s = table(spark, folder, "supplier")
    n = table(spark, folder, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.nullif(F.col("s_suppkey"), F.lit(7)).alias("tailnum"),
        (F.col("s_nationkey") + 1970).alias("year"),
        (F.floor(F.col("s_acctbal") / 100) + 20).cast("int").alias("seats"),
        F.col("n_name").alias("manufacturer"),
    )


PLANES = """(SELECT nullif(s_suppkey, 7) AS tailnum, s_nationkey + 1970 AS year,
  CAST(floor(s_acctbal / 100) + 20 AS INTEGER) AS seats, n_name AS manufacturer
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


# --- passengers ---------------------------------------------------------------------------
def passengers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as passengers: unknown outcome, unknown age and blank port all occur."""
    o = table(spark, folder, "orders")
    c = table(spark, folder, "customer")
    n = table(spark, folder, "nation")
    status = F.col("o_orderstatus")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .select(
            F.col("o_orderkey").alias("passenger_id"),
            F.when(status == "F", 1).when(status == "O", 0).alias("survived"),
            (F.col("n_regionkey") + 1).alias("pclass"),
            F.concat(
                F.col("c_mktsegment"),
                F.lit(", "),
                F.substring("o_orderpriority", 3, 20),
                F.lit(". "),
                F.col("c_name"),
            ).alias("name"),
            F.when(F.col("c_acctbal") >= 4500, "female").otherwise("male").alias("sex"),
            F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 110)).cast("int").alias("age"),
            (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("sibsp"),
            F.col("n_regionkey").alias("parch"),
            F.col("o_custkey").alias("ticket"),
            F.when(F.col("c_acctbal") >= -900, F.col("o_totalprice")).alias("fare"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", "")
            .otherwise(F.substring("c_mktsegment", 1, 1))
            .alias("embarked"),
        )
    )


PASSENGERS = """(SELECT o_orderkey AS passenger_id,
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS survived,
  n_regionkey + 1 AS pclass,
  concat(c_mktsegment, ', ', substr(o_orderpriority, 3, 20), '. ', c_name) AS name,
  CASE WHEN c_acctbal >= 4500 THEN 'female' ELSE 'male' END AS sex,
  CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 110) AS INTEGER) END AS age,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS sibsp,
  n_regionkey AS parch, o_custkey AS ticket,
  CASE WHEN c_acctbal >= -900 THEN o_totalprice END AS fare,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE substr(c_mktsegment, 1, 1) END AS embarked
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


# --- monthly totals per segment -----------------------------------------------------------
def monthly(spark: SparkSession, folder: str) -> DataFrame:
    """Order totals per segment and month: at most twelve rows per segment and year."""
    o = table(spark, folder, "orders")
    c = table(spark, folder, "customer")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .groupBy(F.col("c_mktsegment").alias("key"), F.trunc("o_orderdate", "month").alias("t"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("y"))
    )


MONTHLY = """(SELECT c_mktsegment AS key, CAST(date_trunc('month', o_orderdate) AS DATE) AS t,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


# --- daily totals per segment -------------------------------------------------------------
def daily(spark: SparkSession, folder: str) -> DataFrame:
    """Order totals per segment and day, with days missing: bounded by the calendar."""
    o = table(spark, folder, "orders")
    c = table(spark, folder, "customer")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .groupBy(F.col("c_mktsegment").alias("key"), F.to_date("o_orderdate").alias("t"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("y"))
    )


DAILY = """(SELECT c_mktsegment AS key, CAST(o_orderdate AS DATE) AS t,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


# --- prices of a supplier, line by line (keys of any length) ------------------------------
def lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("key"),
        F.col("l_shipdate").alias("t"),
        F.col("l_extendedprice").alias("y"),
        *LINE_ID,
    )


LINES = """(SELECT l_suppkey AS key, l_shipdate AS t, l_extendedprice AS y,
  l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)"""
LINE_ORDER = ["t", "l_orderkey", "l_linenumber", "l_partkey"]
LINE_ORDER_SQL = "t, l_orderkey, l_linenumber, l_partkey"


# --- ratings ------------------------------------------------------------------------------
def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Customers rate suppliers by the size of what they ordered, one to five."""
    li = table(spark, folder, "lineitem")
    o = table(spark, folder, "orders")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .groupBy(F.col("o_custkey").alias("userid"), F.col("l_suppkey").alias("itemid"))
        .agg(F.avg(F.ceil(F.col("l_quantity") / 10)).alias("rating"))
    )


RATINGS = """(SELECT o_custkey AS userid, l_suppkey AS itemid, avg(ceil(l_quantity / 10)) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


def titles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("itemid"), F.col("s_name").alias("title")
    )


TITLES = "(SELECT s_suppkey AS itemid, s_name AS title FROM supplier)"


# --- texts, and the labelled ones -----------------------------------------------------------
def all_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents").select("doc_id", "text")
    lab = table(spark, folder, "labels")
    return d.join(lab, "doc_id").select(
        "doc_id", "text", F.when(F.col("quality") == 1, "pos").otherwise("neg").alias("class")
    )


TEXTS = """(SELECT doc_id, text, CASE WHEN quality = 1 THEN 'pos' ELSE 'neg' END AS class
  FROM documents JOIN labels USING (doc_id))"""


# --- claims: mixed types with nulls -------------------------------------------------------
def claims(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with mixed-type attributes; debtors have no balance, pending ones no class."""
    o = table(spark, folder, "orders")
    c = table(spark, folder, "customer")
    n = table(spark, folder, "nation")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .select(
            F.col("o_orderkey").alias("id"),
            F.when(F.col("o_totalprice") > 250000, 1).otherwise(0).alias("target"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("v10"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("v12"),
            F.month("o_orderdate").alias("v14"),
            F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("v24"),
            F.nullif("o_orderpriority", F.lit("5-LOW")).alias("v47"),
            F.col("n_name").alias("v79"),
        )
    )


CLAIMS = """(SELECT o_orderkey AS id, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS target,
  CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS v10,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v12,
  CAST(month(o_orderdate) AS INTEGER) AS v14,
  nullif(c_mktsegment, 'HOUSEHOLD') AS v24, nullif(o_orderpriority, '5-LOW') AS v47, n_name AS v79
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
