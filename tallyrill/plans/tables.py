"""Queries for sources, sinks, projections, filters, joins, sets and SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrill.functions import scalars as S
from tallyrill.operators import relational as R
from tallyrill.operators.ordered import with_position
from tallyrill.plans import standins as D
from tallyrill.plans.registry import query, table
from tallyrill.session import owned_path
from tallyrill.sources import readers, writers


def fresh(spark, name: str) -> str:
    return owned_path(spark, name)


# --- sources ------------------------------------------------------------------------------
BAR_SCHEMA = "day date, open double, high double, low double, close double, volume bigint"


@query(
    "src01_csv_header",
    f"SELECT strftime(day, '%Y-%m-%d') AS day, open, high, low, close, volume FROM {D.BARS}",
)
def src01(spark, sf):
    path = fresh(spark, "bars")
    writers.write_csv(D.bars(spark, sf), path)
    return readers.read_csv(spark, path, BAR_SCHEMA).withColumn("day", F.col("day").cast("string"))


@query("src02_tab_no_header", f"SELECT doc_id, class, md5(text) AS digest FROM {D.TEXTS}")
def src02(spark, sf):
    path = fresh(spark, "texts")
    """Quoted, so that tabs, quotes and line ends inside a text come back unchanged."""
    D.texts(spark, sf).select("doc_id", "class", "text").write.options(sep="\t", quoteAll=True, escape='"').csv(path)
    read = readers.read_csv(spark, path, "_c0 bigint, _c1 string, _c2 string", sep="\t", header=False, multiLine=True, escape='"')
    return read.select(F.col("_c0").alias("doc_id"), F.col("_c1").alias("class"), F.md5("_c2").alias("digest"))


@query("src03_piped_subset", f"SELECT itemid, title FROM {D.TITLES}")
def src03(spark, sf):
    path = fresh(spark, "titles")
    table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal").write.option("sep", "|").csv(path)
    schema = "itemid bigint, title string, nation int, balance double"
    return readers.read_csv(spark, path, schema, sep="|", header=False, columns=["itemid", "title"])


@query("src04_json_lines", "SELECT c_name AS name, c_nationkey AS age FROM customer")
def src04(spark, sf):
    path = fresh(spark, "people")
    people = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("age"))
    writers.write_json(people, path)
    schema = T.StructType([T.StructField("age", T.IntegerType(), True), T.StructField("name", T.StringType(), True)])
    return readers.read_json(spark, path, schema)


@query("src05_labelled_corpus", f"SELECT class AS label, doc_id, text FROM {D.TEXTS}")
def src05(spark, sf):
    docs = D.texts(spark, sf)
    paths = {label: fresh(spark, label) for label in ("neg", "pos")}
    for label, path in paths.items():
        writers.write_json(docs.filter(F.col("class") == label).select("doc_id", "text"), path)
    return readers.read_labelled_json(spark, paths, "doc_id bigint, text string")


@query("src06_parsed_dates", f"SELECT key, strftime(t, '%Y-%m') AS month, y FROM {D.MONTHLY}")
def src06(spark, sf):
    path = fresh(spark, "monthly")
    writers.write_csv(D.monthly(spark, sf).withColumn("t", F.date_format("t", "yyyy-MM")), path)
    read = readers.read_series_csv(spark, path, "key string, t string, y double", "t", "yyyy-MM")
    return read.select("key", F.date_format("t", "yyyy-MM").alias("month"), "y")


@query(
    "src07_composite_key",
    "SELECT l_returnflag AS poor, count(*) AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity FROM lineitem GROUP BY 1",
)
def src07(spark, sf):
    path = fresh(spark, "keyed")
    part = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    writers.write_csv(part, path)
    schema = "l_orderkey bigint, l_linenumber int, poor string, l_quantity double"
    df, features = readers.read_keyed_csv(spark, path, schema, ["l_orderkey", "l_linenumber"])
    assert features == ["poor", "l_quantity"]
    return df.groupBy("poor").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@query("src08_files_by_name", "SELECT 'orders.parquet' AS file_name, count(*) AS n FROM orders")
def src08(spark, sf):
    schema = table(spark, sf, "orders").schema
    read = readers.read_matching(spark, sf, "*.parquet", "^ord.*", "parquet", schema)
    return read.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))


@query("src09_all_strings", "SELECT CAST(p_size AS VARCHAR) AS size, p_brand AS brand, count(*) AS n FROM part GROUP BY 1, 2")
def src09(spark, sf):
    path = fresh(spark, "part")
    writers.write_csv(table(spark, sf, "part").select("p_size", "p_brand"), path)
    return readers.read_text_columns(spark, path, ["size", "brand"]).groupBy("size", "brand").agg(F.count(F.lit(1)).alias("n"))


@query("src10_declared_schema", "SELECT r_name AS name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def src10(spark, sf):
    n_schema = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_regionkey", T.IntegerType())])
    nations = spark.read.schema(n_schema).parquet(f"{sf}/nation.parquet")
    regions = table(spark, sf, "region")
    joined = nations.join(regions, nations.n_regionkey == regions.r_regionkey)
    return joined.groupBy(F.col("r_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))


# --- sinks --------------------------------------------------------------------------------
@query("snk01_csv_sink", f"SELECT id, target, v14 FROM {D.CLAIMS}")
def snk01(spark, sf):
    path = fresh(spark, "scored")
    writers.write_csv(D.claims(spark, sf).select("id", "target", "v14"), path)
    return readers.read_csv(spark, path, "id bigint, target int, v14 int")


@query("snk02_keyed_csv_sink", f"SELECT id, v79, round(v12, 2) AS v12 FROM {D.CLAIMS}")
def snk02(spark, sf):
    path = fresh(spark, "keyed")
    writers.write_csv(D.claims(spark, sf).select("id", "v79", F.round("v12", 2).alias("v12")), path)
    return readers.read_csv(spark, path, "id bigint, v79 string, v12 double")


@query(
    "snk03_preview_ends",
    """SELECT 'head' AS part, id, day FROM (SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day
       FROM orders ORDER BY o_orderkey LIMIT 5) UNION ALL
       SELECT 'tail' AS part, id, day FROM (SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day
       FROM orders ORDER BY o_orderkey DESC LIMIT 5)""",
)
def snk03(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    )
    head = o.orderBy("id").limit(5).select(F.lit("head").alias("part"), "id", "day")
    tail = o.orderBy(F.col("id").desc()).limit(5).select(F.lit("tail").alias("part"), "id", "day")
    return head.unionByName(tail)


@query(
    "snk04_schema_listing",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{k}' AS kind, count({c}) AS filled FROM {D.PASSENGERS}"
        for c, k in [
            ("passenger_id", "numeric"), ("survived", "numeric"), ("pclass", "numeric"), ("name", "string"),
            ("sex", "string"), ("age", "numeric"), ("sibsp", "numeric"), ("parch", "numeric"),
            ("ticket", "numeric"), ("fare", "numeric"), ("embarked", "string"),
        ]
    ),
)
def snk04(spark, sf):
    return writers.schema_listing(D.passengers(spark, sf))


@query("snk05_table_size", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def snk05(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(li.columns)))


@query(
    "snk06_first_cell",
    f"SELECT strftime(day, '%Y-%m-%d') AS day, volume, round(close - (SELECT avg(close) FROM {D.BARS}), 4) AS above FROM {D.BARS} "
    f"WHERE low = (SELECT min(low) FROM {D.BARS})",
)
def snk06(spark, sf):
    """A single cell used further on stays relational: a scalar subquery, not a collect."""
    b = D.bars(spark, sf)
    low = b.agg(F.min("low")).scalar()
    mean = b.agg(F.avg("close")).scalar()
    return b.filter(F.col("low") == low).select(
        F.col("day").cast("string").alias("day"), "volume", F.round(F.col("close") - mean, 4).alias("above")
    )


# --- projections --------------------------------------------------------------------------
@query("prj01_select", "SELECT o_orderkey, o_totalprice FROM orders")
def prj01(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice")


@query("prj02_add_column", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def prj02(spark, sf):
    return table(spark, sf, "orders").withColumn("year", F.year("o_orderdate")).select("o_orderkey", "year")


@query(
    "prj03_constant_column",
    f"SELECT 1 AS new_column, 'Train' AS flag, count(*) AS n FROM {D.CLAIMS} GROUP BY 1, 2",
)
def prj03(spark, sf):
    flagged = D.claims(spark, sf).withColumns({"new_column": F.lit(1), "flag": F.lit("Train")})
    return flagged.groupBy("new_column", "flag").agg(F.count(F.lit(1)).alias("n"))


@query("prj04_rename", "SELECT s_suppkey AS itemid, s_name AS title, s_acctbal AS balance FROM supplier")
def prj04(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal").toDF("itemid", "name", "s_acctbal")
    return s.withColumnRenamed("name", "title").withColumnsRenamed({"s_acctbal": "balance"})


@query("prj05_drop_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def prj05(spark, sf):
    return table(spark, sf, "customer").drop("c_name", "c_acctbal")


@query("prj06_columns_by_type", "SELECT p_partkey, p_size, p_retailprice FROM part")
def prj06(spark, sf):
    p = table(spark, sf, "part")
    return p.select(*R.columns_by_type(p, "numeric"))


@query("prj07_alias", "SELECT round(avg(o_totalprice), 4) AS avg_price FROM orders")
def prj07(spark, sf):
    return table(spark, sf, "orders").agg(F.round(F.avg("o_totalprice"), 4).alias("avg_price"))


@query(
    "prj08_casts",
    """SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
       CAST(floor(o_totalprice) AS BIGINT) AS whole, TRY_CAST(o_orderpriority AS DOUBLE) AS unreadable FROM orders""",
)
def prj08(spark, sf):
    """Text to number by way of double, and null instead of an error for unreadable text."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("level"),
        F.col("o_totalprice").cast("string").cast("double").cast("bigint").alias("whole"),
        F.col("o_orderpriority").try_cast("double").alias("unreadable"),
    )


@query(
    "prj09_ratio_columns",
    f"SELECT strftime(day, '%Y-%m-%d') AS day, round(high / volume, 6) AS hv_ratio, round(high - low, 2) AS span FROM {D.BARS}",
)
def prj09(spark, sf):
    return D.bars(spark, sf).select(
        F.col("day").cast("string").alias("day"),
        F.round(S.ratio("high", "volume"), 6).alias("hv_ratio"),
        F.round(F.col("high") - F.col("low"), 2).alias("span"),
    )


@query(
    "prj10_point_update",
    f"SELECT passenger_id, CASE WHEN passenger_id = 44 THEN 8.05 ELSE fare END AS fare FROM {D.PASSENGERS}",
)
def prj10(spark, sf):
    p = D.passengers(spark, sf)
    return R.point_update(p, F.col("passenger_id") == 44, "fare", 8.05).select("passenger_id", "fare")


@query(
    "prj11_columns_back",
    f"SELECT id, target, v79, coalesce(v24, 'NA') AS v24, coalesce(v47, 'NA') AS v47 FROM {D.CLAIMS}",
)
def prj11(spark, sf):
    """A subset of columns is changed in place."""
    return D.claims(spark, sf).na.fill("NA", ["v24", "v47"]).select("id", "target", "v79", "v24", "v47")


@query(
    "prj12_id_and_prediction",
    f"SELECT passenger_id, CASE WHEN sex = 'female' THEN 1 ELSE 0 END AS survived FROM {D.PASSENGERS} WHERE survived IS NULL",
)
def prj12(spark, sf):
    rule = F.when(F.col("sex") == "female", 1).otherwise(0)
    return D.passengers(spark, sf).filter(F.col("survived").isNull()).select("passenger_id", rule.alias("survived"))


# --- filters ------------------------------------------------------------------------------
@query("fil01_comparison", f"SELECT count(*) AS n FROM {D.BARS} WHERE close < 30000")
def fil01(spark, sf):
    return D.bars(spark, sf).filter("close < 30000").agg(F.count(F.lit(1)).alias("n"))


@query("fil02_conjunction", f"SELECT strftime(day, '%Y-%m-%d') AS day, open, close FROM {D.BARS} WHERE close < 50000 AND open > 50000")
def fil02(spark, sf):
    b = D.bars(spark, sf).filter((F.col("close") < 50000) & (F.col("open") > 50000))
    return b.select(F.col("day").cast("string").alias("day"), "open", "close")


@query("fil03_sql_where", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 20")
def fil03(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("people")
    return spark.sql("SELECT c_custkey, c_name FROM people WHERE c_nationkey = 20")


@query(
    "fil04_null_and_blank",
    f"SELECT passenger_id, fare, embarked FROM {D.PASSENGERS} WHERE fare IS NULL OR embarked = ''",
)
def fil04(spark, sf):
    p = D.passengers(spark, sf)
    return p.filter(F.col("fare").isNull() | (F.col("embarked") == "")).select("passenger_id", "fare", "embarked")


@query(
    "fil05_membership",
    """SELECT count(*) AS n, count(DISTINCT l_orderkey) AS orders FROM lineitem
       WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)""",
)
def fil05(spark, sf):
    rich = table(spark, sf, "supplier").filter("s_acctbal > 5000").select(F.col("s_suppkey").alias("l_suppkey"))
    kept = R.keep_members(table(spark, sf, "lineitem"), rich, "l_suppkey")
    return kept.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("c")).agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("orders")
    )


@query(
    "fil06_complete_rows",
    f"SELECT id, v10, v12, v24, v47 FROM {D.CLAIMS} WHERE v10 IS NOT NULL AND v12 IS NOT NULL AND v24 IS NOT NULL AND v47 IS NOT NULL",
)
def fil06(spark, sf):
    return D.claims(spark, sf).select("id", "v10", "v12", "v24", "v47").dropna(how="any")


@query(
    "fil07_rows_by_position",
    f"""SELECT key, position, y FROM (SELECT key, y, row_number() OVER (PARTITION BY key ORDER BY {D.LINE_ORDER_SQL}) AS position
        FROM {D.LINES}) WHERE position > 19""",
)
def fil07(spark, sf):
    """All rows after the first 19 of each series, however long a series is."""
    placed = with_position(D.lines(spark, sf), ["key"], D.LINE_ORDER)
    return placed.filter(F.col("position") > 19).select("key", "position", "y")


@query("fil08_share_of_rows", f"SELECT round(100.0 * count(*) FILTER (WHERE high > 104000) / count(*), 6) AS share FROM {D.BARS}")
def fil08(spark, sf):
    out = R.share_where(D.bars(spark, sf), F.col("high") > 104000)
    return out.select(F.round("share", 6).alias("share"))


# --- joins --------------------------------------------------------------------------------
@query(
    "joi01_inner_join",
    f"SELECT userid, itemid, title, round(rating, 6) AS rating FROM {D.RATINGS} JOIN {D.TITLES} USING (itemid)",
)
def joi01(spark, sf):
    joined = D.ratings(spark, sf).join(D.titles(spark, sf), "itemid")
    return joined.select("userid", "itemid", "title", F.round("rating", 6).alias("rating"))


@query(
    "joi02_left_join_null_safe",
    f"""SELECT f.tailnum, p.manufacturer, p.seats, count(*) AS n FROM {D.FLIGHTS} f
        LEFT JOIN {D.PLANES} p ON f.tailnum IS NOT DISTINCT FROM p.tailnum GROUP BY 1, 2, 3""",
)
def joi02(spark, sf):
    joined = R.null_safe_join(D.flights(spark, sf), D.planes(spark, sf).drop("year"), ["tailnum"])
    return joined.groupBy("tailnum", "manufacturer", "seats").agg(F.count(F.lit(1)).alias("n"))


@query(
    "joi03_natural_left_join",
    f"""SELECT f.month, f.day, count(*) AS n, round(avg(w.temp), 4) AS temp, round(avg(w.visib), 4) AS visib
        FROM {D.FLIGHTS} f LEFT JOIN {D.WEATHER} w ON f.day = w.day GROUP BY 1, 2""",
)
def joi03(spark, sf):
    joined = R.natural_left_join(D.flights(spark, sf), D.weather(spark, sf))
    return joined.groupBy("month", "day").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("temp"), 4).alias("temp"), F.round(F.avg("visib"), 4).alias("visib")
    )


@query(
    "joi04_join_on_id",
    f"""SELECT a.id, a.v14, b.v79 FROM (SELECT id, v14 FROM {D.CLAIMS}) a
        JOIN (SELECT id, v79 FROM {D.CLAIMS} WHERE v12 IS NOT NULL) b ON a.id = b.id""",
)
def joi04(spark, sf):
    c = D.claims(spark, sf)
    return c.select("id", "v14").join(c.filter(F.col("v12").isNotNull()).select("id", "v79"), "id")


@query(
    "joi05_anti_join",
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
       (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""",
)
def joi05(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    big = table(spark, sf, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return R.drop_members(c, big, "c_custkey")


@query(
    "joi06_semi_join_derived",
    f"""SELECT passenger_id, ticket FROM {D.PASSENGERS} WHERE ticket IN
        (SELECT ticket FROM {D.PASSENGERS} GROUP BY ticket HAVING count(*) <= 5)""",
)
def joi06(spark, sf):
    p = D.passengers(spark, sf).select("passenger_id", "ticket")
    return R.with_group_size(p, ["ticket"], "n").filter("n <= 5").drop("n")


# --- sets and reshaping -------------------------------------------------------------------
@query(
    "set01_union_by_name",
    f"""SELECT id, target, flag, count(*) AS n FROM (
        SELECT v14 AS id, target, 'Train' AS flag FROM {D.CLAIMS} WHERE v12 IS NOT NULL UNION ALL
        SELECT v14 AS id, NULL AS target, 'Test' AS flag FROM {D.CLAIMS} WHERE v12 IS NULL) GROUP BY 1, 2, 3""",
)
def set01(spark, sf):
    c = D.claims(spark, sf).withColumn("id", F.col("v14"))
    train = c.filter(F.col("v12").isNotNull()).select("id", "target", F.lit("Train").alias("flag"))
    test = c.filter(F.col("v12").isNull()).select(F.lit("Test").alias("flag"), "id")
    return R.stack_rows(train, test).groupBy("id", "target", "flag").agg(F.count(F.lit(1)).alias("n"))


@query("set02_distinct_values", f"SELECT DISTINCT ticket FROM {D.PASSENGERS}")
def set02(spark, sf):
    return D.passengers(spark, sf).select("ticket").distinct()


@query(
    "set03_category_drift",
    f"""WITH a AS (SELECT DISTINCT c, v FROM (SELECT 'v14' AS c, CAST(v14 AS VARCHAR) AS v FROM {D.CLAIMS} WHERE v12 IS NOT NULL
          UNION ALL SELECT 'v10' AS c, CAST(CAST(floor(v10) AS BIGINT) AS VARCHAR) AS v FROM {D.CLAIMS} WHERE v12 IS NOT NULL
          UNION ALL SELECT 'v79' AS c, v79 AS v FROM {D.CLAIMS} WHERE v12 IS NOT NULL) WHERE v IS NOT NULL),
        b AS (SELECT DISTINCT c, v FROM (SELECT 'v14' AS c, CAST(v14 AS VARCHAR) AS v FROM {D.CLAIMS} WHERE v12 IS NULL
          UNION ALL SELECT 'v10' AS c, CAST(CAST(floor(v10) AS BIGINT) AS VARCHAR) AS v FROM {D.CLAIMS} WHERE v12 IS NULL
          UNION ALL SELECT 'v79' AS c, v79 AS v FROM {D.CLAIMS} WHERE v12 IS NULL) WHERE v IS NOT NULL)
        SELECT c AS "column", v AS value, 'first' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
        UNION ALL SELECT c AS "column", v AS value, 'second' AS only_in FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def set03(spark, sf):
    c = D.claims(spark, sf).withColumn("v10", F.floor("v10"))
    return R.category_drift(
        c.filter(F.col("v12").isNotNull()), c.filter(F.col("v12").isNull()), ["v14", "v10", "v79"]
    )


MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


@query(
    "set04_seasonal_pivot",
    f"SELECT key, CAST(year(t) AS INTEGER) AS year, "
    + ", ".join(f"round(avg(y) FILTER (WHERE month(t) = {i + 1}), 2) AS {m}" for i, m in enumerate(MONTHS))
    + f" FROM {D.MONTHLY} GROUP BY 1, 2",
)
def set04(spark, sf):
    m = D.monthly(spark, sf).withColumns({"year": F.year("t"), "m": S.month_short("t")})
    wide = R.pivot_mean(m, ["key", "year"], "m", MONTHS, "y")
    return wide.select("key", "year", *[F.round(c, 2).alias(c) for c in MONTHS])


@query(
    "set05_pivot_column_order",
    "SELECT o_orderpriority AS priority, "
    + ", ".join(f"count(*) FILTER (WHERE o_orderstatus = '{s}') AS {s}" for s in ("P", "O", "F"))
    + " FROM orders GROUP BY 1",
)
def set05(spark, sf):
    wide = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).pivot("o_orderstatus", ["P", "O", "F"]).count()
    return wide.na.fill(0)


# --- SQL ----------------------------------------------------------------------------------
@query("sql01_temp_view", "SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def sql01(spark, sf):
    for name in ("customer", "nation"):
        table(spark, sf, name).createOrReplaceTempView(name)
    return spark.sql("SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")


@query(
    "sql02_sql_text",
    "SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS quantity, count(*) AS n FROM lineitem "
    "WHERE l_shipdate <= TIMESTAMP '2000-09-02' GROUP BY 1, 2",
)
def sql02(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("lineitem")
    return spark.sql(
        """SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS quantity, count(*) AS n
           FROM lineitem WHERE l_shipdate <= TIMESTAMP_NTZ '2000-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus"""
    )
