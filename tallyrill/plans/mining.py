"""Queries for missing data, recommenders, splits, metrics, text and neighbours."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tallyrill.functions import scalars as S
from tallyrill.operators import evaluate as E
from tallyrill.operators import impute as I
from tallyrill.operators import matching as MT
from tallyrill.operators import neighbors as N
from tallyrill.operators import recommend as RC
from tallyrill.operators import splits as SP
from tallyrill.operators import strata as SG
from tallyrill.operators import text as X
from tallyrill.plans import standins as D
from tallyrill.plans.registry import query, table
from tallyrill.session import stage


# --- scalar functions ---------------------------------------------------------------------
@query(
    "sca01_date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       strftime(o_orderdate, '%b') AS mon, strftime(o_orderdate, '%Y-%m-%d') || ' 12:00:00' AS noon FROM orders""",
)
def sca01(spark, sf):
    o = table(spark, sf, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    noon = S.noon_of(F.col("year"), F.col("month"), F.dayofmonth("o_orderdate"))
    return o.select("o_orderkey", "year", "month", S.month_short("o_orderdate").alias("mon"), noon.cast("string").alias("noon"))


@query(
    "sca05_calendar_months",
    """SELECT strftime(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)), '%Y-%m') AS month FROM orders""",
)
def sca05(spark, sf):
    ends = table(spark, sf, "orders").agg(
        F.trunc(F.min("o_orderdate"), "month").alias("lo"), F.trunc(F.max("o_orderdate"), "month").alias("hi")
    )
    months = ends.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("t"))
    return months.select(F.date_format("t", "yyyy-MM").alias("month"))


@query(
    "sca08_logs_and_rounding",
    """SELECT o_orderkey, round(ln(o_totalprice), 6) AS log_price, round(exp(ln(o_totalprice)), 2) AS back,
       round_even(o_totalprice / 1000, 0) AS thousands, round(sqrt(o_totalprice), 6) AS root FROM orders""",
)
def sca08(spark, sf):
    p = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.round(F.ln(p), 6).alias("log_price"),
        F.round(F.exp(F.ln(p)), 2).alias("back"),
        S.half_even(p / 1000, 0).alias("thousands"),
        F.round(F.sqrt(p), 6).alias("root"),
    )


@query(
    "sca10_norm_and_dot",
    """SELECT e.vec_id, round(sqrt(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 5) AS norm,
       round(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(n.embedding AS DOUBLE[])), 5) AS with_next
       FROM embeddings e LEFT JOIN embeddings n ON n.vec_id = e.vec_id + 1""",
)
def sca10(spark, sf):
    """Length of each vector, and its dot product with the vector of the next id."""
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w"))
    return e.join(after, "vec_id", "left").select("vec_id", F.round(S.norm("v"), 5).alias("norm"), F.round(S.dot("v", "w"), 5).alias("with_next"))


@query("sca06_run_stamp", "SELECT r_regionkey, true AS parses, true AS in_run FROM region")
def sca06(spark, sf):
    """The time of the run as text: it can be read back, and lies between the start of the query and now."""
    start = datetime.datetime.now(datetime.UTC).replace(tzinfo=None) - datetime.timedelta(seconds=1)
    stamp = F.date_format(F.convert_timezone(None, F.lit("UTC"), F.localtimestamp()), "yyyy-MM-dd-HH-mm-ss")
    back = F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd-HH-mm-ss")).cast("timestamp_ntz")
    return table(spark, sf, "region").select("r_regionkey", back.isNotNull().alias("parses"), (back >= F.lit(start.replace(microsecond=0))).alias("in_run"))


@query(
    "sca12_clamped_delays",
    f"""SELECT CASE WHEN arr_delay >= 0 THEN arr_delay ELSE 0 END + CASE WHEN dep_delay >= 0 THEN dep_delay ELSE 0 END AS total_delay, count(*) AS n
        FROM {D.FLIGHTS} GROUP BY 1""",
)
def sca12(spark, sf):
    total = S.at_least_zero("arr_delay") + S.at_least_zero("dep_delay")
    return D.flights(spark, sf).groupBy(total.alias("total_delay")).agg(F.count(F.lit(1)).alias("n"))


FARE_BANDS = [(100000, "ten-"), (200000, "ten+"), (300000, "twenty+")]


@query(
    "sca13_range_labels",
    f"""SELECT CASE WHEN sibsp + parch + 1 = 1 THEN 'Single' WHEN sibsp + parch + 1 < 5 THEN 'Small' ELSE 'Big' END AS family,
        CASE WHEN age < 10 THEN 'kid' WHEN age > 80 THEN 'old' ELSE 'adult' END AS child,
        CASE WHEN fare < 100000 THEN 'ten-' WHEN fare < 200000 THEN 'ten+' WHEN fare < 300000 THEN 'twenty+' ELSE 'thirty+' END AS fare2,
        count(*) AS n FROM {D.PASSENGERS} GROUP BY 1, 2, 3""",
)
def sca13(spark, sf):
    p = D.passengers(spark, sf)
    child = F.when(F.col("age") < 10, "kid").when(F.col("age") > 80, "old").otherwise("adult")
    return p.groupBy(
        S.party_label(F.col("sibsp") + F.col("parch") + 1).alias("family"),
        child.alias("child"),
        S.banded("fare", FARE_BANDS, "thirty+").alias("fare2"),
    ).agg(F.count(F.lit(1)).alias("n"))


TITLE_GROUPS = {"URGENT": "Officer", "HIGH": "Officer", "MEDIUM": "Mr", "LOW": "Miss"}


@query(
    "sca14_recode_titles",
    f"""SELECT passenger_id, CASE regexp_replace(name, '^.*, (.*?)\\..*$', '\\1') WHEN 'URGENT' THEN 'Officer' WHEN 'HIGH' THEN 'Officer'
        WHEN 'MEDIUM' THEN 'Mr' WHEN 'LOW' THEN 'Miss' ELSE regexp_replace(name, '^.*, (.*?)\\..*$', '\\1') END AS title,
        CASE WHEN passenger_id = 44 THEN 'one' ELSE 'other' END AS flag FROM {D.PASSENGERS}""",
)
def sca14(spark, sf):
    p = D.passengers(spark, sf)
    flag = F.when(F.col("passenger_id") == 44, "one").otherwise("other")
    return p.select("passenger_id", S.recode(S.title_in("name"), TITLE_GROUPS).alias("title"), flag.alias("flag"))


@query(
    "sca15_compound_flag",
    f"""SELECT CASE WHEN sex = 'female' AND parch > 0 AND age > 18 AND sibsp <> 4 THEN 'Mother' ELSE 'Not Mother' END AS mother, count(*) AS n
        FROM {D.PASSENGERS} GROUP BY 1""",
)
def sca15(spark, sf):
    is_mother = (F.col("sex") == "female") & (F.col("parch") > 0) & (F.col("age") > 18) & (F.col("sibsp") != 4)
    mother = F.when(is_mother, "Mother").otherwise("Not Mother")
    return D.passengers(spark, sf).groupBy(mother.alias("mother")).agg(F.count(F.lit(1)).alias("n"))


@query("sca16_signed_labels", f"SELECT doc_id, CASE WHEN class = 'neg' THEN -1 ELSE 1 END AS label FROM {D.TEXTS}")
def sca16(spark, sf):
    return D.texts(spark, sf).select("doc_id", S.signed_label("class").alias("label"))


@query(
    "sca17_name_parts",
    f"""SELECT passenger_id, regexp_replace(name, '^.*, (.*?)\\..*$', '\\1') AS title, regexp_split_to_array(name, '[,.]')[1] AS surname,
        concat(CAST(sibsp + parch + 1 AS VARCHAR), regexp_split_to_array(name, '[,.]')[1]) AS family_id FROM {D.PASSENGERS}""",
)
def sca17(spark, sf):
    size = (F.col("sibsp") + F.col("parch") + 1).cast("string")
    return D.passengers(spark, sf).select(
        "passenger_id", S.title_in("name").alias("title"), S.surname_in("name").alias("surname"),
        F.concat(size, S.surname_in("name")).alias("family_id"),
    )


@query(
    "sca20_text_tests",
    "SELECT doc_id, length(text) AS length, contains(lower(text), 'the') AS has_the, starts_with(lower(text), 'a') AS starts_a FROM documents",
)
def sca20(spark, sf):
    low = F.lower("text")
    return table(spark, sf, "documents").select(
        "doc_id", F.length("text").alias("length"), F.contains(low, F.lit("the")).alias("has_the"), F.startswith(low, F.lit("a")).alias("starts_a")
    )


@query(
    "sca24_seeded_shuffle",
    f"SELECT o_orderkey, round({S.hash_unit_sql('o_orderkey', 3)}, 9) AS draw FROM orders ORDER BY draw",
)
def sca24(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.round(S.hash_unit("o_orderkey", 3), 9).alias("draw")).orderBy("draw", "o_orderkey")


# --- missing data -------------------------------------------------------------------------
@query("imp01_fill_constant", f"SELECT company, person, o_orderkey, coalesce(sales, 0) AS sales FROM {D.SALES}")
def imp01(spark, sf):
    return I.fill_constant(D.sales(spark, sf), 0, ["sales"])


@query(
    "imp02_fill_mean",
    f"""SELECT id, round(coalesce(v10, (SELECT avg(v10) FROM {D.CLAIMS})), 4) AS v10,
        round(coalesce(v12, (SELECT avg(v12) FROM {D.CLAIMS})), 4) AS v12 FROM {D.CLAIMS}""",
)
def imp02(spark, sf):
    out = I.fill_mean(D.claims(spark, sf), ["v10", "v12"])
    return out.select("id", F.round("v10", 4).alias("v10"), F.round("v12", 4).alias("v12"))


def mode_sql(c: str, source: str = D.CLAIMS) -> str:
    return f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "imp03_fill_category_mode",
    f"SELECT id, coalesce(v24, {mode_sql('v24')}) AS v24, coalesce(v47, {mode_sql('v47')}) AS v47 FROM {D.CLAIMS}",
)
def imp03(spark, sf):
    c = D.claims(spark, sf)
    model = I.CategoryImputer(inputCols=["v24", "v47"]).fit(c)
    return model.transform(c).select("id", "v24", "v47")


@query("imp03_fill_category_constant", f"SELECT id, coalesce(v24, 'NA') AS v24, coalesce(v47, 'NA') AS v47 FROM {D.CLAIMS}")
def imp03b(spark, sf):
    c = D.claims(spark, sf)
    return I.CategoryImputer(inputCols=["v24", "v47"], strategy="constant").fit(c).transform(c).select("id", "v24", "v47")


@query(
    "imp04_fill_numeric_mode",
    f"SELECT passenger_id, CAST(coalesce(age, {mode_sql('age', D.PASSENGERS)}) AS DOUBLE) AS age FROM {D.PASSENGERS}",
)
def imp04(spark, sf):
    p = D.passengers(spark, sf).withColumn("age", F.col("age").cast("double"))
    return I.numeric_mode_imputer(["age"]).fit(p).transform(p).select("passenger_id", "age")


@query(
    "imp05_fill_by_group",
    f"""WITH p AS (SELECT passenger_id, pclass, fare, CASE WHEN embarked = '' THEN (SELECT embarked FROM {D.PASSENGERS} WHERE fare > 400000 AND embarked <> ''
          GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) ELSE embarked END AS embarked FROM {D.PASSENGERS})
        SELECT passenger_id, embarked, round(coalesce(fare, median(fare) OVER (PARTITION BY pclass, embarked)), 4) AS fare FROM p""",
)
def imp05(spark, sf):
    p = I.fill_blank_by_frequent(D.passengers(spark, sf), "embarked", F.col("fare") > 400000)
    out = I.fill_group_median(p, ["pclass", "embarked"], "fare")
    return out.select("passenger_id", "embarked", F.round("fare", 4).alias("fare"))


def chained_sql(rounds: int) -> str:
    steps = [
        f"w0 AS (SELECT id, v10 IS NULL AS g10, v12 IS NULL AS g12, coalesce(v10, (SELECT avg(v10) FROM {D.CLAIMS})) AS v10, "
        f"coalesce(v12, (SELECT avg(v12) FROM {D.CLAIMS})) AS v12 FROM {D.CLAIMS})"
    ]
    n = 0
    for _ in range(rounds):
        for y, x in (("v10", "v12"), ("v12", "v10")):
            g = "g" + y[1:]
            fit = f"(SELECT regr_intercept({y}, {x}) AS a, regr_slope({y}, {x}) AS b FROM w{n} WHERE NOT {g})"
            steps.append(
                f"w{n + 1} AS (SELECT id, g10, g12, {x}, CASE WHEN {g} THEN f.a + f.b * {x} ELSE {y} END AS {y} FROM w{n}, {fit} f)"
            )
            n += 1
    return f"WITH {', '.join(steps)} SELECT id, round(v10, 2) AS v10, round(v12, 1) AS v12 FROM w{n}"


@query("imp06_chained_linear", chained_sql(2))
def imp06(spark, sf):
    out = I.fill_chained(D.claims(spark, sf).select("id", "v10", "v12"), ["v10", "v12"], rounds=2)
    return out.select("id", F.round("v10", 2).alias("v10"), F.round("v12", 1).alias("v12"))


@query("imp06_chained_forest")
def imp06b(spark, sf):
    """The same with tree learners: no SQL form, so the counts of filled cells are reported."""
    c = D.claims(spark, sf).select("id", "v10", "v12", "v14", "target")
    out = I.fill_chained(c, ["v10", "v12"], ["v14", "target"], rounds=1, method="forest")
    return out.agg(F.count("v10").alias("v10"), F.count("v12").alias("v12"), F.round(F.avg("v10"), 2).alias("mean_v10"))


def matched_sql(donors: int) -> str:
    """The nearest observed rows by the line through them, all pairs compared."""
    return f"""WITH w AS (SELECT id, v10, coalesce(v12, (SELECT avg(v12) FROM {D.CLAIMS})) AS v12 FROM {D.CLAIMS}),
      c AS (SELECT id, v10, v12 - (SELECT avg(v12) FROM w) AS x FROM w), f AS (SELECT regr_intercept(v10, x) AS a, regr_slope(v10, x) AS b FROM c WHERE v10 IS NOT NULL),
      p AS (SELECT id, v10, round(a + b * x, {MT.PLACES}) AS at FROM c, f),
      n AS (SELECT r.id, d.id AS donor, d.v10 AS value, row_number() OVER (PARTITION BY r.id ORDER BY abs(d.at - r.at), d.at, d.id) AS place
        FROM p r, p d WHERE r.v10 IS NULL AND d.v10 IS NOT NULL)
      SELECT id, donor, round(value, 4) AS value FROM n WHERE place <= {donors}"""


@query("imp06_matched_nearest", matched_sql(1))
def imp06c(spark, sf):
    """The value of the observed row whose prediction is nearest, for each gap."""
    drawn = MT.matched_draws(D.claims(spark, sf).select("id", "v10", "v12"), "id", "v10", ["v12"], draws=0, donors=1)
    return drawn.select("id", "donor", F.round("value", 4).alias("value"))


@query("imp06_pooled_means")
def imp06d(spark, sf):
    """Mean of a column with gaps by five imputations, with the variance within and between them."""
    c = stage(D.claims(spark, sf).select("id", "v10", "v12", "v14"), "claims")
    tables = MT.completed(c, "id", "v10", MT.matched_draws(c, "id", "v10", ["v12", "v14"]).where("draw > 0"))
    each = tables.groupBy("draw").agg(F.avg("v10").alias("estimate"), (F.var_samp("v10") / F.count("v10")).alias("variance"))
    return MT.pooled(each)


# --- recommenders -------------------------------------------------------------------------
def rated(spark, sf):
    """Ratings written once: the steps below read them several times."""
    return stage(D.ratings(spark, sf), "ratings")


def active_users(ratings):
    """The users asked about: every one whose id is divisible by 20, and the one with fewest ratings, five at least."""
    counts = ratings.groupBy("userid").agg(F.count(F.lit(1)).alias("n")).filter("n >= 5")
    least = counts.orderBy("n", "userid").limit(1).select("userid")
    return ratings.filter("userid % 20 = 0").select("userid").union(least).distinct()


COUNTED = f"(SELECT userid, count(*) AS n FROM {D.RATINGS} GROUP BY 1 HAVING count(*) >= 5)"
ACTIVE = f"((SELECT userid FROM {D.RATINGS} WHERE userid % 20 = 0) UNION (SELECT userid FROM {COUNTED} ORDER BY n, 1 LIMIT 1))"
REC_SQL = f"""WITH r AS (SELECT * FROM {D.RATINGS}), a AS (SELECT userid FROM {ACTIVE}),
  m AS (SELECT userid, avg(rating) AS m FROM r GROUP BY 1),
  s AS (SELECT x.userid AS active, y.userid AS neighbour, count(*) AS shared, CASE WHEN count(*) >= 2
    THEN round(coalesce(covar_pop(x.rating, y.rating) / nullif(stddev_pop(x.rating) * stddev_pop(y.rating), 0), 0), 9) ELSE 0 END AS sim
    FROM r x JOIN r y ON x.itemid = y.itemid AND x.userid <> y.userid WHERE x.userid IN (SELECT userid FROM a) GROUP BY 1, 2),
  k AS (SELECT active, neighbour, shared, sim FROM (SELECT *, row_number() OVER (PARTITION BY active ORDER BY sim DESC, neighbour) AS i FROM s) WHERE i <= 10),
  p AS (SELECT k.active, r.itemid, max(ma.m) + coalesce(sum(k.sim * (r.rating - mv.m)) / nullif(sum(abs(k.sim)), 0), 0) AS predicted
    FROM k JOIN r ON r.userid = k.neighbour JOIN m mv ON mv.userid = k.neighbour JOIN m ma ON ma.userid = k.active GROUP BY 1, 2) """


@query("rec01_ratings_per_user", f"SELECT userid, count(*) AS n FROM {D.RATINGS} GROUP BY 1")
def rec01(spark, sf):
    return D.ratings(spark, sf).groupBy("userid").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "userid")


@query("rec01_ratings_per_title", f"SELECT title, count(*) AS n FROM {D.RATINGS} JOIN {D.TITLES} USING (itemid) GROUP BY 1")
def rec01b(spark, sf):
    per = D.ratings(spark, sf).groupBy("itemid").agg(F.count(F.lit(1)).alias("n"))
    return per.join(D.titles(spark, sf), "itemid").groupBy("title").agg(F.sum("n").alias("n"))


@query(
    "rec02_favourites",
    f"""SELECT userid, title, round(rating, 6) AS rating FROM {D.RATINGS} JOIN {D.TITLES} USING (itemid)
        WHERE userid IN (SELECT userid FROM {ACTIVE}) QUALIFY row_number() OVER (PARTITION BY userid ORDER BY rating DESC, title) <= 5""",
)
def rec02(spark, sf):
    r = rated(spark, sf)
    mine = r.join(active_users(r), "userid", "left_semi")
    return RC.favourites(mine, D.titles(spark, sf), 5).select("userid", "title", F.round("rating", 6).alias("rating"))


def sims(r, nearest=None):
    return RC.similarity(r, active_users(r), nearest=nearest)


@query("rec03_similarity", REC_SQL + "SELECT active, neighbour, shared, sim FROM s")
def rec03(spark, sf):
    return sims(rated(spark, sf))


@query(
    "joi07_co_rated_pairs",
    f"""SELECT x.userid AS active, y.userid AS neighbour, count(*) AS shared FROM {D.RATINGS} x JOIN {D.RATINGS} y ON x.itemid = y.itemid AND x.userid <> y.userid
        WHERE x.userid IN (SELECT userid FROM {ACTIVE}) GROUP BY 1, 2""",
)
def joi07(spark, sf):
    return sims(rated(spark, sf)).select("active", "neighbour", "shared")


@query("rec04_nearest_users", REC_SQL + "SELECT active, neighbour, shared, sim FROM k")
def rec04(spark, sf):
    return RC.nearest_users(sims(rated(spark, sf), nearest=10), 10)


@query("rec05_predicted_ratings", REC_SQL + "SELECT active, itemid, round(predicted, 5) AS predicted FROM p")
def rec05(spark, sf):
    r = rated(spark, sf)
    return RC.predict_from_neighbours(r, RC.nearest_users(sims(r, nearest=10), 10)).withColumn("predicted", F.round("predicted", 5))


@query(
    "rec06_unseen_top",
    REC_SQL
    + f"""SELECT active, itemid, title, predicted FROM (SELECT active, itemid, round(predicted, 6) AS predicted FROM p
          WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.userid = p.active AND r.itemid = p.itemid)
          QUALIFY row_number() OVER (PARTITION BY active ORDER BY round(predicted, 6) DESC, itemid) <= 5)
          JOIN {D.TITLES} USING (itemid)""",
)
def rec06(spark, sf):
    r = rated(spark, sf)
    predicted = RC.predict_from_neighbours(r, RC.nearest_users(sims(r, nearest=10), 10))
    return RC.unseen_top(predicted, r, D.titles(spark, sf), 5)


@query("rec07_factor_error")
def rec07(spark, sf):
    """Training error of the two-factor model after few and after more steps."""
    r = rated(spark, sf)
    out = None
    for steps in (1, 10):
        scored = RC.factorise(r, 2, 0.02, steps).score(r)
        row = scored.agg(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).alias("rmse")).withColumn("steps", F.lit(steps))
        out = row if out is None else out.unionByName(row)
    return out


@query("rec07_check_equations", f"SELECT count(DISTINCT userid) AS users, true AS solved FROM {D.RATINGS}")
def rec07b(spark, sf):
    """Each user's factors solve the normal equations of the ratings, given those of the items."""
    r = rated(spark, sf)
    m = RC.factorise(r, 2, 0.02, 10)
    u = m.model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("u"))
    v = m.model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("v"))
    each = m.coded(r).join(v, "item").select("user", F.col("rating").cast("float").cast("double").alias("r"), *[F.col("v")[i].cast("double").alias(f"v{i}") for i in range(2)])
    sums = each.groupBy("user").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"s{i}{j}") for i in range(2) for j in range(2)], *[F.sum(F.col(f"v{i}") * F.col("r")).alias(f"t{i}") for i in range(2)])
    both = sums.join(u, "user")
    gaps = [F.abs(F.col(f"s{i}0") * F.col("u")[0] + F.col(f"s{i}1") * F.col("u")[1] + 0.02 * F.col("n") * F.col("u")[i] - F.col(f"t{i}")) / F.col("n") for i in range(2)]
    return both.agg(F.count(F.lit(1)).alias("users"), F.every((gaps[0] < 1e-3) & (gaps[1] < 1e-3)).alias("solved"))


@query("rec07_gradient_error")
def rec07c(spark, sf):
    """Error after each epoch of gradient steps over strata."""
    made = SG.factorise_by_strata(rated(spark, sf), 2, blocks=4, rate=0.01, epochs=3)
    return spark.createDataFrame(list(enumerate(made.errors, 1)), "epoch int, error double")


@query("rec08_factor_top")
def rec08(spark, sf):
    r = rated(spark, sf)
    return RC.factor_unseen_top(RC.factorise(r), r, active_users(r), D.titles(spark, sf), 5)


# --- splits -------------------------------------------------------------------------------
@query(
    "spl01_random_split",
    f"SELECT o_orderkey, CASE WHEN {S.hash_unit_sql('o_orderkey', 45)} < 0.7 THEN 'train' ELSE 'test' END AS split FROM orders",
)
def spl01(spark, sf):
    return SP.random_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.7)


@query(
    "spl02_stratified_split",
    f"""SELECT id, target, CASE WHEN row_number() OVER (PARTITION BY target ORDER BY {S.hash_unit_sql('id', 500)}, id)
        <= ceil(0.8::DOUBLE * count(*) OVER (PARTITION BY target)) THEN 'train' ELSE 'test' END AS split FROM {D.CLAIMS}""",
)
def spl02(spark, sf):
    return SP.stratified_split(D.claims(spark, sf).select("id", "target"), "id", "target", 0.8)


@query(
    "spl03_split_by_presence",
    f"SELECT passenger_id, CASE WHEN survived IS NOT NULL THEN 'train' ELSE 'test' END AS split FROM {D.PASSENGERS}",
)
def spl03(spark, sf):
    return SP.split_by_presence(D.passengers(spark, sf), "survived").select("passenger_id", "split")


@query("spl04_features_and_label", f"SELECT target, v10, v12, v14, v24, v47, v79 FROM {D.CLAIMS}")
def spl04(spark, sf):
    c = D.claims(spark, sf)
    return c.select("target", *SP.features_and_label(c, ["id"], "target"))


@query(
    "spl05_shuffled_head",
    f"""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {S.hash_unit_sql('doc_id', 1)}, doc_id) <= 280 THEN 'train' ELSE 'test' END AS split FROM {D.TEXTS}""",
)
def spl05(spark, sf):
    return SP.shuffled_head(D.texts(spark, sf).select("doc_id"), "doc_id", 280)


# --- metrics ------------------------------------------------------------------------------
SCORED = f"""(SELECT passenger_id, survived AS label, round(least(greatest(age / 100.0 + sibsp / 20.0, 0.01), 0.99), 4) AS p,
  CASE WHEN round(least(greatest(age / 100.0 + sibsp / 20.0, 0.01), 0.99), 4) > 0.5 THEN 1 ELSE 0 END AS prediction,
  CASE WHEN {S.hash_unit_sql('passenger_id', 45)} < 0.8 THEN 'train' ELSE 'validation' END AS split
  FROM {D.PASSENGERS} WHERE survived IS NOT NULL AND age IS NOT NULL)"""


def scored(spark, sf):
    """Known outcomes with a rule-made probability, so that metrics have a SQL twin."""
    p = D.passengers(spark, sf).filter(F.col("survived").isNotNull() & F.col("age").isNotNull())
    prob = F.round(F.least(F.greatest(F.col("age") / 100.0 + F.col("sibsp") / 20.0, F.lit(0.01)), F.lit(0.99)), 4)
    s = p.select("passenger_id", F.col("survived").alias("label"), prob.alias("p"))
    split = F.when(S.hash_unit("passenger_id", 45) < 0.8, "train").otherwise("validation")
    return s.withColumns({"prediction": E.threshold("p"), "split": split})


@query("ml21_threshold", f"SELECT passenger_id, p, prediction FROM {SCORED}")
def ml21(spark, sf):
    return scored(spark, sf).select("passenger_id", "p", "prediction")


F1_SQL = f"""SELECT round(sum(f * actual) / sum(actual), 6) AS f1 FROM (SELECT c, actual, 2.0 * tp / (actual + called) AS f FROM
  (SELECT label AS c, count(*) AS actual, count(*) FILTER (WHERE prediction = label) AS tp FROM {SCORED} GROUP BY 1) JOIN
  (SELECT prediction AS c, count(*) AS called FROM {SCORED} GROUP BY 1) USING (c))"""


@query("eva01_weighted_f1", F1_SQL)
def eva01(spark, sf):
    return E.weighted_f1(scored(spark, sf)).select(F.round("f1", 6).alias("f1"))


@query(
    "eva02_area_under_roc",
    f"""SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM (SELECT pos, neg,
        coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM
        (SELECT p, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM {SCORED} GROUP BY 1))""",
)
def eva02(spark, sf):
    return E.area_under_roc(scored(spark, sf), "label", "p").select(F.round("auc", 6).alias("auc"))


@query(
    "eva03_confusion",
    f"""SELECT l.v AS label, p.v AS prediction, count(s.label) AS n FROM (VALUES (0), (1)) l(v) CROSS JOIN (VALUES (0), (1)) p(v)
        LEFT JOIN {SCORED} s ON s.label = l.v AND s.prediction = p.v GROUP BY 1, 2""",
)
def eva03(spark, sf):
    return E.confusion(scored(spark, sf), [0, 1])


@query("eva04_accuracy", f"SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) * 100, 6) AS accuracy FROM {SCORED}")
def eva04(spark, sf):
    return scored(spark, sf).agg(F.round(E.accuracy(), 6).alias("accuracy"))


LOSS = "avg(CASE WHEN label = 1 THEN -ln(p) ELSE -ln(1 - p) END)"


@query("eva05_log_loss", f"SELECT round({LOSS}, 6) AS log_loss FROM {SCORED}")
def eva05(spark, sf):
    return scored(spark, sf).agg(F.round(E.log_loss(), 6).alias("log_loss"))


@query(
    "eva06_compare_splits",
    f"""SELECT split, count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) * 100, 6) AS accuracy,
        round({LOSS}, 6) AS log_loss FROM {SCORED} GROUP BY 1""",
)
def eva06(spark, sf):
    out = E.compare_splits(scored(spark, sf))
    return out.withColumns({"accuracy": F.round("accuracy", 6), "log_loss": F.round("log_loss", 6)})


# --- text ---------------------------------------------------------------------------------
TOKENS = r"regexp_extract_all(lower(text), 'https?://[^\s]+|[@#][A-Za-z0-9_]+|[\p{L}\p{N}'']+|[^\s\p{L}\p{N}]')"
STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in dict.fromkeys([*X.STOP_WORDS, *X.STOP_SIGNS]))
CONTENT = f"""term NOT LIKE '%http%' AND term NOT LIKE '#%' AND term NOT LIKE '%@%' AND length(term) >= 3 AND term NOT IN ({STOP_SQL})"""
WORDS = f"(SELECT doc_id, term FROM (SELECT doc_id, unnest({TOKENS}) AS term FROM documents) WHERE {CONTENT})"
LABELLED_WORDS = f"(SELECT doc_id, class, term FROM (SELECT doc_id, class, unnest({TOKENS}) AS term FROM {D.TEXTS}) WHERE {CONTENT})"
TOP_WORDS = f"(SELECT term, count(*) AS n FROM {WORDS} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50)"
VOCABULARY = 3000
PRESENCE = f"""(SELECT doc_id, count(*) FILTER (WHERE contains(lower(text), term)) AS hits FROM documents,
    (SELECT term, count(*) AS n FROM {WORDS} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {VOCABULARY}) GROUP BY 1)"""


def content_words(spark, sf):
    return X.words(D.all_texts(spark, sf), "text", ["doc_id"])


@query("fil09_content_tokens", f"SELECT doc_id, count(*) AS n, count(DISTINCT term) AS kinds FROM {WORDS} GROUP BY 1")
def fil09(spark, sf):
    per = content_words(spark, sf).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("c"))
    return per.groupBy("doc_id").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("kinds"))


@query("agg26_word_frequency", TOP_WORDS[1:-1])
def agg26(spark, sf):
    return X.top_words(content_words(spark, sf), 50)


@query("sca22_tokens_to_rows", f"SELECT term, count(*) AS n FROM (SELECT unnest({TOKENS}) AS term FROM documents) GROUP BY 1")
def sca22(spark, sf):
    return X.word_frequency(D.all_texts(spark, sf).select(F.explode(X.tweet_tokens("text")).alias("term")))


PLAIN = r"list_filter(string_split_regex(lower(text), '\s'), lambda x: x <> '')"


@query("fea07_tokenise", f"SELECT doc_id, len({PLAIN}) AS plain, len({TOKENS}) AS tweet FROM documents")
def fea07(spark, sf):
    return D.all_texts(spark, sf).select(
        "doc_id", F.size(X.plain_tokens("text")).alias("plain"), F.size(X.tweet_tokens("text")).alias("tweet")
    )


@query(
    "fea08_stop_words",
    f"SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest({PLAIN}) AS term FROM documents) WHERE term NOT IN ({STOP_SQL}) GROUP BY 1",
)
def fea08(spark, sf):
    kept = X.without_stop_words(X.plain_tokens("text"))
    return D.all_texts(spark, sf).select("doc_id", F.size(kept).alias("n")).filter("n > 0")


COUNTS = f"(SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({PLAIN}) AS term FROM documents) GROUP BY 1, 2)"


@query("fea09_term_counts", COUNTS[1:-1])
def fea09(spark, sf):
    return X.term_counts(D.all_texts(spark, sf), "doc_id", X.plain_tokens("text"))


@query(
    "fea10_tf_idf",
    f"""WITH c AS (SELECT * FROM {COUNTS}), d AS (SELECT term, count(*) AS df FROM c GROUP BY 1)
        SELECT doc_id, term, n, round(n * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS tf_idf FROM c JOIN d USING (term)""",
)
def fea10(spark, sf):
    docs = D.all_texts(spark, sf)
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    weighted = X.tf_idf(X.term_counts(docs, "doc_id", X.plain_tokens("text")), "doc_id", n_docs)
    return weighted.withColumn("tf_idf", F.round("tf_idf", 6))


@query("fea11_vocabulary_presence", PRESENCE[1:-1])
def fea11(spark, sf):
    docs = D.all_texts(spark, sf)
    vocab = X.top_words(X.words(docs, "text"), VOCABULARY)
    counts = X.vocabulary_hits(docs, "doc_id", "text", vocab, VOCABULARY).groupBy("doc_id").agg(F.count(F.lit(1)).alias("hits"))
    return docs.select("doc_id").join(counts, "doc_id", "left").select("doc_id", F.coalesce("hits", F.lit(0)).alias("hits"))


LEXICON = f"""(SELECT term, round(avg(CASE WHEN class = 'neg' THEN -1.0 ELSE 1.0 END), 4) AS valence FROM
  (SELECT DISTINCT doc_id, class, term FROM {LABELLED_WORDS}) GROUP BY 1 HAVING count(*) >= 5)"""


def lexicon(spark, sf):
    """Valence of a word: mean sign of the labelled texts that use it, five at least."""
    once = X.words(D.texts(spark, sf), "text", ["doc_id", "class"]).distinct()
    sign = S.signed_label("class").cast("double")
    return once.groupBy("term").agg(F.round(F.avg(sign), 4).alias("valence"), F.count(F.lit(1)).alias("c")).filter("c >= 5").drop("c")


@query(
    "fea12_lexicon_scores",
    f"""SELECT doc_id, round(coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15), 6) AS compound FROM documents LEFT JOIN
        (SELECT doc_id, sum(valence) AS s FROM (SELECT doc_id, unnest({TOKENS}) AS term FROM documents) JOIN {LEXICON} USING (term) GROUP BY 1) USING (doc_id)""",
)
def fea12(spark, sf):
    scored_docs = X.lexicon_scores(D.all_texts(spark, sf), "doc_id", "text", stage(lexicon(spark, sf), "lexicon"))
    return scored_docs.withColumn("compound", F.round("compound", 6))


@query(
    "joi09_two_features_one_row",
    f"""SELECT doc_id, hits, round(coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15), 6) AS compound FROM
        {PRESENCE} LEFT JOIN
        (SELECT doc_id, sum(valence) AS s FROM (SELECT doc_id, unnest({TOKENS}) AS term FROM documents) JOIN {LEXICON} USING (term) GROUP BY 1) USING (doc_id)""",
)
def joi09(spark, sf):
    """Two feature lists meet by document key, not by their place in a list."""
    return fea11(spark, sf).join(fea12(spark, sf), "doc_id")


# --- neighbours ---------------------------------------------------------------------------
KNN_SQL = f"""WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
    {S.hash_unit_sql('vec_id', 9)} < 0.8 AS train FROM embeddings),
  d AS (SELECT q.vec_id AS query_id, t.vec_id AS train_id, CAST(t.label AS DOUBLE) AS label, list_distance(q.v, t.v) AS distance
    FROM e q JOIN e t ON t.train AND NOT q.train),
  k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, train_id) AS r FROM d) WHERE r <= 2) """


def knn_sides(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("u", S.hash_unit("vec_id", 9))
    train = e.filter("u < 0.8").select(F.col("vec_id").alias("train_id"), "label", F.col("embedding").alias("v"))
    return train, e.filter("u >= 0.8").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("v"))


@query("joi08_nearest_rows", KNN_SQL + "SELECT query_id, train_id, label, round(distance, 6) AS distance FROM k")
def joi08(spark, sf):
    train, asked = knn_sides(spark, sf)
    return N.nearest(train, asked, 2).withColumn("distance", F.round("distance", 6))


@query(
    "ml13_nearest_vote",
    KNN_SQL
    + """SELECT query_id, label AS prediction FROM (SELECT query_id, label, row_number() OVER (PARTITION BY query_id
         ORDER BY count(*) DESC, min(distance), label) AS r FROM k GROUP BY 1, 2) WHERE r = 1""",
)
def ml13(spark, sf):
    train, asked = knn_sides(spark, sf)
    return N.vote(N.nearest(train, asked, 2))
