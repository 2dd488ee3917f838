"""Hand-made frames for the rules on nulls, ties, rounding, order and casts."""

import math
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyrill.functions import scalars as S
from tallyrill.functions.tails import chi2_tail_even, f_tail, f_two_sided
from tallyrill.operators import copairs
from tallyrill.operators import evaluate as E
from tallyrill.operators import impute as I
from tallyrill.operators import profile as P
from tallyrill.operators import recommend as RC
from tallyrill.operators import relational as R
from tallyrill.operators import series as TS
from tallyrill.operators import text as X


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_distinct_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("x", 1), ("y", None), (None, 2), ("x", 2)], "a string, b int")
    assert dict(rows(P.distinct_counts(df, ["a", "b"]))) == {"a": 3, "b": 3}
    assert dict(rows(P.distinct_counts(df, ["a", "b"], approximate=True))) == {"a": 3, "b": 3}
    assert rows(P.frequency(df, ["a"], drop_null=True)) == [("x", 2), ("y", 1)]


def test_left_join_matches_null_keys(spark):
    a = spark.createDataFrame([(1, "p"), (None, "q")], "k int, v string")
    b = spark.createDataFrame([(None, "z"), (2, "w")], "k int, u string")
    assert rows(R.natural_left_join(a, b)) == [(1, "p", None), (None, "q", "z")]
    assert rows(R.natural_left_join(a, b, null_safe=False)) == [(1, "p", None), (None, "q", None)]


def test_ratio_and_clamp(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-3.0, 2.0), (None, 1.0)], "a double, b double")
    got = df.select(S.ratio("a", "b").alias("r"), S.at_least_zero("a").alias("c")).collect()
    assert [tuple(r) for r in got] == [(None, 1.0), (-1.5, 0.0), (None, None)]


def test_half_even_and_constant_columns(spark):
    df = spark.createDataFrame([(2.5, 1.0), (3.5, 1.0), (0.0005, 1.0)], "x double, y double")
    assert [r[0] for r in df.select(S.half_even("x", 0)).collect()] == [2.0, 4.0, 0.0]
    assert df.agg(S.safe_corr("x", "y")).first()[0] is None
    pairs = {(r["a"], r["b"]): r["r"] for r in P.correlation_pairs(df, ["x", "y"]).collect()}
    assert pairs[("x", "y")] is None and abs(pairs[("x", "x")] - 1) < 1e-12


def test_filling_a_whole_number_column_with_its_mean(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (5,)], "x bigint")
    assert sorted(r[0] for r in I.fill_mean(df, ["x"]).collect()) == [1.0, 2.0, 8 / 3, 5.0]


def test_modes_and_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("b", 1), ("a", 1), (None, 3)], "c string, n int")
    assert rows(P.modes(df, ["c"])) == [("c", "a", 2)]
    assert P.group_mode(df, [], "n").first()["mode"] == 1
    filled = I.CategoryImputer(inputCols=["c"]).fit(df).transform(df)
    assert filled.filter("c is null").count() == 0
    assert rows(RC.top_per(df.dropna(), ["c"], [F.col("n").desc()], 1)) == [("a", 2), ("b", 2)]


def test_name_parts(spark):
    df = spark.createDataFrame([("Kelly, Mr. James",), ("no title",), ("A, the Countess. of (B. C.)",)], "n string")
    assert [r[0] for r in df.select(S.title_in("n")).collect()] == ["Mr", "no title", "the Countess"]
    assert [r[0] for r in df.select(S.surname_in("n")).collect()] == ["Kelly", "no title", "A"]
    assert [r[0] for r in df.select(S.recode(S.title_in("n"), {"Mr": "M"})).collect()] == ["M", "no title", "the Countess"]


def test_collapse_counts_after_the_first_rule(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",)], "f string")
    assert rows(P.frequency(R.collapse_rare(df, "f", 2, "Small"), ["f"])) == [("Small", 3), ("a", 3)]


def test_bands_and_lag_two(spark):
    pdf = pd.DataFrame({"k": ["a"] * 25 + ["b"] * 25, "t": list(range(25)) * 2, "y": np.random.default_rng(0).random(50)})
    df = spark.createDataFrame(pdf)
    got = TS.bands(df, ["k"], ["t"], "y").toPandas().sort_values(["k", "t"])
    mean = pdf.groupby("k")["y"].transform(lambda s: s.rolling(20).mean())
    sd = pdf.groupby("k")["y"].transform(lambda s: s.rolling(20).std())
    np.testing.assert_allclose(got["upper"].astype(float), np.round(mean + 2 * sd, 3), atol=1e-9, equal_nan=True)
    assert (got.dropna()["upper"] >= got.dropna()["ave"]).all()
    diff = TS.lag_difference(df, ["k"], ["t"], "y", 2).toPandas().sort_values(["k", "t"])["diff"].astype(float)
    np.testing.assert_allclose(diff, pdf.groupby("k")["y"].diff(2), equal_nan=True)
    split = TS.split_by_position(df, ["k"], ["t"], 0.7).filter("split = 'train'").groupBy("k").count()
    assert rows(split) == [("a", 18), ("b", 18)]


def test_calendar_and_forward_fill(spark):
    df = spark.sql("SELECT 'k' AS key, d AS t, v AS y FROM VALUES (date'2020-01-01', 1.0), (date'2020-01-04', null), (date'2020-01-06', 3.0) AS x(d, v)")
    got = [r["y"] for r in TS.densify(df, ["key"], "t", "y").orderBy("t").collect()]
    assert got == [1.0, 1.0, 1.0, 1.0, 1.0, 3.0]


def test_histogram_is_closed_on_the_right(spark):
    df = spark.createDataFrame([(float(i),) for i in range(51)], "x double")
    h = P.histogram(df, "x").orderBy("bin").collect()
    assert sum(r["n"] for r in h) == 51 and h[-1]["bin"] == 24 and h[-1]["n"] == 3
    flat = P.histogram(spark.createDataFrame([(2.0,)] * 4, "x double"), "x").collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(0, 4)]
    keyed = P.histogram(df.withColumn("k", F.col("x") > 25), "x", 5, ["k"])
    assert keyed.agg(F.sum("n")).first()[0] == 51


def test_tails(spark):
    one = spark.range(1)
    # F(2, 2): P(F > x) = 1 / (1 + x);  F(2, b): (b / (b + 2 x))^(b / 2)
    got = one.select(f_tail(F.lit(3.0), F.lit(2.0), F.lit(2.0)), f_tail(F.lit(1.7), F.lit(2.0), F.lit(9.0)), f_two_sided(F.lit(1.0), F.lit(7.0), F.lit(7.0))).first()
    assert abs(got[0] - 0.25) < 1e-12 and abs(got[1] - (9 / (9 + 3.4)) ** 4.5) < 1e-12 and abs(got[2] - 1) < 1e-12
    q = one.select(chi2_tail_even(F.lit(5.0), 2), chi2_tail_even(F.lit(5.0), 4)).first()
    assert abs(q[0] - math.exp(-2.5)) < 1e-12 and abs(q[1] - math.exp(-2.5) * 3.5) < 1e-12


def test_confusion_has_all_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    assert rows(E.confusion(df, [0, 1])) == [(0, 0, 2), (0, 1, 0), (1, 0, 1), (1, 1, 0)]
    more = df.union(spark.createDataFrame([(7, 0), (None, 1)], "label int, prediction int"))
    assert rows(E.confusion(more, [0, 1])) == [(0, 0, 2), (0, 1, 0), (1, 0, 1), (1, 1, 0), (7, 0, 1), (None, 1, 1)]
    assert [r[0] for r in spark.createDataFrame([(0.5,), (0.51,)], "p double").select(E.threshold("p")).collect()] == [0, 1]


RATINGS = [(1, i, float(r)) for i, r in enumerate([5, 3, 4, 4, 1])] + [(2, 0, 3.0), (2, 1, 1.0), (2, 2, 2.0), (2, 5, 3.0)]
RATINGS += [(3, 0, 4.0), (3, 1, 4.0), (3, 2, 4.0), (3, 5, 1.0)] + [(4, 7, 2.0)]


def test_similarity_and_prediction(spark):
    r = spark.createDataFrame(RATINGS, "userid bigint, itemid bigint, rating double")
    sims = {s["neighbour"]: s["sim"] for s in RC.similarity(r, spark.createDataFrame([(1,)], "userid bigint")).collect()}
    assert abs(sims[2] - 1.0) < 1e-9 and sims[3] == 0.0 and 4 not in sims and 1 not in sims
    near = RC.nearest_users(RC.similarity(r, spark.createDataFrame([(1,)], "userid bigint")), 2)
    predicted = {p["itemid"]: p["predicted"] for p in RC.predict_from_neighbours(r, near).collect()}
    assert abs(predicted[5] - (3.4 + (3 - 2.25))) < 1e-9
    titles = spark.createDataFrame([(i, f"t{i}") for i in range(8)], "itemid bigint, title string")
    top = RC.unseen_top(RC.predict_from_neighbours(r, near), r, titles, 3).collect()
    assert [t["itemid"] for t in top] == [5]


def test_similarity_sums_pairs_where_they_are_made(spark):
    """Blocks and parts of any size give the same rows, and no pair of users is dealt anew."""
    rng = random.Random(3)
    made = [(rng.randrange(12), rng.randrange(6), rng.choice([1.0, 2.5, 4.0, None])) for _ in range(90)]
    made += [(None, 1, 2.0), (3, None, 2.0), (None, None, 1.0), (3, 1, 4.0), (3, 1, 4.0)]
    r = spark.createDataFrame(made, "userid bigint, itemid bigint, rating double")
    asked = spark.createDataFrame([(1,), (3,), (3,), (5,), (None,), (99,)], "userid bigint")
    want = {}
    for a, i, x in made:
        for b, j, y in made:
            if a in (1, 3, 5) and b is not None and a != b and i is not None and i == j:
                want.setdefault((a, b), []).append((x, y))
    for active_rows, pair_rows in ((200_000, 1_000_000), (10, 40)):
        got = RC.similarity(r, asked, active_rows, pair_rows)
        assert "hashpartitioning(active" not in got._jdf.queryExecution().executedPlan().toString()
        found = {(s["active"], s["neighbour"]): (s["shared"], s["sim"]) for s in got.collect()}
        assert {k: v[0] for k, v in found.items()} == {k: len(v) for k, v in want.items()}
        for key, pairs in want.items():
            both = np.array([p for p in pairs if None not in p]).reshape(-1, 2)
            flat = len(pairs) < 2 or not len(both) or (both.std(0) == 0).any()
            assert abs(found[key][1] - (0 if flat else np.corrcoef(both.T)[0, 1])) < 1e-8
    assert RC.similarity(r.limit(0), asked).isEmpty()


def test_text_tokens_and_lexicon(spark):
    df = spark.createDataFrame([(1, "RT @bob Great day!! http://x.y/z #fun isn't"), (2, "bad Bad day"), (3, "")], "d int, t string")
    assert df.select(X.tweet_tokens("t")).first()[0] == ["rt", "@bob", "great", "day", "!", "!", "http://x.y/z", "#fun", "isn't"]
    assert {(1, "day"), (1, "great"), (1, "isn't")} == {r for r in rows(X.words(df, "t", ["d"])) if r[0] == 1}
    stop = spark.createDataFrame([("day",)], "term string")
    assert (1, "day") not in rows(X.words(df, "t", ["d"], stop))
    lex = spark.createDataFrame([("great", 3.0), ("bad", -2.5)], "term string, valence double")
    got = dict(rows(X.lexicon_scores(df, "d", "t", lex)))
    assert abs(got[1] - 3 / math.sqrt(24)) < 1e-12 and abs(got[2] + 5 / math.sqrt(40)) < 1e-12 and got[3] == 0.0
    vocab = spark.createDataFrame([("eat",), ("day",)], "term string")
    marks = {r["d"]: r["present"] for r in X.vocabulary_presence(df, "t", vocab, 10).collect()}
    assert marks == {1: [1, 1], 2: [1, 0], 3: [0, 0]}
    with pytest.raises(ValueError, match="more than 1 words"):
        X.vocabulary_presence(df, "t", vocab, 1)


def test_vocabulary_hits_are_those_of_contains(spark):
    rng = random.Random(4)
    letters = "abcdé漢"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(400)]
    texts = [" \t\n".join("".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(rng.randint(0, 40))) for _ in range(80)]
    texts += [None, "", "   ", "ABC CD", "x" * 255 + "abcdé" + "y" * 300, "abc" * 900, "two  words here", "q" * 251 + words[0] + words[1]]
    vocab = words + ["o  w", "two  words", "xabcdéy", "y" * 290]
    df = spark.createDataFrame(list(enumerate(texts)), "d int, t string")
    listed = spark.createDataFrame([(w,) for w in vocab + words[:50] + [None, ""]], "term string")
    got = X.vocabulary_hits(df, "d", "t", listed, 500)
    assert sorted(tuple(r) for r in got.collect()) == sorted({(i, w) for i, t in enumerate(texts) if t for w in vocab if w in t.lower()})
    with pytest.raises(ValueError, match="more than 10 words"):
        X.vocabulary_hits(df, "d", "t", listed, 10)
    assert X.vocabulary_hits(df, "d", "t", listed.limit(0), 10).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_category_drift_and_group_fill(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "c string, n int")
    b = spark.createDataFrame([("x", 1), ("z", 1)], "c string, n int")
    assert rows(R.category_drift(a, b, ["c", "n"])) == [("c", "y", "first"), ("c", "z", "second"), ("n", "2", "first")]
    g = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", None)], "k string, v double")
    assert rows(I.fill_group_median(g, ["k"], "v")) == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", None)]


def test_join_back_with_hot_and_null_keys(spark):
    df = spark.createDataFrame([("hot", i) for i in range(50)] + [(None, i) for i in range(30)] + [(f"k{i}", i) for i in range(20)], "k string, v int")
    sizes = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top"))
    want = sorted(((r["k"], r["v"], {"hot": 50, None: 30}.get(r["k"], 1)) for r in df.collect()), key=str)
    for share in (1e-4, 0.02, 0.35, 1.0):
        got = R.join_back(df, sizes, ["k"], "n", share)
        assert got.columns == ["k", "v", "n", "top"]
        assert rows(got.select("k", "v", "n")) == want
    assert rows(R.join_back(df, sizes.select("k", "top"), ["k"]).select("k", "v")) == rows(df)


def test_join_back_spreads_a_hot_key(spark, shuffles):
    """90 % of the rows on one key: no task of the join gets more than a part of them."""
    shuffles(16)
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id")).alias("k"), "id")
    joined = R.join_back(df, df.groupBy("k").agg(F.count(F.lit(1)).alias("n")), ["k"], "n", share=0.01)
    sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in sizes) == 20_000 and max(r["count"] for r in sizes) < 6_000


def test_vocabulary_hits_stay_in_plain_columns(spark):
    """Places are made in generated code, and none where too few characters are left; long tokens are cut anywhere."""
    words = ["abc", "bcd", "cabca", "zzz", "é漢é", "x y", "abcabcabcabc"]
    texts = [None, "", "ab", "abc", "ABC bcd", "x y", "xx yy", "é漢é漢", "zz z"]
    texts += ["q" * n + tail for n in (250, 253, 255, 256, 257, 262, 266, 511, 512, 600) for tail in ("abc", "cabca", "abcabcabcabc", "é漢é")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    vocabulary = spark.createDataFrame([(w,) for w in words], "term string")
    hits = X.vocabulary_hits(docs, "doc_id", "text", vocabulary, 10)
    assert {tuple(r) for r in hits.collect()} == {(i, w) for i, t in enumerate(texts) for w in words if w in (t or "").lower()}
    assert "lambdafunction" not in hits._jdf.queryExecution().optimizedPlan().toString()
    few = X.vocabulary_hits(docs, "doc_id", "text", vocabulary.union(spark.createDataFrame([("b",), ("zz",)], "term string")), 10)
    assert {tuple(r) for r in few.collect()} == {(i, w) for i, t in enumerate(texts) for w in [*words, "b", "zz"] if w in (t or "").lower()}


def test_term_counts_stay_in_their_rows(spark):
    """Only documents whose id comes again are summed up in a shuffle; nulls, empty texts and repeated rows."""
    texts = [(1, "b a b"), (2, None), (3, ""), (4, "x"), (4, "x y x"), (None, "n m"), (None, "n"), (5, "  c  C\tc "), (6, "漢 漢 a")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    want = {}
    for i, t in texts:
        for w in (t or "").lower().split():
            want[i, w] = want.get((i, w), 0) + 1
    counts = X.term_counts(df, "doc_id", X.plain_tokens("text"))
    assert counts.dtypes == [("doc_id", "bigint"), ("term", "string"), ("n", "bigint")]
    got = counts.collect()
    assert len(got) == len(want) and {(r.doc_id, r.term): r.n for r in got} == want
    once = df.where("doc_id in (1, 2, 3, 5, 6)")
    plan = X.term_counts(once, "doc_id", X.plain_tokens("text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_blocks_of_asked_users_share_a_pass(spark):
    """The ratings are not gone through once for each block of asked users."""
    r = spark.createDataFrame([(u, (u * k) % 7, float(k % 5)) for u in range(60) for k in range(9)], "userid bigint, itemid bigint, rating double")
    asked = r.select("userid").where("userid % 2 = 0")
    got = RC.similarity(r, asked, active_rows=10, part_rows=10)
    plan = got._jdf.queryExecution().toString().partition("Physical Plan")[2]
    assert plan.count("MapInArrow") == 1 and "Join" not in plan
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, RC.similarity(r, asked).collect()))


def test_nearest_leaves_out_only_pairs_that_others_come_before(spark):
    """Ties go to the smaller user, NaN comes first, pairs without both ratings are counted and not scored."""
    rng = random.Random(5)
    made = [(rng.randrange(40), rng.randrange(9), rng.choice([0.1, 0.1, 0.7, 2.0, None, math.nan if u < 4 else 1.0])) for u in range(400)]
    for kind, name in (("bigint", lambda u: u - 20), ("string", lambda u: f"u{u}")):
        r = spark.createDataFrame([(name(u), str(i), x) for u, i, x in made], f"userid {kind}, itemid string, rating double")
        asked = r.select("userid").where(F.abs(F.hash("userid")) % 2 == 0)
        want = [tuple(map(str, x)) for x in RC.nearest_users(RC.similarity(r, asked), 3).collect()]
        few = RC.similarity(r, asked, 50, 20, 90, nearest=3)
        assert len(want) < few.count() < RC.similarity(r, asked).count()
        assert sorted(tuple(map(str, x)) for x in RC.nearest_users(few, 3).collect()) == sorted(want)
    assert {x[3] for x in want} > {"1.0", "nan"}


def test_a_batch_of_pairs_holds_whole_users():
    theirs = pa.table({"neighbour": [1, 2, 3, 1, 2, 3], "itemid": [7, 7, 7, 8, 8, 8], "b": [1.0, 2.0, 3.0, 2.0, 1.0, 3.0]})
    mine = pa.table({"active": [1, 1, 9, 9, 10], "itemid": [7, 8, 8, 7, 99], "a": [1.0, 2.0, 5.0, 4.0, 1.0]})
    for most in (1, 6, 100):
        found = [tuple(x.values()) for batch in copairs.Part(theirs).scored(mine, most=most) for x in batch.to_pylist()]
        assert found == [(1, 2, 2, -1.0), (1, 3, 2, 0.0), (9, 1, 2, 1.0), (9, 2, 2, -1.0), (9, 3, 2, 0.0)]
