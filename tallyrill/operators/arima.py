"""Order search, fitting and forecasting of seasonal ARMA models, and unit-root tests.

The estimator is Hannan and Rissanen's: a long autoregression gives residuals, then the
series is regressed on its own lags and on lags of those residuals. Seasonal lags enter
additively. Every regression needs only sums of products, so Spark adds those up per series
(partial sums before the shuffle, any length); one matrix of sums for the largest order holds
the matrices of all smaller ones. Python only solves systems of a few unknowns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrill.functions.tails import f_two_sided
from tallyrill.operators import series as TS
from tallyrill.operators.ordered import over_blocks, with_position
from tallyrill.operators.relational import join_back, null_safe_join
from tallyrill.session import stage

ORDER = ["p", "d", "q", "sp", "sd", "sq"]


def order_grid(p, d, q, sp=(0,), sd=(0,), sq=(0,)) -> list[dict]:
    """All combinations but those with p = d = q = 0, numbered in order."""
    combos = [c for c in product(p, d, q, sp, sd, sq) if c[:3] != (0, 0, 0)]
    return [dict(zip(ORDER, map(int, c)), order_id=i) for i, c in enumerate(combos)]


# --- sums of products ---------------------------------------------------------------------
def sums_of_products(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """n and the upper triangle of X'X as an array, rows complete in all columns only."""
    full = df.dropna(how="any", subset=list(columns))
    # one piece of SQL text instead of hundreds of small column calls
    sums = ", ".join(f"sum(`{a}` * `{b}`)" for i, a in enumerate(columns) for b in columns[i:])
    return full.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.expr(f"array({sums})").alias("xx"))


def _square(xx: np.ndarray) -> np.ndarray:
    m = int((math.isqrt(8 * len(xx) + 1) - 1) // 2)
    full = np.zeros((m, m))
    full[np.triu_indices(m)] = xx
    return full + np.triu(full, 1).T


def _solve(full: np.ndarray, use: Sequence[int]) -> tuple[np.ndarray, float, np.ndarray]:
    """Regress column 0 on the columns ``use``: coefficients, error sum, inverse matrix."""
    use = list(use)
    if not use:
        return np.zeros(0), float(full[0, 0]), np.zeros((0, 0))
    a, b = full[np.ix_(use, use)], full[use, 0]
    scale = 1.0 / np.sqrt(np.maximum(np.diag(a), 1e-300))
    inv = np.linalg.pinv(a * np.outer(scale, scale), rcond=1e-13, hermitian=True) * np.outer(scale, scale)
    coef = inv @ b
    return coef, float(full[0, 0] - coef @ b), inv


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _coefficients(xx: pd.Series) -> pd.Series:
    out = []
    for v in xx:
        full = _square(np.asarray(v, dtype=float))
        out.append(_solve(full, range(1, len(full)))[0].tolist())
    return pd.Series(out)


# --- positions and windows: plain on a calendar grain, in blocks for long series ------------
def _placed(df: DataFrame, keys: Sequence[str], order: Sequence[str], long: bool) -> DataFrame:
    if long:
        return with_position(df, keys, order, "__pos", "__len")
    w = Window.partitionBy(*keys)
    return df.withColumns(
        {"__pos": F.row_number().over(w.orderBy(*order)).cast("long"), "__len": F.count(F.lit(1)).over(w)}
    )


def _back(df: DataFrame, keys: Sequence[str], before: int, build, long: bool) -> DataFrame:
    if long:
        return over_blocks(df, keys, "__pos", before, build)
    return df.withColumns(build(Window.partitionBy(*keys).orderBy("__pos")))


# --- differenced rows ---------------------------------------------------------------------
def difference_weights(d: int, sd: int, s: int) -> list[float]:
    """Coefficients of (1 - B)^d (1 - B^s)^sd, from lag 0 upwards."""
    w = np.array([1.0])
    for _ in range(d):
        w = np.convolve(w, [1.0, -1.0])
    seasonal = np.zeros(s + 1)
    seasonal[0], seasonal[-1] = 1.0, -1.0
    for _ in range(sd):
        w = np.convolve(w, seasonal)
    return w.tolist()


def differenced(
    df: DataFrame, keys: Sequence[str], y: str, pairs: Sequence[tuple[int, int]], s: int, long: bool
) -> DataFrame:
    """Rows (keys, d, sd, position, y, z) for each pair of differences, from one window pass."""
    weights = {pair: difference_weights(*pair, s) for pair in pairs}
    reach = max(len(w) for w in weights.values()) - 1

    def build(spec):
        return {f"__y{j}": F.lag(y, j).over(spec) for j in range(1, reach + 1)}

    lagged = _back(df, keys, reach, build, long)

    def z_of(w: list[float]) -> Column:
        out = F.col(y).cast("double")
        for j, v in enumerate(w):
            if j and v:
                out = out + F.lit(v) * F.col(f"__y{j}")
        return out

    cells = F.array(
        *[F.struct(F.lit(d).alias("d"), F.lit(sd).alias("sd"), z_of(w).alias("z")) for (d, sd), w in weights.items()]
    )
    return lagged.select(*keys, "__pos", F.col(y).alias("y"), F.inline(cells)).filter(F.col("z").isNotNull())


class SearchSpace:
    """Column layout shared by all orders of a grid: target, constant, own lags, error lags."""

    def __init__(self, grid: Sequence[dict], s: int, trend: str = "n"):
        self.grid, self.s, self.trend = list(grid), s, trend
        self.pairs = sorted({(g["d"], g["sd"]) for g in grid})
        top = {k: max(g[k] for g in grid) for k in ORDER}
        self.z_lags = sorted({*range(1, top["p"] + 1), *(s * j for j in range(1, top["sp"] + 1))})
        self.e_lags = sorted({*range(1, top["q"] + 1), *(s * j for j in range(1, top["sq"] + 1))})
        self.long_ar = max([*self.z_lags, *self.e_lags, 1]) + 2
        self.const = ["one"] if trend == "c" else []
        self.columns = ["z", *self.const, *[f"z{j}" for j in self.z_lags], *[f"e{j}" for j in self.e_lags]]

    def used(self, g: dict) -> tuple[list[int], list[int]]:
        """Positions of the own-lag and error-lag columns of an order."""
        own = {*range(1, g["p"] + 1), *(self.s * j for j in range(1, g["sp"] + 1))}
        err = {*range(1, g["q"] + 1), *(self.s * j for j in range(1, g["sq"] + 1))}
        return (
            [self.columns.index(f"z{j}") for j in sorted(own)],
            [self.columns.index(f"e{j}") for j in sorted(err)],
        )


def regressors(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], y: str, space: SearchSpace, long: bool = False, every: bool = False
) -> DataFrame:
    """Rows with target, own lags and error lags for every (key, d, sd).

    All orders of a grid get the same rows: those on which the largest one is defined. With ``every`` the
    others stay too, and ``__shared`` tells them apart.
    """
    groups = [*keys, "d", "sd"]
    placed = _placed(df, keys, order, long).drop("__len")
    z = differenced(placed, keys, y, space.pairs, space.s, long)
    ar = range(1, space.long_ar + 1)

    def own(spec):
        return {f"z{j}": F.lag("z", j).over(spec) for j in ar}

    first = _back(z, groups, space.long_ar, own, long).withColumn("one", F.lit(1.0))
    const = space.const
    coef = sums_of_products(first, groups, ["z", *const, *[f"z{j}" for j in ar]]).select(
        *groups, _coefficients("xx").alias("__c")
    )
    fitted = join_back(first, coef, groups) if long else null_safe_join(first, coef, groups, "inner")
    guess = F.lit(0.0)
    for i, name in enumerate([*const, *[f"z{j}" for j in ar]]):
        guess = guess + F.col("__c")[i] * F.col(name)
    second = fitted.withColumn("e", F.col("z") - guess)
    reach = max([*space.e_lags, 0])
    widest = max(len(difference_weights(*pair, space.s)) for pair in space.pairs) - 1
    shared = F.col("__pos") > widest + space.long_ar + reach

    def errors(spec):
        return {f"e{j}": F.lag("e", j).over(spec) for j in space.e_lags}

    lagged = _back(second, groups, reach, errors, long) if reach else second
    chosen = lagged.select(*groups, "__pos", "y", "e", *space.columns, shared.alias("__shared"))
    return chosen if every else chosen.filter("__shared").drop("__shared")


_FIT = T.StructType(
    [
        T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("sse", T.DoubleType()),
        T.StructField("k", T.IntegerType()),
        T.StructField("ar_ok", T.BooleanType()),
        T.StructField("ma_ok", T.BooleanType()),
        T.StructField("status", T.StringType()),
    ]
)


def _outside(lags: list[int], coef: np.ndarray, sign: float) -> bool:
    """Are all roots of 1 + sign * sum c_j B^j outside the unit circle?"""
    if not lags:
        return True
    poly = np.zeros(max(lags) + 1)
    poly[0] = 1.0
    poly[lags] = sign * coef
    return bool(np.all(np.abs(np.roots(poly[::-1])) > 1.0))


def _fitter(space: SearchSpace):
    plan = {}
    for g in space.grid:
        own, err = space.used(g)
        plan[g["order_id"]] = (own, err)
    lag_of = {i: int(c[1:]) for i, c in enumerate(space.columns) if i and c != "one"}
    const = [space.columns.index(c) for c in space.const]
    width = len(space.columns) - 1

    @F.pandas_udf(_FIT)
    def fit(n: pd.Series, xx: pd.Series, order_id: pd.Series) -> pd.DataFrame:
        rows = []
        for rows_n, v, oid in zip(n, xx, order_id):
            own, err = plan[int(oid)]
            use = [*const, *own, *err]
            if v is None or rows_n <= len(use) + 1:
                rows.append((None, None, len(use) + 1, None, None, "too short"))
                continue
            full = _square(np.asarray(v, dtype=float))
            coef, sse, _ = _solve(full, use)
            padded = np.zeros(width)
            padded[[i - 1 for i in use]] = coef
            a = _outside([lag_of[i] for i in own], padded[[i - 1 for i in own]], -1.0)
            m = _outside([lag_of[i] for i in err], padded[[i - 1 for i in err]], 1.0)
            good = np.isfinite(sse) and sse > 0
            rows.append((padded.tolist(), float(sse), len(use) + 1, a, m, "ok" if good else "no variance"))
        return pd.DataFrame(rows, columns=_FIT.names)

    return fit


def order_search(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    y: str,
    grid: Sequence[dict],
    s: int = 12,
    trend: str = "n",
    rows: DataFrame | None = None,
    long: bool = False,
) -> DataFrame:
    """One row per series and order: coefficients, AIC, BIC, root checks and status.

    An order that cannot be fitted stays as a row with its status. All orders share one
    sample, so their AIC and BIC can be compared.
    """
    space = SearchSpace(grid, s, trend)
    base = rows if rows is not None else regressors(df, keys, order, y, space, long)
    sums = sums_of_products(base, [*keys, "d", "sd"], space.columns)
    listed = ", ".join(
        "named_struct(" + ", ".join(f"'{k}', {int(g[k])}" for k in ("order_id", *ORDER)) + ")" for g in space.grid
    )
    # every series has its orders, also one that is too short for a single row of regressors
    orders = df.select(*keys).distinct().select(*keys, F.explode(F.expr(f"array({listed})")).alias("__o")).select(*keys, "__o.*")
    asked = null_safe_join(orders, sums.select(*keys, "d", "sd", "n", "xx"), [*keys, "d", "sd"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    fitted = asked.withColumn("__f", _fitter(space)("n", "xx", "order_id"))
    sigma2 = F.when(F.col("sse") > 0, F.col("sse") / F.col("n"))
    loglik = -F.col("n") / 2 * (F.ln(2 * math.pi * sigma2) + 1)
    return fitted.select(*keys, "order_id", *ORDER, "n", "__f.*").select(
        "*",
        F.lit(s).alias("s"),
        F.lit(trend).alias("trend"),
        (-2 * loglik + 2 * F.col("k")).alias("aic"),
        (-2 * loglik + F.col("k") * F.ln("n")).alias("bic"),
    )


def best_orders(results: DataFrame, keys: Sequence[str], top: int = 10) -> DataFrame:
    """Fitted orders by BIC, ties by order number; failed ones are left out."""
    ok = results.filter((F.col("status") == "ok") & F.col("bic").isNotNull())
    w = Window.partitionBy(*keys).orderBy(F.round("bic", 9), "order_id")
    return ok.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= top)


def residuals(rows: DataFrame, fits: DataFrame, keys: Sequence[str], space: SearchSpace) -> DataFrame:
    """One-step errors of fitted orders: rows meet the orders asked for, by (key, d, sd)."""
    x = F.array(*[F.col(c) for c in space.columns[1:]]) if len(space.columns) > 1 else F.array().cast("array<double>")
    picked = fits.select(*keys, "d", "sd", "order_id", "coef")
    joined = null_safe_join(rows.withColumn("__x", x), picked, [*keys, "d", "sd"], "inner")
    guess = F.aggregate(F.zip_with("__x", "coef", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return joined.select(*keys, "order_id", "__pos", "y", "z", (F.col("z") - guess).alias("resid"))


def residual_tests(resid: DataFrame, keys: Sequence[str], lags: int = 10) -> DataFrame:
    """Break-variance, normality, serial-correlation and Durbin-Watson checks per order."""
    groups = [*keys, "order_id"]
    het = TS.break_variance(resid, groups, ["__pos"], "resid")
    het = het.select(*groups, "stat", f_two_sided(F.col("stat"), F.col("h"), F.col("h")).alias("het_p"))
    norm = TS.jarque_bera(resid, groups, "resid").select(*groups, F.col("p").alias("norm_p"), "skew", "excess")
    ser = TS.ljung_box(resid, groups, ["__pos"], "resid", lags).select(*groups, F.col("p").alias("sercor_p"))
    dw = TS.durbin_watson(resid, groups, ["__pos"], "resid").withColumnRenamed("dw", "dw_stat")
    return het.join(norm, groups).join(ser, groups).join(dw, groups)


def searched_table(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], y: str, grid: Sequence[dict], s: int = 12, trend: str = "n", top: int = 10,
    long: bool = False,
) -> DataFrame:
    """The ranked search table with residual checks for the best ``top`` orders of each series."""
    space = SearchSpace(grid, s, trend)
    rows = stage(regressors(df, keys, order, y, space, long), "arima-rows")
    best = best_orders(order_search(df, keys, order, y, grid, s, trend, rows), keys, top)
    best = stage(best, "arima-best")
    checks = residual_tests(residuals(rows, best, keys, space), keys)
    return best.join(checks, [*keys, "order_id"])


def _forecaster(space: SearchSpace, g: dict, steps: int):
    weights = difference_weights(g["d"], g["sd"], space.s)
    own, err = space.used(g)
    z_terms = [(int(space.columns[i][1:]), i - 1) for i in own]
    e_terms = [(int(space.columns[i][1:]), i - 1) for i in err]
    const = 0 if space.const else None
    reach = max([*space.z_lags, *space.e_lags, len(weights), 1])

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def ahead(y_tail: pd.Series, z_tail: pd.Series, e_tail: pd.Series, coef: pd.Series) -> pd.Series:
        out = []
        for ys, zs, es, c in zip(y_tail, z_tail, e_tail, coef):
            if c is None or ys is None:
                out.append([None] * steps)
                continue
            # before its start a series has no values, and errors count as zero
            ys, zs = ([*[math.nan] * reach, *(math.nan if v is None else v for v in x)] for x in (ys, zs))
            es, made = [*[0.0] * reach, *(0.0 if v is None or v != v else v for v in es)], []
            for _ in range(steps):
                z = (c[const] if const is not None else 0.0) + sum(c[i] * zs[-j] for j, i in z_terms)
                z += sum(c[i] * es[-j] for j, i in e_terms)
                y = z - sum(w * ys[-j] for j, w in enumerate(weights) if j and w)
                zs.append(z)
                es.append(0.0)
                ys.append(y)
                made.append(None if y != y else float(y))
            out.append(made)
        return pd.Series(out)

    return ahead


def fit_and_predict(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], y: str, spec: dict, steps: int, s: int = 12, trend: str = "n",
    long: bool = False,
) -> DataFrame:
    """One-step predictions on the sample and ``steps`` rows beyond it, per series.

    Rows are (keys, step, yhat, is_forecast, status); step is the row's position in its series. A forecast
    needs the last few rows of a series only, so no series goes whole to one task. A series that cannot
    be fitted, or is too short to go on from, keeps its forecast rows with a null and its status.
    """
    g = {**{k: 0 for k in ORDER}, **spec, "order_id": 0}
    space = SearchSpace([g], s, trend)
    every = stage(regressors(df, keys, order, y, space, long, every=True), "arima-rows")
    rows = every.filter("__shared").drop("__shared")
    found = stage(order_search(df, keys, order, y, [g], s, trend, rows).select(*keys, *ORDER, "order_id", "coef", "status"), "arima-fits")
    fits = found.filter("status = 'ok'")
    err = stage(residuals(rows, fits, keys, space), "arima-resid")
    inside = err.select(
        *keys, F.col("__pos").alias("step"), (F.col("y") - F.col("resid")).alias("yhat"), F.lit(False).alias("is_forecast"), F.lit("ok").alias("status")
    )
    # future errors start from those of the first stage, as in the regression itself
    tail_len = max([*space.z_lags, *space.e_lags, len(difference_weights(g["d"], g["sd"], s)), 1])
    ends = every.groupBy(*keys).agg(F.max("__pos").alias("__last"), F.count(F.lit(1)).alias("__size"))
    tail = join_back(every, ends, keys, "__size").filter(F.col("__pos") > F.col("__last") - tail_len)
    lists = tail.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("__pos", "y", "z", "e"))).alias("__t"))
    lengths = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__last"))
    ready = null_safe_join(null_safe_join(lengths, lists, list(keys), "left"), found.select(*keys, "coef", "status"), list(keys), "left")
    made = _forecaster(space, g, steps)("__t.y", "__t.z", "__t.e", F.when(F.col("status") == "ok", F.col("coef")))
    future = ready.select(*keys, "__last", "status", F.posexplode(made).alias("__i", "yhat")).select(
        *keys, (F.col("__last") + F.col("__i") + 1).alias("step"), "yhat", F.lit(True).alias("is_forecast"), "status"
    )
    return inside.unionByName(future)


# --- partial autocorrelation --------------------------------------------------------------
@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _levinson(r: pd.Series) -> pd.Series:
    """Partial autocorrelations from r_0..r_K by the Levinson-Durbin recursion."""
    out = []
    for values in r:
        rho = np.asarray(values, dtype=float)
        phi, found = np.zeros(0), [1.0]
        for k in range(1, len(rho)):
            num = rho[k] - phi @ rho[k - 1 : 0 : -1] if k > 1 else rho[1]
            den = 1.0 - phi @ rho[1:k] if k > 1 else 1.0
            last = num / den if den else float("nan")
            phi = np.append(phi - last * phi[::-1], last)
            found.append(float(last))
        out.append(found)
    return pd.Series(out)


def pacf(df: DataFrame, keys: Sequence[str], order: Sequence[str], y: str, lags: int = 20, long: bool = False) -> DataFrame:
    """Partial autocorrelation per key and lag 0..lags, with the 1.96 / sqrt(n) band."""
    cov = TS.autocovariances(df, keys, order, y, lags, long)
    ratios = F.transform("c", lambda v: F.try_divide(v, F.col("c")[0]))
    known = cov.filter(F.col("c")[0] > 0)
    return known.select(*keys, "n", F.posexplode(_levinson(ratios)).alias("lag", "pacf")).select(
        *keys, "lag", "pacf", (1.96 / F.sqrt("n")).alias("band")
    )


# --- unit root ----------------------------------------------------------------------------
# MacKinnon (2010) response surface for a test with constant, per level.
CRITICAL = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10": (-2.56677, -1.5384, -2.809, 0.0),
}
_ROOT = T.StructType([T.StructField("stat", T.DoubleType()), T.StructField("lags", T.IntegerType())])


@F.pandas_udf(_ROOT)
def _unit_root(n: pd.Series, xx: pd.Series, max_lag: pd.Series) -> pd.DataFrame:
    rows = []
    for m, v, top in zip(n, xx, max_lag):
        full, best = _square(np.asarray(v, dtype=float)), (float("nan"), -1, float("inf"))
        for lag in range(int(top) + 1):
            use = list(range(1, 3 + lag))
            if m <= len(use) + 1:
                break
            coef, sse, inv = _solve(full, use)
            if not sse > 0:
                continue
            aic = m * math.log(sse / m) + 2 * len(use)
            if aic < best[2] - 1e-12:
                best = (float(coef[1] / math.sqrt(sse / (m - len(use)) * inv[1, 1])), lag, aic)
        rows.append(best[:2])
    return pd.DataFrame(rows, columns=_ROOT.names)


def unit_root(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], y: str, max_lag: int | None = None, long: bool = False
) -> DataFrame:
    """Augmented Dickey-Fuller statistic with constant; the lag has the lowest AIC.

    Candidate lags go up to 12 (n / 100)^(1/4) of each series; all are compared on the rows on which the
    series' longest is defined, so a result does not depend on the other series.
    """
    placed = _placed(df.filter(F.col(y).isNotNull()), keys, order, long)
    limit = F.floor(12 * F.pow(F.col("__len") / 100.0, F.lit(0.25)))
    if max_lag is None:
        max_lag = int(placed.agg(F.max(limit)).first()[0] or 0)
    means = placed.groupBy(*keys).agg(F.avg(y).alias("__m"), F.count(F.lit(1)).alias("__size"))
    centred = join_back(placed, means, keys, "__size").withColumn("__y", F.col(y) - F.col("__m"))
    stepped = _back(centred, keys, 1, lambda w: {"level": F.lag("__y", 1).over(w)}, long)
    stepped = stepped.withColumns({"dy": F.col("__y") - F.col("level"), "one": F.lit(1.0)})
    names = [f"dy{j}" for j in range(1, max_lag + 1)]
    if names:
        stepped = _back(
            stepped, keys, max_lag, lambda w: {f"dy{j}": F.lag("dy", j).over(w) for j in range(1, max_lag + 1)}, long
        )
    # a series has its own rows: those that its own longest lag leaves it; beyond that lag nothing is used
    own = F.least(limit, F.lit(max_lag)).cast("int")
    stepped = stepped.filter(F.col("__pos") > own + 1).withColumns({n: F.coalesce(n, F.lit(0.0)) for n in names})
    lengths = stepped.groupBy(*keys).agg(F.max(own).alias("max_lag"))
    sums = sums_of_products(stepped, keys, ["dy", "one", "level", *names])
    tested = null_safe_join(sums, lengths, list(keys), "inner").withColumn("__u", _unit_root("n", "xx", "max_lag"))
    n = F.col("n")
    crit = {name: F.lit(b[0]) + b[1] / n + b[2] / (n * n) + b[3] / (n * n * n) for name, b in CRITICAL.items()}
    return tested.select(*keys, "n", "__u.*", *[c.alias(name) for name, c in crit.items()]).withColumn(
        "stationary", F.col("stat") < F.col("crit_5")
    )
