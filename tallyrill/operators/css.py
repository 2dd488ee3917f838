"""Seasonal orders that multiply, by conditional least squares.

The errors of (1 - ..)(1 - ..B^s) z = c + (1 + ..)(1 + ..B^s) e follow from a linear recurrence, so a long
series is cut into blocks: what a block does to the last errors before it is an affine map, maps are composed
over the blocks of a series, and then every block knows the errors it starts from. Gauss and Newton's step
(with Levenberg and Marquardt's damping) needs only sums of products of the errors and their derivatives.
All series and all orders of a grid go through one job a step; what is settled drops out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrill.operators import arima as A
from tallyrill.operators.relational import null_safe_join
from tallyrill.session import stage

BLOCK = 2048  # rows of a series that one task recurs over
CHUNK = 512  # blocks whose maps are composed at a time
STEP = 1e-6  # of a parameter, for its derivative
SETTLED = 1e-8  # relative gain of a step
_STATE = T.StructType(
    [
        T.StructField("beta", T.ArrayType(T.DoubleType())),
        T.StructField("trial", T.ArrayType(T.DoubleType())),
        T.StructField("sums", T.ArrayType(T.DoubleType())),
        T.StructField("n", T.LongType()),
        T.StructField("damping", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)


class Layout:
    """Parameters of an order: constant, own lags, seasonal own lags, error lags, seasonal error lags."""

    def __init__(self, grid: Sequence[dict], s: int, trend: str):
        self.grid, self.s, self.trend = {g["order_id"]: g for g in grid}, s, trend
        top = {k: max(g[k] for g in grid) for k in A.ORDER}
        self.own = top["p"] + s * top["sp"]  # the longest lags
        self.errors = top["q"] + s * top["sq"]
        self.most = max(self.size(g) for g in grid)
        self.pairs = sorted({(g["d"], g["sd"]) for g in grid})
        self.widest = max(len(A.difference_weights(*pair, s)) for pair in self.pairs) - 1

    def size(self, g: dict) -> int:
        return (self.trend == "c") + g["p"] + g["sp"] + g["q"] + g["sq"]

    def parts(self, g: dict, beta: np.ndarray) -> list[np.ndarray]:
        return np.split(beta, np.cumsum([int(self.trend == "c"), g["p"], g["sp"], g["q"]]))

    def product(self, short: np.ndarray, seasonal: np.ndarray, sign: float, length: int) -> np.ndarray:
        """Coefficients of (1 + sign * sum a_j B^j)(1 + sign * sum b_j B^sj), padded to ``length`` lags."""
        wide = np.zeros(self.s * len(seasonal) + 1)
        wide[0], wide[self.s :: self.s] = 1.0, sign * seasonal
        made = np.convolve(np.concatenate(([1.0], sign * short)), wide)
        return np.concatenate((made, np.zeros(length + 1 - len(made))))

    def polynomials(self, g: dict, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        const, own, seasonal, err, seasonal_err = self.parts(g, beta)
        return (const[0] if len(const) else 0.0), self.product(own, seasonal, -1.0, self.own), self.product(err, seasonal_err, 1.0, self.errors)

    def variants(self, g: dict, beta: Sequence[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Constants, own-lag and error-lag polynomials of the parameters and of each one moved a little; the moves."""
        beta = np.asarray(beta, float)
        moves = STEP * np.maximum(1.0, np.abs(beta))
        made = [self.polynomials(g, beta), *(self.polynomials(g, beta + moves[i] * np.eye(len(beta))[i]) for i in range(len(beta)))]
        return np.array([m[0] for m in made]), np.stack([m[1] for m in made]), np.stack([m[2] for m in made]), moves


def _dense(row: dict, layout: Layout, block_rows: int) -> np.ndarray:
    """A block's values with those before it that its first errors reach back to; NaN where there are none."""
    at = np.asarray(row["at"], int)
    z = np.full(layout.own + block_rows if row["more"] else int(at.max()) + 1, np.nan)
    z[at] = row["z"]
    return z


def _recurred(layout: Layout, z: np.ndarray, orders: list[tuple[int, Sequence[float], np.ndarray | None]]):
    """Errors of a block for each order and moved parameter, and which rows count.

    Where a value that an error needs is missing, the row's own part is taken as zero and the row doesn't count.
    """
    made = [layout.variants(layout.grid[oid], beta) for oid, beta, _ in orders]
    const, own, err = (np.concatenate([m[i] for m in made]) for i in range(3))
    count, lags = len(z) - layout.own, layout.errors
    windows = np.lib.stride_tricks.sliding_window_view(z, layout.own + 1)[:, ::-1]
    good = np.isfinite(windows).all(axis=1)
    starts = [np.zeros((len(m[0]), lags)) if st is None else np.reshape(st, (len(m[0]), lags)) for m, (_, _, st) in zip(made, orders, strict=True)]
    with np.errstate(all="ignore"):
        u = np.where(good[:, None], windows, 0.0) @ own.T - const
        u[~good] = 0.0
        e = np.concatenate((np.concatenate(starts).T, u))
        used = np.flatnonzero(np.abs(err[:, 1:]).max(axis=0) > 0) + 1
        weights = np.ascontiguousarray(err[:, used].T)
        for t in range(lags, lags + count if len(used) else 0):
            e[t] -= np.einsum("lc,lc->c", weights, e[t - used])
    return made, e, good


def _upper(k: int) -> int:
    return (k + 1) * (k + 2) // 2


def _evaluated(layout: Layout, keys: list[str], block_rows: int) -> Callable:
    """Rows (keys, order_id, n, sums): sums of products of derivatives and errors of one block."""
    width = _upper(layout.most)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                orders = [(o["order_id"], o["trial"], o["start"]) for o in row["orders"]]
                made, e, good = _recurred(layout, _dense(row, layout, block_rows), orders)
                own, at = e[layout.errors :][good], 0
                for (oid, beta, _), m in zip(orders, made, strict=True):
                    some = own[:, at : at + len(beta) + 1]
                    at += len(beta) + 1
                    with np.errstate(all="ignore"):
                        x = np.column_stack(((some[:, 1:] - some[:, :1]) / m[3], some[:, 0]))
                        xx = (x.T @ x)[np.triu_indices(x.shape[1])]
                    xx = np.where(np.isfinite(xx), xx, 1e300)  # too large for any step to be taken
                    out.append([*(row[k] for k in keys), oid, int(good.sum()), np.concatenate((xx, np.zeros(width - len(xx)))).tolist()])
            yield pd.DataFrame(out, columns=[*keys, "order_id", "rows", "part"])

    return run


def _ends(layout: Layout, keys: list[str], block_rows: int) -> Callable:
    """Rows (keys, order_id, block, map): the last errors of a full block that starts from errors of zero."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                orders = [(o["order_id"], o["trial"], None) for o in row["orders"]]
                made, e, _ = _recurred(layout, _dense(row, layout, block_rows), orders)
                last, at = e[len(e) - layout.errors :].T, 0
                for (oid, beta, _), m in zip(orders, made, strict=True):
                    out.append([*(row[k] for k in keys), oid, list(beta), row["block"], last[at : at + len(m[0])].ravel().tolist()])
                    at += len(m[0])
            yield pd.DataFrame(out, columns=[*keys, "order_id", "trial", "block", "last"])

    return run


def _across(layout: Layout, oid: int, beta: Sequence[float], rows: int) -> np.ndarray:
    """What the recurrence does to the errors before ``rows`` rows, for each moved parameter."""
    lags = layout.errors
    err = layout.variants(layout.grid[oid], beta)[2]
    step = np.zeros((len(err), lags, lags))  # from the errors in order of time to those one row later
    step[:, np.arange(lags - 1), np.arange(1, lags)] = 1.0
    step[:, -1, :] = -err[:, :0:-1]
    with np.errstate(all="ignore"):
        return np.linalg.matrix_power(step, rows)


def _applied(across: np.ndarray, state: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.einsum("vij,vj->vi", across, state)


def _starts(layout: Layout, ends: DataFrame, keys: list[str], block_rows: int) -> DataFrame:
    """(keys, order_id, block, start): the errors that each block but the first starts from."""
    lags, groups = layout.errors, [*keys, "order_id"]
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ends.schema if f.name in groups)

    def composed(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values("block")
        first = chunk.iloc[0]
        across = _across(layout, int(first.order_id), first.trial, block_rows)
        state = np.zeros((len(across), lags))
        for last in chunk["last"]:
            state = _applied(across, state) + np.reshape(last, state.shape)
        return pd.DataFrame([[*(first[k] for k in groups), first.chunk, list(first.trial), len(chunk), state.ravel().tolist()]], columns=[*groups, "chunk", "trial", "blocks", "last"])

    def carried(chunks: pd.DataFrame) -> pd.DataFrame:
        out, first, state = [], chunks.iloc[0], None
        for row in chunks.sort_values("chunk").itertuples(index=False):
            across = _across(layout, int(first.order_id), first.trial, block_rows * row.blocks)
            state = np.zeros((len(across), lags)) if state is None else state
            out.append([*(first[k] for k in groups), row.chunk, state.ravel().tolist()])
            state = _applied(across, state) + np.reshape(row.last, state.shape)
        return pd.DataFrame(out, columns=[*groups, "chunk", "into"])

    def spread(chunk: pd.DataFrame) -> pd.DataFrame:
        out, chunk = [], chunk.sort_values("block")
        first = chunk.iloc[0]
        across = _across(layout, int(first.order_id), first.trial, block_rows)
        state = np.reshape(first.into, (len(across), lags))
        for row in chunk.itertuples(index=False):
            state = _applied(across, state) + np.reshape(row.last, state.shape)
            out.append([*(first[k] for k in groups), row.block + 1, state.ravel().tolist()])
        return pd.DataFrame(out, columns=[*groups, "block", "start"])

    chunked = ends.withColumn("chunk", F.expr(f"block div {CHUNK}"))
    up = chunked.groupBy(*groups, "chunk").applyInPandas(composed, f"{kind}, chunk long, trial array<double>, blocks long, last array<double>")
    down = up.groupBy(*groups).applyInPandas(carried, f"{kind}, chunk long, into array<double>")
    met = null_safe_join(chunked, down, [*groups, "chunk"], "inner")
    return met.groupBy(*groups, "chunk").applyInPandas(spread, f"{kind}, block long, start array<double>")


def blocks_of(df: DataFrame, keys: list[str], order: Sequence[str], y: str, layout: Layout, block_rows: int, long: bool) -> DataFrame:
    """(keys, d, sd, block, more, at, z): each block's differenced values with those that its first errors reach back to.

    All orders have the rows on which the longest differences and own lags of the grid are defined. ``more`` tells
    that another block follows.
    """
    z = A.differenced(A._placed(df, keys, order, long).drop("__len"), keys, y, layout.pairs, layout.s, long)
    place = F.col("__pos") - 1 - layout.widest  # from 0, where all differences are there
    own = F.expr(f"CAST(floor((__pos - 1 - {layout.widest} - {layout.own}) / {block_rows}) AS BIGINT)")
    # the last rows of a block are looked back to by the next one; so are those before the first
    reached = F.when(F.pmod(place - layout.own, F.lit(block_rows)) >= block_rows - layout.own, own + 1)
    each = z.filter(place >= 0).withColumn("block", F.explode(F.array(own, reached))).filter("block >= 0")
    cell = F.struct((place - F.col("block") * block_rows).cast("int").alias("at"), "z")
    groups = [*keys, "d", "sd"]
    packed = each.groupBy(*groups, "block").agg(F.collect_list(cell).alias("c"))
    packed = packed.filter(F.exists("c", lambda c: c["at"] >= layout.own))
    last = packed.groupBy(*groups).agg(F.max("block").alias("last"))
    return null_safe_join(packed, last, groups, "inner").select(*groups, "block", (F.col("block") < F.col("last")).alias("more"), "c.at", "c.z")


def _stepped(layout: Layout) -> Callable:
    """The next state of each fit, from the sums at its trial parameters."""

    @F.pandas_udf(_STATE)
    def step(order_id: pd.Series, beta: pd.Series, trial: pd.Series, sums: pd.Series, n: pd.Series, damping: pd.Series, part: pd.Series, rows: pd.Series) -> pd.DataFrame:
        out = []
        for oid, old, new, had, old_n, lam, got, got_n in zip(order_id, beta, trial, sums, n, damping, part, rows, strict=True):
            k = layout.size(layout.grid[int(oid)])
            if got is None or got_n is None or np.isnan(got_n) or got_n <= k + 1:
                out.append((None, None, None, 0, lam, "too short"))
                continue
            took = np.asarray(got, float)[: _upper(k)]
            fresh = had is None
            gain = 1.0 if fresh else (had[_upper(k) - 1] - took[-1]) / max(had[_upper(k) - 1], 1e-300)
            good = bool(took.max() < 1e299)
            if fresh and not good and np.any(np.asarray(new) != 0):
                out.append((None, np.zeros(k).tolist(), None, int(got_n), 1e-3, "open"))  # from zero instead
                continue
            if fresh and not good:
                out.append((None, None, None, int(got_n), lam, "no variance"))
                continue
            if good and (fresh or gain > 0):
                old, had, lam = list(new), took.tolist(), max(lam / 10, 1e-12)
                settled = not fresh and gain < SETTLED
            else:
                lam, settled = lam * 10, lam > 1e8
            full = A._square(np.asarray(had, float)[: _upper(k)])
            jj, g = full[:k, :k], full[:k, k]
            if k and full[k, k] > 0:
                scale = 1.0 / np.sqrt(np.maximum(np.diag(jj), 1e-300))
                lifted = jj * np.outer(scale, scale) + lam * np.eye(k)
                move = -np.linalg.lstsq(lifted, scale * g, rcond=1e-14)[0] * scale
                settled = settled or bool(np.abs(move).max() < 1e-9)
            else:
                move, settled = np.zeros(k), True
            status = ("ok" if full[k, k] > 0 else "no variance") if settled else "open"
            out.append((old, (np.asarray(old) + move).tolist(), had, int(got_n), lam, status))
        return pd.DataFrame(out, columns=_STATE.names)

    return step


def _starting(layout: Layout, space: A.SearchSpace) -> Callable:
    """Parameters to begin with: those that the regression on lags gave, zero where it gave none."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def start(order_id: pd.Series, coef: pd.Series) -> pd.Series:
        out = []
        for oid, c in zip(order_id, coef, strict=True):
            g = layout.grid[int(oid)]
            if c is None or not np.all(np.isfinite(np.asarray(c, float))):
                out.append([0.0] * layout.size(g))
                continue
            at = {name: i - 1 for i, name in enumerate(space.columns)}
            names = [*space.const, *[f"z{j}" for j in range(1, g["p"] + 1)], *[f"z{layout.s * j}" for j in range(1, g["sp"] + 1)]]
            names += [*[f"e{j}" for j in range(1, g["q"] + 1)], *[f"e{layout.s * j}" for j in range(1, g["sq"] + 1)]]
            out.append([float(c[at[name]]) for name in names])
        return pd.Series(out)

    return start


def _judged(layout: Layout) -> Callable:
    kind = T.StructType([T.StructField("sse", T.DoubleType()), T.StructField("se", T.ArrayType(T.DoubleType())), T.StructField("ar_ok", T.BooleanType()), T.StructField("ma_ok", T.BooleanType())])

    @F.pandas_udf(kind)
    def judge(order_id: pd.Series, beta: pd.Series, sums: pd.Series, n: pd.Series) -> pd.DataFrame:
        out = []
        for oid, b, had, rows in zip(order_id, beta, sums, n, strict=True):
            if b is None or had is None:
                out.append((None, None, None, None))
                continue
            g, k = layout.grid[int(oid)], len(b)
            full = A._square(np.asarray(had, float)[: _upper(k)])
            spread = np.linalg.pinv(full[:k, :k], rcond=1e-13, hermitian=True) * full[k, k] / max(int(rows) - k, 1)
            roots = [np.roots(p[::-1]) for p in layout.polynomials(g, np.asarray(b, float))[1:]]
            out.append((float(full[k, k]), np.sqrt(np.maximum(np.diag(spread), 0)).tolist(), *(bool(np.all(np.abs(r) > 1.0)) for r in roots)))
        return pd.DataFrame(out, columns=["sse", "se", "ar_ok", "ma_ok"])

    return judge


def conditional_fits(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], y: str, grid: Sequence[dict], s: int = 12, trend: str = "n",
    most_steps: int = 40, block_rows: int = BLOCK, long: bool = False,
) -> DataFrame:
    """One row per series and order: parameters, standard errors, SSE, AIC, BIC, root checks and status.

    Parameters stand in the order constant, own lags, seasonal own lags, error lags, seasonal error lags.
    A fit begins at the coefficients of the regression on lags (``arima.order_search``; zero where it has none or where
    they make the errors grow without bound), and a step is taken only if it lowers the SSE, so no SSE is above
    the one it began with (``start_sse``). ``steps out`` marks fits that ``most_steps`` steps didn't
    settle; series without enough rows that count are ``too short``. Errors before a series' first row are zero. A gap in
    a long series has to be shorter than a block.
    """
    if block_rows <= s * max(g["sp"] for g in grid) + max(g["p"] for g in grid):
        raise ValueError("a block has to be longer than the longest lag")
    keys, layout, space = list(keys), Layout(grid, s, trend), A.SearchSpace(grid, s, trend)
    groups = [*keys, "order_id"]
    blocks = stage(blocks_of(df, keys, order, y, layout, block_rows, long), "css-blocks")
    several = not blocks.filter("more").isEmpty()
    begun = A.order_search(df, keys, order, y, grid, s, trend, long=long)
    none = F.lit(None)
    state = begun.select(
        *groups, "d", "sd", none.cast("array<double>").alias("beta"), _starting(layout, space)("order_id", "coef").alias("trial"), none.cast("array<double>").alias("sums"),
        F.lit(0).cast("long").alias("n"), F.lit(1e-3).alias("damping"), F.lit("open").alias("status"), none.cast("double").alias("start_sse"), F.lit(0).alias("steps"),
    )
    state = stage(state, "css-state")
    done = None
    key_kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema if f.name in groups)
    width = _upper(layout.most)
    total = F.expr("array(" + ", ".join(f"sum(part[{i}])" for i in range(width)) + ")")
    for at in range(most_steps + 1):
        listed = F.collect_list(F.struct("order_id", "trial", F.lit(None).cast("array<double>").alias("start")))
        asked = state.groupBy(*keys, "d", "sd").agg(listed.alias("orders"))
        met = null_safe_join(blocks, asked, [*keys, "d", "sd"], "inner")
        if several and layout.errors:
            ends = met.filter("more").mapInPandas(_ends(layout, keys, block_rows), f"{key_kind}, trial array<double>, block long, last array<double>")
            starts = stage(_starts(layout, stage(ends, "css-ends"), keys, block_rows), "css-starts")
            each = blocks.select(*keys, "d", "sd", "block").join(F.broadcast(_listed(layout, state.sparkSession)), ["d", "sd"])
            own = null_safe_join(null_safe_join(each, state.select(*groups, "trial"), groups, "inner"), starts, [*groups, "block"], "left")
            asked = own.groupBy(*keys, "d", "sd", "block").agg(F.collect_list(F.struct("order_id", "trial", "start")).alias("orders"))
            met = null_safe_join(blocks, asked, [*keys, "d", "sd", "block"], "inner")
        parts = met.mapInPandas(_evaluated(layout, keys, block_rows), f"{key_kind}, rows long, part array<double>")
        sums = parts.groupBy(*groups).agg(F.sum("rows").alias("rows"), total.alias("part"))
        both = null_safe_join(state, sums, groups, "left")
        made = both.withColumn("__s", _stepped(layout)("order_id", "beta", "trial", "sums", "n", "damping", "part", "rows"))
        # the first sums that a fit gets are those it began with
        first = F.when(F.col("sums").isNull() & F.col("__s.sums").isNotNull(), F.element_at("__s.sums", _last(layout))).otherwise(F.col("start_sse"))
        steps = F.col("steps") + 1
        state = stage(made.select(*groups, "d", "sd", "__s.*", first.alias("start_sse"), steps.alias("steps")), "css-state")
        closed = state.filter("status <> 'open'")
        if at == most_steps:
            closed = state.withColumn("status", F.when(F.col("status") == "open", "steps out").otherwise(F.col("status")))
        done = closed if done is None else done.unionByName(closed)
        state = state.filter("status = 'open'")
        if at == most_steps or state.isEmpty():
            break
    orders = df.sparkSession.createDataFrame([(g["order_id"], *(int(g[k]) for k in A.ORDER)) for g in grid], "order_id int, " + ", ".join(f"{k} int" for k in A.ORDER))
    fitted = done.drop("d", "sd").withColumn("__j", _judged(layout)("order_id", "beta", "sums", "n")).join(F.broadcast(orders), "order_id")
    k = F.size("beta") + 1
    loglik = -F.col("n") / 2 * (F.ln(2 * math.pi * F.when(F.col("__j.sse") > 0, F.col("__j.sse")) / F.col("n")) + 1)
    return fitted.select(
        *groups, *A.ORDER, "n", F.when(F.col("beta").isNotNull(), k).alias("k"), F.col("beta").alias("coef"), "__j.*", "start_sse", "steps", "status",
        (-2 * loglik + 2 * k).alias("aic"), (-2 * loglik + k * F.ln("n")).alias("bic"),
    )


def _last(layout: Layout):
    """Place of the error sum among an order's sums."""
    sizes = [F.lit(v) for oid, g in layout.grid.items() for v in (oid, _upper(layout.size(g)))]
    return F.element_at(F.create_map(*sizes), F.col("order_id"))


def _listed(layout: Layout, spark) -> DataFrame:
    return spark.createDataFrame([(g["d"], g["sd"], oid) for oid, g in layout.grid.items()], "d int, sd int, order_id int")
