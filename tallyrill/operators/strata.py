"""Matrix factors by stochastic gradient steps over strata of user blocks and item blocks.

Users and items are dealt to ``blocks`` blocks each. In a round, user block b meets item block b + round, so no
two tasks share a row of either side, and each walks its ratings in a fixed order, those that share no row at once. After as many
rounds as blocks every rating has been used once: an epoch. Factors are staged after each round.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrill.functions.scalars import hash_unit
from tallyrill.session import stage

FACTORS = "kind string, id bigint, block int, v array<double>"


@dataclass(frozen=True)
class Factors:
    """``kind`` (user or item), ``id``, ``v``; the error after each epoch; why it ended."""

    table: DataFrame
    errors: list[float]
    stopped: str

    def side(self, kind: str, name: str) -> DataFrame:
        return self.table.where(F.col("kind") == kind).select(F.col("id").alias(name), F.col("v").alias(f"v_{name}"))

    def score(self, ratings: DataFrame) -> DataFrame:
        """``ratings`` (userid, itemid, ...) with ``prediction``; pairs with an unknown user or item are left out."""
        both = ratings.join(self.side("user", "userid"), "userid").join(self.side("item", "itemid"), "itemid")
        return both.withColumn("prediction", dot("v_userid", "v_itemid")).drop("v_userid", "v_itemid")


def dot(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


FEW = 4  # ratings of a wave from which on arrays are faster than steps one by one


def waves(users: np.ndarray, items: np.ndarray) -> list[np.ndarray]:
    """Places of the ratings in waves: each rating is in the first wave after all earlier ones of its user or its item.

    So no two ratings of a wave share a user or an item, and taking wave after wave gives each step the
    rows that it would find one after another.
    """
    of_user, of_item = [0] * (int(users.max(initial=-1)) + 1), [0] * (int(items.max(initial=-1)) + 1)
    wave = np.empty(len(users), np.int32)
    for k, (u, i) in enumerate(zip(users.tolist(), items.tolist(), strict=True)):
        a, b = of_user[u], of_item[i]
        of_user[u] = of_item[i] = wave[k] = (a if a > b else b) + 1
    order = np.argsort(wave, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(wave[order])) + 1) if len(order) else []


def walked(users: np.ndarray, items: np.ndarray, ratings: np.ndarray, p: np.ndarray, q: np.ndarray, rate: float, penalty: float) -> None:
    """One gradient step for each rating in turn, whole waves at a time; ``p`` and ``q`` are changed in place."""
    for at in waves(users, items):
        if len(at) < FEW:
            for u, i, r in zip(users[at], items[at], ratings[at], strict=True):
                a, b = p[u].copy(), q[i]
                e = 2.0 * (r - a @ b)
                p[u] += rate * (e * b - penalty * a)
                q[i] += rate * (e * a - penalty * b)
            continue
        u, i = users[at], items[at]
        a, b = p[u], q[i]
        e = 2.0 * (ratings[at] - (a * b).sum(axis=1))[:, None]
        p[u] = a + rate * (e * b - penalty * a)
        q[i] = b + rate * (e * a - penalty * b)


def _round(rate: float, penalty: float):
    def run(key: tuple, rated: pd.DataFrame, factors: pd.DataFrame) -> pd.DataFrame:
        if not len(rated):
            return factors[["kind", "id", "block", "v"]]
        own = {k: factors[factors["kind"] == k].reset_index(drop=True) for k in ("user", "item")}
        p, q = (np.stack(own[k]["v"].to_numpy()).astype(float) for k in ("user", "item"))
        h = rated["h"].to_numpy()
        order = np.argsort(h, kind="stable")
        if (np.diff(h[order]) == 0).any():
            order = np.lexsort((rated["itemid"].to_numpy(), rated["userid"].to_numpy(), h))
        users, items = (pd.Index(own[k]["id"]).get_indexer(rated[f"{k}id"])[order] for k in ("user", "item"))
        walked(users, items, rated["rating"].to_numpy()[order], p, q, rate, penalty)
        return pd.concat([own["user"].assign(v=list(p)), own["item"].assign(v=list(q))])[["kind", "id", "block", "v"]]

    return run


def factorise_by_strata(
    ratings: DataFrame, rank: int = 2, blocks: int = 4, rate: float = 0.002, penalty: float = 0.02, epochs: int = 100, enough: float = 0.001, seed: int = 7,
) -> Factors:
    """Factors of (userid, itemid, rating) by stochastic gradient steps.

    Starts from numbers in [0, 1) by hash of kind, id and place. After each epoch the error is the sum over
    ratings of the squared difference plus ``penalty / 2`` times the squared lengths of the two rows; it ends when that
    is under ``enough`` or doesn't change, after ``epochs``, or with an error where it grows without bound. A (user, item) pair is rated once. A task
    holds one stratum and its two blocks of factors, so choose ``blocks`` by the size of the table; all ratings of a
    user lie in one user block. Rows with a null are left out; without ratings there are no factors.
    """
    block = {"user": F.pmod(F.xxhash64("userid"), F.lit(blocks)).cast("int"), "item": F.pmod(F.xxhash64("itemid"), F.lit(blocks)).cast("int")}
    known = ratings.select("userid", "itemid", F.col("rating").cast("double").alias("rating")).dropna()
    rated = stage(known.withColumns({"ub": block["user"], "ib": block["item"], "h": F.xxhash64("userid", "itemid", F.lit(seed))}), "strata")

    def begun(kind: str) -> DataFrame:
        ids = rated.select(F.col(f"{kind}id").cast("bigint").alias("id"), F.col(f"{kind[0]}b").alias("block")).distinct()
        first = F.array(*[hash_unit([F.lit(kind), F.col("id"), F.lit(i)], seed) for i in range(rank)])
        return ids.select(F.lit(kind).alias("kind"), "id", "block", first.alias("v"))

    table = stage(begun("user").unionByName(begun("item")), "factors")
    errors, stopped = [], "epochs"
    if rated.isEmpty():
        return Factors(table, errors, "no ratings")
    for _ in range(epochs):
        for turn in range(blocks):
            met = rated.where(F.col("ib") == F.pmod(F.col("ub") + turn, F.lit(blocks))).select(F.col("ub").alias("task"), "userid", "itemid", "rating", "h")
            own = F.when(F.col("kind") == "user", F.col("block")).otherwise(F.pmod(F.col("block") - turn, F.lit(blocks)))
            table = stage(met.groupBy("task").cogroup(table.withColumn("task", own).groupBy("task")).applyInPandas(_round(rate, penalty), FACTORS), "factors")
        made = Factors(table, errors, stopped)
        both = rated.join(made.side("user", "userid"), "userid").join(made.side("item", "itemid"), "itemid")
        gap = F.col("rating") - dot("v_userid", "v_itemid")
        lengths = dot("v_userid", "v_userid") + dot("v_itemid", "v_itemid")
        error = both.agg(F.sum(gap * gap + penalty / 2 * lengths).alias("e")).first()["e"]
        if error is None or not np.isfinite(error):
            raise RuntimeError("the error grows without bound; choose a smaller rate")
        errors.append(float(error))
        if error < enough:
            stopped = "enough"
            break
        if len(errors) > 1 and errors[-1] == errors[-2]:
            stopped = "no change"
            break
    return Factors(table, errors, stopped)
