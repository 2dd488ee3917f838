"""Coefficient tables of generalised linear models over a whole formula, factors with all their contrasts.

Each step of reweighted least squares is one pass of sums of products over the rows; the driver solves a
system as large as the number of terms. The same sums give the information matrix and so standard errors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.operators import arima as A
from tallyrill.session import stage

FAMILIES = ("binomial", "poisson", "gaussian")
INTERCEPT = "(Intercept)"


def contrasts(df: DataFrame, factors: Sequence[str], most: int = 1000) -> dict[str, list[str]]:
    """The levels of each factor as text, in order; the first is what the others are compared with.

    More than ``most`` levels of one factor are an error.
    """
    out = {}
    for c in factors:
        found = [r[0] for r in df.select(F.col(c).cast("string")).where(F.col(c).isNotNull()).distinct().limit(most + 1).collect()]
        if len(found) > most:
            raise ValueError(f"{c} has more than {most} levels")
        out[c] = sorted(found)
    return out


def design(levels: dict[str, list[str]], numeric: Sequence[str]) -> dict[str, Column]:
    """Term -> its column: the intercept, the numbers, and a 0/1 column for each level but the first."""
    out = {INTERCEPT: F.lit(1.0)}
    out |= {c: F.col(c).cast("double") for c in numeric}
    for c, names in levels.items():
        out |= {f"{c}{name}": (F.col(c).cast("string") == name).cast("double") for name in names[1:]}
    return out


def _deviance(family: str, y: Column, mu: Column) -> Column:
    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.ln(a / b)).otherwise(0.0)

    if family == "binomial":
        return 2 * (part(y, mu) + part(1 - y, 1 - mu))
    return 2 * (part(y, mu) - (y - mu)) if family == "poisson" else (y - mu) * (y - mu)


def _log_likelihood(family: str, y: Column, mu: Column) -> Column:
    if family == "binomial":
        return y * F.ln(mu) + (1 - y) * F.ln(1 - mu)
    # the logarithm of y! by Stirling's series for (y + 10)!, less the logs of y + 1 to y + 10
    z = y + 10
    series = z * F.ln(z) - z + 0.5 * F.ln(2 * math.pi * z) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    product = F.lit(0.0)
    for i in range(1, 11):
        product = product + F.ln(y + i)
    return y * F.ln(mu) - mu - (series - product)


def coefficient_table(
    df: DataFrame, label: str, numeric: Sequence[str] = (), factors: Sequence[str] = (), family: str = "binomial", most_steps: int = 25, tolerance: float = 1e-10,
) -> DataFrame:
    """(term, estimate, error, statistic, p, n, deviance, null_deviance, aic, steps), one row per term.

    ``label`` is 0 or 1 (binomial, logit), a count (poisson, log) or a number (gaussian). Rows with a null in
    a column of the formula are left out; equal rows are counted first. p is two-sided by the normal distribution, for the gaussian
    family too. A term that others determine has a null estimate. Too few rows, or a model that ``most_steps`` don't
    settle (perfect separation, for instance), is an error.
    """
    if family not in FAMILIES:
        raise ValueError(f"family has to be one of {FAMILIES}")
    used = [label, *numeric, *factors]
    plain = df.select(*used).dropna(how="any")
    levels = contrasts(plain, factors)
    terms = design(levels, numeric)
    names = [f"__t{i}" for i in range(len(terms))]
    shaped = plain.select(F.col(label).cast("double").alias("__y"), *[c.alias(n) for n, c in zip(names, terms.values(), strict=True)])
    rows = stage(shaped.groupBy("__y", *names).agg(F.count(F.lit(1)).alias("__n")), "formula")
    n, total = rows.agg(F.sum("__n"), F.sum(F.col("__n") * F.col("__y"))).first()
    if not n or n <= len(terms):
        raise ValueError("there are too few rows for the formula")
    # numbers are centred and scaled, so that the sums stay well conditioned
    spread = rows.agg(*[F.struct((F.sum(F.col("__n") * F.col(t)) / n).alias("m"), F.max(F.abs(t)).alias("s")).alias(t) for t in names]).first()
    shift = np.array([0.0, *[spread[t]["m"] for t in names[1:]]])
    scale = np.array([1.0, *[spread[t]["s"] or 1.0 for t in names[1:]]])
    scaled = [((F.col(t) - F.lit(float(a))) / F.lit(float(b))).alias(t) for t, a, b in zip(names, shift, scale, strict=True)]
    rows = rows.select("__y", "__n", *scaled)
    y, weight = F.col("__y"), F.col("__n")

    def linear(beta: np.ndarray) -> Column:
        out = F.lit(0.0)
        for b, t in zip(beta, names, strict=True):
            out = out + F.lit(float(b)) * F.col(t)
        return out

    mean = {"binomial": lambda e: 1 / (1 + F.exp(-e)), "poisson": F.exp, "gaussian": lambda e: e}[family]
    centre = total / n
    start = {"binomial": lambda: math.log(centre / (1 - centre)), "poisson": lambda: math.log(centre), "gaussian": lambda: centre}[family]
    beta, steps, deviance, null_deviance = np.zeros(len(names)), 0, None, None
    if family == "gaussian" or 0 < centre < (1 if family == "binomial" else math.inf):
        beta[0] = start()
    else:
        raise ValueError("the label doesn't vary")
    while True:
        # at the present coefficients: deviance, likelihood and the weighted sums of the next step
        eta = linear(beta)
        found = rows.withColumn("__e", eta).withColumn("__mu", mean(F.col("__e")))
        mu = F.col("__mu")
        slope = {"binomial": mu * (1 - mu), "poisson": mu, "gaussian": F.lit(1.0)}[family]
        found = found.withColumn("__w", F.sqrt(slope * weight)).withColumn("__z", F.col("__w") * (F.col("__e") + (y - mu) / slope))
        columns = ["__z", *[f"{t}w" for t in names]]
        found = found.withColumns({f"{t}w": F.col(t) * F.col("__w") for t in names})
        sums = ", ".join(f"sum(`{a}` * `{b}`)" for i, a in enumerate(columns) for b in columns[i:])
        likelihood = F.sum(weight * _log_likelihood(family, y, mu)) if family != "gaussian" else F.lit(0.0)
        row = found.agg(F.sum(weight * _deviance(family, y, mu)).alias("d"), likelihood.alias("l"), F.expr(f"array({sums})").alias("xx")).first()
        full = A._square(np.asarray(row["xx"], float))
        null_deviance = row["d"] if null_deviance is None else null_deviance
        if deviance is not None and abs(deviance - row["d"]) <= tolerance * (abs(row["d"]) + 0.1):
            break
        if steps == most_steps or not np.isfinite(full).all():
            raise RuntimeError(f"not settled after {steps} steps")
        deviance, steps = row["d"], steps + 1
        kept = _independent(full[1:, 1:])
        beta = np.zeros(len(names))
        beta[kept] = np.linalg.solve(full[1:, 1:][np.ix_(kept, kept)], full[1:, 0][kept])
    rank = len(kept)
    dispersion = row["d"] / (n - rank) if family == "gaussian" else 1.0
    cover = np.linalg.inv(full[1:, 1:][np.ix_(kept, kept)]) * dispersion
    # back to the numbers as they were
    back = np.diag(1 / scale)
    back[0, 1:] = -shift[1:] / scale[1:]
    own = back[:, kept]
    estimate, error = own @ beta[kept], np.sqrt(np.maximum(np.diag(own @ cover @ own.T), 0))
    aic = n * (math.log(2 * math.pi * row["d"] / n) + 1) + 2 * (rank + 1) if family == "gaussian" else -2 * row["l"] + 2 * rank
    out = []
    for i, term in enumerate(terms):
        if i not in kept:
            out.append((term, None, None, None, None))
            continue
        z = estimate[i] / error[i] if error[i] > 0 else math.inf
        out.append((term, float(estimate[i]), float(error[i]), float(z), math.erfc(abs(z) / math.sqrt(2))))
    shared = (int(n), float(row["d"]), float(null_deviance), float(aic), steps)
    kind = "term string, estimate double, error double, statistic double, p double, n long, deviance double, null_deviance double, aic double, steps int"
    return df.sparkSession.createDataFrame([(*o, *shared) for o in out], kind)


def _independent(gram: np.ndarray) -> list[int]:
    """The columns, in order, that those before don't determine."""
    kept: list[int] = []
    for i in range(len(gram)):
        if gram[i, i] <= 0:
            continue
        own = gram[np.ix_(kept, kept)]
        left = gram[i, i] - (gram[i, kept] @ np.linalg.solve(own, gram[kept, i]) if kept else 0.0)
        if left > 1e-9 * gram[i, i]:
            kept.append(i)
    return kept
