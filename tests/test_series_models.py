"""Series models: every series has its result, and the same one as alone."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrill.operators import arima as A

LENGTHS = (1, 5, 14, 30, 36, 60, 300)
SPEC = {"p": 1, "d": 1, "q": 1, "sp": 1, "sd": 0, "sq": 1}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    rows = [(n, t, float(x)) for n in LENGTHS for t, x in enumerate(np.cumsum(rng.normal(size=n)) + 10)]
    return spark.createDataFrame(rows, "key int, t int, y double").cache()


def by_key(df, *columns):
    out = {}
    for r in df.select("key", *columns).collect():
        out.setdefault(r["key"], []).append(tuple(None if v is None or v != v else round(v, 6) if isinstance(v, float) else v for v in r[1:]))
    return {k: sorted(v, key=str) for k, v in out.items()}


def check(table, made, columns, alone=(1, 30, 36, 60)):
    got = by_key(made(table), *columns)
    for n in alone:
        assert by_key(made(table.filter(F.col("key") == n)), *columns).get(n) == got.get(n), n
    return got


def test_predictions(table):
    got = check(table, lambda df: A.fit_and_predict(df, ["key"], ["t"], "y", SPEC, 4, 12), ("step", "yhat", "is_forecast", "status"))
    assert set(got) == set(LENGTHS)
    for n, rows in got.items():
        ahead = [r for r in rows if r[2]]
        assert sorted(r[0] for r in ahead) == [n + 1, n + 2, n + 3, n + 4]
        assert all((r[1] is None) == (r[3] != "ok") for r in ahead) or n <= 36
    assert all(r[1] is not None for n in (60, 300) for r in got[n])


def test_order_search_keeps_every_series(table):
    grid = A.order_grid(range(2), range(2), range(2), range(1), range(1), range(1))
    got = check(table, lambda df: A.order_search(df, ["key"], ["t"], "y", grid, 12), ("order_id", "n", "bic", "status"))
    assert set(got) == set(LENGTHS) and all(len(rows) == len(grid) for rows in got.values())
    assert {r[3] for r in got[1]} == {"too short"} and {r[3] for r in got[300]} == {"ok"}


def test_unit_root_of_each_series_alone(table):
    got = check(table, lambda df: A.unit_root(df, ["key"], ["t"], "y"), ("n", "stat", "lags"), (14, 30, 60))
    assert {14, 30, 36, 60, 300} <= set(got)
