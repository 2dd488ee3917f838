"""Exact neighbours by pivot cells against all pairs, and how many pairs they compare."""

import numpy as np
import pandas as pd
import pytest

from tallyrill.operators import neighbors as N
from tallyrill.operators.pivots import CELLS, PivotCells

TRAIN, ASKED = "train_id bigint, label double, v array<double>", "query_id bigint, v array<double>"


def tables(spark, x, q):
    train = spark.createDataFrame([(i, float(i % 3), v.tolist()) for i, v in enumerate(x)], TRAIN)
    return train, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], ASKED)


def plain(x, q, k):
    out = set()
    for i, v in enumerate(q):
        d = np.sqrt(((x - v) ** 2).sum(1))
        out |= {(i, int(j), float(j % 3), round(float(d[j]), 9)) for j in np.lexsort((np.arange(len(x)), d))[:k]}
    return out


def given(df):
    return {(r.query_id, r.train_id, r.label, round(r.distance, 9)) for r in df.collect()}


@pytest.mark.parametrize(("k", "settings"), [(3, {}), (5, {"pivots": 40, "cell_rows": 20, "rings": 4}), (1, {"pivots": 7, "cell_rows": 5, "part_rows": 30}), (60, {"pivots": 30, "cell_rows": 20})])
def test_equals_all_pairs(spark, k, settings):
    rng = np.random.default_rng(k)
    x = np.concatenate([rng.normal(size=(300, 6)), 0.01 * rng.normal(size=(200, 6)) + 4, np.tile(rng.normal(size=6), (150, 1)), np.zeros((50, 6))])
    q = np.concatenate([rng.normal(size=(30, 6)), x[300:340], x[520:525] + 1e-9, np.zeros((2, 6)), np.full((2, 6), 50.0)])
    train, asked = tables(spark, x, q)
    found, _ = PivotCells(train, **settings).search(asked, k, slice_rows=20)
    assert given(found) == plain(x, q, k)


def test_compares_under_a_tenth_of_the_pairs_of_clustered_vectors(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(60, 24))
    x = centres[rng.integers(0, 60, 9000)] + 0.05 * rng.normal(size=(9000, 24))
    x[:3000] = centres[0] + 0.05 * rng.normal(size=(3000, 24))  # a hot cluster
    q = centres[rng.integers(1, 60, 400)] + 0.05 * rng.normal(size=(400, 24))
    cells = PivotCells((t := tables(spark, x, q))[0], cell_rows=50, part_rows=400)
    found, visits = cells.search(t[1], 4)
    assert given(found) == plain(x, q, 4)
    assert 400 * 4 <= cells.compared(visits) < 0.1 * 400 * 9000
    assert all(r[4] / r[5] <= 400 for r in cells.rings)


def test_few_rows_and_missing_vectors(spark):
    none = spark.createDataFrame([], TRAIN)
    asked = spark.createDataFrame([(1, [0.0, 0.0]), (2, None)], ASKED)
    assert N.nearest(none, asked, 2).count() == 0
    train = spark.createDataFrame([(5, 1.0, [3.0, 4.0]), (6, None, [0.0, 1.0]), (7, 0.0, None)], TRAIN)
    assert sorted((r.query_id, r.train_id, r.label, r.distance) for r in N.nearest(train, asked, 3).collect()) == [(1, 5, 1.0, 5.0), (1, 6, None, 1.0)]
    assert N.nearest(train, asked.where("query_id = 9"), 3).count() == 0


def test_visits_go_out_in_bounded_frames(spark):
    """A query that sees thousands of rings has its vector in each visit."""
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(3000, 32)), rng.normal(size=(300, 32))
    cells = PivotCells(tables(spark, x, q)[0], cell_rows=2)

    class Local:
        def mapInPandas(self, run, kind):  # noqa: N802
            frame = pd.DataFrame({"query_id": np.arange(300), "v": list(q), "bound": np.full(300, np.inf)})
            return list(run(iter([frame])))

    frames = cells._visits(Local(), 1, False)
    seen = pd.concat(frames)
    assert len(cells.rings) > 1000 and len(seen) == 300 * (len(cells.rings) - 1)
    assert not seen.duplicated(["query_id", "at", "part"]).any()
    assert max(map(len, frames)) * 32 <= CELLS
