"""Whitening against exact sums and a dense eigensolver."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tallyrill.llm import whitening
from tallyrill.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, component int, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], None, 9, "x") for i, v in rows], VECTORS)


def whole(v):
    return [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]


def checked(got, rows, components=8):
    """Deviations exactly, components by a dense solver, the rest by their definitions."""
    x = np.array([whole(v) for _, v in rows], dtype=object)
    n, total = len(x), x.sum(axis=0)
    apart = x * n - total
    centred = (apart.astype(float)) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == n * k
    trace = Fraction(int((apart * apart).sum()), n**3)
    for j in range(1, k + 1):
        own = np.array([by[i][j].whitened for i, _ in rows])
        want = centred @ axes[:, j - 1] / np.sqrt(values[j - 1])
        assert np.abs(own * np.sign(own @ want) - want).max() < 1e-8
        for i, _ in rows:
            assert abs(by[i][j].explained - values[j - 1] / float(trace)) <= 1e-9
    for at, (i, _) in enumerate(rows):
        assert by[i][1].n == n and int(by[i][1].deviation) == int((apart[at] * apart[at]).sum())
    assert {r.identity_error for r in got} == {got[0].identity_error} and 0 <= got[0].identity_error < 1e-9


@pytest.mark.parametrize("spread", [np.ones(40), np.exp(-np.arange(40) / 3), np.r_[np.full(12, 3.0), np.full(28, 0.1)] + np.arange(40) * 1e-3])
def test_equals_a_dense_solver(spark, spread):
    rng = np.random.default_rng(8)
    rows = [(int(i), (rng.normal(size=40) * spread).astype(np.float32)) for i in range(900)]
    rows[5] = (5, rows[4][1])  # a copy
    odd = [(2000, None), (2001, [math.nan] * 40), (2002, [math.inf] + [0.0] * 39), (2003, [None] + [0.0] * 39), (2004, [1.0, 2.0]), (2005, [])]
    checked(whitening.whitened(vectors(spark, rows + odd).repartition(4)).collect(), rows)


def test_leading_is_certified_from_a_start_without_the_answer():
    rng = np.random.default_rng(2)
    axes = np.linalg.qr(rng.normal(size=(300, 300)))[0]
    spectrum = np.sort(np.r_[np.linspace(1, 2, 292), np.linspace(2.05, 2.2, 8)])[::-1]
    passes = []

    def times(q):
        passes.append(q.shape[1])
        return axes @ (spectrum[:, None] * (axes.T @ q))

    values, found = whitening.leading(times, 300, 8)
    assert np.abs(values - spectrum[:8]).max() < 1e-13
    assert np.abs(np.abs(np.sum(found * axes[:, :8], axis=0)) - 1).max() < 1e-12
    assert max(passes) <= 24 and len(passes) < 250


def test_small_and_flat_tables(spark):
    same = [1.0, 2.0, 3.0]
    assert whitening.whitened(vectors(spark, [])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, same)])).count() == 0
    assert whitening.whitened(vectors(spark, [(i, same) for i in range(9)])).count() == 0
    rows = [(1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.0, 0.5, 0.0]), (4, [0.25, 0.5, 0.0])]
    checked(whitening.whitened(vectors(spark, rows)).collect(), rows)
    got = whitening.whitened(vectors(spark, [(None, [1.0, 0.0]), (7, [0.0, 3.0]), (7, [5.0, 1.0])])).collect()
    assert sorted((r.vec_id is None, r.component) for r in got) == [(False, 1), (False, 1), (False, 2), (False, 2), (True, 1), (True, 2)]


def test_sums_beyond_a_long(spark):
    rows = [(i, [2.0**40 * (i % 3 - 1), 2.0**39 * (i % 5), -3.0]) for i in range(40)]
    got = whitening.whitened(vectors(spark, rows)).collect()
    x = [whole(v) for _, v in rows]
    total = [sum(c) for c in zip(*x, strict=True)]
    for r in got:
        assert int(r.deviation) == sum((40 * a - s) ** 2 for a, s in zip(x[r.vec_id], total, strict=True))
    with pytest.raises(Exception, match="beyond"):
        whitening.whitened(vectors(spark, [(1, [1e30]), (2, [2.0])])).count()


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = QUERIES["op13_whitening"](spark, folder)
    assert dict(got.dtypes)["deviation"] == "bigint"
    checked(got.collect(), rows)
