"""Hard negatives against all pairs, and the intervals against exact scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrill.llm import hardnegatives
from tallyrill.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, x string, block long"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], y, "x", 1) for i, v, y in rows], VECTORS)


def plain(rows, asked, positives=5, negatives=3):
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v, _ in rows], dtype=object)
    last = 1 << 70
    out = []
    for i, (anchor, _, label) in enumerate(rows):
        if anchor is None or not asked(anchor):
            continue
        score = [int(s) for s in x @ x[i]]
        order = sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-score[j], last if rows[j][0] is None else rows[j][0]))
        for p in [j for j in order if rows[j][2] == label][:positives]:
            hard = [j for j in order if rows[j][2] != label and 50 * score[p] <= 100 * score[j] <= 95 * score[p]]
            out += [(anchor, rows[p][0], rank, rows[j][0], score[p], score[j]) for rank, j in enumerate(hard[:negatives], 1)]
    return sorted(out, key=str)


def given(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("width", "small"), [(64, False), (70, True), (3, False)])
def test_equals_all_pairs(spark, monkeypatch, width, small):
    rng = np.random.default_rng(width)
    centres = rng.normal(size=(6, width)) / math.sqrt(width)
    rows = [(i, (centres[i % 6] * 0.7 + rng.normal(size=width) / math.sqrt(width)).astype(np.float32), int(rng.integers(0, 4))) for i in range(700)]
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(40)]  # copies, so ties
    rows += [(10, rows[3][1], 2), (10, rows[3][1], 2), (None, rows[5][1], 1), (None, rows[5][1], 0), (2000, np.zeros(width), 1)]
    odd = [(30, None, 1), (40, rows[0][1], None), (50, [math.nan] * width, 0), (60, [None] + [0.5] * (width - 1), 0), (70, [1.0], 0), (80, [], 1), (90, [math.inf] * width, 2)]
    if small:  # many blocks and slices
        monkeypatch.setattr(hardnegatives, "SLICE", 16)
        monkeypatch.setattr(hardnegatives, "CELLS", 500)
    got = hardnegatives.mined(table(spark, rows + odd).repartition(6), F.col("vec_id") % 10 == 0)
    want = plain(rows, lambda i: i % 10 == 0)
    assert len(want) > 100
    assert given(got) == want


@pytest.mark.parametrize("width", [5, 64, 130])
def test_intervals_hold_the_score_and_leave_much_out(width):
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(3000, width)) / math.sqrt(width)).astype(np.int32)
    x[7], x[8] = 0, x[9]
    asked = hardnegatives.Planes(x[:40])
    low, high = asked.bounds(slice(0, 40), hardnegatives.Codes.of(x))
    score = x[:40].astype(float) @ x.T.astype(float)
    assert (low <= score).all() and (score <= high).all()
    if width >= 64:
        assert (high >= hardnegatives._kth(low, 6)).mean() < (0.05 if width == 64 else 0.15)


def test_without_anchors_or_rows(spark):
    assert hardnegatives.mined(table(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert hardnegatives.mined(table(spark, [(1, [1.0, 2.0], 1)]), F.col("vec_id") % 50 == 0).count() == 0
    assert hardnegatives.mined(table(spark, [(50, [1.0, 2.0], 1)]), F.col("vec_id") % 50 == 0).count() == 0
    assert hardnegatives.mined(table(spark, [(50, None, 1), (0, [1.0], None)]), F.col("vec_id") % 50 == 0).count() == 0
    assert hardnegatives.mined(table(spark, [(50, [1.0], 1), (51, [2.0], 1), (52, [1.5], 2), (53, [0.5], 2)]), F.col("vec_id") % 50 == 0).count() == 1


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = QUERIES["op11_hard_negatives"](spark, folder)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert given(got) == plain(rows, lambda i: i % 50 == 0)
