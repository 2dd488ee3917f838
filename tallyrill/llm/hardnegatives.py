"""Hard negatives by rotated one-bit codes.

Vectors become whole numbers. A random rotation of a vector's direction is held as its signs, and their
alignment (inner product) with the direction; what that leaves is rotated and coded again, ``LEVELS`` times. An
anchor's direction is quantised to bit planes, so its product with a code is a sum of population counts. By
Cauchy and Schwarz the remainder can't add more than its length times that part of the anchor that is at
right angles to the last code. That gives an interval which holds the score for certain; only pairs whose
interval can matter are scored, in whole numbers. Every row is coded, anchors meet all of them in blocks,
and nothing depends on how well the codes do but the time.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrill.llm.base import staged
from tallyrill.operators.recommend import top_per

LEVELS = 6  # codes of a vector, each of what the ones before leave
PLANES = 7  # bits of an anchor's entries
BLOCK = 8192  # rows in a block
SLICE = 4096  # anchors that meet a block in one task
CELLS = 1 << 19  # pairs that are bounded at a time
SCORED = 1 << 16  # pairs that are scored at a time
NONE = (1 << 63) - 1  # stands for a null id, which comes last among ties


def rotation(width: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))[0]


@dataclass
class Codes:
    """Coded rows: ``bits`` by row, level and word, alignments by row and level, lengths.

    Each level rotates what the one before has left.
    """

    bits: np.ndarray
    align: np.ndarray
    rest: np.ndarray  # length of the part of the direction that no code holds
    norm: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Codes:
        n, width = x.shape
        words, turn = -(-width // 64), rotation(width).T
        norm = np.sqrt((x.astype(float) ** 2).sum(axis=1))
        left = x / np.where(norm > 0, norm, 1)[:, None]
        bits, align = np.zeros((n, LEVELS, words), np.uint64), np.zeros((n, LEVELS))
        for level in range(LEVELS):
            left = left @ turn
            up = np.zeros((n, words * 64), bool)
            up[:, :width] = left >= 0
            bits[:, level] = np.packbits(up, axis=1, bitorder="little").view("<u8")
            align[:, level] = np.abs(left).sum(axis=1) / math.sqrt(width)
            left -= np.where(up[:, :width], 1.0, -1.0) * (align[:, level] / math.sqrt(width))[:, None]
        return cls(bits, align, np.linalg.norm(left, axis=1), norm)

    def take(self, at: np.ndarray) -> Codes:
        return Codes(self.bits[at], self.align[at], self.rest[at], self.norm[at])


class Planes:
    """Anchors' directions, rotated as often as each level's codes, in bit planes."""

    def __init__(self, x: np.ndarray):
        n, self.width = x.shape
        words, turn = -(-self.width // 64), rotation(self.width).T
        self.norm = np.sqrt((x.astype(float) ** 2).sum(axis=1))
        unit = x / np.where(self.norm > 0, self.norm, 1)[:, None]
        self.low, self.step, self.total, self.off = (np.zeros((LEVELS, n)) for _ in range(4))
        self.planes = np.zeros((LEVELS, n, PLANES, words), np.uint64)
        for level in range(LEVELS):
            unit = unit @ turn
            self.low[level] = unit.min(axis=1)
            self.step[level] = np.maximum(unit.max(axis=1) - self.low[level], 1e-300) / (2**PLANES - 1)
            low, step = self.low[level][:, None], self.step[level][:, None]
            steps = np.rint((unit - low) / step).astype(np.int64)
            self.total[level] = steps.sum(axis=1)
            self.off[level] = np.linalg.norm(unit - low - step * steps, axis=1)
            up = np.zeros((n, PLANES, words * 64), bool)
            up[:, :, : self.width] = (steps[:, None, :] >> np.arange(PLANES)[None, :, None]) & 1
            self.planes[level] = np.packbits(up, axis=2, bitorder="little").view("<u8")

    def bounds(self, at: slice, rows: Codes) -> tuple[np.ndarray, np.ndarray]:
        """For anchors ``at`` and all ``rows``: a value that the score isn't under, and one it isn't over."""
        estimate = around = 1e-9
        for level in range(LEVELS):
            low, step, total, off = (v[level, at][:, None] for v in (self.low, self.step, self.total, self.off))
            own, align = rows.bits[:, level], rows.align[None, :, level]
            common = np.zeros((len(total), len(own)), np.int32)
            for plane in range(PLANES):
                for word in range(own.shape[1]):
                    common += np.bitwise_count(self.planes[level, at, plane, word][:, None] & own[None, :, word]).astype(np.int32) << plane
            ones = np.bitwise_count(own).sum(axis=1, dtype=np.int64)[None, :]
            product = (low * (2 * ones - self.width) + step * (2 * common - total)) / math.sqrt(self.width)
            estimate, around = estimate + align * product, around + align * off
        # what the last code leaves is at right angles to it
        aside = np.sqrt(1 - np.clip(np.abs(product) - off, 0, 1) ** 2)
        around = around + rows.rest[None, :] * aside
        size = self.norm[at][:, None] * rows.norm[None, :]
        return (estimate - around) * size - 1e-6, (estimate + around) * size + 1e-6


def _scored(x: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor and row of each pair that ``wanted`` marks, and its score."""
    a, r = np.nonzero(wanted)
    score = np.zeros(len(a), np.int64)
    for at in range(0, len(a), SCORED):
        some = slice(at, at + SCORED)
        score[some] = np.einsum("ij,ij->i", x[a[some]].astype(np.int64), rows[r[some]].astype(np.int64))
    return a, r, score


def _first(a: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each anchor's ``k`` best: by falling score, then by id."""
    order = np.lexsort((ids, -score, a))
    own = a[order]
    starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(own)]))))
    return order[rank < k]


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """Each row's ``k``-th largest value; minus infinity if it has fewer."""
    if values.shape[1] < k:
        return np.full((len(values), 1), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k][:, None]


def _coded(width: int, scale: int):
    """A row for each block: its vectors with ids, labels and codes, and its anchors by themselves."""

    def made(block: int, ids: np.ndarray, labels: np.ndarray, asked: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        codes = Codes.of(x)
        keys = block * BLOCK + np.arange(len(x))
        anchors = [{"row": int(keys[i]), "id": int(ids[i]), "label": int(labels[i]), "x": x[i].tobytes()} for i in np.flatnonzero(asked)]
        cells = [keys, ids, labels, x, codes.bits, codes.align, codes.rest, codes.norm]
        columns = [pa.array([block], pa.int64()), *(pa.array([np.ascontiguousarray(c).tobytes()]) for c in cells)]
        kind = pa.list_(pa.struct([("row", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("x", pa.binary())]))
        return pa.RecordBatch.from_arrays([*columns, pa.array([anchors], kind)], ["block", *CELL_NAMES, "anchors"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, waiting, rows = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            for part in range(0, batch.num_rows, BLOCK // 2):
                some = batch.slice(part, BLOCK // 2)
                fits = pc.fill_null(pc.equal(pc.list_value_length(some.column(3)), width), False)
                some = some.filter(pc.and_(fits, pc.is_valid(some.column(1))))
                values = some.column(3).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
                good = np.isfinite(values).all(axis=1)
                x = np.floor(values[good] * scale)
                if not len(x):
                    continue
                if np.abs(x).max() >= (1 << 31) / math.sqrt(width) - 1:
                    raise ValueError("an inner product may be beyond a long")
                kept = some.filter(pa.array(good))
                cells = [np.asarray(pc.fill_null(kept.column(i), v)) for i, v in enumerate((NONE, 0, False))]
                waiting.append([*cells, x.astype("<i4")])
                rows += len(x)
                if rows > BLOCK // 2:
                    yield made(block, *(np.concatenate(c) for c in zip(*waiting, strict=True)))
                    block, waiting, rows = block + 1_000_003, [], 0
        if waiting:
            yield made(block, *(np.concatenate(c) for c in zip(*waiting, strict=True)))

    return run


CELL_NAMES = ["keys", "ids", "labels", "x", "bits", "align", "rest", "norm"]
_KINDS = dict(zip(CELL_NAMES, ["<i8", "<i8", "<i8", "<i4", "<u8", "<f8", "<f8", "<f8"], strict=True))


def _unpacked(row: pd.Series, width: int) -> tuple[dict[str, np.ndarray], Codes]:
    cells = {c: np.frombuffer(row[c], kind) for c, kind in _KINDS.items()}
    n = len(cells["ids"])
    codes = Codes(cells["bits"].reshape(n, LEVELS, -1), cells["align"].reshape(n, LEVELS), cells["rest"], cells["norm"])
    return cells | {"x": cells["x"].reshape(n, width)}, codes


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<i4").reshape(-1, width)


def _chunks(anchors: int, rows: int) -> Iterator[slice]:
    step = max(1, CELLS // max(1, rows))
    return (slice(at, at + step) for at in range(0, anchors, step))


def _positives(width: int, k: int):
    """The best ``k`` of a block for each anchor of the same label, itself left out."""

    def search(blocks: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in blocks.iterrows() if len(anchors) else ():
            cells, codes = _unpacked(row, width)
            labels = anchors["label"].to_numpy()
            for label in np.intersect1d(labels, cells["labels"]):
                own, at = anchors[labels == label], np.flatnonzero(cells["labels"] == label)
                keys, x, rows, some = own["row"].to_numpy(), _matrix(own["x"], width), cells["x"][at], codes.take(at)
                asked = Planes(x)
                for part in _chunks(len(own), len(at)):
                    low, high = asked.bounds(part, some)
                    itself = keys[part][:, None] == cells["keys"][at][None, :]
                    low[itself] = high[itself] = -np.inf
                    a, r, score = _scored(x[part], rows, (high >= _kth(low, k)) & ~itself)
                    best = _first(a, score, cells["ids"][at][r], k)
                    out.append(pd.DataFrame({"row": keys[part][a[best]], "id": own["id"].to_numpy()[part][a[best]], "positive_id": cells["ids"][at][r[best]], "positive_score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("row", "id", "positive_id", "positive_score")})

    return search


def _negatives(width: int, k: int, least: int, most: int):
    """The best ``k`` of a block for each anchor and positive: of another label and inside the positive's window."""
    names = ["row", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def search(blocks: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if not len(anchors):
            blocks = blocks.iloc[:0]
        else:
            x, labels, ids, keys = _matrix(anchors["x"], width), anchors["label"].to_numpy(), anchors["id"].to_numpy(), anchors["row"].to_numpy()
            asked = Planes(x)
            places = max(map(len, anchors["positive_scores"]))
            windows = np.zeros((len(x), places), np.int64)  # 0 gives no window: least * 0 <= 100 * score <= most * 0
            there = np.zeros((len(x), places), bool)
            near = np.zeros((len(x), places), np.int64)
            for i, (own, found) in enumerate(zip(anchors["positive_scores"], anchors["positive_ids"], strict=True)):
                windows[i, : len(own)], near[i, : len(own)], there[i, : len(own)] = own, found, True
        for _, row in blocks.iterrows():
            cells, codes = _unpacked(row, width)
            for part in _chunks(len(anchors), len(cells["ids"])):
                low, high = asked.bounds(part, codes)
                other = labels[part][:, None] != cells["labels"][None, :]
                wanted = np.zeros(other.shape, bool)
                for j in range(places):
                    from_, to = (share * windows[part, j][:, None] / 100 for share in (least, most))
                    surely = other & (low >= from_) & (high <= to)
                    best = _kth(np.where(surely, low, -np.inf), k)
                    wanted |= other & (high >= np.maximum(from_, best)) & (low <= to) & there[part, j][:, None]
                a, r, score = _scored(x[part], cells["x"], wanted)
                for j in range(places):
                    own = windows[part, j][a]
                    inside = there[part, j][a] & (least * own <= 100 * score) & (100 * score <= most * own)
                    aj, rj, sj = a[inside], r[inside], score[inside]
                    at = _first(aj, sj, cells["ids"][rj], k)
                    aj, rj, sj = aj[at], rj[at], sj[at]
                    columns = [keys[part][aj], np.full(len(aj), j), ids[part][aj], near[part, j][aj], windows[part, j][aj], cells["ids"][rj], sj]
                    out.append(pd.DataFrame(dict(zip(names, columns, strict=True))))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in names})

    return search


def _id(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(NONE)).alias(name)


def mined(df: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, scale: int = 256) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Entries become ``floor(scale * entry)``; a score is the inner product of two such vectors. An anchor (a row
    for which ``anchors`` is true) has as positives the ``positives`` best other rows of its label. For each of them
    come the ``negatives`` best rows of other labels whose score is from ``least`` to ``most`` per cent of the
    positive's, ranked from 1. Ties go to the smaller id, null ids last. Rows with a null label, a null vector, or null or
    non-finite entries take no part, nor do vectors of another length than the most common one (of equally
    common ones the longest). Rows that repeat an id are rows of their own, each an anchor by itself. A positive
    of a score below 0 has no such window. An empty table gives an empty one.
    """
    spark = df.sparkSession
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    own = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("asked"), F.col(vec_col).alias("vector"))
    lengths = own.where("vector IS NOT NULL AND label IS NOT NULL").select(F.size("vector").alias("width")).where("width > 0").groupBy("width").count()
    usual = lengths.orderBy(F.desc("count"), F.desc("width")).first()
    if not usual:
        return empty
    width = usual.width
    kind = "block long, " + ", ".join(f"{c} binary" for c in CELL_NAMES) + ", anchors array<struct<row:long,id:long,label:long,x:binary>>"
    blocks = staged(own.mapInArrow(_coded(width, scale), kind), "codes")
    asked = blocks.select(F.explode("anchors").alias("a")).select("a.*")
    n, m = blocks.count(), asked.count()
    if not m:
        return empty
    slices, cells = -(-m // SLICE), ["block", *CELL_NAMES]
    whole = blocks.select((F.col("block") % n).alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), *cells).groupBy("bucket", "slice")

    def dealt(some: DataFrame) -> DataFrame:
        """Anchors in slices, each met by every bucket of blocks."""
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("bucket")
        return some.select("*", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("slice")).select("*", each).groupBy("bucket", "slice")

    found = whole.cogroup(dealt(asked)).applyInPandas(_positives(width, positives), "row long, id long, positive_id long, positive_score long")
    best = top_per(found, ["row"], [F.col("positive_score").desc(), F.col("positive_id")], positives)
    # five rows an anchor, in order
    listed = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct((-F.col("positive_score")).alias("s"), F.col("positive_id").alias("p")))).alias("l"))
    listed = listed.select("row", F.transform("l", lambda e: -e["s"]).alias("positive_scores"), F.transform("l", lambda e: e["p"]).alias("positive_ids"))
    ready = staged(asked.join(listed, "row"), "positives")
    kind = "row long, place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = whole.cogroup(dealt(ready)).applyInPandas(_negatives(width, negatives, least, most), kind)
    order = Window.partitionBy("row", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return best.select(_id("anchor_id"), _id("positive_id"), F.col("rank").cast("int").alias("rank"), _id("negative_id"), "positive_score", "negative_score")
