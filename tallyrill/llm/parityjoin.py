"""Jaccard join of word n-gram sets by parity sketches.

A shingle toggles one bit of a sketch, so the Hamming distance of two sketches is at most the size of the
symmetric difference of their sets, which a similarity of ``percent`` bounds by the sets' sizes. Sizes fall
into bands; what can link lies in one band or in neighbouring ones, so each set is sketched for its own band
and for the one below. A band's sketch has more blocks than differing bits are allowed, so at least one block
of a linked pair is equal. A block is held as the exclusive or of the hashes of the bits set in it, which
stands for a block of any width. Sets that share a block meet; a sketch of less than a byte for each shingle
drops most of what differs, and the sets themselves decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.llm.base import staged, texts
from tallyrill.llm.components import components
from tallyrill.llm.neardup import shingles

BROADCAST_ROWS = 1_000_000  # ids and keys of 24 bytes
SEEN = 500_000  # sets a task knows to be keyed already
APART = 8192  # rows of a bucket of several components beyond which its members meet by a second sketch
STARS = 2  # rounds in which the nodes of a bucket meet one of them
SHORT = 16  # words of the sketch that goes along with the rows of a bucket
_GROUP, _BLOCK, _MIX = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(27))


class Bands:
    """Size bands for a similarity of ``percent``, and the blocks of each band's sketch."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("percent has to be from 50 to 100")
        self.percent, self.starts = percent, [1]
        while self.starts[-1] < 1 << 31:
            self.starts.append(self.starts[-1] * 100 // percent + 1)
        self.of = np.array(self.starts)

    def apart(self, a: int, b: int) -> int:
        """The most shingles that only one of two linked sets of these sizes has."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def blocks(self, band: int) -> tuple[int, int]:
        """Blocks of the sketch that joins ``band`` with itself and the next, and how many empty ones don't count.

        With ``d`` differing bits at most and ``d + 1 + spare`` blocks, ``spare + 1`` agree. So one that agrees
        isn't empty, or both sets have more than ``spare`` empty blocks; only such sets are keyed by those.
        """
        a = self.starts[band + 1] - 1
        least = self.apart(a, min(100 * a // self.percent, self.starts[band + 2] - 1)) + 1
        empty = least * math.exp(-self.starts[band] / least)
        spare = 1 + math.ceil(empty + 3 * math.sqrt(empty))
        return least + spare, spare

    def keys(self, found: np.ndarray, turn: int = 0) -> np.ndarray:
        """Keys of the blocks of the sketches of a sorted set; ``turn`` deals out its shingles anew."""
        if turn:
            found = np.sort(_mixed(found * (_GROUP + np.uint64(2 * turn))))
        band = int(np.searchsorted(self.of, len(found), side="right")) - 1
        keys = []
        for g in (band, band - 1):
            if not len(found) or g < 0 or self.blocks(g)[0] - self.blocks(g)[1] == 1:
                continue  # nothing, or equal sets only, which are one
            n, spare = self.blocks(g)
            block = ((found >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)  # ascending
            starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
            words, at = np.bitwise_xor.reduceat(found, starts), block[starts]
            if n - len(at) > spare:
                left = np.setdiff1d(np.arange(n, dtype=np.uint64), at)
                words, at = np.concatenate((words, np.zeros(len(left), np.uint64))), np.concatenate((at, left))
            keys.append(_mixed(words ^ _mixed(at * _BLOCK + np.uint64((g + 1) * int(_GROUP) & 0xFFFFFFFFFFFFFFFF))))
        return np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)


def sketch(found: np.ndarray, words: int | None = None) -> np.ndarray:
    """Parity bits, four to eight for each shingle if not in so many words; halves fold into the sketch of half the width."""
    words = words or 1 << max(0, math.ceil(math.log2(max(1, len(found)) / 16)))
    bits = np.zeros(words, np.uint64)
    np.bitwise_xor.at(bits, (found >> np.uint64(6)) & np.uint64(words - 1), np.uint64(1) << (found & np.uint64(63)))
    return bits


def _keyed(width: int, bands: Bands):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in range(0, batch.num_rows, 512):
                some = batch.slice(part, 512)
                nodes, sizes, keys = [], [], []
                for text in some.column(2):
                    found = shingles(text.as_py(), width)
                    node = xxhash.xxh64_intdigest(found.tobytes()) - (1 << 63)
                    keys.append(None if node in seen else bands.keys(found))
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(node)
                    nodes.append(node)
                    sizes.append(len(found))
                columns = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), *columns], ["doc_id", "text_key", "node", "n", "keys"])

    return run


def _sets(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 512):
                some = batch.slice(part, 512)
                sets = [shingles(t.as_py(), width) for t in some.column(1)]
                forms = (lambda x: sketch(x, SHORT), sketch, np.asarray)
                columns = [pa.array([f(x).view(np.int64) for x in sets], pa.list_(pa.int64())) for f in forms]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(map(len, sets), pa.int64()), *columns], ["node", "n", "short", "sketch", "shingles"])

    return run


def _met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys that several nodes have, with the first node of the key in this task, from sorted rows.

    A task's first and last key are always given, as they may go on in its neighbours.
    """
    key = first = last = None  # of the run that is open: its key, its first and its latest node
    waits = False  # whether the latest row is the run's only one and not given yet
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, nodes = (np.asarray(batch.column(i)) for i in (0, 1))
        carried = key is not None
        if carried:
            keys, nodes = np.concatenate(([key], keys)), np.concatenate(([last], nodes))
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        fresh = np.concatenate(([True], new[1:] | (nodes[1:] != nodes[:-1])))
        keys, nodes, new = keys[fresh], nodes[fresh], new[fresh]
        starts, run = np.flatnonzero(new), np.cumsum(new) - 1
        centre = nodes[starts]
        if carried:
            centre[0] = first
        several = np.diff(np.concatenate((starts, [len(keys)]))) > 1
        several[0] |= not waits  # the task's first run, or one whose rows were given before
        give = several[run]
        if carried and not waits:
            give[0] = False
        key, first, last, waits = keys[-1], centre[-1], nodes[-1], not several[-1]
        yield pa.RecordBatch.from_arrays([pa.array(x[give]) for x in (keys, nodes, centre[run])], ["key", "node", "centre"])
    if waits:
        yield pa.RecordBatch.from_arrays([pa.array(np.array([x])) for x in (key, last, first)], ["key", "node", "centre"])


def _refined(bands: Bands):
    """``key`` and ``node``: a key for each block of a second sketch within the first key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, node, found in zip(*(batch.column(i) for i in range(3)), strict=True):
                own = bands.keys(np.sort(np.array(found.as_py(), np.int64).view(np.uint64)), 1).view(np.uint64)
                keys = _mixed(own ^ np.array([key.as_py()], np.int64).view(np.uint64) * _BLOCK).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), node.as_py()))], ["key", "node"])

    return run


def _differing(a: Column, b: Column) -> Column:
    """Hamming distance of two sketches; the wider one is folded."""

    def folded(x: Column, y: Column) -> Column:
        half = F.size(y)
        return F.when(F.size(x) > half, F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(x)

    return F.aggregate(F.zip_with(folded(a, b), folded(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, x: total + x)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` of nodes ``a``, ``b`` whose sets are similar enough; sketches go along with all, sets with few."""

    def both(some: DataFrame, column: str) -> DataFrame:
        for end in ("a", "b"):
            some = some.join(sets.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col(column).alias(f"{column}_{end}")), end)
        return some

    total = F.col("n_a") + F.col("n_b")
    alike = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    differing = _differing(F.col("sketch_a"), F.col("sketch_b"))
    near = both(pairs, "sketch").where(alike & (differing * (100 + percent) <= total * (100 - percent))).select("a", "b")
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return both(near, "shingles").where(100 * common >= percent * (total - common)).select("a", "b")


def _unpaired(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of one key that have different labels, weren't compared as centre and member, and may link by their short sketches."""
    own = rows.join(sets.select("node", "n", "short"), "node")
    x, y = (own.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("label", "node", "centre", "n", "short"))) for s in "ab")
    differing = sum((F.bit_count(F.get("short_a", F.lit(i)).bitwiseXOR(F.get("short_b", F.lit(i)))) for i in range(SHORT)), F.lit(0))
    total = F.col("n_a") + F.col("n_b")
    may = (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (differing * (100 + percent) <= total * (100 - percent))
    # part of the join, so that what can't link is never a row
    fresh = (F.col("label_a") < F.col("label_b")) & (F.col("node_a") != F.col("centre_b")) & (F.col("node_b") != F.col("centre_a"))
    met = x.withColumnRenamed("key", "k").join(y, (F.col("k") == F.col("key")) & fresh & may)
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles`` and ``component_id``, one row per row of ``docs``.

    A text's set holds its distinct runs of ``width`` words (fewer words are one run); words lie between ASCII
    white space and A to Z count as a to z. Two texts link if ``100 * common >= percent * union``, counted on
    64-bit hashes of the runs; ``component_id`` is the least id that links reach. Null texts and texts without words have no shingle, link
    with nothing and are their own component. Rows that repeat an id count by their own texts; a null id is
    never a component's id unless no member has another. An empty table gives an empty one.
    """
    bands = Bands(percent)
    own = texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = staged(own.mapInArrow(_keyed(width, bands), "doc_id long, text_key long, node long, n long, keys array<long>"), "parity")
    keyed = found.select(F.explode("keys").alias("key"), "node")
    ranges = keyed.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    met = staged(ranges.mapInArrow(_met, "key long, node long, centre long"), "met")
    stars = met.where("node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    # a key may go over several tasks' borders, so all its nodes count
    shared = met.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most").select("key")
    asked = met.join(shared, "key", "left_semi").select("node").distinct()
    first = found.join(asked, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("d"))
    first = staged(first.select("node", F.col("d.doc_id").alias("i"), F.col("d.text_key").alias("k")), "nodes")
    held = own.join(F.broadcast(first) if first.count() <= BROADCAST_ROWS else first, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")))
    kept = held.select("node", "text").mapInArrow(_sets(width), "node long, n long, short array<long>, sketch array<long>, shingles array<long>")
    sets = staged(kept.dropDuplicates(["node"]), "sets")
    links = staged(_verified(stars, sets, percent), "links")
    labels = components(links)
    kept_apart = met.join(shared, "key", "left_semi")

    def apart(labels: DataFrame) -> DataFrame:
        """The rows of buckets whose nodes lie in several components."""
        named = kept_apart.join(labels, "node", "left").select("key", "node", "centre", F.coalesce("label", "node").alias("label"))
        parts = named.groupBy("key", "label").agg(F.count("*").alias("rows")).groupBy("key").agg(F.count("*").alias("parts"), F.sum("rows").alias("rows"))
        return staged(named.join(parts.where("parts > 1 AND rows > 2"), "key"), "open")

    # all of such a bucket meet another of its nodes, then only what is still apart is paired
    open_ = apart(labels)
    for turn in range(STARS):
        if open_.isEmpty():
            break
        middle = open_.groupBy("key").agg(F.min_by(F.struct("node", "label"), F.xxhash64("node", F.lit(turn))).alias("m"))
        stars = open_.join(middle, "key").where("label <> m.label").select(F.least("node", "m.node").alias("a"), F.greatest("node", "m.node").alias("b")).distinct()
        links = staged(links.unionByName(_verified(stars, sets, percent)), "links")
        labels = components(links)
        open_ = apart(labels)
    if not open_.isEmpty():
        large = open_.where(F.col("rows") > APART)
        told = staged(large.join(sets, "node").select("key", "node", "shingles").mapInArrow(_refined(bands), "key long, node long").distinct(), "refined")
        told = told.join(large.select("node", "label").distinct(), "node").withColumn("centre", F.lit(0).cast("long"))
        pairs = _unpaired(open_.where(F.col("rows") <= APART), sets, percent).unionByName(_unpaired(told, sets, percent)).distinct()
        links = staged(links.unionByName(_verified(pairs, sets, percent)), "links")
        labels = components(links)
    named = found.select("doc_id", "text_key", "node", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = named.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = named.join(ids, "label", "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id")
