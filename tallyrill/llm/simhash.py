"""SimHash fingerprints and their near-duplicates by bit-sliced comparison.

Distinct fingerprints are grouped by the bits of some of their blocks: at most ``radius`` differing bits
leave at least ``BLOCKS - radius`` of the blocks equal. In a group, fingerprints lie as bit planes, 64 of
them to a word. Each is compared with whole words of others: the planes' differences go into carry-save
counters, and a word is given up once all its lanes are over the radius. Only a spanning forest of each
group's links goes on, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.llm.base import grouped_batches, staged, texts
from tallyrill.llm.components import components

BITS = 64
BLOCKS = 5
CHUNK = 2048  # fingerprints of a group that one side of a comparison holds
STEP = 8  # planes between two looks at which words can be given up
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def simhash(text: str | None, width: int = 3) -> int:
    """Unsigned fingerprint: a bit is set if it is in over half of the shingles' hashes.

    Shingles of ``width`` words, repeats included; fewer words are one shingle, no words give 0.
    Words lie between ASCII white space; A to Z count as a to z.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    shingles = list(map(b" ".join, zip(*[words[i:] for i in range(width)], strict=False))) if len(words) >= width else [b" ".join(words)]
    return majority(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64, len(shingles)))


def majority(hashes: np.ndarray) -> int:
    """Unsigned fingerprint: the bits that are set in over half of the hashes; 0 without any."""
    octets = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BYTE for i in range(8)])
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(t.as_py(), width) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def _keys(radius: int) -> list[Column]:
    """(table, bits) structs: every choice of ``BLOCKS - radius`` blocks of neighbouring bits."""
    edges = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
    out = []
    for table, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - radius)):
        mask = sum(((1 << edges[b + 1]) - 1) ^ ((1 << edges[b]) - 1) for b in chosen)
        signed = mask - (1 << BITS) if mask >> 63 else mask
        out.append(F.struct(F.lit(table).alias("t"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bits")))
    return out


def links(fps: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions (smaller first) of one group within ``radius`` bits; groups lie together."""
    n = len(fps)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, n])
    lane = np.arange(n) - np.repeat(starts, sizes)
    words = -(-sizes // 64)
    first = np.r_[0, words.cumsum()]
    word = np.repeat(first[:-1], sizes) + lane // 64
    heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    bit = (lane % 64).astype(np.uint64)
    planes = np.stack([np.add.reduceat(((fps >> np.uint64(b)) & np.uint64(1)) << bit, heads) for b in range(BITS)])
    valid = np.add.reduceat(np.uint64(1) << bit, heads)
    # a fingerprint meets the words of its group from its own on
    meets = np.repeat(first[1:], sizes) - word
    slots = radius.bit_length()
    for at in _spans(meets, 1 << 18):
        own = np.repeat(np.arange(at.start, at.stop), meets[at])
        w = np.repeat(word[at], meets[at]) + np.arange(len(own)) - np.repeat(np.r_[0, meets[at].cumsum()[:-1]], meets[at])
        counters = [np.zeros(len(own), np.uint64) for _ in range(slots)]
        over = np.zeros(len(own), np.uint64)
        for b in range(BITS):
            carry = planes[b][w] ^ (np.uint64(0) - ((fps[own] >> np.uint64(b)) & np.uint64(1)))
            for i, c in enumerate(counters):
                counters[i], carry = c ^ carry, c & carry
            over |= carry
            if b % STEP == STEP - 1:
                live = (over & valid[w]) != valid[w]
                if not live.all():
                    own, w, over = own[live], w[live], over[live]
                    counters = [c[live] for c in counters]
        # what the counters hold beyond the radius, when it isn't one less than a power of two
        equal, more = np.full(len(own), _ONES), np.zeros(len(own), np.uint64)
        for i in reversed(range(slots)):
            if radius >> i & 1:
                equal &= counters[i]
            else:
                more |= equal & counters[i]
                equal &= ~counters[i]
        near = ~(over | more) & valid[w]
        hit = np.flatnonzero(near)
        lanes = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        i, j = np.nonzero(lanes)
        a, b = own[hit[i]], heads[w[hit[i]]] + j
        yield a[b > a], b[b > a]


def _spans(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of rows of about ``most`` in sum, or single rows."""
    cut = sizes.cumsum() // most
    ends = np.r_[np.flatnonzero(cut[1:] != cut[:-1]) + 1, len(sizes)]
    start = 0
    for end in ends:
        yield slice(start, int(end))
        start = int(end)


def _roots(n: int, found: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least position that each of ``n`` reaches over the links."""
    root = np.arange(n)
    for a, b in found:
        while True:
            x, y = root[a], root[b]
            if (x == y).all():
                break
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
    return root


def _forest(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped_batches(batches, ["t", "bits", "x", "y"]):
            fps = table["fp"].to_numpy().view(np.uint64)
            keys = np.stack([table[k].to_numpy().astype(np.int64) for k in ("t", "bits", "x", "y")])
            group = np.r_[0, (keys[:, 1:] != keys[:, :-1]).any(0).cumsum()] if len(fps) else np.zeros(0, int)
            root = _roots(len(fps), links(fps, group, radius))
            own = np.flatnonzero(root != np.arange(len(fps)))
            yield pa.RecordBatch.from_arrays([pa.array(fps[own].view(np.int64)), pa.array(fps[root[own]].view(np.int64))], ["a", "b"])

    return run


def forest(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Links ``a``, ``b`` that join whatever fingerprints of column ``fp`` link within ``radius`` bits.

    A group of more than ``CHUNK`` is dealt out as pairs of chunks, each a task's work of its own.
    """
    if not 0 < radius < BLOCKS:
        raise ValueError(f"radius has to be from 1 to {BLOCKS - 1}")
    keyed = fps.select("fp", F.explode(F.array(*_keys(radius))).alias("k")).select("fp", "k.t", "k.bits")
    sizes = keyed.groupBy("t", "bits").count().where("count > 1")
    chunks = F.ceil(F.col("count") / CHUNK).cast("int")
    dealt = keyed.join(sizes, ["t", "bits"]).select("t", "bits", "fp", chunks.alias("chunks"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = dealt.withColumn("c", own).select("t", "bits", "fp", "c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("o"))
    dealt = dealt.select("t", "bits", F.least("c", "o").alias("x"), F.greatest("c", "o").alias("y"), "fp")
    by = ["t", "bits", "x", "y"]
    return dealt.repartition(*by).sortWithinPartitions(*by, "fp").mapInArrow(_forest(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, one row per document.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the smallest ``doc_id``
    that can be reached (equal fingerprints link at distance 0, so copies and texts without words do). Null
    texts count as empty ones, repeated rows stay, a null id is never the smallest; no rows give no rows.
    """
    found = staged(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = staged(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    labels = components(forest(distinct, radius))
    named = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    groups = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return found.join(named.join(groups, "label").select("fp", "component_id"), "fp", "left").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with the document of the smallest id of each near-duplicate group.

    Rows that repeat the kept id within a group are copies too, one stays. Rows with a null id cannot be
    told apart, so they stay.
    """
    found = near_duplicates(docs, id_col, text_col, width, radius)
    kept = found.groupBy("doc_id").agg(F.count_if(F.col("doc_id") == F.col("component_id")).alias("n"), F.count("*").alias("rows")).where("doc_id IS NOT NULL AND (n = 0 OR rows > 1)")
    judged = docs.join(kept.select(F.col("doc_id").alias("__id"), F.col("n").alias("__n")), F.col(id_col).cast("long") == F.col("__id"), "left")
    once = judged.where("__n IS NULL").drop("__id", "__n")
    repeated = judged.where("__n > 0").drop("__id", "__n")
    # only rows whose id occurs again
    return once.unionByName(repeated.dropDuplicates([id_col]))
