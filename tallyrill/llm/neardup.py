"""Near-copy documents by SimHash fingerprints of their word shingles, verified by Jaccard similarity.

Equal sets of shingles are one node. Nodes whose fingerprints link at ``RADIUS`` or fewer bits form groups
(``simhash.forest``), and each node meets the first of its group. A similarity of 0.8 can lie further off than
any exact radius reaches, so nodes that share one of ``BANDS`` bands of ``ROWS`` min-hashes meet too: first the
least node of the bucket, then, where a bucket still holds different components, all of them by their bit-sliced
fingerprints within ``WIDE`` bits. Every link is verified on the whole sets, the latter ones in the tasks that meet
the bucket, so only a spanning forest of links leaves them and never their pairs.

At a similarity of 0.8 a pair shares no band with probability 5e-8. A bit of the fingerprints differs with a
probability of 0.15 (0.19 for sets of four and five shingles), so more than ``WIDE`` do with 1e-8 (1e-6).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.llm import simhash
from tallyrill.llm.base import grouped_batches, staged, texts
from tallyrill.llm.components import components
from tallyrill.llm.suffixes import MEMO, grams
from tallyrill.operators.relational import join_back

BANDS, ROWS = 32, 4
RADIUS, WIDE = 3, 28  # bits of 64
BROADCAST_ROWS = 1_000_000  # ids and keys of 24 bytes
CHUNK, SHINGLES = 512, 1 << 20  # nodes, and shingles, of a bucket that one side of a comparison holds
SKETCH = 2048  # bits
BLOCK = 1024  # shingles that meet all min-hashes at a time
_rng = np.random.default_rng(5)
_XOR, _TIMES = (_rng.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) for _ in range(2))
_TIMES |= np.uint64(1)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO:
            self.clear()
        self[word] = got = xxhash.xxh64_intdigest(word)
        return got


_KNOWN = _Words()


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; fewer words are one shingle, none give none.

    Words lie between ASCII white space; A to Z count as a to z.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    hashes = np.fromiter(map(_KNOWN.__getitem__, words), np.uint64, len(words))
    return np.unique(grams(hashes, min(width, len(words)))) if words else hashes


def bands(found: np.ndarray) -> list[int]:
    """A key for each band of min-hashes; the empty set has one of its own."""
    least = np.full(BANDS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(found), BLOCK):
        np.minimum(least, ((found[at : at + BLOCK] ^ _XOR) * _TIMES).min(axis=1), out=least)
    return [xxhash.xxh64_intdigest(own.tobytes(), band) - (1 << 63) for band, own in enumerate(least.reshape(BANDS, ROWS))]


def _signed(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes()) - (1 << 63)


def _keyed(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), width) for t in batch.column(2)]
            fps = pa.array(np.array([simhash.majority(s) for s in sets], np.uint64).view(np.int64))
            columns = [pa.array(map(_signed, sets), pa.int64()), pa.array(map(len, sets), pa.int64()), fps, pa.array(map(bands, sets), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "text_key", "node", "n", "fp", "bands"])

    return run


def _sets(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 512):
                some = batch.slice(part, 512)
                sets = [shingles(t.as_py(), width).view(np.int64) for t in some.column(1)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """``pairs`` of nodes ``a``, ``b`` whose sets have at least ``share`` of their union in common."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common >= share * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def _sketches(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each set the parities of how many of its hashes end in each of ``SKETCH`` numbers, as words.

    Two sets differ in no fewer hashes than their sketches in bits.
    """
    rows = len(offsets) - 1
    out = np.zeros((rows, SKETCH // 64), np.uint64)
    for at in range(0, rows, 256):
        to = min(at + 256, rows)
        own = np.repeat(np.arange(to - at), np.diff(offsets[at : to + 1])) * SKETCH + (values[offsets[at] : offsets[to]] & (SKETCH - 1))
        odd = (np.bincount(own, minlength=(to - at) * SKETCH) & 1).astype(np.uint8)
        out[at:to] = np.packbits(odd, bitorder="little").view(np.uint64).reshape(to - at, -1)
    return out


def _linked(share: float):
    """Verified links that join the labels of each bucket, from its fingerprints within ``WIDE`` bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped_batches(batches, ["key", "x", "y"]):
            column = {k: table[k].to_numpy() for k in ("key", "x", "y", "c", "label", "node", "fp")}
            lists = table["shingles"].combine_chunks()
            offsets, values = np.asarray(lists.offsets).astype(np.int64), lists.values.to_numpy()
            sizes = np.diff(offsets)
            new = np.ones(len(sizes), bool)
            new[1:] = np.any([column[k][1:] != column[k][:-1] for k in ("key", "x", "y")], axis=0)
            begins = new.copy()
            begins[1:] |= column["label"][1:] != column["label"][:-1]
            # rows are sorted by label, so a label's first row stands for it
            root = np.maximum.accumulate(np.where(begins, np.arange(len(sizes)), 0))
            sketch = _sketches(values, offsets)
            alone = column["x"] == column["y"]

            def least(i: int, root: np.ndarray = root) -> int:
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            found = []
            for one, two in simhash.links(column["fp"].view(np.uint64), new.cumsum() - 1, WIDE):
                for at in range(0, len(one), 1 << 15):
                    a, b = one[at : at + (1 << 15)], two[at : at + (1 << 15)]
                    meet = (root[a] != root[b]) & (alone[a] | (column["c"][a] != column["c"][b]))
                    meet &= np.minimum(sizes[a], sizes[b]) >= share * np.maximum(sizes[a], sizes[b])
                    a, b = a[meet], b[meet]
                    # sets of that share differ in no more hashes
                    near = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64) <= (1 - share) / (1 + share) * (sizes[a] + sizes[b]) + 1e-6
                    for i, j in zip(a[near].tolist(), b[near].tolist(), strict=True):
                        if (x := least(i)) != (y := least(j)):
                            common = len(np.intersect1d(values[offsets[i] : offsets[i + 1]], values[offsets[j] : offsets[j + 1]], assume_unique=True))
                            if common >= share * (sizes[i] + sizes[j] - common):
                                root[max(x, y)] = min(x, y)
                                found.append((i, j))
            ends = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(column["node"][ends[:, 0]]), pa.array(column["node"][ends[:, 1]])], ["a", "b"])

    return run


def by_fingerprint(nodes: DataFrame) -> DataFrame:
    """``a``, ``n_a``, ``b``, ``n_b``: the first node of each group of fingerprints within ``RADIUS`` bits, and the others.

    ``nodes`` has ``node``, ``n`` and ``fp``.
    """
    own = F.struct("node", "n")
    distinct = staged(nodes.groupBy("fp").agg(F.min(own).alias("least"), F.count("*").alias("rows")), "fingerprints")
    labels = components(simhash.forest(distinct.select("fp"), RADIUS))
    # only groups; a fingerprint alone with its node has none
    named = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").where("label IS NOT NULL OR rows > 1").select("fp", "least", "rows", F.coalesce("label", "fp").alias("group"))
    firsts = named.groupBy("group").agg(F.min("least").alias("first"), F.count("*").alias("fps"))
    first = join_back(named, firsts, ["group"], "fps").select("fp", "first", "rows")
    met = join_back(nodes, first, ["fp"], "rows")
    return met.where(F.col("node") != F.col("first.node")).select(F.col("first.node").alias("a"), F.col("first.n").alias("n_a"), F.col("node").alias("b"), F.col("n").alias("n_b"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, share: float = 0.8) -> DataFrame:
    """``doc_id``, ``text_key``, ``node`` and ``label``, one row per document; near copies have one label.

    Documents link if the sets of their shingles of ``width`` words have a Jaccard similarity of at least
    ``share``, which has to be 0.8 or more; a group is what links join. Null texts count as empty ones, and
    texts without words are copies of one another.
    """
    if not 0.8 <= share <= 1:
        raise ValueError("share has to be from 0.8 to 1")
    own = texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = staged(own.mapInArrow(_keyed(width), "doc_id long, text_key long, node long, n long, fp long, bands array<long>"), "shingles")
    nodes = found.groupBy("node").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    near = staged(by_fingerprint(found.select("node", "n", "fp").distinct()), "close")
    keyed = nodes.select("node", "n", "fp", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("node", "n")).alias("least")).where("size > 1")
    met = staged(join_back(keyed, buckets, ["key"], "size").select("key", "node", "n", "fp", F.col("least.node").alias("first"), F.col("least.n").alias("first_n")), "buckets")

    def alike(n: str, m: str) -> Column:
        """Sizes that differ by more have too little in common."""
        return F.least(n, m) >= share * F.greatest(n, m)

    stars = met.where((F.col("node") != F.col("first")) & alike("n", "first_n")).select(F.col("first").alias("a"), F.col("node").alias("b"))
    stars = near.where(alike("n_a", "n_b")).select("a", "b").unionByName(stars).distinct()
    # one text for each node that meets another
    some = met.select("node").unionByName(near.select(F.col("a").alias("node"))).unionByName(near.select(F.col("b").alias("node")))
    texts_of = found.join(some.distinct(), "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("d"))
    texts_of = staged(texts_of.select("node", F.col("d.doc_id").alias("i"), F.col("d.text_key").alias("k")), "nodes")
    held = own.join(F.broadcast(texts_of) if texts_of.count() <= BROADCAST_ROWS else texts_of, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")))
    sets = staged(held.select("node", "text").mapInArrow(_sets(width), "node long, shingles array<long>").dropDuplicates(["node"]), "sets")
    links = staged(_verified(stars, sets, share), "links")
    labels = components(links)
    # what stays apart within a bucket; buckets of the same nodes are one
    named = met.join(labels, "node", "left").select("key", "node", "n", "fp", F.coalesce("label", "node").alias("label"))
    parts = named.groupBy("key", "label").agg(F.count("*").alias("rows"), F.sum("n").alias("n"), F.bit_xor(F.xxhash64("node")).alias("mark"))
    split = parts.groupBy("key").agg(F.count("*").alias("parts"), F.sum("rows").alias("size"), F.sum("n").alias("n"), F.bit_xor("mark").alias("mark")).where("parts > 1 AND size > 2")
    split = split.groupBy("size", "n", "mark").agg(F.min("key").alias("key"))
    chunks = F.greatest(F.ceil(F.col("size") / CHUNK), F.ceil(F.col("n") / SHINGLES)).cast("int")
    open_ = staged(join_back(named, split.select("key", "size", chunks.alias("chunks")), ["key"], "size").drop("size"), "open")
    if not open_.isEmpty():
        own_chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
        dealt = open_.withColumn("c", own_chunk).select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("o"))
        dealt = dealt.join(sets, "node").select("key", F.least("c", "o").alias("x"), F.greatest("c", "o").alias("y"), "c", "label", "node", "fp", "shingles")
        by = ["key", "x", "y"]
        across = dealt.repartition(*by).sortWithinPartitions(*by, "label", "node").mapInArrow(_linked(share), "a long, b long")
        # what is joined already goes along as one link for each node
        labels = components(labels.select(F.col("label").alias("a"), F.col("node").alias("b")).unionByName(across))
    return found.join(labels, "node", "left").select("doc_id", "text_key", "node", F.coalesce("label", "node").alias("label"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, share: float = 0.8) -> DataFrame:
    """``docs`` with the first document of each group of near copies, by id and hash of its text.

    Rows that repeat an id and a text are one document, one of them stays; rows of one id and different texts
    are documents of their own, as are those with a null id, which come last.
    """
    found = near_copies(docs, id_col, text_col, width, share)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("text_key"))
    kept = found.groupBy("label").agg(F.min(order).alias("d"), F.count("*").alias("rows"))
    kept = kept.select(F.col("d.doc_id").alias("__id"), F.col("d.text_key").alias("__key"), "rows")
    judged = docs.withColumn("__own", F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).join(
        kept, F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key"))
    )
    once = judged.where("rows = 1").select(*docs.columns)
    # only groups, whose kept row may occur again
    return once.unionByName(judged.where("rows > 1").dropDuplicates(["__id", "__own"]).select(*docs.columns))
