"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents. In every round a source's deficit grows by its quantum, its
target share of a window; it then sends packets (at most ``packet`` tokens of one document) while the
deficit covers them, and carries the rest on. As a queue is always backed up until it is empty, a packet
that ends at token E of its queue goes out in round ceil(E / quantum): the whole schedule, with its
carried deficits, follows from running sums per source, so no state has to be handed from one window or
partition to the next. Rounds in order, sources in order within a round, make one stream, which is cut
into windows; documents may be cut anywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrill.llm.base import running_before, staged, texts
from tallyrill.llm.tokenise import NAME, tokenised

ROUNDS = 1024  # rounds to a block of the running sum
PIECES = "doc_id long, queue string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _tail(total: int, length: int) -> list[int]:
    """Starts of the last sequences: what full windows leave over, as powers of two, longest first."""
    at, rest, starts = total - total % length, total % length, []
    while rest:
        starts.append(at)
        size = 1 << (rest.bit_length() - 1)
        at, rest = at + size, rest - size
    return starts


def quantum_of(queue: Column, corpus: Column, shares: dict[str, float] | None, length: int) -> Column:
    """Tokens a source may send in a round: its target share of a window, its share of the corpus by default."""
    share = corpus
    for name, target in (shares or {}).items():
        if target <= 0:
            raise ValueError(f"the share of {name!r} has to be over zero")
        share = F.when(queue == name, F.lit(float(target))).otherwise(share)
    return share * length


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    length: int = 2048,
    packet: int = 512,
    shares: dict[str, float] | None = None,
    tokenizer: str = NAME,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``queue``, ``start``, ``length``, ``ids`` (little-endian 32-bit),
    ``doc_tokens``, ``sequence_id`` and ``offset``.

    Every window is full but for the last tokens of the corpus, which form sequences of powers of two, so
    nothing has to be padded. ``shares`` names target proportions of sources (a few); other sources, and
    all without ``shares``, get their share of the corpus. When a queue is empty, later rounds are shorter
    and the others fill the windows on. A null or empty text is one end token; null sources share the
    queue of the empty name; repeated rows are documents of their own; no rows give no rows.
    """
    source = F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("queue")
    tokens = staged(tokenised(texts(docs, id_col, text_col, source), "queue", tokenizer), "tokens")
    light = tokens.select("row", "part", "doc_id", "queue", "before", "n")
    # tokens of a source before each task's own: one row per source and task
    by_part = light.groupBy("queue", "part").agg(F.sum("n").alias("s"))
    whole = Window.partitionBy("queue")
    earlier = F.coalesce(F.sum("s").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_part = by_part.select("queue", "part", earlier.alias("ahead"), F.sum("s").over(whole).alias("all"))
    total = light.agg(F.sum("n")).first()[0] or 0
    quantum = quantum_of(F.col("queue"), F.col("all") / F.lit(float(max(total, 1))), shares, length)
    queued = light.join(by_part, ["queue", "part"]).select("row", "doc_id", "queue", "n", (F.col("ahead") + F.col("before")).alias("at"), quantum.alias("quantum"))

    packets = queued.select("*", F.explode(F.expr(f"sequence(0L, (n - 1) div {packet})")).alias("k"))
    end = F.least((F.col("k") + 1) * packet, F.col("n"))
    packets = packets.select("row", "doc_id", "queue", "n", "at", F.ceil((F.col("at") + end) / F.col("quantum")).cast("long").alias("round"), (F.col("k") * packet).alias("start"), end.alias("end"))
    sent = packets.groupBy("row", "doc_id", "queue", "n", "at", "round").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    sent = staged(sent.withColumn("size", F.col("end") - F.col("start")).withColumn("block", F.expr(f"round div {ROUNDS}")), "sent")

    # place in the stream: blocks before, then a running sum within a block of bounded size
    ahead = running_before(sent, "block", "size", "ahead")
    inside = Window.partitionBy("block").orderBy("round", "queue", F.col("at") + F.col("start"), "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = sent.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(ahead, "block")
    placed = placed.select("row", "start", "end", (F.col("ahead") + F.col("inside")).alias("p")).withColumn("q", F.col("p") + F.col("end") - F.col("start"))

    tail = _tail(total, length)
    full = total // length
    bounds = F.array(*[F.lit(t).cast("long") for t in tail]) if tail else F.expr("cast(array() as array<long>)")
    inner = F.expr(f"transform(sequence(p div {length}, (q - 1) div {length}), w -> w * {length}L)")
    cuts = F.array_sort(F.array_union(F.filter(F.array_union(inner, bounds), lambda c: (c > F.col("p")) & (c < F.col("q"))), F.array("p")))
    cut = placed.select("row", "start", "p", "q", cuts.alias("cuts"))
    piece = F.expr("transform(cuts, (c, i) -> struct(start + c - p AS start, coalesce(get(cuts, i + 1), q) - c AS length, c AS at))")
    in_tail = F.aggregate(bounds, F.lit(0).cast("long"), lambda n, b: n + F.when(b <= F.col("piece.at"), 1).otherwise(0))
    tail_at = F.aggregate(bounds, F.lit(0).cast("long"), lambda n, b: F.when(b <= F.col("piece.at"), b).otherwise(n))
    pieces = cut.select("row", F.explode(piece).alias("piece"))
    pieces = pieces.select(
        "row",
        F.struct(
            F.col("piece.start").alias("start"),
            F.col("piece.length").alias("length"),
            F.when(in_tail > 0, full + in_tail - 1).otherwise(F.expr(f"piece.at div {length}")).alias("sequence_id"),
            F.when(in_tail > 0, F.col("piece.at") - tail_at).otherwise(F.col("piece.at") % length).alias("offset"),
        ).alias("piece"),
    )
    # one document's pieces together: no more than its own tokens
    return tokens.join(pieces.groupBy("row").agg(F.collect_list("piece").alias("pieces")), "row").select("doc_id", "queue", "n", "ids", "pieces").mapInArrow(_cut, PIECES)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            rows: list[tuple] = []
            for doc, queue, n, ids, pieces in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(ids, "<u2").astype("<u4")
                for p in sorted(pieces, key=lambda p: p["start"]):
                    a, size = p["start"], p["length"]
                    rows.append((doc, queue, a, size, ids[a : a + size].tobytes(), n, p["sequence_id"], p["offset"]))
            if rows:
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])
