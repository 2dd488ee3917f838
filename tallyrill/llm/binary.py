"""Packed token-id matrices by best-fit-decreasing.

Documents become token ids; those longer than a row are split losslessly. Pieces, longest first, go to the
open row whose free space is the smallest that holds them. Rows stand by free space at the leaves of a
segment tree, whose inner nodes tell whether any row lies below; the search goes up and down once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrill.llm.base import texts
from tallyrill.llm.tokenise import END, NAME, batch_ids

SCHEMA = (
    "sequence_id long, n_tokens long, ids binary, positions binary, cu_seqlens array<int>, doc_ids array<long>, starts array<long>, doc_tokens array<long>"
)


class Capacities:
    """Rows by free space, 0 to ``most``."""

    def __init__(self, most: int):
        self.base = 1 << most.bit_length()
        self.held = [0] * (2 * self.base)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _count(self, space: int, by: int) -> None:
        at = self.base + space
        while at:
            self.held[at] += by
            at >>= 1

    def add(self, row: int, space: int) -> None:
        self.rows[space].append(row)
        self._count(space, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """A row with the least free space of ``size`` or more, and that space."""
        at = self.base + size
        if not self.held[at]:
            while at > 1 and (at & 1 or not self.held[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.base:
                at = 2 * at if self.held[2 * at] else 2 * at + 1
        space = at - self.base
        self._count(space, -1)
        return self.rows[space].pop(), space


def best_fit(sizes: list[int], length: int) -> list[int]:
    """Row of each piece; pieces are at most ``length``."""
    free, out, rows = Capacities(length), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        got = free.take(sizes[i])
        if got is None:
            got = rows, length
            rows += 1
        out[i] = got[0]
        free.add(got[0], got[1] - sizes[i])
    return out


def _rows(docs: list[tuple[int | None, np.ndarray]], length: int, number: int) -> pa.RecordBatch:
    pieces = [(doc, a, ids[a : a + length], len(ids)) for doc, ids in docs for a in range(0, len(ids), length)]
    held: dict[int, list[tuple]] = {}
    for piece, row in zip(pieces, best_fit([len(p[2]) for p in pieces], length), strict=True):
        held.setdefault(row, []).append(piece)
    columns: list[list] = [[] for _ in range(8)]
    for row in sorted(held):
        own = held[row]
        ends = np.cumsum([len(p[2]) for p in own])
        ids, positions = np.zeros((2, length), "<u4")
        ids[: ends[-1]] = np.concatenate([p[2] for p in own])
        positions[: ends[-1]] = np.concatenate([np.arange(len(p[2])) for p in own])
        for column, value in zip(columns, (number + row, int(ends[-1]), ids.tobytes(), positions.astype("<u2" if length <= 65536 else "<u4").tobytes(), [0, *ends.tolist()], [p[0] for p in own], [p[1] for p in own], [p[3] for p in own]), strict=True):
            column.append(value)
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 2048, buffer: int = 1 << 20, tokenizer: str = NAME) -> DataFrame:
    """Rows of ``length`` ids: ``ids`` (little-endian 32-bit, zeros after ``n_tokens``), ``positions`` (from 0
    in each piece; 16-bit up to 65,536 ids), ``cu_seqlens`` and, per piece, ``doc_ids``, ``starts``, ``doc_tokens``.

    Each task packs what it reads, about ``buffer`` tokens at a time, so nothing is shuffled and memory is
    bounded by that and the longest document. A null or empty text is one end token; repeated rows are
    documents of their own; no rows give no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, docs, held = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                found, starts = batch_ids(some.column(1), tokenizer, END)
                for doc, a, b in zip(some.column(0).to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    docs.append((doc, found[a:b]))
                    held += b - a
                    if held >= buffer:
                        yield (made := _rows(docs, length, number))
                        number, docs, held = number + made.num_rows, [], 0
        if docs:
            yield _rows(docs, length, number)

    return texts(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def pieces(packed: DataFrame) -> DataFrame:
    """One row per piece of packed rows: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``, ``ids``."""
    each = packed.select("sequence_id", "ids", F.posexplode("doc_ids").alias("i", "doc_id"), "cu_seqlens", "starts", "doc_tokens")
    size = F.expr("cu_seqlens[i + 1] - cu_seqlens[i]")
    return each.select("doc_id", F.expr("starts[i]").alias("start"), size.cast("long").alias("length"), F.expr("doc_tokens[i]").alias("doc_tokens"), "sequence_id", F.expr("cast(cu_seqlens[i] as long)").alias("offset"), F.expr("substring(ids, cu_seqlens[i] * 4 + 1, (cu_seqlens[i + 1] - cu_seqlens[i]) * 4)").alias("ids"))
