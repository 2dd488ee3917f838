"""Token ids of whole texts by a public tokenizer, a batch of texts at a time.

Ids are those of ``tokenizers``. Latin text goes through the same vocabulary's ranks in ``tiktoken``, several
times as fast; a test compares the two.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame

NAME = "byte_bpe_50k"
END = 1
_BEYOND_LATIN = "[^\\x{00}-\\x{24f}]"


class _Encoders:
    """The tokenizer, and its vocabulary as ranks."""

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the threads
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        special = {t.content: i for i, t in self.full.get_added_tokens_decoder().items()}
        self.latin = tiktoken.Encoding("latin", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str, latin: bool) -> np.ndarray:
        if latin:
            return self.latin.encode_to_numpy(text, allowed_special="all")
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)


_KNOWN: dict[str, _Encoders] = {}


def batch_ids(texts: pa.Array, name: str = NAME, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, each with ``end`` after it if given, and where each begins and the last ends.

    Null texts are empty ones; no special tokens are added.
    """
    if name not in _KNOWN:
        _KNOWN[name] = _Encoders(name)
    encoders = _KNOWN[name]
    texts = pc.fill_null(texts.cast(pa.string()), "")
    latin = np.asarray(pc.invert(pc.match_substring_regex(texts, _BEYOND_LATIN)), bool).tolist()
    last = [] if end is None else [np.array([end], np.uint32)]
    found, sizes = [np.zeros(0, np.uint32)], []
    for text, plain in zip(texts.to_pylist(), latin, strict=True):
        ids = encoders.ids(text, plain)
        found += [ids, *last]
        sizes.append(len(ids) + len(last))
    return np.concatenate(found), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def token_ids(text: str | None, name: str = NAME) -> np.ndarray:
    """Ids of a whole text, without special tokens added (null: none)."""
    return batch_ids(pa.array([text], pa.string()), name)[0]


def with_end(text: str | None, name: str = NAME, end: int = END) -> np.ndarray:
    return np.append(token_ids(text, name), np.uint32(end))


def tokenised(docs: DataFrame, queue: str, name: str = NAME, end: int = END) -> DataFrame:
    """Documents (``doc_id``, ``text`` and a ``queue`` column) as token ids.

    Rows: ``row`` (unique), ``part`` (task), ``doc_id``, ``queue``, ``before`` (tokens of the same queue
    earlier in the same task), ``n`` and ``ids`` (little-endian 16-bit ids; the vocabulary is smaller
    than 65,536). Meant to be staged: the numbering follows the tasks that made it.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        row = part << 33
        queued: dict[str, int] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                found, starts = batch_ids(batch.column(1), name, end)
                n, before = np.diff(starts), []
                for size, source in zip(n.tolist(), batch.column(2).to_pylist(), strict=True):
                    so_far = queued.get(source, 0)
                    before.append(so_far)
                    queued[source] = so_far + size
                ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(2 * starts), pa.py_buffer(found.astype("<u2"))])
                rows = pa.array(np.arange(row, row + len(n)))
                row += len(n)
                parts = pa.array(np.full(len(n), part))
                yield pa.RecordBatch.from_arrays(
                    [rows, parts, batch.column(0), batch.column(2), pa.array(before, pa.int64()), pa.array(n, pa.int64()), ids.cast(pa.binary())],
                    ["row", "part", "doc_id", "queue", "before", "n", "ids"],
                )

    return docs.select("doc_id", "text", queue).mapInArrow(run, "row long, part long, doc_id long, queue string, before long, n long, ids binary")
