"""Repeated passages by sparse suffix arrays.

Only suffixes at content-selected positions are kept: the minimisers of windows of word n-grams, so placed
that any ``min_words`` words in a row hold one, at the same place in every copy. Suffixes whose first
n-gram occurs again are sorted; neighbours are compared and their match extended right and left. As other copies
may lie between two in the sort, the suffixes that share a first n-gram also compare, where they lie, the runs of
``min_words`` words whose minimiser it is; only those of very frequent n-grams do so by an exchange.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrill.llm.base import staged
from tallyrill.operators.relational import join_back

GRAM = 16
MEMO = 500_000
HELD = 20_000  # an n-gram of more suffixes is spread over tasks
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
SUFFIX = "key long, doc_id long, text_key long, at int, right binary, left binary, most int, least int, hot boolean"


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > MEMO:
            self.clear()
        self[word] = got = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return got


_KNOWN = _Words()


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").split()
    return np.fromiter(map(_KNOWN.__getitem__, words), np.uint64, len(words))


def grams(hashes: np.ndarray, width: int = GRAM) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    n = len(hashes) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        out = out * np.uint64(_BASE) + hashes[k : k + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def minimisers(hashed: np.ndarray, window: int, block: int = 1 << 14) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the least gram (the first of equal ones) of every window of grams, and how many grams before it
    the first and the last of its windows start."""
    found = []
    for start in range(0, len(hashed) - window + 1, block):
        view = np.lib.stride_tricks.sliding_window_view(hashed[start : start + block + window - 1], window)
        found.append(view.argmin(axis=1) + np.arange(start, start + len(view)))
    at, first, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_index=True, return_counts=True)
    return at, at - first, at - first - n + 1


def positions(docs: DataFrame, min_words: int) -> DataFrame:
    """``key``, ``doc_id``, ``text_key``, ``at``, ``most``, ``least``: the kept suffixes of texts of ``min_words`` words and
    more; the windows whose minimiser it is start ``most`` to ``least`` words before it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 512):
                some = batch.slice(part, 512)
                keys, rows, ats = [], [], []
                for i, text in enumerate(some.column(2)):
                    hashed = grams(word_hashes(text.as_py()))
                    own = np.stack(minimisers(hashed, min_words - GRAM + 1))
                    keys.append(hashed[own[0]].view(np.int64))
                    rows.append(np.full(own.shape[1], i))
                    ats.append(own)
                take = pa.array(np.concatenate(rows).astype(np.int64))
                places = [pa.array(c) for c in np.concatenate(ats, axis=1).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), some.column(0).take(take), some.column(1).take(take), *places], ["key", "doc_id", "text_key", "at", "most", "least"])

    return docs.mapInArrow(run, "key long, doc_id long, text_key long, at int, most int, least int")


def _suffixes(min_words: int):
    """Each kept position with the words to the right of its gram and, turned round, to its left, as big-endian 32-bit hashes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 64):
                out: list[list] = [[] for _ in range(9)]
                for doc, key, text, ats in zip(*(c.to_pylist() for c in batch.slice(part, 64).columns), strict=True):
                    hashes = word_hashes(text)
                    short = (hashes >> np.uint64(32)).astype(">u4")
                    right, left, end = short.tobytes(), short[::-1].tobytes(), 4 * len(short)
                    firsts = grams(hashes).view(np.int64)
                    for p in ats:
                        at = p["at"]
                        row = (int(firsts[at]), doc, key, at, right[4 * (at + GRAM) : 4 * (at + min_words)], left[end - 4 * at : end - 4 * at + 4 * min_words], p["most"], p["least"], p["hot"])
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], [x.split()[0] for x in SUFFIX.split(", ")])

    return run


def _again(windows: DataFrame, min_words: int) -> DataFrame:
    """The windows that occur at another place too, as spans with another document's id if there is one.

    Counted up before they are joined back, and hot ones are salted.
    """
    place = F.struct("doc_id", "text_key", "start")
    met = windows.groupBy("window").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count("*").alias("rows")).where("NOT lo <=> hi")
    back = join_back(windows, met.select("window", F.col("lo.doc_id").alias("lo"), F.col("hi.doc_id").alias("hi"), "rows"), ["window"], "rows")
    other = F.when(~F.col("lo").eqNullSafe(F.col("doc_id")) & F.col("lo").isNotNull(), F.col("lo")).when(~F.col("hi").eqNullSafe(F.col("doc_id")), F.col("hi"))
    return back.select("doc_id", "text_key", "start", (F.col("start") + min_words).alias("stop"), other.alias("other"))


# edge: 0 a match, 1 and 2 the first and last suffix of a task, 3 a window of a hot n-gram
MATCH = f"part int, edge int, {SUFFIX}, start int, stop int, other long, window long"
_NAMES = [x.split()[0] for x in MATCH.split(", ")]
_KINDS = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[x.split()[1]] for x in MATCH.split(", ")]


def _rows(count: int, **columns) -> pa.RecordBatch:
    """Rows of ``MATCH``; columns that aren't given are null."""
    given = {n: c if isinstance(c, pa.Array) else pa.array(c) for n, c in columns.items()}
    return pa.RecordBatch.from_arrays([given[n].cast(k) if n in given else pa.nulls(count, k) for n, k in zip(_NAMES, _KINDS, strict=True)], _NAMES)


class _Sorted:
    """Some sorted suffixes, each place once, their words as matrices."""

    def __init__(self, table: pa.Table, width: int):
        rows = table.combine_chunks()
        names = ["key", "doc_id", "text_key", "at", "most", "least"]
        null = np.asarray(rows["doc_id"].is_null())
        own = {n: rows[n].fill_null(0).to_numpy() for n in names}
        same = (null[1:] == null[:-1]) & np.logical_and.reduce([own[n][1:] == own[n][:-1] for n in names[:4]])
        first = np.concatenate((np.ones(min(len(null), 1), bool), ~same))
        self.rows = rows.filter(pa.array(first)).combine_chunks()
        self.null = null[first]
        self.key, self.doc, self.text, self.at, self.most, self.least = (own[n][first] for n in names)
        self.right, self.rights = self._words("right", width)
        self.left, self.lefts = self._words("left", width)

    def __len__(self) -> int:
        return len(self.key)

    def _words(self, name: str, width: int) -> tuple[np.ndarray, np.ndarray]:
        column = self.rows[name]
        sizes = pc.binary_length(column).to_numpy().astype(np.int64) // 4
        out = np.zeros((len(sizes), width), np.uint32)
        flat = np.frombuffer(b"".join(column.to_pylist()), np.uint32)
        out[np.arange(width) < sizes[:, None]] = flat
        return out, sizes

    def matches(self, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs (i, i + 1) of neighbours that share enough: i, and the words to the right and left."""

        def shared(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
            reach = np.minimum(sizes[1:], sizes[:-1])
            unlike = (words[1:] != words[:-1]) | (np.arange(words.shape[1]) >= reach[:, None])
            return np.where(unlike.any(axis=1), unlike.argmax(axis=1), words.shape[1])

        right, left = GRAM + shared(self.right, self.rights), shared(self.left, self.lefts)
        pairs = np.flatnonzero((self.key[1:] == self.key[:-1]) & (right + left >= min_words))
        return pairs, right[pairs], left[pairs]

    def windows(self, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every window whose minimiser is a suffix's first gram: the suffix, the start and a hash with the gram's own."""
        reach = min_words - GRAM + 1
        # the gram itself stands for its words: left words turned back, then its hash, then right words
        words = np.concatenate((self.left[:, : reach - 1][:, ::-1], self.right[:, : reach - 1]), axis=1).astype(np.uint64)
        sums = np.zeros((len(self), words.shape[1] + 1), np.uint64)
        for c in range(words.shape[1]):
            sums[:, c + 1] = sums[:, c] * np.uint64(_BASE) + words[:, c] + np.uint64(1)
        base = np.uint64(pow(_BASE, reach - 1, 1 << 64))
        before = np.arange(reach)
        suffix, back = np.nonzero((before <= self.most[:, None]) & (before >= self.least[:, None]))
        start = reach - 1 - back
        hashed = sums[suffix, start + reach - 1] - sums[suffix, start] * base
        # the same words may lie otherwise around the gram
        hashed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + self.key.view(np.uint64)[suffix] + back.astype(np.uint64) * np.uint64(_BASE)
        hashed = (hashed ^ (hashed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return suffix, self.at[suffix] - back, (hashed ^ (hashed >> np.uint64(29))).view(np.int64)


class _Spans:
    """For each suffix the union of its matches, which all hold its first gram, and the least other document."""

    def __init__(self, suffixes: _Sorted):
        most = np.iinfo(np.int64)
        self.own, self.none = suffixes, most.max
        self.start, self.stop, self.other, self.any = np.full(len(suffixes), most.max), np.full(len(suffixes), most.min), np.full(len(suffixes), most.max), np.zeros(len(suffixes), bool)
        self.named = np.zeros(len(suffixes), bool)

    def add(self, at: np.ndarray, start: np.ndarray, stop: np.ndarray, other: np.ndarray, named: np.ndarray) -> None:
        np.minimum.at(self.start, at, start)
        np.maximum.at(self.stop, at, stop)
        self.any[at] = True
        np.minimum.at(self.other, at[named], other[named])
        self.named[at[named]] = True

    def rows(self, part: int) -> pa.RecordBatch:
        at = np.flatnonzero(self.any)
        n = len(at)
        doc, text = self.own.rows["doc_id"].take(pa.array(at)), self.own.rows["text_key"].take(pa.array(at))
        return _rows(
            n, part=np.full(n, part, np.int32), edge=np.zeros(n, np.int32), doc_id=doc.combine_chunks(), text_key=text.combine_chunks(), at=self.own.at[at],
            start=self.start[at].astype(np.int32), stop=self.stop[at].astype(np.int32), other=pa.array(self.other[at], mask=~self.named[at]),
        )


def _add_neighbours(spans: _Spans, min_words: int) -> None:
    own = spans.own
    pairs, right, left = own.matches(min_words)
    for one, two in ((pairs, pairs + 1), (pairs + 1, pairs)):
        unlike = ~own.null[two] & (own.null[one] | (own.doc[one] != own.doc[two]))
        spans.add(one, own.at[one] - left, own.at[one] + right, own.doc[two], unlike)


def _add_windows(spans: _Spans, min_words: int, whole: np.ndarray) -> None:
    """The windows of the n-grams that are whole here, which occur at two places or more, with the least or else the last document."""
    own = spans.own
    suffix, start, hashed = own.windows(min_words)
    used = whole[suffix]
    suffix, start, hashed = suffix[used], start[used], hashed[used]
    order = np.argsort(hashed, kind="stable")
    suffix, start, hashed = suffix[order], start[order], hashed[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(hashed), 1), bool), hashed[1:] != hashed[:-1])))
    if not len(first):
        return
    null, doc = own.null[suffix], own.doc[suffix]
    sizes = np.diff(np.append(first, len(hashed)))
    most = np.iinfo(np.int64)
    # a null id is the least place
    unknown = np.repeat(np.logical_or.reduceat(null, first), sizes)
    low = np.repeat(np.minimum.reduceat(np.where(null, most.max, doc), first), sizes)
    high = np.repeat(np.maximum.reduceat(np.where(null, most.min, doc), first), sizes)
    all_null = np.repeat(np.logical_and.reduceat(null, first), sizes)
    by_low = ~unknown & (low != doc)
    by_high = ~by_low & ~all_null & (null | (high != doc))
    again = np.repeat(sizes > 1, sizes)
    spans.add(suffix[again], start[again], start[again] + min_words, np.where(by_low, low, high)[again], (by_low | by_high)[again])


def _window_rows(own: _Sorted, part: int, min_words: int) -> pa.RecordBatch:
    suffix, start, hashed = own.windows(min_words)
    n, take = len(suffix), pa.array(suffix)
    return _rows(
        n, part=np.full(n, part, np.int32), edge=np.full(n, 3, np.int32), doc_id=own.rows["doc_id"].take(take).combine_chunks(), text_key=own.rows["text_key"].take(take).combine_chunks(),
        start=start.astype(np.int32), window=hashed,
    )


def _edge(row: pa.Table, part: int, edge: int) -> pa.RecordBatch:
    own = {n: row[n].combine_chunks() for n in row.column_names}
    return _rows(1, part=[part], edge=[edge], **own)


def _cut(table: pa.Table) -> int:
    """Rows before the last key's first."""
    key = table["key"].to_numpy()
    return len(key) - int((key[::-1] == key[-1]).argmin() or len(key))


def _neighbours(min_words: int, most: int):
    """Matches among sorted suffixes: of neighbours, and of the windows of an n-gram, which is whole here unless it is hot.

    The windows of hot n-grams go out, and a task's first and last suffix as its edges. About ``most`` suffixes are held.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        before = held = None

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal before
            own = _Sorted(table if before is None else pa.concat_tables([before, table]), min_words)
            spans = _Spans(own)
            _add_neighbours(spans, min_words)
            fresh = np.arange(len(own)) >= (before is not None)  # the one before is here for its neighbour
            hot = np.asarray(own.rows["hot"])
            _add_windows(spans, min_words, fresh & ~hot)
            yield spans.rows(part)
            going = np.flatnonzero(fresh & hot)
            if len(going):
                yield _window_rows(_Sorted(own.rows.take(pa.array(going)), min_words), part, min_words)
            before = own.rows.slice(len(own) - 1)

        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            if held is None:
                yield _edge(now.slice(0, 1), part, 1)
            held = now if held is None else pa.concat_tables([held, now])
            if held.num_rows >= most:
                # a hot n-gram needn't be whole
                cut = held.num_rows if held["hot"][-1].as_py() else _cut(held)
                if cut:
                    yield from done(held.slice(0, cut))
                    held = held.slice(cut)
        if held is not None:
            if held.num_rows:
                yield from done(held)
            yield _edge(before, part, 2)

    return run


def _borders(min_words: int):
    """Matches across borders, from the edges in order of their tasks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                if row["edge"][0].as_py() == 1 and before is not None:
                    spans = _Spans(_Sorted(pa.concat_tables([before, row]), min_words))
                    _add_neighbours(spans, min_words)
                    yield spans.rows(0)
                before = row

    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """Passages of ``min_words`` words and more that occur again, in another document or the same one.

    ``doc_id``, ``start``, ``stop`` (words between white space, the end exclusive), ``other_doc_id`` (one that
    shares some of it; another document where there is one). Overlapping matches of a document are merged.
    Null, empty and shorter texts have none; rows that repeat an id and a text count once; rows of one id
    and different texts are documents of their own, as are those with a null id.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    kept = staged(positions(own, min_words), "positions")
    again = kept.groupBy("key").count().where("count > 1")
    # a passage of very many copies is salted
    held = join_back(kept, again, ["key"], "count").groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("at", "most", "least", (F.col("count") > HELD).alias("hot")))).alias("ats"))
    by = held.select(F.col("doc_id").alias("i"), F.col("text_key").alias("k"), "ats")
    texts = own.join(by, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k"))).select("doc_id", "text_key", "text", "ats")
    order = ["key", "right", "left", "doc_id", "text_key", "at"]
    suffixes = texts.mapInArrow(_suffixes(min_words), SUFFIX)
    # the whole row of a hot n-gram is the key, so a passage of very many copies spreads over tasks; others stay together
    ranged = suffixes.repartitionByRange("key", *[F.when(F.col("hot"), F.col(c)) for c in order[1:]]).sortWithinPartitions(*order)
    found = staged(ranged.mapInArrow(_neighbours(min_words, HELD), MATCH), "matches")
    # two rows of each task
    edges = found.where("edge IN (1, 2)").coalesce(1).sortWithinPartitions("part", "edge").mapInArrow(_borders(min_words), MATCH)
    windows = found.where("edge = 3").select("window", "doc_id", "text_key", "start")
    matched = found.where("edge = 0").unionByName(edges).select("doc_id", "text_key", "start", "stop", "other").unionByName(_again(windows, min_words))
    spans = matched.groupBy("doc_id", "text_key", "start", "stop").agg(F.min(F.when(~F.col("other").eqNullSafe(F.col("doc_id")), F.col("other"))).alias("other"))
    per_doc = spans.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "other"))).alias("spans"))
    merged = F.expr(
        """aggregate(slice(spans, 2, size(spans)), array(get(spans, 0)), (a, s) -> IF(s.start <= element_at(a, -1).stop,
        concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'stop', greatest(element_at(a, -1).stop, s.stop), 'other', least(element_at(a, -1).other, s.other)))),
        concat(a, array(s))))"""
    )
    return per_doc.select("doc_id", F.explode(merged).alias("s")).select("doc_id", "s.start", "s.stop", F.coalesce("s.other", "doc_id").alias("other_doc_id"))
