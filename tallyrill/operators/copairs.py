"""Pairs of users over shared items within one task: made, summed up and scored in arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Sims are told apart in nine places: 2e9 + 1 steps from 1 down to -1, and NaN before them.
STEPS = 1e9
SIM_BITS = 31


def packed(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
        to.write_table(table)
    return out.getvalue().to_pybytes()


def unpacked(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all()


def _coded(values: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The different values in order, and for each row the place of its own."""
    found = values.combine_chunks().dictionary_encode()
    order = pc.sort_indices(found.dictionary).to_numpy()
    place = np.empty(len(order), dtype=np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return found.dictionary.take(pa.array(order)), place[found.indices.to_numpy()]


def _numbers(values: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray | None]:
    """Values as doubles, and where they are, or None if none lacks."""
    there = None if values.null_count == 0 else values.is_valid().to_numpy()
    return values.to_numpy(), there


def _places(values: pa.Array | pa.ChunkedArray, among: pa.Array) -> np.ndarray:
    """The place of each value in ``among``, -1 where it is not."""
    return pc.fill_null(pc.index_in(values.cast(among.type), value_set=among), -1).to_numpy()


def correlations(x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Pearson correlation of each run of ``sizes`` pairs, 0 where a side does not vary; no run is empty."""
    starts = np.cumsum(sizes) - sizes

    def centred(v: np.ndarray) -> np.ndarray:
        # from the first value on: equal values give zeros exactly
        v = v - np.repeat(v[starts], sizes)
        return v - np.repeat(np.add.reduceat(v, starts) / sizes, sizes)

    with np.errstate(invalid="ignore", divide="ignore"):
        x, y = centred(x), centred(y)
        spread = np.sqrt(np.add.reduceat(x * x, starts) / sizes) * np.sqrt(np.add.reduceat(y * y, starts) / sizes)
        return np.where(spread == 0, 0.0, np.add.reduceat(x * y, starts) / sizes / spread)


def _sims(x: np.ndarray, y: np.ndarray, there: np.ndarray | None, sizes: np.ndarray) -> np.ndarray:
    """Correlation of each run in nine places, halves away from zero; 0 for a run of one pair. Pairs that lack a value are left out."""
    out = np.zeros(len(sizes))
    run, kept = np.flatnonzero(sizes >= 2), np.repeat(sizes >= 2, sizes)
    x, y, sizes = x[kept], y[kept], sizes[run]
    if there is not None:
        there = there[kept]
        left = np.bincount(np.repeat(np.arange(len(run)), sizes)[there], minlength=len(run))
        x, y, run, sizes = x[there], y[there], run[left > 0], left[left > 0]
    if len(run):
        r = correlations(x, y, sizes)
        # nine places: the order of neighbours must not hang on the order of summation
        out[run] = np.copysign(np.floor(np.abs(r) * STEPS + 0.5) / STEPS, r) + 0.0
    return out


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 in order, and the places they had; equal ones keep theirs. Both share 63 bits where they fit, as that sorts faster."""
    bits = max(1, (len(key) - 1).bit_length())
    if len(key) and int(key.max()) >> (63 - bits):
        order = np.argsort(key, kind="stable")
        return key[order], order
    both = np.sort((key << bits) | np.arange(len(key)))
    return both >> bits, both & ((1 << bits) - 1)


def _first(owner: np.ndarray, sim: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` rows of each owner by falling sim, NaN first, then by place."""
    step = np.where(np.isnan(sim), 0, np.rint((1 - sim) * STEPS) + 1).astype(np.int64)
    owner, order = _sorted((owner << SIM_BITS) | step)
    owner >>= SIM_BITS
    place = np.arange(len(order))
    return order[place - np.maximum.accumulate(np.where(np.r_[True, owner[1:] != owner[:-1]], place, 0)) < k]


class Part:
    """Ratings of some users (neighbour, itemid, b) by item."""

    def __init__(self, theirs: pa.Table):
        self.users, user = _coded(theirs["neighbour"])
        self.items, item = _coded(theirs["itemid"])
        order = np.argsort(item, kind="stable")
        self.length = np.bincount(item, minlength=len(self.items))
        self.start = np.cumsum(self.length) - self.length
        b, there = _numbers(theirs["b"])
        self.user, self.b, self.there = user[order], b[order], None if there is None else there[order]

    def scored(self, mine: pa.Table, nearest: int | None = None, most: int = 500_000) -> Iterator[pa.RecordBatch]:
        """Shared items and similarity of each user in ``mine`` (active, itemid, a; by active) with each other user of the part.

        About ``most`` pairs of ratings are made at a time, those of one active user at least. With ``nearest``, only the first
        so many neighbours of each active user come out.
        """
        at = _places(mine["itemid"], self.items)
        mine, at = mine.filter(pa.array(at >= 0)), at[at >= 0]
        if not len(at):
            return
        owners, owner = _coded(mine["active"])
        itself = _places(owners, self.users)
        a, a_there = _numbers(mine["a"])
        length, start, n = self.length[at], self.start[at], len(self.users)
        made = np.cumsum(length)
        # rows of an active user follow each other
        ends = np.append(np.flatnonzero(owner[1:] != owner[:-1]) + 1, len(owner))
        low = done = 0
        while low < len(ends):
            before = made[done - 1] if done else 0
            high = max(low + 1, int(np.searchsorted(made[ends - 1], before + most, side="right")))
            end, low = ends[high - 1], high
            count = length[done:end]
            row = np.repeat(np.arange(done, end), count)
            there = np.arange(len(row)) + np.repeat(start[done:end] - (made[done:end] - count - before), count)
            whose, other = owner[row], self.user[there]
            first, done = int(owner[done]), end
            fair = other != itself[whose]
            row, there, whose, other = row[fair], there[fair], whose[fair], other[fair]
            if not len(row):
                continue
            key, order = _sorted((whose - first).astype(np.int64) * n + other)
            row, there = row[order], there[order]
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.append(starts, len(key)))
            known = None
            if a_there is not None or self.there is not None:
                known = (a_there[row] if a_there is not None else True) & (self.there[there] if self.there is not None else True)
            sim = _sims(a[row], self.b[there], known, sizes)
            whose, other = np.divmod(key[starts], n)
            if nearest is not None:
                best = _first(whose, sim, nearest)
                whose, other, sizes, sim = whose[best], other[best], sizes[best], sim[best]
            columns = [owners.take(pa.array(whose + first)), self.users.take(pa.array(other)), pa.array(sizes.astype(np.int64)), pa.array(sim)]
            yield pa.RecordBatch.from_arrays(columns, names=["active", "neighbour", "shared", "sim"])
