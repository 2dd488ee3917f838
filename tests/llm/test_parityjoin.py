"""The parity-sketch join against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, duck

from tallyrill.llm import parityjoin
from tallyrill.llm.neardup import shingles
from tallyrill.llm.queries import QUERIES, TWINS

DOCS = "doc_id long, text string, node long, key string, n_chars long"


def plain(rows, width=4, percent=85):
    """(doc_id, n, component) for each row, all pairs compared."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                label[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(own, default=None) if sets[i] else doc))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = [None, "", " \t ", "one", "ONE", "one two", "a b c", "a b c d", "A b\nc d", "a b c d e", "x" * 9000]
    for n in (5, 6, 7, 8, 9, 10, 12, 16, 25, 60, 150, 700, 2500):
        for _ in range(3):
            base = rng.choices(words, k=n)
            texts.append(" ".join(base))
            for _ in range(6):  # copies at similarities around the bound, chains included
                base = list(base)
                for _ in range(rng.randint(0, max(1, n // 45))):
                    at = rng.randrange(len(base))
                    base[at : at + 1] = rng.choice([[rng.choice(words)], [], [base[at], rng.choice(words)]])
                texts.append(" ".join(base))
    phrase = " ".join(rng.choices(words, k=30))
    texts += [f"{phrase} {' '.join(rng.choices(words, k=rng.randint(1, 8)))}" for _ in range(60)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "apart"), [(1, 64), (2, 2)])
def test_components_equal_those_of_all_pairs(spark, monkeypatch, seed, apart):
    monkeypatch.setattr(parityjoin, "APART", apart)
    monkeypatch.setattr(parityjoin, "BROADCAST_ROWS", 0 if apart == 2 else 1000)
    rows = list(enumerate(corpus(seed), 100)) + [(None, "a b c d"), (None, "only here once more then"), (101, "one two three four five six"), (7, "same text again in here"), (7, "same text again in here")]
    table = spark.createDataFrame([(i, t, 3, "k", None) for i, t in rows], DOCS).repartition(5)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in parityjoin.linked(table).collect()), key=str)
    assert got == plain(rows)
    assert len({c for *_, c in got}) < len(rows) - 60


def test_lower_bound_and_pigeonhole():
    rng = np.random.default_rng(3)
    bands = parityjoin.Bands(85)
    assert bands.apart(100, 100) == 16
    for size in [6, 7, 9, 14, 33, 90, 400, 3000]:
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 64, size, np.uint64))
            b = np.unique(np.concatenate((a[rng.permutation(len(a))[: len(a) - rng.integers(0, 1 + size // 8)]], rng.integers(0, 1 << 64, rng.integers(0, 1 + size // 8), np.uint64))))
            differ = len(np.setxor1d(a, b))
            wide, narrow = sorted((parityjoin.sketch(a), parityjoin.sketch(b)), key=len, reverse=True)
            while len(wide) > len(narrow):
                wide = wide[: len(wide) // 2] ^ wide[len(wide) // 2 :]
            assert np.bitwise_count(wide ^ narrow).sum() <= differ
            common = len(a) + len(b) - differ
            if 200 * common // 2 >= 85 * (common // 2 + differ) and differ:
                for turn in (0, 1):
                    assert set(bands.keys(a, turn)) & set(bands.keys(b, turn))


def test_runs_over_batch_borders():
    rng = np.random.default_rng(4)
    for _ in range(200):
        rows = sorted({(int(k), int(n)) for k, n in rng.integers(0, rng.integers(2, 30), (rng.integers(0, 40), 2))} | set())
        rows = sorted(rows + rows[: len(rows) // 3])
        cuts = sorted(rng.integers(0, len(rows) + 1, 5))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in p], pa.int64()) for i in (0, 1)], ["key", "node"]) for p in parts]
        got = [tuple(r.values()) for b in parityjoin._met(iter(batches)) for r in b.to_pylist()]
        nodes = {}
        for k, n in rows:
            nodes.setdefault(k, []).append(n)
        ends = {rows[0][0], rows[-1][0]} if rows else set()
        assert got == [(k, n, min(own)) for k, own in sorted(nodes.items()) for n in sorted(set(own)) if len(set(own)) > 1 or k in ends]


def test_empty_table_and_bounds(spark):
    assert parityjoin.linked(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError, match="percent"):
        parityjoin.Bands(40)
    assert len(shingles("a b c", 4)) == 1


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op12_ngram_join"](spark, folder)
    assert got.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, name):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, duck(folder), folder, name, QUERIES[name], TWINS[name]) is None
