"""Compression-distance classification of toxic text.

Two zstandard dictionaries of raw content are made, one from word starts that toxic documents have more often than
others, one from those typical of ordinary documents. A window is a word (cut at 32 characters). It is
compressed with both; how many bytes the toxic dictionary saves over the ordinary one is its distance.
Each pair of neighbouring characters goes in as three bytes, so that a word of four letters is long
enough for a match to pay. Counts and shares of a document's windows beyond several thresholds go
through a logistic model, which calibrates the score.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.llm.base import staged, texts

WINDOW = 32
STEMS = range(3, 11)
THRESHOLDS = (2, 4, 6, 8, 10, 12)
TOP = max(THRESHOLDS) + 1
MEMO = 200_000
STEMS_KEPT = 20_000
CARRIER = b"@what goes before each window@"  # in both dictionaries: a frame's first match is dear, the window's own comes after it


@dataclass(frozen=True)
class Model:
    """Dictionaries and calibration; a model without dictionaries gives its base rate."""

    toxic: bytes = b""
    ordinary: bytes = b""
    mean: tuple[float, ...] = ()
    sd: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    base: float = 0.0


@lru_cache(1 << 16)
def _pair(two: str) -> bytes:
    return zlib.crc32(two.encode("utf-8", "surrogatepass")).to_bytes(4, "little")[:3]


def _coded(word: str) -> bytes:
    word = f" {word} "
    return b"".join([_pair(word[i : i + 2]) for i in range(len(word) - 1)])


def windows(text: str) -> list[str]:
    words = text.lower().split()
    if words and max(map(len, words)) > WINDOW:
        return [w[i : i + WINDOW] for w in words for i in range(0, len(w), WINDOW)]
    return words


def _compressor(dictionary: bytes):
    how = zstandard.ZstdCompressionParameters(window_log=13, hash_log=10, chain_log=10, search_log=4, min_match=7, target_length=64, strategy=zstandard.STRATEGY_DFAST, write_checksum=False, write_content_size=False, write_dict_id=False)
    known = zstandard.ZstdCompressionDict(dictionary + CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(compression_params=how, dict_data=known).compress


class _Distances(dict):
    """Window -> bytes saved by the toxic dictionary, 0 to TOP. Emptied by its user when large."""

    def __init__(self, model: Model):
        super().__init__()
        self.toxic, self.ordinary = _compressor(model.toxic), _compressor(model.ordinary)

    def __missing__(self, window: str) -> int:
        coded = CARRIER + _coded(window)
        saved = len(self.ordinary(coded)) - len(self.toxic(coded))
        self[window] = saved = min(max(saved, 0), TOP)
        return saved


_KNOWN: dict[bytes, _Distances] = {}


def _distances(model: Model) -> _Distances:
    """One per worker process and model, so that tasks share what is known."""
    key = model.toxic + b"|" + model.ordinary
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = _Distances(model)
    if len(_KNOWN[key]) > MEMO:
        _KNOWN[key].clear()
    return _KNOWN[key]


def _features(text: str, distances: _Distances) -> np.ndarray:
    found = windows(text)
    n = len(found)
    counts = np.bincount(np.fromiter(map(distances.__getitem__, found), np.int64, n), minlength=TOP + 1)
    beyond = counts[::-1].cumsum()[::-1][list(THRESHOLDS)]
    return np.concatenate([np.log1p(beyond), beyond / max(n, 1), [math.log(n + 1)]])


def _surplus(own: str, other: str, n_own: int, n_other: int) -> Column:
    """By how many deviations one side has a stem in more documents than the other's share explains."""
    expected = (F.col(other) + 0.5) * n_own / n_other
    return (F.col(own) - expected) / F.sqrt(expected + 1)


def _stems(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``stem``, ``toxic`` and ``ordinary``: in how many of the task's documents a word starts so."""
    counts = Counter(), Counter()
    for batch in batches:
        for text, y in zip(batch.column(0), batch.column(1), strict=True):
            counts[y.as_py()].update({w[:n] for w in set(windows(text.as_py())) for n in STEMS if n <= len(w)})
    stems = sorted(counts[0] | counts[1])
    for at in range(0, len(stems), 10_000):
        some = stems[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array([c[t] for t in some], pa.int64()) for c in (counts[1], counts[0]))], ["stem", "toxic", "ordinary"])


def _starts(surplus: dict[str, float], counts: Counter, least: float, size: int) -> bytes:
    """A dictionary of the word starts that stand out by ``least``, what stands out most at its end.

    A start that goes on from one taken, or is hardly more frequent than one that goes on from it, is left
    out, as they would match the same windows.
    """
    taken: list[str] = []
    known: set[str] = set()
    heads: set[str] = set()
    for stem in sorted((t for t, x in surplus.items() if x >= least), key=lambda t: (-surplus[t], -len(t), t)):
        if any(stem[:n] in known for n in STEMS) or (stem in heads and any(t.startswith(stem) and counts[stem] < 1.2 * counts[t] for t in taken)):
            continue
        if len(taken) * 3 >= size:
            break
        taken.append(stem)
        known.add(stem)
        heads |= {stem[:n] for n in STEMS}
    content = b"".join(_coded(t)[:-3] for t in reversed(taken))
    return content[-size:]


def fit(labelled: DataFrame, dictionary: int = 4096, odds: float | None = None) -> Model:
    """A model from ``text`` and ``y`` (0 or 1). With one class only it gives that class's rate.

    Equal texts count once. ``odds`` are those of a toxic document, where the rows don't show them. Texts stay in the
    tasks: counts of stems are summed up, and the driver gets the ``STEMS_KEPT`` of each side that stand out most, and the
    few features of each row.
    """
    rows = staged(labelled.groupBy(F.sha2("text", 256).alias("key")).agg(F.min("text").alias("text"), F.max("y").cast("int").alias("y")).select("text", "y"), "labelled")
    sizes = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    base = (n_toxic + 0.5) / (n_toxic + n_other + 1)
    if not n_toxic or not n_other:
        return Model(base=base)
    summed = rows.mapInArrow(_stems, "stem string, toxic long, ordinary long").groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    counts = staged(summed, "stems")
    # what only a few copies of one document share stands out as well, by as little as they are few
    sides = (("toxic", "ordinary", n_toxic, n_other, 3, max(6.0, 0.5 * math.sqrt(n_toxic))), ("ordinary", "toxic", n_other, n_toxic, 5, 3.0))
    trained = []
    for own, other, n_own, n_rest, few, least in sides:
        out = counts.where(F.col(own) >= few).select("stem", F.col(own).alias("n"), _surplus(own, other, n_own, n_rest).alias("x")).where(F.col("x") >= least)
        most = out.orderBy(F.desc("x"), "stem").limit(STEMS_KEPT).collect()
        trained.append(_starts({r.stem: r.x for r in most}, Counter({r.stem: r.n for r in most}), least, dictionary))
    if not trained[0]:  # no window stands out
        return Model(base=base)
    model = Model(trained[0], trained[1])

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_features(t.as_py(), _distances(model)).tolist() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.float64()))], ["y", "x"])

    got = rows.mapInArrow(features, "y int, x array<double>").collect()
    x, y = np.array([r.x for r in got]), np.array([r.y for r in got], float)
    mean, sd = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / sd, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(25):  # Newton steps of a logistic model with a unit ridge
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.eye(len(w)), z.T @ (y - p) - w)
    if odds:
        w[-1] += math.log(odds * n_other / n_toxic)
    return Model(trained[0], trained[1], tuple(mean), tuple(sd), tuple(w), base)


def score_text(text: str | None, model: Model) -> float:
    if not model.weights:
        return model.base
    x = (_features(text or "", _distances(model)) - np.array(model.mean)) / np.array(model.sd)
    z = float(x @ np.array(model.weights[:-1]) + model.weights[-1])
    return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every whole text; empty and null texts have one too."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [score_text(t.as_py(), model) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def learn(docs: DataFrame, labels: DataFrame, rows: int = 2000) -> Model:
    """Fit on at most ``rows`` labelled documents of each class, on their whole texts.

    ``labels`` has ``doc_id`` and ``toxic``; rows with a null are left out, a document that is labelled
    both ways counts as toxic. The sample is taken by a hash of the id. The bound holds for fitting only.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("y"))
    order = [F.xxhash64("id"), "id"]
    picked = known.where("y = 1").orderBy(*order).limit(rows).union(known.where("y = 0").orderBy(*order).limit(rows))
    own = texts(docs)
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    odds = counts[1] / counts[0] if counts.get(0) and counts.get(1) else None
    # at most twice ``rows`` ids
    got = own.join(F.broadcast(picked), own.doc_id == F.col("id")).select("id", "text", "y")
    return fit(got, odds=odds)


def held_out(id_col: str = "doc_id"):
    """A third of the ids, never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def under(docs: DataFrame, model: Model, limit: float = 0.7, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, whose text scores under ``limit``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            yield batch.filter(pa.array([score_text(t.as_py(), model) < limit for t in column], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
