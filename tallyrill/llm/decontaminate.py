"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A seed is the hash of the words at a mask's set positions; the others may differ. Seeds of all documents
are joined with those of the benchmark. Around each hit, document and item are laid side by side and every run
that meets the rule and lies in no longer one is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.llm.base import staged, texts

MASKS = ("111101", "110010011")  # five words; together they meet every overlap with an item of WHOLE words or more
WHOLE = 11  # items of fewer words have to occur whole
SHARE = 0.8  # of a run's words match
BROADCAST_ROWS = 1_000_000  # benchmark seeds of 32 bytes, or item words of 8


def words(text: str) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), "")


def hashed(text: str) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _seeds(masks: list[str]) -> str:
    """SQL text: for array ``w``, structs (at, seed) of all masks at all positions where they fit."""
    parts = []
    for i, mask in enumerate(masks):
        chosen = ", ".join(f"get(w, a + {k})" for k, bit in enumerate(mask) if bit == "1")
        parts.append(f"IF(size(w) < {len(mask)}, cast(array() as array<struct<at:int,seed:bigint>>), transform(sequence(0, size(w) - {len(mask)}), a -> struct(a AS at, xxhash64({i}, {chosen}) AS seed)))")
    return f"flatten(transform(array(words), w -> concat({', '.join(parts)})))"


def _runs(least: str) -> str:
    """SQL text: first and last index into ``q``, the places that match, of every maximal run.

    A run has ``least`` places at least, and four in five of its words are among them: ``5 * y - 4 * q[y]``
    falls by one at most from its first to its last.
    """
    height = "(5 * {0} - 4 * get(q, {0}))".format
    last = f"array_max(filter(sequence(low, size(q) - 1), y -> {height('y')} >= {height('x')} - 1))"
    further = f"get(transform(array(greatest(r.best + 1, x + {least} - 1)), low -> IF(low < size(q), coalesce({last}, -1), -1)), 0)"
    none = "cast(array() as array<struct<x:int,y:int>>)"
    return f"""IF(size(q) < {least}, {none}, aggregate(sequence(0, size(q) - {least}), named_struct('best', -1, 'runs', {none}), (r, x) ->
        get(transform(array({further}), y -> IF(y > r.best, named_struct('best', y, 'runs', concat(r.runs, array(named_struct('x', x, 'y', y)))), r)), 0), r -> r.runs))"""


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_words: int = 13
) -> DataFrame:
    """One row per verified overlap: ``doc_id``, ``item_id``, ``doc_start``, ``item_start``, ``n_words``, ``matched``.

    An overlap is a run without insertions, of at least ``min_words`` matching words (four in five of the
    item's, if that is fewer), of which at most one in five is substituted. Runs may overlap, but none lies
    in another one. Items of fewer than ``WHOLE`` words have to occur whole. Null and empty texts overlap nothing; repeated rows give equal overlaps once;
    documents or items of one id and different texts are told apart by their text.
    """
    return overlaps(docs, benchmark, id_col, text_col, item_col, item_text_col, min_words).drop("text_key").distinct()


def overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_words: int = 13
) -> DataFrame:
    """The rows of ``contamination`` with ``text_key``, the hash of the document's text."""
    items = texts(benchmark, item_col, item_text_col).select(F.col("doc_id").alias("item_id"), hashed("text").alias("words")).where("size(words) > 0").distinct()
    items = staged(items.select("item_id", "words", F.xxhash64("words").alias("key"), F.size("words").alias("n")), "items")
    short = sorted(r.n for r in items.where(F.col("n") < WHOLE).select("n").distinct().collect())
    masks = [*MASKS, *("1" * n for n in short)]
    whole = F.expr(_seeds(masks))
    seeds = items.select("item_id", "key", "n", F.explode(whole).alias("s"))
    seeds = seeds.select("item_id", "key", "n", F.col("s.at").alias("item_at"), F.col("s.seed").alias("seed"))
    n_seeds = seeds.count()
    own = texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), hashed("text").alias("words"))
    placed = own.select("doc_id", "text_key", F.explode(F.expr(_seeds(masks))).alias("s")).select("doc_id", "text_key", "s.at", "s.seed")
    hits = placed.join(F.broadcast(seeds) if n_seeds <= BROADCAST_ROWS else seeds, "seed")
    hits = hits.groupBy("doc_id", "text_key", "item_id", "key", "n", (F.col("at") - F.col("item_at")).alias("shift")).agg(F.count("*").alias("hits"))
    hits = staged(hits, "hits")
    # a document's hits together: no more than its words times the items that share a seed
    by_doc = hits.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).agg(F.collect_list(F.struct("item_id", "key", "n", "shift")).alias("hits"))
    ids = by_doc.count()
    near = F.broadcast(by_doc.select("hit_id", "hit_key")) if ids <= BROADCAST_ROWS else by_doc.select("hit_id", "hit_key")
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key"))
    held = texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text")).join(near, same, "left_semi")
    held = held.join(by_doc, same).select("doc_id", "text_key", "hits", hashed("text").alias("words"))
    cut = F.expr(
        """flatten(transform(array(words), w -> transform(hits, h -> struct(h.item_id AS item_id, h.key AS key, h.shift AS shift,
        greatest(0, -h.shift) AS a, slice(w, greatest(0, h.shift) + 1, greatest(0, least(h.n - greatest(0, -h.shift), size(w) - greatest(0, h.shift)))) AS run))))"""
    )
    runs = held.select("doc_id", "text_key", F.explode(cut).alias("r")).select("doc_id", "text_key", "r.*")
    by_key = items.select("key", F.col("item_id").alias("i"), F.col("words").alias("item"), "n")
    n_words = items.agg(F.sum("n")).first()[0] or 0
    met = runs.join(F.broadcast(by_key) if n_words <= BROADCAST_ROWS else by_key, (runs.key == by_key.key) & runs.item_id.eqNullSafe(by_key.i))
    least = f"IF(n < {WHOLE}, n, least({min_words}, CAST(ceil(n * {SHARE}) AS INT)))"
    same = met.withColumn("q", F.expr("filter(transform(run, (w, i) -> IF(w = get(item, a + i), i, NULL)), i -> i IS NOT NULL)")).withColumn("least", F.expr(least))
    found = same.where("size(q) >= least").select("doc_id", "text_key", "item_id", "shift", "a", "q", F.explode(F.expr(_runs("least"))).alias("r"))
    first, matched = "a + get(q, r.x)", "r.y - r.x + 1"
    return found.select("doc_id", "text_key", "item_id", F.expr(f"shift + {first}").alias("doc_start"), F.expr(first).alias("item_start"), F.expr("get(q, r.y) - get(q, r.x) + 1").alias("n_words"), F.expr(matched).alias("matched")).distinct()


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without those that overlap a benchmark item, each judged by its own text, whatever its id."""
    bad = overlaps(docs, benchmark, id_col, text_col, **how).select(F.col("doc_id").alias("__bad"), F.col("text_key").alias("__key")).distinct()
    own = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return docs.join(bad, F.col(id_col).cast("long").eqNullSafe(F.col("__bad")) & (own == F.col("__key")), "left_anti")
