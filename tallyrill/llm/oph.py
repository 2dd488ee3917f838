"""One-permutation MinHash fingerprints, in DataFrame functions only.

Each shingle is hashed once; the top bits of the hash name its bin, which keeps its least value. An empty
bin borrows from another, probed in a random order of its own that is the same for all documents, so that
what two fingerprints borrow agrees as often as their sets do. Of each bin the low ``BITS`` bits are stored,
16 bins to a 64-bit word; likeness is corrected for chance matches of so few bits.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrill.llm.base import texts

BINS = 256
BITS = 4
WIDTH = 5
PROBES = 4  # bins looked at by number; then the filled one that comes first in the bin's own order
_BIN = BINS.bit_length() - 1
_LOW = (1 << (64 - _BIN)) - 1
_LANES = 64 // BITS


def _let(name: str, value: str, body: str) -> str:
    """SQL text: ``body`` with ``name`` bound to ``value``, which is worked out once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _sentinels() -> str:
    """SQL text: the greatest value of each bin, which stands for an empty one."""
    return f"transform(sequence(0, {BINS - 1}), b -> shiftleft(CAST(b AS BIGINT), {64 - _BIN}) | {_LOW}L)"


def _probe(attempt: int) -> str:
    return "array(" + ", ".join(str(xxhash.xxh64_intdigest(f"{attempt}:{i}") % BINS) for i in range(BINS)) + ")"


def fingerprint(text: str) -> Column:
    """``BINS * BITS`` bits of a text column as an array of longs.

    Words are lower-case runs between white space, shingles have ``WIDTH`` of them; a text of fewer words,
    none included, is one shingle.
    """
    words = f"transform(array_remove(split(lower({text}), '\\\\s+'), ''), x -> xxhash64(x))"
    shingle = ", ".join(f"get(w, i + {k})" for k in range(WIDTH))
    hashes = _let("w", words, f"IF(size(w) < {WIDTH}, array(xxhash64(w, 1)), transform(sequence(0, size(w) - {WIDTH}), i -> xxhash64({shingle})))")
    # sorted, every bin has at least its sentinel, and its least value comes first
    firsts = _let("s", f"sort_array(concat({hashes}, {_sentinels()}))", f"filter(s, (h, i) -> i = 0 OR shiftrightunsigned(h, {64 - _BIN}) <> shiftrightunsigned(get(s, i - 1), {64 - _BIN}))")
    bins = f"transform({firsts}, h -> IF((h & {_LOW}L) = {_LOW}L, NULL, h))"
    filled = "d"
    for attempt in range(PROBES):
        filled = f"transform({filled}, (x, i) -> coalesce(x, get(d, get({_probe(attempt)}, i))))"
    nearest = "array_min(transform(full, v -> struct(xxhash64(i, v) AS o, v AS v))).v"
    own_order = _let("full", "array_compact(d)", f"transform(f, (x, i) -> coalesce(x, {nearest}))").replace("xxhash64(i, v)", f"xxhash64(i, shiftrightunsigned(v, {64 - _BIN}))")
    complete = _let("f", filled, f"IF(exists(f, x -> x IS NULL), {own_order}, f)")
    # what is borrowed is hashed with its bin, so that one value in many bins gives bits of many kinds
    dense = _let("d", bins, f"transform({complete}, (x, i) -> IF(get(d, i) IS NULL, xxhash64(x, i), x))")
    packed = f"transform(sequence(0, {BINS // _LANES - 1}), j -> aggregate(slice(z, j * {_LANES} + 1, {_LANES}), 0L, (a, h) -> shiftleft(a, {BITS}) | (h & {(1 << BITS) - 1}L)))"
    return F.expr(_let("z", dense, packed))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard likeness of two fingerprint columns, 0 to 1."""
    lanes = sum(1 << (BITS * i) for i in range(_LANES))
    lanes = lanes - (1 << 64) if lanes >> 63 else lanes
    folded, step = "x", 1
    while step < BITS:
        folded = _let("x", f"{folded} | shiftrightunsigned({folded}, {step})", "x")
        step *= 2
    unlike = f"aggregate(zip_with({a}, {b}, (p, q) -> p ^ q), 0, (n, x) -> n + bit_count({folded} & {lanes}L))"
    chance = 1 / (1 << BITS)
    return F.greatest(F.lit(0.0), ((BINS - F.expr(unlike)) / F.lit(float(BINS)) - chance) / (1 - chance))


def hexed(fp: str) -> Column:
    return F.lower(F.array_join(F.transform(F.col(fp), lambda w: F.lpad(F.hex(w), 16, "0")), ""))


def with_next(docs: DataFrame, slices: int) -> DataFrame:
    """Rows (``doc_id``, ``text``, ``fp``) with the ``next_text``, ``next_fp`` of the row after in descending order.

    Rows are cut into ranges of ids of about equal size; the first row of each range also goes, as a guest,
    to the end of the range before, and the very first one to the end of the last.
    """
    slices = min(max(slices, 1), 10_000)
    shares = [i / slices for i in range(1, slices)]
    cut = docs.agg(F.max("doc_id").alias("top"), F.percentile_approx("doc_id", shares or [0.5], 10 * slices).alias("bounds")).first()
    top = cut.top
    bounds = sorted({b for b in cut.bounds or [] if b < top}) if shares and top is not None else []
    known = F.array(*[F.lit(b) for b in bounds]) if bounds else F.expr("cast(array() as array<bigint>)")
    steps = len(bounds).bit_length()
    # how many bounds lie under the id, by binary lifting
    under = F.expr(f"aggregate(transform(sequence(0, {steps}), i -> shiftleft(1, {steps} - i)), 0, (n, s) -> IF(n + s <= {len(bounds)} AND get(bounds, n + s - 1) < doc_id, n + s, n))")
    sliced = docs.withColumn("bounds", known).withColumn("slice", under)
    guest = F.when(F.array_contains("bounds", F.col("doc_id")), F.col("slice") + 1)
    last = F.when(F.col("doc_id") == F.lit(top).cast("long"), F.lit(0))
    places = F.array_compact(F.array(F.struct(F.col("slice").alias("s"), F.lit(0).alias("g")), F.when(guest.isNotNull(), F.struct(guest.alias("s"), F.lit(1).alias("g"))), F.when(last.isNotNull(), F.struct(last.alias("s"), F.lit(1).alias("g")))))
    dealt = sliced.select("doc_id", "text", "fp", F.explode(places).alias("p")).select("doc_id", "text", "fp", "p.s", "p.g")
    order = Window.partitionBy("s").orderBy("g", F.desc_nulls_last("doc_id"), "text")
    after = F.lead(F.struct("text", "fp")).over(order)
    return dealt.withColumn("after", after).where("g = 0").select("doc_id", "text", "fp", F.coalesce("after.text", "text").alias("next_text"), F.coalesce("after.fp", "fp").alias("next_fp"))


def with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slices: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness.

    ``doc_id``, ``n_chars`` (code points), ``edited``, ``fp``, ``edited_fp``, ``next_fp``. The edited text has
    its last third (rounded down) replaced by as much, or all, of the head of the next text by descending id;
    after the last one comes the first. Null texts are empty; null ids come last, equal ids by text; a single
    row is its own next; no rows give no rows.
    """
    slices = slices or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = texts(docs, id_col, text_col).withColumn("fp", fingerprint("text"))
    both = with_next(own, slices).withColumn("n_chars", F.char_length("text").cast("long"))
    third = "CAST(n_chars div 3 AS INT)"
    both = both.withColumn("edited", F.expr(f"concat(left(text, CAST(n_chars AS INT) - {third}), left(next_text, {third}))"))
    return both.select("doc_id", "n_chars", "edited", "fp", "next_fp", fingerprint("edited").alias("edited_fp"))
