"""Near-duplicate lines by a segment-partition edit join, in DataFrame functions only.

Two lines within ``k`` edits share one of ``k + 1`` segments of the shorter one, at a place that the
lengths and the segment's number bound. Distinct lines are indexed by their segments under their length;
each probes its own and the lengths a little below, and leaves out lines whose letter counts differ by more
than the edits explain. What meets is verified by a bit-parallel edit distance over a band of ``2k + 1``
diagonals, after equal heads and tails are taken off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.llm.base import staged
from tallyrill.llm.components import components

BROADCAST_ROWS = 1_000_000  # ids of 8 bytes
KEY_BITS = 40  # a line meets one other by chance for each 2^40 pairs of a segment and a probe
SHIFT = 2_147_483_648  # over any line number


def budget(length: str, chars_per_edit: int, max_edits: int) -> str:
    """SQL text: edits allowed for a shorter line of this length."""
    return f"least({max_edits}, {length} div {chars_per_edit})"


def _key(parts: str) -> str:
    """SQL text: a key of ``KEY_BITS`` bits, which take less room in the exchange; what only shares a key is told apart after."""
    return f"xxhash64({parts}) & {(1 << KEY_BITS) - 1}"


def _segments(edits: int) -> str:
    """SQL text: hashes of the ``edits + 1`` segments of ``line`` of ``n`` characters, keyed by length and number."""
    parts = edits + 1
    return "array(" + ", ".join(_key(f"n, {s}, substring(line, {s} * n div {parts} + 1, {s + 1} * n div {parts} - {s} * n div {parts})") for s in range(parts)) + ")"


def _probes(edits: int) -> list[tuple[int, str]]:
    """By how much a line is longer, and SQL text of a hash that it then looks for.

    A segment s may have moved by at most s edits before it and ``edits - s`` after it; seen from either
    side, places outside both bounds need not be looked at.
    """
    parts = edits + 1
    out = []
    for longer in range(edits + 1):
        for s in range(parts):
            for move in range(max(-s, longer - (edits - s)), min(s, longer + (edits - s)) + 1):
                m = f"(n - {longer})"
                begin, end = f"{s} * {m} div {parts}", f"{s + 1} * {m} div {parts}"
                out.append((longer, _key(f"{m}, {s}, substring(line, {begin} + 1 + {move}, {end} - {begin})")))
    return out


LETTERS = "etnaorishdlucmpg"


def _letters() -> str:
    """SQL text: how often ``line`` has each of sixteen frequent letters, modulo 16, four bits each.

    A letter is counted in what the ones before it leave, which gets shorter; each is one byte.
    """
    rest, counts = "line", []
    for i, c in enumerate(LETTERS):
        left = f"replace({rest}, '{c}', '')"
        counts.append(f"shiftleft(CAST((octet_length({rest}) - octet_length({left})) & 15 AS BIGINT), {4 * i})")
        rest = left
    return " | ".join(counts)


def _unlike(a: str, b: str) -> str:
    """SQL text: at least so many letters differ; an edit changes two at most."""
    lanes = [f"abs((shiftright({a}, {4 * i}) & 15) - (shiftright({b}, {4 * i}) & 15))" for i in range(len(LETTERS))]
    return " + ".join(f"least({x}, 16 - {x})" for x in lanes)


def _common(a: str, b: str, side: str) -> str:
    """SQL text: how many characters two strings share at their left or right end, by binary lifting."""
    return (
        f"aggregate(transform(sequence(0, 30), i -> shiftleft(1, 30 - i)), 0, (k, s) -> "
        f"IF(k + s <= least(char_length({a}), char_length({b})) AND {side}({a}, k + s) = {side}({b}, k + s), k + s, k))"
    )


def banded(p: str, t: str, edits: int) -> str:
    """SQL text: edit distance of two arrays of characters, ``t`` not shorter; null if over ``edits``.

    Bit ``b`` of mask ``r_e`` tells whether diagonal ``b - edits`` can be reached at this column with at most
    ``e`` edits. A match keeps the diagonal, so do substitutions, an insertion goes one down, a deletion up.
    """
    width = (1 << (2 * edits + 1)) - 1
    hits = " | ".join(f"IF(get({p}, CAST(j - 1 - {edits} + {b} AS INT)) <=> get({t}, CAST(j - 1 AS INT)), {1 << b}, 0)" for b in range(2 * edits + 1))
    masks = ["(r.r0 & hit)"]
    for e in range(1, edits + 1):
        masks.append(f"(((r.r{e} & hit) | r.r{e - 1} | shiftright(r.r{e - 1}, 1) | shiftleft({masks[-1]}, 1)) & {width})")

    def struct(values: list) -> str:
        return "named_struct(" + ", ".join(f"'r{e}', {v}" for e, v in enumerate(values)) + ")"

    column = f"get(transform(array({hits}), hit -> {struct(masks)}), 0)"
    init = struct([sum(1 << (edits + i) for i in range(e + 1)) for e in range(edits + 1)])
    # out of the band: nothing can be reached any more
    walked = f"aggregate(sequence(1, greatest(1, size({t}))), {init}, (r, j) -> IF(r.r{edits} = 0, r, {column}))"
    end = f"shiftleft(1, size({p}) - size({t}) + {edits})"
    found = "CASE " + " ".join(f"WHEN (r.r{e} & {end}) <> 0 THEN {e}" for e in range(edits + 1)) + " END"
    return f"get(transform(array(IF(size({t}) = 0, {init}, {walked})), r -> {found}), 0)"


def _let(name: str, value: str, body: str) -> str:
    """SQL text: ``body`` with ``name`` bound to ``value``, which is worked out once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def edit_distance(pairs: DataFrame, max_edits: int, chars_per_edit: int) -> DataFrame:
    """``pairs`` (``a``, ``b``, ``line_a`` not longer than ``line_b``) with ``edits``; pairs over the budget go."""
    found = banded("p", "t", max_edits)
    for name, core in (("t", "rb"), ("p", "ra")):
        found = _let(name, f"IF({core} = '', cast(array() as array<string>), split({core}, ''))", found)
    for name, rest in (("rb", "pb"), ("ra", "pa")):
        found = _let(name, f"left({rest}, char_length({rest}) - tail)", found)
    found = _let("tail", _common("pa", "pb", "right"), found)
    for name, line in (("pb", "line_b"), ("pa", "line_a")):
        found = _let(name, f"substring({line}, head + 1)", found)
    found = _let("head", _common("line_a", "line_b", "left"), found)
    allowed = budget("char_length(line_a)", chars_per_edit, max_edits)
    return pairs.select("a", "b", F.expr(allowed).alias("allowed"), F.expr(found).alias("edits")).where("edits <= allowed").select("a", "b", "edits")


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_key``, ``line_no`` (from 0) and ``line``, trimmed; blank lines and null texts have no rows."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    # trimming maps out a whole line, so only those are trimmed that need it
    ends = " OR ".join(f"{side}(line, '{c}')" for side in ("startswith", "endswith") for c in (" ", "\\t", "\\r"))
    trimmed = F.expr(f"IF({ends}, trim(BOTH ' \\t\\r' FROM line), line)")
    return own.select("doc_id", "text_key", "line_no", trimmed.alias("line")).where("line <> ''")


def edit_join(lines: DataFrame, max_edits: int = 2, chars_per_edit: int = 30) -> DataFrame:
    """Links ``a``, ``b`` (hashes of different lines) and ``edits`` of all ``line`` values within budget.

    A pair may differ by one edit for each ``chars_per_edit`` characters of the shorter line, ``max_edits`` at
    most; shorter lines than that have no links. Equal lines are one line.
    """
    long = lines.select("line", F.char_length("line").alias("n")).where(f"n >= {chars_per_edit}")
    # letters go through the exchange, since index and probes are made from it in turn
    distinct = long.select("line", "n", F.expr(_letters()).alias("letters")).groupBy("line", "n", "letters").agg(F.lit(1))
    own = distinct.select(F.xxhash64("line").alias("id"), "line", "n", "letters")
    indexed = F.coalesce(*[F.when(F.expr(budget("n", chars_per_edit, max_edits)) == e, F.expr(_segments(e))) for e in range(1, max_edits + 1)])

    def probes(line: str) -> Column:
        # a probe counts if a line of that length has that many edits
        return F.array_compact(F.array(*[
            F.when(F.expr(f"{budget(f'(n - {longer})', chars_per_edit, max_edits)} = {e}"), F.expr(p.replace("substring(line", f"substring({line}")))
            for e in range(1, max_edits + 1) for longer, p in _probes(e)
        ]))

    # where a character is a byte, a place in a line is found without counting up to it
    looked = F.when(F.expr("octet_length(line) = n"), probes("CAST(line AS BINARY)")).otherwise(probes("line"))
    index = own.select(F.col("id").alias("a"), F.col("letters").alias("la"), F.explode(indexed).alias("segment"))
    probe = own.select(F.col("id").alias("b"), F.col("letters").alias("lb"), F.explode(looked).alias("segment"))
    # lines that share a segment but too few letters aren't even paired
    met = index.join(probe, "segment").where("a <> b").where(f"{_unlike('la', 'lb')} <= {2 * max_edits}").select("a", "b").distinct()
    met = staged(met, "met")
    ids = met.select("a").union(met.select("b")).distinct().withColumnRenamed("a", "id")
    few = ids.count() <= BROADCAST_ROWS
    known = lines.select(F.xxhash64("line").alias("id"), "line").join(F.broadcast(ids) if few else ids, "id", "left_semi").dropDuplicates(["id"])
    known = staged(known, "lines")
    both = met.join(known.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a").join(known.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b")
    # of two lines of one length each finds the other
    both = both.where("char_length(line_a) < char_length(line_b) OR a < b")
    return edit_distance(both, max_edits, chars_per_edit)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = 2, chars_per_edit: int = 30) -> DataFrame:
    """One row per line that isn't blank: ``doc_id``, ``text_key``, ``line_no``, ``class_doc_id``, ``class_line_no``,
    ``n_links`` and ``kept``.

    A class is what equal lines and links join; its first line, by document and line number, names it and is
    the one kept. ``n_links`` counts the different lines within budget of this one. Lines are trimmed. Null
    texts have no lines; null ids come last; rows that repeat an id and a text are one document.
    """
    lines = lines_of(docs, id_col, text_col)
    linked = staged(edit_join(lines, max_edits, chars_per_edit), "links")
    labels = components(linked.select("a", "b"))
    degree = linked.select("a").union(linked.select("b")).groupBy("a").agg(F.count("*").alias("n_links"))
    named = labels.join(degree, labels.node == degree.a).select(F.col("node").alias("h"), "label", "n_links")
    place = F.coalesce("doc_id", F.lit((1 << 63) - 1)).cast("decimal(20,0)") * F.lit(SHIFT).cast("decimal(10,0)") + F.col("line_no")
    own = lines.select("doc_id", "text_key", "line_no", F.xxhash64("line").alias("h"), place.alias("place")).join(named, "h", "left")
    own = own.select("doc_id", "text_key", "line_no", "place", F.coalesce("label", "h").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    first = own.groupBy("class").agg(F.min("place").alias("first"))
    line_no = F.expr(f"CAST(pmod(first, {SHIFT}) AS INT)")
    doc = F.expr(f"CAST((first - pmod(first, {SHIFT})) / {SHIFT} AS LONG)")
    joined = own.join(first, "class").select("*", line_no.alias("class_line_no"), doc.alias("class_doc_id"))
    return joined.select("doc_id", "text_key", "line_no", "class_doc_id", "class_line_no", "n_links", (F.col("place") == F.col("first")).alias("kept"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = 2, chars_per_edit: int = 30) -> DataFrame:
    """``docs`` with each line class at its first place only; a document that loses all its lines goes.

    Blank lines stay, documents that had none but blank lines stay too.
    """
    found = classes(docs, id_col, text_col, max_edits, chars_per_edit)
    gone = found.where("NOT kept").groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.collect_set("line_no").alias("__gone"))
    keyed = docs.withColumn("__k", F.xxhash64(F.col(text_col)))
    joined = keyed.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__k") == F.col("__key")), "left")
    left = F.filter(F.split(F.col(text_col), "\n"), lambda line, i: ~F.array_contains("__gone", i))
    text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    out = joined.withColumn("__text", text).where(F.col("__gone").isNull() | (F.expr("trim(BOTH ' \\t\\r\\n' FROM __text)") != ""))
    return out.select(*[F.col("__text").alias(c) if c == text_col else F.col(c) for c in docs.columns])
