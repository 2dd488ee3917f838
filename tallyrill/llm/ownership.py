"""Secret scan with corpus-wide ownership frequency.

Patterns give base spans. Beside them, long mixed runs of high entropy are candidates. The hash of each
candidate's value is counted over the corpus by distinct repositories and owners: values of many owners
are copied examples, values of few owners look like live credentials. Candidates of the second kind are
added to the spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrill.llm.base import staged

# fixed values: the base patterns, with the least length of the part that is the value
KINDS = ("assign", "access", "hex")
_BASE = (
    (re.compile(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    (re.compile(r"[0-9a-f]{24,}"), 0, 24),  # the same runs as one or more, then 24 or more
)
ENTROPY = "entropy"
_MIXED = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_DIGIT, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
SPAN = "struct<kind:string,start:long,end:long,value:string>"
SCHEMA = f"row long, doc_id long, repository string, owner string, base array<{SPAN}>, more array<{SPAN}>"


def _bits(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def _hash(value: str) -> str:
    return hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()[:32]


def candidates(text: str | None, entropy: float = 3.5) -> tuple[list[dict], list[dict]]:
    """Base spans in order of start and kind, and entropy spans that overlap none of them.

    Offsets are code points, the end exclusive; values are only kept as hashes.
    """
    text = text or ""
    base = []
    for kind, (pattern, group, least) in zip(KINDS, _BASE, strict=True):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                base.append((m.start(), KINDS.index(kind), m.end(), m.group(group)))
    base.sort(key=lambda b: b[:2])
    more, ends, i = [], 0, 0
    for m in _MIXED.finditer(text):
        value = m.group()
        if not _DIGIT.search(value) or not _LETTER.search(value) or _bits(value) < entropy:
            continue
        while i < len(base) and base[i][0] < m.end():
            ends = max(ends, base[i][2])
            i += 1
        if ends <= m.start():
            more.append({"kind": ENTROPY, "start": m.start(), "end": m.end(), "value": _hash(value)})
    return [{"kind": KINDS[k], "start": s, "end": e, "value": _hash(v)} for s, k, e, v in base], more


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """Every document with its base spans and further candidates."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
        for batch in batches:
            spans = [candidates(t.as_py()) for t in batch.column(3)]
            rows = pa.array(range(row, row + len(spans)), pa.int64())
            row += len(spans)
            columns = [rows, *(batch.column(i) for i in range(3)), pa.array([b for b, _ in spans], kind), pa.array([m for _, m in spans], kind)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "repository", "owner", "base", "more"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(repository_col).cast("string").alias("repository"), F.col(owner_col).cast("string").alias("owner"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, SCHEMA)


def ownership(spans: DataFrame) -> DataFrame:
    """``value``, ``repositories``, ``owners``: distinct counts per candidate hash.

    A repository without an owner counts as an owner of its own; null repositories are left out. Counted up in
    two steps, so that a value in very many documents is summed before it is gathered.
    """
    values = F.array_distinct(F.transform(F.concat("base", "more"), lambda s: s["value"]))
    each = spans.select("repository", "owner", F.explode(values).alias("value"))
    repositories = each.select("value", "repository").distinct().groupBy("value").agg(F.count("repository").alias("repositories"))
    held = F.struct(F.coalesce("owner", "repository").alias("name"), F.col("owner").isNull().alias("alone"))
    owners = each.select("value", held.alias("held")).distinct().groupBy("value").agg(F.count("held.name").alias("owners"))
    return repositories.join(owners, "value")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository_col: str = "doc_id", owner_col: str = "source", wide: int = 3, spread: int = 50) -> DataFrame:
    """``doc_id``, ``base`` (base spans), ``spans`` (all), ``live``, ``copied``, ``repositories`` and ``owners``, one row per document.

    A candidate's value is a copied example if ``wide`` owners have it, or ``spread`` repositories, more than one owner's own use of
    a credential explains; a repository without an owner counts as one. Any other is owner-specific: an entropy candidate is then
    added as a span. Of the base spans, which stay, ``live`` counts the owner-specific and ``copied`` the
    others; ``repositories`` and ``owners`` are those of the widest spread value among all candidates, 0 without any. Null and empty texts have no spans; repeated rows stay apart; no rows give no rows.
    """
    whole = staged(found(docs, id_col, text_col, repository_col, owner_col), "secrets")
    known = ownership(whole).withColumn("copied", (F.col("owners") >= wide) | (F.col("repositories") >= spread))
    each = whole.select("row", F.explode(F.concat("base", "more")).alias("span")).withColumn("value", F.col("span.value"))
    judged = each.join(known, "value").groupBy("row").agg(
        F.collect_list(F.when((F.col("span.kind") == ENTROPY) & ~F.col("copied"), F.col("span"))).alias("added"),
        F.count_if((F.col("span.kind") != ENTROPY) & ~F.col("copied")).alias("live"),
        F.count_if((F.col("span.kind") != ENTROPY) & F.col("copied")).alias("copied"),
        F.max("repositories").alias("repositories"),
        F.max("owners").alias("owners"),
    )
    ranked = F.transform(F.concat("base", F.coalesce("added", F.expr(f"cast(array() as array<{SPAN}>)"))), lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, (*KINDS, ENTROPY))), s["kind"]).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    return whole.join(judged, "row", "left").select("doc_id", "base", F.array_sort(ranked).alias("spans"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("live", "copied", "repositories", "owners")])


def joined(spans):
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
