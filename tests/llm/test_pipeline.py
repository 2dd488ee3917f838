"""The registered queries' columns, and the pipeline against plain versions of its stages."""

import random
import zlib

import pytest
from test_ops_native import changed, plain_classes
from test_ops_python import grouped, prose, rebuilt

import __spark_entry__
import corpus_pipeline
from tallyrill.llm import queries, toxicity

COLUMNS = {
    "op1_": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op3_": {"doc_id": "bigint", "n_links": "bigint", "class_doc_id": "bigint"},
    "op4_": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op5_": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6_": {"sequence_id": "bigint", "ids": "binary", "cu_seqlens": "array<int>"},
    "op7_": {"doc_id": "bigint", "licence": "string"},
    "op8_": {"doc_id": "bigint", "item_id": "bigint"},
    "op9_": {"doc_id": "bigint", "other_doc_id": "bigint"},
    "op10_": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op11_": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
    "op12_": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op13_": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"},
}
TABLES = ("documents", "labels", "benchmark", "embeddings")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Toxic texts, shared lines, copies, benchmark passages, odd rows; labels for two thirds."""
    rng = random.Random(51)
    lines = [prose(rng, rng.randint(8, 20)) for _ in range(12)]
    items = [prose(rng, n) for n in (15, 30, 50)]
    texts = [None, "", " \n ", "one"]
    toxic = set()
    for i in range(300):
        body = [prose(rng, rng.randint(10, 40)) for _ in range(rng.randint(1, 4))]
        if i % 4 == 0:
            body[0] += " you idiot scum " + "worthless trash idiot"
            toxic.add(len(texts))
        if i % 5 == 1:
            body.append(changed(rng, rng.choice(lines), rng.randint(0, 1)))
        if i % 11 == 2:
            body[-1] += " " + rng.choice(items)
        texts.append("\n".join(body))
    texts += [texts[7], texts[9], texts[9].upper(), texts[10] + " "]
    for i in range(12):  # near copies, some within a similarity of 0.8 and some not
        words = prose(rng, 90).split()
        texts.append(" ".join(words))
        for k in range(i % 4 + 1):
            words[20 * k] = "moved"
        texts.append(" ".join(words))
    at = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").coalesce(2).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(len(texts)) if i % 3], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    vectors = [(i, [rng.gauss(0, 1) for _ in range(6)], i % 10) for i in range(120)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    return at, texts, items


def test_registered_columns(spark, folder):
    for prefix, want in COLUMNS.items():
        name = next(n for n in queries.QUERIES if n.startswith(prefix))
        kinds = dict(queries.QUERIES[name](spark, folder[0]).dtypes)
        assert {c: kinds.get(c) for c in want} == want, name
    entry = __spark_entry__.queries()
    assert "pipeline" in entry and set(queries.QUERIES) <= set(entry)


def test_pipeline_against_plain_stages(spark, folder):
    at, texts, items = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    names = docs.columns
    model = toxicity.learn(docs, spark.read.parquet(f"{at}/labels.parquet").where(~toxicity.held_out()))
    left = {i: t for i, t in enumerate(texts) if toxicity.score_text(t, model) < 0.7}
    assert 60 <= len(texts) - len(left) <= 80

    def stage(i, docs):
        out = corpus_pipeline.STAGES[i][1](spark, docs, at)
        assert out.columns == names
        rows = out.collect()
        assert all(r.n_chars == len(r.text or "") for r in rows)
        return spark.createDataFrame(rows, docs.schema), {r.doc_id: r.text for r in rows}

    docs, got = stage(0, docs)
    assert got == left

    ids = sorted(left)
    kept = plain_classes([left[i] for i in ids])
    after = {}
    for place, i in enumerate(ids):
        own = (left[i] or "").split("\n")
        rest = [x for k, x in enumerate(own) if kept.get((place, k), (0, 0, 0, True))[3]]
        if any(x.strip() for x in rest) or not (left[i] or "").strip():
            after[i] = left[i] if left[i] is None else "\n".join(rest)
    docs, got = stage(1, docs)
    assert got == after and len(after) < len(left)

    def alike(a, b):
        return a == b or 5 * len(a & b) >= 4 * len(a | b)

    sets = {}
    for i, t in after.items():
        words = (t or "").lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    near = grouped([(a, b) for a in sets for b in sets if a < b and alike(sets[a], sets[b])], sets)
    copies = [i for i in near if near[i] != i]
    assert len(copies) >= 6
    docs, got = stage(2, docs)
    assert set(got) == set(near.values())

    clean = {i: t for i, t in got.items() if not any(x in (t or "") for x in items)}
    docs, got = stage(3, docs)
    assert got == clean

    pieces = corpus_pipeline.STAGES[4][1](spark, docs, at).collect()
    order = sorted(clean)
    again = [type("Piece", (), {**p.asDict(), "doc_id": order.index(p.doc_id)}) for p in pieces]
    rebuilt(again, [clean[i] for i in order])
    key = lambda p: (p.doc_id, p.start, p.length, zlib.crc32(bytes(p.ids)))
    # repeated runs may deal rows to tasks anew, so only what was packed is compared
    whole = {}
    for p in corpus_pipeline.run(spark, at).collect():
        whole.setdefault(p.doc_id, []).append(p)
    assert set(whole) == set(clean) and all(sum(p.length for p in v) == v[0].doc_tokens for v in whole.values())
    assert len({key(p) for p in pieces}) == len(pieces)


def test_empty_tables(spark, folder, tmp_path):
    at = str(tmp_path)
    for name in TABLES:
        spark.read.parquet(f"{folder[0]}/{name}.parquet").limit(0).write.parquet(f"{at}/{name}.parquet")
    for name, query in queries.QUERIES.items():
        assert query(spark, at).collect() == [], name
    assert corpus_pipeline.run(spark, at).collect() == []
