"""Operators in DataFrame functions only, against plain versions on small tables."""

import itertools
import random
import textwrap

import pytest

from tallyrill.llm import decontaminate, licences, linededup, oph

DOCS = "doc_id long, text string, source string, n_chars long, item_id long, line string, fp string"
WORDS = "the of and to in is that for it was on are with as be at by this from or an have not".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed"]) for _ in range(n))


def docs(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, "s", None, 1, "x", "y") for i, t in enumerate(texts)], DOCS)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def changed(rng, line, n):
    for _ in range(n):
        i = rng.randrange(len(line))
        line = rng.choice([line[:i] + line[i + 1 :], line[:i] + rng.choice("abcé漢") + line[i:], line[:i] + "z" + line[i + 1 :]])
    return line


@pytest.mark.parametrize("most", [1, 2, 3])
def test_banded_distance(spark, most):
    rng = random.Random(most)
    pairs = []
    for i in range(150):
        a = prose(rng, 12)[: rng.randint(most * 5, 60)]
        b = changed(rng, a, rng.randint(0, 4)) if i % 5 else prose(rng, 8)
        a, b = sorted((a, b), key=len)
        pairs.append((2 * i, 2 * i + 1, a, b))
    table = spark.createDataFrame(pairs, "a long, b long, line_a string, line_b string")
    got = {r.a: r.edits for r in linededup.edit_distance(table, most, 5).collect()}
    assert got == {p[0]: d for p in pairs if (d := edits(p[2], p[3])) <= min(most, len(p[2]) // 5)}


def plain_classes(texts, most=2, per=30):
    places = {}
    for d, t in enumerate(texts):
        for i, line in enumerate((t or "").split("\n")):
            if line.strip():
                places.setdefault(line.strip(), []).append((d, i))
    lines = list(places)
    root = {x: x for x in lines}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    links = dict.fromkeys(lines, 0)
    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            if abs(len(a) - len(b)) <= most and edits(a, b) <= min(most, min(len(a), len(b)) // per):
                links[a] += 1
                links[b] += 1
                root[top(a)] = top(b)
    first = {}
    for x in lines:
        first[top(x)] = min(first.get(top(x), (9e9, 0)), min(places[x]))
    return {p: (*first[top(x)], links[x], p == first[top(x)]) for x in lines for p in places[x]}


def line_texts(rng):
    base = [prose(rng, rng.randint(3, 30)) for _ in range(25)]
    texts = [None, "", "\n\n  ", "short\nshort", "a\r\n b"]
    for _ in range(40):
        texts.append("\n".join(changed(rng, rng.choice(base), rng.randint(0, 2)) for _ in range(rng.randint(1, 4))))
    return [*texts, texts[-1], "\n".join([base[0]] * 3), "x" * 3000 + "\n" + "x" * 2999 + "y"]


def test_line_classes(spark):
    texts = line_texts(random.Random(21))
    got = {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no, r.n_links, r.kept) for r in linededup.classes(docs(spark, texts)).collect()}
    want = plain_classes(texts)
    assert got == want
    kept = {r.doc_id: r.text for r in linededup.without_copies(docs(spark, texts)).collect()}
    for d, t in enumerate(texts):
        left = [x for i, x in enumerate((t or "").split("\n")) if want.get((d, i), (0, 0, 0, True))[3]]
        if any(x.strip() for x in left) or not (t or "").strip():
            assert kept[d] == (t if t is None else "\n".join(left))
        else:
            assert d not in kept
    assert linededup.without_copies(docs(spark, texts)).columns == docs(spark, texts).columns
    assert linededup.classes(docs(spark, texts).limit(0)).collect() == []


def test_line_copies_of_odd_rows(spark):
    table = spark.createDataFrame([(None, "one line of text"), (5, "one line of text"), (5, "one line of text"), (5, "another line"), (-3, None)], "doc_id long, text string")
    kept = [tuple(r) for r in linededup.without_copies(table).collect()]
    assert sorted(kept, key=str) == sorted([(5, "one line of text"), (5, "one line of text"), (5, "another line"), (-3, None)], key=str)


def test_letters_of_a_line_are_counted_once(spark, monkeypatch):
    """Counting is the dearest step: index and probes take it from the exchange that both read."""
    lines = ["", "e", "ééé tea 漢 " * 9, "tattletale " * 40, prose(random.Random(8), 30), "E.T."]
    got = docs(spark, lines).selectExpr("doc_id", f"{linededup._letters().replace('line', 'text')} AS x").collect()
    want = {i: sum((t.count(c) & 15) << 4 * k for k, c in enumerate(linededup.LETTERS)) for i, t in enumerate(lines)}
    assert {r.doc_id: r.x % (1 << 64) for r in got} == want
    plans, staged = {}, linededup.staged

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(linededup, "staged", kept)
    monkeypatch.setattr(linededup, "BROADCAST_ROWS", 10)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        linededup.edit_join(linededup.lines_of(docs(spark, [*lines, lines[4] + "x"]))).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum("replace(" in row for row in plans["met"].split("\n")) == 1


def test_line_ends_and_places_in_wide_characters(spark):
    """Trimmed at both ends whatever stands there; segments are found in lines of one and of several bytes a character."""
    rng = random.Random(17)
    base = [prose(rng, 14) for _ in range(6)]
    wide = [x.replace("t", "漢").replace("o", "é") for x in base]
    texts = []
    for x in base + wide:
        texts += [x, f" \t{x}", f"{x}\r", changed(rng, x, 1), changed(rng, x, 2), f"\r {changed(rng, x, 1)}\t \r"]
    found = linededup.classes(docs(spark, texts)).collect()
    assert {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no, r.n_links, r.kept) for r in found} == plain_classes(texts)


def test_fingerprints(spark):
    rng = random.Random(31)
    texts = [None, "", " ", "one", "One", "漢字 text", prose(rng, 4), prose(rng, 40), prose(rng, 400), prose(rng, 3000)] + [prose(rng, 120) for _ in range(30)] + ["same words in this text", "same words in this text"]
    rows = {r.doc_id: r for r in oph.with_edited(docs(spark, texts), slices=7).collect()}
    order = sorted(range(len(texts)), reverse=True)
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4))}
    off = []
    for i, at in enumerate(order):
        text, after = texts[at] or "", texts[order[(i + 1) % len(order)]] or ""
        third = len(text) // 3
        assert rows[at].edited == text[: len(text) - third] + after[:third]
        assert rows[at].n_chars == len(text)
        a, b = shingles(text), shingles(rows[at].edited)
        off.append((at, len(a & b) / len(a | b)))
    near = {r.doc_id: r for r in oph.with_edited(docs(spark, texts), slices=3).select("doc_id", oph.likeness("fp", "edited_fp").alias("n"), oph.likeness("fp", "fp").alias("own"), oph.hexed("fp").alias("hex")).collect()}
    assert all(abs(near[at].n - true) < 0.2 for at, true in off)
    assert sum(abs(near[at].n - true) for at, true in off) / len(off) < 0.05
    assert all(r.own == 1 and len(r.hex) == 256 for r in near.values())
    assert near[40].hex == near[41].hex and near[0].hex == near[1].hex == near[2].hex
    assert len({r.hex for r in near.values()}) == len({(t or "").lower().strip() for t in texts})
    assert oph.with_edited(docs(spark, texts).limit(0)).collect() == []
    ids = [(None, "a"), (None, "b"), (7, "c"), (7, "d"), (2**62, "e")]
    got = [(r.doc_id, r.next_text) for r in oph.with_next(spark.createDataFrame(ids, "doc_id long, text string").withColumn("fp", oph.fingerprint("text")), 4).collect()]
    assert sorted(got, key=str) == sorted([(2**62, "c"), (7, "d"), (7, "a"), (None, "b"), (None, "e")], key=str)


def test_decontamination(spark):
    rng = random.Random(41)
    items = [prose(rng, n) for n in (13, 20, 40, 65, 14)] + ["only five words in here", "", None]
    texts = [None, "", prose(rng, 200)]
    planted = {}
    for i in range(40):
        item = rng.randrange(6)
        words = items[item].upper().split()
        for _ in range(len(words) // 12 if i % 2 and item < 5 else 0):
            words[rng.randrange(len(words))] = "qqq"
        at = rng.randint(0, 60)
        texts.append(f"{prose(rng, at)}, {' '.join(words)}! {prose(rng, 30)}")
        planted[len(texts) - 1] = item
    clean = [prose(rng, 150) for _ in range(20)]
    table = docs(spark, texts + clean)
    marks = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.contamination(table, marks).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    whole = {(d, i) for d, i in planted.items() if "qqq" not in texts[d]}
    assert whole <= found and len(set(planted.items()) & found) >= len(planted) - 4
    assert {d for d, _ in found} <= set(planted)
    tokens = lambda t: [w for w in "".join(c if c.isalnum() else " " for c in t.lower()).split()]
    for r in got:
        a = tokens(texts[r.doc_id])[r.doc_start : r.doc_start + r.n_words]
        b = tokens(items[r.item_id])[r.item_start : r.item_start + r.n_words]
        same = sum(x == y for x, y in zip(a, b, strict=True))
        assert same == r.matched >= min(13, 0.8 * len(tokens(items[r.item_id]))) and same >= 0.8 * r.n_words
    kept = {r.doc_id for r in decontaminate.clean(table, marks).collect()}
    assert kept == set(range(len(texts + clean))) - {d for d, _ in found}
    assert decontaminate.contamination(table, marks.limit(0)).collect() == []
    assert decontaminate.contamination(table.limit(0), marks).collect() == []


def test_clean_judges_each_text_by_itself(spark):
    """Null and repeated ids: only the rows that hold a passage go."""
    rng = random.Random(44)
    item = prose(rng, 30)
    marks = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, f"{prose(rng, 9)} {item}"), (None, "a clean text"), (5, f"{item} {prose(rng, 9)}"), (5, "another clean one"), (6, None), (6, item)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in decontaminate.clean(table, marks).collect()), key=str)
    assert kept == sorted([rows[1], rows[3], rows[4]], key=str)


def test_decontamination_beyond_broadcast(spark, monkeypatch):
    rng = random.Random(42)
    item = prose(rng, 30)
    table, marks = docs(spark, [prose(rng, 50), f"{prose(rng, 9)} {item}"]), spark.createDataFrame([(4, item), (5, None)], "item_id long, text string")
    want = decontaminate.contamination(table, marks).collect()
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert [r.doc_id for r in want] == [1] and decontaminate.contamination(table, marks).collect() == want


def test_decontamination_meets_every_plant(spark):
    """Substitutions at all places the rule allows, and a valid run beside a denser short one."""
    rng = random.Random(43)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    items = [words(n) for n in (11, 12, 15, 16, 20, 28)]
    texts, planted = [], set()

    def plant(item, gone):
        own = [f"x{k}" if k in gone else w for k, w in enumerate(items[item])]
        planted.add((len(texts), item))
        texts.append(" ".join(words(rng.randint(0, 9)) + own + words(rng.randint(0, 9))))

    for item, most in ((0, 2), (1, 2), (2, 3), (3, 3)):
        for gone in itertools.combinations(range(len(items[item])), most):
            plant(item, gone)
    for _ in range(300):
        plant(4, rng.sample(range(20), 4))
    # eight words, three substituted, then 13 of 16
    plant(5, {8, 9, 10, 11, 15, 19, 23})
    marks = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = decontaminate.contamination(docs(spark, texts), marks).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    assert all(5 * r.matched >= 4 * r.n_words and r.matched >= min(13, -(-4 * len(items[r.item_id]) // 5)) for r in got)


def test_licences(spark):
    s = licences.SENTENCES
    mit = " ".join(s[k] for k in ("mit-grant", "mit-notice", "mit-warranty", "mit-liability"))
    texts = [
        None, "", "No licence here. At all.", f"Copyright (c) 2020 me.\n{mit}\nMore.", "Text.\nLicensed under CC BY-NC 4.0.",
        f"{s['mit-grant']} {s['mit-notice']} other.", s["mit-notice"], f"{s['mit-short']}\n{s['apache-short']}\n{s['mit-short']}",
        f"{s['bsd-grant']}\n{s['bsd-source']}\n{s['bsd-binary']}\n{s['bsd-names']}", f"{s['apache-grant']} {s['apache-copy']}\nhttp://example.org\n{s['apache-basis']}",
        s["bsd-grant"] + "\nx." * 9 + "\n" + s["bsd-source"] + "\n" + s["bsd-binary"], s["mit-short"].upper(), f"{s['gpl-share']} {s['gpl-hope']}",
        "\n".join(textwrap.wrap(mit, 60)), "# " + "\n# ".join(textwrap.wrap(s["apache-grant"], 50)),
    ]
    got = {}
    for r in licences.matches(docs(spark, texts)).collect():
        got.setdefault(r.doc_id, []).append((r.first_sentence, r.licence, len(r.sentences.split(","))))
    assert {d: [x[1:] for x in sorted(v)] for d, v in got.items()} == {
        3: [("MIT", 4)], 4: [("CC-BY-NC-4.0", 1)], 5: [("MIT", 2)], 7: [("MIT", 1), ("Apache-2.0", 1), ("MIT", 1)],
        8: [("BSD-3-Clause", 4)], 9: [("Apache-2.0", 3)], 11: [("MIT", 1)], 12: [("GPL-3.0-or-later", 2)],
        13: [("MIT", 4)], 14: [("Apache-2.0", 1)],
    }
    assert licences.matches(docs(spark, texts).limit(0)).collect() == []


def test_no_python_on_native_paths(spark):
    table = docs(spark, line_texts(random.Random(1)))
    marks = spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "item_id long, text string")
    for df in (linededup.classes(table), oph.with_edited(table), decontaminate.contamination(table, marks)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_segment_keys_are_short(spark):
    """Keys of 40 bits on both sides of the exchange; a line of the same length looks for all segments of its own."""
    lines = spark.createDataFrame([("".join(chr(97 + (i * k) % 23) for k in range(30 + i)),) for i in range(60)], "line string").selectExpr("line", "char_length(line) AS n")
    for edits in (1, 2):
        probes = ", ".join(p for _, p in linededup._probes(edits))
        for r in lines.selectExpr(f"{linededup._segments(edits)} AS own", f"array({probes}) AS looked").collect():
            assert all(0 <= x < 1 << 40 for x in r.own + r.looked) and set(r.own) <= set(r.looked)
