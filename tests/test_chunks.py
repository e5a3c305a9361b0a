"""Packing and segmentation against plain Python written from their descriptions."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.operators import lines, packing, records, segment
from siltstone.plans import ingest


def words(t):
    return len(re.findall(r"[\w]+(?:[-'][\w]+)*", t))


def of(spark, texts, f):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string").select("i", f(F.col("v")).alias("x")).collect()
    return [r["x"] for r in sorted(rows, key=lambda r: r["i"])]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("One two. Three? Four!", ["One two.", "Three?", "Four!"]),
        ("Dr. Smith paid 3.5 dollars. Good.", ["Dr. Smith paid 3.5 dollars.", "Good."]),
        ('He said "yes." Then left.', ['He said "yes."', "Then left."]),
        ("e.g. this vs. that etc. Right.", ["e.g. this vs. that etc. Right."]),
        ("一。 二！", ["一。", "二！"]),
        ("no end", ["no end"]),
        ("", []),
    ],
)
def test_careful_sentences(spark, text, want):
    assert of(spark, [text], segment.careful_sentences)[0] == want


def pack_plainly(sizes, limit):
    out, cur = [], []
    for n in sizes:
        if cur and sum(cur) + n > limit:
            out.append(cur)
            cur = []
        cur.append(n)
    return out + [cur] * bool(cur)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=12))
def test_pack_sentences(spark, sizes):
    text = " ".join(" ".join(["w"] * n) + "." for n in sizes)
    got = of(spark, [text], lambda c: packing.pack_sentences(c, 40, 50))[0]
    assert [p["words"] for p in got] == [sum(g) for g in pack_plainly(sizes, 40)]
    assert " ".join(p["text"] for p in got) == text


def test_long_sentences_are_split_or_kept(spark):
    text = "a b. " + ", ".join(["w " * 6 + "w"] * 4) + ". c d."
    got = of(spark, [text], lambda c: packing.pack_sentences(c, 10, 15))[0]
    assert [(p["words"], p["kind"]) for p in got] == [(2, "oracion"), (14, "suboracion"), (14, "suboracion"), (2, "oracion")]
    kept = of(spark, [text], lambda c: packing.pack_sentences(c, 10, 15, False))[0]
    assert [(p["words"], p["kind"]) for p in kept] == [(2, "oracion"), (28, "oracion_larga_conservada"), (2, "oracion")]
    hard = of(spark, ["w " * 40 + "."], lambda c: packing.pack_sentences(c, 10, 15))[0]
    assert [(p["words"], p["kind"]) for p in hard] == [(15, "limite_palabras"), (15, "limite_palabras"), (10, "limite_palabras")]


def test_pack_table(spark):
    rows = ["| a b | c |", "|---|---|", "| d | e f g |", "| h |"]
    got = of(spark, ["\n".join(rows)], lambda c: packing.pack_table(c, 5, 6))[0]
    assert [p["text"] for p in got] == ["| a b | c |", "| d | e f g |\n| h |"]
    long = "| a b c | d e f | " + "g " * 9 + "|"
    got = of(spark, ["| x |\n" + long + "\n| y |"], lambda c: packing.pack_table(c, 5, 6))[0]
    assert [(p["text"], p["kind"]) for p in got] == [("a b c | d e f", "celda_tabla"), ("g g g g g g", "limite_palabras"), ("g g g", "limite_palabras"), ("| x |\n| y |", "fila_tabla")]


def overlapping(sentences, limit, overlap, goes_on):
    """Step back to the last sentences of a chunk that the next sentence goes on with."""
    out, i = [], 0
    while i < len(sentences):
        j = i
        while j < len(sentences) and (j == i or sum(map(words, sentences[i : j + 1])) <= limit):
            j += 1
        out.append(" ".join(sentences[i:j]))
        if j < len(sentences) and goes_on(out[-1], sentences[j]):
            j = max(i + 1, j - min(overlap, j - i))
        i = j
    return out


@pytest.mark.parametrize("overlap", [1, 2])
def test_overlap(spark, overlap):
    draw = random.Random(overlap)
    starts = ["This", "However", "Mountain", "Extraordinary"]
    texts = [[draw.choice(starts) + " w" * draw.randrange(1, 6) + "." for _ in range(draw.randrange(1, 12))] for _ in range(25)]
    got = of(spark, [" ".join(t) for t in texts], lambda c: packing.pack_overlapping(c, overlap, 9, 9))
    for t, out in zip(texts, got, strict=True):
        def goes_on(a, b):
            if b.startswith("However"):
                return False
            return b.startswith("This") or b.startswith("Extraordinary") and "Extraordinary" in a

        assert out == overlapping(t, 9, overlap, goes_on)


def test_semantic(spark):
    units = [("a a", 2, [1.0, 0.0]), ("b b", 2, [1.0, 0.0]), ("c c", 2, [0.0, 1.0]), ("d d", 2, [0.0, 1.0]), ("e e", 2, [1.0, 0.0])]
    df = spark.createDataFrame([(units,)], "u array<struct<text:string,words:int,vec:array<double>>>")
    assert df.select(packing.pack_semantic(F.col("u"), 4, 100).alias("x")).first()["x"] == ["a a b b", "c c d d", "e e"]
    assert df.select(packing.pack_semantic(F.col("u"), 4, 4).alias("x")).first()["x"] == ["a a b b", "c c d d", "e e"]
    assert df.select(packing.pack_semantic(F.col("u"), 4, 2).alias("x")).first()["x"] == ["a a", "b b", "c c", "d d", "e e"]


def test_plain_chunks_cover_the_text(spark):
    draw = random.Random(1)
    texts = [" ".join("w" * draw.randrange(1, 8) + draw.choice(["", "", "."]) for _ in range(n)) for n in (0, 1, 249, 250, 251, 900)] + [None, " \n "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    by = {}
    for r in ingest.plain_chunks(docs).collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == {1, 2, 3, 4, 5}
    for i, chunks in by.items():
        chunks.sort(key=lambda r: r["posicion"])
        assert [c["posicion"] for c in chunks] == list(range(len(chunks)))
        assert " ".join(c["texto"] for c in chunks) == texts[i]
        assert all(texts[i][c["char_start"] : c["char_end"]] == c["texto"] for c in chunks)
        at = 0
        for c in chunks:
            assert (c["token_start"], c["token_end"]) == (at, at + round(1.3 * len(c["texto"].split())))
            at = c["token_end"]


def test_blocks(spark):
    text = "intro line\nmore\n\n# Contents\n1. One 3\n## 2. Two 5\nDots .... 7\n# Body\nfirst\n\nsecond\n# References\nSmith\n# After\nlast\nIndex\nlost"
    rows = segment.blocks(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")).orderBy("doc_id", "pos").collect()
    assert [(r["pos"], r["block"], r["section"]) for r in rows] == [(0, "intro line\nmore", None), (1, "first", "Body"), (2, "second", "Body"), (3, "last", "After")]


def arrays(spark, rows, f):
    df = spark.createDataFrame([(rows,)], "b array<struct<block:string,section:string>>")
    return [tuple(r) for r in df.select(f("b").alias("x")).first()["x"]]


def test_adjacent_copies(spark):
    base = "one two three four five six seven eight nine"
    rows = [(base, "s"), ("**" + base + "**", "s"), (base + " ten", "s"), (base, "t"), ("One, two", "t")]
    assert arrays(spark, rows, segment.drop_adjacent_copies) == [(base + " ten", "s"), (base, "t"), ("One, two", "t")]


def test_paragraphs(spark):
    long = "word " * 20
    rows = [(long.strip(), "s"), ("short", "s"), ("This " + long.strip(), "s"), ("However " + "other " * 20, "s"), ("x", "t")]
    got = arrays(spark, rows, segment.group_paragraphs)
    assert got == [(f"{long.strip()}\n\nshort\n\nThis {long.strip()}", "s"), ("However " + "other " * 20, "s"), ("x", "t")]


def test_records(spark):
    docs = spark.createDataFrame([(1, "[fila 2] a: b | c: d\n\n[fila 3] e: f", "csv"), (2, "Title\na | b\nc | d", "image"), (3, "date: x\ny", "image"), (4, "p q r | s t u v w | x", "pbf")], "doc_id long, text string, f string")
    got = {}
    for r in records.record_chunks(docs, most=4, format="f").collect():
        got.setdefault(r["doc_id"], {})[r["posicion"]] = (r["texto"], r["chunk_id"])
    assert [got[1][i][0] for i in sorted(got[1])] == ["a: b | c: d", "e: f"]
    assert [got[2][i][0] for i in sorted(got[2])] == ["Title | a | b", "Title | c | d"]
    assert [got[3][i][0] for i in sorted(got[3])] == ["date: x", "y"]
    assert [got[4][i][0] for i in sorted(got[4])] == ["p q r", "s t u v", "w", "x"]
    assert got[4][0][1] == "4-CH-0000"


def test_page_furniture(spark):
    text = "HEAD\na\n3\f HEAD\nb\nPage 4\n\fHEAD\nc"
    out = lines.drop_page_furniture(spark.createDataFrame([(1, text), (2, "x\n7\nx")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert out[0]["text"].split() == ["a", "b", "c"] and out[0]["removed"] == 3
    assert out[1]["text"] == "x\nx" and out[1]["removed"] == 0


def test_second_pass(spark):
    text = "Table of contents\nThe eﬃ-\ncient way\ngoes on\nREPORT TITLE\n• first point\n12\nRun head\nx y.\nRun head\nz.\nRun head\nReferences\n[1] Smith\nnotes here\nANNEX A\nafter"
    out = lines.second_pass(spark.createDataFrame([(1, text), (2, "References\n[1] x"), (3, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert out[0]["text"] == "The efficient way goes on\n\nREPORT TITLE\n\nfirst point x y. z.\n\nANNEX A\n\nafter"
    assert out[1]["text"] == "" and out[2]["text"] == ""


def test_pdf_artifacts(spark):
    rows = lines.explode_lines(spark.createDataFrame([(1, "ANNUAL\nbody\n12\nxiv\n<!-- page 3 -->\nAnnual\nANNUAL\nhttp://a\nhttp://a\nHTTP://a\nAnnual ok")], "doc_id long, text string"))
    got = [r["line"] for r in lines.drop_pdf_artifacts(rows).orderBy("pos").collect()]
    assert got == ["body", "Annual", "Annual ok"]


def test_proposed_rules(spark):
    docs = spark.createDataFrame([(1, "foot\nbody\nfoot\nIntroduction\nIntroduction\nTel 12\nTel 34\nkeep")], "doc_id long, text string")
    rows = lines.explode_lines(docs)
    rules = spark.createDataFrame([(1, "foot", 0.95), (1, "Introduction", 0.99), (1, "body", 0.99), (1, "keep", 0.5)], "doc_id long, text string, confidence double")
    left = lines.delete_proposed_lines(rows, rules)
    assert [r["line"] for r in left.orderBy("pos").collect()] == ["body", "Introduction", "Introduction", "Tel 12", "Tel 34", "keep"]
    patterns = spark.createDataFrame([(1, r"^tel \d+$", 0.95), (1, "^keep$", 0.95), (1, "body", 0.95)], "doc_id long, pattern string, confidence double")
    assert [r["line"] for r in lines.delete_by_pattern(left, patterns).orderBy("pos").collect()] == ["body", "Introduction", "Introduction", "keep"]
    blocks = spark.createDataFrame([(1, "body\n", 0.96), (1, "foot", 0.99), (1, "keep", 0.9)], "doc_id long, block string, confidence double")
    assert lines.delete_proposed_blocks(docs, blocks).first()["text"].startswith("foot\nfoot\n")


def test_reasons_and_ids(spark):
    long = " ".join(["word"] * 16)
    assert of(spark, ["short one", "1 2 3 " * 6, long], lambda c: packing.reject_reason(c)) == ["corto", "ruido_numerico", None]
