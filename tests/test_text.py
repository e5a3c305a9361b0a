import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.functions import text as T


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (T.collapse_blanks, " a  b\n c ", "a b c"),
        (T.collapse_blanks, None, None),
        (T.expand_ligatures, "eﬃcient ﬁle ﬂat raﬄe", "efficient file flat raffle"),
        (T.join_hyphenated, "infor-\n mation 3-4 a-", "information 3-4 a-"),
        (T.join_broken_urls, "see https://a.b/c\nd/e now", "see https://a.b/cd/e now"),
        (T.strip_markup, "## Head [x](http://y) <b>z</b>", "Head x z"),
        (T.strip_markup, "1. item", "item"),
        (T.strip_row_marker, "[fila 12]: a: b", "a: b"),
        (T.clean_value, "﻿a\x00b\t c", "a b c"),
        (T.repair_mojibake, "mÃ¡s aÃ±os", "más años"),
        (T.repair_mojibake, "año Ã solo", "año Ã solo"),
        (T.repair_mojibake, "plain 中", "plain 中"),
        (T.content_hash, " \n", ""),
        (T.attribute, None, ""),
        (T.numeric_tail, "DOC-000123", 123),
        (T.numeric_tail, "none", (1 << 63) - 1),
        (T.format_of, "/a/b.JPG", "image"),
        (T.format_of, "/a/b.exe", None),
        (T.basename, "a\\b\\c.txt", "c.txt"),
        (T.heading_name, " Chapter  1:", "Chapter 1"),
    ],
)
def test_values(spark, f, value, want):
    assert one(spark, value, f) == want


@pytest.mark.parametrize(
    ("f", "yes", "no"),
    [
        (T.is_numeric_noise, ["12 34", "3.5 | 7"], ["12 %", "1999", "a 1", "...", "€ 5"]),
        (T.is_toc_heading, ["Contents", "## Índice:", "Table of contents for all"], ["Content creators", "table of contents " + "x " * 10]),
        (T.is_end_matter_heading, ["References", "Glosario.", "références"], ["reference manual"]),
        (T.is_page_number, ["12", "Página 3", "page - 4", "– 7"], ["12345", "p 3", "1900 x"]),
        (T.is_plain_page_number, ["7", "999"], ["1987", "1000", "x"]),
        (T.is_marked_page_number, ["**12**", "xiv", "civil"], ["page", "12345"]),
        (T.is_bang_line, ["! !", "! 12"], ["!", "wow!"]),
        (T.is_page_mark, ["<!-- página 3 -->", "*<!-- page 12 -->*"], ["<!-- x -->"]),
        (T.is_extraction_mark, ["!! 3", "!!!", "~~"], ["a!"]),
        (T.is_reference_line, ["[3] Smith", "4) Jones"], ["Smith [3]"]),
        (T.is_reference_heading, ["REFERENCES", "Bibliografía"], ["References 2"]),
        (T.is_removable_heading, ["Table of  contents:", "Get involved"], ["Introduction"]),
        (T.is_kept_heading, ["Chapter 3", "Overview", "part a1 highlights"], ["Chapter three"]),
        (T.has_other_script, ["a 中", "ひ", "العربية", "ไทย"], ["é ß", "кириллица"]),
        (T.is_structural, ["", "1) x", "HTTP://a", "• x", "ANNUAL REPORT", "3% Growth", "1 2 3 4"], ["Plain words here.", "LOUD ENDS.", "a 1 b 2"]),
        (T.is_table, ["| a | b |\n|---|---|", "| a |\n| b |"], ["| a |", "a\nb"]),
        (T.one_line_repeated, ["a\na\n a"], ["a\na", "a\nb\na"]),
    ],
)
def test_predicates(spark, f, yes, no):
    assert [one(spark, v, f) for v in yes] == [True] * len(yes)
    assert [bool(one(spark, v, f)) for v in no] == [False] * len(no)


def test_marked_page_numbers_without_romans(spark):
    assert not one(spark, "civil", lambda c: T.is_marked_page_number(c, False))


@pytest.mark.parametrize(("n", "up", "even"), [(0, 0, 0), (1, 2, 1), (5, 7, 6), (25, 33, 32), (45, 59, 58), (200, 260, 260)])
def test_tokens(spark, n, up, even):
    assert one(spark, n, T.tokens_up, "int") == up
    assert one(spark, n, T.tokens_even, "int") == even == round(1.3 * n)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="aé1_-' .\n", max_size=25), min_size=1, max_size=20))
def test_word_count(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "v string").select(T.word_count("v")).collect()
    assert [r[0] for r in rows] == [len(re.findall(r"[\w]+(?:[-'][\w]+)*", t)) for t in texts]


def test_truncate(spark):
    assert one(spark, "a b, c", lambda c: T.truncate_words(c, 2)) == "a b…"
    assert one(spark, " a  b ", lambda c: T.truncate_words(c, 2)) == "a b"


def test_continues(spark):
    def f(a, b):
        return spark.createDataFrame([(a, b)], "a string, b string").select(T.continues(F.col("a"), F.col("b")).alias("x")).first()["x"]

    assert f("x", "Además hay") and f("x", "1. This one") and f("great mountain", "the mountain is great")
    assert f("an extraordinary day", "extraordinary")
    assert not f("great mountain", "However, the great mountain") and not f("one word", "another word")


def test_entity_keys(spark):
    assert one(spark, "layer: a | fid: 3", T.entity_key) == "feature:a:3"
    assert one(spark, "x: 1 | b_ADM1_PCODE: P1 | layer: a", T.entity_key) == "admin:p1:"
    assert one(spark, "au_ID_concatenated: Z9 | layer: a", T.entity_key) == "au_ID_concatenated:z9"
    assert len(one(spark, "x: 1", T.entity_key)) == 64


def test_tile(spark):
    assert tuple(one(spark, "/d/tiles/5/10/P_12.pbf", T.tile)) == ("5", "10", "12")
    assert one(spark, "/d/5/10/P_12.pbf", T.tile) is None


def test_toc_noise(spark):
    assert one(spark, "Contents Introduction 3 Chapter 4 References 12 Annex 20", T.is_toc_noise)
    assert not one(spark, "Introduction to chapter 3 of 12", T.is_toc_noise)
    assert one(spark, "| contents | chapter | 1 | 2 | 3 |", T.is_toc_noise)


def test_language(spark):
    es, en = "el perro que la casa " * 6, "the dog and the house of " * 5
    assert one(spark, es, T.language) == "es" and one(spark, en, T.language) == "en"
    assert one(spark, "the and of", T.language) == "unknown" == one(spark, None, T.language)
