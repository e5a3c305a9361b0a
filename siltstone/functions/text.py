"""Text functions, Column to Column, all inside the JVM but nfc.

Word characters are [\\p{L}\\p{N}_], not \\w, which Java limits to ASCII. Letter
case is folded with lower(). Null stays null unless said otherwise.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import words as W

WORD_CHARS = r"\p{L}\p{N}_"
WORD = rf"[{WORD_CHARS}]+(?:[-'][{WORD_CHARS}]+)*"
BLANKS = r"[\s\p{Z}]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sub(c: Column | str, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(col(c), pattern, to)


# -- whitespace, control characters, typography --


def unix_newlines(c: Column | str) -> Column:
    """CRLF and CR become LF."""
    return sub(c, r"\r\n?", "\n")


def collapse_blanks(c: Column | str) -> Column:
    """Runs of white space, Unicode's included, become one space; none at either end."""
    return F.trim(sub(c, BLANKS, " "))


def text_key(c: Column | str) -> Column:
    """Collapsed, lower-cased text, which equal texts share; '' for null."""
    return F.lower(collapse_blanks(F.coalesce(col(c), F.lit(""))))


def strip_controls(c: Column | str) -> Column:
    """Drops control characters but line feed and tab."""
    return sub(c, r"[\x00-\x08\x0b-\x1f\x7f-\x9f]")


def count_controls(c: Column | str) -> Column:
    return F.regexp_count(col(c), F.lit(r"[\x00-\x08\x0b-\x1f\x7f-\x9f]"))


def controls_to_blanks(c: Column | str) -> Column:
    return sub(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", " ")


def clean_value(c: Column | str) -> Column:
    """One field's value: no byte-order mark, controls as blanks, blanks collapsed."""
    return collapse_blanks(controls_to_blanks(sub(c, "﻿")))


def strip_row_marker(c: Column | str) -> Column:
    """A cleaned record line without its leading [fila n]."""
    return F.trim(sub(clean_value(c), W.ROW_MARKER))


def expand_ligatures(c: Column | str) -> Column:
    out = col(c)
    for ligature, plain in W.LIGATURES:
        out = F.replace(out, F.lit(ligature), F.lit(plain))
    return out


def join_hyphenated(c: Column | str) -> Column:
    """Joins words that a hyphen and a line break part."""
    return sub(c, rf"([{WORD_CHARS}])-\s*\n\s*(?=[{WORD_CHARS}])", "$1")


def join_broken_urls(c: Column | str) -> Column:
    """A URL and what stands at the start of the next line become one."""
    return sub(c, W.BROKEN_URL, "$1$2")


def strip_markup(c: Column | str) -> Column:
    """Markdown links become their labels; HTML tags go, and one heading mark and one list mark at the start of the text."""
    out = sub(c, W.MARKDOWN_LINK, "$1")
    out = sub(out, W.HTML_TAG)
    out = sub(out, W.HEADING_MARK)
    return sub(out, W.LIST_MARK)


def normalise_block(c: Column | str) -> Column:
    """A block of extracted text without format noise: byte-order marks, controls, broken words and markup go, blanks collapse within lines."""
    out = controls_to_blanks(sub(c, "﻿"))
    return F.regexp_replace(sub(strip_markup(join_hyphenated(out)), r"[ \t]+", " "), r"^\s+|\s+$", "")


def truncate_words(c: Column | str, limit: int = 250) -> Column:
    """The first `limit` words; where words were left out, an ellipsis replaces trailing blanks, commas, semicolons and colons."""
    split = F.split(collapse_blanks(col(c)), " ")
    head = F.array_join(F.slice(split, 1, limit), " ")
    return F.when(F.size(split) <= limit, head).otherwise(F.concat(sub(head, r"[ ,;:]+$"), F.lit("…")))


def attribute(c: Column | str, limit: int = 500) -> Column:
    """A graph attribute: collapsed, at most `limit` characters, '' for null."""
    return F.substring(collapse_blanks(F.coalesce(col(c).cast("string"), F.lit(""))), 1, limit)


def block_key(c: Column | str) -> Column:
    """What two blocks share that differ in markup, case and punctuation alone."""
    return sub(sub(F.lower(normalise_block(c)), r"[*_`~]+"), r"[^\p{L}\p{N}_\s]")


def mojibake_hits(c: Column | str) -> Column:
    return F.regexp_count(col(c), F.lit(W.MOJIBAKE))


def repair_mojibake(c: Column | str) -> Column:
    """Text that is UTF-8 read as Latin-1 is read again as UTF-8, if that leaves fewer suspicious sequences."""
    text = col(c)
    latin = ~text.rlike(r"[^\x00-\xff]")
    raw = F.encode(text, "ISO-8859-1")
    again = F.when(latin & F.is_valid_utf8(raw.cast("string")), raw.cast("string"))
    return F.when(again.isNotNull() & (mojibake_hits(again) < mojibake_hits(text)), again).otherwise(text)


# -- hashes, counts, detection --


def content_hash(c: Column | str) -> Column:
    """SHA-256 of the text's key; '' for texts of blanks alone and null."""
    key = text_key(c)
    return F.when(key == "", F.lit("")).otherwise(F.sha2(key, 256))


def word_count(c: Column | str) -> Column:
    """Words as runs of letters, digits and underscores, joined by hyphens and apostrophes."""
    return F.coalesce(F.regexp_count(col(c), F.lit(WORD)), F.lit(0))


def split_words(c: Column | str) -> Column:
    """Words between white space."""
    return F.filter(F.split(collapse_blanks(F.coalesce(col(c), F.lit(""))), " "), lambda w: w != "")


def split_count(c: Column | str) -> Column:
    """How many words split_words has."""
    return F.coalesce(F.regexp_count(col(c), F.lit(r"[^\s\p{Z}]+")), F.lit(0))


def tokens_up(n: Column) -> Column:
    """1.3 tokens a word, rounded up."""
    return F.ceil(F.expr("1.3D") * n)


def tokens_even(n: Column) -> Column:
    """1.3 tokens a word, halves rounded to even."""
    return F.bround(F.expr("1.3D") * n, 0).cast("long")


def language(c: Column | str) -> Column:
    """es, en or pt by how many stop words the first 5000 characters hold; unknown below 20 words or 2 hits. Ties go in that order."""
    sample = F.substring(collapse_blanks(F.coalesce(col(c), F.lit(""))), 1, 5000)
    split = F.split(F.lower(sample), " ")

    def hit(stop: tuple[str, ...]) -> Column:
        return F.size(F.filter(split, lambda w: w.isin(*stop)))

    hits = [hit(stop) for _, stop in W.LANGUAGE_STOP_WORDS]
    best = F.greatest(*hits)
    out = F.when((F.size(split) < 20) | (best < 2), "unknown")
    for n, (name, _) in zip(hits, W.LANGUAGE_STOP_WORDS, strict=True):
        out = out.when(n == best, name)
    return out


def is_numeric_noise(c: Column | str) -> Column:
    """Digits without a letter, and no percentage, currency or year to give them a meaning."""
    text = F.trim(col(c))
    return ~text.rlike(r"[A-Za-zÀ-ÿ]") & text.rlike(r"\d") & ~text.rlike(W.MEANINGFUL_NUMBER)


def heading_key(c: Column | str) -> Column:
    return F.btrim(F.lower(collapse_blanks(normalise_block(c))), F.lit(" .:-"))


def is_toc_heading(c: Column | str) -> Column:
    """The heading of a table of contents, by name or by how it starts, up to 10 words."""
    key = heading_key(c)
    starts = key.rlike(r"^(?:" + "|".join(W.TOC_STARTS) + ")")
    return key.isin(*W.TOC_NAMES) | (starts & (word_count(key) <= 10))


def is_end_matter_heading(c: Column | str) -> Column:
    """The heading of references, credits, a glossary and the like."""
    return heading_key(c).isin(*W.END_MATTER_NAMES)


TOC_ENTRY = W.TOC_ENTRY
TOC_NUMBERED = W.TOC_NUMBERED


def is_toc_entry(c: Column | str, in_toc: Column) -> Column:
    """An entry of a table of contents: a trailing page number; within one also numbered, or short lines that end no sentence, or short headings."""
    line = F.trim(col(c))
    n = word_count(line)
    inside = line.rlike(TOC_NUMBERED) | ((n <= 14) & ~line.rlike(r"[.!?。！？]$")) | (line.rlike(W.HEADING) & (n <= 20))
    return (line != "") & (line.rlike(TOC_ENTRY) | (in_toc & inside))


def is_toc_noise(c: Column | str, section: Column | None = None) -> Column:
    """A flattened table of contents: two of its usual terms and four page numbers, or three in the shape of a table; or a section of that name."""
    text = F.lower(col(c))
    pages = F.regexp_count(text, F.lit(rf"(?<![{WORD_CHARS}])\d{{1,3}}(?![{WORD_CHARS}])"))
    terms = sum((text.contains(t).cast("int") for t in W.TOC_TERMS), F.lit(0))
    table = text.contains("|---") | (F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit(""))) >= 6)
    noise = (terms >= 2) & ((pages >= 4) | (table & (pages >= 3)))
    return noise if section is None else F.coalesce(is_toc_heading(section), F.lit(False)) | noise


TABLE_RULE = W.TABLE_RULE


def lines(c: Column | str) -> Column:
    return F.split(col(c), "\n")


def is_table(c: Column | str) -> Column:
    """At least two lines, and a rule between header and rows or two lines that start with a bar."""
    rows = F.filter(F.transform(lines(c), lambda x: F.trim(x)), lambda x: x != "")
    return (F.size(rows) >= 2) & (F.exists(rows, lambda x: x.rlike(TABLE_RULE)) | (F.size(F.filter(rows, lambda x: x.startswith("|"))) >= 2))


def table_rows(c: Column | str) -> Column:
    """A table's lines without blank ones and rules."""
    return F.filter(F.transform(lines(c), lambda x: F.trim(x)), lambda x: (x != "") & ~x.rlike(TABLE_RULE))


def continues(previous: Column, current: Column) -> Column:
    """Whether a paragraph goes on with the one before: not after a connector of change; after one that continues, an anaphoric start, two shared words of four letters or one of nine."""
    start = F.trim(sub(F.lower(current), r"^[\s\d.)-]+"))

    def any_start(options: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for o in options:
            out = out | start.startswith(o)
        return out

    def long_words(c: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(rf"[{WORD_CHARS}]{{4,}}"), F.lit(0)))

    shared = F.array_except(F.array_intersect(long_words(previous), long_words(current)), F.array(*map(F.lit, W.CONTINUITY_STOP_WORDS)))
    related = (F.size(shared) >= 2) | F.exists(shared, lambda w: F.length(w) >= 9)
    return F.when(any_start(W.CHANGE_CONNECTORS), False).when(any_start(W.CONTINUATION_CONNECTORS) | any_start(W.ANAPHORIC_STARTS), True).otherwise(related)


# -- kinds of lines --


def is_page_number(c: Column | str) -> Column:
    """A line that is a page number alone, with página, page or a dash before it."""
    return F.trim(col(c)).rlike(W.PAGE_NUMBER)


def is_plain_page_number(c: Column | str) -> Column:
    """One to three digits alone; years are no page numbers."""
    return F.trim(col(c)).rlike(r"^0*\d{1,3}$") & (F.length(F.trim(col(c))) <= 4)


def is_bang_line(c: Column | str) -> Column:
    """What PDF extraction leaves of some glyphs: two bangs, or a bang and a number."""
    return F.trim(col(c)).rlike(W.BANG_LINE)


def is_extraction_mark(c: Column | str) -> Column:
    return col(c).rlike(W.EXTRACTION_MARK)


def is_page_mark(c: Column | str) -> Column:
    return col(c).rlike(W.PAGE_MARK)


def is_marked_page_number(c: Column | str, romans: bool = True) -> Column:
    """A page number, bold or not, in digits or (by default) in letters of Roman numerals, which also takes words like civil."""
    digits = r"\d{1,4}|[ivxlcdm]{1,12}" if romans else r"\d{1,4}"
    return col(c).rlike(rf"^(?i)\s*(?:\*\*|__|\*|_)?(?:{digits})(?:\*\*|__|\*|_)?\s*$")


BULLET = W.BULLET


def strip_bullet(c: Column | str) -> Column:
    return F.trim(sub(c, BULLET))


def is_reference_line(c: Column | str) -> Column:
    return col(c).rlike(W.REFERENCE_LINE)


def is_reference_heading(c: Column | str) -> Column:
    return F.trim(col(c)).rlike(W.REFERENCE_HEADING)


def heading_name(c: Column | str) -> Column:
    return collapse_blanks(sub(F.trim(col(c)), ":+$"))


def is_removable_heading(c: Column | str) -> Column:
    return F.lower(heading_name(c)).isin(*W.REMOVABLE_HEADINGS)


def is_kept_heading(c: Column | str) -> Column:
    """Chapter 1, part II preview and the like, and headings by name that content hangs on."""
    name = heading_name(c)
    return name.rlike(W.NUMBERED_HEADING) | F.lower(name).isin(*W.KEPT_HEADINGS)


def is_content_heading(c: Column | str) -> Column:
    return col(c).rlike(W.CONTENT_HEADING)


def has_other_script(c: Column | str) -> Column:
    """Han, kana, Hangul, Arabic, Hebrew, Devanagari or Thai."""
    return col(c).rlike(r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}\p{IsArabic}\p{IsHebrew}\p{IsDevanagari}\p{IsThai}]")


def is_structural(c: Column | str) -> Column:
    """A line that stands for itself: blank, a reference, URL or bullet, mostly capitals up to 100 characters, a number before a capital, or four numbers in up to 180."""
    line = F.trim(col(c))
    letters = F.length(sub(line, r"[^\p{L}]"))
    capitals = F.length(sub(line, r"[^\p{Lu}]"))
    shouted = (F.length(line) <= 100) & ~line.rlike(r"[.,;:]$") & (letters > 0) & (capitals / letters >= 0.7)
    numbers = (F.regexp_count(line, F.lit(W.NUMBER)) >= 4) & (F.length(line) <= 180)
    return (line == "") | is_reference_line(line) | F.lower(line).rlike("^https?://") | col(c).rlike(BULLET) | F.coalesce(shouted, F.lit(False)) | line.rlike(W.NUMBER_BEFORE_CAPITAL) | numbers


# -- identifiers and small records --


def format_of(path: Column | str) -> Column:
    """The logical format of a path by its suffix; null if it is none that is read."""
    suffix = F.lower(F.regexp_extract(col(path), r"\.([^./\\]+)$", 1))
    out = None
    for name, suffixes in W.FORMATS:
        out = F.when(suffix.isin(*suffixes), name) if out is None else out.when(suffix.isin(*suffixes), name)
    return out


def basename(path: Column | str) -> Column:
    """The last part of a path, of either kind of slash."""
    return F.regexp_extract(col(path), r"([^/\\]*)$", 1)


def source_name(original: Column, source: Column) -> Column:
    """The file's name, or what the manifest calls its source."""
    return F.coalesce(F.when(basename(original) != "", basename(original)), source)


def numeric_tail(c: Column | str) -> Column:
    """The number that an identifier ends in, for sorting; those without come last."""
    return F.coalesce(F.regexp_extract(col(c), r"(\d+)$", 1).try_cast("long"), F.lit((1 << 63) - 1))


def tile(path: Column | str) -> Column:
    """(z, x, y) of .../tiles/z/x/NAME_y.pbf; null for other paths."""
    pattern = r"(?i)(?:^|/)tiles/([^/]+)/([^/]+)/(?:[^/]+/)*[^/]*_(\d+)\.[^./]+$"
    z = F.regexp_extract(col(path), pattern, 1)
    return F.when(z != "", F.struct(z.alias("z"), F.regexp_extract(col(path), pattern, 2).alias("x"), F.regexp_extract(col(path), pattern, 3).alias("y")))


def pair_value(line: Column | str, field: str) -> Column:
    """The value of a field in a line "field: value | field: value"; '' if it has none."""
    return F.trim(F.regexp_extract(col(line), rf"(?:^|\|)\s*{field}:\s*(.*?)(?=\s*\|\s*[^|]+:\s*|$)", 1))


def entity_key(line: Column | str) -> Column:
    """What the rows of one territorial entity share over map tiles."""
    out = None
    for field in W.ENTITY_FIELDS:
        v = pair_value(line, field)
        part = F.when(v != "", F.concat(F.lit(field + ":"), F.lower(v)))
        out = part if out is None else F.coalesce(out, part)
    for kind, fields in W.ENTITY_PAIRS:
        a, b = (F.lower(pair_value(line, f)) for f in fields)
        out = F.coalesce(out, F.when((a != "") | (b != ""), F.concat(F.lit(kind + ":"), a, F.lit(":"), b)))
    return F.coalesce(out, content_hash(line))


def row_pairs(names: list[str], skip: tuple[str, ...] = ()) -> Column:
    """A row as "name: value | name: value", without blank values and the fields to skip."""
    parts = []
    for n in names:
        if n not in skip:
            v = collapse_blanks(F.col(f"`{n}`").cast("string"))
            parts.append(F.when(v != "", F.concat(F.lit(n + ": "), v)))
    return F.concat_ws(" | ", *parts)


def node_key(kind: Column | str, label: Column | str) -> Column:
    return F.concat(col(kind), F.lit(":"), F.lower(attribute(label)))


def relevance_gain(label: Column | str) -> Column:
    """2 for alta, 1 for anything else."""
    return F.when(F.lower(F.trim(col(label))) == "alta", 2.0).otherwise(1.0)


def document_state(text: Column, warnings: Column) -> Column:
    """fallido if the text is empty or a warning is critical, procesado_con_advertencias if there are warnings, else procesado."""
    failed = (F.coalesce(text, F.lit("")) == "") | F.exists(warnings, lambda w: w.contains("[CRITICO]"))
    return F.when(failed, "fallido").when(F.size(warnings) > 0, "procesado_con_advertencias").otherwise("procesado")


def one_line_repeated(c: Column | str) -> Column:
    """Whether all of at least three lines that are not blank are the same."""
    rows = F.filter(F.transform(lines(c), lambda x: F.trim(x)), lambda x: x != "")
    return (F.size(rows) >= 3) & (F.size(F.array_distinct(rows)) == 1)


# -- normal form, experiments, results --


def nfc(c: Column | str) -> Column:
    """Text in Unicode's composed normal form. Spark has no function for it; texts of ASCII alone stay in the JVM."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())

    text = col(c)
    odd = F.when(text.rlike(r"[^\x00-\x7F]"), text)
    return F.coalesce(F.arrow_udf(run, "string")(odd), text)


def chunk_folder(experiment: Column | str) -> Column:
    """The folder of PDF chunks of an experiment, named by its configuration or its corpus; other names stay."""
    names = F.create_map(*[F.lit(x) for own in W.EXPERIMENTS for name in own[:2] for x in (name, own[2])])
    return F.coalesce(F.element_at(names, col(experiment)), col(experiment))


def corpus_name(folder: Column | str) -> Column:
    """The corpus that a folder of PDF chunks belongs to; other names stay."""
    names = F.create_map(*[F.lit(x) for own in W.EXPERIMENTS for x in (own[2], own[1])])
    return F.coalesce(F.element_at(names, col(folder)), col(folder))


def result_text(text: Column | str, texto: Column | str) -> Column:
    """A result's text: its field text, else texto, else ''; an empty field counts as none."""
    return F.coalesce(F.nullif(col(text), F.lit("")), col(texto), F.lit(""))
