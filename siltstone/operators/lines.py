"""Cleaning line by line: repeated headers and footers, references, reflow.

Lines of a document are rows (id, pos, line) here; windows and groups run
within a document, so no shuffle carries more than one document to a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import text as T


def explode_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, pos, line) of each line, from position 0; documents of null text have none."""
    return docs.select(id, F.posexplode(T.lines(text)).alias("pos", "line"))


def join_lines(lines: DataFrame, id: str = "doc_id", text: str = "text", by: str = "\n") -> DataFrame:
    """The lines of each document in order, as one text."""
    rows = F.sort_array(F.collect_list(F.struct("pos", "line")))
    return lines.groupBy(id).agg(F.array_join(F.transform(rows, lambda r: r["line"]), by).alias(text))


def repeated_lines(lines: DataFrame, least: int, longest: int, id: str = "doc_id") -> DataFrame:
    """(id, line, n): trimmed lines of at most `longest` characters that occur at least `least` times in a document."""
    trimmed = lines.select(id, F.trim("line").alias("line")).where("line <> ''")
    return trimmed.groupBy(id, "line").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") >= least) & (F.length("line") <= longest))


def drop_page_furniture(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts of several pages (parted by form feeds) without the lines that at least half the pages repeat, and without page numbers: id, text, removed.

    Occurrences are counted over the whole document, at least two, for lines
    up to 180 characters; each page ends in a blank line. Texts of one page
    lose only lines that are page numbers. removed counts repeated lines.
    """
    paged = docs.withColumn("_pages", F.split(F.regexp_replace(F.col(text), "\n\f\n", "\f"), "\f"))
    rows = paged.select(id, F.size("_pages").alias("pages"), F.posexplode("_pages").alias("page", "body"))
    ended = F.when(F.col("pages") > 1, F.concat("body", F.lit("\n"))).otherwise(F.col("body"))
    rows = rows.select(id, "pages", "page", F.posexplode(F.split(ended, "\n")).alias("pos", "line"))
    n = F.count(F.lit(1)).over(Window.partitionBy(id, F.trim("line")))
    least = F.greatest(F.lit(2), F.floor((F.col("pages") + 1) / 2))
    rows = rows.withColumn("repeated", (F.col("pages") > 1) & (F.trim("line") != "") & (F.length(F.trim("line")) <= 180) & (n >= least))
    rows = rows.where(~T.is_page_number("line"))
    kept = F.sort_array(F.collect_list(F.when(~F.col("repeated"), F.struct("page", "pos", "line"))))
    return rows.groupBy(id).agg(F.array_join(F.transform(kept, lambda r: r["line"]), "\n").alias(text), F.sum(F.col("repeated").cast("int")).alias("removed"))


def tidy(text: Column | str) -> Column:
    """Lines trimmed, blanks within them collapsed, at most one blank line between any two, none at the ends."""
    trimmed = F.transform(T.lines(text), lambda x: F.trim(T.sub(x, r"[ \t]+", " ")))
    return T.sub(T.sub(F.array_join(trimmed, "\n"), r"\n{3,}", "\n\n"), r"^\s+|\s+$")


def clean(docs: DataFrame, id: str = "doc_id", text: str = "text", format: str | None = None) -> DataFrame:
    """The first cleaning: id, text, repaired (suspicious sequences mended), removed (repeated lines).

    Mends UTF-8 read as Latin-1, composes accents (NFC), drops control characters, page furniture and,
    where the column `format` says pdf, bang lines, and tidies blanks. Null
    texts stay null.
    """
    raw = F.col(text)
    mended = T.repair_mojibake(raw)
    plain = T.nfc(F.replace(T.unix_newlines(mended), F.lit(" "), F.lit(" ")))
    plain = T.sub(plain, r"[\p{C}&&[^\n\t\f]]")
    first = docs.select(id, F.when(F.lower(F.col(format)) == "pdf", True).otherwise(False).alias("_pdf") if format else F.lit(False).alias("_pdf"), plain.alias(text), (T.mojibake_hits(raw) - T.mojibake_hits(mended)).alias("repaired"))
    bare = drop_page_furniture(first, id, text).join(first.select(id, "_pdf", "repaired"), id, "right")
    no_bangs = F.array_join(F.filter(T.lines(text), lambda x: ~T.is_bang_line(x)), "\n")
    return bare.select(id, tidy(F.when(F.col("_pdf"), no_bangs).otherwise(F.col(text))).alias(text), "repaired", F.coalesce("removed", F.lit(0)).alias("removed"))


def drop_references(lines: DataFrame, id: str = "doc_id") -> DataFrame:
    """Lines without blocks of references: from a heading of references up to the next structural line that is no reference.

    The last heading of references and the last line that would end a block
    tell, at each line, whether one is open.
    """
    w = Window.partitionBy(id).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = F.trim("line")
    heading = T.is_reference_heading(line)
    ends = ~heading & (line != "") & T.is_structural(line) & ~T.is_reference_line(line)
    event = F.when(heading, True).when(ends, False)
    return lines.withColumn("_in", F.coalesce(F.last(event, True).over(w), F.lit(False))).where(~F.col("_in")).drop("_in")


def drop_editorial_lines(lines: DataFrame, id: str = "doc_id") -> DataFrame:
    """Lines without headings of contents and thanks, page numbers up to 999 and short lines without digits, in Latin script, that occur three times; bullets are stripped. Counts go by the lines as given."""
    line = F.trim("line")
    n = F.count(F.lit(1)).over(Window.partitionBy(id, F.trim("line")))
    counted = lines.withColumn("_n", n).where(~T.is_removable_heading(line))
    bare = F.when(line.rlike(T.BULLET), T.strip_bullet(line)).otherwise(line)
    counted = counted.withColumn("line", bare)
    often = (F.col("line") != "") & (F.col("_n") >= 3) & (F.length("line") <= 120) & ~F.col("line").rlike(r"\d") & ~T.has_other_script("line")
    return counted.where(~T.is_plain_page_number("line") & ~often).drop("_n")


def reflow(lines: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One text per document: wrapped lines joined to paragraphs, words that a hyphen parts joined, structural lines alone, a blank line between paragraphs, broken URLs joined.

    A paragraph is a run of lines between structural ones; blank lines don't
    end it.
    """
    w = Window.partitionBy(id).orderBy("pos")
    line = F.col("line")
    rows = lines.withColumn("line", F.trim("line")).where("line <> ''").withColumn("_alone", T.is_structural("line"))
    opens = F.col("_alone") | F.coalesce(F.lag("_alone").over(w), F.lit(True))
    rows = rows.withColumn("_paragraph", F.sum(opens.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))), lambda r: r["line"]), "\n")
    paragraphs = rows.groupBy(id, "_paragraph").agg(body.alias("_body"))
    joined = T.sub(T.sub(F.col("_body"), r"-\n(?=\p{Ll})"), "\n", " ")
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_paragraph", joined.alias("p")))), lambda r: r["p"]), "\n\n")
    return paragraphs.groupBy(id).agg(T.join_broken_urls(whole).alias(text))


def second_pass(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The second cleaning, by rules alone: ligatures, controls, references, editorial lines, reflow. Documents of which nothing is left have the text ''."""
    plain = T.sub(F.replace(T.strip_controls(T.expand_ligatures(T.unix_newlines(text))), F.lit(" "), F.lit(" ")), r"[ \t]+", " ")
    rows = explode_lines(docs.select(id, plain.alias(text)), id, text)
    out = reflow(drop_editorial_lines(drop_references(rows, id), id), id, text)
    return docs.select(id).distinct().join(out, id, "left").select(id, F.coalesce(text, F.lit("")).alias(text))


def drop_pdf_artifacts(lines: DataFrame, id: str = "doc_id", romans: bool = True) -> DataFrame:
    """Lines without page marks, extraction marks, page numbers and lines up to 140 characters that occur three times, whatever their case, if they hold a URL, are a page number or in capitals (five letters at least)."""
    value = F.trim(T.sub("line", r"[ \t]+", " "))
    n = F.count(F.lit(1)).over(Window.partitionBy(id, F.lower(value)))
    letters = T.sub(value, r"[^A-Za-zÁÉÍÓÚÜÑáéíóúüñ]")
    shouted = (F.upper(letters) == letters) & (F.length(letters) >= 5)
    furniture = value.rlike(r"(?i)https?://\S+|www\.\S+") | value.rlike(r"^(?i)(?:p[áa]gina|page)?\s*\d{1,4}$") | shouted
    again = (value != "") & (F.col("_n") >= 3) & (F.length(value) <= 140) & furniture
    kept = lines.withColumn("_n", n).where(~T.is_page_mark("line") & ~T.is_extraction_mark("line") & ~T.is_marked_page_number("line", romans))
    return kept.where(~again).drop("_n")


def delete_proposed_lines(lines: DataFrame, rules: DataFrame, id: str = "doc_id") -> DataFrame:
    """Lines without those that accepted rules (id, text, confidence) name.

    A rule is accepted at a confidence of 0.9 for a line up to 120 characters
    that occurs twice, holds no content heading, ends in no colon and is in
    Latin script.
    """
    wanted = F.trim("text")
    content = T.is_content_heading(wanted) & ~T.is_removable_heading(wanted) & ~T.is_reference_heading(wanted)
    safe = (wanted != "") & (F.col("confidence") >= 0.9) & (F.length(wanted) <= 120) & ~content & ~T.is_kept_heading(wanted) & ~wanted.endswith(":") & ~T.has_other_script(wanted)
    proposed = rules.where(safe).select(id, wanted.alias("_line")).distinct()
    counted = lines.withColumn("_line", F.trim("line")).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(id, "_line")))
    hit = proposed.withColumn("_hit", F.lit(True))
    return counted.join(hit, [id, "_line"], "left").where(F.col("_hit").isNull() | (F.col("_n") < 2)).select(*lines.columns)


def delete_proposed_blocks(docs: DataFrame, rules: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts without blocks that rules (id, block, confidence) of confidence 0.95 name and that occur once, in Latin script. Rules of a document apply in order of their block."""
    safe = rules.where((F.col("confidence") >= 0.95) & (F.col("block") != "") & ~T.has_other_script("block"))
    each = safe.groupBy(id).agg(F.sort_array(F.collect_set("block")).alias("_blocks"))

    def apply(t: Column, b: Column) -> Column:
        without = F.replace(t, b, F.lit(""))
        return F.when(F.length(t) - F.length(without) == F.length(b), without).otherwise(t)

    done = F.aggregate(F.coalesce("_blocks", F.array().cast("array<string>")), F.col(text), apply)
    return docs.join(each, id, "left").withColumn(text, done).drop("_blocks")


def delete_by_pattern(lines: DataFrame, rules: DataFrame, id: str = "doc_id") -> DataFrame:
    """Lines without those that match an accepted rule (id, pattern, confidence): anchored at both ends, up to 200 characters, of one line, of confidence 0.9, with two matches at least."""
    ok = (F.col("confidence") >= 0.9) & F.col("pattern").rlike(r"^\^.*\$$") & (F.length("pattern") <= 200) & ~F.col("pattern").contains("\\n")
    accepted = rules.where(ok).select(id, "pattern").distinct()
    hits = lines.join(accepted, id).where(F.expr("trim(line) rlike concat('(?i)', pattern)"))
    enough = hits.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(id, "pattern"))).where("_n >= 2").select(id, "pos").distinct()
    return lines.join(enough, [id, "pos"], "left_anti")
