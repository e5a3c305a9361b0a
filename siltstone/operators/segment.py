"""Sentences, sections and paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.functions import words as W

#: Stands for a boundary, or for a full stop that is none, while a text is cut.
CUT, STOP = "\x1f", "\x1e"


def sentences(text: Column | str) -> Column:
    """Parts at white space after . ! ? and their full-width forms; the text if there is none."""
    marked = T.sub(T.col(text), r"([.!?。！？｡])\s+", "$1" + CUT)
    parts = F.filter(F.transform(F.split(marked, CUT), lambda p: F.trim(p)), lambda p: p != "")
    return F.when(F.size(parts) == 0, F.array(T.col(text))).otherwise(parts)


def careful_sentences(text: Column | str) -> Column:
    """Sentences of collapsed text: as sentences(), but closing quotes and brackets stay with what they close, and abbreviations and decimal points end nothing.

    Stops of abbreviations are hidden behind STOP while the text is cut.
    """
    flat = T.collapse_blanks(text)
    short = "|".join(a[:-1].replace(".", r"\.") for a in sorted(W.ABBREVIATIONS, key=len, reverse=True))
    hidden = T.sub(flat, rf"(?i)(?<![{T.WORD_CHARS}.])({short})\.(?=\s|$)", "$1" + STOP)
    marked = T.sub(hidden, "([.!?。！？][.!?。！？…\"'”’»)\\]}]*)\\s+", "$1" + CUT)
    parts = F.transform(F.split(marked, CUT), lambda p: F.trim(F.replace(p, F.lit(STOP), F.lit("."))))
    return F.filter(parts, lambda p: p != "")


HEADING = W.HEADING


def blocks(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of Markdown between blank lines and headings: id, pos, block, section.

    Tables of contents and end matter go, from their heading, marked or not,
    to the next heading that is content; a heading that looks like an entry
    doesn't end a table of contents.

    Each line is given what it does to the state (content, toc, end): marked
    headings and unmarked contents headings set it whatever it was; unmarked
    headings of end matter and headings that look like entries do so unless it
    is toc. So the last line of the first kind, and else the last of either,
    tell the state, and windows suffice.
    """
    from siltstone.operators.lines import drop_pdf_artifacts, explode_lines

    rows = drop_pdf_artifacts(explode_lines(docs.select(id, T.unix_newlines(text).alias(text)), id, text), id)
    line = F.col("line")
    marked = line.rlike(HEADING)
    heading = T.normalise_block(F.regexp_extract(line, HEADING, 1))
    entry = heading.rlike(T.TOC_ENTRY) | heading.rlike(T.TOC_NUMBERED)
    toc = F.when(marked, T.is_toc_heading(heading)).otherwise(T.is_toc_heading(line))
    end = F.when(marked, T.is_end_matter_heading(heading)).otherwise(T.is_end_matter_heading(line))
    does = F.when(toc, "toc").when(end, "end").when(marked, "content")
    always = F.when(toc | marked & (end | ~entry), does)
    w = Window.partitionBy(id).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    title = F.when(does.isNotNull(), F.struct(does.alias("does"), F.when(does == "content", F.when(heading != "", heading)).alias("title")))
    rows = rows.select("*", does.alias("_does"), F.last(always, True).over(w).alias("_set"), F.last(title, True).over(w).alias("_last"))
    state = F.when(F.col("_set") == "toc", "toc").otherwise(F.coalesce(F.col("_last.does"), F.lit("content")))
    kept = (state == "content") & F.col("_does").isNull() & (F.trim("line") != "")
    breaks = F.col("_does").isNotNull() | (F.trim("line") == "")
    rows = rows.select(id, "pos", F.trim("line").alias("line"), kept.alias("_kept"), F.col("_last.title").alias("section"), F.sum(breaks.cast("int")).over(w).alias("_block"))
    found = rows.where("_kept").groupBy(id, "_block").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("_rows"), F.first("section", True).alias("section"))
    body = T.normalise_block(F.array_join(F.transform("_rows", lambda r: r["line"]), "\n"))
    found = found.select(id, "_block", body.alias("block"), "section").where("block <> ''")
    return found.select(id, (F.row_number().over(Window.partitionBy(id).orderBy("_block")) - 1).alias("pos"), "block", "section")


def block_arrays(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """(id, blocks): the blocks of each document in order, as an array of (block, section)."""
    rows = F.sort_array(F.collect_list(F.struct("pos", "block", "section")))
    return found.groupBy(id).agg(F.transform(rows, lambda r: F.struct(r["block"].alias("block"), r["section"].alias("section"))).alias("blocks"))


def _without_last(array: Column) -> Column:
    return F.slice(array, 1, F.size(array) - 1)


def _bare(array: Column) -> Column:
    return F.transform(array, lambda x: F.struct(x["block"].alias("block"), x["section"].alias("section")))


def drop_adjacent_copies(array: Column | str) -> Column:
    """Blocks without those that repeat the block before in the same section, but for markup, case and punctuation, or that it holds; of two the longer stays.

    One holds the other if the shorter has eight words and markup or 0.35 of
    the longer's length. What is compared is found once for each block.
    """
    known = F.transform(T.col(array), lambda x: F.struct(x["block"].alias("block"), x["section"].alias("section"), T.block_key(x["block"]).alias("key"), T.word_count(x["block"]).alias("words"), x["block"].rlike("[*_`]").alias("marked")))
    empty = F.array().cast("array<struct<block:string,section:string,key:string,words:int,marked:boolean>>")

    def held(small: Column, large: Column) -> Column:
        enough = small["marked"] | (F.length(small["key"]) / F.length(large["key"]) >= 0.35)
        return (small["words"] >= 8) & enough & large["key"].contains(small["key"])

    def step(out: Column, x: Column) -> Column:
        last = F.element_at(out, -1)
        comparable = (F.size(out) > 0) & last["section"].eqNullSafe(x["section"]) & (last["key"] != "") & (x["key"] != "")
        return F.when(comparable & ((last["key"] == x["key"]) | held(x, last)), out).when(comparable & held(last, x), F.concat(_without_last(out), F.array(x))).otherwise(F.concat(out, F.array(x)))

    return _bare(F.aggregate(known, empty, step))


def group_paragraphs(array: Column | str, most: int = 250, least: int = 15) -> Column:
    """Blocks joined to the one before, in the same section and up to `most` words, if they go on with it or either has at most `least` words."""
    known = F.transform(T.col(array), lambda x: F.struct(x["block"].alias("block"), x["section"].alias("section"), T.word_count(x["block"]).alias("words")))
    empty = F.array().cast("array<struct<block:string,section:string,words:int>>")

    def step(out: Column, x: Column) -> Column:
        last = F.element_at(out, -1)
        short = (last["words"] <= least) | (x["words"] <= least)
        ok = (F.size(out) > 0) & last["section"].eqNullSafe(x["section"]) & (last["words"] + x["words"] <= most) & (short | T.continues(last["block"], x["block"]))
        joined = F.struct(F.concat(last["block"], F.lit("\n\n"), x["block"]).alias("block"), last["section"].alias("section"), (last["words"] + x["words"]).alias("words"))
        return F.when(ok, F.concat(_without_last(out), F.array(joined))).otherwise(F.concat(out, F.array(x)))

    return _bare(F.aggregate(known, empty, step))
