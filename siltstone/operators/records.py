"""Chunks of tables, images and map tiles: one record a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.operators import packing as P


def records(text: Column | str, format: Column | None = None) -> Column:
    """The cleaned lines that aren't blank. Of images, a first line without a bar that is no date, category or rank is put before each of the others."""
    lines = F.filter(F.transform(T.lines(T.unix_newlines(text)), lambda x: T.strip_row_marker(x)), lambda x: x != "")
    if format is None:
        return lines
    first = F.get(lines, F.lit(0))
    context = (F.lower(format) == "image") & (F.size(lines) > 1) & ~first.contains("|") & ~F.lower(first).rlike("^(date|category|rank):")
    return F.when(context, F.transform(F.slice(lines, 2, F.size(lines)), lambda x: F.concat(first, F.lit(" | "), x))).otherwise(lines)


def split_record(record: Column, most: int = 250) -> Column:
    """A record up to `most` words as it is; longer ones by fields between bars, longer fields and records without bars by words."""
    fields = F.filter(F.transform(F.split(record, r"\s*\|\s*"), lambda x: F.trim(x)), lambda x: x != "")
    units = F.flatten(F.transform(fields, lambda f: F.when(T.split_count(f) > most, F.transform(P.hard_split(f, most), lambda p: P.unit(p, T.split_count(p), True, "limite_palabras"))).otherwise(F.array(P.unit(f, T.split_count(f), False, "campo")))))
    packed = F.transform(P.pack(units, most, " | ", "campo"), lambda p: p["text"])
    return F.when(T.split_count(record) <= most, F.array(record)).when(F.size(fields) <= 1, P.hard_split(record, most)).otherwise(packed)


def record_chunks(docs: DataFrame, most: int = 250, least: int = 1, id: str = "doc_id", text: str = "text", format: str | None = None) -> DataFrame:
    """One chunk for each record or part of one: id, posicion, chunk_id, texto, num_palabras, num_tokens. Parts below `least` words go before positions are given."""
    pieces = F.flatten(F.transform(records(text, F.col(format) if format else None), lambda r: split_record(r, most)))
    rows = docs.select(id, F.posexplode(pieces).alias("pos", "texto"))
    rows = rows.withColumn("num_palabras", T.split_count("texto")).where(F.col("num_palabras") >= least)
    rows = rows.withColumn("num_tokens", T.tokens_even(F.col("num_palabras")))
    return P.number_chunks(rows, id).drop("pos")
