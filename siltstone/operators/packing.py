"""Chunks: packing sentences, clauses, rows, cells and fields up to a number of words.

Packing is one fold over an array of units in a row. A unit that is already too
long comes as pieces marked alone, which are chunks of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.functions import vectors as V
from siltstone.functions.folds import fold
from siltstone.operators.segment import careful_sentences, sentences

UNIT = "struct<text:string,words:int,alone:boolean,kind:string>"
PIECE = "struct<text:string,words:int,kind:string>"


def unit(text: Column, words: Column, alone: bool = False, kind: str | Column = "oracion") -> Column:
    return F.struct(text.alias("text"), words.cast("int").alias("words"), F.lit(alone).alias("alone"), (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"))


def _piece(text: Column, words: Column, kind: Column) -> Column:
    return F.struct(text.alias("text"), words.cast("int").alias("words"), kind.alias("kind"))


def pack(units: Column, limit: int, by: str = " ", kind: str = "oracion", keep_open: bool = False) -> Column:
    """Units joined greedily up to `limit` words: an array of (text, words, kind).

    Units alone close what is open, unless keep_open: then they come before
    it, and it goes on after them. Units of a paragraph or a table: each step
    copies what is out so far.
    """
    none = F.array().cast(f"array<{PIECE}>")
    start = F.struct(none.alias("out"), F.array().cast("array<string>").alias("open"), F.lit(0).alias("words"))

    def closed(s: Column) -> Column:
        return F.when(F.size(s["open"]) > 0, F.concat(s["out"], F.array(_piece(F.array_join(s["open"], by), s["words"], F.lit(kind))))).otherwise(s["out"])

    def step(s: Column, x: Column) -> Column:
        own = F.array(_piece(x["text"], x["words"], x["kind"]))
        full = (F.size(s["open"]) > 0) & (s["words"] + x["words"] > limit)
        if keep_open:
            alone = F.struct(F.concat(s["out"], own).alias("out"), s["open"].alias("open"), s["words"].alias("words"))
        else:
            alone = F.struct(F.concat(closed(s), own).alias("out"), F.array().cast("array<string>").alias("open"), F.lit(0).alias("words"))
        fresh = F.struct(closed(s).alias("out"), F.array(x["text"]).alias("open"), x["words"].alias("words"))
        more = F.struct(s["out"].alias("out"), F.concat(s["open"], F.array(x["text"])).alias("open"), (s["words"] + x["words"]).alias("words"))
        return F.when(x["alone"], alone).when(full, fresh).otherwise(more)

    return F.aggregate(units, start, step, closed)


def pack_all(units: Column, limit: int, kind: str = "oracion") -> Column:
    """As pack, for units (text, words) of whole documents, in one linear pass."""

    def packed(found: list[dict]) -> list[dict]:
        out: list[dict] = []
        open_: list[str] = []
        words = 0
        for u in [*found, None]:
            if open_ and (u is None or words + u["words"] > limit):
                out.append({"text": " ".join(open_), "words": words, "kind": kind})
                open_, words = [], 0
            if u:
                open_.append(u["text"])
                words += u["words"]
        return out

    return fold(packed, f"array<{PIECE}>", units)


def hard_split(text: Column | str, most: int = 250) -> Column:
    """Windows of `most` words between white space."""
    words = T.split_words(text)
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(1), F.size(words), F.lit(most))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, most), " "))


def _alone(pieces: Column, kind: str, count=T.word_count) -> Column:
    return F.transform(pieces, lambda p: unit(p, count(p), True, kind))


def split_long(text: Column, most: int = 250) -> Column:
    """A unit too long, cut at commas, semicolons, colons and spaced dashes and packed again (suboracion), and where that isn't enough by words (limite_palabras)."""
    marked = T.sub(T.sub(text, r"([,;:])\s+", "$1\x1f"), r"\s+[—–-]\s+", "\x1f")
    clauses = F.filter(F.transform(F.split(marked, "\x1f"), lambda c: F.trim(c)), lambda c: c != "")
    units = F.flatten(F.transform(clauses, lambda c: F.when(T.word_count(c) > most, _alone(hard_split(c, most), "limite_palabras")).otherwise(F.array(unit(c, T.word_count(c), False, "suboracion")))))
    whole = F.transform(hard_split(text, most), lambda p: _piece(p, T.word_count(p), F.lit("limite_palabras")))
    return F.when(F.size(clauses) <= 1, whole).otherwise(pack(units, most, " ", "suboracion"))


def pack_sentences(text: Column | str, target: int = 200, most: int = 250, split: bool = True) -> Column:
    """A narrative block as chunks of whole sentences up to `target` words. Sentences over `most` words are split, or kept alone if split is off."""

    def units(s: Column) -> Column:
        n = T.word_count(s)
        if split:
            long = F.transform(split_long(s, most), lambda p: F.struct(p["text"].alias("text"), p["words"].alias("words"), F.lit(True).alias("alone"), p["kind"].alias("kind")))
        else:
            long = F.array(unit(s, n, True, "oracion_larga_conservada"))
        return F.when(n > most, long).otherwise(F.array(unit(s, n)))

    return pack(F.flatten(F.transform(careful_sentences(text), units)), min(target, most))


def pack_table(text: Column | str, target: int = 200, most: int = 250) -> Column:
    """A table block as chunks of rows up to `target` words. Rows over `most` words come as groups of cells (celda_tabla), cells over that by words; such pieces come before the rows still open."""

    def cells(row: Column) -> Column:
        parts = F.filter(F.transform(F.split(F.btrim(row, F.lit("|")), r"\|"), lambda c: F.trim(c)), lambda c: c != "")
        units = F.flatten(F.transform(parts, lambda c: F.when(T.word_count(c) > most, _alone(hard_split(c, most), "limite_palabras")).otherwise(F.array(unit(c, T.word_count(c), False, "celda_tabla")))))
        packed = pack(units, most, " | ", "celda_tabla")
        return F.transform(packed, lambda p: F.struct(p["text"].alias("text"), p["words"].alias("words"), F.lit(True).alias("alone"), p["kind"].alias("kind")))

    units = F.flatten(F.transform(T.table_rows(text), lambda r: F.when(T.word_count(r) > most, cells(r)).otherwise(F.array(unit(r, T.word_count(r), False, "fila_tabla")))))
    return pack(units, min(target, most), "\n", "fila_tabla", keep_open=True)


def pack_block(text: Column | str, target: int = 200, most: int = 250, split: bool = True) -> Column:
    """A block up to `most` words passes as it is; longer ones are packed as tables or sentences."""
    block = T.col(text)
    n = T.word_count(block)
    whole = F.array(_piece(block, n, F.lit("oracion")))
    return F.when(n <= most, whole).when(T.is_table(block), pack_table(block, target, most)).otherwise(pack_sentences(block, target, most, split))


def pack_overlapping(text: Column | str, overlap: int = 1, target: int = 200, most: int = 250) -> Column:
    """Chunks of whole sentences where a chunk that the next sentence goes on with gives it its last `overlap` sentences.

    A chunk gives at most all sentences but its first, so each chunk starts
    after the one before. Sentences longer than `most` stand alone.
    """
    limit = min(target, most)
    found = careful_sentences(text)
    units = F.transform(found, lambda s: F.struct(s.alias("text"), T.word_count(s).alias("words")))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.array().cast("array<struct<text:string,words:int>>").alias("open"))

    def joined(open_: Column) -> Column:
        return F.array_join(F.transform(open_, lambda u: u["text"]), " ")

    def words(open_: Column) -> Column:
        return F.aggregate(open_, F.lit(0), lambda n, u: n + u["words"])

    def add(out: Column, open_: Column, x: Column, depth: int) -> Column:
        fits = (F.size(open_) == 0) | (words(open_) + x["words"] <= limit)
        more = F.struct(out.alias("out"), F.concat(open_, F.array(x)).alias("open"))
        emitted = F.concat(out, F.array(joined(open_)))
        if depth == 0:
            back = F.slice(open_, 1, 0)
        else:
            n = F.least(F.lit(depth), F.size(open_) - 1)
            back = F.when(T.continues(joined(open_), x["text"]) & (n > 0), F.slice(open_, F.size(open_) - n + 1, n)).otherwise(F.slice(open_, 1, 0))
        rest = F.struct(emitted.alias("out"), F.array(x).alias("open")) if depth == 0 else add(emitted, back, x, depth - 1)
        return F.when(fits, more).otherwise(rest)

    end = F.aggregate(units, start, lambda s, x: add(s["out"], s["open"], x, overlap))
    return F.when(F.size(end["open"]) > 0, F.concat(end["out"], F.array(joined(end["open"])))).otherwise(end["out"])


def pack_semantic(units: Column, target: int = 200, most: int = 250, threshold: float = 0.8) -> Column:
    """Sentences (text, words, vec) packed up to `most` words; a chunk of `target` words also ends where the next sentence's cosine is at most 1 - threshold."""
    n = F.size(units)
    marked = F.transform(units, lambda u, i: F.struct(u["text"].alias("text"), u["words"].alias("words"), F.coalesce(1 - V.dot(u["vec"], F.get(units, i + 1)["vec"]) >= threshold, F.lit(False)).alias("cut"), F.coalesce(F.get(units, i + 1)["words"], F.lit(0)).alias("next"), (i == n - 1).alias("last")))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.array().cast("array<string>").alias("open"), F.lit(0).alias("words"))

    def step(s: Column, x: Column) -> Column:
        open_, words = F.concat(s["open"], F.array(x["text"])), s["words"] + x["words"]
        ends = (x["cut"] & (words >= target)) | (words + x["next"] > most) | x["last"]
        shut = F.struct(F.concat(s["out"], F.array(F.array_join(open_, " "))).alias("out"), F.array().cast("array<string>").alias("open"), F.lit(0).alias("words"))
        return F.when(ends, shut).otherwise(F.struct(s["out"].alias("out"), open_.alias("open"), words.alias("words")))

    return F.aggregate(marked, start, step, lambda s: s["out"])


def pack_plain(text: Column | str, target: int = 200, most: int = 250) -> Column:
    """Collapsed text up to `most` words (between white space) as one chunk, longer ones as whole sentences up to `target` words: an array of (text, words, kind)."""
    flat = T.collapse_blanks(text)
    units = F.transform(sentences(flat), lambda s: F.struct(s.alias("text"), T.split_count(s).alias("words")))
    return F.when(T.split_count(flat) <= most, F.array(_piece(flat, T.split_count(flat), F.lit("oracion")))).otherwise(pack_all(units, target))


def spans(text: Column, pieces: Column) -> Column:
    """(start, end) of each piece in collapsed text, searched from the end of the one before; a piece that isn't found starts there."""

    def placed(whole: str, found: list[str]) -> list[dict]:
        out, at = [], 0
        for p in found:
            first = whole.find(p, at)
            first = at if first < 0 else first
            at = first + len(p)
            out.append({"start": first, "end": at})
        return out

    return fold(placed, "array<struct<start:int,end:int>>", text, pieces)


def reject_reason(text: Column | str, section: Column | None = None, least: int = 15) -> Column:
    """Why a chunk is dropped: corto, ruido_numerico or ruido_indice, in this order; null if it isn't."""
    return F.when(T.word_count(text) <= least, "corto").when(T.is_numeric_noise(text), "ruido_numerico").when(T.is_toc_noise(text, section), "ruido_indice")


def number_chunks(rows: DataFrame, id: str = "doc_id", order: tuple[str, ...] = ("pos",)) -> DataFrame:
    """Adds posicion, from 0 without gaps within a document, and chunk_id, id-CH-0000."""
    w = Window.partitionBy(id).orderBy(*order)
    numbered = rows.withColumn("posicion", F.row_number().over(w) - 1)
    return numbered.withColumn("chunk_id", F.format_string("%s-CH-%04d", F.col(id).cast("string"), "posicion"))


def token_offsets(chunks: DataFrame, id: str = "doc_id") -> DataFrame:
    """Adds token_start and token_end, running within a document by posicion."""
    w = Window.partitionBy(id).orderBy("posicion").rowsBetween(Window.unboundedPreceding, -1)
    begun = chunks.withColumn("token_start", F.coalesce(F.sum("num_tokens").over(w), F.lit(0)))
    return begun.withColumn("token_end", F.col("token_start") + F.col("num_tokens"))


def sample(docs: DataFrame, n: int, seed: int = 42, id: str = "doc_id") -> DataFrame:
    """n documents, the same for a seed, in order of id."""
    return docs.orderBy(F.xxhash64(F.lit(seed), id), id).limit(n).orderBy(id)


def chunk_report(candidates: DataFrame, text: str = "texto", section: str | None = None, kind: str = "separado_por", id: str = "doc_id", least: int = 15) -> DataFrame:
    """(what, value, n) of chunks before any is dropped: documents, documents without a chunk left, chunks left out by reason, forced splits by kind."""
    judged = candidates.withColumn("_reason", reject_reason(F.col(text), F.col(section) if section else None, least))
    docs = judged.groupBy(id).agg(F.count_if(F.col("_reason").isNull()).alias("kept"))
    totals = docs.agg(F.count(F.lit(1)).alias("documentos"), F.count_if(F.col("kept") == 0).alias("sin_chunks"))
    totals = totals.select(F.inline(F.array(*[F.struct(F.lit("total").alias("what"), F.lit(c).alias("value"), F.col(c).alias("n")) for c in ("documentos", "sin_chunks")])))
    reasons = judged.where("_reason IS NOT NULL").groupBy(F.lit("omitido").alias("what"), F.col("_reason").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    forced = judged.where(F.col("_reason").isNull() & (F.col(kind) != "oracion")).groupBy(F.lit("corte").alias("what"), F.col(kind).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return totals.unionAll(reasons).unionAll(forced)


def alerted_chunks(alerts: DataFrame, id: str = "doc_id", chunk: str = "chunk_id") -> DataFrame:
    """(id, n): how many chunks of each document have an alert; several alerts of a chunk count once, those of no chunk not at all."""
    return alerts.groupBy(id).agg(F.count_distinct(F.nullif(F.col(chunk), F.lit(""))).alias("n"))
