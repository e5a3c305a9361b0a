"""Files or raw texts to clean, distinct documents and their chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.operators import dedupe, lines, packing, records, segment, validate
from siltstone.sources import files as S
from siltstone.sources import jsons

RECORD_FORMATS = ("csv", "image", "pbf", "xlsx", "xls")


def documents_from_files(spark: SparkSession, root: str, formats: set[str] | None = None, readers: dict | None = None) -> DataFrame:
    """Raw documents of all files below root: path, fuente, formato, tamano_bytes, text, method, warnings, metadata."""
    found = S.scan(spark, root, formats)
    texts = S.extract(found, readers)
    kept = found.select("path", "formato", F.col("length").alias("tamano_bytes"))
    return kept.join(texts, "path").withColumn("fuente", T.basename("path"))


def clean_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", format: str | None = None, deep: bool = False) -> DataFrame:
    """docs with texto_limpio, idioma, estado, contenido_hash and duplicado_de. deep adds the second cleaning."""
    first = lines.clean(docs, id, text, format).select(id, F.col(text).alias("texto_limpio"))
    if deep:
        second = lines.second_pass(first, id, "texto_limpio").withColumnRenamed("texto_limpio", "_deep")
        first = first.join(second, id).select(id, F.col("_deep").alias("texto_limpio"))
    marked = dedupe.mark_copies(docs.join(first, id), id, "texto_limpio")
    critical = T.one_line_repeated("texto_limpio")
    warnings = F.when(F.coalesce(critical, F.lit(False)), F.array(F.lit("[CRITICO] una sola línea repetida"))).otherwise(F.array().cast("array<string>"))
    state = F.when(F.col("estado") == "excluido_duplicado", F.col("estado")).otherwise(T.document_state(F.col("texto_limpio"), warnings))
    return marked.withColumn("estado", state).withColumn("idioma", T.language("texto_limpio"))


def markdown_chunks(docs: DataFrame, target: int = 200, most: int = 250, overlap: int = 0, least: int = 15, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks of narrative documents: id, posicion, chunk_id, seccion, texto, num_palabras, num_tokens, separado_por. Short chunks, numbers and tables of contents go."""
    validate.check_parameters(target=target, most=most, overlap=overlap)
    arrays = segment.block_arrays(segment.blocks(docs, id, text), id)
    arrays = arrays.select(id, segment.group_paragraphs(segment.drop_adjacent_copies("blocks"), most, least).alias("blocks"))
    each = arrays.select(id, F.posexplode("blocks").alias("b", "x")).select(id, "b", F.col("x.block").alias("block"), F.col("x.section").alias("seccion"))
    if overlap:
        texts = F.when(T.is_table("block"), F.transform(packing.pack_table("block", target, most), lambda p: p["text"])).otherwise(packing.pack_overlapping("block", overlap, target, most))
        pieces = F.transform(texts, lambda t: F.struct(t.alias("text"), T.word_count(t).alias("words"), F.lit("oracion").alias("kind")))
    else:
        pieces = packing.pack_block("block", target, most)
    rows = each.select(id, "seccion", "b", F.posexplode(pieces).alias("n", "p")).select(id, "seccion", "b", "n", F.col("p.text").alias("texto"), F.col("p.words").alias("num_palabras"), F.col("p.kind").alias("separado_por"))
    rows = rows.where(packing.reject_reason(F.col("texto"), F.col("seccion"), least).isNull()).withColumn("num_tokens", T.tokens_up(F.col("num_palabras")))
    return packing.number_chunks(rows, id, ("b", "n")).drop("b", "n").withColumn("chunking_mode", F.lit("standard"))


def plain_chunks(docs: DataFrame, target: int = 200, most: int = 250, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks of plain text, with where each lies: id, posicion, chunk_id, texto, num_palabras, num_tokens, char_start, char_end, token_start, token_end."""
    flat = docs.select(id, T.collapse_blanks(F.coalesce(F.col(text), F.lit(""))).alias("flat")).where("flat <> ''")
    packed = flat.select(id, "flat", packing.pack_plain("flat", target, most).alias("pieces"))
    placed = packed.withColumn("at", packing.spans(F.col("flat"), F.transform("pieces", lambda p: p["text"])))
    rows = placed.select(id, F.posexplode(F.arrays_zip("pieces", "at")).alias("pos", "x")).select(id, "pos", F.col("x.pieces.text").alias("texto"), F.col("x.pieces.words").alias("num_palabras"), F.col("x.at.start").alias("char_start"), F.col("x.at.end").alias("char_end"))
    rows = rows.withColumn("num_tokens", T.tokens_even(F.col("num_palabras")))
    return packing.token_offsets(packing.number_chunks(rows, id).drop("pos"), id).withColumn("chunking_mode", F.lit("late_chunking"))


def json_chunks(docs: DataFrame, excluded: tuple[str, ...] = (), keep_titles: bool = False, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Chunks of "label: value" texts, without labels."""
    return plain_chunks(docs.select(id, jsons.labelled_text(text, excluded, keep_titles).alias("text")), id=id, **options)


def corpus_chunks(docs: DataFrame, format: str = "formato", id: str = "doc_id", text: str = "text") -> DataFrame:
    """The chunks of documents of all formats: JSON by values, tables, images and tiles by records, all others as narrative."""
    kind = F.lower(F.coalesce(F.col(format), F.lit("txt")))
    by_record = kind.isin(*RECORD_FORMATS)
    tables = records.record_chunks(docs.where(by_record), id=id, text=text, format=format).withColumn("chunking_mode", F.lit("structured_record"))
    chunks = dedupe.union_corpora(
        json=json_chunks(docs.where(kind == "json"), id=id, text=text),
        otros=tables,
        pdf=markdown_chunks(docs.where(~by_record & (kind != "json")), id=id, text=text),
    )
    return chunks.join(docs.select(id, format), id)
