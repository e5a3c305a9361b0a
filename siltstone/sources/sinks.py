"""Writers. Spark's committer makes each atomic: a table is there whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as T


def write_jsonl(rows: DataFrame, path: str, one_file: bool = False) -> None:
    """JSON lines, nulls included; one file only for results that are small."""
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_chunks(chunks: DataFrame, path: str) -> DataFrame:
    """Chunks as JSON lines below path/metadata and a report below path/report: chunks, documents and words of each mode."""
    write_jsonl(chunks, f"{path}/metadata")
    report = chunks.groupBy("chunking_mode").agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("doc_id").alias("documents"), F.sum("num_palabras").alias("words"))
    write_jsonl(report, f"{path}/report", one_file=True)
    return report


def write_texts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", buckets: int = 64) -> None:
    """Texts in buckets of documents, as Parquet: a file for each document would be too many. texts_of reads one."""
    docs.select(id, text, F.pmod(F.xxhash64(id), F.lit(buckets)).alias("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)


def write_vectors(vectors: DataFrame, path: str) -> None:
    """Vectors with their keys, as Parquet."""
    vectors.write.mode("overwrite").parquet(path)


def append_vectors(vectors: DataFrame, path: str) -> None:
    """Adds vectors to those that are there, as a resumed encoding does."""
    vectors.write.mode("append").parquet(path)


def write_graph(vertices: DataFrame, edges: DataFrame, path: str) -> None:
    vertices.write.mode("overwrite").parquet(f"{path}/vertices")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def write_graphml(lines: DataFrame, path: str) -> None:
    """GraphML as one text file, for graphs that other tools read whole."""
    lines.coalesce(1).sortWithinPartitions("part", "line").select("line").write.mode("overwrite").text(path)


def write_evaluation(per_query: DataFrame, path: str, lists: tuple[str, ...] = ()) -> None:
    """An evaluation as CSV with a header, lists joined by bars."""
    joined = per_query.withColumns({c: F.array_join(F.col(c).cast("array<string>"), " | ") for c in lists}) if lists else per_query
    joined.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def quality_report(manifest: DataFrame) -> DataFrame:
    """(estado, n): documents of each state."""
    return manifest.groupBy("estado").agg(F.count(F.lit(1)).alias("n"))


def counters(docs: DataFrame, raw: str, clean: str, id: str = "doc_id") -> DataFrame:
    """(id, characters and words of the raw and the clean text, lines of the clean one)."""
    return docs.select(
        id,
        F.length(raw).alias("caracteres_bruto"),
        F.length(clean).alias("caracteres_limpio"),
        T.split_count(raw).alias("palabras_bruto"),
        T.split_count(clean).alias("palabras_limpio"),
        F.when(F.col(clean) == "", 0).otherwise(F.size(T.lines(clean))).alias("lineas_limpio"),
    )
