"""Streams of documents and events.

Documents are cleaned and hashed as they arrive; copies are dropped against
those of the watermark's span, whose hashes are the only state. A checkpoint
makes each run go on where the last one ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.functions import text as T
from siltstone.operators import lines, packing


def read_documents(spark: SparkSession, path: str, schema: str, files_per_batch: int = 64, format: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(format).load(path)


def distinct_documents(docs: DataFrame, time: str, delay: str = "1 hour", text: str = "text") -> DataFrame:
    """docs with contenido_hash, each text once within the watermark; blank texts all stay distinct by their time and id."""
    hashed = docs.withColumn("contenido_hash", T.content_hash(text)).withWatermark(time, delay)
    return hashed.dropDuplicatesWithinWatermark(["contenido_hash"])


def chunk_stream(docs: DataFrame, target: int = 200, most: int = 250, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks of plain text without state: each row's text is packed by itself."""
    tidy = docs.select(id, lines.tidy(T.unix_newlines(text)).alias("_t"))
    rows = tidy.select(id, F.posexplode(packing.pack_plain("_t", target, most)).alias("posicion", "p"))
    return rows.select(id, "posicion", F.format_string("%s-CH-%04d", F.col(id).cast("string"), "posicion").alias("chunk_id"), F.col("p.text").alias("texto"), F.col("p.words").alias("num_palabras"))


def write(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends to Parquet; once: what is there now, then it ends."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def event_windows(events: DataFrame, size: str = "1 hour", slide: str | None = None, delay: str = "10 minutes", time: str = "ts", by: str = "event_type") -> DataFrame:
    """(start, end, by, n, total): counts and sums over tumbling windows, or sliding ones; rows later than the watermark are left out of a stream."""
    marked = events.withWatermark(time, delay) if events.isStreaming else events
    window = F.window(time, size, slide) if slide else F.window(time, size)
    out = marked.groupBy(window.alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes", time: str = "ts", by: str = "user_id") -> DataFrame:
    """(by, start, end, n): sessions that a gap without events ends."""
    marked = events.withWatermark(time, delay) if events.isStreaming else events
    out = marked.groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
