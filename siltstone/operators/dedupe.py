"""Exact copies, repeated records and manifests that take the place of others.

Keys are hashes of whole texts, and keepers are found by minima, which are
aggregated before they are shuffled; a text that very many documents share
costs a row for each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import text as T


def mark_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds contenido_hash, duplicado_de (the smallest id of the same text, null for that one itself) and estado (procesado, excluido_duplicado). Blank texts are no copies of each other."""
    hashed = docs.withColumn("contenido_hash", T.content_hash(F.coalesce(F.col(text), F.lit(""))))
    keepers = hashed.where("contenido_hash <> ''").groupBy("contenido_hash").agg(F.min(id).alias("_keeper"))
    copy = F.when(F.col("_keeper") != F.col(id), F.col("_keeper"))
    return hashed.join(keepers, "contenido_hash", "left").withColumn("duplicado_de", copy).withColumn("estado", F.when(copy.isNotNull(), "excluido_duplicado").otherwise("procesado")).drop("_keeper")


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without rows whose text an earlier id has."""
    return mark_copies(docs, id, text).where("duplicado_de IS NULL").select(*docs.columns)


def drop_repeated_entities(rows: DataFrame, line: str = "line", order: tuple[str, ...] = ("doc_id", "pos")) -> DataFrame:
    """Rows of tiles without those whose entity an earlier row has."""
    keyed = rows.withColumn("entity_key", T.entity_key(line))
    first = keyed.groupBy("entity_key").agg(F.min(F.struct(*order)).alias("_first"))
    return keyed.join(first, "entity_key").where(F.struct(*order) == F.col("_first")).drop("_first")


def consolidate(rows: DataFrame, context: str, line: str = "line", order: tuple[str, ...] = ("doc_id", "pos")) -> DataFrame:
    """One document for each context: the first one's keys, and the lines of all in order."""
    body = F.sort_array(F.collect_list(F.struct(*order, line)))
    return rows.groupBy(context).agg(F.min(F.struct(*order)).getField(order[0]).alias(order[0]), F.array_join(F.transform(body, lambda r: r[line]), "\n").alias("text"), F.count(F.lit(1)).alias("n_lines"))


def last_wins(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """The union of two manifests; of a key the row of the new one. Rows of one manifest should not share a key."""
    gone = old.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return gone.unionByName(new, allowMissingColumns=True)


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of each key the row of the largest order."""
    cols = F.struct(order, *[c for c in rows.columns if c != order])
    return rows.groupBy(*keys).agg(F.max(cols).alias("_last")).select("_last.*").select(*rows.columns)


def pending(wanted: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """What is wanted and not yet done."""
    return wanted.join(done.select(*keys).distinct(), list(keys), "left_anti")


def complete_shards(shards: DataFrame, originals: DataFrame, key: str = "doc_id") -> DataFrame:
    """Merged shards, and the processed originals that no shard has."""
    missing = pending(originals.where(F.col("estado").startswith("procesado")), shards, key)
    return shards.unionByName(missing, allowMissingColumns=True)


def union_corpora(**parts: DataFrame) -> DataFrame:
    """The union of chunk tables by name, with fuente_corpus, and orden_* to sort by: number of the document, document, number of the chunk, json before otros before pdf, chunk. Nothing is dropped."""
    rank = {"json": 0, "otros": 1, "pdf": 2}
    out = None
    for name, part in parts.items():
        own = part.withColumns({"fuente_corpus": F.lit(name), "orden_fuente": F.lit(rank.get(name, len(rank)))})
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out.withColumns({"orden_doc": T.numeric_tail(F.col("doc_id").cast("string")), "orden_chunk": T.numeric_tail("chunk_id")})


CORPUS_ORDER = ("orden_doc", "doc_id", "orden_chunk", "orden_fuente", "chunk_id")


def fingerprint(rows: DataFrame) -> DataFrame:
    """One row: how many rows, and a sum of their hashes, which no order of rows changes."""
    each = F.xxhash64(*[F.col(c) for c in rows.columns]).cast("decimal(38,0)")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(each).alias("fingerprint"))


def ordered_fingerprint(rows: DataFrame, order: str, record: Column | None = None, per_slice: int = 1 << 16) -> DataFrame:
    """One row: n_rows and fingerprint, a SHA-256 over all records in order, which any change of a record or of their order changes.

    record is a row's text, by default its JSON with sorted keys. Records are
    hashed, their hashes by slices of `per_slice` of the long column `order`,
    the slices' hashes in order; rows of equal order count by their hash. An
    empty table has the hash of the empty text.
    """
    text = F.to_json(F.struct(*sorted(rows.columns))) if record is None else record
    hashed = rows.select(F.floor(F.col(order) / per_slice).alias("_slice"), F.struct(F.col(order).alias("o"), F.sha2(text, 256).alias("h")).alias("_row"))

    def whole(c: Column) -> Column:
        return F.sha2(F.array_join(F.transform(F.sort_array(c), lambda x: x["h"]), ""), 256)

    slices = hashed.groupBy("_slice").agg(F.count(F.lit(1)).alias("n"), whole(F.collect_list("_row")).alias("h"))
    return slices.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), whole(F.collect_list(F.struct(F.col("_slice").alias("o"), "h"))).alias("fingerprint"))


def number_documents(files: DataFrame, group: str, path: str = "path", per_slice: int = 100_000) -> DataFrame:
    """Adds doc_id, DOC-000001 and so on, by group and path: numbers go on from one group to the next.

    Paths are dealt to ranges by a sort of the whole table, so a group of very
    many files is numbered by many tasks; a range is numbered by itself and
    goes on where those before it end. Only the table of ranges is seen by one
    task.
    """
    n = 1 + files.count() // per_slice
    bounds = files.select(F.struct(group, path).alias("k")).repartitionByRange(n, "k").groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("k")).orderBy("k").collect()
    keys = [(r["k"][0], r["k"][1]) for r in bounds][1:]
    if not keys:
        ranged = files.withColumn("_range", F.lit(0))
    else:
        cuts = F.array(*(F.struct(F.lit(a).alias(group), F.lit(b).alias(path)) for a, b in keys))
        ranged = files.withColumn("_range", F.aggregate(cuts, F.lit(0), lambda m, c: m + (F.struct(group, path) >= c).cast("int")))
    start = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    start = start.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(group, path))
    return ranged.withColumn("_own", own).join(start, "_range").withColumn("doc_id", F.format_string("DOC-%06d", F.col("_start") + F.col("_own"))).drop("_own", "_start", "_range")
