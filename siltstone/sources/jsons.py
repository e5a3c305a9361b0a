"""JSON documents to text, JSON lines, manifests and questions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.functions import text as T
from siltstone.functions import words as W


def pieces(value: object) -> list[tuple[str, str]]:
    """(path, text) of all strings of a JSON value in order, but those under metadata and link keys, blank ones and embedded data. Paths join keys by dots, with [i] for places in arrays."""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, object]] = [("", value)]
    while stack:
        path, v = stack.pop()
        if isinstance(v, dict):
            dropped = (*W.JSON_METADATA_KEYS, *W.JSON_IGNORED_KEYS)
            stack += [(f"{path}.{k}" if path else k, x) for k, x in reversed(v.items()) if k.lower() not in dropped]
        elif isinstance(v, list):
            stack += [(f"{path}[{i}]", x) for i, x in reversed(list(enumerate(v)))]
        elif isinstance(v, str) and v.strip() and not v.strip().lower().startswith(("data:image/", "data:application/")):
            out.append((path, v.strip()))
    return out


def flatten(value: object) -> tuple[list[str], int]:
    """("path: text" lines without those whose text, collapsed and case-folded, came before; how many those were)."""
    first: dict[str, str] = {}
    found = pieces(value)
    for path, text in found:
        first.setdefault(" ".join(text.split()).casefold(), f"{path}: {text}" if path else text)
    return list(first.values()), len(found) - len(first)


def json_reader(content: bytes) -> tuple[str, dict[str, str]]:
    from siltstone.sources.files import decode_any

    source, encoding = decode_any(content)
    value = json.loads(source)
    lines, repeated = flatten(value)
    metadata = {"encoding": encoding, "duplicados_textuales_omitidos": str(repeated)}
    if isinstance(value, dict):
        metadata["campos_metadata"] = ",".join(sorted(k for k in value if k.lower() in W.JSON_METADATA_KEYS))
    return "\n\n".join(lines), metadata


def first_of_each_text(rows: DataFrame, id: str = "doc_id", piece: str = "piece") -> DataFrame:
    """Rows (id, pos, piece) without those whose text came before in the document."""
    w = Window.partitionBy(id, T.text_key(piece)).orderBy("pos")
    return rows.withColumn("_n", F.row_number().over(w)).where((F.col("_n") == 1) | (T.text_key(piece) == "")).drop("_n")


def label_value(line: Column | str) -> Column:
    """(label, value) of a line "label: value"; a null label if it has none."""
    pattern = W.LABEL
    label = F.regexp_extract(T.col(line), pattern, 1)
    return F.struct(F.when(label != "", label).alias("label"), F.when(label != "", F.regexp_extract(T.col(line), pattern, 2)).otherwise(T.col(line)).alias("value"))


def labelled_text(text: Column | str, excluded: tuple[str, ...] = (), keep_titles: bool = False) -> Column:
    """Cleaned "label: value" lines as one text: labels go, but those of alerts, which get their usual name; titles and excluded labels go with their values."""

    def line(x: Column) -> Column:
        pair = label_value(F.trim(x))
        simple = F.element_at(F.split(F.lower(F.regexp_replace(pair["label"], r"\[\d+\]", "")), r"\."), -1)
        value = T.clean_value(pair["value"])
        dropped = F.lit(False) if keep_titles else simple == "title"
        for e in excluded:
            dropped = dropped | simple.contains(e.lower())
        names = F.create_map(*[F.lit(x) for pair_ in W.ALERT_LABELS.items() for x in pair_])
        named = F.when(F.element_at(names, simple).isNotNull(), F.concat(F.element_at(names, simple), F.lit(": "), value)).otherwise(value)
        return F.when(pair["label"].isNull(), value).when(dropped | (value == ""), F.lit("")).otherwise(named)

    lines = F.filter(F.transform(T.lines(T.unix_newlines(text)), line), lambda x: x != "")
    return T.collapse_blanks(F.array_join(lines, " "))


def read_lines(spark: SparkSession, path: str, schema: StructType | str | None = None, strict: bool = True) -> DataFrame:
    """JSON lines; a broken line is an error, or, not strict, a row with _corrupt_record."""
    reader = spark.read.option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return (reader.schema(schema) if schema else reader).json(path)


def read_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines, blank ones skipped; a line that is no object is an error that names its file and line."""
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split(F.regexp_replace("value", "^\ufeff", ""), "\r?\n")).alias("n", "line")).where(F.trim("line") != "")
    bad = ~F.coalesce(F.trim("line").startswith("{") & F.try_parse_json("line").isNotNull(), F.lit(False))
    named = F.concat("file", F.lit(":"), (F.col("n") + 1).cast("string"), F.lit(": no JSON object"))
    checked = F.when(bad, F.raise_error(named).cast("string")).otherwise(F.col("line"))
    return lines.select(F.from_json(checked, schema).alias("r")).select("r.*")


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """An array, an object or JSON lines: lines, if the first that isn't blank is a whole object, else whole files."""
    line = F.trim(F.regexp_replace("value", "^﻿", ""))
    first = spark.read.text(path).select(line.alias("v")).where("v <> ''").limit(1)
    whole = first.select((F.col("v").startswith("{") & F.col("v").endswith("}") & F.try_parse_json("v").isNotNull()).alias("lines")).first()
    return spark.read.option("multiLine", "false" if whole and whole["lines"] else "true").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The records of a manifest: an array, or an object that holds one as documentos, documents, registros or records. An empty table if there is none."""
    raw = spark.read.option("multiLine", "true").option("mode", "PERMISSIVE").json(path)
    for key in ("documentos", "documents", "registros", "records"):
        if key in raw.columns and raw.schema[key].dataType.typeName() == "array":
            return raw.select(F.inline(key))
    return raw


def questions(rows: DataFrame, order: str = "line") -> DataFrame:
    """(query_id, query) of rows (line, query_id, query): missing ids are q001 and so on by place. A question without text is an error."""
    n = F.row_number().over(Window.orderBy(order))
    checked = F.when(F.coalesce(T.collapse_blanks("query"), F.lit("")) == "", F.raise_error(F.lit("a question has no text"))).otherwise(F.col("query"))
    return rows.select(F.coalesce(F.col("query_id").cast("string"), F.format_string("q%03d", n)).alias("query_id"), checked.alias("query"))


def read_optional(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines, or an empty table where there is no file."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    return read_lines(spark, path, schema) if there else spark.createDataFrame([], schema)
