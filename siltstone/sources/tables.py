"""Tables to lines of "name: value" pairs."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import text as T


def sniff(source: str) -> tuple[str, bool]:
    """(delimiter, whether it was found) among comma, semicolon, tab and bar, by the first 8192 characters."""
    try:
        return csv.Sniffer().sniff(source[:8192], delimiters=",;\t|").delimiter, True
    except csv.Error:
        return ",", False


def csv_lines(source: str) -> tuple[list[str], dict[str, str]]:
    """A line [fila N] name: value | name: value for each row that isn't blank, the header being row 1; nameless columns are columna_N."""
    delimiter, found = sniff(source)
    rows = list(csv.reader(io.StringIO(source, newline=""), delimiter=delimiter))
    if not rows:
        return [], {"delimitador": delimiter}
    width = max(map(len, rows))
    names = [(rows[0][i].strip() if i < len(rows[0]) else "") or f"columna_{i + 1}" for i in range(width)]
    lines, irregular = [], []
    for n, row in enumerate(rows[1:], 2):
        pairs = [f"{name}: {cell.strip()}" for name, cell in zip(names, row, strict=False) if cell.strip()]
        if pairs:
            lines.append(f"[fila {n}] " + " | ".join(pairs))
            if len(row) != width:
                irregular.append(n)
    metadata = {"delimitador": delimiter, "columnas": ",".join(names), "filas": str(len(lines)), "filas_irregulares": ",".join(map(str, irregular[:20]))}
    return lines, metadata | ({} if found else {"aviso": "delimitador supuesto"})


def csv_reader(content: bytes) -> tuple[str, dict[str, str]]:
    from siltstone.sources.files import decode_any

    source, encoding = decode_any(content)
    lines, metadata = csv_lines(source)
    return "\n".join(lines), {"encoding": encoding} | metadata


def table_lines(table: DataFrame, key: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """(key, line): each row of a DataFrame as pairs, without rows that have none."""
    return table.select(key, T.row_pairs(table.columns, skip).alias("line")).where("line <> ''")


def read_csv(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """A large CSV as a DataFrame of strings, split over tasks."""
    return spark.read.option("header", "true").option("sep", delimiter).option("multiLine", "false").csv(path)
