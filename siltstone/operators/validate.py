"""Checks that return what is wrong, as rows, and parameters that must hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import text as T

CHUNK_FIELDS = ("doc_id", "chunk_id", "fuente", "formato", "fenomeno", "posicion", "num_tokens", "texto")
QUESTION_FIELDS = ("query_id", "fenomeno", "idioma", "pregunta", "respuesta_esperada", "fuente_tipo", "fuente_referencia")


def _problems(rows: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    each = F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in checks.items()])
    return rows.select(F.col(key).cast("string").alias("key"), F.explode(F.array_compact(each)).alias("problem"))


def chunk_problems(chunks: DataFrame, fields: tuple[str, ...] = CHUNK_FIELDS) -> DataFrame:
    """(key, problem): required fields that a chunk hasn't, and blank texts. Columns that are missing altogether count for each row."""
    checks = {f"falta {f}": F.col(f).isNull() if f in chunks.columns else F.lit(True) for f in fields}
    if "texto" in chunks.columns:
        checks["texto vacío"] = F.col("texto").isNotNull() & (T.collapse_blanks("texto") == "")
    return _problems(chunks, "chunk_id", checks)


def graph_problems(chunks: DataFrame) -> DataFrame:
    """(key, problem): chunks that a graph can't be built of: blank ids or texts, a chunk_id that doesn't start with its doc_id, repeated chunk_ids, a fenomeno that isn't 1, 2 or 3."""
    n = F.count(F.lit(1)).over(Window.partitionBy("chunk_id"))
    rows = chunks.withColumn("_n", n)
    return _problems(
        rows,
        "chunk_id",
        {
            "id vacío": (T.attribute("doc_id") == "") | (T.attribute("chunk_id") == ""),
            "chunk_id no trazable": ~F.col("chunk_id").startswith(F.concat(F.col("doc_id"), F.lit("-"))),
            "chunk_id duplicado": F.col("_n") > 1,
            "texto vacío": F.coalesce(T.collapse_blanks("texto"), F.lit("")) == "",
            "fenomeno inválido": ~F.col("fenomeno").cast("string").isin("1", "2", "3"),
        },
    )


def question_problems(questions: DataFrame, ids: list[str], distribution: dict[int, int], languages: tuple[str, ...] = ("es", "en", "pt"), formats: tuple[str, ...] = ("pdf", "json", "csv", "xlsx", "txt", "pbf", "image"), order: str = "line") -> DataFrame:
    """(key, problem) of a question set: missing fields, unknown values, repeated ids, another number or order of ids, another distribution over fenomeno. A set is some dozens of rows."""
    fields = {f"falta {f}": F.col(f).isNull() for f in QUESTION_FIELDS}
    rows = questions.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("query_id"))).withColumn("_i", F.row_number().over(Window.orderBy(order)))
    wanted = F.get(F.array(*map(F.lit, ids)), F.col("_i") - 1)
    each = _problems(
        rows,
        "query_id",
        fields
        | {
            "fenómeno inválido": ~F.col("fenomeno").isin(*distribution),
            "idioma inválido": ~F.col("idioma").isin(*languages),
            "formato inválido": ~F.col("fuente_tipo").isin(*formats),
            "query_id duplicado": F.col("_n") > 1,
            "fuera de orden": ~wanted.eqNullSafe(F.col("query_id")),
        },
    )
    spark = questions.sparkSession
    expected = spark.createDataFrame(list(distribution.items()), "fenomeno int, expected long")
    counts = questions.groupBy(F.col("fenomeno").cast("int").alias("fenomeno")).agg(F.count(F.lit(1)).alias("n"))
    off = expected.join(counts, "fenomeno", "full").where(~F.coalesce("n", F.lit(0)).eqNullSafe(F.coalesce("expected", F.lit(0))))
    total = questions.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != len(ids))
    return each.unionAll(off.select(F.col("fenomeno").cast("string"), F.lit("distribución distinta"))).unionAll(total.select(F.col("n").cast("string"), F.lit("número de preguntas distinto")))


def result_problems(results: DataFrame) -> DataFrame:
    """(key, problem): results without a query_id, documents or fragments."""
    return _problems(results, "query_id", {"sin query_id": F.col("query_id").isNull(), "sin documents": F.col("documents").isNull(), "sin fragments": F.col("fragments").isNull()})


def require(problems: DataFrame, shown: int = 5) -> None:
    """Raises ValueError with the first problems, if there are any."""
    found = problems.limit(shown).collect()
    if found:
        raise ValueError("; ".join(f"{r['key']}: {r['problem']}" for r in found))


def check_parameters(k: int = 1, weight: float = 0.7, near: float = 0.9, target: int = 200, most: int = 250, mode: str = "standard", overlap: int = 0) -> None:
    """Raises ValueError for parameters out of range."""
    rules = [
        (k >= 1, "k must be at least 1"),
        (0 <= weight <= 1, "weight must be between 0 and 1"),
        (0 <= near <= 1, "near must be between 0 and 1"),
        (1 <= target <= most <= 250, "1 <= target <= most <= 250 must hold"),
        (mode in ("standard", "late_chunking", "semantic"), "unknown mode"),
        (mode != "semantic" or overlap == 0, "semantic chunks don't overlap"),
        (overlap >= 0, "overlap must not be negative"),
    ]
    for ok, message in rules:
        if not ok:
            raise ValueError(message)
