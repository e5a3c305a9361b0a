"""Results of one or many configurations against a ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.operators import metrics


def truth_tables(truth: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passages: query_id, verbatim, gain; sources: query_id, source) of a nested ground truth. Relevance may be called relevancia or relevance."""
    fragments = truth.select("query_id", F.explode("ground_truth.fragmentos_relevantes").alias("f"))
    names = fragments.schema["f"].dataType.fieldNames()
    label = F.coalesce(*[F.col(f"f.{n}") for n in ("relevancia", "relevance") if n in names], F.lit(""))
    passages = fragments.select("query_id", F.col("f.texto_verbatim").alias("verbatim"), T.relevance_gain(label).alias("gain")).where("verbatim <> ''")
    sources = truth.select("query_id", F.explode("ground_truth.documentos_relevantes").alias("d")).select("query_id", F.col("d.fuente").alias("source"))
    return passages, sources


def evaluate(fragments: DataFrame, documents: DataFrame, passages: DataFrame, sources: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id and all that queries has, ndcg, precision, recall, f1). A query without a result scores 0 and counts. fragments: query_id, rank, text; documents: query_id, rank, source."""
    a = metrics.ndcg(fragments, passages, queries)
    b = metrics.f1(documents, sources, queries)
    return queries.join(a, "query_id").join(b, "query_id")


def evaluate_all(fragments: DataFrame, documents: DataFrame, passages: DataFrame, sources: DataFrame, queries: DataFrame, config: str = "config") -> DataFrame:
    """As evaluate, for results of many configurations in one plan: keys become (config, query_id)."""
    configs = fragments.select(config).union(documents.select(config)).distinct()

    def keyed(rows: DataFrame, own: bool) -> DataFrame:
        all_ = rows if own else rows.crossJoin(F.broadcast(configs))
        return all_.withColumn("_q", F.col("query_id")).withColumn("query_id", F.concat_ws("\x1f", config, "query_id"))

    scored = evaluate(keyed(fragments, True), keyed(documents, True), keyed(passages, False), keyed(sources, False), keyed(queries, False))
    return scored.withColumn("query_id", F.col("_q")).drop("_q")


def compare(per_query: DataFrame, config: str = "config") -> DataFrame:
    """(config, ndcg, f1, points, rank): mean scores of configurations and their Borda ranking, ties by ndcg."""
    means = per_query.groupBy(config).agg(F.avg("ndcg").alias("ndcg"), F.avg("f1").alias("f1"))
    return means.join(metrics.borda(means, ("ndcg", "f1"), "ndcg", config), config)
