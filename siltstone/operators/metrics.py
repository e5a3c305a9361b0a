"""Scores of ranked results against a ground truth, and reports of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_matches(fragments: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, verbatim, gain, pos): at which of the first k fragments (query_id, rank, text) each distinct passage of the ground truth (query_id, verbatim, gain) is first held. pos counts fragments in order of rank."""
    pos = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("rank").asc_nulls_last(), "text"))
    shown = fragments.withColumn("pos", pos).where(F.col("pos") <= k).select("query_id", "pos", "text")
    asked = truth.where("verbatim <> ''").groupBy("query_id", "verbatim").agg(F.max("gain").alias("gain"))
    held = shown.join(asked, "query_id").where(F.contains("text", "verbatim"))
    return held.groupBy("query_id", "verbatim", "gain").agg(F.min("pos").alias("pos"))


def ndcg(fragments: DataFrame, truth: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, ndcg) of every query: a fragment gains the best of the passages that it is the first to hold, discounted by log2(pos + 1); over the k best gains in the best order. No truth or no result: 0."""
    got = first_matches(fragments, truth, k).groupBy("query_id", "pos").agg(F.max("gain").alias("gain"))
    dcg = got.groupBy("query_id").agg(F.sum(F.col("gain") / F.log2(F.col("pos") + F.lit(1.0))).alias("dcg"))
    distinct = truth.where("verbatim <> ''").groupBy("query_id", "verbatim").agg(F.max("gain").alias("gain"))
    best = distinct.withColumn("i", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("gain"), "verbatim"))).where(F.col("i") <= k)
    ideal = best.groupBy("query_id").agg(F.sum(F.col("gain") / F.log2(F.col("i") + F.lit(1.0))).alias("idcg"))
    joined = queries.select("query_id").distinct().join(dcg, "query_id", "left").join(ideal, "query_id", "left")
    return joined.select("query_id", F.coalesce(F.col("dcg") / F.col("idcg"), F.lit(0.0)).alias("ndcg"))


def f1(documents: DataFrame, truth: DataFrame, queries: DataFrame, k: int = 3) -> DataFrame:
    """(query_id, precision, recall, f1) of every query: sources of the first k documents (query_id, rank, source) against those of the ground truth (query_id, source). Precision is over k, recall over min(relevant, k)."""
    predicted = documents.where((F.col("rank") <= k) & F.col("source").isNotNull()).select("query_id", "source").distinct()
    relevant = truth.where("source IS NOT NULL").select("query_id", "source").distinct()
    hits = predicted.join(relevant, ["query_id", "source"]).groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"))
    sizes = relevant.groupBy("query_id").agg(F.count(F.lit(1)).alias("relevant"))
    rows = queries.select("query_id").distinct().join(hits, "query_id", "left").join(sizes, "query_id", "left").na.fill(0, ["hits", "relevant"])
    p = F.col("hits") / F.lit(float(k))
    r = F.when(F.col("relevant") > 0, F.col("hits") / F.least("relevant", F.lit(k))).otherwise(0.0)
    rows = rows.select("query_id", p.alias("precision"), r.alias("recall"))
    total = F.col("precision") + F.col("recall")
    return rows.withColumn("f1", F.when(total > 0, 2 * F.col("precision") * F.col("recall") / total).otherwise(0.0))


def report(per_query: DataFrame, *groups: str) -> DataFrame:
    """(dimension, value, queries, ndcg, f1): means over all queries and over each group of each dimension; null groups are sin_dato. One pass over all groupings."""
    named = per_query.withColumns({g: F.coalesce(F.col(g).cast("string"), F.lit("sin_dato")) for g in groups})
    sets = [[], *[[g] for g in groups]]
    out = named.groupingSets([[F.col(c) for c in s] for s in sets], *map(F.col, groups)).agg(F.count(F.lit(1)).alias("queries"), F.avg("ndcg").alias("ndcg"), F.avg("f1").alias("f1"), *[F.grouping(g).alias(f"_{g}") for g in groups])
    dimension, value = F.lit("total"), F.lit("total")
    for g in groups:
        dimension = F.when(F.col(f"_{g}") == 0, g).otherwise(dimension)
        value = F.when(F.col(f"_{g}") == 0, F.col(g)).otherwise(value)
    return out.select(dimension.alias("dimension"), value.alias("value"), "queries", F.coalesce("ndcg", F.lit(0.0)).alias("ndcg"), F.coalesce("f1", F.lit(0.0)).alias("f1"))


def hit_rate(found: DataFrame, relevant: DataFrame, k: int, key: str, queries: DataFrame) -> DataFrame:
    """One row: the share of queries with a relevant key among their first k."""
    hits = found.where(F.col("rank") <= k).join(relevant.select("query_id", key).distinct(), ["query_id", key]).select("query_id").distinct().withColumn("hit", F.lit(1.0))
    return queries.select("query_id").distinct().join(hits, "query_id", "left").agg(F.coalesce(F.avg(F.coalesce("hit", F.lit(0.0))), F.lit(0.0)).alias("hit_rate"))


def duplicate_rate(found: DataFrame, key: str) -> DataFrame:
    """One row: fragments, and the share of them that repeat another."""
    return found.agg(F.count(F.lit(1)).alias("fragments"), (1 - F.count_distinct(key) / F.count(F.lit(1))).alias("duplicate_rate"))


def incomplete_rate(found: DataFrame, text: str) -> DataFrame:
    """One row: the share of fragments that end no sentence."""
    ends = F.rtrim(text).rlike("[.!?。！？][\"'”’»)\\]]*$")
    return found.agg(F.count(F.lit(1)).alias("fragments"), F.avg((~ends).cast("int")).alias("incomplete_rate"))


def borda(scores: DataFrame, metrics: tuple[str, ...], tie: str, name: str = "config") -> DataFrame:
    """(config, points, rank): on each metric the best of N gets N - 1 points and the last 0; ties in points go by the metric `tie`. A row per competitor, so one task ranks them."""
    every = Window.partitionBy(F.lit(0))
    points = sum((F.count(F.lit(1)).over(every) - F.rank().over(Window.orderBy(F.desc(m))) for m in metrics), F.lit(0))
    scored = scores.withColumn("points", points.cast("long"))
    return scored.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("points"), F.desc(tie), name))).select(name, "points", "rank")


def result_documents(documents: DataFrame, fragments: DataFrame, k: int = 3) -> DataFrame:
    """(query_id, rank, doc_id): the first k documents, or where a query has none the first k distinct ones of its fragments."""
    own = documents.where(F.col("rank") <= k).select("query_id", "rank", "doc_id")
    first = fragments.groupBy("query_id", "doc_id").agg(F.min("rank").alias("_r")).join(documents.select("query_id").distinct(), "query_id", "left_anti")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("_r"))).where(F.col("rank") <= k)
    return own.unionByName(ranked.select("query_id", "rank", "doc_id"))


def sources_of(documents: DataFrame, *maps: DataFrame) -> DataFrame:
    """(query_id, rank, source): every source that one of the maps (doc_id, source) has for a document."""
    every = maps[0].select("doc_id", "source")
    for m in maps[1:]:
        every = every.unionByName(m.select("doc_id", "source"))
    return documents.join(every.where("source IS NOT NULL").distinct(), "doc_id", "left").select("query_id", "rank", "source")


def assemble(documents: DataFrame, fragments: DataFrame, queries: DataFrame) -> DataFrame:
    """One row per query as results are handed out: query_id, query, documents and fragments as arrays in order of rank."""

    def arrays(rows: DataFrame, name: str) -> DataFrame:
        cols = ["rank", *[c for c in rows.columns if c not in ("query_id", "rank")]]
        return rows.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(name))

    out = queries.join(arrays(documents, "documents"), "query_id", "left").join(arrays(fragments, "fragments"), "query_id", "left")
    return out.select("query_id", "query", "documents", "fragments")


def align_results(questions: DataFrame, results: DataFrame, order: str = "line") -> DataFrame:
    """Results of questions (line, query_id) with the questions' ids: by query_id; or, where no id is shared and both have as many rows, by their place. Question sets are some dozens of rows."""
    cols = [c for c in results.columns if c not in ("query_id", order)]
    shared = questions.join(results, "query_id", "left_semi").limit(1).count()
    if shared or questions.count() != results.count():
        return questions.join(results.drop(order), "query_id", "left")
    place = F.row_number().over(Window.orderBy(order))
    return questions.withColumn("_n", place).join(results.withColumn("_n", place).select("_n", *cols), "_n", "left").drop("_n")
