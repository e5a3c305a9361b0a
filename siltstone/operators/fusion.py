"""Fusing ranked lists, reranking and choosing diverse results."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.functions import vectors as V
from siltstone.session import ship


def _lists(lists: list[DataFrame], keys: tuple[str, ...], depth: int | None) -> DataFrame:
    out = None
    for n, rows in enumerate(lists):
        part = rows.select(*keys, "rank", "score").withColumn("list", F.lit(n))
        part = part if depth is None else part.where(F.col("rank") <= depth)
        out = part if out is None else out.unionByName(part)
    return out


def _ranked(fused: DataFrame, by: str, tie: list[str]) -> DataFrame:
    return fused.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), *tie)))


def rrf(lists: list[DataFrame], keys: tuple[str, ...] = ("query_id", "vec_id"), k: int = 60, depth: int | None = 10) -> DataFrame:
    """Reciprocal rank fusion: keys, score, the sum of 1 / (k + rank) over lists cut to `depth`, and rank."""
    fused = _lists(lists, keys, depth).groupBy(*keys).agg(F.sum(1 / (F.lit(float(k)) + F.col("rank"))).alias("score"))
    return _ranked(fused, keys[0], list(keys[1:]))


def comb_sum(lists: list[DataFrame], keys: tuple[str, ...] = ("query_id", "vec_id"), depth: int | None = None) -> DataFrame:
    """Sums of scores; a list that hasn't a row gives it 0."""
    return _ranked(_lists(lists, keys, depth).groupBy(*keys).agg(F.sum("score").alias("score")), keys[0], list(keys[1:]))


def comb_mnz(lists: list[DataFrame], keys: tuple[str, ...] = ("query_id", "vec_id"), depth: int | None = None) -> DataFrame:
    """Sums of scores times the number of lists that give more than 0."""
    fused = _lists(lists, keys, depth).groupBy(*keys).agg((F.sum("score") * F.count_if(F.col("score") > 0)).alias("score"))
    return _ranked(fused, keys[0], list(keys[1:]))


def overlap_score(question: Column, text: Column) -> Column:
    """What a cross-encoder stands for where there is none: the share of the question's words that the text has."""
    asked = F.array_distinct(T.split_words(F.lower(question)))
    return F.when(F.size(asked) == 0, 0.0).otherwise(F.size(F.array_intersect(asked, T.split_words(F.lower(text)))) / F.size(asked))


def rerank(found: DataFrame, score: Column) -> DataFrame:
    """Candidates with recall_rank and recall_score, what they had, and score, what the scorer says. A model is passed as a pandas UDF column."""
    return found.withColumnRenamed("rank", "recall_rank").withColumnRenamed("score", "recall_score").withColumn("score", score)


def _per_query(found: DataFrame, work: Callable, schema: str) -> DataFrame:
    ship(found.sparkSession)
    return found.groupBy("query_id").applyInArrow(work, schema)


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), -1)


def _schema(found: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)


def drop_near(found: DataFrame, threshold: float = 0.9, id: str = "vec_id", vec: str = "embedding", key: str | None = None) -> DataFrame:
    """Candidates of each query without those that repeat a better one: the same id, the same key (of their text), or a cosine of at least the threshold. Better: by score, then recall_rank. One query's pool, some hundred rows, is one group."""

    def work(rows: pa.Table) -> pa.Table:
        order = np.lexsort((rows["recall_rank"].to_numpy(), -rows["score"].to_numpy()))
        v = _vectors(rows[vec])
        names = rows[id].to_pylist()
        keys = rows[key].to_pylist() if key else [None] * len(names)
        kept: list[int] = []
        seen: set = set()
        for i in order.tolist():
            own = {("id", names[i])} | ({("key", keys[i])} if keys[i] else set())
            if own & seen or kept and float((v[kept] @ v[i]).max()) >= threshold:
                continue
            seen |= own
            kept.append(i)
        return rows.take(pa.array(kept, pa.int64()))

    return _per_query(found, work, _schema(found))


def mmr(found: DataFrame, k: int = 10, weight: float = 0.7, vec: str = "embedding") -> DataFrame:
    """The k candidates of each query that maximal marginal relevance picks, ranked in the order of picking.

    Relevance is the score scaled to 0..1 within the query; each pick has the
    largest weight * relevance - (1 - weight) * largest cosine to those picked
    before; ties go by score, then recall_rank.
    """

    def work(rows: pa.Table) -> pa.Table:
        score = rows["score"].to_numpy()
        order = np.lexsort((rows["recall_rank"].to_numpy(), -score))
        rows, score = rows.take(pa.array(order)), score[order]
        spread = score.max() - score.min()
        relevance = np.ones(len(score)) if spread == 0 else (score - score.min()) / spread
        v = _vectors(rows[vec])
        likest = np.zeros(len(score))
        picked: list[int] = []
        open_ = np.ones(len(score), bool)
        while open_.any() and len(picked) < k:
            gain = np.where(open_, weight * relevance - (1 - weight) * likest, -np.inf)
            i = int(gain.argmax())
            picked.append(i)
            open_[i] = False
            now = v @ v[i]
            likest = now if len(picked) == 1 else np.maximum(likest, now)
        out = rows.take(pa.array(picked, pa.int64()))
        return out.append_column("rank", pa.array(range(1, len(picked) + 1), pa.int32()))

    return _per_query(found, work, _schema(found) + ", rank int")


def rescale(found: DataFrame) -> DataFrame:
    """Adds relevance, the score scaled to 0..1 within the query."""
    return found.withColumn("relevance", V.min_max("score", "query_id"))
