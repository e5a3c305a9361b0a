"""Questions to ranked documents and fragments: versions two and three, and hybrids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.operators import fusion, search, validate


def _final(picked: DataFrame, doc: str) -> tuple[DataFrame, DataFrame]:
    return search.pool_documents(picked, "mean", doc=doc), picked


def retrieve_v2(vectors: DataFrame, queries: DataFrame, scorer: Column, corpus: DataFrame | None = None, keep: Column | None = None, recall: int = 50, k: int = 10, weight: float = 0.7, doc: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(documents, fragments): the pool is filtered, reranked by scorer, and k fragments are picked for relevance and diversity; documents are the three of the largest mean score. vectors are those of the index; they aren't encoded again."""
    validate.check_parameters(k=k, weight=weight)
    found = _with_vectors(search.candidates(vectors, queries, recall, corpus, keep), vectors)
    return _final(fusion.mmr(fusion.rerank(_with_query(found, queries), scorer).drop("query", "qvec"), k, weight), doc)


def retrieve_v3(vectors: DataFrame, queries: DataFrame, scorer: Column, corpus: DataFrame | None = None, keep: Column | None = None, recall: int = 100, k: int = 10, weight: float = 0.7, near: float = 0.9, doc: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """As retrieve_v2, without candidates that repeat a better one (its id, text, or nearly its vector) before fragments are picked."""
    validate.check_parameters(k=k, weight=weight, near=near)
    found = _with_vectors(search.candidates(vectors, queries, recall, corpus, keep), vectors)
    scored = fusion.rerank(_with_query(found, queries), scorer).drop("query", "qvec")
    key = None
    if "texto" in scored.columns:
        scored, key = scored.withColumn("text_key", T.text_key("texto")), "text_key"
    return _final(fusion.mmr(fusion.drop_near(scored, near, key=key), k, weight), doc)


def _with_vectors(found: DataFrame, vectors: DataFrame) -> DataFrame:
    return found if "embedding" in found.columns else found.join(vectors.select("vec_id", "embedding"), "vec_id")


def _with_query(found: DataFrame, queries: DataFrame) -> DataFrame:
    cols = [c for c in ("query", "qvec") if c in queries.columns]
    return found.join(queries.select("query_id", *cols), "query_id")


def retrieve_hybrid(lists: list[DataFrame], corpus: DataFrame, keys: tuple[str, ...] = ("query_id", "vec_id"), depth: int = 10, k: int = 10, doc: str = "doc_id", how: str = "mean3") -> tuple[DataFrame, DataFrame]:
    """(documents, fragments) of the reciprocal rank fusion of several encoders' fragments, each list cut to `depth`; documents pool all fused fragments, k are shown."""
    fused = fusion.rrf(lists, keys, depth=depth).join(corpus, keys[-1])
    return search.pool_documents(fused, how, doc=doc), fused.where(F.col("rank") <= k)


def widen(fragments: DataFrame, chunks: DataFrame, most: int = 250) -> DataFrame:
    """Fragments with their next neighbour's text added, in the same document, where both have at most `most` words together; the fragment keeps its id."""
    w = Window.partitionBy("doc_id").orderBy("posicion")
    following = chunks.select("chunk_id", F.lead("texto").over(w).alias("_next"))
    out = fragments.join(following, "chunk_id", "left")
    fits = F.col("_next").isNotNull() & (T.split_count("texto") + T.split_count("_next") <= most)
    return out.withColumn("texto", F.when(fits, F.concat("texto", F.lit(" "), F.col("_next"))).otherwise(F.col("texto"))).drop("_next")
