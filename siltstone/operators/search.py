"""Vector search, filters, and the three ways to retrieve.

Candidates are rows (query_id, rank, vec_id, score, and what the corpus has).
Filters come after the search, as the pool's size is fixed first; pre_filter
gives the other order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from siltstone.functions import text as T
from siltstone.functions import vectors as V
from siltstone.session import shared_batches, ship, write_shared

#: Queries that one pass over the corpus compares, as one matrix.
QUERY_BLOCK = 2048
#: Pairs of a query and a chunk that a task of graph_candidates scores at once, and ranks of each query that it hands on at once.
PAIRS, RANKED = 1 << 25, 1 << 10


def best(rows: DataFrame, k: int, by: tuple[str, ...] = ("query_id",), score: str = "score", tie: str = "vec_id", rank: str = "rank") -> DataFrame:
    """The k rows of the largest score of each group, ranked from 1."""
    w = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return rows.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int, vec: str = "embedding", other: bool = True) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query (query_id, qvec), all vectors compared.

    Queries are read in blocks of QUERY_BLOCK, each a broadcast of known size;
    every task multiplies its vectors with a block and hands on its own k best,
    so what is shuffled is k rows a query and task. other leaves out vectors
    whose id is the query's.
    """
    spark = vectors.sparkSession
    ship(spark)
    schema = "query_id long, vec_id long, score double"
    out = None
    base = vectors.where(F.col(vec).isNotNull()).select(F.col("vec_id").cast("long"), F.col(vec).cast("array<double>").alias("v"))
    asked = queries.where("qvec IS NOT NULL").select(F.col("query_id").cast("long"), F.col("qvec").cast("array<double>"))
    n = asked.count()
    blocks = max(1, -(-n // QUERY_BLOCK))
    for block in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).orderBy("query_id").toArrow()
        ids = some["query_id"].to_numpy()
        matrix = some["qvec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1) if len(ids) else np.zeros((0, 1))

        def scan(batches, ids=ids, matrix=matrix):
            held: tuple[np.ndarray, np.ndarray] | None = None
            for b in batches:
                if not b.num_rows or not len(ids):
                    continue
                own = b["vec_id"].to_numpy(zero_copy_only=False)
                v = b["v"].flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1)
                score = matrix @ v.T
                if other:
                    score[ids[:, None] == own[None]] = -np.inf
                which = np.broadcast_to(own, score.shape)
                if held:
                    which, score = np.concatenate([held[0], which], axis=1), np.concatenate([held[1], score], axis=1)
                order = np.lexsort((which, -score), axis=1)[:, :k]
                held = np.take_along_axis(which, order, axis=1), np.take_along_axis(score, order, axis=1)
            if held:
                ok = np.isfinite(held[1])
                yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(ids[:, None], ok.shape)[ok]), pa.array(held[0][ok]), pa.array(held[1][ok])], names=["query_id", "vec_id", "score"])

        part = base.mapInArrow(scan, schema)
        out = part if out is None else out.union(part)
    return best(out, k).select("query_id", "rank", "vec_id", "score")


def allowed(threshold: float = -1.0, fenomeno: object = None, idioma: str | None = None, formato: str | None = None, score: str = "score") -> Column:
    """The condition of the metadata filters: a least score, fenomeno by its text, idioma and formato whatever their case."""
    out = F.col(score) >= threshold
    if fenomeno is not None:
        out = out & (F.col("fenomeno").cast("string") == str(fenomeno))
    if idioma:
        out = out & (F.lower(F.coalesce("idioma", F.lit(""))) == idioma.lower())
    if formato:
        out = out & (F.lower(F.coalesce("formato", F.lit(""))) == formato.lower())
    return out


def candidates(vectors: DataFrame, queries: DataFrame, k: int, corpus: DataFrame | None = None, keep: Column | None = None, pre_filter: Column | None = None, vec: str = "embedding") -> DataFrame:
    """The k nearest of each query with what the corpus has of them, then those that keep allows; ranks keep their gaps."""
    pool = vectors if pre_filter is None else vectors.where(pre_filter)
    found = exact_topk(pool, queries, k, vec)
    if corpus is not None:
        found = found.join(corpus, "vec_id")
    return found if keep is None else found.where(keep)


def pool_documents(found: DataFrame, how: str = "mean3", k: int = 3, doc: str = "doc_id", by: str = "query_id") -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents by the mean of their three best chunks (mean3), or the sum, mean or max of all. Ties go to the document of the better first rank."""
    n = F.row_number().over(Window.partitionBy(by, doc).orderBy(F.desc("score"), "rank"))
    scored = {"mean3": F.avg(F.when(F.col("_n") <= 3, F.col("score"))), "sum": F.sum("score"), "mean": F.avg("score"), "max": F.max("score")}[how]
    docs = found.withColumn("_n", n).groupBy(by, doc).agg(scored.alias("score"), F.min("rank").alias("_first"))
    w = Window.partitionBy(by).orderBy(F.desc("score"), "_first", doc)
    return docs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(by, "rank", doc, "score")


def retrieve_base(vectors: DataFrame, queries: DataFrame, corpus: DataFrame | None = None, keep: Column | None = None, pool: int = 20, fragments: int = 10, doc: str = "doc_id", how: str = "mean3") -> tuple[DataFrame, DataFrame]:
    """(documents, fragments) of the base search: a pool of at least `fragments`, documents over all of it, the first fragments of it, their texts cut to 250 words."""
    found = candidates(vectors, queries, max(pool, fragments), corpus, keep)
    dense = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank")))
    shown = dense.where(F.col("rank") <= fragments)
    if "texto" in shown.columns:
        shown = shown.withColumn("texto", T.truncate_words("texto"))
    return pool_documents(dense, how, doc=doc), shown


def retrieve_v1(vectors: DataFrame, queries: DataFrame, corpus: DataFrame | None = None, keep: Column | None = None, k: int = 20, doc: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(documents, fragments) of the first version: ranks are those of the search, with gaps where filters took rows; documents are the first three, with their best score."""
    found = candidates(vectors, queries, k, corpus, keep)
    docs = found.groupBy("query_id", doc).agg(F.min("rank").alias("_first"), F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy("_first")
    docs = docs.withColumn("rank", F.row_number().over(w)).where("rank <= 3").select("query_id", "rank", doc, "score")
    return docs, found


def near_pairs(vectors: DataFrame, threshold: float = 0.9, by: str = "query_id", id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(by, a, b, similarity) of vectors of a group with cosine at least the threshold, a before b. A group is a query's pool, of bounded size."""
    left = vectors.select(by, F.col(id).alias("a"), F.col(vec).alias("va"))
    right = vectors.select(by, F.col(id).alias("b"), F.col(vec).alias("vb"))
    pairs = left.join(right, by).where("a < b")
    return pairs.withColumn("similarity", V.dot("va", "vb")).where(F.col("similarity") >= threshold).drop("va", "vb")


def adjacent_similarity(vectors: DataFrame, by: str, order: str, vec: str = "embedding", per_slice: int = 4096) -> DataFrame:
    """Adds similarity, the inner product with the next vector of the group, by the long column `order`.

    A group is cut into slices of `order`, and the first vector of each slice
    goes to the slice before as well, so a group of very many vectors is no
    one task's.
    """
    sliced = vectors.withColumns({"_slice": F.floor(F.col(order) / per_slice), "_carried": F.lit(False)})
    heads = sliced.groupBy(by, "_slice").agg(F.min_by(vec, order).alias(vec))
    before = Window.partitionBy(by).orderBy("_slice")
    heads = heads.withColumn("_to", F.lag("_slice").over(before)).where("_to IS NOT NULL").select(by, F.col("_to").alias("_slice"), F.lit(True).alias("_carried"), F.col(vec))
    w = Window.partitionBy(by, "_slice").orderBy("_carried", order)
    both = sliced.unionByName(heads, allowMissingColumns=True)
    return both.withColumn("similarity", V.dot(vec, F.lead(vec).over(w))).where("NOT _carried").drop("_slice", "_carried")


def _hashed(values: DataFrame, name: str) -> tuple[str, int]:
    """The path of the distinct values (v) with a hash (h) each, and the hash's seed, one by which no two are equal."""
    values, seed = values.distinct(), 0
    while True:
        path = write_shared(values.withColumn("h", F.xxhash64(F.lit(seed), "v")), name)
        back = values.sparkSession.read.parquet(path)
        if back.count() == back.select("h").distinct().count():
            return path, seed
        seed += 1


def _column(path: str, name: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(b[name].to_numpy() for b in shared_batches(path, [name]))])


def graph_candidates(mentions: DataFrame, edges: DataFrame, asked: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """(query_id, chunk_id, score, rank): chunks that mention the entities of a query (query_id, entity) or those one edge away, scored by how many such mentions they have.

    Nearly every chunk is a candidate of every query, so no candidate is
    shuffled: entities and chunks get numbers, mentions and distinct edges are
    written to the shared folder as numbers, and a task reads them for some
    queries at a time, a bit of a word each, as many as PAIRS candidates allow,
    and ranks what it finds. It hands on the first RANKED ranks of each of
    these queries, then the next: ranks come again and again, and so do the
    chunks that many queries rank alike, so a columnar file has them as
    repeats and references instead of as values.
    """
    spark = mentions.sparkSession
    ship(spark)
    mentions, edges, asked = mentions.where("entity IS NOT NULL"), edges.where("src IS NOT NULL AND dst IS NOT NULL"), asked.where("entity IS NOT NULL").select("query_id", "entity")
    names = [mentions.select(F.col("entity").alias("v")), asked.select(F.col("entity").alias("v")), edges.select(F.explode(F.array("src", "dst")).alias("v"))]
    entities, entity_seed = _hashed(names[0].union(names[1]).union(names[2]), "entities")
    chunks, chunk_seed = _hashed(mentions.select(F.col(chunk).alias("v")), "chunks")

    def numbered(df, *columns):
        """Hashes of entities as their numbers; hashes of chunks as their places in their order."""

        def work(batches):
            known = np.sort(_column(entities, "h"))
            if "chunk" in columns:
                h = _column(chunks, "h")
                order = np.argsort(h)
                h, place = h[order], np.argsort(_ordered(chunks)[1])[order]
            for b in batches:
                own = {c: b[c].to_numpy() for c in columns}
                yield pa.RecordBatch.from_arrays([pa.array((place[np.searchsorted(h, x)] if c == "chunk" else np.searchsorted(known, x)).astype(np.int32)) for c, x in own.items()], names=list(columns))

        return df.mapInArrow(work, ", ".join(f"{c} int" for c in columns))

    def key(c, seed):
        return F.xxhash64(F.lit(seed), c)

    places = write_shared(numbered(mentions.select(key(chunk, chunk_seed).alias("chunk"), key("entity", entity_seed).alias("entity")), "chunk", "entity"), "mentions")
    ends = numbered(edges.select(key("src", entity_seed).alias("a"), key("dst", entity_seed).alias("b")), "a", "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = ends.select(F.inline(F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")), F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))))
    links = write_shared(both.sortWithinPartitions("dst"), "edges")
    size, total = spark.read.parquet(entities).count(), spark.read.parquet(chunks).count()
    width = max(1, min(64, PAIRS // max(1, total)))
    queries = asked.select("query_id").distinct().count()

    def score(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        coded = rows["query_id"].combine_chunks().dictionary_encode(null_encoding="encode")
        own, entity = coded.indices.to_numpy(), np.searchsorted(np.sort(_column(entities, "h")), rows["h"].to_numpy())
        labels = _ordered(chunks)[0]
        for first in range(0, len(coded.dictionary), width):
            some = (own >= first) & (own < first + width)
            seen = np.zeros(size, np.uint64)
            np.bitwise_or.at(seen, entity[some], np.uint64(1) << (own[some] - first).astype(np.uint64))
            wanted = seen.copy()
            for b in shared_batches(links, ["src", "dst"]):
                bits = seen[b["src"].to_numpy()]
                at = np.flatnonzero(bits)
                if len(at):
                    dst = b["dst"].to_numpy()[at]
                    new = np.flatnonzero(np.append(True, dst[1:] != dst[:-1]))
                    np.bitwise_or.at(wanted, dst[new], np.bitwise_or.reduceat(bits[at], new))
            found = np.zeros((len(labels), width), np.uint32)
            for b in shared_batches(places, ["chunk", "entity"]):
                bits, c = wanted[b["entity"].to_numpy()], b["chunk"].to_numpy()
                new = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
                several = np.unpackbits(bits.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, count=width, bitorder="little")
                sums, c = np.add.reduceat(several, new, axis=0, dtype=np.uint32), c[new]
                if len(np.unique(c)) == len(c):
                    found[c] += sums
                else:
                    np.add.at(found, c, sums)
            best = []
            for k in range(min(width, len(coded.dictionary) - first)):
                scores = found[:, k]
                at = np.flatnonzero(scores)
                best.append(at[np.argsort(scores.max(initial=0) - scores[at], kind="stable")].astype(np.int32))
            for x in range(0, max(map(len, best)), RANKED):
                parts = [at[x : x + RANKED] for at in best]
                sizes = [len(part) for part in parts]
                at, k = np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes)
                ranks = np.concatenate([np.arange(x + 1, x + n + 1, dtype=np.int32) for n in sizes])
                yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(first + k)), labels.take(pa.array(at)), pa.array(found[at, k].astype(float)), pa.array(ranks)], names=["query_id", chunk, "score", "rank"])

    schema = StructType([asked.schema["query_id"], mentions.schema[chunk], StructField("score", DoubleType()), StructField("rank", IntegerType())])
    return asked.select("query_id", key("entity", entity_seed).alias("h")).repartition(max(1, -(-queries * 4 // (3 * width))), "query_id").mapInArrow(score, schema)


def _ordered(chunks: str) -> tuple[pa.Array, np.ndarray]:
    """The values of a table of _hashed in their order, null first, and where in it each is."""
    values = pa.concat_arrays([b["v"] for b in shared_batches(chunks, ["v"])] or [pa.array([], pa.string())])
    order = pc.sort_indices(values, null_placement="at_start")
    return values.take(order), order.to_numpy()


def bm25(docs: DataFrame, queries: DataFrame, k: int = 10, k1: float = 1.2, b: float = 0.75, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(query_id, rank, doc_id, score): lexical search. Terms are words between white space, lower-cased. Only postings of the queries' terms are shuffled. Scores are rounded to 9 digits, so that copies tie and go by id."""
    asked = queries.select("query_id", F.explode(F.array_distinct(T.split_words(F.lower("query")))).alias("term"))
    sized = docs.select(id, T.split_words(F.lower(text)).alias("words")).withColumn("len", F.size("words"))
    totals = sized.agg(F.count(F.lit(1)).alias("n"), F.avg("len").alias("mean")).first()
    terms = F.broadcast(asked.select("term").distinct()) if asked.count() <= 100_000 else asked.select("term").distinct()
    postings = sized.select(id, "len", F.explode("words").alias("term")).join(terms, "term").groupBy(id, "len", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.lit(totals["n"]) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    gain = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.lit(totals["mean"] or 1.0)))
    scored = asked.join(postings.join(df, "term"), "term").groupBy("query_id", id).agg(F.round(F.sum(gain), 9).alias("score"))
    return best(scored, k, tie=id).select("query_id", "rank", id, "score")


def fit_lists(vectors: DataFrame, lists: int, sample: int = 20_000, rounds: int = 10, seed: int = 42, id: str = "vec_id", vec: str = "embedding") -> list[list[float]]:
    """Centres of lists by spherical k-means on at most `sample` vectors, the first in a seeded order of id; the driver sees those."""
    found = vectors.where(F.col(vec).isNotNull()).orderBy(F.xxhash64(F.lit(seed), id), id).limit(sample).select(F.col(vec).cast("array<double>").alias("v")).toArrow()
    if not found.num_rows:
        return []
    v = found["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(found.num_rows, -1)
    draw = np.random.default_rng(seed)
    centres = v[draw.choice(len(v), min(lists, len(v)), replace=False)]
    for _ in range(rounds):
        own = (v @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, v)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.maximum(norm, 1e-300), centres)
    return centres.tolist()


def assign_lists(vectors: DataFrame, centres: list[list[float]], vec: str = "embedding") -> DataFrame:
    """Adds list, the number of the centre of the largest inner product; the centres are a bounded parameter."""
    scores = F.transform(F.array(*[F.array(*map(F.lit, c)) for c in centres]), lambda c: V.dot(vec, c))
    return vectors.withColumn("list", F.array_position(scores, F.array_max(scores)).cast("int") - 1)


def ivf_topk(vectors: DataFrame, queries: DataFrame, centres: list[list[float]], k: int, probes: int, vec: str = "embedding") -> DataFrame:
    """As exact_topk, over the lists of the centres nearest to each query."""
    listed = assign_lists(vectors, centres, vec)
    scores = F.transform(F.array(*[F.array(*map(F.lit, c)) for c in centres]), lambda c, i: F.struct(V.dot("qvec", c).alias("s"), i.alias("list")))
    near = queries.select("query_id", "qvec", F.explode(F.slice(F.sort_array(scores, False), 1, probes)).alias("p")).select("query_id", "qvec", "p.list")
    pairs = near.join(listed.select("vec_id", vec, "list"), "list").where("query_id <> vec_id")
    return best(pairs.withColumn("score", V.dot("qvec", vec)).select("query_id", "vec_id", "score"), k).select("query_id", "rank", "vec_id", "score")
