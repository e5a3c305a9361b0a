"""Approximate nearest neighbours by inner product, by an adaptive dimension scan.

Vectors are lifted by one dimension so that the largest inner product is the
least distance, turned by a random rotation and dealt to the lists of a coarse
k-means. Within each list that a query probes, distances build up over blocks
of columns; after each block a candidate is abandoned if its partial distance,
scaled to all columns, is so far above the query's bound that the rotation
could hardly hide it (a hypothesis test on a random projection). What survives
all blocks is scored exactly, in double precision, on the original vectors.

The bound of a query is its k-th best of the lists nearest to it, which are
scanned first. How many lists are probed is set on the fitting sample, so that
its own neighbours are found at the recall asked for.
"""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.common import map_arrow, stash, table
from siltstone.session import ship

SAMPLE = 20_000
LISTS = 4096
COLUMNS = 16
#: How many standard errors a partial distance must lie above the bound to be abandoned.
EPSILON = 2.1
#: Vectors of a list, and queries to it, that one task handles at most, on average.
SIDE = 4096


@dataclasses.dataclass
class Index:
    """top: largest norm; turn: the rotation of lifted vectors; centres: of the lists, turned; probes: lists a query reads."""

    top: float
    turn: np.ndarray
    centres: np.ndarray
    probes: int

    def lift(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Turned vectors with a last column that fills all norms up to top; 0 for queries."""
        extra = np.zeros(len(v)) if query else np.sqrt(np.maximum(self.top**2 - (v * v).sum(axis=1), 0))
        return np.column_stack([v, extra]) @ self.turn

    def near_lists(self, lifted: np.ndarray, n: int) -> np.ndarray:
        far = (self.centres**2).sum(axis=1) - 2 * lifted @ self.centres.T
        return np.argsort(far, axis=1, kind="stable")[:, :n]


def fit(v: np.ndarray, total: int, top: float, k: int = 20, recall: float = 0.96, seed: int = 42, rounds: int = 12) -> Index:
    """An index from a sample of vectors of a table of `total`; of less than 1000 it has one list, and a search reads all."""
    draw = np.random.default_rng(seed)
    d = v.shape[1] + 1
    turn = np.linalg.qr(draw.normal(size=(d, d)))[0]
    lists = 1 if total < 1000 else min(LISTS, math.isqrt(total), len(v))
    index = Index(top, turn, np.zeros((lists, d)), lists)
    lifted = index.lift(v, False)
    centres = lifted[draw.choice(len(v), lists, replace=False)].copy()
    for _ in range(rounds if lists > 1 else 0):
        own = ((centres**2).sum(axis=1) - 2 * lifted @ centres.T).argmin(axis=1)
        n = np.bincount(own, minlength=lists)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, lifted)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    index.centres = centres
    if lists > 1:
        own = ((centres**2).sum(axis=1) - 2 * lifted @ centres.T).argmin(axis=1)
        asks = draw.choice(len(v), min(len(v), 500), replace=False)
        score = v[asks] @ v.T
        score[np.arange(len(asks)), asks] = -np.inf
        found = own[np.argpartition(-score, min(k, len(v) - 1) - 1, axis=1)[:, :k]]
        place = np.argsort(index.near_lists(index.lift(v[asks], True), lists), axis=1)
        index.probes = int(np.quantile(np.take_along_axis(place, found, axis=1), recall)) + 1
    return index


def scan(index: Index, ids: np.ndarray, v: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of each query's k best of these vectors that reach its bound, a least score; ties of the k-th to smaller ids."""
    lifted, asked = index.lift(v, False).astype(np.float32), index.lift(queries, True).astype(np.float32)
    d = lifted.shape[1]
    # The least score as a greatest squared distance in the lifted space.
    limit = (queries**2).sum(axis=1) + index.top**2 - 2 * bounds
    out = []
    rows = max(1, (1 << 20) // max(1, len(v)))
    for at in range(0, len(queries), rows):
        q, own_limit = asked[at : at + rows], limit[at : at + rows]
        a, b, far = None, None, None
        for c in range(0, d, COLUMNS):
            e = min(d, c + COLUMNS)
            if a is None:
                x, y = q[:, c:e], lifted[:, c:e]
                whole = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None] - 2 * x @ y.T
                keep = whole * (d / e) <= ((1 + EPSILON / math.sqrt(e)) ** 2 * own_limit)[:, None] if e < d else whole <= own_limit[:, None] + 1e-4 * (1 + np.abs(own_limit[:, None]))
                a, b = np.nonzero(keep)
                far = whole[a, b]
                continue
            far = far + ((q[a, c:e] - lifted[b, c:e]) ** 2).sum(axis=1)
            keep = far * (d / e) <= (1 + EPSILON / math.sqrt(e)) ** 2 * own_limit[a] if e < d else far <= own_limit[a] + 1e-4 * (1 + np.abs(own_limit[a]))
            a, b, far = a[keep], b[keep], far[keep]
        other = query_ids[at + a] != ids[b]
        a, b = a[other] + at, b[other]
        score = np.einsum("ij,ij->i", queries[a], v[b])
        ok = score >= bounds[a]
        a, b, score = a[ok], b[ok], score[ok]
        order = np.lexsort((ids[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        out.append((query_ids[a[rank < k]], ids[b[rank < k]], score[rank < k]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (query_ids[:0], ids[:0], np.zeros(0))


def _matrix(column, d: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors that take part: none of id, vector or components null, all finite, not all zero."""
    v = F.col("embedding").cast("array<double>")
    good = F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return vectors.where(good).select(F.col("vec_id").cast("long"), v.alias("v"))


def search(vectors: DataFrame, ask, k: int = 20, recall: float = 0.96, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by inner product of the vectors whose vec_id meets the condition ask.

    Rows with null vec_id, and vectors that are null, zero or hold null or
    non-finite components take no part, nor do those of another length than
    most. Of repeated vec_ids the least vector asks, and none is its own
    neighbour; other repeated rows each are candidates. Ties go to smaller
    vec_ids. Fewer candidates than k give fewer rows, an empty table none.
    Columns other than vec_id and embedding are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    good = usable(vectors)
    sizes = good.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("top"))
    most = sizes.orderBy(F.desc("n"), "d").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, total, top = most["d"], most["n"], math.sqrt(most["top"])
    good = good.where(F.size("v") == d)
    some = good.orderBy(F.xxhash64(F.lit(42), "vec_id"), "vec_id").limit(sample).toArrow()
    index = fit(_matrix(some["v"], d), total, top, k, recall)

    def assign(batches):
        for b in batches:
            own = index.near_lists(index.lift(_matrix(b["v"], d), False), 1)[:, 0]
            yield {"list": pa.array(own.astype(np.int32)), "vec_id": b["vec_id"], "v": b["v"]}

    def probe(batches):
        for b in batches:
            to = index.near_lists(index.lift(_matrix(b["v"], d), True), index.probes)
            n = to.shape[1]
            yield {"list": pa.array(to.ravel().astype(np.int32)), "nth": pa.array(np.tile(np.arange(n, dtype=np.int32), len(to))), "query_id": b["query_id"].take(pa.array(np.repeat(np.arange(len(to)), n)))}

    listed = stash(map_arrow(good, assign, "list int, vec_id long, v array<double>"), "listed")
    asking = stash(good.where(ask).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q")), "asking")
    probes = stash(map_arrow(asking.select("query_id", F.col("q").alias("v")), probe, "list int, nth int, query_id long"), "probes")

    def upto(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def meet(key, mine, theirs):
        if not mine.num_rows or not theirs.num_rows:
            found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        else:
            found = scan(index, mine["vec_id"].to_numpy(), _matrix(mine["v"], d), theirs["query_id"].to_numpy(), _matrix(theirs["q"], d), theirs["bound"].to_numpy(), k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, found), strict=True)))

    def sizes_of(rows: DataFrame) -> dict[int, int]:
        return {r["list"]: -(-r["n"] // SIDE) for r in rows.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}

    parts = sizes_of(listed)

    def answers(probed: DataFrame, bounded: DataFrame, all_probes: DataFrame) -> DataFrame:
        """What queries find in the lists that they probe. Lists are cut into parts, and so are the queries to a list; both sides of a task are bounded whatever shares a list."""
        turns = sizes_of(all_probes)
        cuts = F.broadcast(spark.createDataFrame([(i, n, turns[i]) for i, n in parts.items() if i in turns], "list int, parts int, turns int"))
        left = listed.join(cuts, "list").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
        left = left.select("list", "part", upto("turns").alias("turn"), "vec_id", "v")
        right = probed.join(cuts, "list").withColumn("turn", F.pmod(F.xxhash64("query_id"), F.col("turns")).cast("int"))
        right = right.select("list", upto("parts").alias("part"), "turn", "query_id").join(bounded, "query_id")
        by = ["list", "part", "turn"]
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(meet, "query_id long, vec_id long, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def first(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    early = max(1, index.probes // 8)
    near = stash(first(answers(probes.where(F.col("nth") < early), asking.withColumn("bound", F.lit(float("-inf"))), probes)), "near")
    bound = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(float("-inf")).alias("bound"))
    rest = answers(probes.where(F.col("nth") >= early), asking.join(bound, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf")))), probes)
    found = first(near.drop("rank").union(rest))
    if index.probes < len(index.centres):
        # Queries that found too few read all lists.
        found = stash(found, "found")
        short = asking.join(found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")), "query_id", "left").where(F.coalesce("n", F.lit(0)) < min(k, total - 1)).select("query_id", "q")
        short = stash(short.withColumn("bound", F.lit(float("-inf"))), "short")
        if not short.isEmpty():
            everywhere = short.select(F.explode(F.sequence(F.lit(0), F.lit(len(index.centres) - 1))).alias("list"), "query_id")
            again = first(answers(everywhere, short, everywhere))
            found = found.join(short.select("query_id"), "query_id", "left_anti").unionByName(again)
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
