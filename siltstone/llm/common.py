"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.session import ship

#: ASCII white space as a character class for Java's and DuckDB's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or one under /tmp where that is unset (local mode)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file:///tmp/checkpoints/siltstone"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the JVM ends."""
    path = f"{shared_dir(spark)}/siltstone-{uuid.uuid4().hex}/{name}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where.getParent())
    return path


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stash_path = path
    return back


def open_fs(uri: str):
    """Arrow's file system for a URI of the shared folder, and the path there; s3a and s3n are s3 to Arrow."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def forget(df: DataFrame) -> None:
    """Deletes a stashed table that nothing reads any more."""
    if path := getattr(df, "_stash_path", None):
        remove(df.sparkSession, path.rpartition("/")[0])


#: Ids that are broadcast at most.
BROADCAST = 1_000_000


def least_rows(docs: DataFrame, named: DataFrame, kept: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Of named, the rows of docs with a doc_id and a mark of their text, those whose (doc_id, mark) is kept, each once (the least by its columns); and the rows of docs without a doc_id.

    rows (doc_id, mark, n), how often each occurs in named, saves the shuffle of
    most texts: unless they are too many, hashes of what is left out or repeated
    are broadcast, and only texts of such a hash are compared.
    """
    key, whole = F.xxhash64("doc_id", "mark"), named
    out = docs.where("doc_id IS NULL")
    if rows is not None:
        plain = rows.where("n = 1").join(kept, ["doc_id", "mark"], "left_semi").select("doc_id", "mark", F.lit(1).alias("plain"))
        doubt = stash(rows.join(plain, ["doc_id", "mark"], "left").where("plain IS NULL").select(key.alias("_key")).distinct(), "doubt")
        if doubt.count() <= BROADCAST:
            keyed = named.withColumn("_key", key)
            out = out.unionByName(keyed.join(F.broadcast(doubt), "_key", "left_anti").select(*docs.columns))
            whole = keyed.join(F.broadcast(doubt), "_key", "left_semi").drop("_key")
    least = whole.join(kept, ["doc_id", "mark"], "left_semi").groupBy("doc_id", "mark").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return least.select("row.*").unionByName(out)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of doc_id as text, modulo n; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def map_arrow(df: DataFrame, work, schema: str | StructType) -> DataFrame:
    """mapInArrow where work turns an iterator of (dict of columns as Arrow arrays, row count) into dicts of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns():
            for b in batches:
                if b.num_rows:
                    yield dict(zip(b.schema.names, b.columns, strict=True))

        try:
            for out in work(columns()):
                yield pa.RecordBatch.from_arrays([x if isinstance(x := out[f.name], pa.Array) else pa.array(x, type=f.type) for f in arrow], schema=arrow)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


@functools.cache
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


#: What a worker does at the end of each task, as dropping most of a cache.
AT_END: list[Callable[[], None]] = []


def give_back() -> None:
    """Returns memory to the system at the end of a task: workers live on, several to an executor, and beside its heap there is little room."""
    for shrink in AT_END:
        shrink()
    pa.default_memory_pool().release_unused()
    _trim()(0)


def release(spark: SparkSession) -> None:
    """Has the executors' JVMs return the heap that finished work has filled: they keep it, up to their limit, while the next work's Python workers need the room beside it.

    A task for each core collects its JVM's garbage, so each idle executor gets one; where none does, nothing else changes.
    """
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.reflect(F.lit("java.lang.System"), F.lit("gc")).alias("done")).write.format("noop").mode("overwrite").save()


def tidy(work):
    """work for applyInArrow, which returns memory after each group."""

    def run(key, rows):
        try:
            return work(key, rows)
        finally:
            give_back()

    return run


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a column; null counts as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 with links a-b, the smallest node that each can reach."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(nxt := label[label], label):
            label = nxt


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected links (a, b): one row (node, root) for each node that has a link, root the smallest node reachable.

    Alternating large-star and small-star rounds; each round writes its links
    to the shared folder, so no lineage grows and no links reach the driver.
    Minima are taken by partial aggregation and brought back by a join that
    adaptive execution may split, so that a node with very many links is no
    bottleneck.
    """

    def star(links: DataFrame, large: bool) -> DataFrame:
        around = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = around.join(least, "a")
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def digest(links: DataFrame):
        return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    links = stash(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = digest(links)
    while True:
        # A round has at most as many links as it got, and a file for each million.
        new = stash(star(star(links, True), False).coalesce(1 + before[0] // 1_000_000), "links")
        now = digest(new)
        forget(links)
        links = new
        if now == before:
            roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
        before = now


#: Bytes that one round of word_hashes takes at most.
ROUND = 1 << 19
STEP = 0x9E3779B97F4A7C15


@functools.lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2**64."""
    both = []
    for x in (STEP, pow(STEP, -1, 1 << 64)):
        p = np.full(n, x, np.uint64)
        p[0] = 1
        both.append(np.cumprod(p, dtype=np.uint64))
    return both[0], both[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), in place."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _spaces() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[32, *range(9, 14)]] = True
    return t


SPACE = _spaces()
def word_sums(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomials in STEP, modulo 2**64, of some words of an array of codes, its prefix sums taken at once. At most 2 * ROUND + 2 codes."""
    up, down = powers(2 * ROUND + 2)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], dtype=np.uint64, out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def _hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some bytes, and where they start."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], SPACE[buf], [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    return mix(word_sums(buf, starts, ends) + (ends - starts).astype(np.uint64)), starts


def _long_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of one long text, by windows that end at white space; a word longer than a window is summed up window by window."""
    found, buf, at = [], np.frombuffer(text, np.uint8), 0
    while at < len(buf):
        window = buf[at : at + ROUND]
        blank = np.flatnonzero(SPACE[window])
        if at + ROUND >= len(buf) or len(blank):
            end = len(window) if at + ROUND >= len(buf) else int(blank[-1]) + 1
            found.append(_hashes(window[:end])[0])
            at += end
            continue
        total, n, step = 0, 0, 1
        while at < len(buf) and not (blank := SPACE[window := buf[at : at + ROUND]])[0]:
            size = int(blank.argmax()) if blank.any() else len(window)
            total = total + step * int(word_sums(window, np.array([0]), np.array([size]))[0]) & (1 << 64) - 1
            step = step * pow(STEP, size, 1 << 64) & (1 << 64) - 1
            n, at = n + size, at + size
        found.append(mix(np.array([total + n & (1 << 64) - 1], np.uint64)))
    return np.concatenate([np.zeros(0, np.uint64), *found])


def word_hashes(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """64-bit hashes of the words of lower-cased texts, some texts at a time: (index of the first text, texts' bounds in words, hashes).

    All bytes of a round are hashed at once: prefix sums of byte * r**position
    give each word's polynomial. A text longer than a round comes alone and is
    read in windows, so that beside its hashes memory stays bounded.
    """
    i = 0
    while i < len(texts):
        if len(texts[i]) >= ROUND:
            h = _long_hashes(texts[i])
            yield i, np.array([0, len(h)]), h
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and size + len(texts[j]) < ROUND:
            size += len(texts[j]) + 1
            j += 1
        h, starts = _hashes(np.frombuffer(b" ".join(texts[i:j]) + b" ", np.uint8))
        at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts[i:j]])))
        yield i, np.searchsorted(starts, at), h
        i = j


def windows(text: str, size: int) -> Iterator[str]:
    """A text in windows of at most `size` code points that end after white space; a word longer than that is cut."""
    at = 0
    while len(text) - at > size:
        end = 1 + max(text.rfind(c, at, at + size) for c in " \t\n\v\f\r")
        end = end if end > at else at + size
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def lowered(texts: list[str]) -> list[bytes]:
    """Texts as UTF-8 with A-Z lower-cased."""
    return [t.encode("utf-8", "surrogatepass").lower() for t in texts]


@functools.lru_cache(maxsize=8)
def places(n: int) -> list[np.uint64]:
    """n odd numbers, always the same."""
    draw = np.random.default_rng(7).integers(1, 1 << 63, n, dtype=np.uint64)
    return [np.uint64(2 * int(x) + 1 & (1 << 64) - 1) for x in draw]


#: Words whose shingles are hashed at once.
WORDS = 1 << 17


def shingle_hashes(texts: list[bytes], shingle: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, hashes of word shingles, which text from the first on each is of) for some lower-cased texts, or a part of a long one, at a time.

    Fewer words than a shingle are one shingle; a text without words has none.
    """
    for first, bounds, words in word_hashes(texts):
        n = np.diff(bounds)
        if len(n) == 1 and n[0] > WORDS:
            for a in range(0, n[0] - shingle + 1, WORDS):
                h = _shingles(np.array([0, min(WORDS + shingle - 1, n[0] - a)]), words[a : a + WORDS + shingle - 1], shingle)
                yield first, h[0], h[1]
        else:
            yield first, *_shingles(bounds, words, shingle)


def _shingles(bounds: np.ndarray, words: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(bounds)
    k = np.minimum(n, shingle)
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(words)) - bounds[:-1][doc]
    h = np.zeros(len(words), np.uint64)
    for j, odd in enumerate(places(shingle)):
        own = words[j:] * odd
        own[at[: len(own)] + j >= n[doc[: len(own)]]] = 0
        h[: len(own)] += own
    own = at <= (n - k)[doc]
    return mix(h[own] + k[doc[own]].astype(np.uint64)), doc[own]
