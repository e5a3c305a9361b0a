"""Encoding chunks to vectors by a pluggable encoder, and late pooling."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import words as W
from siltstone.session import ship

#: Makes an encoder on a worker: called once a task, it returns texts -> matrix of one row a text.
EncoderFactory = Callable[[], Callable[[list[str]], np.ndarray]]


def hashing_encoder(dims: int = 64, seed: int = 7) -> EncoderFactory:
    """An encoder without a model, for tests and as a default: each lower-cased word adds a fixed random direction."""

    def make():
        import xxhash

        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dims))
            for row, text in zip(out, texts, strict=True):
                for word in text.lower().split():
                    row += np.random.default_rng(xxhash.xxh64_intdigest(word.encode(), seed)).normal(size=dims)
            return out

        return encode

    return make


def encode(chunks: DataFrame, factory: EncoderFactory, key: str = "chunk_id", text: str = "texto", batch: int = 32, longest: int | None = None) -> DataFrame:
    """(key, vec): unit vectors of the texts; null texts count as empty. The encoder is made once a task and gets `batch` texts at a time. A text of more than `longest` words between white space is an error."""
    ship(chunks.sparkSession)

    def work(batches) -> Iterator[pa.RecordBatch]:
        model = factory()
        for b in batches:
            for i in range(0, b.num_rows, batch):
                some = b.slice(i, batch)
                texts = [t or "" for t in some[text].to_pylist()]
                for name, t in zip(some[key].to_pylist(), texts, strict=True):
                    if longest is not None and len(t.split()) > longest:
                        raise ValueError(f"{key} {name} is longer than the encoder's window of {longest}")
                v = np.asarray(model(texts), np.float64)
                v = (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([some[key], pa.array(list(v), pa.list_(pa.float32()))], names=[key, "vec"])

    kind = chunks.schema[key].dataType.simpleString()
    return chunks.select(key, text).mapInArrow(work, f"`{key}` {kind}, vec array<float>")


def resume_encoding(chunks: DataFrame, done: DataFrame, factory: EncoderFactory, key: str = "chunk_id", **options) -> DataFrame:
    """Vectors of the chunks that `done` hasn't, for appending to it."""
    return encode(chunks.join(done.select(key).distinct(), key, "left_anti"), factory, key, **options)


def sentence_windows(tokens: list[tuple[int, int]], text: str, capacity: int, back: int = 2) -> list[tuple[int, int]]:
    """Windows of at most `capacity` tokens (start, end in characters) that begin and end at sentences; each begins `back` sentences before the end of the one before, and after its beginning. Longer sentences are cut."""
    starts = np.array([s for s, _ in tokens])
    ends = np.array([e for _, e in tokens])
    pieces: list[tuple[int, int]] = []
    for m in re.finditer(W.SENTENCE, text, re.DOTALL):
        own = np.flatnonzero((ends > m.start()) & (starts < m.end()))
        if len(own):
            pieces += [(i, min(i + capacity, own[-1] + 1)) for i in range(int(own[0]), int(own[-1]) + 1, capacity)]
    windows: list[tuple[int, int]] = []
    i = 0
    while i < len(pieces):
        first = pieces[i][0]
        fitting = [k for k in range(i, len(pieces)) if k == i or pieces[k][1] - first <= capacity]
        last = next((k for k, nxt in zip(fitting, fitting[1:], strict=False) if nxt != k + 1), fitting[-1])
        windows.append((int(first), int(pieces[last][1])))
        if last + 1 >= len(pieces):
            break
        i = max(i + 1, last + 1 - back)
    return windows or [(0, len(tokens))]


#: Makes a token encoder on a worker: text -> token spans in characters, and (text, spans) of a window -> a vector for each token.
TokenEncoderFactory = Callable[[], tuple[Callable[[str], list[tuple[int, int]]], Callable[[str, list[tuple[int, int]]], np.ndarray]]]


def hashing_token_encoder(dims: int = 16, seed: int = 7) -> TokenEncoderFactory:
    """A token encoder without a model: words between white space; a token's vector is its word's direction and a tenth of the window's mean."""

    def make():
        encode_word = hashing_encoder(dims, seed)()

        def spans(text: str) -> list[tuple[int, int]]:
            return [m.span() for m in re.finditer(r"\S+", text)]

        def embed(text: str, window: list[tuple[int, int]]) -> np.ndarray:
            own = encode_word([text[s:e] for s, e in window])
            return own + 0.1 * own.mean(axis=0)

        return spans, embed

    return make


def encode_late(docs: DataFrame, chunks: DataFrame, factory: TokenEncoderFactory, capacity: int = 8192, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(chunk_id, vec): late vectors of chunks (doc_id, chunk_id, char_start, char_end) of whole documents.

    Each document is encoded once, in windows of `capacity` tokens that begin
    two sentences before the end of the one before; a chunk is the mean, over
    the windows that it meets, of the mean of its tokens there, as a unit
    vector. A chunk without a token is an error. Windows of one document only
    are in memory.
    """
    ship(docs.sparkSession)
    spans_of = chunks.groupBy(id).agg(F.collect_list(F.struct("chunk_id", "char_start", "char_end")).alias("spans"))
    rows = docs.select(id, F.coalesce(F.col(text), F.lit("")).alias("text")).join(spans_of, id).select("text", "spans")

    def work(batches) -> Iterator[pa.RecordBatch]:
        tokenise, embed = factory()
        for b in batches:
            names, vectors = [], []
            for body, spans in zip(b["text"].to_pylist(), b["spans"].to_pylist(), strict=True):
                tokens = tokenise(body)
                first = np.array([s for s, _ in tokens], np.int64)
                last = np.array([e for _, e in tokens], np.int64)
                inside = [np.flatnonzero((last > c["char_start"]) & (first < c["char_end"])) for c in spans]
                parts: list[list[np.ndarray]] = [[] for _ in spans]
                for a, z in sentence_windows(tokens, body, capacity) if tokens else []:
                    v = np.asarray(embed(body, tokens[a:z]), np.float64)
                    for own, out in zip(inside, parts, strict=True):
                        here = own[(own >= a) & (own < z)] - a
                        if len(here):
                            out.append(v[here].mean(axis=0))
                for c, out in zip(spans, parts, strict=True):
                    if not out:
                        raise ValueError(f"no token lies in {c['chunk_id']}")
                    mean = np.mean(out, axis=0)
                    names.append(c["chunk_id"])
                    vectors.append((mean / max(float(np.linalg.norm(mean)), 1e-12)).astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(vectors, pa.list_(pa.float32()))], names=["chunk_id", "vec"])

    return rows.mapInArrow(work, "chunk_id string, vec array<float>")


def late_pool(token_vectors: DataFrame, chunks: DataFrame) -> DataFrame:
    """(chunk_id, vec): the mean over windows of the mean of the token vectors (doc_id, window, tok_start, tok_end, vec) that overlap a chunk's characters (doc_id, chunk_id, char_start, char_end), as a unit vector.

    Tokens meet the chunks of their document only; sums go by dimension and
    are aggregated before they are shuffled.
    """
    inside = (F.col("tok_end") > F.col("char_start")) & (F.col("tok_start") < F.col("char_end"))
    pairs = token_vectors.join(chunks.select("doc_id", "chunk_id", "char_start", "char_end"), "doc_id").where(inside)
    each = pairs.select("chunk_id", "window", F.posexplode("vec").alias("dim", "x"))
    windows = each.groupBy("chunk_id", "window", "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    means = windows.groupBy("chunk_id", "dim").agg(F.avg("x").alias("x"))
    rows = means.groupBy("chunk_id").agg(F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("r"))
    length = F.greatest(F.sqrt(F.aggregate("r", F.lit(0.0), lambda s, r: s + r["x"] * r["x"])), F.lit(1e-12))
    return rows.select("chunk_id", F.transform("r", lambda r: r["x"] / length).alias("vec"))


def check_alignment(chunks: DataFrame, vectors: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Keys that only one of chunks and vectors has: key, missing_in. Empty if they belong together."""
    a, b = chunks.select(key).distinct(), vectors.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("missing_in", F.lit("vectors")).unionByName(b.join(a, key, "left_anti").withColumn("missing_in", F.lit("chunks")))
