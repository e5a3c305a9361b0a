"""Document fingerprints by one-permutation MinHash.

Each word shingle is hashed once; the high bits of the hash name a bin and the
bin keeps its least value. An empty bin takes the value of the first filled bin
in a seeded order of all bins that is its own (optimal densification: filled
bins are equally likely, and two documents choose alike). The low bits of each
value are stored, packed, and likeness corrects for bits that agree by chance.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import lowered, map_arrow, mix, shingle_hashes, table
from siltstone.session import ship

SHINGLE = 5
BINS = 512
BITS = 4


@functools.lru_cache(maxsize=2)
def probes(bins: int) -> np.ndarray:
    """At [i, j], when bin i, if empty, looks at bin j."""
    draw = np.random.default_rng(20240229)
    return np.stack([draw.permutation(bins) for _ in range(bins)]).astype(np.uint16)


def sketches(texts: list[bytes], shingle: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> np.ndarray:
    """Low-order bits of each text's bins, one byte each, of lower-cased texts. Fewer words than a shingle are one shingle; no words: all zero."""
    high = np.uint64(64 - (bins - 1).bit_length())
    least = np.uint64((1 << int(high)) - 1)
    empty = np.uint64((1 << 64) - 1)
    values = np.full((len(texts), bins), empty, np.uint64)
    for first, h, doc in shingle_hashes(texts, shingle):
        np.minimum.at(values.reshape(-1), (first + doc) * bins + (h >> high).astype(np.int64), h & least)
    some = (values != empty).any(axis=1)
    for i in np.flatnonzero(some):
        blank = np.flatnonzero(values[i] == empty)
        if len(blank):
            filled = np.flatnonzero(values[i] != empty)
            values[i, blank] = values[i, filled[probes(bins)[np.ix_(blank, filled)].argmin(axis=1)]]
    out = (mix(values) & np.uint64((1 << bits) - 1)).astype(np.uint8)
    out[~some] = 0
    return out


def to_text(sketch: np.ndarray, bits: int = BITS) -> str:
    """The bins' bits packed without gaps, as hex digits."""
    return np.packbits(np.unpackbits(sketch[:, None], axis=1)[:, 8 - bits :]).tobytes().hex()


def from_text(text: str, bits: int = BITS) -> np.ndarray:
    raw = np.unpackbits(np.frombuffer(bytes.fromhex(text), np.uint8))
    raw = raw[: len(raw) // bits * bits].reshape(-1, bits)
    return (raw << np.arange(bits - 1, -1, -1, dtype=np.uint8)).sum(axis=1).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimates of the Jaccard likeness of sketches' shingle sets, row by row: bins that agree, less those that agree by chance."""
    chance = 1 / (1 << bits)
    return np.clip(((a == b).mean(axis=-1) - chance) / (1 - chance), 0, 1)


def edited(text: str, after: str) -> str:
    """The text with its last floor(n/2) code points replaced by the first as many, or all, of the next."""
    n = len(text) // 2
    return text[: len(text) - n] + after[:n]


def cuts_of(keys: list[int], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Where ranges of (key, sub) begin, the first one's beginning left out, from quantiles of keys: a key that holds several quantiles is cut by sub, a hash, into as many parts."""
    found, times = np.unique(np.array(keys, np.int64), return_counts=True)
    out = [(int(k), -(1 << 63) + (j << 64) // int(n + 1)) for k, n in zip(found, times, strict=True) for j in range(int(n) + 1 if n > 1 else 1)]
    out = [x for x in out if x != (least, -(1 << 63))]
    return np.array([k for k, _ in out], np.int64), np.array([x for _, x in out], np.int64)


def range_at(cut_keys: np.ndarray, cut_subs: np.ndarray, keys: np.ndarray, subs: np.ndarray) -> np.ndarray:
    """Which range each (key, sub) is in."""
    at = np.searchsorted(cut_keys, keys, side="left")
    for k in np.unique(cut_keys[np.isin(cut_keys, keys)]):
        own = keys == k
        at[own] += np.searchsorted(cut_subs[cut_keys == k], subs[own], side="right")
    return at


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next larger doc_id, after the last the
    first; rows of equal doc_id follow each other by a hash of their text, null
    ids come before all others and null texts count as empty. A lone document
    follows itself. An empty table gives an empty result. Other columns are not
    read.

    Documents are dealt to ranges of (doc_id, hash), so that many rows of one
    id, or of none, are many ranges; the first row of each range goes to the
    range before it too. Each text is shuffled once.
    """
    spark = docs.sparkSession
    ship(spark)
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumns({"key": F.coalesce("doc_id", F.lit(-(1 << 63))), "sub": F.xxhash64("text")})
    found = docs.agg(F.min("key").alias("least"), F.percentile_approx("key", [i / n for i in range(1, n)], 10 * n).alias("cuts")).first()
    cut_keys, cut_subs = cuts_of(found["cuts"] or [], found["least"])

    @F.pandas_udf("long")
    def range_of(key: pd.Series, sub: pd.Series) -> pd.Series:
        return pd.Series(range_at(cut_keys, cut_subs, key.to_numpy(), sub.to_numpy()))

    ranged = docs.withColumn("range", range_of("key", "sub"))
    firsts = sorted((r["range"], r["m"]["key"], r["m"]["sub"]) for r in ranged.groupBy("range").agg(F.min(F.struct("key", "sub")).alias("m")).collect())
    before = [firsts[k - 1][0] for k in range(len(firsts))]  # of the first the last
    marks = spark.createDataFrame([(k, x, to) for (_, k, x), to in zip(firsts, before, strict=True)], "key long, sub long, range long")
    ahead = docs.join(F.broadcast(marks), ["key", "sub"]).groupBy("range", "key", "sub").agg(F.first("doc_id").alias("doc_id"), F.min("text").alias("text"))
    columns = ("doc_id", "text", "key", "sub", "range")
    dealt = ranged.select(*columns, F.lit(False).alias("ahead")).unionAll(ahead.select(*columns, F.lit(True)))
    dealt = dealt.repartition(n, "range").sortWithinPartitions("range", "ahead", "key", "sub", "text")

    def work(batches):
        held = None  # the last row and its sketch
        for b in batches:
            ids, texts, ranges, flags = b["doc_id"].to_pylist(), b["text"].to_pylist(), b["range"].to_pylist(), b["ahead"].to_pylist()
            for i in range(0, len(ids), 512):
                rows = list(zip(ids[i : i + 512], texts[i : i + 512], ranges[i : i + 512], flags[i : i + 512], strict=True))
                found = sketches(lowered([t for _, t, *_ in rows]))
                if held:
                    rows, found = [held[0], *rows], np.concatenate([held[1], found])
                pairs = [k for k in range(len(rows) - 1) if not rows[k][3] and rows[k][2] == rows[k + 1][2]]
                changed = [edited(rows[k][1], rows[k + 1][1]).encode("utf-8", "surrogatepass") for k in pairs]
                after = sketches([t.lower() for t in changed])
                at = np.array(pairs, np.int64)
                yield {
                    "doc_id": pa.array([rows[k][0] for k in pairs], pa.int64()),
                    "n_chars": pa.array([len(rows[k][1]) for k in pairs], pa.int64()),
                    "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
                    "fingerprint": pa.array([to_text(found[k]) for k in pairs], pa.string()),
                    "edited_fingerprint": pa.array([to_text(x) for x in after], pa.string()),
                    "near_edited": pa.array(likeness(found[at], after), pa.float64()),
                    "near_next": pa.array(likeness(found[at], found[at + 1]), pa.float64()),
                }
                held = rows[-1], found[-1:]

    return map_arrow(dealt.select("doc_id", "text", "range", "ahead"), work, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op2_oph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(table(spark, sf_dir, "documents"))
