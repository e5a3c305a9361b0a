"""SimHash near-duplicate classes, found by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2r bits have a common variant that
differs from each in at most r bits. Every fingerprint therefore stands for the
ball of all its variants within r flips; fingerprints that share a variant are
linked, and none that should be linked is missed. The variants are shuffled by
the parities of k disjoint groups of bits: a flip changes one parity, so a ball
meets 1 + k + k(k-1)/2 of the 2**k buckets, and one row a bucket carries the
fingerprint whose variants of that bucket the receiving task writes out. That
moves some dozens of rows a fingerprint over the network and not 2081.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import SPACE, components, forget, least_rows, local_components, map_arrow, stash, table, texts_of, windows

SEED = 42


#: Code points whose shingles are hashed at once.
WINDOW = 1 << 19


def fingerprint(text: str, shingle: int = 4) -> int:
    """64-bit SimHash over word shingles: a bit is 1 if over half the shingles' XXH64 have it. No words: 0; fewer words than a shingle: the whole sequence is one."""
    ones, n, words, open_ = np.zeros(64, np.int64), 0, [], False
    for window in windows(text, WINDOW):
        data = window.encode("utf-8", "surrogatepass").lower()
        if open_:  # the last word goes on
            data = words.pop() + data
        words += data.split()
        open_ = len(text) > WINDOW and bool(words) and not SPACE[data[-1]]
        if len(text) > WINDOW and len(words) > shingle:
            h = _shingles(words, shingle)[:-1]
            ones, n, words = ones + _ones(h), n + len(h), words[len(h) :]
    if words:
        h = _shingles(words, shingle)
        ones, n = ones + _ones(h), n + len(h)
    return sum(1 << b for b in range(64) if 2 * int(ones[b]) > n)


def _shingles(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of each shingle, or of the whole sequence if it is shorter."""
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    joined, k = b" ".join(words), min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64, len(words) - k + 1)


def _ones(h: np.ndarray) -> np.ndarray:
    """How many hashes have each bit."""
    out = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        out += np.unpackbits(h[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): the SimHash of each text, as a signed 64-bit number; null texts count as empty. Long columns named in extra stay."""

    def work(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in texts_of(b["text"])], np.uint64)
            yield {"doc_id": b["doc_id"].cast("int64"), "fp": pa.array(fps.view(np.int64)), **{c: b[c] for c in extra}}

    return map_arrow(docs.select("doc_id", "text", *extra), work, ", ".join(["doc_id long, fp long", *(f"{c} long" for c in extra)]))


class Ball:
    """Variants within r = 1 or 2 flips, dealt to 2**k buckets by the parities of k groups of bits."""

    def __init__(self, k: int, radius: int):
        self.k = k
        self.groups = [sum(1 << b for b in range(g, 64, k)) for g in range(k)]
        self.masks: dict[int, list[int]] = {}
        for r in range(radius + 1):
            for bits in itertools.combinations(range(64), r):
                differ = 0
                for b in bits:
                    differ ^= 1 << (b % k)
                self.masks.setdefault(differ, []).append(sum(1 << b for b in bits))
        self.masks = {x: np.array(m, np.uint64) for x, m in self.masks.items()}

    def home(self, fps: np.ndarray) -> np.ndarray:
        out = np.zeros(len(fps), np.int64)
        for g, m in enumerate(self.groups):
            out |= (np.bitwise_count(fps & np.uint64(m)).astype(np.int64) & 1) << g
        return out

    def links(self, bucket: int, fps: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """A spanning forest of the links that the variants of one bucket show: (fingerprint, the smallest of its tree)."""
        fps = np.unique(fps)
        differ = self.home(fps) ^ bucket
        variants, owners, flips = [], [], []
        for x in np.unique(differ):
            own = np.flatnonzero(differ == x)
            masks = self.masks[int(x)]
            variants.append((fps[own][:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(own, len(masks)))
            flips.append(np.tile(np.bitwise_count(masks), len(own)))
        variants, owners = np.concatenate(variants), np.concatenate(owners)
        # All that share a variant are compared with the one that is nearest to it. If that is nearer than the radius, all are linked to it; if not, those of an odd `within` that are to be linked share another variant, too.
        order = np.lexsort((np.concatenate(flips), variants))
        variants, owners = variants[order], owners[order]
        new = np.concatenate(([True], variants[1:] != variants[:-1]))
        first = np.maximum.accumulate(np.where(new, np.arange(len(owners)), 0))
        a, b = owners[first[~new]], owners[~new]
        pairs = np.unique(np.minimum(a, b) * len(fps) + np.maximum(a, b))
        a, b = pairs // len(fps), pairs % len(fps)
        near = np.bitwise_count(fps[a] ^ fps[b]) <= within
        label = local_components(len(fps), a[near], b[near])
        child = np.flatnonzero(label != np.arange(len(fps)))
        return fps[child], fps[label[child]]


def near_links(fps: DataFrame, count: int, within: int = 4, variants_per_bucket: int = 2_000_000) -> DataFrame:
    """Links (a, b) that connect just the distinct fingerprints that chains of at most `within` differing bits connect.

    count, the number of fingerprints, sets the number of buckets, so that a
    task's variants fit in memory at any size.
    """
    radius = (within + 1) // 2
    k = max(6, math.ceil(math.log2(max(1, count * sum(math.comb(64, r) for r in range(radius + 1)) / variants_per_bucket))))
    ball = Ball(k, radius)
    reach = np.array(sorted(ball.masks), np.int64)

    def deal(batches):
        for b in batches:
            own = b["fp"].to_numpy(zero_copy_only=False)
            to = ball.home(own.view(np.uint64))[:, None] ^ reach[None, :]
            yield {"bucket": pa.array(to.ravel()), "fp": pa.array(np.repeat(own, len(reach)))}

    def meet(key, rows):
        a, b = ball.links(key[0].as_py(), rows["fp"].to_numpy().view(np.uint64), within)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return map_arrow(fps.select("fp"), deal, "bucket long, fp long").groupBy("bucket").applyInArrow(meet, "a long, b long")


def rooted(distinct: DataFrame, within: int) -> DataFrame:
    """(fp, least_id, root) of distinct (fp, least_id): root names the class that links of at most `within` differing bits reach."""
    roots = components(near_links(distinct, distinct.count(), within))
    whole = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    return stash(whole, "rooted")


def near_classes(docs: DataFrame, shingle: int = 4, within: int = 4) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, the smallest doc_id that links of at most `within` differing bits reach.

    Null texts count as empty; texts without words have fingerprint zero and
    are linked like any other. Repeated rows fall into one class and stay
    repeated. A null doc_id keeps its row; it is never a component_id unless
    its class has no other id. An empty table gives an empty result. Columns
    other than doc_id and text are not read.
    """
    own = stash(fingerprints(docs, shingle), "fingerprints")
    distinct = stash(own.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    whole = rooted(distinct, within)
    least = whole.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = stash(whole.join(least, "root").select("fp", "component_id"), "classes")
    forget(whole)
    forget(distinct)
    return own.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = 4, within: int = 4) -> DataFrame:
    """The rows of docs that stand for their class: of each, the one of the smallest doc_id, then of the smallest hash of its text, once. All columns stay. Rows without a doc_id can't be named and all stay."""
    named = docs.where("doc_id IS NOT NULL").withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    own = fingerprints(named, shingle, ("mark",))
    distinct = stash(own.groupBy("fp").agg(F.min(F.struct("doc_id", "mark")).alias("least_id")), "distinct")
    kept = rooted(distinct, within).groupBy("root").agg(F.min("least_id").alias("least"))
    return least_rows(docs, named, stash(kept.select("least.doc_id", "least.mark"), "kept"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))
