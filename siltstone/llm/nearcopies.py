"""Near copies by SimHash and the Jaccard likeness of word shingles, for the corpus pipeline.

Each text is the set of its 64-bit shingle hashes. Texts of one set fall
together first. Links are found in two steps, and compared as the sets they
are: linked is what has a likeness of at least the threshold; chains of links
make classes.

The first step finds nearly all classes cheaply. Its candidates are the links
of operator 9, SimHash fingerprints of the same shingles within four bits, and
the buckets of BANDS bands of ROWS MinHash values; in a bucket of more than
SMALL sets each is compared with the hub, the set with the most company in all
its buckets, and in every fourth band with another of the bucket.

The second step finds each link between the classes of the first that is
missing. Sets of likeness t share one of their n - ceil(t * n) + 1 first
shingles in any common order; here the order is by the frequency in a sample,
so that common shingles come last (the sample moves cost, never results). All
pairs that share such a shingle and are of two classes are held against two
bounds that lose nothing: their sizes, and parities of their shingles (how many
of a class of hashes a set has, odd or even), of which two sets differ in no
more than they differ in shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import BROADCAST, components, forget, least_rows, lowered, map_arrow, mix, release, shingle_hashes, stash, texts_of, tidy
from siltstone.llm.simhash import fingerprint, near_links

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 20, 5
SMALL = 64
#: Documents whose shingles are counted for the order of prefixes, and how many frequent ones are told apart.
SAMPLE, FREQUENT = 4000, 100_000
#: Shingles of prefixes that one task sorts, rows that one task compares, and sets of one shingle that are compared at once.
POSTINGS, MEMBERS, BLOCK = 500_000, 50_000, 2048
PARITIES, MOST_PARITIES = 1024, 1 << 17
#: Pairs of one set that go to one task.
PAIRS = 512


def shingle_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each lower-cased text, sorted."""
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for first, h, doc in shingle_hashes(texts, shingle):
        cut = np.flatnonzero(np.diff(doc)) + 1
        for own, i in zip(np.split(h, cut), doc[np.concatenate(([0], cut))] if len(doc) else [], strict=False):
            parts[first + i].append(np.unique(own))
    return [np.unique(np.concatenate(x)) if len(x) > 1 else x[0] if x else np.zeros(0, np.uint64) for x in parts]


def band_keys(h: np.ndarray) -> np.ndarray:
    """BANDS keys of a set that is not empty."""
    odds = np.random.default_rng(11).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    out = np.zeros(BANDS, np.uint64)
    least = np.array([(h * odd).min() for odd in odds]).reshape(BANDS, ROWS)
    for row in least.T:
        out = mix(out + row + np.arange(BANDS, dtype=np.uint64))
    return out


def parities(h: np.ndarray) -> bytes:
    """Of some classes of shingles, whether a set has an odd number of them: PARITIES classes or, of a large set, at least two for each shingle, up to MOST_PARITIES."""
    size = min(MOST_PARITIES, max(PARITIES, 1 << (2 * len(h) - 1).bit_length() if len(h) else 1))
    return np.packbits((np.bincount((h & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(bool)).tobytes()


def folded(parity: bytes, size: int) -> np.ndarray:
    """The parities of `size` classes, from those of more."""
    return np.bitwise_xor.reduce(np.frombuffer(parity, np.uint64).reshape(-1, size // 64), axis=0)


def apart(x: bytes, y: bytes) -> int:
    """How many parities of two sets differ: at most as many as their shingles."""
    size = 8 * min(len(x), len(y))
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())


def most_apart(n, m, least: float):
    """By how many shingles sets of n and m may differ whose likeness is at least `least`."""
    return np.floor((n + m) * ((1 - least) / (1 + least)) + 1e-6)


def prefix(h: np.ndarray, least: float, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set by frequency and hash: two sets of likeness `least` share one of them."""
    size = len(h) - int(np.ceil(least * len(h) - 1e-6)) + 1 if len(h) else 0
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
        known = np.where(frequent[at] == h, counts[at], 0)
        if known.any():
            h = h[np.lexsort((h, known))]
    return h[:size]


def frequent_shingles(named: DataFrame, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of a sample of about SAMPLE documents, sorted, and how many have them; any answer gives right prefixes."""
    some = named.where(F.pmod(F.xxhash64("doc_id", "mark"), F.lit(max(1, named.count() // SAMPLE))) == 0)

    def work(batches):
        for b in batches:
            for h in shingle_sets(lowered(texts_of(b["text"])), shingle):
                yield {"token": pa.array(h.view(np.int64))}

    counted = map_arrow(some.select("text"), work, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    found = counted.orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    tokens, counts = found["token"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], counts[order]


def sketched(docs: DataFrame, shingle: int, least: float, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, mark, same, fp, bands, n, parity, prefix) of docs (doc_id, mark, text): same names the set of shingles, n is its size, fp the SimHash; no words: 0, no bands and no prefix."""

    def work(batches):
        longs = pa.list_(pa.field("element", pa.int64()))
        for b in batches:
            texts = texts_of(b["text"])
            for at in range(0, len(texts), 256):
                sets = shingle_sets(lowered(texts[at : at + 256]), shingle)
                same = np.array([xxhash.xxh64_intdigest(h.tobytes()) if len(h) else 0 for h in sets], np.uint64).view(np.int64)
                own = slice(at, at + 256)
                yield {
                    "doc_id": b["doc_id"][own].cast("int64"),
                    "mark": b["mark"][own],
                    "same": pa.array(same),
                    "fp": pa.array(np.array([fingerprint(t, shingle) for t in texts[at : at + 256]], np.uint64).view(np.int64)),
                    "bands": pa.array([band_keys(h).view(np.int64) if len(h) else [] for h in sets], longs),
                    "n": pa.array([len(h) for h in sets], pa.int64()),
                    "parity": pa.array([parities(h) for h in sets], pa.binary()),
                    "prefix": pa.array([prefix(h, least, *frequent).view(np.int64) for h in sets], longs),
                }

    return map_arrow(docs.select("doc_id", "mark", "text"), work, "doc_id long, mark long, same long, fp long, bands array<long>, n long, parity binary, prefix array<long>")


def candidates(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets to compare, of distinct (same, fp, bands); b is a hub where one set has many pairs."""
    first = stash(distinct.where("size(bands) > 0").groupBy("fp").agg(F.min("same").alias("rep")), "first")
    alike = distinct.join(first, "fp").where("size(bands) > 0 AND same <> rep").select(F.col("same").alias("a"), F.col("rep").alias("b"))
    linked = near_links(first.select("fp"), first.count())
    linked = linked.join(first.select(F.col("fp").alias("a"), F.col("rep").alias("ra")), "a").join(first.select(F.col("fp").alias("b"), F.col("rep").alias("rb")), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    buckets = distinct.select("same", F.posexplode("bands").alias("band", "key"))
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stash(buckets.join(sizes, "key"), "shared")
    small = shared.where(F.col("n") <= SMALL).select("key", "same")
    pairs = small.withColumnRenamed("same", "a").join(small.withColumnRenamed("same", "b"), "key").where("a < b").select("a", "b").distinct()
    large = shared.where(F.col("n") > SMALL)
    company = large.groupBy("same").agg(F.sum("n").alias("company"))
    large = large.join(company, "same")
    heads = large.groupBy("key").agg(F.max(F.struct("company", "same")).alias("hub"), F.min(F.struct(F.xxhash64("same", "key"), "same")).alias("other"))
    heads = heads.select("key", F.col("hub.same").alias("hub"), F.col("other.same").alias("other"))
    stars = large.join(heads, "key")
    stars = stars.select(F.col("same").alias("a"), F.col("hub").alias("b")).union(stars.where("band % 4 = 0").select(F.col("same").alias("a"), F.col("other").alias("b")))
    return pairs.union(stars.where("a <> b")).union(alike).union(linked).distinct()


def possible(pairs: DataFrame, distinct: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sizes and parities allow a likeness of at least `least`."""
    own = distinct.select("same", "n", "parity")
    for side in "ab":
        pairs = pairs.join(own.select(F.col("same").alias(side), F.col("n").alias(f"n{side}"), F.col("parity").alias(f"p{side}")), side)
    pairs = pairs.where(F.least("na", "nb") >= F.lit(least) * F.greatest("na", "nb") - 1e-6)

    def work(batches):
        for b in batches:
            n, m = (b[c].to_numpy() for c in ("na", "nb"))
            differ = np.array([apart(x, y) for x, y in zip(b["pa"].to_pylist(), b["pb"].to_pylist(), strict=True)], np.int64)
            may = pa.array(differ <= most_apart(n, m, least))
            yield {"a": b["a"].filter(may), "b": b["b"].filter(may)}

    return map_arrow(pairs, work, "a long, b long")


def coarse(state: DataFrame) -> DataFrame:
    """state with PARITIES parities of each set."""

    def work(batches):
        for b in batches:
            yield {**b, "parity": pa.array([folded(x, PARITIES).tobytes() for x in b["parity"].to_pylist()], pa.binary())}

    return map_arrow(state, work, state.schema)


def runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal keys."""
    new = np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))) if len(keys[0]) else np.zeros(0, bool)
    at = np.append(np.flatnonzero(new), len(keys[0])).tolist()
    return list(zip(at[:-1], at[1:], strict=True))


def unmet(own: DataFrame, state: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) that share a shingle of their prefixes, are of two roots and may have a likeness of at least `least`; each that has it is among them. own: (same, prefix); state: (same, root, n, parity)."""

    total = own.agg(F.sum(F.size("prefix"))).first()[0] or 0
    buckets = 1 + total // POSTINGS

    def deal(batches):
        """Each set's shingles once a task, as one row for each bucket and batch."""
        seen: set[int] = set()
        for b in batches:
            new = pa.array([not (x in seen or seen.add(x)) for x in b["same"].to_pylist()])
            lists, s = b["prefix"].filter(new), b["same"].filter(new).to_numpy()
            t = lists.flatten().to_numpy()
            s = np.repeat(s, lists.value_lengths().to_numpy(zero_copy_only=False))
            to = t.view(np.uint64) % np.uint64(buckets)
            order = np.argsort(to, kind="stable")
            t, s, to = t[order], s[order], to[order].astype(np.int64)
            spans = runs(to)
            yield {"bucket": pa.array([to[x] for x, _ in spans], pa.int64()), **{c: pa.array([v[x:y].tobytes() for x, y in spans], pa.binary()) for c, v in (("token", t), ("same", s))}}

    def shared(key, rows):
        """Of the shingles that two sets have, the sets."""
        t, s = (np.frombuffer(b"".join(rows[c].to_pylist()), np.int64) for c in ("token", "same"))
        order = np.lexsort((s, t))
        t, s = t[order], s[order]
        new = np.append(True, (t[1:] != t[:-1]) | (s[1:] != s[:-1]))
        t, s = t[new], s[new]
        twice = t[1:] == t[:-1]
        held = np.append(False, twice) | np.append(twice, False)
        return pa.table({"token": pa.array(t[held]), "same": pa.array(s[held])})

    def mixed(key, rows):
        """Of the shingles that sets of two roots have, the sets, and how many they are."""
        t, s, r = (rows[c].to_numpy() for c in ("token", "same", "root"))
        order = np.lexsort((r, t))
        t, s, r = t[order], s[order], r[order]
        _, at, size = np.unique(t, return_index=True, return_counts=True)
        several = np.repeat(r[at] != r[at + size - 1], size)
        return pa.table({"token": pa.array(t[several]), "same": pa.array(s[several]), "size": pa.array(np.repeat(size, size)[several].astype(np.int64))})

    def compare(key, rows):
        rows = rows.sort_by([("token", "ascending"), ("lo", "ascending"), ("hi", "ascending"), ("n", "ascending")])
        t, lo, hi, own, s, r, n = (rows[c].to_numpy() for c in ("token", "lo", "hi", "own", "same", "root", "n"))
        p = np.frombuffer(b"".join(rows["parity"].to_pylist()), np.uint64).reshape(-1, PARITIES // 64)
        found = []
        for x, y in runs(t, lo, hi):
            ends = np.searchsorted(n[x:y], n[x:y] / least + 1e-6, "right") + x
            for i in range(x, y - 1):
                j = np.arange(i + 1, ends[i - x])
                j = j[(r[j] != r[i]) & ((own[j] != own[i]) | (lo[i] == hi[i]))]
                if len(j):
                    j = j[np.bitwise_count(p[j] ^ p[i]).sum(axis=1) <= most_apart(n[i], n[j], least)]
                    found.append(np.stack((np.minimum(s[j], s[i]), np.maximum(s[j], s[i]))))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.table({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})

    postings = map_arrow(own.select("same", "prefix"), deal, "bucket long, token binary, same binary")
    held = stash(postings.groupBy("bucket").applyInArrow(tidy(shared), "token long, same long"), "held")
    held_by = held.join(state.select("same", "root"), "same")
    mixed_ = stash(held_by.groupBy(F.pmod("token", F.lit(1 + held.count() // POSTINGS)).alias("bucket")).applyInArrow(tidy(mixed), "token long, same long, size long"), "mixed")
    forget(held)
    release(own.sparkSession)
    blocks = F.ceil(F.col("size") / BLOCK)
    dealt = mixed_.withColumns({"own": F.pmod(F.xxhash64("same"), blocks), "other": F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))})
    dealt = dealt.select("token", "same", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")).join(coarse(state), "same")
    bucket = F.pmod(F.xxhash64("token", "lo", "hi"), F.lit(1 + mixed_.count() // MEMBERS)).alias("bucket")
    found = stash(dealt.groupBy(bucket).applyInArrow(tidy(compare), "a long, b long").distinct(), "unmet")
    forget(mixed_)
    return found


def sets_of(named: DataFrame, distinct: DataFrame, pairs: DataFrame, shingle: int, repeated: bool) -> DataFrame:
    """(same, grams): the sets of some pairs, from the texts that stand for them. repeated: rows of one doc_id and text may occur."""
    asked = pairs.select(F.col("a").alias("same")).union(pairs.select(F.col("b").alias("same"))).distinct()
    asked = stash(distinct.join(asked, "same").select("least.doc_id", "least.mark", "same"), "asked")
    few = asked.count() <= BROADCAST

    def work(batches):
        for b in batches:
            texts = texts_of(b["text"])
            for at in range(0, len(texts), 256):
                yield {"same": b["same"][at : at + 256], "grams": pa.array([h.tobytes() for h in shingle_sets(lowered(texts[at : at + 256]), shingle)], pa.binary())}

    texts = named.select("doc_id", "mark", "text").join(F.broadcast(asked) if few else asked, ["doc_id", "mark"]).select("same", "text")
    sets = map_arrow(texts, work, "same long, grams binary")
    return stash(sets.dropDuplicates(["same"]) if repeated else sets, "sets")


def like(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard likeness of at least `least`. A set of many pairs goes to a task for each PAIRS of them."""
    tasks = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PAIRS).alias("tasks"))
    pairs = pairs.join(tasks, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("tasks")).alias("salt"))
    right = pairs.select("b", "salt").distinct().join(sets.select(F.col("same").alias("b"), F.col("grams").alias("y")), "b")
    both = pairs.join(sets.select(F.col("same").alias("a"), F.col("grams").alias("x")), "a").join(right, ["b", "salt"]).select("a", "b", "x", "y")

    def work(batches):
        for b in batches:
            near = np.zeros(len(b["a"]), bool)
            for i, (x, y) in enumerate(zip(b["x"], b["y"], strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if min(len(x), len(y)) >= least * max(len(x), len(y)) - 1e-9:
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    near[i] = common >= least * (len(x) + len(y) - common) - 1e-9
            yield {"a": b["a"].filter(pa.array(near)), "b": b["b"].filter(pa.array(near))}

    return map_arrow(both, work, "a long, b long")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, least: float = LEAST) -> DataFrame:
    """The rows of docs that stand for their class: of each, the one of the smallest doc_id, then of the smallest hash of its text, once.

    Null texts count as empty; texts without words are one class. All columns
    stay. Rows without a doc_id can't be named and all stay.
    """
    named = docs.where("doc_id IS NOT NULL").withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    own = stash(sketched(named, shingle, least, frequent_shingles(named, shingle)), "sketched")
    firsts = [F.first(c).alias(c) for c in ("bands", "n", "parity")]
    distinct = stash(own.groupBy("same").agg(F.min(F.struct("doc_id", "mark")).alias("least"), F.min("fp").alias("fp"), *firsts), "distinct")
    rows = stash(own.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("n")), "rows")
    repeated = bool(rows.where("n > 1").head(1))
    release(docs.sparkSession)
    roots = components(links_of(named, distinct, candidates(distinct), shingle, least, repeated))
    state = stash(_with_roots(distinct, roots).select("same", "root", "n", "parity"), "state")
    release(docs.sparkSession)
    missing = links_of(named, distinct, unmet(own, state, least), shingle, least, repeated)
    forget(own)
    forget(state)
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(missing))
    rooted = _with_roots(distinct, roots).groupBy("root").agg(F.min("least").alias("least"))
    kept = stash(rooted.select("least.doc_id", "least.mark"), "kept")
    release(docs.sparkSession)
    return least_rows(docs, named, kept, rows)


def links_of(named: DataFrame, distinct: DataFrame, pairs: DataFrame, shingle: int, least: float, repeated: bool) -> DataFrame:
    """Of candidates (a, b), those that are linked."""
    pairs = stash(possible(pairs, distinct, least), "candidates")
    release(named.sparkSession)
    sets = sets_of(named, distinct, pairs, shingle, repeated)
    found = stash(like(pairs, sets, least), "near")
    forget(sets)
    forget(pairs)
    release(named.sparkSession)
    return found


def _with_roots(distinct: DataFrame, roots: DataFrame) -> DataFrame:
    return distinct.join(roots.withColumnRenamed("node", "same"), "same", "left").withColumn("root", F.coalesce("root", "same"))
