"""Scores of texts under a hierarchical Pitman-Yor language model.

The restaurant of a word serves what follows that word; all share one parent,
the restaurant of all words, which draws from a uniform base over the
vocabulary and one unknown word. A text begins in a restaurant of its own.

Seatings are sampled by Gibbs. What is kept of a dish in a restaurant is its
number of customers and of tables: one customer leaves (their table goes with
the probability that they sit alone, given those two numbers), and sits down
again at a table or at a new one, given all else. Tables of a restaurant are
customers of the parent. Predictive probabilities are averaged over the samples
kept. Restaurants sit in shards, which re-seat at the same time; between rounds
they exchange, for each of their words, the customers and tables in the parent.
Discounts follow from how many dishes were had once and twice; the strength of
the restaurants is fitted to the seating after each round.

Texts are hashed once, into block files of word numbers. What goes between
blocks, shards of words and shards of restaurants are compressed arrays, one
row for each pair of the two, never more rows than entries. A restaurant of
very many customers is cut into slices of its dishes. No task and no driver
holds the vocabulary, and all files lie in the shared folder under names that a
task that runs again writes again, so a lost executor costs its tasks only.
"""

from __future__ import annotations

import dataclasses
import json
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import crc_mod, forget, give_back, lowered, map_arrow, mix, new_path, open_fs, remove, stash, table, texts_of, word_hashes

#: Up to how many customers of a dish the chance to sit alone is tabled.
TABLED = 256
#: Dishes of a restaurant move in turns, this many turns to a step; dishes of one turn move at the same time.
TURNS = 4
STRENGTHS = np.geomspace(0.05, 2000, 24)
END = np.uint64(0x5E17_0000_0000_0E01)
BEGIN = 1 << 62
ROWS = "to long, of long, data binary, sums array<double>"
#: Places in sums: customers and tables of the parent, its dishes had once and twice, pairs had once and twice, then likelihoods of STRENGTHS.
CUSTOMERS, TABLES, ONCE, TWICE, PAIRS_ONCE, PAIRS_TWICE, LIKELY = range(7)
SUMS = LIKELY + len(STRENGTHS)


@dataclasses.dataclass(frozen=True)
class Sizes:
    """block: tokens (words and ends) of a block file at most; shard: tokens, on average, whose pairs one shard of restaurants has; words: words of blocks that one shard of words has, on average; slice: tokens after a word from which on its restaurant is cut into slices."""

    block: int = 3_000_000
    shard: int = 5_000_000
    words: int = 3_000_000
    slice: int = 1_000_000


def dump(**arrays: np.ndarray) -> bytes:
    """Arrays of numbers as bytes, the numbers' bytes compressed place by place; rising arrays of 64 bits as differences."""
    head, parts, packer = [], [], zstandard.ZstdCompressor(level=1)
    for name, x in arrays.items():
        x = np.ascontiguousarray(x)
        rising = x.dtype.kind in "iu" and x.itemsize == 8 and len(x) > 1 and bool((x[1:] >= x[:-1]).all())
        raw = np.diff(x, prepend=x.dtype.type(0)) if rising else x
        data = packer.compress(np.ascontiguousarray(raw.view(np.uint8).reshape(-1, x.itemsize).T).tobytes())
        head.append((name, x.dtype.str, rising, len(data)))
        parts.append(data)
    top = json.dumps(head).encode()
    return b"".join([len(top).to_bytes(4, "little"), top, *parts])


def load(data: bytes) -> dict[str, np.ndarray]:
    """The arrays that dump packed."""
    data, out = memoryview(data), {}
    at = 4 + int.from_bytes(data[:4], "little")
    for name, kind, rising, size in json.loads(bytes(data[4:at])):
        raw = np.frombuffer(zstandard.decompress(data[at : at + size]), np.uint8)
        x = np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)
        out[name] = np.cumsum(x, dtype=x.dtype) if rising else x
        at += size
    return out


def save(folder: str, name: str, **arrays: np.ndarray) -> None:
    """A file in a folder that all executors share, written under a name of its attempt and then renamed."""
    fs, base = open_fs(folder)
    fs.create_dir(base, recursive=True)
    attempt = f"{base}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(attempt) as f:
        f.write(dump(**arrays))
    fs.move(attempt, f"{base}/{name}")


def saved(folder: str, name: str) -> dict[str, np.ndarray]:
    fs, base = open_fs(folder)
    with fs.open_input_file(f"{base}/{name}") as f:
        return load(f.read())


def sent(rows: list[tuple[int, int, bytes]], sums: np.ndarray | None = None) -> dict:
    """Rows (to, of, data, sums); sums go with the first row."""
    to, of, data = zip(*rows, strict=True) if rows else ((), (), ())
    first = [None if k or sums is None else sums.tolist() for k in range(len(to))]
    return {"to": pa.array(to, pa.int64()), "of": pa.array(of, pa.int64()), "data": pa.array(data, pa.binary()), "sums": pa.array(first, pa.list_(pa.field("element", pa.float64())))}


def passed(rows: DataFrame, work: Callable, schema: str = ROWS) -> DataFrame:
    """What work(to, of, arrays, sums) makes of the rows sent to each place: their senders in ascending order, arrays and added sums."""

    def run(key, got):
        try:
            of = got["of"].to_numpy()
            order = np.argsort(of, kind="stable")
            data = got["data"]
            sums = np.array([x for x in got["sums"].to_pylist() if x]).reshape(-1, SUMS).sum(axis=0)
            return pa.table(work(key[0].as_py(), of[order], [load(data[int(i)].as_buffer()) for i in order], sums))
        finally:
            give_back()

    return rows.select("to", "of", "data", "sums").groupBy("to").applyInArrow(run, schema)


def added(rows: DataFrame) -> np.ndarray:
    """The sums of all rows; the driver gets one row."""
    r = rows.agg(*(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(SUMS))).first()
    return np.array([x or 0.0 for x in r])


# Texts to blocks


def write_blocks(docs: DataFrame, folder: str, most: int) -> DataFrame:
    """Writes the block files of docs (doc_id, text, held_out); gives block, tokens, words and training texts of each.

    A block has the numbers of its tokens' words among its own sorted words,
    its parts of texts (doc_id, held_out, a number of the row, tokens), and, if
    it begins inside a text, the word before. A long text may lie in several.
    """

    def work(batches):
        part, nth, row = TaskContext.get().partitionId(), 0, 0
        hashes: list[np.ndarray] = []
        parts: list[tuple] = []
        size, begun, before = 0, 0, np.zeros(0, np.uint64)

        def written():
            block = (part << 24) + nth
            names, code = np.unique(np.concatenate([before, *hashes]), return_inverse=True)
            ids, held, rows, n = zip(*parts, strict=True)
            n, held = np.array(n), np.array(held)
            trained = np.bincount(code[len(before) :], np.repeat(~held, n), len(names)).astype(np.int64)
            every = np.bincount(code[len(before) :], minlength=len(names))
            none = np.array([i is None for i in ids])
            save(f"{folder}/texts", str(block), code=code.astype(np.int32), n=n, held=held, row=np.array(rows), doc_id=np.array([i or 0 for i in ids], np.int64), none=none, inside=np.array([len(before)]))
            save(f"{folder}/names", str(block), names=names, trained=trained, every=every)
            return {"block": pa.array([block]), "tokens": pa.array([int(n.sum())]), "words": pa.array([len(names)]), "trained": pa.array([begun])}

        for b in batches:
            texts, ids, held = texts_of(b["text"]), b["doc_id"].to_pylist(), b["held_out"].to_pylist()
            for at in range(0, len(texts), 256):
                for first, bounds, h in word_hashes(lowered(texts[at : at + 256])):
                    h[h == END] ^= np.uint64(1 << 63)
                    for k, i in enumerate(range(at + first, at + first + len(bounds) - 1)):
                        whole = np.append(h[bounds[k] : bounds[k + 1]], END)
                        begun += not held[i]
                        while len(whole):
                            own, whole = whole[: most - size], whole[most - size :]
                            hashes.append(own)
                            parts.append((ids[i], held[i], (part << 32) + row, len(own)))
                            size += len(own)
                            if size == most:
                                yield written()
                                before = own[-1:].copy() if len(whole) else own[:0]
                                hashes, parts, size, begun, nth = [], [], 0, 0, nth + 1
                        row += 1
        if parts:
            yield written()

    return map_arrow(docs, work, "block long, tokens long, words long, trained long")


def to_words(blocks: DataFrame, folder: str, n: int) -> DataFrame:
    """Sends each block's words to the n shards of words, by ranges of their hashes."""

    def work(batches):
        for b in batches:
            for block in b["block"].to_pylist():
                got = saved(f"{folder}/names", str(block))
                shard = ((got["names"] >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
                cut = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]))
                yield sent([(int(shard[s]), block, dump(**{k: x[s:e] for k, x in got.items()})) for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)])

    return map_arrow(blocks, work, ROWS)


def count_words(slice_: int) -> Callable:
    """Answers blocks: their words' numbers in this shard, training counts and slices. Sums: tokens and distinct words of training texts."""

    def work(to, of, arrays, _):
        names, code = np.unique(np.concatenate([x["names"] for x in arrays]), return_inverse=True)
        trained, every = (np.bincount(code, np.concatenate([x[k] for x in arrays]), len(names)).astype(np.int64) for k in ("trained", "every"))
        slices = (1 + every // slice_).astype(np.int32)
        ends = np.cumsum([len(x["names"]) for x in arrays])[:-1]
        sums = np.zeros(SUMS)
        sums[CUSTOMERS], sums[TABLES] = trained.sum(), (trained > 0).sum()
        return sent([(int(block), to, dump(id=own, trained=trained[own], slices=slices[own])) for block, own in zip(of, np.split(code, ends), strict=True)], sums)

    return work


# Pairs to restaurants


def pairs_of(text: dict, ids: np.ndarray, slices: np.ndarray, begin_slices: int, n: int) -> tuple[np.ndarray, ...]:
    """A block's distinct (restaurant, slice, word), by shard: (word before, slice, word, shard), and the place of each token's pair among them."""
    inside = int(text["inside"][0])
    code, starts = text["code"].astype(np.int64), np.concatenate(([0], np.cumsum(text["n"])[:-1]))
    word = code[inside:]
    before = np.concatenate((code[:inside] if inside else [len(ids)], word[:-1]))
    before[starts[inside:]] = len(ids)
    slices = np.append(slices, begin_slices).astype(np.int64)
    most = int(slices.max())
    some = slices[before] > 1
    which = np.zeros(len(word), np.int64)
    which[some] = (mix(ids[word[some]].astype(np.uint64)) % slices[before[some]].astype(np.uint64)).astype(np.int64)
    names, of = np.unique((before * most + which) * len(ids) + word, return_inverse=True)
    place, word = names // len(ids), names % len(ids)
    before, which = place // most, place % most
    shard = (place_hash(np.append(ids, BEGIN)[before], which) % np.uint64(n)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    back = np.empty(len(order), np.int32)
    back[order] = np.arange(len(order), dtype=np.int32)
    return before[order], which[order], word[order], shard[order], back[of]


def place_hash(ids: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Names a slice of a restaurant."""
    return mix(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + which.astype(np.uint64))


def to_restaurants(folder: str, n: int, tokens: float, vocabulary: float, texts: int, begin: int) -> Callable:
    """Sends a block's pairs to the shards of restaurants, and keeps what its texts have of the base score. begin: slices of the restaurant in which texts begin."""

    def work(block, of, arrays, _):
        ids = np.concatenate([(int(s) << 32) + x["id"] for s, x in zip(of, arrays, strict=True)])
        trained, slices = (np.concatenate([x[k] for x in arrays]) for k in ("trained", "slices"))
        text = saved(f"{folder}/texts", str(block))
        code = text["code"][int(text["inside"][0]) :]
        starts = np.concatenate(([0], np.cumsum(text["n"])[:-1]))
        base = np.log10((trained + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
        save(f"{folder}/known", str(block), id=ids, slices=slices, base=np.add.reduceat(base[code], starts), known=np.add.reduceat((trained > 0)[code].astype(np.int64), starts))
        before, which, word, shard, at = pairs_of(text, ids, slices, begin, n)
        count = np.bincount(at, np.repeat(~text["held"], text["n"]), len(word)).astype(np.int32)
        total, ids, slices = np.append(trained, texts), np.append(ids, BEGIN), np.append(slices, begin)
        cut = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]))
        rows = []
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            new = np.flatnonzero(np.concatenate(([True], (np.diff(before[s:e]) != 0) | (np.diff(which[s:e]) != 0))))
            own = before[s:e][new]
            words, w = np.unique(word[s:e], return_inverse=True)
            data = dump(id=ids[own], which=which[s:e][new].astype(np.int32), total=total[own], sliced=slices[own] > 1, size=np.diff(np.append(new, e - s)).astype(np.int32), words=ids[words], word=w.astype(np.int32), n=count[s:e])
            rows.append((int(shard[s]), block, data))
        return sent(rows)

    return work


def by_word_shard(ids: np.ndarray, other: np.ndarray) -> Iterator[tuple[int, slice, slice]]:
    """The shards of words that rising ids and rising others lie in, and where."""
    for shard in np.union1d(ids >> 32, other >> 32).tolist():
        both = [slice(*np.searchsorted(x, [shard << 32, shard + 1 << 32]).tolist()) for x in (ids, other)]
        yield shard, both[0], both[1]


def open_restaurants(folder: str) -> Callable:
    """Merges the pairs that blocks sent to a shard, keeps them, and sends each word's restaurants to the shards of words, and the tables of sliced restaurants."""

    def work(shard, of, arrays, _):
        names, first, inn = np.unique(np.concatenate([place_hash(x["id"], x["which"]) for x in arrays]), return_index=True, return_inverse=True)
        ids, which, total, sliced = (np.concatenate([x[k] for x in arrays])[first] for k in ("id", "which", "total", "sliced"))
        words, code = np.unique(np.concatenate([x["words"] for x in arrays]), return_inverse=True)
        inns = np.repeat(inn, np.concatenate([x["size"] for x in arrays]))
        skip = np.cumsum([0, *(len(x["words"]) for x in arrays)])
        word = np.concatenate([code[k + x["word"]] for k, x in zip(skip[:-1].tolist(), arrays, strict=True)])
        pairs, at = np.unique(inns * len(words) + word, return_inverse=True)
        c = np.bincount(at, np.concatenate([x["n"] for x in arrays]), len(pairs)).astype(np.int64)
        inn, word = (pairs // len(words)).astype(np.int32), (pairs % len(words)).astype(np.int32)
        cut = np.flatnonzero(sliced)
        cut = cut[np.argsort(ids[cut], kind="stable")]
        save(f"{folder}/shards", str(shard), inn=inn, word=word, c=c, total=total, first=which == 0, cut=cut)
        save(f"{folder}/asked", str(shard), block=of, n=np.array([len(x["word"]) for x in arrays]), at=at.astype(np.int32))
        sums = np.zeros(SUMS)
        sums[PAIRS_ONCE], sums[PAIRS_TWICE] = (c == 1).sum(), (c == 2).sum()
        t = np.bincount(word, c > 0, len(words)).astype(np.int32)
        tables = np.bincount(inn, c > 0, len(names)).astype(np.int64)[cut]
        return sent([(s, shard, dump(id=words[a] & 0xFFFFFFFF, t=t[a], inn=ids[cut][b], tables=tables[b])) for s, a, b in by_word_shard(words, ids[cut])], sums)

    return work


# Seatings


def tabled(discount: float) -> np.ndarray:
    """[c, t]: the chance that one of c customers at t tables sits alone, exactly, by generalised Stirling numbers, for c up to TABLED."""
    out = np.zeros((TABLED + 1, TABLED + 2))
    low = np.full(TABLED + 2, -np.inf)
    low[1] = 0.0
    out[1, 1] = 1.0
    t = np.arange(TABLED + 2)
    for c in range(2, TABLED + 1):
        with np.errstate(divide="ignore"):
            stay = low + np.log(np.maximum(c - 1 - discount * t, 0))
        alone = np.concatenate(([-np.inf], low[:-1]))
        now = np.logaddexp(stay, alone)
        fine = now > -np.inf
        out[c, fine] = np.exp(alone[fine] - now[fine])
        low = now
    return out


@dataclasses.dataclass
class Alone:
    """The chance that one of c customers at t tables sits alone. Beyond TABLED customers by the saddle point of the tables' generating function (1 - (1 - z)**d) / d."""

    discount: float

    def __post_init__(self):
        d = self.discount
        self.table = tabled(d)
        y = np.geomspace(1e-16, 0.999, 4000)  # 1 - z
        whole = (1 - y**d) / d
        mean = (1 - y) * y ** (d - 1) / whole
        order = np.argsort(mean)
        self.mean, self.share = np.log(mean[order]), ((1 - y) / whole)[order]

    def __call__(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        out = self.table[np.minimum(c, TABLED), np.minimum(t, TABLED + 1).astype(np.int64)]
        far = np.flatnonzero(c > TABLED)
        if len(far):
            c, t = c[far], t[far]
            out[far] = np.where(t >= c, 1.0, (t - 1) / c * np.interp(np.log(c / t), self.mean, self.share))
        return out


def move(c: np.ndarray, t: np.ndarray, others: np.ndarray, base: np.ndarray, strength: float, alone: Alone, draw: np.random.Generator) -> np.ndarray:
    """Tables of dishes of c > 1 customers at t tables after one customer of each left and sat down again; others: tables of other dishes in the restaurant, base: the dish's probability in the parent."""
    t = t - (draw.random(len(c)) < alone(c, t))
    new = (strength + alone.discount * (others + t)) * base
    return t + (draw.random(len(c)) * (new + c - 1 - alone.discount * t) < new)


def settled(c: np.ndarray, others: np.ndarray, base: np.ndarray, strength: float, alone: Alone) -> np.ndarray:
    """A number of tables at which a table is as likely to go as to come, where the moves begin."""
    low, high = np.ones(len(c)), c.astype(float)
    while len(c) and (high - low).max() > 1:
        t = np.floor((low + high) / 2)
        new = (strength + alone.discount * (others + t)) * base
        down = alone(c, t) > new / (new + c - 1 - alone.discount * t)
        low, high = np.where(down, low, t), np.where(down, t, high)
    return low


def sweep(inn: np.ndarray, c: np.ndarray, t: np.ndarray, tables: np.ndarray, base: np.ndarray, strength: float, alone: Alone, draw: np.random.Generator, moves: int) -> np.ndarray:
    """Tables of dishes after `moves` customers of each moved. Dishes (sorted by restaurant) of one customer have one table always; tables: of each restaurant, all slices together, as they are at first."""
    t, tables = t.astype(np.float64), tables.astype(np.float64)
    open_ = np.flatnonzero(c > 1)
    turn = np.arange(len(open_)) - np.searchsorted(inn[open_], inn[open_])
    turns = [open_[turn % TURNS == k] for k in range(TURNS)]
    turns = [(x, inn[x], c[x], base[x]) for x in turns if len(x)]
    for _ in range(moves):
        for x, place, n, p in turns:
            old = t[x]
            t[x] = new = move(n, old, tables[place] - old, p, strength, alone, draw)
            moved = np.flatnonzero(new != old)
            np.add.at(tables, place[moved], (new - old)[moved])
    return t


def likelihoods(customers: np.ndarray, tables: np.ndarray, discount: float) -> np.ndarray:
    """Of each of STRENGTHS, the log-likelihood of restaurants of so many customers and tables, up to what doesn't depend on it."""
    some = customers > 0
    out = np.zeros(len(STRENGTHS))
    for k, (values, n) in enumerate(np.unique(x[some], return_counts=True) for x in (tables, customers)):
        for i, s in enumerate(STRENGTHS):
            at = s / discount if k == 0 else s
            out[i] += (1 - 2 * k) * (n * (np.array([math.lgamma(at + v) for v in values.tolist()]) - math.lgamma(at + 1))).sum()
    return out


@dataclasses.dataclass
class Settings:
    """Vocabulary; customers and tables of the parent; discounts and strengths of restaurants and of the parent."""

    vocabulary: float
    customers: float
    tables: float
    discount: float
    parent_discount: float
    strength: float = 1.0
    parent_strength: float = 1.0

    def parent(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Probabilities of words by their customers and tables in the parent."""
        back = (self.parent_strength + self.parent_discount * self.tables) / (self.vocabulary + 1)
        return (c - self.parent_discount * t + back) / (self.parent_strength + self.customers)

    def then(self, sums: np.ndarray) -> Settings:
        """Settings for what the parent holds after a round."""
        whole = likelihoods(np.array([sums[CUSTOMERS]]), np.array([sums[TABLES]]), self.parent_discount)
        return dataclasses.replace(self, customers=sums[CUSTOMERS], tables=sums[TABLES], strength=float(STRENGTHS[sums[LIKELY:].argmax()]), parent_strength=float(STRENGTHS[whole.argmax()]))


def discount_of(once: float, twice: float) -> float:
    return float(np.clip(once / (once + 2 * twice), 0.05, 0.95)) if once + twice else 0.5


def open_parent(folder: str) -> Callable:
    """Merges the words that shards sent to a shard of words, keeps their places, and answers with customers and tables, one table each."""

    def work(to, of, arrays, sums):
        ids, at = np.unique(np.concatenate([x["id"] for x in arrays]), return_inverse=True)
        save(f"{folder}/parents", str(to), at=at.astype(np.int32), n=np.array([len(x["id"]) for x in arrays]), inn=np.concatenate([x["inn"] for x in arrays]))
        c = np.bincount(at, np.concatenate([x["t"] for x in arrays]), len(ids)).astype(np.int64)
        return answered(to, of, arrays, at, c, (c > 0).astype(np.int64), sums)

    return work


def answered(to: int, of: np.ndarray, arrays: list[dict], at: np.ndarray, c: np.ndarray, t: np.ndarray, sums: np.ndarray) -> dict:
    """Rows to the shards that sent arrays: customers and tables of their words in the parent, and all tables of their sliced restaurants."""
    sums = sums.copy()
    sums[CUSTOMERS], sums[TABLES], sums[ONCE], sums[TWICE] = c.sum(), t.sum(), (c == 1).sum(), (c == 2).sum()
    inn, own = np.unique(np.concatenate([x["inn"] for x in arrays]), return_inverse=True)
    tables = np.bincount(own, np.concatenate([x["tables"] for x in arrays]), len(inn)).astype(np.int64)[own]
    rows, i, j = [], 0, 0
    for shard, x in zip(of.tolist(), arrays, strict=True):
        some, i, cut, j = at[i : i + len(x["t"])], i + len(x["t"]), tables[j : j + len(x["tables"])], j + len(x["tables"])
        rows.append((shard, to, dump(c=c[some], t=t[some], tables=cut)))
    return sent(rows, sums)


def seat_parent(folder: str, now: Settings, seed: int, moves: int) -> Callable:
    """The parent's tables for the customers that restaurants have now."""
    alone = Alone(now.parent_discount)

    def work(to, of, arrays, sums):
        kept = saved(f"{folder}/parents", str(to))
        inns = np.split(kept["inn"], np.cumsum([len(x["tables"]) for x in arrays])[:-1])
        arrays = [x | {"inn": i} for x, i in zip(arrays, inns, strict=True)]
        at = kept["at"]
        c = np.bincount(at, np.concatenate([x["t"] for x in arrays]), int(at.max(initial=-1)) + 1).astype(np.int64)
        draw = np.random.default_rng([seed, 1, to])
        base = np.full(len(c), 1 / (now.vocabulary + 1))
        t = np.minimum(c, 1)
        many = np.flatnonzero(c > 1)
        t[many] = settled(c[many], np.full(len(many), now.tables), base[many], now.parent_strength, alone)
        t = sweep(np.zeros(len(c), np.int64), c, t, np.array([now.tables]), base, now.parent_strength, alone, draw, moves)
        return answered(to, of, arrays, at, c, t.astype(np.int64), sums)

    return work


def sample_of(kept: dict, t: np.ndarray, tables: np.ndarray, parent: np.ndarray, now: Settings) -> np.ndarray:
    """Predictive probabilities of a shard's pairs under its seating."""
    inn, customers = kept["inn"], kept["total"]
    back = (now.strength + now.discount * tables) / (now.strength + customers)
    return (kept["c"] - now.discount * t) / (now.strength + customers)[inn] + back[inn] * parent[kept["word"]]


def gathered(kept: dict, t: np.ndarray, arrays: list[dict], now: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the parent's answers: probabilities of the shard's words there, and tables of its restaurants, all slices together and of other slices."""
    c, tp, all_tables = (np.concatenate([x[k] for x in arrays]) for k in ("c", "t", "tables"))
    own = np.bincount(kept["inn"], t, len(kept["total"]))
    tables = own.copy()
    tables[kept["cut"]] = all_tables
    return now.parent(c, tp), tables, tables - own


def seat(folder: str, now: Settings, seed: int, round_: int, burn: int, moves: int) -> Callable:
    """A round: adds the standing seating's probabilities to those kept, if it is a sample, then re-seats the shard."""
    alone = Alone(now.discount)

    def work(shard, of, arrays, _):
        kept = saved(f"{folder}/shards", str(shard))
        c, inn = kept["c"], kept["inn"]
        state = saved(f"{folder}/state-{round_ - 1}", str(shard)) if round_ > 1 else {"t": np.minimum(c, 1).astype(np.int32)}
        t = state["t"].astype(np.float64)
        parent, tables, others = gathered(kept, t, arrays, now)
        state = {"p": state["p"]} if "p" in state else {}
        if round_ - 1 > burn:
            state["p"] = (state.get("p", 0) + sample_of(kept, t, tables, parent, now)).astype(np.float32)
        base = parent[kept["word"]]
        if round_ == 1:
            many = np.flatnonzero(c > 16)
            t[many] = settled(c[many], tables[inn[many]] - 1, base[many], now.strength, alone)
            tables = np.bincount(inn, t, len(tables)) + others
        t = sweep(inn, c, t, tables, base, now.strength, alone, np.random.default_rng([seed, 0, shard, round_]), moves)
        save(f"{folder}/state-{round_}", str(shard), t=t.astype(np.int32), **state)
        own = np.bincount(inn, t, len(tables)).astype(np.int64)
        sums = np.zeros(SUMS)
        sums[LIKELY:] = likelihoods(kept["total"][kept["first"]], (own + others.astype(np.int64))[kept["first"]], now.discount)
        words = np.bincount(kept["word"], t, int(sum(len(x["c"]) for x in arrays))).astype(np.int32)
        i, j, rows = 0, 0, []
        for to, x in zip(of.tolist(), arrays, strict=True):
            rows.append((to, shard, dump(t=words[i : i + len(x["c"])], tables=own[kept["cut"]][j : j + len(x["tables"])])))
            i, j = i + len(x["c"]), j + len(x["tables"])
        return sent(rows, sums)

    return work


def answers(folder: str, now: Settings, rounds: int, burn: int) -> Callable:
    """Sends blocks the logarithms of their pairs' probabilities, averaged over samples."""

    def work(shard, of, arrays, _):
        kept, asked = saved(f"{folder}/shards", str(shard)), saved(f"{folder}/asked", str(shard))
        state = saved(f"{folder}/state-{rounds}", str(shard))
        t = state["t"].astype(np.float64)
        parent, tables, _ = gathered(kept, t, arrays, now)
        p = (state.get("p", 0) + sample_of(kept, t, tables, parent, now)) / (rounds - burn)
        p = np.log10(p).astype(np.float32)
        ends = np.cumsum(asked["n"])[:-1]
        return sent([(int(b), shard, dump(p=p[own])) for b, own in zip(asked["block"], np.split(asked["at"], ends), strict=True)])

    return work


def sums_of_texts(folder: str, n: int, begin: int) -> Callable:
    """A block's parts of texts with their sums."""

    def work(block, of, arrays, _):
        text, known = saved(f"{folder}/texts", str(block)), saved(f"{folder}/known", str(block))
        *_, at = pairs_of(text, known["id"], known["slices"], begin, n)
        p = np.concatenate([x["p"] for x in arrays])[at].astype(np.float64)
        starts = np.concatenate(([0], np.cumsum(text["n"])[:-1]))
        return {
            "row": pa.array(text["row"]),
            "doc_id": pa.array(text["doc_id"], mask=text["none"]),
            "held_out": pa.array(text["held"]),
            "n_tokens": pa.array(text["n"].astype(np.int64)),
            "n_known": pa.array(known["known"]),
            "base_score": pa.array(known["base"]),
            "score": pa.array(np.add.reduceat(p, starts)),
        }

    return work


def score(docs: DataFrame, rounds: int = 3, burn: int = 1, moves: int = 12, seed: int = 42, sizes: Sizes = Sizes()) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    docs has doc_id, text and held_out; the others train. Null texts count as
    empty and have one token, the end. Repeated rows and null ids are scored
    one by one. Without training texts each token has the base's probability
    of one, the unknown word. An empty table gives an empty result.
    """
    spark, folder = docs.sparkSession, new_path(docs.sparkSession, "model")
    tasks = 1 + spark.sparkContext.defaultParallelism // 64  # of tables of a row a block
    blocks = stash(write_blocks(docs.select(F.col("doc_id").cast("long"), "text", "held_out"), folder, sizes.block).repartition(tasks), "blocks")
    r = blocks.agg(*(F.sum(c) for c in ("tokens", "words", "trained")), F.count(F.lit(1))).first()
    tokens, words, texts, n_blocks = (x or 0 for x in r)
    n_words, n, begin = 1 + words // sizes.words, 1 + tokens // sizes.shard, 1 + texts // sizes.slice

    spread = blocks.repartition(max(1, min(n_blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))), "block")
    counted = stash(passed(to_words(spread, folder, n_words), count_words(sizes.slice)), "counted")
    remove(spark, f"{folder}/names")
    sums = added(counted)
    train_tokens, vocabulary = sums[CUSTOMERS], sums[TABLES]

    sent_pairs = passed(counted, to_restaurants(folder, n, train_tokens, vocabulary, texts, begin))
    opened = stash(passed(passed(sent_pairs, open_restaurants(folder)), open_parent(folder)), "opened")
    forget(counted)
    sums = added(opened)
    now = Settings(vocabulary, sums[CUSTOMERS], sums[TABLES], discount_of(sums[PAIRS_ONCE], sums[PAIRS_TWICE]), discount_of(sums[ONCE], sums[TWICE]))
    for k in range(1, rounds + 1):
        seated = stash(passed(passed(opened, seat(folder, now, seed, k, burn, moves)), seat_parent(folder, now, seed + k, moves)), f"round-{k}")
        forget(opened)
        opened, now = seated, now.then(added(seated))
    told = passed(opened, answers(folder, now, rounds, burn))
    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    parts = passed(told, sums_of_texts(folder, n, begin), schema)
    whole = parts.groupBy("row", "doc_id", "held_out").agg(*(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(train_tokens)).cast("long").alias("train_tokens"), "base_score", "score")


def op8_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs.select("doc_id", "text", (crc_mod(F.col("doc_id"), 10) == 0).alias("held_out")))
