"""Packing documents into sequences: Martello-Toth dominance reduction, then best-fit.

Piece lengths are integers up to the sequence length, so the instance is its
histogram: one count a length, however many documents there are. Sets of
lengths that dominate every other choice for their largest member are fixed for
all their copies at once, the rest goes by best-fit decreasing over groups of
equally filled sequences, which ends in some thousands of patterns at most.
Pieces then take their places by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.llm.common import map_arrow, stash, table, texts_of
from siltstone.llm.tokens import default_path, encoder

#: (length, copies) in the order in which they lie in a sequence, and in how many sequences.
Pattern = tuple[tuple[tuple[int, int], ...], int]


def _largest(counts: np.ndarray, most: int) -> int:
    """The largest length with a count, at most `most`; 0 if there is none."""
    found = np.flatnonzero(counts[: most + 1]) if most > 0 else ()
    return int(found[-1]) if len(found) else 0


def _smallest(counts: np.ndarray, n: int) -> list[int]:
    """The n smallest single lengths, with repeats."""
    found: list[int] = []
    for s in np.flatnonzero(counts)[:n]:
        found += [int(s)] * min(n - len(found), int(counts[s]))
    return found[:n]


def _pairs(counts: np.ndarray, room: int) -> tuple[int, int]:
    """Over pairs that fit into room: the largest sum, and the largest smaller member; 0 if no pair fits."""
    sizes = np.flatnonzero(counts[: room + 1])
    if not len(sizes):
        return 0, 0
    upto = np.searchsorted(sizes, room - sizes, side="right") - 1
    single = (upto >= 0) & (sizes[np.maximum(upto, 0)] == sizes) & (counts[sizes] < 2)
    upto = np.where(single, upto - 1, upto)
    fits = upto >= 0
    if not fits.any():
        return 0, 0
    best = sizes[fits] + sizes[upto[fits]]
    return int(best.max()), int(np.minimum(sizes[fits], sizes[upto[fits]]).max())


def reduce_dominated(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Fixes dominating sets, largest length first, and takes them off counts.

    For a length s with room = capacity - s left beside it, and b the largest
    other length that fits:
    nothing fits: s lies alone.
    s + b fills the sequence, or no two others fit together: {s, b}.
    at most two others fit and b is no less than any two that do: {s, b}.
    at most two others fit, b with its largest partner y, and y is no less than
    the smaller of any two that do: {s, b, y}.
    """
    fixed: list[Pattern] = []

    def fix(*members: int) -> None:
        need = defaultdict(int)
        for m in members:
            need[m] += 1
        n = min(int(counts[m]) // k for m, k in need.items())
        for m, k in need.items():
            counts[m] -= n * k
        fixed.append((tuple(need.items()), n))

    for s in range(capacity, 0, -1):
        while counts[s] > 0:
            room = capacity - s
            counts[s] -= 1  # what is left beside one s
            b = _largest(counts, room)
            least = _smallest(counts, 3)
            fits = sum(sum(least[: k + 1]) <= room for k in range(len(least)))
            total, smaller = _pairs(counts, room) if fits == 2 else (0, 0)
            y = 0
            if fits == 2 and b:
                counts[b] -= 1
                y = _largest(counts, room - b)
                counts[b] += 1
            counts[s] += 1
            if not b:
                fix(s)
            elif s + b == capacity or fits <= 1 or fits == 2 and b >= total:
                fix(s, b)
            elif fits == 2 and y and y >= smaller:
                fix(s, b, y)
            else:
                break
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing; sequences filled alike are handled together."""
    groups: dict[int, list[list]] = defaultdict(list)
    free = np.zeros(capacity + 1, np.int64)  # sequences by room left

    def put(room: int, filled: tuple, n: int) -> None:
        groups[room].append([filled, n])
        free[room] += n

    for s in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[s])
        while left:
            rooms = np.flatnonzero(free[s:])
            if not len(rooms):
                each = capacity // s
                if left >= each:
                    put(capacity - each * s, ((s, each),), left // each)
                if left % each:
                    put(capacity - left % each * s, ((s, left % each),), 1)
                break
            room = s + int(rooms[0])
            each, group = room // s, groups[room][-1]
            n, copies = (min(group[1], left // each), each) if left >= each else (1, left)
            group[1] -= n
            free[room] -= n
            if not group[1]:
                groups[room].pop()
            put(room - copies * s, (*group[0], (s, copies)), n)
            left -= n * copies
    return [(filled, n) for found in groups.values() for filled, n in found]


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """The patterns that hold every piece of a histogram of lengths 1..capacity."""
    left = np.zeros(capacity + 1, np.int64)
    for s, n in counts.items():
        left[s] += n
    fixed = reduce_dominated(left, capacity)
    return fixed + best_fit(left, capacity)


def pieces(docs: DataFrame, tokenizer: str, length: int = 4096, end: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids with the id end after them, cut after every `length` ids."""

    def work(batches):
        for b in batches:
            at, rows = 0, []
            doc_ids = b["doc_id"].cast("int64")
            texts = texts_of(b["text"])
            for at, ids in enumerate(encoder(tokenizer).encode(texts, end)):
                n, view = len(ids) // 4, memoryview(ids)
                for k, s in enumerate(range(0, n, length)):
                    rows.append((at, k, s, min(length, n - s), zlib.crc32(view[4 * s : 4 * (s + length)])))
            r = np.array(rows, np.int64)
            yield {"doc_id": doc_ids.take(pa.array(r[:, 0])), "piece": pa.array(r[:, 1].astype(np.int32)), "start": pa.array(r[:, 2]), "length": pa.array(r[:, 3]), "ids_crc32": pa.array(r[:, 4])}

    return map_arrow(docs.select("doc_id", "text"), work, "doc_id long, piece int, start long, length long, ids_crc32 long")


def place(items: DataFrame, capacity: int, per_slice: int = 200_000) -> DataFrame:
    """Adds sequence_id and offset to a written table with a length column of 1..capacity and a unique _row.

    The histogram (capacity rows at most) and the patterns are all that the
    driver sees. Ranks within a length are counted in slices of it, so that a
    length that holds a third of all rows is counted by many tasks.
    """
    counts = {int(r["length"]): r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    key, first, copies, sequence, offset = [], [], [], [], []
    taken: dict[int, int] = defaultdict(int)
    opened = 0
    for filled, n in plan(counts, capacity):
        at = 0
        for s, k in filled:
            key.append((s << 48) + taken[s])
            first.append(taken[s])
            copies.append(k)
            sequence.append(opened)
            offset.append(at)
            taken[s] += n * k
            at += s * k
        opened += n
    order = np.argsort(np.array(key, np.int64))
    key, first, copies, sequence, offset = (np.array(x, np.int64)[order] for x in (key, first, copies, sequence, offset))

    slices = max(64, sum(counts.values()) // per_slice)
    sliced = items.withColumn("_slice", F.pmod(F.xxhash64("_row"), F.lit(slices)))
    before = sliced.groupBy("length", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("length", "_slice", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_slice").orderBy("_row")
    ranked = sliced.withColumn("_rank", F.row_number().over(inside) - 1).join(before, ["length", "_slice"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_slice", "_before", "_row")

    def work(batches):
        for b in batches:
            size, rank = b["length"].to_numpy(), b["_rank"].to_numpy()
            at = np.searchsorted(key, (size << 48) + rank, side="right") - 1
            nth = rank - first[at]
            yield {k: v for k, v in b.items() if k != "_rank"} | {"sequence_id": pa.array(sequence[at] + nth // copies[at]), "offset": pa.array(offset[at] + nth % copies[at] * size)}

    schema = StructType([f for f in ranked.schema if f.name != "_rank"]).add("sequence_id", "long").add("offset", "long")
    return map_arrow(ranked, work, schema)


def pack(docs: DataFrame, tokenizer: str, length: int = 4096, end: int = 1) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one id, the end. Documents longer than a sequence
    are cut, no others. Repeated rows and null ids are pieces of their own. An
    empty table gives an empty result. Columns other than doc_id and text are
    not read.
    """
    return placed(cut(docs, tokenizer, length, end), length)


def cut(docs: DataFrame, tokenizer: str, length: int = 4096, end: int = 1) -> DataFrame:
    """The pieces of pack(), written to the shared folder."""
    return stash(pieces(docs, tokenizer, length, end).withColumn("_row", F.monotonically_increasing_id()), "pieces")


def placed(cut: DataFrame, length: int = 4096) -> DataFrame:
    """The rows of pack(), from those of cut()."""
    return place(cut, length).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_path())
