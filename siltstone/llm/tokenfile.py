"""Token-id files with fixed-width ids.

A file holds the ids of some documents, one after another in ascending doc_id
order, each id in the fewest bits that the vocabulary needs. Ids lie in blocks
of BLOCK ids that begin at a byte, so any block can be unpacked alone, with
numpy, and any range of ids by the blocks that it meets.

Layout, little-endian: magic (8 bytes); bits, block, documents, ids, blocks
(uint64 each); doc_id of each document (int64; NO_ID for null); where each
document's ids start in the file, and their end (uint64); where each block
starts in the payload, and its end (uint64); payload.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.common import map_arrow, new_path, open_fs, stash, table, texts_of
from siltstone.llm.tokens import default_path, encoder

MAGIC = b"SILTIDS1"
BLOCK = 4096
NO_ID = -(1 << 63)
#: Files that one task reads.
FILES_PER_TASK = 16


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0..vocabulary-1."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after another, `bits` each, lowest bit first, the last byte filled up with zeros.

    Eight ids take just `bits` bytes; byte k of them holds what of the eight
    falls into bits 8k..8k+7.
    """
    eight = np.zeros((-(-len(ids) // 8), 8), np.uint32)
    eight.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(eight), bits), np.uint8)
    for k in range(bits):
        for i in range(8 * k // bits, min(7, (8 * k + 7) // bits) + 1):
            shift = 8 * k - i * bits
            out[:, k] |= ((eight[:, i] >> shift if shift >= 0 else eight[:, i] << -shift) & 255).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack_bits(data: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    """The n ids that pack_bits packed."""
    raw = np.zeros((-(-n // 8), bits), np.uint8)
    raw.reshape(-1)[: -(-n * bits // 8)] = np.frombuffer(data, np.uint8, -(-n * bits // 8))
    out = np.zeros((len(raw), 8), np.uint32)
    for i in range(8):
        for k in range(i * bits // 8, (i * bits + bits - 1) // 8 + 1):
            shift = 8 * k - i * bits
            byte = raw[:, k].astype(np.uint32)
            out[:, i] |= byte << shift if shift >= 0 else byte >> -shift
    return out.reshape(-1)[:n] & np.uint32((1 << bits) - 1)


def to_file(doc_ids: Sequence[int], documents: Sequence[np.ndarray], bits: int, block: int = BLOCK) -> bytes:
    """A file's bytes. Every id must be below 2**bits."""
    ids = np.concatenate([*documents, np.zeros(0, np.uint32)]).astype(np.uint32)
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"the id {ids.max()} does not fit {bits} bits")
    parts = [pack_bits(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    starts = np.cumsum([0, *map(len, documents)])
    offsets = np.cumsum([0, *map(len, parts)])
    head = np.array([bits, block, len(documents), len(ids), len(parts)], "<u8")
    return b"".join([MAGIC, head.tobytes(), np.array(doc_ids, "<i8").tobytes(), starts.astype("<u8").tobytes(), offsets.astype("<u8").tobytes(), *parts])


class TokenFile:
    """Reads a file's bytes (or a memory map of them)."""

    def __init__(self, data):
        self.data = memoryview(data)
        if self.data[:8] != MAGIC:
            raise ValueError("not a token-id file")
        self.bits, self.block, self.n_docs, self.n_ids, n_blocks = (int(x) for x in np.frombuffer(self.data, "<u8", 5, 8))
        at = 48
        self.doc_ids = np.frombuffer(self.data, "<i8", self.n_docs, at)
        self.starts = np.frombuffer(self.data, "<u8", self.n_docs + 1, at := at + 8 * self.n_docs).astype(np.int64)
        self.offsets = np.frombuffer(self.data, "<u8", n_blocks + 1, at := at + 8 * (self.n_docs + 1)).astype(np.int64)
        self.payload = self.data[at + 8 * (n_blocks + 1) :]

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids start..end-1 of the file; only the blocks that hold them are unpacked."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        got = [unpack_bits(self.payload[self.offsets[b] : self.offsets[b + 1]], min(self.block, self.n_ids - b * self.block), self.bits) for b in range(first, last + 1)]
        return np.concatenate(got)[start - first * self.block : end - first * self.block]

    def all_ids(self) -> np.ndarray:
        """All ids. Blocks of a multiple of eight ids lie without gaps and are unpacked at once."""
        return unpack_bits(self.payload, self.n_ids, self.bits) if self.block % 8 == 0 else self.ids(0, self.n_ids)

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def write_files(docs: DataFrame, folder: str, tokenizer: str, end: int = 2, ids_per_file: int = 1 << 22, partitions: int | None = None) -> DataFrame:
    """Writes token-id files under folder, which all executors must share; one row per file: path, part, nth, n_docs, n_ids.

    Documents go to range partitions by doc_id, so files in the order (part,
    nth) hold ascending doc_ids, null first. A file is written under a name of
    its attempt and then renamed, so a task that is run again replaces whole
    files only.
    """
    spark = docs.sparkSession
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def work(batches):
        part, nth = TaskContext.get().partitionId(), 0
        own = encoder(tokenizer)
        bits = bits_for(max(own.vocabulary, end + 1))
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        doc_ids, documents, size = [], [], 0

        def flushed():
            name = f"ids-{part:06d}-{nth:06d}.bin"
            attempt = f"{base}/.{name}.{uuid.uuid4().hex}"
            with fs.open_output_stream(attempt) as f:
                f.write(to_file(doc_ids, documents, bits))
            fs.move(attempt, f"{base}/{name}")
            return {"path": pa.array([f"{folder}/{name}"]), "part": pa.array([part]), "nth": pa.array([nth]), "n_docs": pa.array([len(documents)]), "n_ids": pa.array([size])}

        for b in batches:
            for doc_id, ids in zip(b["doc_id"].cast("int64").to_pylist(), own.encode(texts_of(b["text"]), end), strict=True):
                doc_ids.append(NO_ID if doc_id is None else doc_id)
                documents.append(np.frombuffer(ids, "<u4"))
                size += len(ids) // 4
                if size >= ids_per_file:
                    yield flushed()
                    doc_ids, documents, size, nth = [], [], 0, nth + 1
        if documents:
            yield flushed()

    return map_arrow(ordered, work, "path string, part long, nth long, n_docs long, n_ids long")


def read_files(files: DataFrame) -> DataFrame:
    """One row per document of the files of write_files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Running totals go over the table of files, one row for some millions of
    ids, in one task.
    """
    running = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    placed = stash(files.withColumn("before", F.coalesce(F.sum("n_ids").over(running), F.lit(0))), "placed")
    spread = placed.select("path", "before").repartition(max(1, -(-placed.count() // FILES_PER_TASK)))

    def work(batches):
        for b in batches:
            for path, before in zip(b["path"].to_pylist(), b["before"].to_pylist(), strict=True):
                fs, name = open_fs(path)
                with fs.open_input_file(name) as f:
                    got = TokenFile(f.read())
                ids = memoryview(got.all_ids().astype("<u4")).cast("B")
                at = got.starts.tolist()
                yield {
                    "doc_id": pa.array(got.doc_ids, mask=got.doc_ids == NO_ID),
                    "start": pa.array(got.starts[:-1] + before),
                    "n_tokens": pa.array(np.diff(got.starts)),
                    "ids_crc32": pa.array([zlib.crc32(ids[4 * s : 4 * e]) for s, e in zip(at, at[1:], strict=False)], pa.int64()),
                }

    return map_arrow(spread, work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, folder: str, end: int = 2) -> DataFrame:
    """Writes the files and reads them: doc_id, start, n_tokens, ids_crc32 per document.

    Null and empty texts are one id, the end. Equal doc_ids lie in the order of
    their texts, null ids before all others. An empty table writes no file and
    gives an empty result. Columns other than doc_id and text are not read.
    """
    files = write_files(docs, folder, tokenizer, end)
    return read_files(stash(files.repartition(1 + files.sparkSession.sparkContext.defaultParallelism // 64), "files"))


def op7_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), default_path(), new_path(spark, "ids"))
