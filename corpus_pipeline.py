"""A training corpus in five stages: toxic documents go, then poor ones, then near copies; sources are mixed to target weights and what is left is packed into sequences.

Each stage is written to the shared folder as Parquet and read again by the
next, so a lost executor costs no earlier stage. Before each stage the
executors return the heap that the one before has filled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import mixing, nearcopies, packing, quality, toxicity
from siltstone.llm.common import release, stash, table
from siltstone.llm.tokens import default_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is not toxic (operator 10).

    Null and empty texts have no toxic passage and stay unless labels say that
    most are toxic. Repeated rows and rows without an id are judged like any
    other. All columns stay; an empty table stays empty.
    """
    release(spark)
    return toxicity.clean_only(docs, table(spark, sf_dir, "labels"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality (operator 5).

    Null and empty texts score the share of good labels. Repeated rows and rows
    without an id are judged like any other. All columns stay; an empty table
    stays empty.
    """
    release(spark)
    return quality.good_only(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (operator 9): candidates by SimHash and by bands, linked at a Jaccard likeness of five-word shingles of 0.8 or more.

    Of a class the smallest doc_id stays, of its texts the one of the smallest
    hash, once. Texts without words, null ones too, are one class. Rows without
    an id can't be named and all stay. All columns stay; an empty table stays
    empty.
    """
    release(spark)
    return nearcopies.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it (operator 3).

    Null sources are a source of their own, the last. Texts without words have
    size 0 and are taken at most once. Repeated rows count one by one. All
    columns stay; an empty table stays empty.
    """
    release(spark)
    return mixing.repeat_docs(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, repeats included, and their places in sequences (operator 6).

    Null and empty texts are one id, the end. Repeated rows and rows without an
    id are pieces of their own. An empty table gives an empty result.
    """
    release(spark)
    cut = packing.cut(docs, default_path())
    release(spark)
    return packing.placed(cut)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifiers nor packing; tests hold run() against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs, name)
    return docs
