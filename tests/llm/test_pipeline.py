import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from siltstone.llm import mixing, quality, toxicity  # noqa: E402
from siltstone.llm.tokens import default_path, encoder  # noqa: E402

from .test_classifiers import corpus, insult, junk  # noqa: E402
from .test_simhash import classes_of, slow_fingerprint  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rows, bad = corpus(500, 3, insult)
    more, poor = corpus(500, 4, junk)
    docs = [(i, t, "en", f"src{i % 3}", len(t)) for i, t, *_ in rows] + [(500 + i, t, None, None, None) for i, t, *_ in more]
    docs += [(2000, docs[3][1], "en", "src1", 1), (2001, docs[3][1] + " tail", "en", "src1", 1), (2002, None, "en", "src1", 0), (2003, "", "en", "src1", 0)]
    labels = [(i, 1, y) for i, y in bad] + [(500 + i, 1 - y, 0) for i, y in poor]
    d = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_copies", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, sf_dir).cache()
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name == "toxicity":
            good = {r["doc_id"] for r in toxicity.classify(spark.createDataFrame(before, SCHEMA), labels).collect() if not r["predicted"]}
            assert {r["doc_id"] for r in after} == good and len(good) < len(before)
        if name == "quality":
            good = {r["doc_id"] for r in quality.classify(spark.createDataFrame(before, SCHEMA), labels).collect() if r["predicted"]}
            assert {r["doc_id"] for r in after} == good and len(good) < len(before)
        if name == "near_copies":
            classes = classes_of({r["doc_id"]: slow_fingerprint(r["text"]) for r in before})
            assert sorted(r["doc_id"] for r in after) == sorted(set(classes.values()))
        if name == "mixing":
            times = {r["doc_id"]: r["times"] for r in mixing.mix(spark.createDataFrame(before, SCHEMA)).collect()}
            assert Counter(r["doc_id"] for r in after) == Counter({i: n for i, n in times.items() if n})
        if name == "packing":
            tokenizer = encoder(default_path()).tokenizer
            sizes = sum(len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in before)
            assert sum(r["length"] for r in after) == sizes
            assert len({r["sequence_id"] for r in after}) <= -(-sizes // 4096) + 1


def test_run_is_the_stages_one_after_another(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), SCHEMA)
    tokenizer = encoder(default_path()).tokenizer
    want = Counter()
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[(r["doc_id"], k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = out.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    at = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 4096


WIDE = SCHEMA + ", size long, same long, mark long, score double, y int"


def odd_rows():
    draw = random.Random(8)
    long = " ".join(f"{w}{draw.randrange(99)}" for w in ["word", "thing", "place"] * 20_000)
    rows = [(1, long, "en", "a"), (2, long + " tail", "en", "a"), (3, None, None, None), (4, "", "en", None), (5, " \n", None, "b"), (None, "no id at all here", "en", "a"), (7, "x" * 3000, "en", "b"), (8, "tie one two three four five", "en", "b"), (9, "tie one two three four five", "en", "b"), (9, "tie one two three four five", "en", "b")]
    return [(*r, 1, 2, 3, 4, 0.5, 6) for r in rows]


@pytest.mark.parametrize("kind", ["empty", "odd"])
def test_stages_bear_odd_rows(spark, sf_dir, kind):
    """An empty table, and nulls, long texts, ties, repeated rows, rows without an id and columns that operators use themselves."""
    docs = spark.createDataFrame([] if kind == "empty" else odd_rows(), WIDE)
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = stage(spark, docs, sf_dir).cache()
        if kind == "empty":
            assert docs.count() == 0
        if name != "packing":
            assert docs.schema.names == spark.createDataFrame([], WIDE).schema.names
        if name == "near_copies" and kind == "odd":
            ids = [r["doc_id"] for r in docs.collect()]
            assert len(ids) == len(set(ids)) and 2 not in ids and None in ids and before > len(ids)


def test_stages_begin_with_heaps_released(spark, sf_dir):
    """Each stage has the executors' JVMs, here the only one, collect their garbage before it works."""

    def collections():
        return sum(x.getCollectionCount() for x in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans() if "Young" not in x.getName())

    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        before = collections()
        stage(spark, docs, sf_dir)
        assert collections() > before
