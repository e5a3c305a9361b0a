import numpy as np

from siltstone.llm import nearcopies, simhash

SCHEMA = "doc_id long, text string"


def jaccard(a, b, k=5):
    a, b = ({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b)


def edited(words, draw, n):
    words = list(words)
    for at in draw.choice(len(words) // 10, n, replace=False):
        words[at * 10] = f"new{draw.integers(10**9)}"
    return words


def test_pairs_beyond_four_bits_fall_together(spark):
    draw = np.random.default_rng(3)
    rows = []
    for i in range(40):
        words = [f"w{x}" for x in draw.integers(0, 10**6, 120)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(edited(words, draw, 2 if i % 2 else 5)))]
    near = {i for i in range(40) if jaccard(rows[2 * i][1], rows[2 * i + 1][1]) >= 0.8}
    apart = [(simhash.fingerprint(rows[2 * i][1], 5) ^ simhash.fingerprint(rows[2 * i + 1][1], 5)).bit_count() > 4 for i in near]
    assert 0 < len(near) < 40 and any(apart)
    got = {r["doc_id"] for r in nearcopies.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {2 * i for i in range(40)} | {2 * i + 1 for i in range(40) if i not in near}


def test_one_large_class(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "SMALL", 4)
    draw = np.random.default_rng(4)
    words = [f"w{x}" for x in range(200)]
    rows = [(i, " ".join(edited(words, draw, 2))) for i in range(150)]
    got = nearcopies.keep_first(spark.createDataFrame([*rows, (500, " ".join(words[::-1]))], SCHEMA)).collect()
    assert [r["doc_id"] for r in sorted(got)] == [0, 500]


def test_repeated_ids_rows_and_none(spark, empty):
    rows = [(1, "one two three"), (1, "one  two three"), (1, "quite another text"), (2, "One two three"), (None, "one two three"), (3, None), (4, " ")]
    got = nearcopies.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"] or 0) for r in got) == [0, 1, 1, 3]
    assert "quite another text" in {r["text"] for r in got}
    assert nearcopies.keep_first(empty).collect() == []


def classes_of(texts, least=0.8):
    """The smallest number that links of at least `least` reach, all pairs compared."""
    label = list(range(len(texts)))
    near = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(texts[i], texts[j]) >= least]
    while any(label[i] != label[j] for i, j in near):
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
    return label


def test_no_link_of_a_large_bucket_is_lost(spark, monkeypatch):
    """Two texts with the same places changed are alike, those of others are not, and the hub of their buckets is like neither."""
    monkeypatch.setattr(nearcopies, "SMALL", 2)
    draw = np.random.default_rng(6)
    texts = []
    for _ in range(60):
        at = draw.choice(20, 4, replace=False) * 10
        for _ in range(2):
            words = [f"w{x}" for x in range(200)]
            for i in at:
                words[i] = f"new{draw.integers(10**9)}"
            texts.append(" ".join(words))
    want = classes_of(texts)
    assert 30 <= len(set(want)) <= 60
    got = nearcopies.keep_first(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(set(want))


def test_links_without_any_first_step(spark, monkeypatch):
    """The second step alone finds all links, in blocks and with frequent shingles too."""
    draw = np.random.default_rng(7)
    bases = [[f"{k}w{x}" for x in range(100 + 40 * k)] for k in range(4)]
    texts = [" ".join(edited(bases[i % 4], draw, int(draw.integers(0, 4)))) for i in range(120)] + ["", "one two", "One  two", "one"]
    want = classes_of(texts)
    monkeypatch.setattr(nearcopies, "candidates", lambda distinct: distinct.select(nearcopies.F.col("same").alias("a"), nearcopies.F.col("same").alias("b")).limit(0))
    for block, frequent in ((2048, 100_000), (7, 0)):
        monkeypatch.setattr(nearcopies, "BLOCK", block)
        monkeypatch.setattr(nearcopies, "FREQUENT", frequent)
        got = nearcopies.keep_first(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
        assert sorted(r["doc_id"] for r in got) == sorted(set(want))


def test_bounds_lose_nothing():
    draw = np.random.default_rng(8)
    for _ in range(300):
        n = int(draw.integers(1, 2000))
        pool = np.unique(draw.integers(0, 1 << 63, n * 2, dtype=np.uint64))
        x = np.sort(draw.choice(pool, min(n, len(pool)), replace=False))
        y = np.unique(np.concatenate((x[draw.random(len(x)) < 0.9], pool[draw.random(len(pool)) < 0.05])))
        common = len(np.intersect1d(x, y))
        if not len(y) or common < 0.8 * (len(x) + len(y) - common):
            continue
        known = np.sort(draw.choice(pool, len(pool) // 3, replace=False))
        counts = draw.integers(1, 9, len(known))
        assert len(np.intersect1d(nearcopies.prefix(x, 0.8, known, counts), nearcopies.prefix(y, 0.8, known, counts)))
        assert nearcopies.apart(nearcopies.parities(x), nearcopies.parities(y)) <= len(x) + len(y) - 2 * common <= nearcopies.most_apart(len(x), len(y), 0.8)
