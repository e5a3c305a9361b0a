import itertools
import math
import random
import zlib
from collections import Counter, defaultdict
from unittest import mock

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import hpylm
from siltstone.llm.common import crc_mod

END = object()


def tokens(text):
    return [*(text or "").encode().lower().split(), END]


def scored(docs, **options):
    return hpylm.score(docs.select("doc_id", "text", (crc_mod(F.col("doc_id"), 10) == 0).alias("held_out")), **options)


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def test_counts_and_base(docs, rows):
    counts = Counter()
    for r in rows:
        if not held(r[0]):
            counts.update(tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for r in rows:
        t = tokens(r[1])
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
        want[(r[0], held(r[0]), len(t), sum(counts[x] > 0 for x in t), n, round(base, 6))] += 1
    got = scored(docs).collect()
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


SMALL = hpylm.Sizes(block=500, shard=4000, words=2000, slice=300)


def test_base_is_the_same_in_small_blocks(docs):
    """Texts over several blocks, words over several shards, restaurants over several slices."""
    whole, parts = (sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in scored(docs, sizes=x).collect()) for x in (hpylm.Sizes(), SMALL))
    assert whole == parts


def test_score_is_nearly_the_same_in_small_blocks(docs):
    whole, parts = ({(r["doc_id"], round(r["base_score"], 3)): r["score"] for r in scored(docs, sizes=x).collect()} for x in (hpylm.Sizes(), SMALL))
    assert sum(whole.values()) == pytest.approx(sum(parts.values()), rel=0.01)
    assert all(parts[k] == pytest.approx(v, rel=0.05, abs=0.5) for k, v in whole.items())


def test_better_than_base_on_new_text_of_two_languages(spark):
    draw = np.random.default_rng(0)
    rows = []
    for i in range(600):
        words = [("un", "el", "la") if i % 2 else ("the", "of", "an"), [f"{'x' if i % 2 else 'y'}{k}long" for k in range(3000)]]
        p = 1 / np.arange(1, 3001)
        text = " ".join(draw.choice(words[0]) if draw.random() < 0.3 else words[1][int(draw.choice(3000, p=p / p.sum()))] for _ in range(60))
        rows.append((i, text))
    got = [r for r in scored(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got) + 0.05 * sum(r["n_tokens"] for r in got)


def stirling(c, t, d):
    """Generalised Stirling numbers by their recursion, in plain Python."""
    if t < 1 or t > c:
        return 0.0
    return 1.0 if c == 1 else stirling(c - 1, t - 1, d) + (c - 1 - d * t) * stirling(c - 1, t, d)


@pytest.mark.parametrize("d", [0.05, 0.2, 0.5, 0.8, 0.95])
def test_chance_to_sit_alone(d):
    alone = hpylm.Alone(d)
    for c in (1, 2, 3, 7, 11):
        t = np.arange(1, c + 1)
        want = [1.0 if c == 1 else stirling(c - 1, x - 1, d) / stirling(c, x, d) for x in t]
        assert alone(np.full(c, c), t) == pytest.approx(want, abs=1e-9)
    # Beyond the table, against the exact recursion in logarithms.
    with mock.patch.object(hpylm, "TABLED", 1500):
        exact = hpylm.tabled(d)
    for c in (300, 700, 1500):
        t = np.array([1, 2, 5, 20, 100, c // 2, c - 5, c])
        assert alone(np.full(len(t), c), t) == pytest.approx(exact[c, t], rel=0.06, abs=0.003)


@pytest.mark.parametrize("d", [0.2, 0.5, 0.8])
@pytest.mark.parametrize(("c", "strength", "base"), [(2, 0.5, 0.3), (7, 1.0, 0.05), (12, 5.0, 0.2), (12, 0.3, 0.9)])
def test_moves_have_the_exact_conditional(d, c, strength, base):
    """One customer at a time leaves and sits down; in the long run tables are as the exact conditional says, alone and beside other dishes."""
    draw = np.random.default_rng(3)
    for others in (0, 4):
        weights = [stirling(c, t, d) * math.prod((strength + d * (others + k)) * base for k in range(t)) for t in range(1, c + 1)]
        want = np.array(weights) / sum(weights)
        n = 20_000
        t = np.ones(n)
        for _ in range(12 * c):
            t = hpylm.move(np.full(n, c), t, np.full(n, float(others)), np.full(n, base), strength, hpylm.Alone(d), draw)
        assert np.bincount(t.astype(int), minlength=c + 1)[1:] / n == pytest.approx(want, abs=0.015)


def test_dishes_of_one_restaurant_against_all_their_seatings():
    """Three dishes of one restaurant, all numbers of tables enumerated."""
    d, strength, c, base = 0.6, 0.8, [2, 4, 3], [0.3, 0.1, 0.25]
    want, whole = np.zeros(3), 0.0
    for t in itertools.product(*(range(1, n + 1) for n in c)):
        w = math.prod(strength + d * k for k in range(sum(t))) * math.prod(stirling(n, x, d) * b**x for n, x, b in zip(c, t, base, strict=True))
        want, whole = want + w * np.array(t), whole + w
    n = 8000
    inn, cs, p = np.repeat(np.arange(n), 3), np.tile(c, n), np.tile(base, n)
    t = hpylm.sweep(inn, cs, np.ones(3 * n), np.full(n, 3.0), p, strength, hpylm.Alone(d), np.random.default_rng(5), 60)
    assert t.reshape(n, 3).mean(axis=0) == pytest.approx(want / whole, rel=0.02)


def test_probabilities_add_up_to_one():
    draw = np.random.default_rng(1)
    words, inns = 60, 9
    counts = draw.poisson(0.6, (inns, words)) * draw.integers(1, 30, (1, words))
    counts[:, counts.sum(axis=0) == 0] = 1
    inn, word = (x.ravel() for x in np.indices((inns, words)))
    c = counts.ravel()
    t = np.minimum(c, draw.integers(1, 5, len(c)))
    kept = {"inn": inn, "word": word, "c": c, "total": counts.sum(axis=1)}
    customers = np.bincount(word, t, words)
    tables = np.minimum(customers, draw.integers(1, 4, words))
    now = hpylm.Settings(words, customers.sum(), tables.sum(), 0.6, 0.4, 2.0, 1.5)
    parent = now.parent(customers, tables)
    of = np.bincount(inn, t, inns)
    p = hpylm.sample_of(kept, t.astype(float), of, parent, now).reshape(inns, words)
    back = (now.strength + now.discount * of) / (now.strength + kept["total"])
    assert np.allclose(p.sum(axis=1) + back * now.parent(np.zeros(1), np.zeros(1)), 1)


def slow_model(texts, held, sweeps, burn, seed=0):
    """A hierarchical Pitman-Yor model in plain Python: explicit tables, one customer after another, averaged probabilities of each text."""
    draw = random.Random(seed)
    begin = object()
    pairs = [list(zip([begin, *tokens(t)], tokens(t), strict=False)) for t in texts]
    counts = Counter(p for x, h in zip(pairs, held, strict=True) if not h for p in x)
    words = {w for _, w in counts}
    v = len(words)
    d1 = hpylm.discount_of(sum(n == 1 for n in counts.values()), sum(n == 2 for n in counts.values()))
    inns = Counter(w for _, w in counts)
    d0 = hpylm.discount_of(sum(n == 1 for n in inns.values()), sum(n == 2 for n in inns.values()))
    s1 = s0 = 1.0
    sizes = defaultdict(list)  # (inn or None, word): customers of each table
    n_tables, customers = Counter(), Counter()

    def parent_p(w):
        return (sum(sizes[None, w]) - d0 * len(sizes[None, w]) + (s0 + d0 * n_tables[None]) / (v + 1)) / (s0 + customers[None])

    def own_p(u, w):
        return (sum(sizes[u, w]) - d1 * len(sizes[u, w]) + (s1 + d1 * n_tables[u]) * parent_p(w)) / (s1 + customers[u])

    def add(u, w):
        d, s, p = (d0, s0, 1 / (v + 1)) if u is None else (d1, s1, parent_p(w))
        at = sizes[u, w]
        k = draw.choices(range(len(at) + 1), [*(x - d for x in at), (s + d * n_tables[u]) * p])[0]
        customers[u] += 1
        if k < len(at):
            at[k] += 1
            return
        at.append(1)
        n_tables[u] += 1
        if u is not None:
            add(None, w)

    def leave(u, w):
        at = sizes[u, w]
        k = draw.choices(range(len(at)), at)[0]
        customers[u] -= 1
        at[k] -= 1
        if not at[k]:
            at.pop(k)
            n_tables[u] -= 1
            if u is not None:
                leave(None, w)

    seats = list(counts.elements())
    for u, w in seats:
        add(u, w)
    total = np.zeros(len(texts))
    p = defaultdict(float)
    asked = {x for t in pairs for x in t}
    for sweep in range(sweeps):
        draw.shuffle(seats)
        for u, w in seats:
            leave(u, w)
            add(u, w)
        inns_now = [u for u in n_tables if u is not None and n_tables[u]]
        s1 = float(hpylm.STRENGTHS[hpylm.likelihoods(np.array([customers[u] for u in inns_now]), np.array([n_tables[u] for u in inns_now]), d1).argmax()])
        s0 = float(hpylm.STRENGTHS[hpylm.likelihoods(np.array([customers[None]]), np.array([n_tables[None]]), d0).argmax()])
        if sweep >= burn:
            for x in asked:
                p[x] += own_p(*x) / (sweeps - burn)
    for i, x in enumerate(pairs):
        total[i] = sum(math.log10(p[y]) for y in x)
    return total


def test_scores_are_those_of_a_plain_model(spark):
    draw = np.random.default_rng(4)
    p = 1 / np.arange(1, 61)
    rows = []
    for i in range(60):
        words, at = [], 0
        for _ in range(25):
            at = (3 * at + int(draw.choice(60, p=p / p.sum()))) % 60 if draw.random() < 0.6 else int(draw.choice(60, p=p / p.sum()))
            words.append(f"w{at}")
        rows.append((i, " ".join(words)))
    want = slow_model([t for _, t in rows], [held(i) for i, _ in rows], 60, 20)
    got = {r["doc_id"]: r["score"] for r in scored(spark.createDataFrame(rows, "doc_id long, text string"), rounds=20, burn=12).collect()}
    got = np.array([got[i] for i, _ in rows])
    assert got.sum() == pytest.approx(want.sum(), rel=0.01)
    assert np.abs(got / want - 1).max() < 0.03


def test_long_text_over_blocks_keeps_its_contexts(spark):
    """A text's pairs don't depend on where blocks end: the repeated pair is learnt alike."""
    rows = [(i, "a b " * 300) for i in range(1, 4)]
    whole, parts = (hpylm.score(spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", F.lit(False)), sizes=x).collect() for x in (hpylm.Sizes(), hpylm.Sizes(block=7)))
    assert {r["n_tokens"] for r in parts} == {601}
    assert sorted(r["score"] for r in parts) == pytest.approx(sorted(r["score"] for r in whole), rel=0.05)


def test_arrays_survive_packing():
    draw = np.random.default_rng(0)
    arrays = {"a": np.sort(draw.integers(-(1 << 62), 1 << 62, 99)), "b": draw.integers(0, 9, 7).astype(np.int32), "c": np.zeros(0), "d": np.array([True, False]), "e": np.sort(draw.integers(0, 1 << 63, 5).astype(np.uint64)), "f": draw.random(3).astype(np.float32)}
    got = hpylm.load(hpylm.dump(**arrays))
    assert all(np.array_equal(x, got[k]) and x.dtype == got[k].dtype for k, x in arrays.items())


def test_empty_and_no_training(spark, empty):
    assert scored(empty).collect() == []
    only = next(i for i in range(100) if held(i))
    got = scored(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got] == [(3, 0, 0, 0.0)]
    assert abs(got[0]["score"]) < 1e-6
