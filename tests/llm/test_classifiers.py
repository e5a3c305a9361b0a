import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import labelled, quality, toxicity

from .conftest import prose


def slow_segments(s):
    """Ruzzo and Tompa's definition: a best segment of the whole, then those of what is left of and right of it."""
    best = max(((sum(s[a:b]), -a, -(b - a)) for a in range(len(s)) for b in range(a + 1, len(s) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    a, b = -best[1], -best[1] - best[2]
    return [*slow_segments(s[:a]), (a, b, best[0]), *[(x + b, y + b, z) for x, y, z in slow_segments(s[b:])]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=14))
def test_segments(s):
    s = [x + 0.01 * (i + 1) ** 0.5 for i, x in enumerate(s)]  # no ties
    got = toxicity.segments(np.array(s, float))
    assert [x[:2] for x in got] == [x[:2] for x in slow_segments(s)]
    assert [x[2] for x in got] == pytest.approx([sum(s[a:b]) for a, b, _ in got])
    for a, b, total in got:  # every prefix and suffix is positive
        assert all(sum(s[a:k]) > 0 for k in range(a + 1, b + 1)) and all(sum(s[k:b]) > 0 for k in range(a, b))


def corpus(n, seed, bad):
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        y = int(draw.random() < 0.3)
        rows.append((i, bad(prose(draw, draw.randrange(20, 120)), draw) if y else prose(draw, draw.randrange(20, 120)), "en", "s", 1, 2, "k", 0.5))
        labels.append((i, y))
    return rows, labels


def insult(text, draw):
    words = text.split()
    for _ in range(draw.randrange(1, 4)):
        words.insert(draw.randrange(len(words)), draw.choice(["grumbler", "nastyface", "villain" + draw.choice("abcdefgh")]))
    return " ".join(words)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, score double"


@pytest.fixture(scope="module")
def toxic(spark):
    rows, labels = corpus(900, 1, insult)
    rows += [(1000, None, "en", "s", 1, 2, "k", 0.5), (1001, "", "en", "s", 1, 2, "k", 0.5), (1002, prose(random.Random(9), 20_000), "en", "s", 1, 2, "k", 0.5), rows[0], (None, "no id", "en", "s", 1, 2, "k", 0.5)]
    frame = spark.createDataFrame([(i, 1, y, "x") for i, y in labels] + [(None, 1, 1, "x"), (5, None, None, "x")], "doc_id long, quality int, toxic int, text string")
    return spark.createDataFrame(rows, SCHEMA), frame, dict(labels), rows


def accuracy(got, truth):
    own = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(own) > 100
    return np.mean([r["predicted"] == truth[r["doc_id"]] for r in own])


def test_toxicity(toxic):
    docs, labels, truth, rows = toxic
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert accuracy(got, truth) > 0.97
    by = {r["doc_id"]: r for r in got}
    assert by[1000]["score"] == by[1001]["score"] and not by[1002]["predicted"]
    assert all(r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 3 == 1) for r in got)
    again = toxicity.classify(docs, labels).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_toxic_spans_hold_the_insults(toxic):
    docs, labels, truth, _ = toxic
    model = toxicity.learn(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in toxicity.spans(docs, model).collect():
        words = (texts[r["doc_id"]] or "").encode().lower().split()[r["start"] : r["end"]]
        assert any(w.startswith((b"grum", b"nast", b"vill")) for w in words)


def test_clean_only(toxic):
    docs, labels, truth, _ = toxic
    kept = toxicity.clean_only(docs, labels)
    assert kept.schema == docs.schema
    predicted = {r["doc_id"]: r["predicted"] for r in toxicity.classify(docs, labels).collect()}
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == sorted(str(r["doc_id"]) for r in docs.collect() if not predicted[r["doc_id"]])


def junk(text, draw):
    words = text.split()
    kind = draw.randrange(3)
    if kind == 0:
        return text.upper() + "!!"
    if kind == 1:
        return " | ".join(words)
    return " ".join([words[0]] * 30 + words)


@pytest.fixture(scope="module")
def poor(spark):
    rows, labels = corpus(900, 2, junk)
    rows += [(1000, None, "en", "s", 1, 2, "k", 0.5), (1001, " ", "en", "s", 1, 2, "k", 0.5), (1002, prose(random.Random(9), 20_000), "en", "s", 1, 2, "k", 0.5), rows[0], (None, "no id", "en", "s", 1, 2, "k", 0.5)]
    frame = spark.createDataFrame([(i, 1 - y, 0) for i, y in labels] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    return spark.createDataFrame(rows, SCHEMA), frame, {i: 1 - y for i, y in labels}, rows


def test_quality(poor):
    docs, labels, truth, rows = poor
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert accuracy(got, truth) > 0.97
    by = {r["doc_id"]: r for r in got}
    assert by[1000]["score"] == by[1001]["score"] and by[1002]["predicted"]
    kept = quality.good_only(docs, labels)
    assert kept.schema == docs.schema
    predicted = {r["doc_id"]: r["predicted"] for r in got}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in docs.collect() if predicted[r["doc_id"]])


def slow_features(text):
    """Each feature of a text by plain Python: words, n-grams in a word between blanks, and the token for a repeat."""
    words = text.encode("utf-32-le", "surrogatepass")
    words = "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" ")
    words = [w for w in words if w]
    found = [("word", w) for w in words] + [("same",) for a, b in zip(words, words[1:], strict=False) if a == b]
    for w in words:
        w = f" {w} "
        found += [("gram", w[i : i + n]) for n in quality.GRAMS for i in range(len(w) - n + 1)]
    return found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab é\n", max_size=60), max_size=5), st.sampled_from([4, 9, 1 << 18]))
def test_features_are_those_of_plain_python(texts, size):
    """Equal features have equal rows, whatever windows a text is read in (words here are shorter than a window)."""
    from unittest import mock

    texts = [" ".join(w[:3] for w in t.split(" ")) for t in texts]
    with mock.patch.object(quality, "ROUND", size):
        if any(len(w) >= size for t in texts for w in t.split()):
            return
        got = [[] for _ in texts]
        for rows, owners in quality.features(texts, 30):
            for r, o in zip(rows.tolist(), owners.tolist(), strict=True):
                got[o].append(r)
    for t, g in zip(texts, got, strict=True):
        want = slow_features(t)
        assert len(g) == len(want) and len(set(g)) == len(set(want))


def slow_train(bags, y, bits, dim, epochs, rate=0.5, seed=42):
    """The network of train, step by step, in plain Python over lists."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32).astype(float).tolist()
    out, bias = [[0.0] * dim, [0.0] * dim], [0.0, 0.0]
    classes = [np.flatnonzero(y == k) for k in (0, 1)]
    n = max(map(len, classes))
    steps, done = epochs * 2 * n, 0
    for _ in range(epochs):
        turns = np.stack([np.concatenate([draw.permutation(c) for _ in range(-(-n // len(c)))])[:n] for c in classes], axis=1).ravel()
        for i in turns.tolist():
            step = rate * (1 - done / steps)
            done += 1
            rows, share = (x.tolist() for x in bags[i])
            hidden = [sum(s * vectors[r][k] for r, s in zip(rows, share, strict=True)) for k in range(dim)]
            z = [sum(a * b for a, b in zip(o, hidden, strict=True)) + c for o, c in zip(out, bias, strict=True)]
            e = [math.exp(v - max(z)) for v in z]
            g = [v / sum(e) - (k == y[i]) for k, v in enumerate(e)]
            back = [g[0] * out[0][k] + g[1] * out[1][k] for k in range(dim)]
            for r, s in zip(rows, share, strict=True):
                for k in range(dim):
                    vectors[r][k] -= step * math.sqrt(len(rows)) * s * back[k]
            for j in (0, 1):
                bias[j] -= step * g[j]
                for k in range(dim):
                    out[j][k] -= step * g[j] * hidden[k]
    return vectors, out, bias


def test_scores_are_the_trained_network(spark):
    """Vectors averaged and put through the softmax by plain Python give the scores of the model, which keeps one number a row."""
    texts, y = ["good words here", "BAD BAD BAD!!", "more good words", "BAD!! WORSE!!", "words here", "BAD WORSE"], np.array([1, 0, 1, 0, 1, 0])
    bags = quality.bags_of(texts, 10)
    model = quality.train(bags, y, np.ones(6, bool), bits=10, dim=5, epochs=20)
    vectors, out, bias = slow_train(bags, y, 10, 5, 20)
    odds = model.odds([*texts, "BAD words, all new", ""])
    for i, text in enumerate([*texts, "BAD words, all new"]):
        rows = np.concatenate([r for r, _ in quality.features([text], 10)])
        mean = [sum(vectors[r][k] for r in rows.tolist()) / len(rows) for k in range(5)]
        z = [sum(a * b for a, b in zip(o, mean, strict=True)) + c for o, c in zip(out, bias, strict=True)]
        assert odds[i] == pytest.approx(z[1] - z[0], rel=1e-3, abs=1e-3)
    assert (odds[:6][y == 1] > odds[:6][y == 0].max()).all()
    whole = quality.fit(spark, texts, y, np.ones(6), bits=10, dim=5, epochs=20)
    p = whole.probability(texts)
    assert p == pytest.approx(1 / (1 + np.exp(-(whole.slope * odds[:6] + whole.intercept))), rel=1e-3)
    assert whole.probability(["", " \n"]).tolist() == [0.5, 0.5]


def slow_score(model, text):
    """A toxicity score by plain Python: log-odds of words or of their longest known beginnings, all pairs of ends searched for segments."""
    known = dict(zip(model.keys.tolist(), model.values.tolist(), strict=True))
    scores = []
    for w in text.split():
        h, _, cp, starts, ends = next(toxicity.read([w]))
        begin = [int(x) for x in toxicity.beginnings(cp, starts, ends)[0] if x]
        scores.append(next((known[k] for k in [int(h[0]), *begin[::-1]] if k in known), model.rest))
    total = 0.0
    for _, _, s in slow_segments(scores):
        chance = model.k * max(len(scores), 1) * math.exp(-model.rate * s)
        if chance < toxicity.SIGNIFICANT:
            total -= math.log10(chance)
    return 1 / (1 + math.exp(-min(30, max(-30, model.slope * total + model.intercept))))


def test_toxicity_scores_are_those_of_plain_python(toxic):
    docs, labels, _, _ = toxic
    model = toxicity.learn(docs, labels)
    texts = [r["text"] for r in docs.collect() if r["text"] and len(r["text"]) < 400][:40] + ["", "grumbler", "villainous nastyface grumblers " * 8]
    got = model.probability(np.array([model.evidence(s) for s in model.scores(texts)]))
    assert got.tolist() == pytest.approx([slow_score(model, t) for t in texts], abs=1e-9)
    assert got[-1] > 0.99


def test_windows_of_long_texts_change_nothing(toxic, monkeypatch):
    docs, labels, _, rows = toxic
    model = toxicity.learn(docs, labels)
    text = " ".join(r[1] or "" for r in rows[:200])
    whole = model.scores([text, rows[0][1]])
    bags = quality.bags_of([text])
    for where in (quality, toxicity):
        monkeypatch.setattr(where, "ROUND", 500)
    parts = model.scores([text, rows[0][1]])
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))
    again = quality.bags_of([text])
    assert np.array_equal(bags.rows, again.rows) and np.allclose(bags.shares, again.shares)


def test_bags_take_little_memory():
    """Beside the bags, at most 6 bytes for a distinct feature of a text here, one round's features are held."""
    draw = random.Random(6)
    texts = [prose(draw, 400) for _ in range(2500)]
    list(quality.features(texts[:200]))  # tables that are kept
    tracemalloc.start()
    bags = quality.bags_of(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(bags.rows) > 2_000_000
    assert peak < 6 * len(bags.rows) + 200 * quality.ROUND


def test_bags_are_counts_of_rows(monkeypatch):
    """Counts of one, two and more bytes, and texts in one round and in several."""
    texts = ["a b", "", "again " * 400, "x" * 70_000, " \t"]
    for size in (quality.ROUND, 300):
        monkeypatch.setattr(quality, "ROUND", size)
        bags = quality.bags_of(texts)
        for i in range(len(texts)):
            n = Counter(x for rows, owners in quality.features(texts) for x in rows[owners == i].tolist())
            rows, shares = bags[i]
            assert rows.tolist() == sorted(n) and shares.tolist() == [n[x] / max(1, n.total()) for x in sorted(n)]


@pytest.mark.parametrize("kind", ["none", "one class", "no rows"])
def test_without_labels_or_rows(spark, empty, docs, kind):
    labels = spark.createDataFrame([] if kind == "none" else [(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    table = empty if kind == "no rows" else docs
    for f in (quality.classify, toxicity.classify):
        got = f(table, labels).collect()
        assert len(got) == table.count() and all(0 <= r["score"] <= 1 for r in got)


def test_sample_is_bounded_and_weighed(spark, docs):
    labels = spark.createDataFrame([(i, int(i < 50)) for i in range(60)], "doc_id long, toxic int")
    from pyspark.sql import functions as F

    texts, y, weight = labelled.sample(docs, labels, "toxic", F.lit(True), 8)
    assert len(texts) <= 18 and weight[y == 1].sum() / weight.sum() == pytest.approx(50 / 60)


def test_sample_is_ordered_deduplicated_and_bounded_in_bytes(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i % 40, f"{'x' * 100}{i}") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(40)] * 2 + [(3, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    got = [labelled.sample(docs.repartition(n), labels.repartition(n), "toxic", F.lit(True), 12) for n in (1, 7)]
    assert got[0][0] == got[1][0] and np.array_equal(got[0][1], got[1][1]) and len(got[0][0]) == 24
    texts, y, weight = labelled.sample(docs, labels, "toxic", F.lit(True), 100)
    assert len(texts) == 39 and (y == 1).sum() == 19  # the id of both labels is left out, of two texts of an id the least is read
    assert all(int(t[100:]) < 40 or str(int(t[100:]) - 40) > t[100:] for t in texts)
    texts, _, _ = labelled.sample(docs, labels, "toxic", F.lit(True), 100, most_bytes=310)
    assert len(texts) == 6
