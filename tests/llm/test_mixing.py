import re
from fractions import Fraction

from siltstone.llm import mixing


def slow_targets(sizes: dict, cap=3):
    """Clamp, share the rest, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, [] if s is None else [ord(c) for c in s]))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, open_, target = Fraction(sum(sizes.values())), set(names), {}
    while True:
        whole = sum(weight[s] for s in open_)
        level = {s: left * weight[s] / whole for s in open_} if open_ else {}
        over = {s for s in open_ if level[s] > cap * sizes[s]}
        if not over:
            return target | level
        for s in over:
            target[s] = Fraction(cap * sizes[s])
            left -= target[s]
        open_ -= over


def check(got, rows):
    sizes = {}
    for r in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
        sizes[r[3]] = sizes.get(r[3], 0) + n
    want = slow_targets(sizes)
    taken, largest = {}, {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - float(want[r["source"]])) < 1e-6 * max(1, r["target"])
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
    for s, n in taken.items():
        assert abs(n - want[s]) <= largest[s] / 2
    return taken


def test_mix(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    check(got, rows)
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["source"] or "", r["times"])
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix(docs).collect()))


def test_many_small_documents_come_close(spark):
    rows = [(i, "w " * (1 + i % 5), "en", ("b", "a", None, "ä", "z")[i % 5 if i % 3 else 0]) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    taken = check(got, [(r[0], r[1], r[2], r[3]) for r in rows])
    want = {r["source"]: r["target"] for r in got}
    assert all(abs(taken[s] - want[s]) <= 5 for s in want)


def test_one_source_and_all_stopped(spark):
    one = mixing.mix(spark.createDataFrame([(1, "a b", "s"), (2, "c", "s")], "doc_id long, text string, source string")).collect()
    assert sorted(r["taken"] for r in one) == [1, 2]
    # The small source stops at three times its size, the rest goes to the other.
    two = mixing.mix(spark.createDataFrame([(1, "a", "b"), (2, "c " * 99, "a")], "doc_id long, text string, source string")).collect()
    assert {r["source"]: r["target"] for r in two} == {"a": 97.0, "b": 3.0}


def test_empty(empty):
    assert mixing.mix(empty).collect() == []
    assert mixing.repeat_docs(empty).collect() == []


def test_repeat_docs(named):
    times = {r["doc_id"]: r["times"] for r in mixing.mix(named).collect()}
    out = mixing.repeat_docs(named)
    assert out.columns == named.columns
    counts = {}
    for r in out.collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert counts == {i: n for i, n in times.items() if n}
