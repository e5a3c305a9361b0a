import re
from unittest import mock

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import simhash
from siltstone.llm.common import components, local_components


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aAbB \t\n\x0b\x1c éß中", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB \t\x1c é", max_size=80), st.sampled_from([1, 2, 5, 16]))
def test_fingerprint_in_windows(text, size):
    with mock.patch.object(simhash, "WINDOW", size):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("within", [1, 2, 3, 4])
def test_no_link_is_lost_within(spark, within):
    """Random sets with many distances around the limit, against all pairs, for odd limits too."""
    ball = simhash.Ball(6, (within + 1) // 2)
    for seed in range(40):
        draw = np.random.default_rng(seed)
        fps = {int(draw.integers(0, 1 << 63))}
        while len(fps) < 30:
            x = int(draw.choice(list(fps)))
            for b in draw.choice(63, int(draw.integers(1, within + 3)), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
        array = np.array(sorted(fps), np.uint64)
        home = ball.home(array)
        a, b = [], []
        for bucket in range(64):
            own = array[np.isin(home ^ bucket, list(ball.masks))]
            if len(own):
                x, y = ball.links(bucket, own, within)
                a += x.tolist()
                b += y.tolist()
        assert all((x ^ y).bit_count() <= 64 for x, y in zip(a, b, strict=True))
        at = {x: i for i, x in enumerate(array.tolist())}
        label = local_components(len(array), np.array([at[x] for x in a], np.int64), np.array([at[x] for x in b], np.int64))
        want = classes_of(dict(enumerate(array.tolist())), within)
        assert label.tolist() == [want[i] for i in range(len(array))]


def classes_of(fps: dict[int, int], within=4):
    label = {i: i for i in fps}
    while True:
        new = {i: min(label[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= within) for i in fps}
        if new == label:
            return label
        label = new


def test_classes(named, rows):
    got = {r["doc_id"]: r for r in simhash.near_classes(named).collect()}
    fps = {r[0]: slow_fingerprint(r[1]) for r in rows[:-2]}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == fps
    assert {i: r["component_id"] for i, r in got.items()} == classes_of(fps)


def test_repeated_rows_and_null_ids(docs, rows):
    got = simhash.near_classes(docs).collect()
    assert len(got) == len(rows)
    assert sum(r["doc_id"] == 3 for r in got) == 2


def test_empty(empty):
    assert simhash.near_classes(empty).collect() == []
    assert simhash.keep_first(empty).collect() == []


@pytest.mark.parametrize("k", [2, 6, 9])
def test_ball_meets_exactly(k):
    draw = np.random.default_rng(k)
    centres = draw.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = []
    for c in centres.tolist():
        for n in range(10):
            fps.append(c ^ sum(1 << int(b) for b in draw.choice(64, n % 7, replace=False)))
    fps = np.unique(np.array(fps, np.uint64))
    ball = simhash.Ball(k, 2)
    dealt = [(b, fps[np.isin(ball.home(fps) ^ b, list(ball.masks))]) for b in range(1 << k)]
    links = [ball.links(b, own, 4) for b, own in dealt if len(own)]
    found = {i: i for i in range(len(fps))}
    where = {int(f): i for i, f in enumerate(fps)}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                low = min(found[where[x]], found[where[y]])
                changed |= found[where[x]] != low or found[where[y]] != low
                found[where[x]] = found[where[y]] = low
    want = classes_of({i: int(f) for i, f in enumerate(fps)})
    assert {i: min(j for j in found if found[j] == found[i]) for i in found} == want


def test_ball_deals_every_variant_once():
    ball = simhash.Ball(7, 2)
    every = np.concatenate(list(ball.masks.values()))
    assert len(every) == len(np.unique(every)) == 1 + 64 + 64 * 63 // 2
    assert all((ball.home(m) == x).all() for x, m in ball.masks.items())


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame([*path, *star, (200, 199)], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 199: 199, 200: 199}


def test_keep_first_keeps_columns_and_rows_without_id(docs):
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 1 and len(ids) == len(set(ids))
    assert 1 in ids and not {60, 61, 62} & set(ids)


def test_keep_first_of_two_texts_with_one_id(spark):
    one, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, one), (1, other), (1, other), (2, one), (0, other)]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(0, other), (1, one)]
    kept = simhash.keep_first(spark.createDataFrame(rows[:4], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, one), (1, other)]
