import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import packing, tokenfile, tokens

from .conftest import prose

PATH = tokens.default_path()


def ids_of(text):
    return tokens.encoder(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abZéÀ.,'!0९ \t\n\r\x0b\x0c\x1c\x85 İḰß中🎉<|>endoftx", max_size=40), max_size=5))
def test_encoder_equals_the_library(texts):
    texts = [*texts, "<|endoftext|> x<|EndOfText|>y", "it's we'll 'S"]
    got = [np.frombuffer(b, "<u4").tolist() for b in tokens.Encoder(PATH, capacity=3).encode(texts)]
    assert got == [ids_of(t) for t in texts]


def optimum(sizes, capacity):
    """The fewest bins, by trying all."""
    best = len(sizes)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k, room in enumerate(bins):
            if room >= sizes[i] and room not in bins[:k]:
                go(i + 1, [*bins[:k], room - sizes[i], *bins[k + 1 :]])
        go(i + 1, [*bins, capacity - sizes[i]])

    go(0, [])
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_is_optimal_and_all_is_packed(sizes):
    sizes = sorted(sizes, reverse=True)
    counts = np.zeros(21, np.int64)
    for s in sizes:
        counts[s] += 1
    left = counts.copy()
    fixed = packing.reduce_dominated(left, 20)
    rest = [s for s in range(20, 0, -1) for _ in range(int(left[s]))]
    assert sum(n for _, n in fixed) + optimum(rest, 20) == optimum(sizes, 20)
    made = packing.plan(dict(Counter(sizes)), 20)
    packed = Counter()
    for filled, n in made:
        assert sum(s * k for s, k in filled) <= 20
        for s, k in filled:
            packed[s] += k * n
    assert packed == Counter(sizes)
    assert sum(n for _, n in made) <= optimum(sizes, 20) + 1


def test_many_copies_at_once():
    made = packing.plan({4000: 10**9, 96: 10**9, 50: 7 * 10**9}, 4096)
    assert len(made) < 10
    assert sum(n for _, n in made) == 10**9 + -(-7 * 10**9 // 81)


def test_pack(docs, rows):
    got = packing.pack(docs, PATH).collect()
    want = Counter()
    for r in rows:
        ids = [*ids_of(r[1]), 1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[(r[0], k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    at = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 4096
    assert len(at) <= -(-sum(at.values()) // 4096) + 1


def test_pack_empty(empty):
    assert packing.pack(empty, PATH).collect() == []


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 31, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1001])
def test_bits(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
    data = tokenfile.pack_bits(ids, bits)
    assert len(data) == -(-n * bits // 8)
    assert (tokenfile.unpack_bits(data, n, bits) == ids).all()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 999), max_size=30), max_size=12), st.sampled_from([8, 16, 24]))
def test_file_random_access(documents, block):
    arrays = [np.array(x, np.uint32) for x in documents]
    got = tokenfile.TokenFile(tokenfile.to_file(list(range(len(arrays))), arrays, tokenfile.bits_for(1000), block))
    flat = [i for x in documents for i in x]
    assert got.all_ids().tolist() == flat
    assert [got.document(k).tolist() for k in range(len(arrays))] == documents
    for a in range(0, len(flat), 7):
        assert got.ids(a, min(len(flat), a + 20)).tolist() == flat[a : a + 20]


def test_bits_for_and_limits():
    assert [tokenfile.bits_for(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]
    with pytest.raises(ValueError):
        tokenfile.to_file([0], [np.array([8], np.uint32)], 3)
    with pytest.raises(ValueError):
        tokenfile.TokenFile(b"not a file" * 9)


def test_round_trip(spark, docs, rows, tmp_path):
    got = tokenfile.round_trip(docs, PATH, f"file://{tmp_path}/ids").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for r in ordered:
        ids = [*ids_of(r[1]), 2]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_round_trip_empty(empty, tmp_path):
    assert tokenfile.round_trip(empty, PATH, f"file://{tmp_path}/ids").collect() == []


def test_small_files_keep_order(named, rows, tmp_path):
    files = tokenfile.write_files(named, f"file://{tmp_path}/ids", PATH, ids_per_file=500, partitions=3)
    files = files.persist()
    assert files.count() > 10
    got = tokenfile.read_files(files).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted(r[0] for r in rows[:-2])


def test_windows_of_a_long_text_change_no_id(monkeypatch):
    draw = random.Random(3)
    texts = [prose(draw, 400), "x" * 900 + " y", "é\u3000中 " * 90, "\n" * 300, "a<|endoftext|>b " * 30]
    whole = list(tokens.Encoder(PATH).encode(texts, 2))
    monkeypatch.setattr(tokens, "WINDOW", 100)
    assert list(tokens.Encoder(PATH).encode(texts, 2)) == whole == [np.array([*ids_of(t), 2], "<u4").tobytes() for t in texts]
