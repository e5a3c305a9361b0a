import hashlib

import numpy as np

from siltstone.llm import oph


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_pairs(named, rows):
    got = {r["doc_id"]: r for r in oph.fingerprint_pairs(named).collect()}
    ordered = sorted(rows[:-2], key=lambda r: r[0])
    texts = [r[1] or "" for r in ordered]
    assert sorted(got) == [r[0] for r in ordered]
    errors = []
    for k, r in enumerate(ordered):
        nxt = texts[(k + 1) % len(texts)]
        n = len(texts[k]) // 2
        changed = texts[k][: len(texts[k]) - n] + nxt[:n]
        row = got[r[0]]
        assert row["n_chars"] == len(texts[k])
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = shingles(texts[k]), shingles(changed), shingles(nxt)
        errors += [row["near_edited"] - jaccard(a, b), row["near_next"] - jaccard(a, c)]
        sketch = oph.sketches([texts[k].encode().lower(), changed.encode().lower()])
        assert row["fingerprint"] == oph.to_text(sketch[0]) and row["edited_fingerprint"] == oph.to_text(sketch[1])
        assert abs(float(oph.likeness(sketch[0], sketch[1])) - row["near_edited"]) < 1e-12
    assert max(map(abs, errors)) < 0.15 and np.sqrt(np.mean(np.square(errors))) < 0.04
    equal = {}
    for r in ordered:
        equal.setdefault((r[1] or ""), set()).add(got[r[0]]["fingerprint"])
    assert all(len(v) == 1 for v in equal.values())


def test_bias_is_corrected():
    draw = np.random.default_rng(1)
    found = []
    for share in (0.0, 0.5, 0.9):
        for _ in range(30):
            a = [f"w{i}" for i in draw.integers(0, 10**9, 400)]
            b = a[: int(400 * share)] + [f"v{i}" for i in draw.integers(0, 10**9, 400 - int(400 * share))]
            s = oph.sketches([" ".join(a).encode(), " ".join(b).encode()])
            found.append(float(oph.likeness(s[0], s[1])) - jaccard(shingles(" ".join(a)), shingles(" ".join(b))))
    assert abs(np.mean(found)) < 0.01


def test_bits_round_trip():
    x = np.random.default_rng(0).integers(0, 16, 512).astype(np.uint8)
    assert (oph.from_text(oph.to_text(x)) == x).all()


def test_nulls_repeats_single_empty(spark, docs, rows, empty):
    assert oph.fingerprint_pairs(docs).count() == len(rows)
    assert oph.fingerprint_pairs(empty).collect() == []
    one = oph.fingerprint_pairs(spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    none = oph.sketches([b"", b" \t"])
    assert not none.any() and oph.likeness(none[0], none[1]) == 1.0


def test_a_third_without_id_are_many_ranges(spark):
    rows = [(None, f"text {i} of none") for i in range(300)] + [(5, f"five {i}") for i in range(200)] + [(i, f"doc {i}") for i in range(100, 500)]
    got = oph.fingerprint_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    ids = [r["doc_id"] for r in got]
    assert ids.count(None) == 300 and ids.count(5) == 200
    # Each row has the edit by the next one in a ring of all rows: edited texts name a successor each, and no successor twice.
    texts = [t for _, t in rows]
    by_hash = {}
    for t in texts:
        for u in texts:
            by_hash.setdefault(hashlib.sha256(oph.edited(t, u).encode()).hexdigest(), set()).add(t)
    for r in got:
        assert r["edited_sha256"] in by_hash
    keys, subs = oph.cuts_of([-5, -5, -5, 7, 9], -5)
    assert list(zip(keys, subs))[-2:] == [(7, -(1 << 63)), (9, -(1 << 63))] and (keys == -5).sum() == 3
    at = oph.range_at(keys, subs, np.array([-5, -5, 6, 7, 100]), np.array([-(1 << 63), (1 << 63) - 1, 0, 0, 0]))
    assert at.tolist() == [0, 3, 3, 4, 5]
