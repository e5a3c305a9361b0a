import math
import os
import re
from collections import Counter

import pytest

from siltstone.llm import licenses

SCHEMA = "doc_id long, path string, text string, license string, dir string, best int"
APACHE = "Licensed under the Apache License, Version 2.0."
MIT = "Released under the MIT License."


def files(spark, rows):
    return spark.createDataFrame([(i, p, t, "x", "y", 1) for i, (p, t) in enumerate(rows)], SCHEMA)


def brute(rows, threshold=licenses.THRESHOLD):
    """Own licences by comparing every passage with every template, in plain Python."""
    split = [re.findall(licenses.TERM, licenses_lower(t or "")) for _, t in rows]
    df = Counter(x for w in split for x in set(w))
    vocabulary = set().union(*(c for _, c in licenses.template_counts()))
    idf = lambda t: math.log((1 + len(rows)) / (1 + df[t])) + 1 if t in vocabulary else math.log(1 + len(rows)) + 1
    vec = lambda c: {t: n * idf(t) for t, n in c.items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    templates = []
    for name, c in licenses.template_counts():
        v = vec(c)
        size = norm(v)
        templates.append((name, {t: w / size for t, w in v.items()}))
    aligned = []  # anchor, its place, terms of the template
    for (_, v), sequence in zip(templates, licenses.template_terms(), strict=True):
        ranked = sorted(v, key=lambda t: (-v[t], t))
        for k, t in enumerate(ranked):
            if math.sqrt(max(0, sum(v[x] ** 2 for x in ranked[k:]))) >= threshold - 1e-9:
                aligned += [(t, i, len(sequence)) for i, x in enumerate(sequence) if x == t]
    out = []
    for (p, _), words in zip(rows, split, strict=True):
        found = {(max(0, i - k), n) for t, k, n in aligned for i, x in enumerate(words) if x == t}
        if p and re.search(r"(?i)^(un)?licen[cs]e|^copying|^notice", p.rsplit("/", 1)[-1]):
            found.add((-1, len(words)))
        best = None
        for at, n in sorted(found):
            v = vec(Counter(words if at < 0 else words[at : at + n]))
            for name, m in templates:
                s = round(sum(x * m.get(k, 0) for k, x in v.items()) / norm(v), 6) if v else 0
                if s >= threshold and (best is None or s > best[1]):
                    best = (name, s, at)
        out.append(best)
    return out


def licenses_lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


ROWS = [
    ("a/LICENSE", MIT),
    ("a/x.txt", "words\nand more"),
    ("a/b/y.txt", f"top\n{APACHE}\nend"),
    ("a/b/c/z.txt", "nothing"),
    ("a/b/COPYING.md", "This work is licensed under the GNU General Public License, version 3.\nand text"),
    ("b/x.txt", "nothing"),
    ("ab/LICENSE", "no licence stated at all"),
    ("ab/x.txt", None),
    ("top.txt", ""),
    (None, MIT),
    ("a/b/long.txt", "word " * 50_000 + "\n" + MIT),
    ("d/LICENSE", f"{MIT} {MIT}"),
    ("d/e/f/g/x", "LICENSED UNDER CC BY-NC 4.0\r"),
    ("d/e/f/g/y", "licensed under terms of the version"),
    ("w/gpl.c", "/*\n * You can redistribute it and/or modify\n * it under the terms of the GNU General Public License as\n * published by the Free Software Foundation, either version 3\n * of the License, or any later version.\n */"),
    ("w/bsd.c", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met"),
    ("w/mit1", "Copyright 2019 The Authors. All rights reserved. Released under the MIT License."),
    ("w/mit2", "The module was written in 2019 and is released under the MIT License, as others."),
    ("w/apache", f"some words {APACHE} {APACHE} and more"),
    ("w/many", "license " * 3000),
    ("w/one line", " ".join(f"term{i}" for i in range(60_000)) + " license " + " ".join(f"more{i}" for i in range(60_000))),
]


def test_own(spark):
    got = {r["doc_id"]: r for r in licenses.stated(files(spark, ROWS)).collect()}
    want = brute(ROWS)
    assert {i: got[i]["own_license"] for i in got} == {i: w and w[0] for i, w in enumerate(want)}
    for i, w in enumerate(want):
        if w:
            assert abs(got[i]["own_score"] - w[1]) < 2e-6 and got[i]["own_at"] == w[2]


def test_inheritance(spark):
    got = {r["path"]: (r["license"], r["inherited_from"]) for r in licenses.scan(files(spark, ROWS)).collect()}
    assert got["a/x.txt"] == ("MIT", "a")
    assert got["a/b/y.txt"] == ("Apache-2.0", None)
    assert got["a/b/c/z.txt"] == ("GPL-3.0", "a/b")
    assert got["b/x.txt"] == (None, None) and got["ab/x.txt"] == (None, None)
    assert got["top.txt"] == (None, None) and got[None] == ("MIT", None)
    assert got["a/b/long.txt"] == ("MIT", None)
    assert got["d/e/f/g/y"] == ("MIT", "d")


def test_wrapped_and_embedded_notices(spark):
    got = {r["path"]: r["license"] for r in licenses.scan(files(spark, ROWS)).collect()}
    assert got["w/gpl.c"] == "GPL-3.0" and got["w/bsd.c"] == "BSD-3-Clause" and got["w/apache"] == "Apache-2.0"
    assert got["w/mit1"] == got["w/mit2"] == "MIT"
    assert got["w/many"] is None and got["w/one line"] is None


def test_one_directory_of_most_files(spark):
    rows = [("top/LICENSE", MIT), ("top/deep/er/COPYING", APACHE)] + [("top/deep/x%d" % i, "words") for i in range(3000)] + [("top/deep/er/est/y", "")]
    got = {r["path"]: (r["license"], r["inherited_from"]) for r in licenses.scan(files(spark, rows)).collect()}
    assert all(got[f"top/deep/x{i}"] == ("MIT", "top") for i in range(3000)) and got["top/deep/er/est/y"] == ("Apache-2.0", "top/deep/er")


def test_repeated_rows_and_empty(spark):
    twice = files(spark, ROWS[:4])
    assert licenses.scan(twice.union(twice)).count() == 4
    assert licenses.scan(files(spark, ROWS[:0])).collect() == []


def test_anchors_lose_nothing():
    for _, c in licenses.template_counts():
        norm = math.sqrt(sum(n * n for n in c.values()))
        v = {t: n / norm for t, n in c.items()}
        marks = licenses.anchors(v, 0.75)
        assert math.sqrt(sum(w * w for t, w in v.items() if t not in marks)) < 0.75


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_query_inherits_from_several_levels(spark):
    got = licenses.op1_licenses(spark, "/root/testdata/sf0.001").collect()
    assert len({r["inherited_from"].count("/") for r in got if r["inherited_from"]}) > 1
