"""Licence scans: what licence a file states, or inherits from a directory above it.

A text is the sequence of its terms, whatever lines they stand on. Passages of
it are compared to licence templates by the cosine of sparse TF-IDF vectors,
with document frequencies over all texts. A passage has as many terms as a
template and lies where an anchor of the template stands where the template
has it; the whole of a licence file is a passage too. So notices are found that
are wrapped over lines, stand inside a sentence or were edited a little. A file
that states nothing takes the licence of the nearest directory above it that
has a licence file. All of it is DataFrame code: a text never leaves the JVM.

The anchors of a template are its heaviest terms, without which what is left of
it is shorter than the threshold: a passage without one can't reach it.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import stash, table

#: Usual notices of public licences, by SPDX identifier.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause Simplified License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal."),
    ("EPL-2.0", "This program is made available under the terms of the Eclipse Public License 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("ISC", "Licensed under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = "[a-z0-9]+"
LICENCE_FILE = "(?i)^(un)?licen[cs]e|^copying|^notice"
THRESHOLD = 0.75


def terms(text: Column) -> Column:
    """All terms of a text, with repeats: runs of ASCII letters and digits, lower-cased."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def template_counts() -> list[tuple[str, Counter]]:
    return [(name, Counter(re.findall(TERM, text.lower()))) for name, text in TEMPLATES]


def template_terms() -> list[list[str]]:
    return [re.findall(TERM, text.lower()) for _, text in TEMPLATES]


def idf(n_docs: int, df: int) -> float:
    return math.log((1 + n_docs) / (1 + df)) + 1


def frequencies(files: DataFrame) -> tuple[int, dict[str, int]]:
    """The number of files, and how many have each term of the templates; the driver gets a row per template term."""
    vocabulary = sorted(set().union(*(c for _, c in template_counts())))
    found = F.array_intersect(terms(F.col("text")), F.array(*map(F.lit, vocabulary)))
    rows = files.select(F.explode(F.array_append(found, F.lit(""))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["term"]: r["n"] for r in rows}
    return counts.pop("", 0), counts


def anchors(v: dict[str, float], threshold: float) -> set[str]:
    """Of a template of length 1 the heaviest terms, as many that the rest is shorter than the threshold."""
    found: set[str] = set()
    left = sum(w * w for w in v.values())
    for t, w in sorted(v.items(), key=lambda x: (-x[1], x[0])):
        if left < threshold**2 - 1e-9:
            break
        found.add(t)
        left -= w * w
    return found


#: A passage is named by START * its first term's place + its number of terms; the whole text is -1.
START = 1000


def passages(files: DataFrame, places: list[tuple[str, int, int]]) -> DataFrame:
    """(doc_id, path, name, t, n): the passages of files (doc_id, path, text), and how often each has a term. places: an anchor, its place in a template, and the template's terms, for all of them.

    Each step is a projection of its own, as a column inside a function of
    another is computed again for every element.
    """
    marks = sorted({t for t, _, _ in places})
    every = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(k).alias("k"), F.lit(n).alias("n")) for t, k, n in places))
    cut = files.select("doc_id", "path", terms(F.col("text")).alias("terms")).where(F.arrays_overlap("terms", F.array(*map(F.lit, marks))))
    numbered = F.transform("terms", lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    hits = cut.select("doc_id", "path", "terms", F.filter(numbered, lambda x: x["t"].isin(*marks)).alias("hits"))
    own = F.transform("hits", lambda x: F.transform(F.filter(every, lambda a: a["t"] == x["t"]), lambda a: F.greatest(x["i"] - a["k"], F.lit(0)).cast("long") * START + a["n"]))
    named = hits.select("doc_id", "path", "terms", F.array_distinct(F.flatten(own)).alias("names"))
    found = F.transform("names", lambda c: F.struct(c.alias("name"), F.slice("terms", F.floor(c / START).cast("int") + 1, (c % START).cast("int")).alias("terms")))
    whole = F.array(F.struct(F.lit(-1).cast("long").alias("name"), F.col("terms")))
    some = named.select("doc_id", "path", F.inline(F.when(is_licence_file(F.col("path")), F.concat(whole, found)).otherwise(found)))
    return some.select("doc_id", "path", "name", F.explode("terms").alias("t")).groupBy("doc_id", "path", "name", "t").agg(F.count(F.lit(1)).alias("n"))


def is_licence_file(path: Column) -> Column:
    return F.coalesce(F.regexp_extract(path, "[^/]*$", 0).rlike(LICENCE_FILE), F.lit(False))


def stated(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, path, own_license, own_score, own_at) of files (doc_id, path, text).

    own_at is the place of the first term, from 0, of the passage with the
    largest cosine to any template, or -1 for the whole of a licence file, if
    that cosine is at least the threshold; ties go to the whole, then to
    earlier and shorter passages, then to templates in their order. Scores are
    rounded to 6 digits. Null texts count as empty and state nothing.
    """
    spark = files.sparkSession
    files = files.select("doc_id", "path", F.coalesce("text", F.lit("")).alias("text"))
    n_docs, df = frequencies(files)
    weights = {t: idf(n_docs, df.get(t, 0)) for t in set().union(*(c for _, c in template_counts()))}
    vectors, places = [], set()
    for (_, counts), sequence in zip(template_counts(), template_terms(), strict=True):
        v = {t: n * weights[t] for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in v.values()))
        vectors.append({t: w / norm for t, w in v.items()})
        own = anchors(vectors[-1], threshold)
        places |= {(t, k, len(sequence)) for k, t in enumerate(sequence) if t in own}

    counted = passages(files, sorted(places))
    known = spark.createDataFrame([(t, w, [v.get(t, 0.0) for v in vectors]) for t, w in sorted(weights.items())], "t string, w double, v array<double>")
    weighed = counted.join(F.broadcast(known), "t", "left").withColumn("w", F.col("n") * F.coalesce("w", F.lit(idf(n_docs, 0))))
    dots = [F.sum(F.col("w") * F.coalesce(F.col("v")[i], F.lit(0.0))).alias(f"d{i}") for i in range(len(vectors))]
    each = weighed.groupBy("doc_id", "path", "name").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), *dots)
    likes = F.array_max(F.array(*(F.struct(F.round(F.col(f"d{i}") / F.col("norm"), 6).alias("score"), F.lit(-i).alias("template")) for i in range(len(vectors)))))
    each = each.select("doc_id", "path", F.struct(likes["score"].alias("score"), (-F.col("name")).alias("before"), likes["template"].alias("template")).alias("like")).where(F.col("like.score") >= threshold)
    best = each.groupBy("doc_id", "path").agg(F.max("like").alias("best"))
    names = F.array(*(F.lit(name) for name, _ in TEMPLATES))
    at = F.when(F.col("best.before") == 1, -1).otherwise(F.floor(-F.col("best.before") / START))
    best = best.select("doc_id", "path", F.element_at(names, 1 - F.col("best.template")).alias("own_license"), F.col("best.score").alias("own_score"), at.cast("int").alias("own_at"))
    return files.select("doc_id", "path").distinct().alias("f").join(best.alias("b"), F.struct("f.doc_id", "f.path").eqNullSafe(F.struct("b.doc_id", "b.path")), "left").select("f.doc_id", "f.path", "own_license", "own_score", "own_at")


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per distinct (doc_id, path) of files (doc_id, path, text): what it states (own_license, own_score, own_at), license, and inherited_from, the directory that a licence not its own is from.

    A directory has the licence that a licence file right in it states, of
    several the one of the largest score, then of the smallest path. Files
    that state a licence keep it; others take that of the nearest directory at
    or above their own. Repeated rows give one row. Null paths and paths
    without a directory inherit nothing. An empty table gives an empty result.
    Columns other than doc_id, path and text are not read.

    Inheritance joins directories to the directories above them, so its work
    follows the number of directories; files meet only the directories that
    inherit, and Spark may split a directory of very many files.
    """
    own = stash(stated(files, threshold).withColumn("dir", F.regexp_extract("path", "^(.*)/[^/]*$", 1)), "own")
    licensed = own.where(F.col("own_license").isNotNull() & (F.col("dir") != "") & is_licence_file(F.col("path")))
    licensed = licensed.groupBy(F.col("dir").alias("above")).agg(F.min(F.struct((-F.col("own_score")).alias("s"), "path", "doc_id", F.col("own_license").alias("license"))).alias("best")).select("above", "best.license")
    parts = F.split("dir", "/")
    upward = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("above")))
    below = own.where("dir <> ''").select("dir").distinct().select("dir", F.inline(upward))
    nearest = below.join(licensed, "above").groupBy("dir").agg(F.max_by(F.struct("above", "license"), "depth").alias("from"))
    nearest = stash(nearest.select("dir", F.col("from.above").alias("from_dir"), F.col("from.license").alias("from_license")), "nearest")
    out = own.join(nearest, "dir", "left")
    none = F.col("own_license").isNull()
    return out.select("doc_id", "path", "own_license", "own_score", "own_at", F.coalesce("own_license", "from_license").alias("license"), F.when(none, F.col("from_dir")).alias("inherited_from"))


#: The tables have no paths. The query lays documents out under source/lang: a third right there, the others two levels below, 4096 and 64 ids to a directory. Of each 8 documents one is the LICENSE of its directory, one lies as COPYING a level above the lowest and one as NOTICE in source/lang.
FILES_SQL = """concat(coalesce(source, '_'), '/', coalesce(lang, '_'),
  CASE WHEN doc_id % 8 = 5 OR doc_id % 3 = 1 THEN '' WHEN doc_id % 8 = 3 THEN concat('/', cast({div4096} AS {text})) ELSE concat('/', cast({div4096} AS {text}), '/', cast({div64} AS {text})) END,
  CASE doc_id % 8 WHEN 0 THEN '/LICENSE' WHEN 3 THEN '/COPYING' WHEN 5 THEN '/NOTICE' ELSE concat('/', cast(doc_id AS {text}), '.txt') END)"""


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs.select("doc_id", F.expr(FILES_SQL.format(div64="doc_id div 64", div4096="doc_id div 4096", text="string")).alias("path"), "text"))


def _oracle() -> str:
    counts = ", ".join(f"({i}, '{name}', '{t}', {n})" for i, (name, c) in enumerate(template_counts()) for t, n in sorted(c.items()))
    places = ", ".join(f"({i}, '{t}', {k}, {len(x)})" for i, x in enumerate(template_terms()) for k, t in enumerate(x))
    return f"""
WITH template(id, name, t, n) AS (VALUES {counts}),
place(id, t, k, size) AS (VALUES {places}),
files AS (SELECT DISTINCT doc_id, {FILES_SQL.format(div64="doc_id // 64", div4096="doc_id // 4096", text="varchar")} AS path, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
filed AS (SELECT doc_id, path, regexp_extract_all(text, '{TERM}') AS terms, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, regexp_matches(regexp_extract(path, '[^/]*$'), '{LICENCE_FILE}') AS is_licence FROM files),
total AS (SELECT count(*) AS n_docs FROM files),
seq AS (SELECT doc_id, path, is_licence, i - 1 AS i, terms[i] AS t FROM (SELECT doc_id, path, is_licence, terms, unnest(range(1, len(terms) + 1)) AS i FROM filed)),
weight AS (SELECT v.t, ln((1.0 + max(n_docs)) / (1 + count(DISTINCT (s.doc_id, s.path)))) + 1 AS w FROM (SELECT DISTINCT t FROM template) v CROSS JOIN total LEFT JOIN seq s ON s.t = v.t GROUP BY v.t),
tnorm AS (SELECT id, sqrt(sum((n * w) ** 2)) AS norm FROM template JOIN weight USING (t) GROUP BY id),
vector AS (SELECT id, name, t, n * w / norm AS v FROM template JOIN weight USING (t) JOIN tnorm USING (id)),
anchor AS (SELECT id, t FROM (SELECT id, t, 1 - coalesce(sum(v * v) OVER (PARTITION BY id ORDER BY v DESC, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining FROM vector) WHERE remaining >= {THRESHOLD} ** 2 - 1e-9),
passage AS (SELECT DISTINCT doc_id, path, greatest(i - k, 0) AS start, size FROM seq JOIN place USING (t) JOIN anchor USING (id, t)),
cell AS (SELECT s.doc_id, s.path, start, size, s.t FROM passage p JOIN seq s ON s.doc_id = p.doc_id AND s.path = p.path AND s.i BETWEEN p.start AND p.start + p.size - 1
  UNION ALL SELECT doc_id, path, -1, 0, t FROM seq WHERE is_licence),
counted AS (SELECT doc_id, path, start, size, t, count(*) AS n FROM cell GROUP BY ALL),
weighed AS (SELECT c.*, n * coalesce(w, ln(1.0 + n_docs) + 1) AS tw FROM counted c CROSS JOIN total LEFT JOIN weight USING (t)),
pnorm AS (SELECT doc_id, path, start, size, sqrt(sum(tw * tw)) AS norm FROM weighed GROUP BY ALL),
liked AS (SELECT w.doc_id, w.path, w.start, w.size, v.id, any_value(v.name) AS name, round(sum(w.tw * v.v) / any_value(p.norm), 6) AS score
  FROM weighed w JOIN vector v ON v.t = w.t JOIN pnorm p ON p.doc_id = w.doc_id AND p.path = w.path AND p.start = w.start AND p.size = w.size GROUP BY w.doc_id, w.path, w.start, w.size, v.id),
best AS (SELECT * FROM liked WHERE score >= {THRESHOLD} QUALIFY row_number() OVER (PARTITION BY doc_id, path ORDER BY score DESC, start, size, id) = 1),
own AS (SELECT DISTINCT f.doc_id, f.path, f.dir, f.is_licence, b.name AS own_license, b.score AS own_score, b.start AS own_at FROM filed f LEFT JOIN best b ON b.doc_id = f.doc_id AND b.path = f.path),
licensed AS (SELECT dir AS above, own_license AS from_license FROM own WHERE own_license IS NOT NULL AND is_licence AND dir <> '' QUALIFY row_number() OVER (PARTITION BY dir ORDER BY own_score DESC, path, doc_id) = 1),
nearest AS (SELECT d.dir, l.above, l.from_license FROM (SELECT DISTINCT dir FROM own) d JOIN licensed l ON d.dir = l.above OR starts_with(d.dir, l.above || '/') QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(l.above) DESC) = 1)
SELECT doc_id, path, own_license, own_score, cast(own_at AS integer) AS own_at, coalesce(own_license, from_license) AS license, CASE WHEN own_license IS NULL THEN above END AS inherited_from
FROM own LEFT JOIN nearest USING (dir)
"""


ORACLE = _oracle()
