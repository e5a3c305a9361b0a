import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.functions import vectors as V
from siltstone.operators import embed, fusion, graph, metrics, search, validate
from siltstone.plans import evaluation, retrieval


def near(n, dims=6, seed=0):
    draw = np.random.default_rng(seed)
    v = draw.normal(size=(n, dims))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def corpus(spark):
    v = near(80)
    rows = [(i, v[i].tolist(), i % 7, "en" if i % 2 else "ES", f"text {i % 5}") for i in range(80)] + [(99, None, 1, "en", "x")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, doc_id int, idioma string, texto string").cache()


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame([(1000 + i, q.tolist()) for i, q in enumerate(near(5, seed=1))], "query_id long, qvec array<double>")


def ranks(v, q, k):
    return [sorted(range(len(v)), key=lambda i: (-float(v[i] @ x), i))[:k] for x in q]


def by_query(rows, value="vec_id"):
    out = {}
    for r in sorted(rows.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r[value])
    return out


def test_exact(corpus, asked, monkeypatch):
    want = {1000 + i: r for i, r in enumerate(ranks(near(80), near(5, seed=1), 9))}
    assert by_query(search.exact_topk(corpus, asked, 9)) == want
    monkeypatch.setattr(search, "QUERY_BLOCK", 2)
    assert by_query(search.exact_topk(corpus, asked, 9)) == want
    assert search.exact_topk(corpus.limit(0), asked, 9).collect() == []
    assert search.exact_topk(corpus, asked.limit(0), 9).collect() == []


def test_filters_come_after_the_search(corpus, asked):
    meta = corpus.select("vec_id", "idioma")
    keep = search.allowed(idioma="es")
    got = by_query(search.candidates(corpus, asked, 10, meta, keep))
    for i, r in enumerate(ranks(near(80), near(5, seed=1), 10)):
        assert got.get(1000 + i, []) == [x for x in r if x % 2 == 0]
    first = by_query(search.candidates(corpus, asked, 10, pre_filter=F.lower("idioma") == "es"))
    assert all(len(x) == 10 for x in first.values())


def test_filter_conditions(spark):
    rows = spark.createDataFrame([(0.5, 1, "ES", "PDF"), (0.1, 1, "es", "pdf"), (0.9, 2, "es", "pdf"), (0.9, 1, None, "pdf")], "score double, fenomeno int, idioma string, formato string")
    assert rows.where(search.allowed(0.3, "1", "es", "pdf")).count() == 1


def test_pooling(spark):
    rows = [(1, 1, 10, 0.9), (1, 2, 20, 0.8), (1, 3, 10, 0.1), (1, 4, 10, 0.5), (1, 5, 10, 0.3), (1, 6, 30, 0.8)]
    found = spark.createDataFrame(rows, "query_id long, rank int, doc_id int, score double")
    got = {how: [(r["doc_id"], round(r["score"], 6)) for r in search.pool_documents(found, how).orderBy("rank").collect()] for how in ("mean3", "sum", "mean", "max")}
    assert got["mean3"] == [(20, 0.8), (30, 0.8), (10, round(1.7 / 3, 6))]
    assert got["sum"] == [(10, 1.8), (20, 0.8), (30, 0.8)]
    assert got["mean"] == [(20, 0.8), (30, 0.8), (10, 0.45)]
    assert got["max"] == [(10, 0.9), (20, 0.8), (30, 0.8)]


def test_v1_keeps_gaps(corpus, asked):
    keep = search.allowed(idioma="en")
    docs, found = search.retrieve_v1(corpus, asked, corpus.select("vec_id", "doc_id", "idioma"), keep)
    assert any(r["rank"] > 15 for r in found.collect())
    assert all(len(x) == 3 for x in by_query(docs, "doc_id").values())


def mmr_plainly(v, score, recall, k, weight):
    low, high = min(score), max(score)
    rel = [1.0 if low == high else (s - low) / (high - low) for s in score]
    order = sorted(range(len(score)), key=lambda i: (-score[i], recall[i]))
    picked = []
    while len(picked) < min(k, len(order)):
        picked.append(max((i for i in order if i not in picked), key=lambda i: (round(weight * rel[i] - (1 - weight) * max((float(v[i] @ v[j]) for j in picked), default=0.0), 12), -order.index(i))))
    return picked


@pytest.mark.parametrize("weight", [0.0, 0.7, 1.0])
def test_mmr(spark, weight):
    v = near(25, seed=3)
    draw = random.Random(1)
    score = [round(draw.random(), 1) for _ in range(25)]
    rows = spark.createDataFrame([(7, i, i + 1, score[i], v[i].tolist()) for i in range(25)], "query_id long, vec_id long, recall_rank int, score double, embedding array<double>")
    got = [r["vec_id"] for r in fusion.mmr(rows, 8, weight).orderBy("rank").collect()]
    assert got == mmr_plainly(v, score, range(25), 8, weight)


def test_drop_near(spark):
    v = [[1.0, 0.0], [0.99, math.sqrt(1 - 0.99**2)], [0.0, 1.0], [0.6, 0.8], [-1.0, 0.0], [0.0, -1.0]]
    keys = ["a", "b", "c", "c", "", ""]
    rows = spark.createDataFrame([(1, i, i + 1, s, v[i], keys[i]) for i, s in enumerate([0.5, 0.9, 0.4, 0.3, 0.2, 0.2])], "query_id long, vec_id long, recall_rank int, score double, embedding array<double>, k string")
    got = sorted(r["vec_id"] for r in fusion.drop_near(rows, 0.9, key="k").collect())
    assert got == [1, 2, 4, 5]


def test_fusion(spark):
    a = spark.createDataFrame([(1, 10, 1, 0.9), (1, 11, 2, 0.5), (1, 12, 11, 0.1)], "query_id long, vec_id long, rank int, score double")
    b = spark.createDataFrame([(1, 11, 1, 0.7), (1, 13, 2, -0.2)], "query_id long, vec_id long, rank int, score double")
    rrf = {r["vec_id"]: r["score"] for r in fusion.rrf([a, b]).collect()}
    assert rrf == pytest.approx({10: 1 / 61, 11: 1 / 62 + 1 / 61, 13: 1 / 62})
    sums = {r["vec_id"]: r["score"] for r in fusion.comb_sum([a, b]).collect()}
    assert sums == pytest.approx({10: 0.9, 11: 1.2, 12: 0.1, 13: -0.2})
    mnz = {r["vec_id"]: r["score"] for r in fusion.comb_mnz([a, b]).collect()}
    assert mnz == pytest.approx({10: 0.9, 11: 2.4, 12: 0.1, 13: 0.0})
    assert by_query(fusion.rrf([a, b])) == by_query(fusion.rrf([b, a]))


def test_v2_and_v3(corpus, asked):
    meta = corpus.select("vec_id", "doc_id", "texto")
    scorer = V.dot(F.slice("qvec", 1, 3), F.slice("embedding", 1, 3))
    docs, found = retrieval.retrieve_v2(corpus, asked, scorer, meta, recall=30, k=6)
    assert all(len(x) == 6 for x in by_query(found).values()) and all(len(x) <= 3 for x in by_query(docs, "doc_id").values())
    _, third = retrieval.retrieve_v3(corpus, asked, scorer, meta, recall=30, k=10)
    assert all(len(set(x)) == len(x) <= 5 for x in by_query(third, "texto").values())  # equal texts are shown once
    with pytest.raises(ValueError):
        retrieval.retrieve_v3(corpus, asked, scorer, near=2)


def test_ivf_and_near_pairs(corpus, asked):
    centres = near(4, seed=9).tolist()
    assert by_query(search.ivf_topk(corpus.where("embedding IS NOT NULL"), asked, centres, 9, 4)) == by_query(search.exact_topk(corpus, asked, 9))
    v = near(80)
    pools = corpus.where("embedding IS NOT NULL").withColumn("query_id", F.col("vec_id") % 2)
    got = {(r["a"], r["b"]) for r in search.near_pairs(pools, 0.6).collect()}
    assert got and got == {(i, j) for i in range(80) for j in range(i + 2, 80, 2) if v[i] @ v[j] >= 0.6}


def test_unit_and_cosine(spark):
    rows = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    got = rows.select(V.unit("a").alias("u"), V.cosine("a", "b").alias("c")).collect()
    assert got[0]["u"] == pytest.approx([0.6, 0.8]) and got[0]["c"] == pytest.approx(0.96)
    assert got[1]["u"] == [0.0, 0.0] and got[1]["c"] == 0.0


def ndcg_plainly(texts, truth, k=10):
    left, total = dict(truth), 0.0
    for i, t in enumerate(texts[:k], 1):
        hit = [p for p in left if p in t]
        if hit:
            total += max(left[p] for p in hit) / math.log2(i + 1)
            for p in hit:
                del left[p]
    best = sum(g / math.log2(i + 1) for i, g in enumerate(sorted(truth.values(), reverse=True)[:k], 1))
    return total / best if best else 0.0


def test_ndcg(spark):
    draw = random.Random(4)
    results, truth = [], []
    want = {}
    for q in range(12):
        passages = {f"p{j}z": draw.choice([1.0, 2.0]) for j in range(draw.randrange(0, 14))}
        texts = [" ".join(draw.choice(list(passages) + ["none"]) for _ in range(draw.randrange(1, 4))) for _ in range(draw.randrange(0, 13))] if passages else ["x"]
        want[q] = ndcg_plainly(texts, passages)
        results += [(q, 3 * i + 1, t) for i, t in enumerate(texts)]
        truth += [(q, p, g) for p, g in passages.items()]
    a = spark.createDataFrame(results, "query_id long, rank int, text string")
    b = spark.createDataFrame(truth, "query_id long, verbatim string, gain double")
    queries = spark.createDataFrame([(q,) for q in range(12)], "query_id long")
    got = {r["query_id"]: r["ndcg"] for r in metrics.ndcg(a, b, queries).collect()}
    assert got == pytest.approx(want) and all(0 <= x <= 1 for x in got.values())


def test_f1(spark):
    docs = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (1, 4, "d"), (2, 1, None)], "query_id long, rank int, source string")
    truth = spark.createDataFrame([(1, "a"), (1, "d"), (2, "x"), (3, "y")], "query_id long, source string")
    queries = spark.createDataFrame([(1,), (2,), (3,), (4,)], "query_id long")
    got = {r["query_id"]: (r["precision"], r["recall"], r["f1"]) for r in metrics.f1(docs, truth, queries).collect()}
    assert got[1] == pytest.approx((1 / 3, 1 / 2, 0.4)) and got[2] == got[3] == got[4] == (0, 0, 0)


def test_borda(spark):
    scores = spark.createDataFrame([("1", 0.72, 0.68), ("2", 0.81, 0.55), ("3", 0.65, 0.62), ("4", 0.5, 0.41)], "config string, ndcg double, f1 double")
    got = [(r["config"], r["points"]) for r in metrics.borda(scores, ("ndcg", "f1"), "ndcg").orderBy("rank").collect()]
    assert got == [("1", 5), ("2", 4), ("3", 3), ("4", 0)]


def test_evaluation_of_configurations(spark):
    truth = spark.createDataFrame([(1, {"fragmentos_relevantes": [("abc", "ALTA"), ("", "alta")], "documentos_relevantes": [("s1",)]})], "query_id long, ground_truth struct<fragmentos_relevantes:array<struct<texto_verbatim:string,relevancia:string>>,documentos_relevantes:array<struct<fuente:string>>>")
    passages, sources = evaluation.truth_tables(truth)
    assert passages.collect()[0]["gain"] == 2.0 and passages.count() == 1
    fragments = spark.createDataFrame([("A", 1, 1, "x abc"), ("B", 1, 1, "x"), ("B", 1, 2, "abc")], "config string, query_id long, rank int, text string")
    documents = spark.createDataFrame([("A", 1, 1, "s1"), ("B", 1, 1, "s2")], "config string, query_id long, rank int, source string")
    queries = spark.createDataFrame([(1, "t"), (2, None)], "query_id long, tipo string")
    each = evaluation.evaluate_all(fragments, documents, passages, sources, queries)
    got = {(r["config"], r["query_id"]): (r["ndcg"], r["f1"]) for r in each.collect()}
    assert got[("A", 1)] == pytest.approx((1.0, 0.5)) and got[("B", 1)] == pytest.approx((1 / math.log2(3), 0)) and got[("A", 2)] == (0, 0)
    assert [r["config"] for r in evaluation.compare(each).orderBy("rank").collect()] == ["A", "B"]
    rows = {(r["dimension"], r["value"]): r["queries"] for r in metrics.report(each.where("config = 'A'"), "tipo").collect()}
    assert rows == {("total", "total"): 2, ("tipo", "t"): 1, ("tipo", "sin_dato"): 1}


def test_result_documents_and_assembly(spark):
    docs = spark.createDataFrame([(1, 1, "a"), (1, 4, "b")], "query_id long, rank int, doc_id string")
    frags = spark.createDataFrame([(1, 1, "z", "t"), (2, 1, "x", "t"), (2, 2, "x", "u"), (2, 3, "y", "v")], "query_id long, rank int, doc_id string, text string")
    got = sorted((r["query_id"], r["rank"], r["doc_id"]) for r in metrics.result_documents(docs, frags).collect())
    assert got == [(1, 1, "a"), (2, 1, "x"), (2, 2, "y")]
    queries = spark.createDataFrame([(1, "one"), (2, "two")], "query_id long, query string")
    out = metrics.assemble(docs, frags, queries).orderBy("query_id").collect()
    assert [f["rank"] for f in out[1]["fragments"]] == [1, 2, 3] and out[1]["documents"] is None
    assert validate.result_problems(metrics.assemble(docs, frags, queries)).count() == 1


def test_encode_and_resume(spark):
    chunks = spark.createDataFrame([("a", "one two"), ("b", None), ("c", "two one")], "chunk_id string, texto string")
    got = {r["chunk_id"]: r["vec"] for r in embed.encode(chunks, embed.hashing_encoder(8)).collect()}
    assert got["a"] == pytest.approx(got["c"], abs=1e-6) and np.linalg.norm(got["a"]) == pytest.approx(1, abs=1e-6) and not any(got["b"])
    done = spark.createDataFrame([("a",)], "chunk_id string")
    assert sorted(r["chunk_id"] for r in embed.resume_encoding(chunks, done, embed.hashing_encoder(8)).collect()) == ["b", "c"]
    assert embed.check_alignment(chunks, done).count() == 2
    with pytest.raises(Exception, match="window"):
        embed.encode(chunks, embed.hashing_encoder(8), longest=1).collect()


def test_windows():
    text = "A b. C d e. F. " + "g " * 7 + "h."
    tokens = [(i, i + len(w)) for i, w in ((text.index(w, p), w) for p, w in positions(text))]
    got = embed.sentence_windows(tokens, text, 6)
    assert all(0 < b - a <= 6 for a, b in got) and got[0][0] == 0 and got[-1][1] == len(tokens)
    assert all(x[0] < y[0] <= x[1] for x, y in zip(got, got[1:], strict=False))


def test_encode_late(spark):
    text = "One two. Three four five. Six."
    docs = spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")
    chunks = spark.createDataFrame([(1, "a", 0, 8), (1, "b", 9, 30)], "doc_id long, chunk_id string, char_start int, char_end int")
    for capacity in (3, 100):
        got = {r["chunk_id"]: np.array(r["vec"]) for r in embed.encode_late(docs, chunks, embed.hashing_token_encoder(8), capacity).collect()}
        spans, embed_ = embed.hashing_token_encoder(8)()
        tokens = spans(text)
        for name, own in (("a", {0, 1}), ("b", {2, 3, 4, 5})):
            parts = []
            for a, z in embed.sentence_windows(tokens, text, capacity):
                here = [i - a for i in own if a <= i < z]
                if here:
                    parts.append(embed_(text, tokens[a:z])[here].mean(axis=0))
            mean = np.mean(parts, axis=0)
            assert np.allclose(got[name], mean / np.linalg.norm(mean), atol=1e-5)
    lost = spark.createDataFrame([(1, "c", 100, 110)], "doc_id long, chunk_id string, char_start int, char_end int")
    with pytest.raises(Exception, match="no token"):
        embed.encode_late(docs, lost, embed.hashing_token_encoder(8)).collect()


def test_align_results(spark):
    asked = spark.createDataFrame([(1, "a"), (2, "b")], "line int, query_id string")
    by_id = spark.createDataFrame([(1, "b", 5)], "line int, query_id string, x int")
    assert {r["query_id"]: r["x"] for r in metrics.align_results(asked, by_id).collect()} == {"a": None, "b": 5}
    by_place = spark.createDataFrame([(9, "q2", 7), (8, "q1", 6)], "line int, query_id string, x int")
    assert {r["query_id"]: r["x"] for r in metrics.align_results(asked, by_place).collect()} == {"a": 6, "b": 7}


def positions(text):
    at = 0
    for w in text.split():
        at = text.index(w, at)
        yield at, w
        at += len(w)


def test_bm25(spark):
    docs = spark.createDataFrame([(1, "cat dog"), (2, "cat cat bird fish"), (3, "none")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "Cat bird")], "query_id long, query string")
    got = [(r["doc_id"], r["rank"]) for r in search.bm25(docs, asked).orderBy("rank").collect()]
    assert got == [(2, 1), (1, 2)]


def test_parameters():
    validate.check_parameters()
    for bad in ({"k": 0}, {"weight": 1.1}, {"near": -1}, {"target": 0}, {"target": 260}, {"mode": "x"}, {"mode": "semantic", "overlap": 1}):
        with pytest.raises(ValueError):
            validate.check_parameters(**bad)


def test_neighbours_over_slices_of_one_group(spark):
    draw = np.random.default_rng(1)
    rows = [("one", i, draw.normal(size=4).tolist()) for i in range(0, 300, 3)] + [("two", 5, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "g string, n long, embedding array<double>")
    got = {(r["g"], r["n"]): r["similarity"] for r in search.adjacent_similarity(df, "g", "n", per_slice=16).collect()}
    assert len(got) == len(rows) and got["two", 5] is None and got["one", 297] is None
    for (_, n, v), (_, _, w) in zip(rows[:-2], rows[1:-1], strict=True):
        assert got["one", n] == pytest.approx(float(np.dot(v, w)))


def test_one_label_of_most_mentions_is_resolved_over_slices(spark):
    mentions = [(i, 0, "d", "c", "The", "location" if i < 40 else "person") for i in range(0, 80, 2)] + [(90, 0, "d", "c", "Rare", "person")]
    m = spark.createDataFrame(mentions, "row_no long, seq int, doc_id string, chunk_id string, label string, kind string")
    asked = spark.createDataFrame([(i, "the") for i in range(0, 100, 3)] + [(5, "rare"), (95, "Rare"), (1, "none")], "row_no long, label string")
    got = {(r["row_no"], r["label"]): r["node"] for r in graph.resolve(asked, m, per_slice=7).collect()}
    whole = {(r["row_no"], r["label"]): r["node"] for r in graph.resolve(asked, m).collect()}
    assert got == whole and got[39, "the"].startswith("location:") and got[99, "the"].startswith("person:")
    assert got[5, "rare"].startswith("entity:") and got[95, "Rare"].startswith("person:")


def test_fitted_lists(spark):
    draw = np.random.default_rng(2)
    rows = [(i, (v := draw.normal(size=6)) / np.linalg.norm(v)) for i in range(200)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    q = df.where("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding AS qvec")
    centres = search.fit_lists(df, 5)
    assert len(centres) == 5 and centres == search.fit_lists(df.repartition(3), 5)
    exact = {tuple(r)[:3] for r in search.exact_topk(df, q, 5).collect()}
    assert {tuple(r)[:3] for r in search.ivf_topk(df, q, centres, 5, 5).collect()} == exact
    some = {tuple(r)[:3] for r in search.ivf_topk(df, q, centres, 5, 2).collect()}
    assert some and len({x[::2] for x in some} & {x[::2] for x in exact}) > 0.3 * len(exact)


def test_graph_candidates_of_nulls_and_repeats(spark, monkeypatch):
    """Against plain Python, some queries a task, and without a shuffle of the candidates."""
    draw = random.Random(9)
    mentions = [(draw.choice([*"abcdefghij", None]), draw.choice([*(f"c{i}" for i in range(30)), None])) for _ in range(300)]
    edges = [(draw.choice([*"abcdefghijz", None]), draw.choice("abcdefghij")) for _ in range(8)]
    asked = [(draw.choice([*range(9), None]), draw.choice([*"abcz", None])) for _ in range(25)]
    want = {}
    for q in {q for q, _ in asked}:
        own = {e for x, e in asked if x == q and e}
        own |= {y for a, b in edges if a for x, y in ((a, b), (b, a)) if x in own}
        counts = {}
        for e, c in mentions:
            if e in own:
                counts[c] = counts.get(c, 0) + 1
        for rank, (c, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0] or "")), 1):
            want[q, c] = (n, rank)
    frames = spark.createDataFrame(mentions, "entity string, chunk_id string"), spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame(asked, "query_id long, entity string")
    for pairs in (1 << 25, 62):
        monkeypatch.setattr(search, "PAIRS", pairs)
        found = search.graph_candidates(*frames)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and plan.count("Exchange") == 1, plan
        assert {(r["query_id"], r["chunk_id"]): (r["score"], r["rank"]) for r in found.collect()} == want
        assert found.columns == ["query_id", "chunk_id", "score", "rank"]
    assert search.graph_candidates(*(f.limit(0) for f in frames)).collect() == []


def test_graph_candidates_are_compact(spark, tmp_path):
    """Written as Parquet, a candidate takes few bytes, as rows of several queries take turns."""
    draw = random.Random(4)
    mentions = [(f"e{draw.randrange(40)}", f"{draw.randrange(10**6)}-CH-{i:04d}") for i in range(4000) for _ in range(5)]
    asked = [(q, e) for q in range(48) for e in (f"e{draw.randrange(40)}", "e0")] + [(q, f"e{e}") for q in range(48) for e in range(1, 30)]
    found = search.graph_candidates(spark.createDataFrame(mentions, "entity string, chunk_id string"), spark.createDataFrame([("e0", "e1")], "src string, dst string"), spark.createDataFrame(asked, "query_id long, entity string").coalesce(1))
    found.write.parquet(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    rows = back.count()
    assert rows > 400_000 and back.select("query_id", "chunk_id").distinct().count() == rows
    assert sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet")) < 5 * rows
