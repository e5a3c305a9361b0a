import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators import dedupe, graph, validate
from siltstone.plans import ingest
from siltstone.sources import files, html, jsons, sinks, tables
from siltstone.streaming import ingest as streams


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("files")
    (d / "sub").mkdir()
    (d / "a.txt").write_bytes("caf\xe9 \x80".encode("cp1252", "replace") + b"\x80")
    (d / "b.TXT").write_bytes("﻿señal única".encode())
    (d / "sub" / "c.html").write_text("<html><head><title> T &amp; U </title><style>x</style></head><body><nav>menu</nav><p>One<b>two</b></p><footer>f</footer></body></html>")
    (d / "sub" / "d.json").write_text(json.dumps({"title": "T", "url": "http://x", "body": ["one", {"k": " one "}, "two", 3], "links": ["l"], "img": "data:image/png;x"}))
    (d / "sub" / "e.csv").write_text("name;;age\nAna;x;3\n;;\nBo;;\n")
    (d / "sub" / "f.json").write_text("{broken")
    (d / "sub" / "g.pdf").write_bytes(b"%PDF-")
    (d / "h.exe").write_text("no")
    return d


def test_scan_and_extract(spark, folder):
    found = files.scan(spark, str(folder))
    assert found.count() == 7
    got = {r["path"].rsplit("/", 1)[-1]: r for r in files.extract(found).collect()}
    assert got["b.TXT"]["text"] == "señal única"
    assert got["a.txt"]["metadata"]["encoding"] == "cp1252"
    assert got["c.html"]["text"] == "T & U\nOne\ntwo" and got["c.html"]["metadata"]["titulo"] == "T & U"
    assert got["d.json"]["text"] == "title: T\n\nbody[0]: one\n\nbody[2]: two" and got["d.json"]["metadata"]["duplicados_textuales_omitidos"] == "1"
    assert got["e.csv"]["text"] == "[fila 2] name: Ana | columna_2: x | age: 3\n[fila 4] name: Bo"
    assert got["f.json"]["text"] == "" and "CRITICO" in got["f.json"]["warnings"][0]
    assert got["g.pdf"]["text"] == "" and got["g.pdf"]["warnings"]


def test_formats():
    assert files.parse_formats("pdf, .JPG,htm") == {"pdf", "image", "html"}
    for bad in ("", "exe,pdf"):
        with pytest.raises(ValueError):
            files.parse_formats(bad)


def test_decode(spark):
    rows = spark.createDataFrame([(bytearray("año".encode()),), (bytearray(b"\xef\xbb\xbfx"),), (bytearray("año".encode("latin-1")),)], "content binary")
    assert [r[0] for r in rows.select(files.decode("content")).collect()] == ["año", "x", "año"]


def test_html_edges():
    assert html.visible("<p>a<script>b</script>c<p>d &lt; e") == ("a\nc\nd < e", None)
    assert html.visible("<nav><nav>x</nav>y</nav>z")[0] in ("z", "y\nz")


def test_csv_lines():
    assert tables.csv_lines("") == ([], {"delimitador": ","})
    lines, meta = tables.csv_lines("a,b\n1,2,3\n4")
    assert lines == ["[fila 2] a: 1 | b: 2 | columna_3: 3", "[fila 3] a: 4"] and meta["filas_irregulares"] == "3"


def test_flatten_json():
    lines, repeated = jsons.flatten({"a": {"b": ["x", "X "]}, "author": "no", "c": ""})
    assert (lines, repeated) == (["a.b[0]: x"], 1)
    assert jsons.flatten("plain") == (["plain"], 0)


def test_labelled_text(spark):
    rows = spark.createDataFrame([("title: T\nbody[0].Fecha: 3 de mayo\nbody.other:  a   b\nno label here\nskip.me: x",)], "text string")
    got = rows.select(jsons.labelled_text("text", ("skip", "me")).alias("x")).first()["x"]
    assert got == "Fecha: 3 de mayo a b no label here"
    assert rows.select(jsons.labelled_text("text", (), True).alias("x")).first()["x"].startswith("T Fecha")


def test_json_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    (tmp_path / "b.jsonl").write_text('{"x": 1}\n\n{"x": 2}\n{"x": 3}\n')
    (tmp_path / "m.json").write_text('{"documentos": [{"doc_id": "D1"}, {"doc_id": "D2"}]}')
    (tmp_path / "bad.jsonl").write_text('{"x": 1}\n{broken\n')
    assert jsons.read_any(spark, str(tmp_path / "a.json")).count() == 2
    assert jsons.read_any(spark, str(tmp_path / "b.jsonl")).count() == 3
    assert jsons.read_manifest(spark, str(tmp_path / "m.json")).count() == 2
    with pytest.raises(Exception):
        jsons.read_lines(spark, str(tmp_path / "bad.jsonl"), "x int").collect()


def test_questions(spark):
    rows = spark.createDataFrame([(1, None, "one"), (2, "x", "two")], "line int, query_id string, query string")
    assert [r["query_id"] for r in jsons.questions(rows).orderBy("query_id").collect()] == ["q001", "x"]
    with pytest.raises(Exception, match="no text"):
        jsons.questions(spark.createDataFrame([(1, "a", " ")], "line int, query_id string, query string")).collect()


def test_paths_tiles_and_pairs(spark):
    found = spark.createDataFrame([("/r/a.txt",), ("/r/x/b.txt",), ("/r/tiles/1/2/P_3.pbf",), ("/r/c1/index.faiss",), ("/r/c1/metadata.jsonl",)], "path string")
    records = spark.createDataFrame([("1", "/r/a.txt", None), ("2", "/gone", "/old/b.txt"), ("3", "/gone", "/gone2")], "doc_id string, p1 string, p2 string")
    got = {r["doc_id"]: r["path"] for r in files.resolve_paths(records, found, [F.col("p1"), F.col("p2")]).collect()}
    assert got["1"] == "/r/a.txt" and got["3"] is None
    table = spark.createDataFrame([(1, 2, 3, "n", " "), (1, 2, 4, "m", "v")], "tile_zoom int, tile_x int, tile_y int, name string, extra string")
    assert files.tiles_from_table(found, table).first()["text"] == "name: n"
    pair = files.pair_indexes(found, r"\.faiss$", "^metadata.*jsonl$").collect()
    assert [(r["index_path"], r["metadata_path"]) for r in pair] == [("/r/c1/index.faiss", "/r/c1/metadata.jsonl")]
    states = {r["path"]: r["estado"] for r in files.exclude(found, ["x/b.txt"]).collect()}
    assert states["/r/x/b.txt"] == "excluido_no_contenido" and states["/r/a.txt"] is None


def test_manifests(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert sorted(map(tuple, dedupe.last_wins(old, new, "k").collect())) == [("a", 1), ("b", 2), ("c", 2)]
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z")], "k string, n int, s string")
    assert [tuple(r) for r in dedupe.latest(rows, ["k"], "n").collect()] == [("a", 3, "y")]
    shards = spark.createDataFrame([("1", "procesado")], "doc_id string, estado string")
    originals = spark.createDataFrame([("1", "procesado"), ("2", "procesado_con_advertencias"), ("3", "fallido")], "doc_id string, estado string")
    assert sorted(r["doc_id"] for r in dedupe.complete_shards(shards, originals).collect()) == ["1", "2"]
    a = dedupe.fingerprint(rows).first()
    assert a == dedupe.fingerprint(rows.orderBy(F.rand())).first() and a != dedupe.fingerprint(rows.limit(2)).first()


def test_copies_and_entities(spark):
    docs = spark.createDataFrame([(3, "A  b"), (1, "a b "), (2, ""), (4, " "), (5, None), (6, "c")], "doc_id long, text string")
    got = {r["doc_id"]: r["duplicado_de"] for r in dedupe.mark_copies(docs).collect()}
    assert got == {3: 1, 1: None, 2: None, 4: None, 5: None, 6: None}
    kept = dedupe.drop_copies(docs)
    assert kept.count() == 5 and dedupe.drop_copies(kept).count() == 5
    rows = spark.createDataFrame([(1, 0, "layer: a | fid: 1", "c"), (1, 1, "layer: A | fid: 1", "c"), (2, 0, "layer: a | fid: 2", "c")], "doc_id long, pos int, line string, ctx string")
    assert dedupe.drop_repeated_entities(rows).count() == 2
    whole = dedupe.consolidate(rows, "ctx").first()
    assert whole["doc_id"] == 1 and whole["n_lines"] == 3 and whole["text"].endswith("fid: 2")


def test_graph(spark):
    chunks = spark.createDataFrame([(1, "d1", "d1-CH-0", "S", 1, "en", 0), (2, "d1", "d1-CH-1", "s", 1, "en", 1), (3, "d2", "d2-CH-0", None, 2, None, 0)], "row_no long, doc_id string, chunk_id string, fuente string, fenomeno int, idioma string, posicion int")
    vertices, edges = graph.structural_vertices(chunks), graph.structural_edges(chunks)
    got = {r["id"]: r for r in vertices.collect()}
    assert len(got) == 2 + 3 + 2 + 2 and got["source:s"]["label"] == "s" and "idioma" not in got["chunk:d2-CH-0"]["attrs"]
    assert edges.count() == 3 + 2 + 2
    mentions = spark.createDataFrame([(1, 0, "d1", "d1-CH-0", "Mars", "location"), (2, 0, "d1", "d1-CH-1", "mars", "Space mission")], "row_no long, seq int, doc_id string, chunk_id string, label string, kind string")
    relations = spark.createDataFrame([(1, "d1", "d1-CH-0", "Mars", "affects", "Venus", 0.5), (2, "d1", "d1-CH-1", "MARS", "uses", "Mars", None)], "row_no long, doc_id string, chunk_id string, head string, relation string, tail string, confidence double")
    found = {(r["src"], r["relation"], r["dst"]) for r in graph.relation_edges(relations, mentions).collect()}
    assert found == {("location:mars", "affects", "entity:venus"), ("space_mission:mars", "uses", "space_mission:mars")}
    assert graph.entity_vertices(mentions).count() == 2 and graph.mention_edges(mentions).count() == 2
    both = graph.compose((vertices, edges), (vertices, edges))
    assert both[0].count() == vertices.count() and both[1].count() == 2 * edges.count()
    lines = [r["line"] for r in graph.graphml(vertices, edges).orderBy("part").collect()]
    assert lines[0].startswith("<?xml") and lines[-1] == "</graph></graphml>" and len(lines) == 2 + 9 + 7


def test_graph_problems(spark):
    rows = spark.createDataFrame([("d1", "d1-1", "t", 1), ("d1", "x-1", "t", 1), ("d2", "d2-1", " ", 9), ("d1", "d1-1", "t", 1), ("", None, "t", 1)], "doc_id string, chunk_id string, texto string, fenomeno int")
    got = {}
    for r in validate.graph_problems(rows).collect():
        got.setdefault(r["key"], []).append(r["problem"])
    assert got["x-1"] == ["chunk_id no trazable"] and got["d2-1"] == ["texto vacío", "fenomeno inválido"] and got["d1-1"] == ["chunk_id duplicado"] * 2
    with pytest.raises(ValueError, match="d1-1|x-1|d2-1|None"):
        validate.require(validate.graph_problems(rows))


def test_question_problems(spark):
    ids = ["T001", "T002"]
    schema = "line int, query_id string, fenomeno int, idioma string, pregunta string, respuesta_esperada string, fuente_tipo string, fuente_referencia string"
    good = spark.createDataFrame([(1, "T001", 1, "es", "p", "r", "pdf", "f"), (2, "T002", 2, "en", "p", "r", "csv", "f")], schema)
    assert validate.question_problems(good, ids, {1: 1, 2: 1}).collect() == []
    bad = spark.createDataFrame([(1, "T002", 1, "xx", "p", None, "pdf", "f"), (2, "T002", 1, "en", "p", "r", "doc", "f"), (3, "T003", 1, "en", "p", "r", "csv", "f")], schema)
    problems = {r["problem"] for r in validate.question_problems(bad, ids, {1: 1, 2: 1}).collect()}
    assert problems >= {"falta respuesta_esperada", "idioma inválido", "formato inválido", "query_id duplicado", "fuera de orden", "distribución distinta", "número de preguntas distinto"}


def test_ingest(spark, folder):
    docs = ingest.documents_from_files(spark, str(folder)).withColumn("doc_id", F.col("fuente"))
    cleaned = ingest.clean_documents(docs.select("doc_id", "text", "formato"), format="formato")
    state = {r["doc_id"]: r["estado"] for r in cleaned.collect()}
    assert state["f.json"] == "fallido" and state["b.TXT"] == "procesado"
    long = spark.createDataFrame([("x", "# Head\n" + "Many words stand here and go on. " * 60, "md"), ("y", "a: b | c: d\ne: f", "csv"), ("z", "title: T\nbody: one two three", "json")], "doc_id string, text string, formato string")
    chunks = ingest.corpus_chunks(long)
    modes = {r["doc_id"]: r["chunking_mode"] for r in chunks.collect()}
    assert modes == {"x": "standard", "y": "structured_record", "z": "late_chunking"}
    assert all(r["num_palabras"] <= 250 for r in chunks.collect())


def test_sinks(spark, tmp_path):
    chunks = spark.createDataFrame([("a", "a-CH-0000", "standard", 5, None)], "doc_id string, chunk_id string, chunking_mode string, num_palabras int, seccion string")
    sinks.write_chunks(chunks, str(tmp_path / "c"))
    assert "seccion" in spark.read.json(str(tmp_path / "c/metadata")).columns
    sinks.write_texts(spark.createDataFrame([(1, "t")], "doc_id long, text string"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    sinks.write_evaluation(spark.createDataFrame([(1, ["a", "b"])], "query_id long, hits array<string>"), str(tmp_path / "e"), ("hits",))
    assert spark.read.option("header", "true").csv(str(tmp_path / "e")).first()["hits"] == "a | b"
    vectors = spark.createDataFrame([("a", [1.0])], "chunk_id string, vec array<float>")
    sinks.write_vectors(vectors, str(tmp_path / "v"))
    sinks.append_vectors(vectors, str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v")).count() == 2


def test_stream_resumes(spark, tmp_path):
    schema = "doc_id long, text string, at timestamp"
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def arrive(rows):
        spark.createDataFrame(rows, "doc_id long, text string, at string").select("doc_id", "text", F.col("at").cast("timestamp").alias("at")).write.mode("append").parquet(source)

    def run():
        docs = streams.read_documents(spark, source, schema)
        streams.write(streams.distinct_documents(docs, "at"), out, state).awaitTermination()

    arrive([(1, "a b", "2024-01-01 00:00:00"), (2, "A  b", "2024-01-01 00:01:00"), (3, "c", "2024-01-01 00:02:00")])
    run()
    arrive([(4, "c ", "2024-01-01 00:03:00"), (5, "d", "2024-01-01 00:04:00")])
    run()
    texts = sorted(r["text"].strip().lower().replace("  ", " ") for r in spark.read.parquet(out).collect())
    assert texts == ["a b", "c", "d"]


def test_event_windows_stream(spark, tmp_path):
    rows = [("a", 1.0, "2024-01-01 00:10:00"), ("a", 2.0, "2024-01-01 00:50:00"), ("b", 3.0, "2024-01-01 02:00:00")]
    events = spark.createDataFrame(rows, "event_type string, value double, at string").select("event_type", "value", F.col("at").cast("timestamp").alias("ts"), F.lit(1).alias("user_id"))
    got = sorted((r["event_type"], r["n"], r["total"]) for r in streams.event_windows(events).collect())
    assert got == [("a", 2, 3.0), ("b", 1, 3.0)]
    assert streams.event_windows(events, "1 hour", "30 minutes").count() == 5
    assert sorted(r["n"] for r in streams.sessions(events, "45 minutes").collect()) == [1, 2]
    events.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    q = streams.event_windows(stream).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("w").count() == 2


def test_paths_without_manifest_and_optional(spark, tmp_path):
    rows = spark.createDataFrame([("/x/F2_a/pdfs/DOC-000012.txt",), ("/x/F9/pdf_full/DOC-1_b.txt",), ("/x/csv/DOC-2.txt",), ("/x/pdf/no.txt",)], "path string")
    assert sorted((r["doc_id"], r["fenomeno"], r["formato"]) for r in files.manifest_from_paths(rows).collect()) == [("DOC-000012", 2, "pdf"), ("DOC-1", None, "pdf")]
    assert jsons.read_optional(spark, str(tmp_path / "none.jsonl"), "x int").count() == 0


def test_run_all(spark, tmp_path):
    from siltstone.plans import run

    calls = []

    def good():
        calls.append(1)
        return spark.range(3)

    def bad():
        raise ValueError("broken")

    path = f"file://{tmp_path}/out"
    assert run.run_all(spark, {"a": good, "b": bad}, path) == {"a": "done", "b": "ValueError: broken"}
    assert run.run_all(spark, {"a": good, "b": good}, path) == {"a": "skipped", "b": "done"} and len(calls) == 2
    assert run.read_all(spark, ["a", "b", "c"], path).groupBy("config").count().count() == 2


def test_chunk_report(spark):
    from siltstone.operators import packing

    long = "word " * 20
    rows = spark.createDataFrame([(1, long, "oracion"), (1, "short", "oracion"), (2, "1 2 3 " * 6, "suboracion"), (3, long, "suboracion")], "doc_id long, texto string, separado_por string")
    got = {(r["what"], r["value"]): r["n"] for r in packing.chunk_report(rows).collect()}
    assert got == {("total", "documentos"): 3, ("total", "sin_chunks"): 1, ("omitido", "corto"): 1, ("omitido", "ruido_numerico"): 1, ("corte", "suboracion"): 1}


def test_result_and_metadata_files(spark):
    names = ["a/resultado.json", "a/Resultados_v2.JSON", "a/resultadox.json", "b c/resultado.json", "a/metadata.jsonl", "a/metadata_1.jsonl", "b/metadata_2.jsonl", "b/metadata_10.jsonl", "a/other.txt"]
    rows = spark.createDataFrame([(n,) for n in names], "path string")
    assert [r["path"] for r in files.result_files(rows).collect()] == ["a/resultado.json", "a/Resultados_v2.JSON"]
    assert {tuple(r) for r in files.metadata_files(rows).collect()} == {("a", "a/metadata.jsonl"), ("b", "b/metadata_10.jsonl")}


def test_broken_lines_are_named(spark, tmp_path):
    (tmp_path / "good.jsonl").write_text('﻿{"a": 1}\n\n  \n{"a": 2}\n')
    assert sorted(r["a"] for r in jsons.read_records(spark, f"file://{tmp_path}/good.jsonl", "a int").collect()) == [1, 2]
    for bad in ('{"a": 1}\n\n{"a": \n', '{"a": 1}\n\n[1]\n'):
        (tmp_path / "bad.jsonl").write_text(bad)
        with pytest.raises(Exception, match=r"bad\.jsonl:3"):
            jsons.read_records(spark, f"file://{tmp_path}/bad.jsonl", "a int").collect()


def test_ambiguous_names_are_an_error_if_asked(spark):
    found = spark.createDataFrame([("r/x/a.txt",), ("r/y/a.txt",), ("r/z/b.txt",)], "path string")
    records = spark.createDataFrame([(1, "a.txt"), (2, "b.txt")], "doc_id int, name string")
    tried = [F.concat(F.lit("q/"), "name")]
    assert {r["doc_id"]: r["path"] for r in files.resolve_paths(records, found, tried).collect()} == {1: None, 2: "r/z/b.txt"}
    with pytest.raises(Exception, match="no one file for 1: 2 of its name"):
        files.resolve_paths(records, found, tried, strict=True).collect()


def test_lone_surrogates_are_counted(spark):
    rows = spark.createDataFrame([("p", "txt", b"x")], "path string, formato string, content binary")
    got = files.extract(rows, {"txt": lambda _: ("a\ud800b\udc01", {})}).first()
    assert got["text"] == "a?b?" and got["metadata"]["surrogates"] == "2" and "2 sustitutos" in got["warnings"][0]


def test_ordered_fingerprint(spark):
    import hashlib

    rows = [(i, f"t{i}") for i in range(50)] + [(7, "again")]
    df = spark.createDataFrame(rows, "n long, t string")

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    slices = {}
    for n, t in rows:
        slices.setdefault(n // 16, []).append((n, sha('{"n":%d,"t":"%s"}' % (n, t))))
    want = sha("".join(sha("".join(h for _, h in sorted(x))) for _, x in sorted(slices.items())))
    assert tuple(dedupe.ordered_fingerprint(df.repartition(5), "n", per_slice=16).first()) == (51, want)
    assert dedupe.ordered_fingerprint(df.where("n <> 9"), "n", per_slice=16).first()["fingerprint"] != want
    assert dedupe.ordered_fingerprint(df.limit(0), "n").first()["fingerprint"] == sha("")


def test_documents_of_one_group_are_numbered_in_ranges(spark):
    rows = [("big", f"p{i:04d}") for i in range(400)] + [("a", "x"), (None, "n"), ("z", "y")]
    got = dedupe.number_documents(spark.createDataFrame(rows, "g string, path string").repartition(7), "g", per_slice=50).collect()
    want = {r: f"DOC-{k + 1:06d}" for k, r in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r)))}
    assert {(r["g"], r["path"]): r["doc_id"] for r in got} == want
