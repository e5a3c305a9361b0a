"""Queries over the given tables, and the same in SQL.

QUERIES: name -> (spark, sf_dir) -> DataFrame. ORACLE_SQL: name -> SQL for
DuckDB. Names without SQL are iterative or sequential; tests hold them against
plain Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone import session
from siltstone.functions import text as T
from siltstone.functions import vectors as V
from siltstone.operators import dedupe, embed, fusion, graph, lines, metrics, packing, records, search, segment, validate
from siltstone.plans import evaluation, ingest, retrieval
from siltstone.sources import html, jsons, sinks, tables
from siltstone.streaming import ingest as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FLAT = r"trim(regexp_replace(text, '[\s\p{Z}]+', ' ', 'g'))"
WORD_SQL = r"[\p{L}\p{N}_]+(?:[-''][\p{L}\p{N}_]+)*"

# -- text --


@query(f"SELECT doc_id, {FLAT} AS text FROM documents")
def clean_whitespace(spark, d):
    return table(spark, d, "documents").select("doc_id", T.collapse_blanks("text").alias("text"))


@query(r"SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0b-\x1f\x7f-\x9f]', '', 'g') AS text, length(text) - length(regexp_replace(text, '[\x00-\x08\x0b-\x1f\x7f-\x9f]', '', 'g')) AS n FROM documents")
def strip_control(spark, d):
    return table(spark, d, "documents").select("doc_id", T.strip_controls("text").alias("text"), T.count_controls("text").alias("n"))


@query(r"SELECT doc_id, regexp_replace(replace(text, ' the', '-' || chr(10) || 'the'), '([\p{L}\p{N}_])-\s*\n\s*([\p{L}\p{N}_])', '\1\2', 'g') AS text FROM documents")
def dehyphenate(spark, d):
    broken = F.replace("text", F.lit(" the"), F.lit("-\nthe"))
    return table(spark, d, "documents").select("doc_id", T.join_hyphenated(broken).alias("text"))


@query(r"SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '!?\[([^\]]+)\]\([^)]*\)', '\1', 'g'), '</?[A-Za-z][^>]*>', '', 'g'), '^\s{0,3}#{1,6}\s*', ''), '^\s{0,3}(?:[-*+]\s+|\d+[.)]\s+)', '') AS text FROM pages")
def markdown_strip(spark, d):
    return table(spark, d, "pages").select("page_id", T.strip_markup("html").alias("text"))


@query(
    rf"""SELECT doc_id, CASE WHEN len(w) <= 50 THEN array_to_string(w[1:50], ' ') ELSE regexp_replace(array_to_string(w[1:50], ' '), '[ ,;:]+$', '') || '…' END AS text
    FROM (SELECT doc_id, string_split({FLAT}, ' ') AS w FROM documents)"""
)
def truncate_words(spark, d):
    return table(spark, d, "documents").select("doc_id", T.truncate_words("text", 50).alias("text"))


@query(f"SELECT doc_id, CASE WHEN {FLAT} = '' THEN '' ELSE sha256(lower({FLAT})) END AS hash FROM documents")
def content_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", T.content_hash("text").alias("hash"))


HASHED = f"SELECT doc_id, sha256(lower({FLAT})) AS h FROM documents"
COPIES = f"SELECT doc_id, nullif(min(doc_id) OVER (PARTITION BY h), doc_id) AS duplicado_de FROM ({HASHED})"


@query(f"SELECT doc_id, duplicado_de, CASE WHEN duplicado_de IS NULL THEN 'procesado' ELSE 'excluido_duplicado' END AS estado FROM ({COPIES})")
def exact_dedupe(spark, d):
    return dedupe.mark_copies(table(spark, d, "documents")).select("doc_id", "duplicado_de", "estado")


@query(f"SELECT CASE WHEN duplicado_de IS NULL THEN 'procesado' ELSE 'excluido_duplicado' END AS estado, count(*) AS n FROM ({COPIES}) GROUP BY 1")
def dedupe_summary(spark, d):
    return sinks.quality_report(dedupe.mark_copies(table(spark, d, "documents")))


@query(
    rf"""SELECT doc_id, w AS words, s AS plain_words, cast(ceil(1.3::DOUBLE * w) AS bigint) AS tokens, cast(round_even(1.3::DOUBLE * s, 0) AS bigint) AS plain_tokens
    FROM (SELECT doc_id, len(regexp_extract_all(text, '{WORD_SQL}')) AS w, len(list_filter(string_split({FLAT}, ' '), lambda x: x <> '')) AS s FROM documents)"""
)
def word_token_counts(spark, d):
    words, plain = T.word_count("text"), T.split_count("text")
    return table(spark, d, "documents").select("doc_id", words.alias("words"), plain.alias("plain_words"), T.tokens_up(words).alias("tokens"), T.tokens_even(plain).alias("plain_tokens"))


def _hits(name: str, words: str) -> str:
    return f"len(list_filter(w, lambda x: x IN ({words}))) AS {name}"


LANGUAGES = f"""SELECT doc_id, lang, CASE WHEN len(w) < 20 OR greatest(es, en, pt) < 2 THEN 'unknown' WHEN es = greatest(es, en, pt) THEN 'es' WHEN en = greatest(es, en, pt) THEN 'en' ELSE 'pt' END AS detected
FROM (SELECT *, {_hits("es", "'el','la','los','las','que','del','para','una'")}, {_hits("en", "'the','and','of','for','with','from','this'")}, {_hits("pt", "'o','a','os','as','que','para','uma','dos'")}
FROM (SELECT doc_id, lang, string_split(lower(substring({FLAT}, 1, 5000)), ' ') AS w FROM documents))"""


@query(f"SELECT doc_id, detected FROM ({LANGUAGES})")
def lang_detect(spark, d):
    return table(spark, d, "documents").select("doc_id", T.language("text").alias("detected"))


@query(f"SELECT lang, detected, count(*) AS n FROM ({LANGUAGES}) GROUP BY ALL")
def lang_confusion(spark, d):
    found = table(spark, d, "documents").select("lang", T.language("text").alias("detected"))
    return found.groupBy("lang", "detected").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line FROM documents) WHERE line <> '' AND length(line) <= 120 GROUP BY ALL HAVING count(*) >= 3")
def repeated_lines(spark, d):
    return lines.repeated_lines(lines.explode_lines(table(spark, d, "documents")), 3, 120)


SENTENCES = r"""SELECT doc_id, CASE WHEN len(s) = 0 THEN [text] ELSE s END AS s FROM (SELECT doc_id, text,
list_filter(list_transform(string_split(regexp_replace(text, '([.!?。！？｡])[\s\x0b]+', '\1' || chr(31), 'g'), chr(31)), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents)"""


@query(f"SELECT doc_id, i - 1 AS pos, s[i] AS sentence FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM ({SENTENCES}))")
def sentences(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(segment.sentences("text")).alias("pos", "sentence"))


@query(f"SELECT doc_id, len(s) AS n, list_max(list_transform(s, lambda x: length(x))) AS longest FROM ({SENTENCES})")
def sentence_stats(spark, d):
    s = segment.sentences("text")
    return table(spark, d, "documents").select("doc_id", F.size(s).alias("n"), F.array_max(F.transform(s, lambda x: F.length(x))).alias("longest"))


PACKED = rf"""WITH RECURSIVE flat AS (SELECT doc_id, {FLAT} AS text FROM documents WHERE {FLAT} <> ''),
cut AS (SELECT doc_id, text, list_filter(string_split(regexp_replace(text, '([.!?。！？｡]) ', '\1' || chr(31), 'g'), chr(31)), lambda x: x <> '') AS s, len(string_split(text, ' ')) AS total FROM flat),
unit AS (SELECT doc_id, i, s[i] AS sentence, len(string_split(s[i], ' ')) AS n FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM cut WHERE total > 250)),
fold(doc_id, i, pos, cur) AS (SELECT doc_id, i, 0, n FROM unit WHERE i = 1
  UNION ALL SELECT u.doc_id, u.i, CASE WHEN f.cur + u.n > 200 THEN f.pos + 1 ELSE f.pos END, CASE WHEN f.cur + u.n > 200 THEN u.n ELSE f.cur + u.n END FROM fold f JOIN unit u ON u.doc_id = f.doc_id AND u.i = f.i + 1),
piece AS (SELECT f.doc_id, f.pos AS posicion, string_agg(u.sentence, ' ' ORDER BY u.i) AS texto, sum(u.n) AS n FROM fold f JOIN unit u ON u.doc_id = f.doc_id AND u.i = f.i GROUP BY ALL
  UNION ALL SELECT doc_id, 0, text, total FROM cut WHERE total <= 250),
token AS (SELECT *, cast(round_even(1.3::DOUBLE * n, 0) AS bigint) AS num_tokens FROM piece)"""


@query(f"{PACKED} SELECT doc_id, posicion, texto, n AS num_palabras FROM piece")
def chunk_pack(spark, d):
    return ingest.plain_chunks(table(spark, d, "documents")).select("doc_id", "posicion", "texto", "num_palabras")


@query(
    f"""{PACKED} SELECT doc_id, posicion, format('{{:s}}-CH-{{:04d}}', cast(doc_id AS varchar), posicion) AS chunk_id, num_tokens,
    coalesce(sum(num_tokens) OVER w, 0) AS token_start, coalesce(sum(num_tokens) OVER w, 0) + num_tokens AS token_end,
    coalesce(sum(length(texto) + 1) OVER w, 0) AS char_start, coalesce(sum(length(texto) + 1) OVER w, 0) + length(texto) AS char_end
    FROM token WINDOW w AS (PARTITION BY doc_id ORDER BY posicion ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
)
def chunk_offsets(spark, d):
    return ingest.plain_chunks(table(spark, d, "documents")).select("doc_id", "posicion", "chunk_id", "num_tokens", "token_start", "token_end", "char_start", "char_end")


TOC_TERMS_SQL = " + ".join(f"cast(contains(lower(s), '{t}') AS integer)" for t in T.W.TOC_TERMS)


@query(
    rf"""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN len(regexp_extract_all(s, '{WORD_SQL}')) <= 15 THEN 'corto'
    WHEN NOT regexp_matches(trim(s), '[A-Za-zÀ-ÿ]') AND regexp_matches(trim(s), '\d') AND NOT regexp_matches(trim(s), '[%$€£¥₹]|\b(?:19|20)\d{{2}}\b') THEN 'ruido_numerico'
    WHEN ({TOC_TERMS_SQL}) >= 2 AND (pages >= 4 OR (contains(s, '|---') OR length(s) - length(replace(s, '|', '')) >= 6) AND pages >= 3) THEN 'ruido_indice' END AS reason
    FROM (SELECT s, len(list_filter(regexp_extract_all(s, '[\p{{L}}\p{{N}}_]+'), lambda x: regexp_full_match(x, '\d{{1,3}}'))) AS pages FROM (SELECT unnest(s) AS s FROM ({SENTENCES})))) GROUP BY 1"""
)
def chunk_filter_reasons(spark, d):
    each = table(spark, d, "documents").select(F.explode(segment.sentences("text")).alias("s"))
    return each.groupBy(packing.reject_reason(F.col("s")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(rf"SELECT doc_id, i AS pos, array_to_string(w[i * 40 + 1 : i * 40 + 40], ' ') AS piece FROM (SELECT doc_id, w, unnest(range(0, (len(w) + 39) // 40)) AS i FROM (SELECT doc_id, list_filter(string_split({FLAT}, ' '), lambda x: x <> '') AS w FROM documents))")
def hard_split(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(packing.hard_split("text", 40)).alias("pos", "piece"))


@query()
def chunk_overlap(spark, d):
    """Chunks of whole sentences that share a sentence where the next goes on."""
    return table(spark, d, "documents").select("doc_id", F.posexplode(packing.pack_overlapping("text", 1)).alias("posicion", "texto"))


@query()
def chunk_markdown(spark, d):
    """Documents as sections, paragraphs and chunks."""
    return ingest.markdown_chunks(table(spark, d, "documents"))


@query()
def chunk_semantic(spark, d):
    """Sentences with vectors of the default encoder, cut where neighbours differ."""
    each = table(spark, d, "documents").select("doc_id", F.posexplode(segment.sentences("text")).alias("pos", "text"))
    keyed = each.withColumn("key", F.concat_ws("-", "doc_id", "pos"))
    vectors = embed.encode(keyed, embed.hashing_encoder(16), "key", "text")
    rows = keyed.join(vectors, "key").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "text", T.word_count("text").alias("words"), "vec"))).alias("units"))
    return rows.select("doc_id", F.posexplode(packing.pack_semantic(F.col("units"))).alias("posicion", "texto"))


@query()
def text_blocks(spark, d):
    return segment.blocks(table(spark, d, "documents"))


BANG_SQL = T.W.BANG_LINE.replace("'", "''")


@query(
    rf"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(string_agg(trim(regexp_replace(line, '[ \t]+', ' ', 'g')), chr(10) ORDER BY i), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+', ''), '\s+$', '') AS text, 0::BIGINT AS repaired, 0::BIGINT AS removed FROM (
    SELECT doc_id, i, w[i] AS line FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, string_split(regexp_replace(nfc_normalize(replace(replace(replace(text, '. ', '.' || chr(10) || '!!  ' || chr(10)), ', ', ',' || chr(10) || ' Página 12' || repeat(chr(10), 4)), 'é', 'e' || chr(769))), '[^\P{{C}}\n\t\f]', '', 'g'), chr(10)) AS w FROM documents)))
    WHERE NOT regexp_full_match(trim(line), '(?i)(?:página|page)?\s*[-–—]?\s*\d{{1,4}}\s*') AND NOT (doc_id % 2 = 0 AND regexp_matches(trim(line), '{BANG_SQL}')) GROUP BY doc_id"""
)
def clean_first_pass(spark, d):
    """Documents with accents apart, page numbers and bang lines, which go from every second one, a PDF."""
    broken = F.replace(F.replace("text", F.lit(". "), F.lit(".\n!!  \n")), F.lit(", "), F.lit(",\n Página 12\n\n\n\n"))
    broken = F.replace(broken, F.lit("é"), F.lit("e\u0301"))
    docs = table(spark, d, "documents").select("doc_id", broken.alias("text"), F.when(F.col("doc_id") % 2 == 0, "PDF").otherwise("txt").alias("formato"))
    cleaned = lines.clean(docs, format="formato")
    return cleaned.withColumns({n: F.col(n).cast("long") for n in ("repaired", "removed")})


@query()
def clean_second_pass(spark, d):
    return lines.second_pass(table(spark, d, "documents"))


@query(
    """SELECT doc_id, string_agg(line, chr(10) ORDER BY p, i) AS text, sum(cast(again AS integer)) AS removed FROM (
    SELECT doc_id, p, i, CASE WHEN NOT again THEN line END AS line, again FROM (
    SELECT *, pages > 1 AND trim(line) <> '' AND length(trim(line)) <= 180 AND count(*) OVER (PARTITION BY doc_id, trim(line)) >= greatest(2, (pages + 1) // 2) AS again FROM (
    SELECT doc_id, pages, p, i, l[i] AS line FROM (SELECT doc_id, pages, p, l, unnest(range(1, len(l) + 1)) AS i FROM (
    SELECT doc_id, pages, p, string_split(CASE WHEN pages > 1 THEN b[p] || chr(10) ELSE b[p] END, chr(10)) AS l FROM (SELECT doc_id, len(b) AS pages, b, unnest(range(1, len(b) + 1)) AS p FROM (
    SELECT doc_id, string_split(replace(text, '.' || chr(10), '.' || chr(12) || 'HEAD' || chr(10)), chr(12)) AS b FROM documents))))))
    WHERE NOT regexp_full_match(trim(line), '(?i)(?:página|page)?\\s*[-–—]?\\s*\\d{1,4}\\s*')) GROUP BY doc_id"""
)
def page_furniture(spark, d):
    """Documents paged at lines that end sentences, each page under the same head."""
    paged = table(spark, d, "documents").select("doc_id", F.replace("text", F.lit(".\n"), F.lit(".\fHEAD\n")).alias("text"))
    return lines.drop_page_furniture(paged)


# -- pages, tables, JSON --

STRIPPED = "html"
for _tag in ("script", "style", "noscript", "svg"):
    STRIPPED = f"regexp_replace({STRIPPED}, '(?is)<{_tag}.*?</{_tag}>', ' ', 'g')"
STRIPPED = f"regexp_replace({STRIPPED}, '(?s)<[^>]+>', chr(10), 'g')"
for _entity, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    STRIPPED = f"replace({STRIPPED}, '{_entity}', '{_char}')"


@query(f"SELECT page_id, {STRIPPED} AS text FROM pages")
def html_text(spark, d):
    return table(spark, d, "pages").select("page_id", html.strip_tags("html").alias("text"))


@query("SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title FROM pages")
def html_title(spark, d):
    return table(spark, d, "pages").select("page_id", html.title("html").alias("title"))


@query("""SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*href="([^"]*)"', 1)) AS link FROM pages""")
def html_links(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(html.links("html")).alias("link"))


@query()
def html_visible(spark, d):
    """Visible text by a parser, over files' bytes."""
    from siltstone.sources import files

    pages = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("path"), F.lit("html").alias("formato"), F.col("html").cast("binary").alias("content"))
    return files.extract(pages).select(F.col("path").cast("long").alias("page_id"), "text", "metadata")


CLEAN_LINE = r"""trim(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(l, '\x{FEFF}', '', 'g'), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g')), '^(?i)\s*\[fila\s+\d+\]\s*[:\-]?\s*', ''))"""


@query(
    rf"""SELECT doc_id, posicion, format('{{:s}}-CH-{{:04d}}', cast(doc_id AS varchar), posicion) AS chunk_id, texto, n AS num_palabras, cast(round_even(1.3::DOUBLE * n, 0) AS bigint) AS num_tokens FROM (
    SELECT doc_id, texto, len(string_split(texto, ' ')) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS posicion FROM (
    SELECT doc_id, i, {CLEAN_LINE} AS texto FROM (SELECT doc_id, i, w[i] AS l FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS w FROM documents)))) WHERE texto <> '')"""
)
def record_chunks(spark, d):
    return records.record_chunks(table(spark, d, "documents"), most=1_000_000)


@query(
    rf"""WITH RECURSIVE line AS (SELECT doc_id, i, {CLEAN_LINE} AS r FROM (SELECT doc_id, i, w[i] AS l FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS w FROM documents)))),
    sized AS (SELECT doc_id, i, r, string_split(r, ' ') AS w, list_filter(list_transform(string_split(r, '|'), lambda x: trim(x)), lambda x: x <> '') AS fields FROM line WHERE r <> ''),
    long AS (SELECT * FROM sized WHERE len(w) > 60),
    field AS (SELECT doc_id, i, j, fields[j] AS t, string_split(fields[j], ' ') AS w FROM (SELECT doc_id, i, fields, unnest(range(1, len(fields) + 1)) AS j FROM long WHERE len(fields) > 1)),
    part AS (SELECT doc_id, i, j, 0 AS k, t, len(w) AS n, false AS alone FROM field WHERE len(w) <= 60
      UNION ALL SELECT doc_id, i, j, k, array_to_string(w[k * 60 + 1 : k * 60 + 60], ' '), 0, true FROM (SELECT *, unnest(range(0, (len(w) + 59) // 60)) AS k FROM field WHERE len(w) > 60)),
    unit AS (SELECT *, row_number() OVER (PARTITION BY doc_id, i ORDER BY j, k) AS u FROM part),
    fold(doc_id, i, u, grp, cur) AS (SELECT doc_id, i, u, 0, n FROM unit WHERE u = 1
      UNION ALL SELECT x.doc_id, x.i, x.u, CASE WHEN x.alone OR f.cur = 0 OR f.cur + x.n > 60 THEN f.grp + 1 ELSE f.grp END, CASE WHEN x.alone OR f.cur = 0 OR f.cur + x.n > 60 THEN x.n ELSE f.cur + x.n END FROM fold f JOIN unit x ON x.doc_id = f.doc_id AND x.i = f.i AND x.u = f.u + 1),
    piece AS (SELECT doc_id, i, 0 AS p, r AS texto FROM sized WHERE len(w) <= 60
      UNION ALL SELECT doc_id, i, k, array_to_string(w[k * 60 + 1 : k * 60 + 60], ' ') FROM (SELECT *, unnest(range(0, (len(w) + 59) // 60)) AS k FROM long WHERE len(fields) <= 1)
      UNION ALL SELECT f.doc_id, f.i, f.grp, string_agg(x.t, ' | ' ORDER BY x.u) FROM fold f JOIN unit x ON x.doc_id = f.doc_id AND x.i = f.i AND x.u = f.u GROUP BY ALL)
    SELECT doc_id, posicion, format('{{:s}}-CH-{{:04d}}', cast(doc_id AS varchar), posicion) AS chunk_id, texto, n AS num_palabras, cast(round_even(1.3::DOUBLE * n, 0) AS bigint) AS num_tokens
    FROM (SELECT doc_id, texto, len(string_split(texto, ' ')) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i, p) - 1 AS posicion FROM piece)"""
)
def record_chunks_split(spark, d):
    """Records of at most 60 words, cut at bars and else by words."""
    return records.record_chunks(table(spark, d, "documents"), most=60)


@query("SELECT c_custkey, 'c_custkey: ' || c_custkey || ' | c_name: ' || c_name || ' | c_nationkey: ' || c_nationkey || ' | c_mktsegment: ' || c_mktsegment AS line FROM customer")
def row_pairs(spark, d):
    return tables.table_lines(table(spark, d, "customer"), "c_custkey", ("c_acctbal",))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query(
    r"""SELECT event_id, trim(concat_ws(' ', 'Tipo: ' || event_type, cast(user_id AS varchar))) AS text FROM events"""
)
def labelled_text(spark, d):
    source = F.concat(F.lit("type: "), F.col("event_type"), F.lit("\nuser: "), F.col("user_id").cast("string"), F.lit("\ntitle: dropped"))
    return table(spark, d, "events").select("event_id", jsons.labelled_text(source).alias("text"))


# -- vectors --

DOT = "round(list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6)"


def _ranked_sql(k: int, where: str = "true", v: str = "v.embedding", q: str = "q.embedding") -> str:
    return f"""SELECT q.vec_id AS query_id, v.vec_id, v.label, list_dot_product({q}::DOUBLE[], {v}::DOUBLE[]) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product({q}::DOUBLE[], {v}::DOUBLE[]) DESC, v.vec_id) AS rank
    FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0 AND {where} QUALIFY rank <= {k}"""


def _vectors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    v = table(spark, d, "embeddings")
    return v, v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qvec"))


def _corpus(v: DataFrame) -> DataFrame:
    return v.select("vec_id", F.col("label").alias("doc_id"))


def _rounded(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: F.round(n, 6) for n in names})


@query(f"SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ({_ranked_sql(10)})")
def cosine_topk(spark, d):
    return _rounded(search.exact_topk(*_vectors(spark, d), 10), "score")


@query(f"SELECT query_id, rank, vec_id, round(score, 6) AS score, label FROM ({_ranked_sql(20)}) WHERE label = 3")
def cosine_topk_filtered(spark, d):
    v, q = _vectors(spark, d)
    return _rounded(search.candidates(v, q, 20, v.select("vec_id", "label"), F.col("label") == 3), "score")


@query(f"SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ({_ranked_sql(10, 'v.label = 3')})")
def prefiltered_topk(spark, d):
    v, q = _vectors(spark, d)
    return _rounded(search.candidates(v, q, 10, pre_filter=F.col("label") == 3), "score")


def _pooled_sql(agg: str, source: str) -> str:
    return f"""SELECT query_id, rank, doc_id, round(score, 6) AS score FROM (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first, doc_id) AS rank FROM (
    SELECT query_id, label AS doc_id, {agg} AS score, min(rank) AS first FROM (SELECT *, row_number() OVER (PARTITION BY query_id, label ORDER BY score DESC, rank) AS n FROM ({source})) GROUP BY ALL)) WHERE rank <= 3"""


@query(_pooled_sql("avg(score) FILTER (n <= 3)", _ranked_sql(20)))
def retrieve_base(spark, d):
    v, q = _vectors(spark, d)
    return _rounded(search.retrieve_base(v, q, _corpus(v))[0], "score")


@query(f"SELECT query_id, rank, vec_id, doc_id, round(score, 6) AS score FROM (SELECT query_id, rank, vec_id, label AS doc_id, score FROM ({_ranked_sql(20)})) WHERE rank <= 10")
def retrieve_base_fragments(spark, d):
    v, q = _vectors(spark, d)
    return _rounded(search.retrieve_base(v, q, _corpus(v))[1], "score")


@query(f"SELECT query_id, rank, doc_id, round(score, 6) AS score FROM (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY first) AS rank FROM (SELECT query_id, label AS doc_id, min(rank) AS first, max(score) AS score FROM ({_ranked_sql(20)}) GROUP BY ALL)) WHERE rank <= 3")
def retrieve_v1(spark, d):
    v, q = _vectors(spark, d)
    return _rounded(search.retrieve_v1(v, q, _corpus(v))[0], "score")


def _pool(how: str) -> Query:
    def run(spark, d):
        v, q = _vectors(spark, d)
        return _rounded(search.pool_documents(search.candidates(v, q, 50, _corpus(v)), how), "score")

    run.__name__ = f"doc_pool_{how}"
    return run


for _how, _agg in (("mean3", "avg(score) FILTER (n <= 3)"), ("sum", "sum(score)"), ("mean", "avg(score)"), ("max", "max(score)")):
    query(_pooled_sql(_agg, _ranked_sql(50)))(_pool(_how))


def _halves(spark: SparkSession, d: str) -> list[DataFrame]:
    v, q = _vectors(spark, d)
    out = []
    for start in (1, 33):
        part = v.select("vec_id", F.slice("embedding", start, 32).alias("embedding"))
        out.append(search.exact_topk(part, q.select("query_id", F.slice("qvec", start, 32).alias("qvec")), 10))
    return out


LISTS = " UNION ALL ".join(f"SELECT query_id, vec_id, rank, score FROM ({_ranked_sql(10, 'true', f'v.embedding[{a}:{b}]', f'q.embedding[{a}:{b}]')})" for a, b in ((1, 32), (33, 64)))


def _fused_sql(score: str) -> str:
    return f"SELECT query_id, vec_id, round(s, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM (SELECT query_id, vec_id, {score} AS s FROM ({LISTS}) GROUP BY ALL)"


@query(_fused_sql("sum(1 / (60.0::DOUBLE + rank))"))
def rrf(spark, d):
    return _rounded(fusion.rrf(_halves(spark, d)), "score")


@query(_fused_sql("sum(score)"))
def combsum(spark, d):
    return _rounded(fusion.comb_sum(_halves(spark, d)), "score")


@query(_fused_sql("sum(score) * count(*) FILTER (score > 0)"))
def combmnz(spark, d):
    return _rounded(fusion.comb_mnz(_halves(spark, d)), "score")


@query(_pooled_sql("avg(score) FILTER (n <= 3)", f"SELECT query_id, vec_id, label, s AS score, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM (SELECT query_id, vec_id, sum(1 / (60.0::DOUBLE + rank)) AS s FROM ({LISTS}) GROUP BY ALL) JOIN embeddings USING (vec_id)"))
def retrieve_hybrid(spark, d):
    v, _ = _vectors(spark, d)
    return _rounded(retrieval.retrieve_hybrid(_halves(spark, d), _corpus(v))[0], "score")


@query(f"SELECT query_id, vec_id, rank, round(CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END, 6) AS relevance FROM ({_ranked_sql(20)}) WINDOW w AS (PARTITION BY query_id)")
def minmax_scores(spark, d):
    v, q = _vectors(spark, d)
    return _rounded(fusion.rescale(search.exact_topk(v, q, 20)).select("query_id", "vec_id", "rank", "relevance"), "relevance")


def _half_score() -> "F.Column":
    return V.dot(F.slice("qvec", 1, 32), F.slice("embedding", 1, 32))


def _diverse_sql(recall: int, near: float | None) -> str:
    """Ten fragments of each query by relevance (half of the dimensions) and diversity; near: first without candidates that are like a better one."""
    keep = "true" if near is None else "list_contains(kept, vec_id)"
    return f"""WITH RECURSIVE found AS (SELECT p.query_id, p.vec_id, p.label AS doc_id, p.rank AS recall_rank, p.score AS recall_score, list_dot_product(q.embedding[1:32]::DOUBLE[], e.embedding[1:32]::DOUBLE[]) AS score, e.embedding::DOUBLE[] AS v FROM ({_ranked_sql(recall)}) p JOIN embeddings e USING (vec_id) JOIN embeddings q ON q.vec_id = p.query_id),
    ordered AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, recall_rank) AS i FROM found),
    alike AS (SELECT a.query_id, a.vec_id AS a, list(b.vec_id) AS bs FROM ordered a JOIN ordered b ON a.query_id = b.query_id AND a.i > b.i WHERE list_dot_product(a.v, b.v) >= {near or 2} GROUP BY ALL),
    walk(query_id, step, kept) AS (SELECT query_id, 1, [vec_id] FROM ordered WHERE i = 1
      UNION ALL SELECT w.query_id, w.step + 1, CASE WHEN list_has_any(coalesce(l.bs, []), w.kept) THEN w.kept ELSE list_append(w.kept, o.vec_id) END FROM walk w JOIN ordered o ON o.query_id = w.query_id AND o.i = w.step + 1 LEFT JOIN alike l ON l.query_id = o.query_id AND l.a = o.vec_id),
    pool AS (SELECT o.*, CASE WHEN max(score) OVER w = min(score) OVER w THEN 1.0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS rel FROM ordered o JOIN (SELECT query_id, arg_max(kept, step) AS kept FROM walk GROUP BY 1) USING (query_id) WHERE {keep} WINDOW w AS (PARTITION BY query_id)),
    sim AS (SELECT a.query_id, a.vec_id AS a, b.vec_id AS b, list_dot_product(a.v, b.v) AS s FROM pool a JOIN pool b ON a.query_id = b.query_id),
    pick(query_id, step, chosen) AS (SELECT query_id, 1, [arg_min(vec_id, i)] FROM pool GROUP BY query_id
      UNION ALL SELECT query_id, step + 1, list_append(chosen, vec_id) FROM (SELECT p.query_id, p.step, p.chosen, c.vec_id, row_number() OVER (PARTITION BY p.query_id ORDER BY 0.7::DOUBLE * c.rel - 0.3::DOUBLE * (SELECT max(s) FROM sim WHERE sim.query_id = p.query_id AND a = c.vec_id AND list_contains(p.chosen, b)) DESC, c.i) AS n
        FROM pick p JOIN pool c ON c.query_id = p.query_id AND NOT list_contains(p.chosen, c.vec_id) WHERE p.step < 10) WHERE n = 1),
    last AS (SELECT query_id, arg_max(chosen, step) AS chosen FROM pick GROUP BY 1)
    SELECT pool.query_id, recall_rank, vec_id, round(recall_score, 6) AS recall_score, doc_id, round(score, 6) AS score, list_position(chosen, vec_id) AS rank FROM pool JOIN last USING (query_id) WHERE list_contains(chosen, vec_id)"""


@query(_diverse_sql(50, None))
def retrieve_v2(spark, d):
    v, q = _vectors(spark, d)
    return _rounded(retrieval.retrieve_v2(v, q, _half_score(), _corpus(v))[1].drop("embedding"), "score", "recall_score")


@query(_diverse_sql(100, 0.4))
def retrieve_v3(spark, d):
    v, q = _vectors(spark, d)
    return _rounded(retrieval.retrieve_v3(v, q, _half_score(), _corpus(v), near=0.4)[1].drop("embedding"), "score", "recall_score")


@query(
    f"""WITH RECURSIVE pool AS (SELECT p.query_id, p.vec_id, p.score, p.rank, e.embedding, (p.score - min(p.score) OVER w) / (max(p.score) OVER w - min(p.score) OVER w) AS rel FROM ({_ranked_sql(30)}) p JOIN embeddings e USING (vec_id) WINDOW w AS (PARTITION BY query_id)),
    sim AS (SELECT a.query_id, a.vec_id AS a, b.vec_id AS b, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s FROM pool a JOIN pool b ON a.query_id = b.query_id),
    pick(query_id, step, chosen) AS (SELECT query_id, 1, [arg_min(vec_id, rank)] FROM pool GROUP BY query_id
      UNION ALL SELECT query_id, step + 1, list_append(chosen, vec_id) FROM (SELECT p.query_id, p.step, p.chosen, c.vec_id, row_number() OVER (PARTITION BY p.query_id ORDER BY 0.7::DOUBLE * c.rel - 0.3::DOUBLE * (SELECT max(s) FROM sim WHERE sim.query_id = p.query_id AND a = c.vec_id AND list_contains(p.chosen, b)) DESC, c.rank) AS n
        FROM pick p JOIN pool c ON c.query_id = p.query_id AND NOT list_contains(p.chosen, c.vec_id) WHERE p.step < 5) WHERE n = 1)
    SELECT query_id, i AS rank, chosen[i] AS vec_id FROM (SELECT query_id, chosen, unnest(range(1, 6)) AS i FROM pick WHERE step = 5)"""
)
def mmr(spark, d):
    v, q = _vectors(spark, d)
    found = search.exact_topk(v, q, 30).join(v.select("vec_id", "embedding"), "vec_id")
    return fusion.mmr(fusion.rerank(found, F.col("recall_score")), 5).select("query_id", "rank", "vec_id")


@query(
    f"""WITH RECURSIVE pool AS (SELECT p.query_id, p.vec_id, p.score, p.rank, e.embedding::DOUBLE[] AS v FROM ({_ranked_sql(50)}) p JOIN embeddings e USING (vec_id)),
    alike AS (SELECT a.query_id, a.vec_id AS a, list(b.vec_id) AS bs FROM pool a JOIN pool b ON a.query_id = b.query_id AND a.rank > b.rank WHERE list_dot_product(a.v, b.v) >= 0.35 GROUP BY ALL),
    walk(query_id, step, kept) AS (SELECT query_id, 1, [vec_id] FROM pool WHERE rank = 1
      UNION ALL SELECT w.query_id, w.step + 1, CASE WHEN list_has_any(coalesce(l.bs, []), w.kept) THEN w.kept ELSE list_append(w.kept, p.vec_id) END FROM walk w JOIN pool p ON p.query_id = w.query_id AND p.rank = w.step + 1 LEFT JOIN alike l ON l.query_id = p.query_id AND l.a = p.vec_id)
    SELECT query_id, rank AS recall_rank, vec_id, round(score, 6) AS recall_score, round(score, 6) AS score FROM pool JOIN (SELECT query_id, arg_max(kept, step) AS kept FROM walk GROUP BY 1) USING (query_id) WHERE list_contains(kept, vec_id)"""
)
def near_dup_greedy(spark, d):
    """The pool of each query without what is like a better candidate."""
    v, q = _vectors(spark, d)
    found = search.exact_topk(v, q, 50).join(v.select("vec_id", "embedding"), "vec_id")
    return _rounded(fusion.drop_near(fusion.rerank(found, F.col("recall_score")), 0.35).drop("embedding"), "score", "recall_score")


@query(f"WITH pool AS (SELECT p.query_id, p.vec_id, e.embedding::DOUBLE[] AS v FROM ({_ranked_sql(50)}) p JOIN embeddings e USING (vec_id)) SELECT a.query_id, a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.v, b.v), 6) AS similarity FROM pool a JOIN pool b ON a.query_id = b.query_id AND a.vec_id < b.vec_id WHERE list_dot_product(a.v, b.v) >= 0.35")
def near_dup_pairs(spark, d):
    """Pairs within each query's pool of fifty."""
    v, q = _vectors(spark, d)
    return _rounded(search.near_pairs(search.exact_topk(v, q, 50).join(v.select("vec_id", "embedding"), "vec_id"), 0.35), "similarity")


@query("SELECT vec_id, label, round(list_dot_product(embedding::DOUBLE[], lead(embedding) OVER (PARTITION BY label ORDER BY vec_id)::DOUBLE[]), 6) AS similarity FROM embeddings")
def adjacent_similarity(spark, d):
    rows = search.adjacent_similarity(table(spark, d, "embeddings"), "label", "vec_id")
    return _rounded(rows.select("vec_id", "label", "similarity"), "similarity")


@query("SELECT vec_id, round(list_sum(list_transform(embedding::DOUBLE[], lambda x: (2 * x) * (2 * x))), 6) AS squared, 1.0 AS unit FROM embeddings")
def unit_vectors(spark, d):
    double = F.transform("embedding", lambda x: x.cast("double") * 2)
    return table(spark, d, "embeddings").select("vec_id", F.round(V.dot(double, double), 6).alias("squared"), F.round(V.norm(V.unit(double)), 6).alias("unit"))


@query()
def encode_documents(spark, d):
    """Vectors of texts by the default encoder."""
    return _rounded(embed.encode(table(spark, d, "documents"), embed.hashing_encoder(8), "doc_id", "text").select("doc_id", F.posexplode("vec").alias("dim", "x")).withColumn("x", F.col("x").cast("double")), "x")


@query(
    """WITH tok AS (SELECT vec_id // 10 AS doc_id, vec_id % 10 // 5 AS win, vec_id % 10 AS t, embedding FROM embeddings),
    chunk AS (SELECT DISTINCT doc_id, c FROM tok, (SELECT unnest([0, 1, 2]) AS c)),
    w AS (SELECT chunk.doc_id, c, win, d, avg(embedding[d]::DOUBLE) AS x FROM tok JOIN chunk ON tok.doc_id = chunk.doc_id AND t * 5 + 5 > c * 15 AND t * 5 < c * 15 + 18, (SELECT unnest(range(1, 65)) AS d) GROUP BY ALL),
    m AS (SELECT doc_id, c, d, avg(x) AS x FROM w GROUP BY ALL)
    SELECT doc_id || '-' || c AS chunk_id, d - 1 AS dim, round(x / greatest(sqrt(sum(x * x) OVER (PARTITION BY doc_id, c)), 1e-12), 6) AS x FROM m"""
)
def late_pooling(spark, d):
    """Vectors as tokens of five characters, ten a document, in two windows."""
    v = table(spark, d, "embeddings")
    doc, t = F.floor(F.col("vec_id") / 10).alias("doc_id"), F.col("vec_id") % 10
    tokens = v.select(doc, F.floor(t / 5).alias("window"), (t * 5).alias("tok_start"), (t * 5 + 5).alias("tok_end"), F.col("embedding").alias("vec"))
    chunks = v.select(doc).distinct().select("doc_id", F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("c"))
    chunks = chunks.select("doc_id", F.concat_ws("-", "doc_id", "c").alias("chunk_id"), (F.col("c") * 15).alias("char_start"), (F.col("c") * 15 + 18).alias("char_end"))
    return _rounded(embed.late_pool(tokens, chunks).select("chunk_id", F.posexplode("vec").alias("dim", "x")), "x")


# -- scores --

BM25 = """WITH asked AS (SELECT item_id AS query_id, unnest(list_distinct(list_filter(string_split(trim(regexp_replace(lower(text), '[\\s\\p{Z}]+', ' ', 'g')), ' '), lambda x: x <> ''))) AS term FROM benchmark),
w AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(lower(text), '[\\s\\p{Z}]+', ' ', 'g')), ' '), lambda x: x <> '') AS words FROM documents),
t AS (SELECT count(*) AS n, avg(len(words)) AS mean FROM w),
p AS (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(words) AS len, unnest(words) AS term FROM w) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
s AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 9) AS score FROM asked JOIN p USING (term) JOIN f USING (term), t GROUP BY ALL),
pool AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s QUALIFY rank <= 50),
held AS (SELECT pool.*, d.text, d.source FROM pool JOIN documents d ON d.doc_id = pool.doc_id),
truth AS (SELECT item_id AS query_id, text AS verbatim, CASE WHEN item_id % 2 = 0 THEN 2.0 ELSE 1.0 END AS gain FROM benchmark),
relevant AS (SELECT DISTINCT h.query_id, h.doc_id, h.source FROM held h JOIN truth t ON t.query_id = h.query_id AND contains(h.text, t.verbatim)),
matched AS (SELECT t.query_id, t.verbatim, t.gain, min(h.rank) AS pos FROM held h JOIN truth t ON t.query_id = h.query_id AND contains(h.text, t.verbatim) WHERE h.rank <= 10 GROUP BY ALL),
ndcg AS (SELECT t.query_id, coalesce(dcg / idcg, 0.0) AS ndcg FROM (SELECT query_id, sum(gain) AS idcg FROM truth GROUP BY 1) t LEFT JOIN (SELECT query_id, sum(gain / log2(pos + 1.0)) AS dcg FROM (SELECT query_id, pos, max(gain) AS gain FROM matched GROUP BY ALL) GROUP BY 1) g USING (query_id)),
f1 AS (SELECT query_id, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1 FROM (SELECT t.query_id, coalesce(hits, 0) / 3.0::DOUBLE AS p, CASE WHEN n > 0 THEN coalesce(hits, 0) / least(n, 3)::DOUBLE ELSE 0.0 END AS r FROM truth t
  LEFT JOIN (SELECT query_id, count(DISTINCT source) AS n FROM relevant GROUP BY 1) USING (query_id)
  LEFT JOIN (SELECT h.query_id, count(DISTINCT h.source) AS hits FROM held h JOIN relevant r ON r.query_id = h.query_id AND r.source = h.source WHERE h.rank <= 3 GROUP BY 1) USING (query_id)))
"""


@query(f"{BM25} SELECT query_id, rank, doc_id, round(score, 6) AS score FROM pool WHERE rank <= 10")
def lexical_search(spark, d):
    """Every benchmark passage, whole, as a question to all documents."""
    return _rounded(_pool50(spark, d).where("rank <= 10"), "score")


def _pool50(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return search.bm25(table(spark, d, "documents"), asked, 50)


def _results(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(the pool of fifty of each passage with texts and sources, passages, queries)."""
    b = table(spark, d, "benchmark")
    found = _pool50(spark, d).join(table(spark, d, "documents").select("doc_id", "text", "source"), "doc_id")
    label = F.when(F.col("item_id") % 2 == 0, "alta").otherwise("media")
    passages = b.select(F.col("item_id").alias("query_id"), F.col("text").alias("verbatim"), T.relevance_gain(label).alias("gain"))
    return found, passages, b.select(F.col("item_id").alias("query_id"), (F.col("item_id") % 3 + 1).alias("fenomeno"), label.alias("tipo"))


def _relevant(found: DataFrame, passages: DataFrame) -> DataFrame:
    """Documents of a pool that hold the passage."""
    return found.join(passages, "query_id").where(F.contains("text", "verbatim")).select("query_id", "doc_id", "source").distinct()


@query(f"{BM25} SELECT * FROM matched")
def substring_matches(spark, d):
    found, passages, _ = _results(spark, d)
    return metrics.first_matches(found, passages)


@query(f"{BM25} SELECT query_id, round(ndcg, 6) AS ndcg FROM ndcg")
def ndcg_at_10(spark, d):
    return _rounded(metrics.ndcg(*_results(spark, d)), "ndcg")


@query(f"{BM25} SELECT query_id, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1 FROM f1")
def f1_at_3(spark, d):
    found, passages, asked = _results(spark, d)
    predicted = metrics.sources_of(found.select("query_id", "rank", "doc_id"), table(spark, d, "documents").select("doc_id", "source"))
    return _rounded(metrics.f1(predicted, _relevant(found, passages), asked), "precision", "recall", "f1")


@query(
    f"""{BM25} SELECT CASE WHEN grouping(fenomeno) = 0 THEN 'fenomeno' WHEN grouping(tipo) = 0 THEN 'tipo' ELSE 'total' END AS dimension, coalesce(fenomeno, tipo, 'total') AS value, count(*) AS queries, round(avg(ndcg), 6) AS ndcg, round(avg(f1), 6) AS f1
    FROM (SELECT query_id, cast(query_id % 3 + 1 AS varchar) AS fenomeno, CASE WHEN query_id % 2 = 0 THEN 'alta' ELSE 'media' END AS tipo, ndcg, f1 FROM ndcg JOIN f1 USING (query_id)) GROUP BY GROUPING SETS ((), (fenomeno), (tipo))"""
)
def metrics_by_group(spark, d):
    found, passages, asked = _results(spark, d)
    per_query = evaluation.evaluate(found, found, passages, _relevant(found, passages), asked)
    return _rounded(metrics.report(per_query, "fenomeno", "tipo"), "ndcg", "f1")


@query(f"{BM25} SELECT round(avg(coalesce(hit, 0)), 6) AS hit_rate FROM truth LEFT JOIN (SELECT DISTINCT h.query_id, 1.0 AS hit FROM held h JOIN relevant r ON r.query_id = h.query_id AND r.doc_id = h.doc_id WHERE h.rank <= 3) USING (query_id)")
def hit_rate_at_3(spark, d):
    found, passages, asked = _results(spark, d)
    return _rounded(metrics.hit_rate(found, _relevant(found, passages), 3, "doc_id", asked), "hit_rate")


@query(f"{BM25} SELECT count(*) AS fragments, round(1 - count(DISTINCT text) / count(*), 6) AS duplicate_rate FROM held")
def duplicate_results(spark, d):
    return _rounded(metrics.duplicate_rate(_results(spark, d)[0], "text"), "duplicate_rate")


@query(f"{BM25} SELECT count(*) AS fragments, round(avg(cast(NOT regexp_matches(rtrim(text), '[.!?。！？][\"''”’»)\\]]*$') AS integer)), 6) AS incomplete_rate FROM held")
def incomplete_results(spark, d):
    return _rounded(metrics.incomplete_rate(_results(spark, d)[0], "text"), "incomplete_rate")


@query("SELECT config, points, row_number() OVER (ORDER BY points DESC, ndcg DESC, config) AS rank FROM (SELECT *, 2 * count(*) OVER () - rank() OVER (ORDER BY ndcg DESC) - rank() OVER (ORDER BY f1 DESC) AS points FROM (SELECT s_nationkey AS config, round(avg(s_acctbal), 2) AS ndcg, count(*) AS f1 FROM supplier GROUP BY 1))")
def borda(spark, d):
    scores = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("config")).agg(F.round(F.avg("s_acctbal"), 2).alias("ndcg"), F.count(F.lit(1)).alias("f1"))
    return metrics.borda(scores, ("ndcg", "f1"), "ndcg")


# -- graph --

CHUNKS = "SELECT doc_id AS row_no, cast(doc_id AS varchar) AS doc_id, doc_id || '-CH-0000' AS chunk_id, source AS fuente, doc_id % 3 + 1 AS fenomeno, lang AS idioma, text AS texto FROM documents"
ENTITIES = rf"SELECT row_no, i - 1 AS seq, doc_id, chunk_id, l[i] AS label, CASE WHEN contains(l[i], ' ') THEN 'organization' ELSE 'location' END AS kind FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM (SELECT *, regexp_extract_all(texto, '\p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)*') AS l FROM ({CHUNKS})))"
NODE = "kind || ':' || lower(left(trim(regexp_replace(label, '[\\s\\p{Z}]+', ' ', 'g')), 500))"


def _graph_chunks(spark: SparkSession, d: str) -> DataFrame:
    doc = F.col("doc_id").cast("string")
    return table(spark, d, "documents").select(F.col("doc_id").alias("row_no"), doc.alias("doc_id"), F.concat(doc, F.lit("-CH-0000")).alias("chunk_id"), F.col("source").alias("fuente"), (F.col("doc_id") % 3 + 1).alias("fenomeno"), F.col("lang").alias("idioma"), F.col("text").alias("texto"))


@query(
    f"""SELECT DISTINCT 'doc:' || doc_id AS id, 'document' AS kind, doc_id AS label FROM ({CHUNKS}) UNION ALL SELECT DISTINCT 'chunk:' || chunk_id, 'chunk', chunk_id FROM ({CHUNKS})
    UNION ALL SELECT DISTINCT 'source:' || lower(fuente), 'source', fuente FROM ({CHUNKS}) UNION ALL SELECT DISTINCT 'phenomenon:' || fenomeno, 'phenomenon', 'Fenómeno ' || fenomeno FROM ({CHUNKS})"""
)
def kg_vertices(spark, d):
    return graph.structural_vertices(_graph_chunks(spark, d)).select("id", "kind", "label")


@query(
    f"""SELECT DISTINCT 'doc:' || doc_id AS src, 'chunk:' || chunk_id AS dst, 'contains' AS relation FROM ({CHUNKS}) UNION ALL SELECT DISTINCT 'doc:' || doc_id, 'source:' || lower(fuente), 'comes_from' FROM ({CHUNKS}) UNION ALL SELECT DISTINCT 'doc:' || doc_id, 'phenomenon:' || fenomeno, 'belongs_to' FROM ({CHUNKS})"""
)
def kg_edges(spark, d):
    return graph.structural_edges(_graph_chunks(spark, d))


@query(f"SELECT 'chunk:' || chunk_id AS src, {NODE} AS dst, 'mentions' AS relation, doc_id, chunk_id FROM ({ENTITIES})")
def kg_mentions(spark, d):
    return graph.mention_edges(graph.capitalised_entities(_graph_chunks(spark, d)))


@query(f"SELECT {NODE} AS id, kind, arg_max(left(label, 500), row_no * 1000000 + seq) AS label FROM ({ENTITIES}) GROUP BY 1, 2")
def kg_entities(spark, d):
    return graph.entity_vertices(graph.capitalised_entities(_graph_chunks(spark, d))).select("id", "kind", "label")


@query(
    f"""SELECT row_no, label, node FROM (SELECT *, coalesce(last_value(known IGNORE NULLS) OVER (PARTITION BY lower(label) ORDER BY row_no, ask, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'entity:' || lower(label)) AS node FROM (
    SELECT row_no, 0 AS ask, seq, label, {NODE} AS known FROM ({ENTITIES}) UNION ALL SELECT doc_id, 1, 0, regexp_extract(text, '\\p{{Lu}}\\p{{Ll}}+'), NULL FROM documents WHERE regexp_extract(text, '\\p{{Lu}}\\p{{Ll}}+') <> '')) WHERE ask = 1"""
)
def kg_asof_kind(spark, d):
    mentions = graph.capitalised_entities(_graph_chunks(spark, d))
    asked = table(spark, d, "documents").select(F.col("doc_id").alias("row_no"), F.regexp_extract("text", r"\p{Lu}\p{Ll}+", 0).alias("label")).where("label <> ''")
    return graph.resolve(asked, mentions)


@query(
    f"""SELECT id, neighbour, count(*) AS n FROM (SELECT 'doc:' || doc_id AS id, 'source:' || lower(fuente) AS neighbour FROM ({CHUNKS}) UNION ALL SELECT 'source:' || lower(fuente), 'doc:' || doc_id FROM ({CHUNKS})) GROUP BY ALL"""
)
def kg_neighbours(spark, d):
    return graph.neighbours(graph.structural_edges(_graph_chunks(spark, d)), "comes_from")


@query(
    f"""SELECT 'vertices' AS what, kind, count(DISTINCT id) AS n FROM (SELECT 'document' AS kind, doc_id AS id FROM ({CHUNKS}) UNION ALL SELECT 'chunk', chunk_id FROM ({CHUNKS}) UNION ALL SELECT 'source', lower(fuente) FROM ({CHUNKS}) UNION ALL SELECT 'phenomenon', cast(fenomeno AS varchar) FROM ({CHUNKS})) GROUP BY ALL
    UNION ALL SELECT 'edges', unnest(['contains', 'comes_from', 'belongs_to']), (SELECT count(*) FROM documents)"""
)
def kg_stats(spark, d):
    chunks = _graph_chunks(spark, d)
    return graph.statistics(graph.structural_vertices(chunks), graph.structural_edges(chunks))


@query(f"SELECT src, dst, 'related_to' AS relation, doc_id, chunk_id, 1.0::DOUBLE AS confidence FROM (SELECT doc_id, chunk_id, {NODE} AS src, lead({NODE}) OVER (PARTITION BY chunk_id ORDER BY seq) AS dst FROM ({ENTITIES})) WHERE dst IS NOT NULL")
def kg_relations(spark, d):
    """Neighbouring entities of a chunk as relations, their ends resolved."""
    mentions = graph.capitalised_entities(_graph_chunks(spark, d))
    w = Window.partitionBy("chunk_id").orderBy("seq")
    pairs = mentions.select("row_no", "doc_id", "chunk_id", F.col("label").alias("head"), F.lit("related_to").alias("relation"), F.lead("label").over(w).alias("tail"), F.lit(1.0).alias("confidence")).where("tail IS NOT NULL")
    return graph.relation_edges(pairs, mentions)


MENTIONS = f"SELECT row_no, chunk_id, seq, {NODE} AS entity, lead({NODE}) OVER (PARTITION BY chunk_id ORDER BY seq) AS following FROM ({ENTITIES})"


@query(
    f"""WITH m AS ({MENTIONS}), asked AS (SELECT DISTINCT row_no AS query_id, entity FROM m WHERE row_no % 50 = 0), e AS (SELECT DISTINCT entity AS src, following AS dst FROM m WHERE following IS NOT NULL),
    wanted AS (SELECT query_id, entity FROM asked UNION SELECT query_id, dst FROM asked JOIN e ON e.src = asked.entity UNION SELECT query_id, src FROM asked JOIN e ON e.dst = asked.entity)
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM (SELECT query_id, chunk_id, count(*)::DOUBLE AS score FROM wanted JOIN m USING (entity) GROUP BY ALL)"""
)
def graph_retrieval(spark, d):
    """The entities of every document whose id is divisible by 50 as a question; entities that follow each other are neighbours."""
    kind = F.replace(F.lower("kind"), F.lit(" "), F.lit("_"))
    m = graph.capitalised_entities(_graph_chunks(spark, d)).select("row_no", "chunk_id", "seq", T.node_key(kind, "label").alias("entity"))
    m = spark.read.schema(m.schema).parquet(session.write_shared(m, "found"))
    edges = m.withColumn("dst", F.lead("entity").over(Window.partitionBy("chunk_id").orderBy("seq"))).where("dst IS NOT NULL").select(F.col("entity").alias("src"), "dst")
    asked = m.where("row_no % 50 = 0").select(F.col("row_no").alias("query_id"), "entity").distinct()
    return search.graph_candidates(m.select("entity", "chunk_id"), edges, asked)


# -- manifests and checks --


@query(rf"SELECT lang, count(*) AS n, round(quantile_cont(w, 0.5), 4) AS median, round(quantile_cont(w, 0.75), 4) AS p75, round(quantile_cont(w, 0.9), 4) AS p90 FROM (SELECT lang, len(regexp_extract_all(text, '{WORD_SQL}')) AS w FROM documents) GROUP BY lang")
def word_percentiles(spark, d):
    counted = table(spark, d, "documents").select("lang", T.word_count("text").alias("w"))
    return counted.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *[F.round(F.percentile("w", p), 4).alias(name) for name, p in (("median", 0.5), ("p75", 0.75), ("p90", 0.9))])


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN lang ELSE upper(lang) END AS lang, CASE WHEN l.doc_id IS NULL THEN 1 ELSE 2 END AS version FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def manifest_upsert(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    new = docs.join(table(spark, d, "labels").select("doc_id"), "doc_id").select("doc_id", F.upper("lang").alias("lang"), F.lit(2).alias("version"))
    return dedupe.last_wins(docs.withColumn("version", F.lit(1)), new, "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_pending(spark, d):
    return dedupe.pending(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("SELECT d.doc_id, source, quality, toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id")
def manifest_join(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("doc_id", "source", "quality", "toxic")


@query(
    """SELECT doc_id, chunk_id, fuente_corpus, orden_fuente, orden_doc, orden_chunk FROM (SELECT cast(doc_id AS varchar) AS doc_id, doc_id || '-CH-0000' AS chunk_id, CASE lang WHEN 'en' THEN 'json' WHEN 'es' THEN 'pdf' ELSE 'otros' END AS fuente_corpus, CASE lang WHEN 'en' THEN 0 WHEN 'es' THEN 2 ELSE 1 END AS orden_fuente, doc_id AS orden_doc, 0 AS orden_chunk FROM documents)"""
)
def corpus_union(spark, d):
    chunks = _graph_chunks(spark, d).select("doc_id", "chunk_id", F.coalesce("idioma", F.lit("")).alias("idioma"))
    parts = {"json": chunks.where("idioma = 'en'"), "otros": chunks.where("idioma NOT IN ('en', 'es')"), "pdf": chunks.where("idioma = 'es'")}
    return dedupe.union_corpora(**parts).select("doc_id", "chunk_id", "fuente_corpus", "orden_fuente", "orden_doc", "orden_chunk")


@query("SELECT format('DOC-{:06d}', row_number() OVER (ORDER BY source, doc_id)) AS name, source, doc_id AS number FROM documents")
def document_numbers(spark, d):
    files = table(spark, d, "documents").select("source", F.col("doc_id").alias("number"))
    return dedupe.number_documents(files, "source", "number").select(F.col("doc_id").alias("name"), "source", "number")


STATE = f"CASE WHEN {FLAT} = '' THEN 'fallido' WHEN quality = 0 THEN 'procesado_con_advertencias' ELSE 'procesado' END"


@query(f"SELECT d.doc_id, {STATE} AS estado FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def quality_state(spark, d):
    joined = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    warnings = F.when(F.col("quality") == 0, F.array(F.lit("calidad baja"))).otherwise(F.array().cast("array<string>"))
    return joined.select("doc_id", T.document_state(T.collapse_blanks("text"), warnings).alias("estado"))


@query(f"SELECT estado, count(*) AS n FROM (SELECT {STATE} AS estado FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) GROUP BY 1")
def state_counts(spark, d):
    return sinks.quality_report(quality_state(spark, d))


@query(
    f"SELECT chunk_id AS key, unnest(['falta formato', 'falta num_tokens', 'falta posicion']) AS problem FROM ({CHUNKS}) UNION ALL SELECT chunk_id, 'falta fuente' FROM ({CHUNKS}) WHERE row_no NOT IN (SELECT doc_id FROM labels)"
)
def contract_violations(spark, d):
    labelled = table(spark, d, "labels").select(F.col("doc_id").alias("row_no"), F.lit(True).alias("known"))
    chunks = _graph_chunks(spark, d).join(labelled, "row_no", "left").withColumn("fuente", F.when(F.col("known"), F.col("fuente")))
    return validate.chunk_problems(chunks)


@query("SELECT conv_id, turn, CASE WHEN turn = first THEN text ELSE context || ' | ' || text END AS text FROM (SELECT *, first_value(text) OVER w AS context, first_value(turn) OVER w AS first FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))")
def conversation_context(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, d, "conversations").withColumns({"context": F.first("text").over(w), "first": F.first("turn").over(w)})
    return rows.select("conv_id", "turn", F.when(F.col("turn") == F.col("first"), F.col("text")).otherwise(F.concat("context", F.lit(" | "), "text")).alias("text"))


@query(
    """SELECT sum(n)::BIGINT AS n_rows, sha256(string_agg(h, '' ORDER BY s)) AS fingerprint FROM (SELECT doc_id // 256 AS s, count(*) AS n, sha256(string_agg(h, '' ORDER BY doc_id, h)) AS h
    FROM (SELECT doc_id, sha256(concat_ws('|', cast(doc_id AS varchar), lang, source, text)) AS h FROM documents) GROUP BY 1)"""
)
def table_fingerprint(spark, d):
    record = F.concat_ws("|", F.col("doc_id").cast("string"), "lang", "source", "text")
    return dedupe.ordered_fingerprint(table(spark, d, "documents"), "doc_id", record, 256)


@query("SELECT doc_id, nfc_normalize(replace(replace(text, 'é', 'e' || chr(769)), 'ñ', 'n' || chr(771))) AS text FROM documents")
def compose_accents(spark, d):
    """Texts whose accents were taken apart, composed again."""
    apart = F.replace(F.replace("text", F.lit("é"), F.lit("e\u0301")), F.lit("ñ"), F.lit("n\u0303"))
    return table(spark, d, "documents").select("doc_id", T.nfc(apart).alias("text"))


@query("SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE text END, ''), CASE WHEN doc_id % 2 = 0 THEN source END, '') AS text FROM documents")
def result_texts(spark, d):
    """Results whose text is null, empty or there, with another field to fall back on in half of them."""
    text = F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 3 == 1, "").otherwise(F.col("text"))
    rows = table(spark, d, "documents").select("doc_id", text.alias("text"), F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("texto"))
    return rows.select("doc_id", T.result_text("text", "texto").alias("text"))


_FOLDERS = "CASE n " + " ".join(f"WHEN {i} THEN '{own[2]}'" for i, own in enumerate(T.W.EXPERIMENTS)) + " END"
_CORPORA = "CASE n " + " ".join(f"WHEN {i} THEN '{own[1]}'" for i, own in enumerate(T.W.EXPERIMENTS)) + " END"


@query(f"SELECT n_nationkey, coalesce({_FOLDERS}, n_name) AS folder, coalesce({_CORPORA}, n_name) AS corpus FROM (SELECT *, n_nationkey % 8 AS n FROM nation)")
def experiment_names(spark, d):
    """Rows that name an experiment by its configuration or its corpus, and some that name none."""
    name = F.col("n_name")
    for i, own in enumerate(T.W.EXPERIMENTS):
        name = F.when(F.col("n_nationkey") % 8 == i, own[0] if i % 2 else own[1]).otherwise(name)
    rows = table(spark, d, "nation").select("n_nationkey", T.chunk_folder(name).alias("folder"))
    return rows.select("n_nationkey", "folder", T.corpus_name("folder").alias("corpus"))


@query("SELECT conv_id, count(DISTINCT CASE WHEN turn % 3 > 0 THEN role END) AS n FROM conversations GROUP BY 1")
def alerted_chunks(spark, d):
    """Turns as alerts, their roles as chunks; each third turn is an alert of no chunk."""
    alerts = table(spark, d, "conversations").select("conv_id", F.when(F.col("turn") % 3 > 0, F.col("role")).alias("role"))
    return packing.alerted_chunks(alerts, "conv_id", "role")


@query(f"SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ({_ranked_sql(10)})")
def ivf_all_lists(spark, d):
    """Search over fitted lists, all of them probed, which is exact search."""
    v, q = _vectors(spark, d)
    centres = search.fit_lists(v, 8)
    return _rounded(search.ivf_topk(v, q, centres, 10, len(centres)), "score")


# -- relations and events --


@query(
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL"""
)
def pricing_summary(spark, d):
    rows = table(spark, d, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n"))


@query("SELECT n_name, c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_name, c_mktsegment)")
def segment_rollup(spark, d):
    joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.rollup("n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders QUALIFY rank <= 3")
def top_orders(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return search.best(rows, 3, ("o_custkey",), "o_totalprice", "o_orderkey")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS \"end\", event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_windows(spark, d):
    return streams.event_windows(table(spark, d, "events")).withColumn("total", F.round("total", 4))


@query(
    """SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM (SELECT *, sum(cast(gap AS integer)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 30 MINUTE, true) AS gap FROM events)) GROUP BY user_id, s"""
)
def session_windows(spark, d):
    return streams.sessions(table(spark, d, "events"))


@query("SELECT e.event_id, v.event_id AS last_view FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY ALL) v ON e.user_id = v.user_id AND v.ts <= e.ts WHERE e.event_type = 'purchase'")
def last_view_before_purchase(spark, d):
    """An as-of join by a running last value: no pairs are made."""
    rows = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", F.when(F.col("event_type") == "view", F.col("event_id")).alias("v"))
    w = Window.partitionBy("user_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    views = rows.withColumn("last_view", F.max(F.when(F.col("v").isNotNull(), F.struct("ts", "v"))).over(w).getField("v"))
    return views.where("event_type = 'purchase'").select("event_id", "last_view")


@query()
def encode_late(spark, d):
    """Late vectors of the chunks of whole documents by the default token encoder."""
    docs = table(spark, d, "documents").select("doc_id", T.collapse_blanks("text").alias("text")).where("text <> ''")
    return _rounded(embed.encode_late(docs, ingest.plain_chunks(docs), embed.hashing_token_encoder(4), 512).select("chunk_id", F.posexplode("vec").alias("dim", "x")).withColumn("x", F.col("x").cast("double")), "x")


@query()
def chunk_totals(spark, d):
    """Reasons and forced splits of all sentence chunks."""
    each = table(spark, d, "documents").select("doc_id", F.inline(packing.pack_sentences("text")))
    return packing.chunk_report(each.select("doc_id", F.col("text").alias("texto"), F.col("kind").alias("separado_por")))


@query(f"{PACKED} SELECT doc_id, posicion, format('{{:s}}-CH-{{:04d}}', cast(doc_id AS varchar), posicion) AS chunk_id, texto, n AS num_palabras FROM piece UNION ALL SELECT doc_id, 0, doc_id || '-CH-0000', '', 0 FROM documents WHERE {FLAT} = ''")
def streamed_chunks(spark, d):
    """The packing that streams run, over a table."""
    return streams.chunk_stream(table(spark, d, "documents"))
