"""Every query against its SQL on the smallest tables."""

import decimal
import os

import duckdb
import numpy as np
import pytest
import regex

from siltstone import queries as Q
from siltstone.operators import embed

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, float):
        return None if x != x else round(x, 9)
    if isinstance(x, decimal.Decimal):
        return float(x)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_equals_sql(spark, con, name):
    df = Q.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    cur = con.execute(Q.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = [tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()]
    assert order(got) == order(want)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLE_SQL)))
def test_runs(spark, name):
    assert Q.QUERIES[name](spark, SF).count() > 0


def unit(v):
    n = np.linalg.norm(v)
    return v / n if n else v


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_encode_documents_is_the_encoder(spark, texts):
    encode = embed.hashing_encoder(8)()
    got = {(r["doc_id"], r["dim"]): r["x"] for r in Q.QUERIES["encode_documents"](spark, SF).collect()}
    assert len(got) == 8 * len(texts)
    for i, text in texts.items():
        want = unit(encode([text])[0])
        assert [got[i, k] for k in range(8)] == pytest.approx(want.tolist(), abs=2e-6)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_chunk_semantic_is_plain_packing(spark, texts):
    encode = embed.hashing_encoder(16)()
    got = {}
    for r in Q.QUERIES["chunk_semantic"](spark, SF).collect():
        got.setdefault(r["doc_id"], {})[r["posicion"]] = r["texto"]
    assert set(got) == set(texts)
    for i, text in texts.items():
        found = [s.strip(" ") for s in regex.split(r"(?<=[.!?。！？｡])[ \t\n\x0b\f\r]+", text)]
        found = [s for s in found if s] or [text]
        sizes = [len(regex.findall(r"[\p{L}\p{N}_]+(?:[-'][\p{L}\p{N}_]+)*", s)) for s in found]
        vectors = [unit(encode([s])[0]).astype(np.float32).astype(float) for s in found]
        want, open_, n = [], [], 0
        for k, s in enumerate(found):
            open_.append(s)
            n += sizes[k]
            apart = k + 1 < len(found) and 1 - float(vectors[k] @ vectors[k + 1]) >= 0.8
            if k + 1 == len(found) or apart and n >= 200 or n + sizes[k + 1] > 250:
                want.append(" ".join(open_))
                open_, n = [], 0
        assert [got[i][k] for k in range(len(got[i]))] == want
