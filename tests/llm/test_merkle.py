"""The Merkle manifest against a plain version and its SQL twin."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from logwarden.llm import merkle, oracle, queries

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def said(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(leaves):
    """Levels of digests up to one node."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i:i + 16]) for i in range(0, len(below), 16)])
    return levels


def proof(levels, i):
    """(left, right) siblings of leaf i, level by level."""
    out = []
    for level in levels[:-1]:
        run = i - i % 16
        out.append((level[run:i], level[i + 1:run + 16]))
        i //= 16
    return out


def plain(rows):
    def leaf(r, text):
        return H(*map(said, (r[0], r[3], r[2], r[4], text)))

    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    towers, members = [], []
    for s in order:
        docs = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        members.append(docs)
        towers.append(climb([leaf(r, r[1]) for r in docs]))
    top = climb([t[-1][0] for t in towers])
    root, out = top[-1][0], []
    for k, (docs, tower) in enumerate(zip(members, towers)):
        for i, r in enumerate(docs):
            path = proof(tower, i) + proof(top, k)
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(r, text)
            for left, right in path:
                folded = H(*left, folded, *right)
            out.append((r[0], leaf(r, r[1]), tower[-1][0], root,
                        H(*[h for left, right in path for h in left + right]), folded, folded == root))
    return out


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def check(spark, rows, fan=None):
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], COLUMNS + ", tree int, hash string, idx int, n int")
    found = merkle.audit(docs.repartition(5))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(plain(rows), key=key)


def test_sources_of_many_sizes(spark):
    rows, i = [], 0
    for s, size in enumerate([1, 2, 15, 16, 17, 31, 32, 33, 256, 257, 290, 1, 1, 1, 1, 1, 1, 3]):
        for _ in range(size):
            rows.append((i * 7 % 100_003, f"Text {i} É" if i % 9 else None, "en" if i % 4 else None, f"s{s:02d}", i % 50))
            i += 1
    check(spark, rows)


def test_odd_rows(spark):
    rows = [
        (1, "A b", "en", None, 3), (2, None, None, None, None), (None, "Z", "en", "", 1), (None, None, None, "", None),
        (5, "", "", "É", 0), (5, "", "", "É", 0), (5, "OTHER", "", "É", 0), (-7, "X" * 200_000, "de", "z", 200_000),
        (3, "Ünï Ç", "xx", "Z", 5)] + [(9, "Copy", "en", "hot", 4)] * 40
    check(spark, rows)


@pytest.mark.parametrize("rows", [[(10, "One", "en", "s", 3)], [(10, "One", "en", None, 3), (11, "Two", "en", "s", 3)]])
def test_few_rows(spark, rows):
    check(spark, rows)


def test_empty_table(spark):
    assert merkle.audit(spark.createDataFrame([], COLUMNS)).collect() == []


def test_manifest_does_not_depend_on_the_spread(spark, sf):
    docs = merkle.document_leaves(spark.read.parquet(f"{sf}/documents.parquet"))
    assert merkle.build_manifest(docs).root == merkle.build_manifest(docs.repartition(7, F.rand(3))).root


def test_query_and_sql_twin(spark, sf):
    found = queries.op11_merkle(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = sorted(map(tuple, found.collect()), key=key)
    assert rows == sorted(plain(list(map(tuple, docs.collect()))), key=key)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    twin = db.sql(oracle.ORACLE["op11_merkle"]).select(*found.columns).fetchall()
    assert sorted(twin, key=key) == rows
    assert {r[6] for r in rows} == {True, False}
