import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tools.check_oracle import duck
from vaultline.llm import merkle as M

from ..conftest import SF_SMALL
from . import cases


def exact(rows):
    return sorted(map(tuple, rows), key=repr)


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def part(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """The levels of a tree over a list of hashes."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def beside(levels, pos):
    out = []
    for row in levels[:-1]:
        at = pos - pos % 16
        out.append((row[at:pos], row[pos + 1:at + 16]))
        pos //= 16
    return out


def expected(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    first = lambda v: (v is not None, v)
    leaf = lambda r, text: H(*map(part, (*r[:4], text)))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (first(r[0]), leaf(r, r[4])))
        trees[s] = tree([leaf(r, r[4]) for r in groups[s]])
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for pos, r in enumerate(groups[s]):
            path = beside(trees[s], pos) + beside(top, k)
            text = r[4]
            if text is not None and zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0:
                text = "".join(c.lower() if c < "\x80" else c for c in text)
            node = leaf(r, text)
            for left, right in path:
                node = H(*left, node, *right)
            root = top[-1][0]
            out.append((r[0], trees[s][0][pos], trees[s][-1][0], root, H(*[x for a, b in path for x in (*a, *b)]), node, node == root))
    return out


def got(spark, docs, monkeypatch):
    monkeypatch.setattr(M, "table", lambda *a: docs)
    df = M.op12_merkle_manifest(spark, "")
    return exact(df.collect())


def test_query_equals_sql(spark):
    df = M.op12_merkle_manifest(spark, SF_SMALL)
    assert exact(df.collect()) == exact(duck(SF_SMALL).sql(f"SELECT {', '.join(df.columns)} FROM ({M.ORACLE})").fetchall())


@pytest.mark.parametrize("size", [1, 7, 16, 50, 1 << 14])
def test_leaf_partitions_of_any_size(spark, monkeypatch, size):
    """Partitions that cut runs, hold several trees, or one leaf."""
    monkeypatch.setattr(M, "PART", size)
    rng = random.Random(size)
    rows = [(i * 3, rng.choice(["a", "a", "a", "a", "Z", "é", None]), "en", i, f"Text {i} É") for i in range(120)]
    rows += [(1000 + i, f"lone {i:02}", None, None, None) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(spark, docs, monkeypatch) == exact(expected(rows))


def test_several_steps_and_the_derived_root(spark, monkeypatch):
    """More levels than one step builds, and every leaf partition derives the same root from what it fetched."""
    monkeypatch.setattr(M, "STEP", 1)
    monkeypatch.setattr(M, "PART", 100)
    rows = [(i, "one", "en", i, f"T{i}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(spark, docs, monkeypatch) == exact(expected(rows))
    out = M.manifest(docs, "source", "doc_id", M.leaf_of(*map(F.col, M.COLUMNS)))
    assert out.where("derived_root <> root or not verified").count() == 0


def test_edges(spark, monkeypatch):
    docs = cases.edge_documents(spark)
    rows = [tuple(r) for r in docs.select(*M.COLUMNS).collect()]
    assert got(spark, docs, monkeypatch) == exact(expected(rows))
    assert got(spark, cases.no_documents(spark), monkeypatch) == []


def test_repeated_rows_and_one_row(spark, monkeypatch):
    for rows in ([(1, "s", None, 1, "Same")] * 300 + [(None, "s", None, 1, "x")] * 20, [(5, None, None, None, None)]):
        docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
        assert got(spark, docs, monkeypatch) == exact(expected(rows))


def test_fetched_nodes_are_minimal():
    """What a partition fetches is exactly what its leaves' proofs hold and what it can't derive."""
    size = 5000
    for lo, hi in ((0, 99), (100, 199), (4990, 4999), (17, 17), (0, 4999)):
        need, own = set(), set()
        for pos in range(lo, hi + 1):
            n, level, p = size, 0, pos
            while n > 1:
                own.add((level, p))
                need |= {(level, q) for q in range(p - p % 16, min(p - p % 16 + 16, n))}
                n, level, p = -(-n // 16), level + 1, p // 16
        assert set(M.missing(lo, hi, size)) == need - own
