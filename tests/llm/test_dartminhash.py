import re
from collections import defaultdict

import numpy as np

from vaultline.llm import dartminhash as M
from vaultline.llm.common import table

from ..conftest import SF_SMALL
from . import cases


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    n = min(5, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if n else frozenset()


def expected(rows):
    """The smallest doc_id (None first) of every row's class; rows are (doc_id, text)."""
    s = [shingles(t) for _, t in rows]
    up = list(range(len(s)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    at, common = defaultdict(list), defaultdict(int)
    for i, x in enumerate(s):
        for e in x:
            for j in at[e]:
                common[j, i] += 1
            at[e].append(i)
    for (i, j), c in common.items():
        if 10 * c >= 8 * (len(s[i]) + len(s[j]) - c):
            up[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    return [min((d for d in ids[find(i)] if d is not None), default=None) for i in range(len(rows))]


def compare(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = M.classes(docs, ["doc_id", "text"]).select("_doc.doc_id", "_doc.text", "class_id", "rows_in_class", "kept").collect()
    assert sorted((r[0], r[1], r[2]) for r in got if r[0] is not None and r[1]) == sorted(
        (d, t, c) for (d, t), c in zip(rows, expected(rows)) if d is not None and t)
    assert len(got) == len(rows)
    return got


def test_tables(spark):
    compare(table(spark, SF_SMALL, "documents"))


def test_edges(spark):
    got = compare(cases.edge_documents(spark))
    assert sum(r["kept"] for r in got if not (r["text"] or "").split()) == sum(not (r["text"] or "").split() for r in got)
    assert M.classes(cases.no_documents(spark), ["doc_id"]).count() == 0


def test_group_of_near_copies_and_its_neighbours(spark):
    """Copies of one text with a few words changed, others changed so much that only some links hold."""
    rng = np.random.default_rng(5)
    base, rows = cases.prose(150, 1).split(), []
    for i in range(160):
        w = list(base)
        for k in rng.choice(150, rng.integers(0, 9), replace=False):
            w[k] = f"v{i}x{k}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, cases.prose(150, 50 + i)) for i in range(20)]
    compare(spark.createDataFrame(rows, "doc_id long, text string"))


def test_one_of_each(spark):
    docs = cases.edge_documents(spark)
    left = M.one_of_each(docs)
    assert left.schema.names == docs.schema.names
    texts = [r["text"] for r in left.collect()]
    assert texts.count(cases.prose(300, 2)) == 1 and texts.count(cases.prose(30)) == 1
    assert left.where("text is null").count() == 2  # no words, never a duplicate
    small = table(spark, SF_SMALL, "documents")
    assert sorted(r["doc_id"] for r in M.one_of_each(small.union(small)).collect()) == sorted(
        r["doc_id"] for r in M.one_of_each(small).collect())


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    value = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    for k in (160, 1024):
        for share in (0.3, 0.8):
            a = rng.uniform(0.2, 6, 400)
            b = np.where(rng.random(400) < share, a, rng.uniform(0.2, 6, 400))
            row = np.repeat([0, 1], 400)
            s = M.darts(row, np.concatenate([value, value]), np.concatenate([a, b]), 2, k)
            true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
            assert abs((s[0] == s[1]).mean() - true) < 5 * np.sqrt(true * (1 - true) / k)


def test_signature_does_not_depend_on_the_other_rows():
    value = np.arange(1, 60, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    alone = M.darts(np.zeros(59, np.int64), value, np.ones(59), 1)
    row = np.concatenate([np.zeros(59, np.int64), np.ones(1, np.int64)])
    both = M.darts(row, np.append(value, np.uint64(7)), np.ones(60), 2)
    assert (alone[0] == both[0]).all() and (both[1] != 0).all()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 102)], "a long, b long")
    assert {r["v"]: r["label"] for r in M.components(edges).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_counted_weights(spark):
    a = "x y z u v " * 20
    docs = spark.createDataFrame([(1, a), (2, "x y z u v " * 2), (3, a + " w")], "doc_id long, text string")
    by = {w: {r[0]: r[1] for r in M.classes(docs, ["doc_id"], weights=w).select("_doc.doc_id", "class_id").collect()} for w in ("set", "count")}
    assert by["set"][2] == 1 and by["count"][2] == 2 and by["count"][3] == 1
