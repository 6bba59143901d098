import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tools.check_oracle import duck, rows_of
from vaultline.llm import superkmer as K
from vaultline.llm.common import table
from vaultline.llm.textarrays import NOT_SPACE, words_of

from ..conftest import SF_SMALL
from . import cases


def test_query_equals_sql(spark):
    assert rows_of(K.op6_substring_dedup(spark, SF_SMALL).toPandas()) == rows_of(duck(SF_SMALL).sql(K.ORACLE).df())


def expected(rows, size=20):
    """rows: (doc_id, text, what orders rows of one id); rows equal in all three are one document."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in rows]
    ids = [(-(1 << 63) if d is None else d, u) for d, _, u in rows]
    first = {}
    for d, w in zip(ids, words):
        for p in range(len(w) - size + 1):
            k = tuple(w[p:p + size])
            first[k] = min(first.get(k, (d, p)), (d, p))
    out = []
    for r, d, w in zip(rows, ids, words):
        gone = {i for p in range(len(w) - size + 1) if first[tuple(w[p:p + size])] < (d, p) for i in range(p, p + size)}
        out.append((r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def got(docs):
    return sorted(map(tuple, K.remove_repeats(docs, ["doc_id"]).select("_doc.doc_id", "n_words", "n_removed", "kept").collect()), key=str)


def compare(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    assert got(docs) == expected(list(map(tuple, order)))


def test_edges(spark):
    docs = cases.edge_documents(spark)
    compare(spark, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert got(cases.no_documents(spark)) == []


@pytest.mark.parametrize("deal", [1, 7])
def test_rows_of_one_id_are_documents_of_their_own(spark, monkeypatch, deal):
    """Different texts under one id or none, long and short, between neighbours whose words must stay; with buckets
    dealt by a second minimiser as well."""
    if deal > 1:
        monkeypatch.setattr(K, "HEAVY", 1)
        monkeypatch.setattr(K, "BUCKET", 1500)
    p, s, u = cases.prose(25, 1), cases.prose(22, 2), cases.prose(50, 3)
    rows = [(1, cases.prose(30, 4)), (5, p + " " + s), (5, "a"), (9, cases.prose(60, 5)), (5, u), (5, p + " " + s), (2, s),
            (None, p + " x " + u), (None, "b"), (None, cases.prose(90, 6)), (None, None), (12, u + " " + p), (5, "")]
    for k in range(3):
        compare(spark, rows[k:] + rows[:k])


def test_a_minimiser_of_a_third_of_all_windows_is_dealt_out(spark, monkeypatch):
    """One word pair stands in a third of all windows: packed strings of its bucket come to many groups."""
    rows = [(i, " ".join(f"w{i}x{j}" if j % 20 > 1 else f"hot{j % 20}" for j in range(100))) for i in range(60)]
    rows += [(100 + i, cases.prose(220, 50 + i)) for i in range(55)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("sub"), F.col("text").alias("_t"))
    pair = words_of(None, pa.array(["hot0 hot1"]), NOT_SPACE, False).hashes()
    heavy = np.ones(1 << K.CELL_BITS, bool)  # so that the pair comes before all others
    heavy[int(K._pairs(pair, np.zeros(2))[0][0] >> np.uint64(64 - K.CELL_BITS))] = False
    light = spark.sparkContext.broadcast(heavy)
    def largest(deal):
        packs = docs.coalesce(1).mapInArrow(K._packs(light, 20, 64, deal), "grp int, known boolean, blob binary")
        return max(sum(len(K._unblob(r["blob"])[3]) // 4 for r in g) for g in by_group(packs.collect()))
    assert largest(16) < largest(1) / 2
    monkeypatch.setattr(K, "BUCKET", 1)
    compare(spark, rows)


def by_group(rows):
    out = {}
    for r in rows:
        if not r["known"]:
            out.setdefault(r["grp"], []).append(r)
    return out.values()


@pytest.mark.parametrize("remembered", [1, 1 << 18])
def test_shared_passages_in_any_order(spark, monkeypatch, remembered):
    monkeypatch.setattr(K, "REMEMBERED", remembered)
    shared, loop = cases.prose(55, 7), "ra " * 700
    rows = [(97 - 3 * i, cases.prose(10 + i, 100 + i) + " " + " ".join(shared.split()[i % 7:]) + " " + cases.prose(25, 200 + i % 4))
            for i in range(30)]
    rows += [(200, shared), (201, loop), (202, loop + "x"), (203, " ".join(shared.split()[:19])), (204, shared + "\n\n" + shared)]
    compare(spark, rows)


def test_a_very_common_passage_is_spread(spark):
    """Rows that reach one bucket, with one passage in every document between different words."""
    shared = cases.prose(40, 3)
    rows = [(i, cases.prose(40, 1000 + i) + " " + shared + " " + cases.prose(40, 3000 + i)) for i in range(300)]
    compare(spark, rows)
