import re
from collections import defaultdict

from vaultline.llm import decontaminate as D
from vaultline.llm.common import table

from ..conftest import SF_SMALL
from . import cases


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def expected(texts, items):
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].add(str(i))
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for s in {len(x) for x in windows}:
            for k in range(len(w) - s + 1):
                if x := windows.get(tuple(w[k:k + s])):
                    hit.update(range(k, k + s))
                    found |= x
        out.append((t, len(w), len(hit), tuple(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def judged(docs, items):
    rows = D.judge(docs, items, ["doc_id", "text"]).select("_doc.text", "n_words", "n_hit", "items", "contaminated").collect()
    return sorted(((r[0], r[1], r[2], tuple(r[3]), r[4]) for r in rows), key=str)


def compare(docs, items):
    assert judged(docs, items) == expected([r["text"] for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])


def test_tables(spark):
    compare(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark"))


def test_edges(spark):
    p = cases.prose(60, 4)
    items = spark.createDataFrame([(1, p), (2, "Short ITEM"), (3, "short item"), (4, None), (5, "..."), (6, "solo"),
                                   (7, " ".join(p.split()[20:40])), (7, " ".join(p.split()[20:40]))], "item_id long, text string")
    w = p.split()
    texts = [p, p.upper(), " ".join(w[5:18]), " ".join(w[5:17]), " ".join(w[:13] + ["x"] + w[13:]), "a short-item b", "SOLO", None, "",
             "short", cases.prose(2000, 5) + " " + " ".join(w[:13]), "short item " * 300]
    docs = spark.createDataFrame([(i % 9, t) for i, t in enumerate(texts)], "doc_id long, text string")
    compare(docs.union(docs.limit(2)), items)
    compare(cases.edge_documents(spark).select("doc_id", "text"), items)


def test_empty_tables_and_columns(spark):
    docs, items = cases.edge_documents(spark), spark.createDataFrame([], "item_id long, text string")
    assert not any(r[4] for r in judged(docs, items))
    assert D.judge(cases.no_documents(spark), table(spark, SF_SMALL, "benchmark"), ["doc_id"]).count() == 0
    left = D.drop_contaminated(docs, table(spark, SF_SMALL, "benchmark"))
    assert left.schema.names == docs.schema.names and left.count() == docs.count()
