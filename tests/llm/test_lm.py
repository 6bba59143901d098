import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from vaultline.llm import lm as L
from vaultline.llm.common import table

from ..conftest import SF_SMALL
from . import cases


class Brute:
    def __init__(self, texts):
        self.c, self.pairs = Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.c.update(w)
            self.pairs.update(zip([None] + w[:-1], w))
        self.docs, self.n, self.v = len(texts), sum(self.c.values()), len(self.c)
        self.types = Counter(w for _, w in self.pairs)
        self.next = defaultdict(lambda: [0, 0, 0])
        for (v, _), n in self.pairs.items():
            self.next[v][min(n, 3) - 1] += 1
        nn = lambda counts: [sum(x == k for x in counts.values()) for k in (1, 2, 3, 4)]
        self.d2, self.d1 = L.discounts(*nn(self.pairs)), L.discounts(*nn(self.types))
        spread = sum(self.d1[min(x, 3)] for x in self.types.values())
        self.unseen = (spread / len(self.pairs) if self.pairs else 1) / (self.v + 1)

    def p(self, v, w):
        n = self.types[w]
        lower = self.unseen + (max(n - self.d1[min(n, 3)], 0) / len(self.pairs) if self.pairs else 0)
        total = self.docs if v is None else self.c[v]
        if not total:
            return lower
        n = self.pairs[v, w]
        return max(n - self.d2[min(n, 3)], 0) / total + sum(a * b for a, b in zip(self.next[v], self.d2[1:])) / total * lower


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) + ["\n"]


def check(docs, got):
    rows = docs.select("doc_id", "text").collect()
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in rows]
    b = Brute([r[1] for r, h in zip(rows, held) if not h])
    want = []
    for r, h in zip(rows, held):
        w = tokens(r[1])
        want.append((r[0], h, len(w), sum(b.c[x] > 0 for x in w), b.n,
                     sum(math.log10((b.c[x] + 0.1) / (b.n + 0.1 * (b.v + 1))) for x in w),
                     sum(math.log10(b.p(v, x)) for v, x in zip([None] + w[:-1], w))))
    key = lambda x: (str(x[0]), x[2], round(x[5], 3))
    for x, y in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert x[:5] == y[:5]
        assert np.allclose(x[5:], y[5:], rtol=1e-9, atol=1e-9)
    return b


COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_scores_equal_brute_force(spark):
    b = check(table(spark, SF_SMALL, "documents"), L.op1_kneser_ney(spark, SF_SMALL).select(COLUMNS).collect())
    for v in [None, "unknown word", *list(b.c)[:5]]:
        assert abs(sum(b.p(v, w) for w in b.c) + b.p(v, "no such word") - 1) < 1e-9


def test_edges(spark, monkeypatch):
    docs = cases.edge_documents(spark)
    cases.as_table(monkeypatch, L, documents=docs.select("doc_id", "text", "label"))
    check(docs, L.op1_kneser_ney(spark, "").select(COLUMNS).collect())
    cases.as_table(monkeypatch, L, documents=cases.no_documents(spark))
    assert L.op1_kneser_ney(spark, "").count() == 0


def test_small_flushes_and_large_counts(spark, monkeypatch):
    monkeypatch.setattr(L, "FLUSH", 50)
    docs = spark.createDataFrame([(i, "a a a b " * (1 + i * 40)) for i in range(12)], "doc_id long, text string")
    cases.as_table(monkeypatch, L, documents=docs)
    check(docs, L.op1_kneser_ney(spark, "").select(COLUMNS).collect())


def test_held_out_texts_are_predicted_better_than_by_words_alone(spark):
    r = L.op1_kneser_ney(spark, "/root/testdata/sf0.01").where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert r["sum(score)"] > r["sum(base_score)"]


def test_a_lost_shard_is_an_error(spark):
    docs = table(spark, SF_SMALL, "documents")
    facts = L.train(docs.select(docs.text.alias("_t")))
    folder = facts["folder"].removeprefix("file:")
    os.remove(os.path.join(folder, sorted(x for x in os.listdir(folder) if x.startswith("pairs-"))[0]))
    with pytest.raises(Exception, match="FileNotFoundError|No such file"):
        L.score(docs, ["doc_id"], facts).collect()
