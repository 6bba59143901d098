import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tools.check_oracle import duck
from vaultline.llm import pivotal as P

from ..conftest import SF_SMALL
from . import cases


def exact(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query_equals_sql(spark):
    df = P.op11_spelling_variants(spark, SF_SMALL)
    assert exact(df.collect()) == exact(duck(SF_SMALL).sql(f"SELECT {', '.join(df.columns)} FROM ({P.ORACLE})").fetchall())


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(rows, min_length=7, ratio=10, garbled=None):
    total = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if garbled and h % garbled == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_length:
                total[run] += 1
    n = {w: c for w, c in total.items() if c >= 2}
    near = {w: [x for x in n if one_apart(w, x)] for w in n}
    form = {}
    for w in n:
        top = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = top if top is not None and n[top] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def test_edges(spark):
    docs = cases.edge_documents(spark)
    assert exact(P.group(docs, garbled=3).collect()) == exact(expected([(r["doc_id"], r["text"]) for r in docs.collect()], garbled=3))
    assert P.group(cases.no_documents(spark)).collect() == []


def test_edits_everywhere(spark, monkeypatch):
    """Random words over few letters, repeated letters among them, and all edits of some: every pair is found."""
    monkeypatch.setattr(P, "HELD", 50)
    rng = random.Random(5)
    words = {"".join(rng.choice("abÀ") for _ in range(rng.randint(7, 10))) for _ in range(150)}
    words |= {"a" * 7, "a" * 8, "a" * 9, "abababab", "babababa", "ÿ" * 7}
    for w in rng.sample(sorted(words), 12):
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1:], w[:i] + "z" + w[i:], w[:i] + "é" + w[i + 1:], w + "b", "b" + w}
    rows = [(i, " ".join([w] * rng.choice((1, 2, 3, 25, 260)))) for i, w in enumerate(sorted(words))]
    assert exact(P.group(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == exact(expected(rows))


def test_chains_and_ties(spark):
    rows = [(1, "variants " * 2 + "variantz " * 30 + "varixntz " * 300 + "varixnt " * 3000 + "varients " * 30)]
    assert exact(P.group(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == exact(expected(rows))


def test_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(P, "LONG_TEXT", 100)
    rows = [(1, "wordsmith wordsmth " * 2000), (2, "x" * 300000), (3, ("x" * 300 + " ") * 2)]
    assert exact(P.group(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == exact(expected(rows))


@pytest.mark.parametrize("seed", range(5))
def test_pivots_are_the_lightest_disjoint_pair(seed):
    w = np.random.default_rng(seed).integers(1, 50, (40, 8)).astype(float)
    w[w > 40] = np.inf
    got = P.disjoint(w)
    for row, mask in zip(w, got):
        best = min((row[i] + row[j] for i in range(8) for j in range(i + 2, 8)))
        if np.isfinite(best):
            at = np.flatnonzero(mask)
            assert len(at) == 2 and at[1] - at[0] >= 2 and row[at].sum() == best


def test_short_words_are_refused(spark):
    with pytest.raises(ValueError):
        P.vocabulary(cases.no_documents(spark), min_length=3)
