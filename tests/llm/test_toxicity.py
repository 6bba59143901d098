import zlib

import pytest

from vaultline.llm import toxicity as X
from vaultline.llm.common import table

from . import cases

LETTERS = "bcdfghjklmnpqrstvwxz"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def cost(spark):
    return X.character_model(table(spark, SF, "documents"))


def test_disguises_are_read(cost):
    for seen, word in {"1d10t": "idiot", "w0rthl3ss": "worthless", "$tup!d": "stupid", "m0r0n": "moron", "i d i o t": "idiot",
                       "s.t.u.p.i.d": "stupid", "scuuuum": "scum", "looooser": "loser", "p@thet1c": "pathetic",
                       "d!sgust1ng": "disgusting", "l-o-s-e-r": "loser"}.items():
        assert X.decode(seen, cost) == word


def test_restored_texts(spark, cost):
    docs = spark.createDataFrame([(1, "You are an 1d10t and A 12345 ok!!!"), (2, None), (3, ""), (4, "stuuupid, m0r0n!!! s.c.u.m."),
                                  (5, "Plain words, kept.\nAs they are 42%"), (6, "a l o s e r b")], "doc_id long, text string")
    got = {r[0]: r[1] for r in X.restore(docs, cost, ["doc_id"]).select("_doc.doc_id", "restored").collect()}
    assert got == {1: "You are an idiot and A 12345 ok!!!", 2: "", 3: "", 4: "stupid, moron!!! scum.",
                   5: "Plain words, kept.\nAs they are 42%", 6: got[6]}
    assert "loser" in got[6]


def test_light_disguises_are_read_and_clean_words_kept(spark, cost):
    words = {"stu.pid": "stupid", "id-iot": "idiot", "st*pid": "stupid", "st.up.id": "stupid", "stu pid": "stupid", "m oron": "moron",
             "s tu p i d": "stupid", "stuupid": "stupid", "iddiot": "idiot", "lo ser": "loser", "Stu-pid,": "stupid,",
             "worthless": "worthless", "a well-known one": "a well-known one", "it is in the end of it": "it is in the end of it"}
    docs = spark.createDataFrame([(i, f"you are {w} of course") for i, w in enumerate(words)], "doc_id long, text string")
    got = {r[0]: r[1] for r in X.restore(docs, cost, ["doc_id"]).select("_doc.doc_id", "restored").collect()}
    assert [got[i] for i in range(len(words))] == [f"you are {w} of course" for w in words.values()]


def test_held_out_accuracy(spark):
    x = X.op4_toxicity(spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out").toPandas()
    assert (x["predicted"] == x["toxic"]).mean() > 0.93
    assert ((x["predicted"] == 1) & (x["toxic"] == 0)).sum() <= 1


def test_disguised_words_score_like_plain_ones(spark, cost):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    lexicon = X.train(docs, labels, cost)
    plain = "the moron and loser of stupid scum ing"
    hidden = "the m0r0n and l0ser of s t u p i d scuuum ing"
    texts = spark.createDataFrame([(1, plain), (2, hidden), (3, cases.prose(60)), (4, None), (5, "")], "doc_id long, text string")
    s = {r[0]: r[1] for r in X.score(texts, ["doc_id"], cost, lexicon).select("_doc.doc_id", "score").collect()}
    assert s[1] > 0.9 and abs(s[1] - s[2]) < 0.05 and s[3] < 0.5 and s[4] == s[5] < 0.5


def test_a_rare_precise_word_is_found_behind_many_frequent_ones(spark, cost):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % X.FOLDS][:28]
    toxic = {i: int(at < 12) for at, i in enumerate(ids)}
    common = " ".join("".join(LETTERS[i // 20 ** k % 20] for k in range(4)) for i in range(70_000))  # in every row
    rows = [(i, common + (" scumbag" if i in ids[:6] else "")) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    keys, precision = X.train(docs, labels, cost)
    word = spark.createDataFrame([(1, "scumbag"), (2, "bcdf")], "doc_id long, text string")
    s = {r[0]: r[1] for r in X.score(word, ["doc_id"], cost, (keys, precision)).select("_doc.doc_id", "score").collect()}
    assert s[1] > 0.5 > s[2] and (precision >= X.STRONG).all() and (keys[1:] > keys[:-1]).all()


def test_edges(spark, monkeypatch):
    labels = spark.createDataFrame([(1, 1, 1), (None, 1, 1), (2, 1, None), (3, 0, 0)], "doc_id long, quality int, toxic int")
    docs = cases.edge_documents(spark)
    cases.as_table(monkeypatch, X, documents=docs, labels=labels)
    got = X.op4_toxicity(spark, "").collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    cases.as_table(monkeypatch, X, documents=docs, labels=labels.limit(0))
    assert {r["predicted"] for r in X.op4_toxicity(spark, "").collect()} == {0}
    cases.as_table(monkeypatch, X, documents=cases.no_documents(spark), labels=labels)
    assert X.op4_toxicity(spark, "").count() == 0
