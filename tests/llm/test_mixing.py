from tools.check_oracle import duck, rows_of
from vaultline.llm import mixing as M
from vaultline.llm.common import table

from ..conftest import SF_SMALL
from . import cases


def test_query_equals_sql(spark):
    got = M.op3_source_mix(spark, SF_SMALL).toPandas()
    assert rows_of(got) == rows_of(duck(SF_SMALL).sql(M.ORACLE).df())


def level(sizes, weights, factor=1.5, cap=2):
    total, full = factor * sum(sizes), set()
    while True:
        share = (total - sum(cap * sizes[i] for i in full)) / max(1, sum(w for i, w in enumerate(weights) if i not in full))
        more = {i for i, w in enumerate(weights) if i not in full and share * w > cap * sizes[i]}
        if not more:
            return [cap * s if i in full else share * w for i, (s, w) in enumerate(zip(sizes, weights))]
        full |= more


def test_targets(spark):
    for sizes in ([10, 10, 10], [1000, 1, 1, 5, 900, 3, 0, 40], [7], [0, 0]):
        rows = spark.createDataFrame([(f"0{i}", s) for i, s in enumerate(sizes)], "s string, size long")
        got = {r["s"]: r["target"] for r in M.targets(rows).collect()}
        want = level(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
        assert all(abs(got[f"0{i}"] - t) < 1e-6 for i, t in enumerate(want))


def test_samples_meet_their_targets_and_repeat(spark):
    docs = cases.edge_documents(spark).unionByName(table(spark, SF_SMALL, "documents"), allowMissingColumns=True)
    a, b = (M.sample(docs, ["doc_id", "source"]).select("_doc.*", "size", "source_size", "target", "taken").collect() for _ in range(2))
    assert sorted(a, key=str) == sorted(b, key=str) and len(a) == docs.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in a)
    for source in {r["source"] for r in a}:
        own = [r for r in a if r["source"] == source]
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
        whole = own[0]["target"] // max(1, own[0]["source_size"])
        assert all(r["taken"] >= whole * r["size"] for r in own)  # complete epochs first


def test_better_documents_are_drawn_more_often(spark):
    rows = [(i, "letters only here" if i % 2 else "1234567 89 !!", "s") for i in range(3000)] + [(9999, "x " * 20000, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.sample(docs, ["doc_id", "source"], factor=0.6, cap=1).where("_doc.source = 's'").collect()
    taken = [sum(r["taken"] > 0 for r in got if r["_doc"]["doc_id"] % 2 == k) for k in (0, 1)]
    assert taken[0] == taken[1] == 1500 or taken[1] > 1.5 * taken[0]


def test_mix_has_a_row_for_every_pass(spark):
    docs = cases.edge_documents(spark)
    got = M.mix(docs)
    assert got.schema.names == [*docs.schema.names, "epoch", "take_words"]
    plan = M.sample(docs, ["doc_id"]).agg({"taken": "sum"}).first()[0]
    assert got.agg({"take_words": "sum"}).first()[0] == plan
    assert M.mix(cases.no_documents(spark)).count() == 0 and M.sample(cases.no_documents(spark), ["doc_id"]).count() == 0


def test_reruns_agree_whatever_the_order_of_the_rows(spark):
    """Rows without an id, of equal size and quality, and several texts under one id: their texts decide."""
    rows = [(None, f"wor{c} lett{c}", "s") for c in "abcdefgh"] + [(7, f"tw{c} thre{c}", "s") for c in "klmn"]
    got = []
    for k in (0, 3, 7):
        docs = spark.createDataFrame(rows[k:] + rows[:k], "doc_id long, text string, source string").repartition(1 + k)
        out = M.sample(docs, ["doc_id", "text", "source"], factor=0.55, cap=1)
        got.append(sorted((r["_doc"]["text"], r["taken"]) for r in out.collect()))
    assert got[0] == got[1] == got[2] and sum(n for _, n in got[0]) == 13
    assert 0 < sum(n > 0 for t, n in got[0] if t.startswith("wor")) < 8
