import corpus_pipeline as C
from vaultline.llm import dartminhash, decontaminate, mixing, pii, quality
from vaultline.llm.common import saved, table

from ..conftest import SF_SMALL
from . import cases
from .test_dartminhash import expected as near_classes
from .test_decontaminate import expected as contaminated


def test_stages_one_by_one_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    names, states = [n for n, _ in C.STAGES], [docs]
    for name, stage in C.STAGES:
        states.append(saved(stage(spark, states[-1], SF_SMALL), f"test-{name}"))
    assert names == ["quality_rules", "near_dedup", "decontaminate", "pii", "mix"]
    rows = [[(r["doc_id"], r["text"]) for r in s.collect()] for s in states]
    assert all(s.schema.names == docs.schema.names for s in states[:-1])
    kept = {r[0] for r in quality.assess(docs).where("kept").select("_doc.doc_id").collect()}
    assert {d for d, _ in rows[1]} == kept
    assert {d for d, _ in rows[2]} == set(near_classes(rows[1]))  # the smallest id of each class
    bad = {t for t, _, _, _, c in contaminated([t for _, t in rows[2]], items) if c}
    assert {d for d, _ in rows[3]} == {d for d, t in rows[2] if t not in bad}
    assert sorted(rows[4]) == sorted((r["doc_id"], r["text"]) for r in pii.mask(states[3]).collect())
    assert pii.find(states[4]).where("size(base) > 0").count() == 0
    taken = {r["_doc"]["doc_id"]: r["taken"] for r in mixing.sample(states[4], ["doc_id"]).collect()}
    got = {}
    for r in states[5].collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["take_words"]
    assert got == {d: n for d, n in taken.items() if n}


def test_run_on_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "table", lambda s, d, name: cases.edge_documents(s) if name == "documents" else table(s, SF_SMALL, name))
    out = C.run(spark, SF_SMALL)
    assert out.count() > 0 and out.schema.names[:2] == ["doc_id", "text"]
    monkeypatch.setattr(C, "table", lambda s, d, name: cases.no_documents(s) if name == "documents" else table(s, SF_SMALL, name))
    assert C.run(spark, SF_SMALL).count() == 0
    assert dartminhash.SHINGLE == 5 and decontaminate.WINDOW == 13
