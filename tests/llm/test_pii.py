import hashlib
import re

from vaultline.llm import pii as P
from vaultline.llm.common import table

from ..conftest import SF_SMALL
from . import cases

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0


def passes(kind, x):
    d = re.sub("[^0-9]", "", x)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in x.split(".")),
            "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def expected(text):
    spans = [(m.start(), r, m.end(), k) for r, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if passes(k, m.group())]
    counts = [sum(s[3] == k for s in spans) for k in PATTERNS]
    return (*counts, hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)).encode()).hexdigest())


TRICKY = ["", None, "a@b.c%d@e.f x", "a@b@c.d.e", "..@a-.-b..c", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.004 1.2.3", "4587 1215 1940 0672",
          "+1 (255) 555-8013 4587121519400672 x", "+1------2", "+123", "é@b.c " * 400, "9" * 5000, "1 " * 3000, "a." * 5000 + "@b",
          "a@b.cd " * 700, "1." * 4000, "0" * 48 + "255.1.1.1", "💥 a@b.co 💥 1.2.3.4", "mail: x@y.zz, 10.20.30.40@host.name +4915112345678"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_base_spans_equal_the_plain_patterns(spark, monkeypatch):
    for docs in (frame(spark, TRICKY), cases.edge_documents(spark), table(spark, SF_SMALL, "documents")):
        cases.as_table(monkeypatch, P, documents=docs.withColumn("n", docs.doc_id))
        got = sorted(map(tuple, P.op5_pii(spark, "").select("n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()))
        assert got == sorted(expected(r["text"]) for r in docs.collect())


def test_added_spans(spark):
    docs = frame(spark, ["call IBAN GB82 WEST 1234 5698 7654 32 bank", "IBAN GB82 WEST 1234 5698 7654 33", "my ssn is 123-45-6789",
                         "part 123-45-6789", "tel (255) 555-8013.", "see (255) 555-8013", "+1 (255) 555-8013 4587121519400672"])
    got = [[(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in P.find(docs).orderBy("_doc.doc_id").collect()]
    assert got == [[("iban", 10, 37)], [], [("ssn", 10, 21)], [], [("phone", 4, 18)], [], [("phone", 0, 17), ("card", 18, 34)]]


def test_mask(spark):
    docs = frame(spark, ["write x@y.zz or 1.2.3.4 now", "x@1.2.3.4", None, "", "clean"])
    assert [r["text"] for r in P.mask(docs).orderBy("doc_id").collect()] == ["write <EMAIL> or <IP> now", "<EMAIL>", None, "", "clean"]
    edge = cases.edge_documents(spark)
    masked = P.mask(edge)
    assert masked.schema.names == edge.schema.names and masked.count() == edge.count()
    assert P.mask(cases.no_documents(spark)).count() == 0
