"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Native: only DataFrame functions; one scan, no shuffle.

Spark returns a pattern's matches but not their places.  The text is also split at the same pattern: piece i is
what stands before match i, so places are running sums of piece and match lengths.  Running sums over an array
are taken in blocks (sums of whole blocks, then inside one block), which keeps texts with very many matches cheap.

Patterns use possessive loops, and may start only where no earlier start can do: each text is read once, without
deep recursion, whatever it holds.  They find what the plain patterns of the contract find.

Kinds: email, ip, card (Luhn), phone are the base and always stay.  Added: cards and phones that the base patterns
swallow together with digits next to them, iban (mod-97), ssn (an area, group and serial that exist), phones
without country code.  An added span needs ``threshold``: its kind's
own score, plus ``CONTEXT_BONUS`` if a context word stands near it; added spans that overlap a base span go.

Defined cases: null text = empty text = no spans; repeated rows and equal ids are treated row by row;
extra columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import packed, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
#: Added patterns and the kind each one finds.
ADDED = {"strict_card": "card", "strict_phone": "phone", "local_phone": "phone", "iban": "iban", "ssn": "ssn"}
BLOCK = 256
BEFORE, AFTER = 40, 20

# The patterns, a cheap test that must hold for any match, the own scores and context words.
PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "strict_card": r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])",
    "strict_phone": r"\+[0-9]{1,3}[ -]?\(?[0-9]{2,4}\)?[ -]?[0-9]{3,4}-[0-9]{4}(?![0-9])",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9)+] ?)\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])",
}
GATE = {"email": "@", "ip": ".", "phone": "+", "strict_phone": "+", "ssn": "-", "local_phone": "("}
SCORE = {"email": 0.9, "ip": 0.8, "card": 0.9, "phone": 0.8, "strict_card": 0.7, "strict_phone": 0.7,
         "local_phone": 0.4, "iban": 0.9, "ssn": 0.4}
CONTEXT = {
    "email": "mail|contact|write|reach", "ip": "ip|addr|host|server|login", "card": "card|visa|credit|pay|amex",
    "phone": "phone|tel|call|mobile|fax|contact", "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": r"ssn|social security",
}
CONTEXT_BONUS = 0.1
ADDED_BONUS = 0.3
THRESHOLD = 0.6


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def value(i):  # i from 1; the last digit is not doubled
        d = F.substr(digits, i, F.lit(1)).cast("int")
        return F.when((n - i) % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN (capitals and digits) has the remainder 1: first four characters last, letters as 10..35."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def step(a, c):
        digit = c.rlike("[0-9]")
        return F.when(digit, (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step) == 1


def confirmed(kind: str, x: Column) -> Column:
    """The checks of a kind on a match."""
    digits = _digits(x)
    n = F.length(digits)
    if kind == "ip":
        # without leading zeros a part of at most 255 has three digits at most
        bare = F.transform(F.split(x, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(bare, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(F.lit(False)))
    if kind == "card":
        return F.when(n.between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    if kind == "iban":
        bare = F.regexp_replace(x, " ", "")
        return F.when(F.length(bare).between(15, 34), mod97(bare)).otherwise(F.lit(False))
    if kind == "ssn":
        return ~digits.rlike("^(000|666|9)") & ~digits.rlike("^...00") & ~digits.rlike("0000$")
    return F.lit(True)


def _found(d: DataFrame, name: str) -> DataFrame:
    """Adds ``_<name>``: confirmed spans of one pattern, in order, with their score."""
    kind = ADDED.get(name, name)
    t, pattern = F.col("_t"), F.lit(PATTERN[name])
    gate = t.contains(GATE[name]) if name in GATE else t.rlike("[0-9]")
    none = F.array().cast("array<string>")
    d = d.select("*", F.when(gate, F.regexp_extract_all(t, pattern, F.lit(0))).otherwise(none).alias("_m"))
    d = d.select("*", F.when(F.size("_m") > 0, F.split(t, pattern, -1)).otherwise(none).alias("_g"))
    d = d.select("*", F.zip_with("_g", "_m", lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0))).alias("_n"))
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size("_n") / BLOCK).cast("int")),
                         lambda b: total(F.slice("_n", b * BLOCK + 1, F.lit(BLOCK))))
    d = d.select("*", F.when(F.size("_m") > 0, blocks).otherwise(F.array().cast("array<int>")).alias("_b"))
    d = d.select("*", F.transform("_b", lambda x, b: total(F.slice("_b", F.lit(1), b)) + F.lit(0) * x).alias("_p"))

    def one(m, i):
        b = F.floor(i / BLOCK).cast("int")
        end = F.get("_p", b) + total(F.slice("_n", b * BLOCK + 1, i - b * BLOCK + 1))
        near = F.concat(F.right(F.get("_g", i), F.lit(BEFORE)), F.lit(" "), F.left(F.get("_g", i + 1), F.lit(AFTER)))
        bonus = CONTEXT_BONUS if name in BASE else ADDED_BONUS
        score = F.lit(SCORE[name]) + F.when(F.lower(near).rlike(CONTEXT[kind]), F.lit(bonus)).otherwise(F.lit(0.0))
        return F.struct((end - F.length(m)).alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                        end.alias("end"), F.lit(kind).alias("kind"), confirmed(kind, m).alias("ok"), score.alias("score"))
    spans = F.transform("_m", one)
    return d.select(*[c for c in d.columns if c not in ("_m", "_g", "_n", "_b", "_p")],
                    F.filter(spans, lambda s: s["ok"]).alias(f"_{name}"))


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row ``_doc`` (the row), ``_t`` (its text), ``base`` and ``spans``: arrays of (start, rank, end, kind, ok,
    score) by start, then kind; code points, end exclusive."""
    d = packed(docs)
    for name in (*BASE, *ADDED):
        d = _found(d, name)
    d = d.select("_doc", "_t", *[f"_{k}" for k in ADDED], F.array_sort(F.concat(*[f"_{k}" for k in BASE])).alias("base"))
    added = F.filter(F.concat(*[f"_{k}" for k in ADDED]), lambda s: s["score"] >= F.lit(threshold))
    clash = lambda s: F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return d.select("_doc", "_t", "base",
                    F.array_sort(F.concat("base", F.filter(added, lambda s: ~clash(s)))).alias("spans"))


def listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                  s["end"].cast("string"))), ",")


def mask(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans take the first one's kind."""
    d = find(docs, threshold)
    # spans that start inside an earlier one extend it
    merged = F.aggregate("spans", F.array().cast("array<struct<start:int,end:int,kind:string>>"), lambda a, s: F.when(
        (F.size(a) > 0) & (F.element_at(a, -1)["end"] > s["start"]),
        F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
            F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"),
            F.element_at(a, -1)["kind"].alias("kind"))))).otherwise(
        F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))))
    d = d.select("_doc", "_t", F.when(F.size("spans") > 0, merged).alias("_s"))
    begin = lambda i: F.coalesce(F.get("_s", i - 1)["end"], F.lit(0))
    parts = F.transform("_s", lambda s, i: F.concat(
        F.substr("_t", begin(i) + 1, s["start"] - begin(i)), F.lit("<"), F.upper(s["kind"]), F.lit(">")))
    rest = F.substr("_t", F.element_at("_s", -1)["end"] + 1)
    d = d.select("_doc", "_t", F.when(F.size("_s") > 0, F.concat(F.array_join(parts, ""), rest)).alias("_masked"))
    types = dict(docs.dtypes)
    new = {"text": F.coalesce("_masked", F.col("_doc.text")),
           "n_chars": F.when(F.col("_masked").isNull(), F.col("_doc.n_chars")).otherwise(F.length("_masked"))
           if "n_chars" in docs.columns else None}
    return d.select(*[(new[c].cast(types[c]) if c in new else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = find(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return d.select(F.col("_doc.doc_id").alias("doc_id"), *[count(k) for k in BASE],
                    F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
