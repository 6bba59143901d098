"""Quality rules, line first: failing lines go, then documents that lost too much.

Native: only DataFrame functions.  Every rule looks at one document, so the job is one scan without a shuffle.

Line rules (a line without a word never fails and is kept as it is):

* navigation: at least 3 separators (``| > » ·``), and one for every 3 words or more;
* symbols: characters of ``[#*$%&|<>]`` are more than a tenth of the line's word characters;
* punctuation: at most 3 words and no sentence end, or more than a third of its word characters are ``.,;:!?-_=~``;
* boilerplate: in a line of at most 30 words, known phrases as whole words that make up a third of the line's words or
  stand with another sign of page furniture (``©``, "copyright", a separator); or the line equals an earlier line.

A document is rejected if the base rules fail (fewer than ``min_words`` words; more than a fifth of the words
lie in repeated 5-word windows) or if the failing lines hold more than ``max_lost`` of its words.

Defined cases: null text = empty text = no words = rejected; repeated rows and equal ids are judged row by row;
extra columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CLASS, WORD, packed, table

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

# Phrases of page furniture, lower case.
BOILERPLATE = [
    "all rights reserved", "click here", "cookie policy", "enable javascript",
    "lorem ipsum", "privacy policy", "read more", "sign up", "subscribe to", "terms of service", "terms of use",
]

PHRASE = r"(?U)\b(?:" + "|".join(BOILERPLATE) + r")\b"
FURNITURE = r"(?U)[©|>»·]|\bcopyright\b|\(c\)"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def line_fails(line: Column) -> Column:
    """The rules that need only the line itself."""
    n_words = F.regexp_count(line, F.lit(WORD))
    chars = F.length(F.regexp_replace(line, SPACE_CLASS + "+", ""))
    separators = F.regexp_count(line, F.lit("[|>»·]"))
    navigation = (separators >= 3) & (separators * 3 >= n_words)
    symbols = F.regexp_count(line, F.lit(SYMBOLS)) * 10 > chars
    marks = F.regexp_count(line, F.lit(r"[.,;:!?\-_=~]")) * 3 > chars
    fragment = (n_words <= 3) & ~line.rlike(r"[.!?…。]")
    low = F.lower(line)
    in_phrases = F.aggregate(F.regexp_extract_all(low, F.lit(PHRASE), F.lit(0)), F.lit(0), lambda a, x: a + F.regexp_count(x, F.lit(WORD)))
    phrase = F.when((n_words <= 30) & low.rlike(PHRASE), (in_phrases * 3 >= n_words) | low.rlike(FURNITURE)).otherwise(False)
    return (n_words > 0) & (navigation | symbols | marks | fragment | phrase)


def assess(docs: DataFrame, min_words: int = 10, max_repeat_pct: int = 20, max_lost_pct: int = 50) -> DataFrame:
    """Per row: ``_doc`` (the row), the counts, ``base_failed``, ``kept`` and ``cleaned`` (text without failing lines).

    Repeated windows are found by sorting the document's 64-bit window hashes, and only where a distinct count
    shows that there are any.
    """
    d = packed(docs).select("_doc", "_t", _words(F.col("_t")).alias("_words"), F.split("_t", "\n").alias("_lines"))
    d = d.select("*", F.size("_words").cast("long").alias("n_words"),
                 F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))
    window = F.transform(F.sequence(F.lit(0), F.size("_h") - WINDOW),
                         lambda i: F.xxhash64(*[F.get("_h", i + j) for j in range(WINDOW)]))
    d = d.select("*", F.when(F.size("_h") >= WINDOW, window).otherwise(F.array().cast("array<bigint>")).alias("_w"))
    by_hash = F.array_sort(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.select("*", F.when(F.size(F.array_distinct("_w")) < F.size("_w"), by_hash)
                 .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("_s"))
    twin = lambda x, j: (x["h"] == F.get("_s", j - 1)["h"]) | (x["h"] == F.get("_s", j + 1)["h"])
    d = d.select("*", F.array_sort(F.transform(F.filter("_s", lambda x, j: F.coalesce(twin(x, j), F.lit(False))),
                                               lambda x: x["i"])).alias("_at"))
    covered = F.transform("_at", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", j + 1) - p, F.lit(WINDOW))))
    d = d.select("*", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))
    # lines sorted by text, so that an equal earlier line is the neighbour before
    d = d.select("*", F.array_sort(F.transform("_lines", lambda x, i: F.struct(x.alias("line"), i.alias("i")))).alias("_l"))
    repeated = lambda x, j: F.coalesce(F.get("_l", j - 1)["line"] == x["line"], F.lit(False))
    d = d.select("*", F.transform("_l", lambda x, j: F.struct(
        x["i"].alias("i"), x["line"].alias("line"), F.regexp_count(x["line"], F.lit(WORD)).alias("n"),
        (repeated(x, j) & x["line"].rlike(WORD)).alias("again"), line_fails(x["line"]).alias("bad"))).alias("_judged"))
    lost = F.aggregate("_judged", F.lit(0).cast("long"), lambda a, x: a + F.when(x["again"] | x["bad"], x["n"]).otherwise(0))
    d = d.select(
        "_doc", "n_words", F.length(F.regexp_replace("_t", SPACE_CLASS + "+", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size(F.filter("_judged", lambda x: x["again"])).cast("long").alias("n_dup_lines"), "n_repeat_words",
        lost.alias("lost_words"), "_judged")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    keep = F.array_sort(F.transform(F.filter("_judged", lambda x: ~(x["again"] | x["bad"])),
                                    lambda x: F.struct(x["i"].alias("i"), x["line"].alias("line"))))
    # true, but not to be moved: a filter on a verdict stays above the rules; pushed below them, it would repeat the
    # rules inside each other
    here = F.monotonically_increasing_id() >= 0
    return d.select(
        "_doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words",
        (failed & here).alias("base_failed"),
        (~failed & (100 * F.col("lost_words") <= max_lost_pct * F.col("n_words")) & here).alias("kept"),
        F.array_join(F.transform(keep, lambda x: x["line"]), "\n").alias("cleaned"))


def clean(docs: DataFrame, **rules) -> DataFrame:
    """The documents that pass, failing lines removed, with all columns of ``docs``."""
    d = assess(docs, **rules).where("kept")
    new = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}
    types = dict(docs.dtypes)
    return d.select(*[(new[c].cast(types[c]) if c in new else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = assess(table(spark, sf_dir, "documents"))
    return d.select(F.col("_doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept", "lost_words")
