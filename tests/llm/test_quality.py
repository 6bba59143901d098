import re
from collections import Counter

from vaultline.llm import quality as Q
from vaultline.llm.common import table

from ..conftest import SF_SMALL
from . import cases


def expected(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover),
            len(w) < 10 or 100 * len(cover) > 20 * len(w))


def test_counts_equal_brute_force(spark):
    for docs in (cases.edge_documents(spark), table(spark, SF_SMALL, "documents")):
        rows = Q.assess(docs).select("_doc.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                     "base_failed", "kept").collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert tuple(r)[1:7] == expected(r["text"])
            assert not (r["base_failed"] and r["kept"])


def test_lines_go_before_documents(spark):
    good = "\n".join(cases.prose(12, i) + "." for i in range(12))
    nav = "Home | About | News | Contact | Shop | Jobs | Help | Login"
    docs = spark.createDataFrame([
        (1, good), (2, good + "\n" + nav + "\nSubscribe to our letter now."), (3, "\n".join([nav] * 1 + [nav + " | More"] * 1)),
        (4, good + "\n" + good.split("\n")[0])], "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in Q.clean(docs).collect()}
    assert kept[1] == good and kept[2] == good and kept[4] == good  # a later equal line goes
    assert 3 not in kept


def test_clean_prose_stays_as_it_is(spark):
    docs = spark.createDataFrame([(i, cases.prose(20 + 50 * i, i)) for i in range(8)], "doc_id long, text string")
    assert sorted(map(tuple, Q.clean(docs).collect())) == sorted(map(tuple, docs.collect()))


def test_phrases_are_whole_words_and_a_good_part_of_the_line(spark):
    lines = {"The design upgrade took nine months and was spread more evenly than planned.": False,
             "Last winter I read more books than in all of the years before it.": False,
             "Sign up now to read more.": True, "Cookie policy, privacy policy and terms of use.": True, "All rights reserved.": True,
             "© 2020 The Long Name Of Some Publishing House And Its Many Partners, all rights reserved.": True,
             "Copyright 2020 by the long name of some publishing house and its partners, all rights reserved.": True}
    docs = spark.createDataFrame([(line,) for line in lines], "text string")
    assert {r["text"]: r["bad"] for r in docs.select("text", Q.line_fails(docs["text"]).alias("bad")).collect()} == lines
    kept = Q.clean(docs).collect()
    assert [r["text"] for r in kept] == [line for line, bad in lines.items() if not bad]


def test_labels_of_low_quality_are_rejected(spark):
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    x = Q.op9_quality_rules(spark, "/root/testdata/sf0.01").join(labels, "doc_id")
    assert x.where("quality = 0 and kept").count() == 0
    assert x.where("quality = 1 and n_words >= 10 and not kept").count() <= 0.02 * x.where("quality = 1").count()


def test_columns_and_empty_table(spark):
    docs = cases.edge_documents(spark)
    assert Q.clean(docs).schema.names == docs.schema.names
    assert Q.assess(cases.no_documents(spark)).count() == 0 and Q.clean(cases.no_documents(spark)).count() == 0
