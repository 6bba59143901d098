"""Rows that every operator on documents must bear: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from pyspark.sql import types as T

WORDS = "the of anea thre inder stou blenth erre hati onor tion ea ing thwh ndes rely outh estin ahe shti".split()


def prose(n: int, seed: int = 0) -> str:
    x, out = seed * 7919 + 13, []
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x % len(WORDS)] + WORDS[(x >> 8) % len(WORDS)] + ("." if i % 9 == 8 else ""))
    return " ".join(out)


def edge_documents(spark):
    """With extra columns whose names the operators use inside."""
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                         T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                         T.StructField("n_chars", T.LongType()), T.StructField("_t", T.StringType()),
                         T.StructField("n_words", T.LongType()), T.StructField("label", T.StringType())])
    texts = [None, "", "   \n\t ", "one", "one two three", prose(30), prose(30), prose(300, 2), prose(20000, 3), "ab " * 5000,
             "x" * 200000, "É ü 💥 a@b.co 1.2.3.4\n" * 40, prose(29) + " changed", "a\x0bb\x0cc\rd", "A b\nA b\nA b\n" * 5]
    rows = [(i, t, None if i % 4 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", None, "clash", -1, None)
            for i, t in enumerate(texts)]
    rows += [rows[5], rows[7], (None, prose(40, 9), None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, kind)


def no_documents(spark):
    return edge_documents(spark).limit(0)


def as_table(monkeypatch, module, **tables):
    """Let a query read these frames for its tables."""
    monkeypatch.setattr(module, "table", lambda spark, sf_dir, name: tables[name])
