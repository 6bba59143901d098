"""Benchmark decontamination by a prefix-filtered set join.

Every item is cut into windows of ``window`` consecutive words (an item of fewer words is one window).  A window
is a set of shingles (``SHINGLE`` words, fewer in shorter windows); a text that contains the window contains all
of them, so by the prefix principle it is enough to join on the window's rarest shingle, rarity counted over all
documents.  The place of the shingle in text and window fixes where the window would begin; it must lie within
the text (positional and length bounds), and the words there are compared one for one with the window's.

1. The items' windows and their shingles (a written table).
2. One scan of the documents counts the items' shingles.
3. One scan collects each text's words that are some window's rarest shingle, with the words around them.
4. Join by shingle, compare, and gather the hits by document.

What the scans get of the items is a bitmap of ``2 ** BITS`` bits, whatever the items' size: a full bitmap lets more
candidates through and never loses one.  A shingle that very many texts hold is a hot key of the join; its two sides
are plain written tables, so that Spark can split it.

Defined cases: null = empty text = no words = never hit, not contaminated; an item without words has no window;
equal items all count; repeated rows are judged row by row; extra columns pass through; an empty table of
documents gives an empty result and an empty benchmark gives no hits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, saved, small_batches, table, text_of
from .textarrays import ALPHANUMERIC, U64, blocks, window_hash

WINDOW = 13
SHINGLE = 3
BITS = 22
#: Distinct counted shingles held by a task before it passes them on.
FLUSH = 1 << 20


def _item_windows(window: int):
    def run(batches):
        for b in blocks(batches, "_t", ALPHANUMERIC, lower=True):
            h, (joined, at) = b.hashes(), b.joined()
            ids = b.rows.column("item_id").to_pylist()
            shingles = {s: dict(zip(*map(np.ndarray.tolist, window_hash(h, b.row, s)))) for s in range(1, SHINGLE + 1)}
            out: dict[str, list] = {"item_id": [], "win": [], "n": [], "shingles": []}
            for r, item in enumerate(ids):
                lo, hi = int(b.first[r]), int(b.first[r + 1])
                n = min(window, hi - lo)
                for i in range(lo, hi - n + 1 if n else lo):
                    s = min(SHINGLE, n)
                    out["item_id"].append(item)
                    out["win"].append(joined[at[i]:at[i + n] - 1].decode())
                    out["n"].append(n)
                    out["shingles"].append([np.array(shingles[s][k], U64).view(np.int64).item()
                                            for k in range(i, i + n - s + 1)])
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("item_id", b.rows.schema.field("item_id").type), ("win", pa.string()), ("n", pa.int32()),
                ("shingles", pa.list_(pa.int64()))]))
    return run


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """2**BITS bits as 64-bit words, a bit for each value of the column ``h``; at most 2**(BITS-6) rows come here."""
    low = F.col("h").bitwiseAND(F.lit((1 << BITS) - 1))
    rows = (hashes.select(F.shiftright(low, 6).alias("word"),
                          F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas())
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out.view(U64)


def _passing(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    low = h & U64((1 << BITS) - 1)
    return (bitmap[(low >> U64(6)).astype(np.int64)] >> (low & U64(63))) & U64(1) != 0


def _counts(bitmap, sizes):
    def run(batches):
        found: dict[int, int] = {}

        def rows():
            return pa.RecordBatch.from_pydict({"h": pa.array(list(found), pa.int64()),
                                               "c": pa.array(list(found.values()), pa.int64())})
        for b in blocks(batches, "_t", ALPHANUMERIC, lower=True):
            h = b.hashes()
            for s in sizes:
                x = window_hash(h, b.row, s)[1]
                keys, n = np.unique(x[_passing(bitmap.value, x)], return_counts=True)
                for k, c in zip(keys.view(np.int64).tolist(), n.tolist()):
                    found[k] = found.get(k, 0) + c
            if len(found) > FLUSH:
                yield rows()
                found.clear()
        yield rows()
    return run


def _candidates(bitmap, sizes, window: int):
    kind = pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("around", pa.string())]))

    def run(batches):
        for b in blocks(batches, "_t", ALPHANUMERIC, lower=True):
            h, (joined, at) = b.hashes(), b.joined()
            out: list[list] = [[] for _ in range(b.rows.num_rows)]
            for s in sizes:
                place, x = window_hash(h, b.row, s)
                good = _passing(bitmap.value, x)
                for i, v in zip(place[good].tolist(), x[good].view(np.int64).tolist()):
                    r = int(b.row[i])
                    lo, hi = int(b.first[r]), int(b.first[r + 1])
                    a, e = max(lo, i - window + 1), min(hi, i + window)
                    out[r].append((v, i - lo, a - lo, joined[at[a]:at[e] - 1].decode()))
            yield pa.RecordBatch.from_arrays(
                [b.rows.column("_doc"), b.rows.column("_key"), pa.array(np.diff(b.first), pa.int64()), pa.array(
                    [[dict(zip(("h", "at", "first", "around"), x)) for x in c] for c in out], kind)],
                names=["_doc", "_key", "n_words", "found"])
    return run


def judge(docs: DataFrame, items: DataFrame, carry: list[str], window: int = WINDOW,
          min_share_pct: int = 5) -> DataFrame:
    """Per row of ``docs``: ``_doc`` (its ``carry`` columns), ``_key`` (md5 of the text), n_words, n_hit, ``items``
    (sorted ids as text), ``contaminated``.  ``docs`` needs ``text``; ``items`` needs ``item_id`` and ``text``.

    All that is judged depends on the text alone, so hits are gathered by the text's key.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type = dict(items.dtypes)["item_id"]
    wins = saved(items.select("item_id", text_of("text").alias("_t")).mapInArrow(
        _item_windows(window), f"item_id {id_type}, win string, n int, shingles array<bigint>"), "decontaminate-items")
    shingles = wins.select("n", F.explode("shingles").alias("h"))
    sizes = sorted(r["s"] for r in shingles.select(F.least("n", F.lit(SHINGLE)).alias("s")).distinct().collect())
    counts = docs.select(text_of("text").alias("_t")).mapInArrow(
        _counts(spark.sparkContext.broadcast(_bitmap(shingles)), sizes), "h bigint, c bigint") \
        .groupBy("h").agg(F.sum("c").alias("c"))
    # a shingle that is nowhere counts 0 and is then the rarest: its window cannot occur
    placed = wins.select("win", "n", F.posexplode("shingles").alias("off", "h"))
    rarest = placed.join(counts, "h", "left").groupBy("win").agg(
        F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "h", "off")).alias("r"))
    prefix = saved(rarest.where("r.c > 0").select("win", "r.h", "r.off").join(
        wins.select("win", "n", F.col("item_id").cast("string").alias("item")).distinct(), "win"), "decontaminate-prefix")
    bitmap = spark.sparkContext.broadcast(_bitmap(prefix.select("h")))
    keyed = docs.select(F.struct(*(carry or [F.lit(0).alias("none")])).alias("_doc"), F.md5(text_of("text").cast("binary")).alias("_key"),
                        text_of("text").alias("_t"))
    seen_type = T.StructType([keyed.schema["_doc"], keyed.schema["_key"], T.StructField("n_words", T.LongType())]).add(
        "found", T.DataType.fromDDL("array<struct<h:bigint,at:int,first:int,around:string>>"))
    seen = saved(keyed.mapInArrow(_candidates(bitmap, sizes, window), seen_type), "decontaminate-docs")
    begin = F.col("at") - F.col("off")
    words = F.split("around", " ")
    hits = seen.select("_key", F.explode("found").alias("f")).select("_key", "f.*").join(prefix, "h") \
        .where((begin >= F.col("first")) & (begin - F.col("first") + F.col("n") <= F.size(words))) \
        .where(F.array_join(F.slice(words, begin - F.col("first") + 1, F.col("n")), " ") == F.col("win"))
    by_text = hits.groupBy("_key").agg(F.array_sort(F.collect_set(F.struct(begin.alias("begin"), "n"))).alias("at"),
                                       F.array_sort(F.collect_set("item")).alias("items"))

    def cover(a, x):  # each window adds what lies beyond the furthest end so far
        end = x["begin"] + x["n"]
        new = F.greatest(end - F.greatest(a["end"], x["begin"]), F.lit(0))
        return F.struct(F.greatest(a["end"], end).alias("end"), (a["hit"] + new).alias("hit"))
    none = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))
    by_text = saved(by_text.select("_key", "items", F.aggregate("at", none, cover)["hit"].alias("n_hit")),
                    "decontaminate-hits")
    return seen.join(by_text, "_key", "left").select(
        "_doc", "_key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items")) \
        .withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= min_share_pct * F.col("n_words")))


def drop_contaminated(docs: DataFrame, items: DataFrame, **rules) -> DataFrame:
    """``docs`` without contaminated rows, all columns kept."""
    bad = judge(docs, items, [], **rules).where("contaminated").select("_key").distinct()
    return packed(docs).withColumn("_key", F.md5(F.col("_t").cast("binary"))) \
        .join(saved(bad, "decontaminate-bad"), "_key", "left_anti").select("_doc.*")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("_doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
