"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources in code point order (null last) weigh 5, 2, 1, repeating, and share ``factor`` times all words.  No source
gets more than ``cap`` times its own words; what is above is shared again by weight: the targets are
``min(cap * size, level * weight)`` with the level that makes them add up.

A source with target T and S words takes floor(T / S) complete epochs, then a sample without replacement for the
rest: every document draws an exponential key with its quality as the rate, ``-ln(u) / quality``, u from a hash of
its id and text; in key order documents are taken until the rest is full, the last one for the words still missing.

The order is never sorted as a whole.  Keys fall into ``BUCKETS`` ranges; word sums by source and range (small,
combined before the shuffle) show which ranges are in, which are out, and the one that holds the border; only that
range's rows are sorted.  So a source with a third of all rows needs no task of its own.

Defined cases: null = empty text = size 0, taken 0; a source without words has target 0; null is a source of its own;
rows equal in id and text draw equal keys and are taken one after the other, other rows of one id draw their own; extra columns pass through; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, packed, saved, table, text_of
from .dartminhash import row_key

WEIGHTS = (5, 2, 1)
BUCKETS = 1024


def quality(text: Column) -> Column:
    """A document's rate: from a quarter (no letters) to 1 (nothing but letters)."""
    letters = F.regexp_count(text, F.lit(r"[\p{L}]"))
    return F.lit(0.25) + F.lit(0.75) * letters / F.greatest(F.length(text) - F.regexp_count(text, F.lit(r"\s")), letters, F.lit(1))


def uniform(identity: Column, seed: int) -> Column:
    """A number in (0, 1) from 52 bits of an md5."""
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), identity).cast("binary")), 1, 13)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, factor: float = 1.5, cap: int = 2) -> DataFrame:
    """(s, source_size, target) of the sources (s, size); ``s`` in order is the order of the weights."""
    by_source = saved(sizes.groupBy("s").agg(F.sum("size").alias("source_size")), "mix-sources")
    # a source's place: its place in its range, and the number of sources in the ranges before
    ranged = saved(by_source.repartitionByRange("s").withColumn("part", F.spark_partition_id()), "mix-ranges")
    ranged = ranged.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy("s")))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    ahead = ranged.groupBy("part").agg(F.count("*").alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    turn = (F.col("place") + F.col("ahead") - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in WEIGHTS]), (turn + 1).cast("int"))
    placed = saved(ranged.join(ahead, "part").select("s", "source_size", weight.alias("weight")), "mix-weights")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:  # whole numbers are summed, so that reruns agree
        capped = F.col("source_size") * cap <= F.lit(level) * F.col("weight")
        r = placed.agg(F.count(F.when(capped, 1)).alias("n"), F.sum(F.when(capped, F.col("source_size") * cap)).alias("used"),
                       F.sum(F.when(~capped, F.col("weight"))).alias("free")).first()
        if r["n"] == full or not r["free"]:
            break
        full, level = r["n"], (factor * total - (r["used"] or 0)) / r["free"]
    goal = F.least(F.col("source_size") * float(cap), F.lit(level) * F.col("weight"))
    return placed.select("s", "source_size", F.when(F.col("source_size") > 0, goal).otherwise(F.lit(0.0)).alias("target"))


def sample(docs: DataFrame, carry: list[str], seed: int = 0, factor: float = 1.5, cap: int = 2) -> DataFrame:
    """Per row: ``_doc`` (its ``carry`` columns), ``_key`` (its id and text), size, source_size, target, taken."""
    text = text_of("text")
    rows = docs.select(
        F.struct(*carry).alias("_doc"), row_key(docs).alias("_key"), quality(text).alias("rate"),
        F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source"))).alias("s"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
    # from the key's column, or the text would be hashed twice
    rows = rows.withColumn("k", -F.log(uniform(F.col("_key"), seed)) / F.col("rate")).drop("rate")
    # any rising function of the key serves; this one spreads keys of rate 1 evenly
    rows = saved(rows.withColumn("b", F.floor((1 - F.exp(-F.col("k"))) * BUCKETS).cast("int")), "mix-rows")
    goal = saved(targets(rows, factor, cap), "mix-targets")
    sums = rows.groupBy("s", "b").agg(F.sum("size").alias("here"))
    up_to = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = sums.withColumn("before", F.coalesce(F.sum("here").over(up_to), F.lit(0))).join(goal, "s") \
        .withColumn("epochs", epochs) \
        .withColumn("rest", F.round("target").cast("long") - F.col("epochs") * F.col("source_size"))
    joined = saved(rows.join(saved(plan, "mix-plan"), ["s", "b"]), "mix-joined")
    border = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("here") > F.col("rest"))
    in_order = Window.partitionBy("s").orderBy("k", "_key").rowsBetween(Window.unboundedPreceding, -1)
    edge = joined.where(border).withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(in_order), F.lit(0)))
    part = F.least(F.greatest(F.col("rest") - F.col("before"), F.lit(0)), F.col("size"))
    # outside the border range a document is in as a whole or not at all
    clear = joined.where(~border).withColumn("before", F.when(F.col("before") < F.col("rest"), F.lit(0)).otherwise(F.col("rest"))) \
        .withColumn("rest", F.when(F.col("before") == 0, F.when(F.col("rest") > 0, F.col("size")).otherwise(0)).otherwise(F.col("rest")))
    return edge.unionByName(clear).select("_doc", "_key", "size", "source_size", "target",
                                          (F.col("epochs") * F.col("size") + part).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: ``docs`` with a row for every pass over a document, and ``epoch`` (from 1) and ``take_words``
    (all words, but for the one document of a source where the budget ends)."""
    taken = sample(docs, ["doc_id"], **options).where("taken > 0") \
        .groupBy("_key", "size").agg(F.sort_array(F.collect_list("taken"), asc=False).alias("takes"))
    rows = packed(docs).select("_doc", F.md5(F.concat(
        F.md5(F.col("_t").cast("binary")), F.lit(":"), F.coalesce(F.col("_doc.doc_id").cast("string"), F.lit("null")))
        .cast("binary")).alias("_key"))
    rows = rows.join(saved(taken, "mix-taken"), "_key")
    # equal rows share a key: the first gets the first entry, and so on
    turn = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    rows = rows.withColumn("_take", F.get("takes", turn - 1)).where("_take is not null")
    passes = F.sequence(F.lit(1), F.ceil(F.col("_take") / F.col("size")).cast("int"))
    rows = rows.select("_doc", "size", "_take", F.explode(passes).alias("epoch"))
    return rows.select("_doc.*", "epoch", F.least("size", F.col("_take") - (F.col("epoch") - 1) * F.col("size")).alias("take_words"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample(table(spark, sf_dir, "documents"), ["doc_id"]).select("_doc.doc_id", "size", "source_size", "target", "taken")


# The level in one statement: sources by the level at which they are full; the last that is not full sets it.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, md5(md5(coalesce(text, '')) || ':' || coalesce(doc_id::VARCHAR, 'null')) AS i, source, coalesce(text, '') AS t,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
k AS (
  SELECT doc_id, i, source, size,
         -ln((('0x' || substr(md5('0:' || i), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
         / (0.25 + 0.75 * len(regexp_extract_all(t, '\pL'))
            / greatest(length(t) - len(regexp_extract_all(t, '[\x20\x09-\x0D]')), len(regexp_extract_all(t, '\pL')), 1)) AS k
  FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 + 1)::INT] AS weight FROM s),
f AS (
  SELECT *, 2 * source_size / weight AS full_at,
         coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (ORDER BY 2 * source_size / weight, source
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         1.5 * sum(source_size) OVER () AS goal FROM w),
level AS (SELECT arg_min((goal - used) / free, full_at) FILTER (WHERE (goal - used) / free < full_at) AS lv FROM f),
g AS (
  SELECT source, source_size, least(2.0 * source_size, coalesce(lv, 0) * weight)::DOUBLE AS target FROM w, level),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM g),
r AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, round(e.target)::BIGINT - e.epochs * e.source_size AS rest,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.k, k.i
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + least(greatest(rest - before, 0), size))::BIGINT AS taken FROM r
"""
