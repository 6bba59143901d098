"""Parity of two large copies of a table: checksums by bucket, rows only where they differ.

Both copies are reduced to one row per bucket of the key's hash: the number of rows, the xor and the sums of the rows'
64-bit hashes, all independent of the rows' order and combined before the shuffle.  Only the rows of buckets whose
checksums differ are shuffled and compared; when two copies of ten billion rows differ in a hundred, that is a hundred
buckets' worth.  Rows are compared as multisets, value by value, so the counts are exact for every bucket looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def checksums(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, bits, low, high) of a copy: row count, xor of the rows' hashes, sums of their halves.

    An even number of equal rows cancels in the xor, but not in the sums.  A null and a missing value hash differently
    from any other, since every column adds its own null flag.
    """
    row = F.xxhash64(*df.columns, *[F.col(c).isNull() for c in df.columns])
    return df.select(bucket_of(keys, buckets).alias("bucket"), row.alias("h")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("h").alias("bits"),
        F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.sum(F.shiftright("h", 32)).alias("high"))


def differing_buckets(a: DataFrame, b: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, source_rows, target_rows, differs), a row for every bucket that either copy has: at most ``buckets``."""
    x, y = (checksums(d, keys, buckets).select("bucket", "rows", F.struct("rows", "bits", "low", "high").alias("sums")) for d in (a, b))
    x, y = x.alias("x"), y.alias("y")
    return x.join(y, F.col("x.bucket") == F.col("y.bucket"), "full_outer").select(
        F.coalesce("x.bucket", "y.bucket").alias("bucket"), F.coalesce("x.rows", F.lit(0)).alias("source_rows"),
        F.coalesce("y.rows", F.lit(0)).alias("target_rows"), (~F.col("x.sums").eqNullSafe(F.col("y.sums"))).alias("differs"))


def differences(a: DataFrame, b: DataFrame, keys: list[str], buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """(the buckets, rows of differing buckets with how often each copy has them: the columns, _source, _target).

    The list of differing buckets is at most ``buckets`` numbers and goes to the tasks as a literal set, so rows of
    other buckets are dropped in the scan's stage, before any exchange.
    """
    found = differing_buckets(a, b, keys, buckets).persist()
    try:
        wanted = [r["bucket"] for r in found.where("differs").select("bucket").collect()]
        sums = found.agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows")).first()
    finally:
        found.unpersist()
    spark = a.sparkSession
    totals = spark.createDataFrame([(sums["source_rows"] or 0, sums["target_rows"] or 0, len(wanted))],
                                   "source_rows bigint, target_rows bigint, buckets bigint")
    inside = bucket_of(keys, buckets).isin(wanted) if wanted else F.lit(False)
    cols = a.columns
    tagged = a.where(inside).select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")) \
        .unionByName(b.select(*cols).where(inside).select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    rows = tagged.groupBy(*cols).agg(F.sum("_a").alias("_source"), F.sum("_b").alias("_target"))
    return totals, rows


def reconcile_by_bucket(name: str, a: DataFrame, b: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(check_name, source_rows, target_rows, missing_in_target, extra_in_target): the answer of ``quality.reconcile``.

    A change that leaves a bucket's count, xor and both sums as they were would be missed; for a random change the chance
    is below 2 ** -64.
    """
    totals, rows = differences(a, b.select(*a.columns), keys, buckets)
    surplus = lambda x, y: F.coalesce(F.sum(F.greatest(F.col(x) - F.col(y), F.lit(0))), F.lit(0)).cast("bigint")
    diff = rows.agg(surplus("_source", "_target").alias("missing_in_target"), surplus("_target", "_source").alias("extra_in_target"))
    return totals.join(diff, F.lit(True)).select(
        F.lit(name).alias("check_name"), "source_rows", "target_rows", "missing_in_target", "extra_in_target")
