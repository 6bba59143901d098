"""Data-quality checks: orphans, key uniqueness, reconciliation, coverage.

All checks reduce the larger side to distinct keys with a partial aggregate
*before* any join, so a key that owns a third of the child rows is one row per
map task when it reaches the exchange; the anti-joins then run over key sets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def insert_absent(df: DataFrame, target: DataFrame, keys, arrival=None) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO NOTHING: target plus new-key rows of ``df``.

    One row per new key: the one with the smallest ``arrival`` columns, as a
    row-by-row insert-ignore in that order would keep; without ``arrival``, or
    among equal arrivals, the smallest row (the columns in order).
    """
    keys = _keys(keys)
    rest = [c for c in df.columns if c not in keys]
    order = _keys(arrival) if arrival is not None else []
    if rest:
        first = F.min(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], *rest)).alias("_f")
        one = df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_f.{c}").alias(c) for c in rest])
    else:
        one = df.dropDuplicates(keys)
    fresh = one.join(target.select(*keys).dropDuplicates(keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def orphans(child: DataFrame, parent: DataFrame, child_key, parent_key=None) -> DataFrame:
    """Child keys with no parent row: (key..., child_rows).  NULL child keys are not orphans."""
    ck = _keys(child_key)
    pk = _keys(parent_key) if parent_key is not None else ck
    not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ck])
    per_key = child.where(not_null).groupBy(*ck).agg(F.count(F.lit(1)).alias("child_rows"))
    parents = parent.select(*[F.col(p).alias(c) for p, c in zip(pk, ck)]).dropDuplicates(ck)
    return per_key.join(parents, ck, "left_anti")


def orphan_summary(relation: str, child: DataFrame, parent: DataFrame, child_key, parent_key=None
                   ) -> DataFrame:
    o = orphans(child, parent, child_key, parent_key)
    return o.agg(F.count(F.lit(1)).alias("orphan_keys"),
                 F.coalesce(F.sum("child_rows"), F.lit(0)).cast("bigint").alias("orphan_rows")) \
            .select(F.lit(relation).alias("relation"), "orphan_keys", "orphan_rows")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once: (key..., rows)."""
    keys = _keys(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def uniqueness_summary(relation: str, df: DataFrame, keys) -> DataFrame:
    """(relation, total_rows, distinct_keys, duplicated_keys) in one aggregate pass."""
    keys = _keys(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count(F.when(F.col("n") > 1, 1)).alias("duplicated_keys"),
    ).select(F.lit(relation).alias("relation"), "total_rows", "distinct_keys", "duplicated_keys")


def row_count(df: DataFrame, label: str | None = None) -> DataFrame:
    cols: list[Column] = [F.lit(label).alias("table")] if label is not None else []
    return df.agg(F.count(F.lit(1)).alias("rows")).select(*cols, "rows")


def reconcile(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
    """Row parity of two copies: counts plus multiset differences both ways.

    ``exceptAll`` is a union and one aggregate over all columns (partial-
    aggregated), so duplicates are counted, not collapsed.
    """
    cols = a.columns
    b = b.select(*cols)
    tagged = (a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
               .unionByName(b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    per_row = tagged.groupBy(*cols).agg(F.sum("_a").alias("na"), F.sum("_b").alias("nb"))
    return per_row.agg(
        F.coalesce(F.sum("na"), F.lit(0)).cast("bigint").alias("source_rows"),
        F.coalesce(F.sum("nb"), F.lit(0)).cast("bigint").alias("target_rows"),
        F.coalesce(F.sum(F.greatest(F.col("na") - F.col("nb"), F.lit(0))), F.lit(0)).cast("bigint")
         .alias("missing_in_target"),
        F.coalesce(F.sum(F.greatest(F.col("nb") - F.col("na"), F.lit(0))), F.lit(0)).cast("bigint")
         .alias("extra_in_target"),
    ).select(F.lit(name).alias("check_name"), "*")


def missing_in_hub(source: DataFrame, hub: DataFrame, bk: str, hk_col: str) -> DataFrame:
    """Source business keys whose hash is not in the hub (must be empty after a load)."""
    src = source.select(F.col(bk).cast("string").alias(bk)).where(F.col(bk).isNotNull()).dropDuplicates([bk])
    src = src.withColumn(hk_col, F.md5(F.col(bk)))
    return src.join(hub.select(hk_col).dropDuplicates([hk_col]), hk_col, "left_anti")


def hub_without_sat(hub: DataFrame, sat: DataFrame, hk_col: str) -> DataFrame:
    """Hub rows that have no satellite row."""
    return hub.join(sat.select(hk_col).dropDuplicates([hk_col]), hk_col, "left_anti")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def over_length(df: DataFrame, target) -> DataFrame:
    """Rows with a string longer than its VARCHAR limit: (column, rows, max_length) per column.

    Values are kept as they are; this only reports them (the target's reaction
    to over-long text is not specified).
    """
    from ..functions.coerce import VARCHAR_LIMIT, sql_type
    limits = {a.name: VARCHAR_LIMIT[sql_type(a.declared)] for a in target.attrs
              if sql_type(a.declared) in VARCHAR_LIMIT and a.name in df.columns}
    if not limits:
        return df.sparkSession.createDataFrame([], "column string, rows bigint, max_length int")
    aggs = []
    for name, lim in limits.items():
        aggs += [F.count(F.when(F.length(name) > lim, 1)).alias(f"{name}__n"),
                 F.max(F.length(name)).alias(f"{name}__max")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}__n`, `{n}__max`" for n in limits)
    return wide.selectExpr(f"stack({len(limits)}, {stack}) AS (column, rows, max_length)")
