"""Cohort report: the report equals a brute-force model on the edge cases."""

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import types as T

from vaultline.plans import cohort as C

D = dt.datetime
SCHEMA = T.StructType([
    T.StructField("user_external_id", T.LongType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("total_amount", T.DecimalType(18, 2)),
])

EDGE_ORDERS = [
    (1, D(2020, 1, 15), Decimal("10.00")),
    (1, D(2020, 6, 30, 23, 59), Decimal("5.55")),     # last minute of month 5 -> period 5
    (1, D(2020, 7, 1), Decimal("99.00")),             # exactly +6 months -> excluded
    (2, D(2020, 12, 10), Decimal("1.00")),
    (2, D(2021, 1, 5), Decimal("2.00")),              # Dec -> Jan rollover -> period 1
    (3, D(2019, 3, 1), Decimal("7.00")),
    (3, D(2020, 3, 5), Decimal("8.00")),              # 12 months later -> excluded, no wrap
    (4, None, Decimal("3.00")),                       # only NULL dates -> NULL cohort
    (5, D(2020, 1, 20), None),                        # NULL amount only
    (6, D(2020, 1, 2), Decimal("4.00")),
    (6, None, Decimal("6.00")),                       # NULL date beside a real one
    (7, D(2020, 1, 31, 12), Decimal("0.01")),
    (7, D(2020, 3, 1), Decimal("0.02")),
]


def month(d):
    return D(d.year, d.month, 1)


def add_months(d, n):
    y, m = divmod(d.month - 1 + n, 12)
    return D(d.year + y, m + 1, 1)


def model_report(orders):
    first = {}
    for u, d, _ in orders:
        first.setdefault(u, None)
        if d is not None and (first[u] is None or d < first[u]):
            first[u] = d
    cohort = {u: (month(d) if d else None) for u, d in first.items()}
    size = defaultdict(int)
    for u, c in cohort.items():
        size[c] += 1
    active = defaultdict(set)
    revenue = {}
    for u, d, a in orders:
        c = cohort[u]
        if d is None or c is None or not d < add_months(c, 6):
            continue
        p = ((d.year - c.year) * 12 + d.month - c.month) % 12
        active[(c, p)].add(u)
        if a is not None:
            revenue[c] = revenue.get(c, Decimal(0)) + a
        else:
            revenue.setdefault(c, None)
    out = {}
    for c, n in size.items():
        pcts = [float((Decimal(len(active[(c, p)]) * 100) / n).quantize(Decimal("0.01"), ROUND_HALF_UP))
                for p in range(6)]
        rev = revenue.get(c)
        arpc = float(((rev or Decimal(0)) / n).quantize(Decimal("0.01"), ROUND_HALF_UP))
        out[c] = (n, pcts, None if rev is None else float(rev), arpc)
    return out


def as_dict(df):
    out = {}
    for r in df.collect():
        rev = r["total_cohort_revenue"]
        out[r["cohort_month"]] = (r["cohort_size"], [r[f"period_{i}_pct"] for i in range(6)],
                                  None if rev is None else float(rev), r["avg_revenue_per_customer"])
    return out


@pytest.mark.parametrize("plan", ["report", "prepartitioned", "view"])
def test_edges_match_model(spark, plan):
    df = spark.createDataFrame(EDGE_ORDERS, SCHEMA)
    res = {"report": lambda: C.cohort_report(df),
           "prepartitioned": lambda: C.cohort_report(df, pre_partition=True),
           "view": lambda: C.register_cohort_view(spark, df, name="cohort_edges_view")}[plan]()
    got = as_dict(res)
    assert got == model_report(EDGE_ORDERS)
    # NULL cohort sorts last; period 0 is 100.00 for every dated cohort
    rows = res.collect()
    assert rows[-1]["cohort_month"] is None
    assert all(r["period_0_pct"] == 100.0 for r in rows if r["cohort_month"] is not None)


def test_null_cohort_row(spark):
    got = as_dict(C.cohort_report(spark.createDataFrame(EDGE_ORDERS, SCHEMA)))
    assert got[None] == (1, [0.0] * 6, None, 0.0)


def test_half_up_percentages(spark):
    # 1 of 8 = 12.5 %, 1 of 3 = 33.33 %, 2 of 3 = 66.67 %, 1 of 16 = 6.25 %: exact half-up
    from vaultline.functions.numeric import pct, round_div
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (1, 16), (1, 6), (5, 7)], "a long, s long")
    got = [r[0] for r in df.select(pct("a", "s")).collect()]
    assert got == [12.5, 33.33, 66.67, 6.25, 16.67, 71.43]
    money = spark.createDataFrame([(Decimal("0.05"), 2), (Decimal("10.01"), 4)], "m decimal(18,2), s long")
    assert [r[0] for r in money.select(round_div("m", "s", 2, num_scale=2)).collect()] == [0.03, 2.5]


def test_orders_without_a_user_count_nowhere(spark):
    rows = [(1, D(2020, 1, 1), Decimal("5.00")), (None, D(2020, 1, 2), Decimal("10.00")), (None, D(2020, 2, 2), Decimal("1.00"))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert as_dict(C.cohort_report(df)) == {D(2020, 1, 1): (1, [100.0] + [0.0] * 5, 5.0, 5.0)}
    alone = C.cohort_report(spark.createDataFrame(rows[1:], SCHEMA)).collect()
    assert [(r["cohort_size"], r["total_cohort_revenue"], r["period_0_pct"]) for r in alone] == [(0, None, None)]
    assert C.with_cohort_month(df).count() == 1


def test_windows_above_a_year_are_refused(spark):
    df = spark.createDataFrame(EDGE_ORDERS, SCHEMA)
    assert len(C.cohort_report(df, 12).columns) == 16
    for bad in (0, 13):
        with pytest.raises(ValueError, match="1 to 12 months"):
            C.cohort_report(df, bad)


def test_rows_of_a_hot_user_are_spread(spark):
    """Without broadcasts, a user with a third of the orders does not fill one task of the row-level join."""
    from pyspark.sql import functions as F
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("user_external_id"),
                                   F.expr("timestampadd(DAY, cast(id % 90 as int), TIMESTAMP_NTZ'2020-01-01 00:00:00')").alias("order_date"),
                                   F.lit(1).cast("decimal(18,2)").alias("total_amount"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        per_task = C.with_cohort_month(df).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in per_task) == 30000
    assert max(r["count"] for r in per_task) < 3 * 30000 / 16


def test_hot_user_owning_a_third_of_orders(spark):
    """Skew: one user owns a third of all orders; the report still equals the model."""
    from pyspark.sql import functions as F
    from tests.conftest import SF_SMALL
    from vaultline.plans.marketplace import table
    o = table(spark, SF_SMALL, "orders")
    hot = o.select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("o_custkey")).alias("user_external_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_amount"))
    rows = [(r[0], r[1], r[2]) for r in hot.collect()]
    assert sum(1 for r in rows if r[0] == -1) * 3 >= len(rows) - 3
    want = model_report(rows)
    assert as_dict(C.cohort_report(hot)) == want
