"""Cohort report queries: the report, its view, each step, and the row-level views."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import cohort as C
from .marketplace import cohort_orders, table
from .registry import register
from .sqltext import pct_sql, round_div_sql
from ..functions.dates import month_trunc, period_num
from ..session import fresh_dir
from ..streaming.cohort_view import CohortView


def _months(spark, sf_dir):
    return C.user_months(cohort_orders(spark, sf_dir))


def _as_double(df, column):
    """Money as DOUBLE for comparison with the oracle."""
    return df.withColumn(column, F.col(column).cast("double"))


# The oracle tags each order with its age in months since its user's first order, and filters aggregates by it.
_AGED = """
WITH aged AS (
    SELECT *, (year(ordered) - year(began)) * 12 + month(ordered) - month(began) AS age
    FROM (SELECT o_orderkey, o_custkey AS buyer, o_orderdate AS ordered, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
                 CAST(date_trunc('month', min(o_orderdate) OVER (PARTITION BY o_custkey)) AS TIMESTAMP) AS began
          FROM orders))
"""
_IN = f"age < {C.PERIODS}"


def _active(i: int) -> str:
    return f"count(DISTINCT buyer) FILTER (WHERE age = {i})"


_REPORT = _AGED + "SELECT began AS cohort_month, count(DISTINCT buyer) AS cohort_size, " + ", ".join(
    f"{pct_sql(_active(i), 'count(DISTINCT buyer)')} AS period_{i}_pct" for i in range(C.PERIODS)) + f""",
       CAST(sum(amount) FILTER (WHERE {_IN}) AS DOUBLE) AS total_cohort_revenue,
       {round_div_sql(f"coalesce(sum(amount) FILTER (WHERE {_IN}), 0) * 100", "count(DISTINCT buyer)")} AS avg_revenue_per_customer
FROM aged GROUP BY began"""


@register("cohort_analysis", _REPORT)
def q_cohort_analysis(spark, sf_dir):
    return _as_double(C.cohort_report(cohort_orders(spark, sf_dir)), "total_cohort_revenue")


@register("cohort_one_pass", _REPORT)
def q_cohort_one_pass(spark, sf_dir):
    return _as_double(C.cohort_report(cohort_orders(spark, sf_dir)), "total_cohort_revenue")


@register("cohort_view_kept", _REPORT)
def q_cohort_view_kept(spark, sf_dir):
    """The report kept up to date by five batches of orders, which hold first orders of users that earlier batches know."""
    view = CohortView(spark, fresh_dir(spark, "cohort-view"))
    orders = cohort_orders(spark, sf_dir, extra=["o_orderkey"])
    for batch in range(5):
        view.apply(orders.where(F.col("o_orderkey") % 5 == batch).drop("o_orderkey"), batch)
    return _as_double(view.report(), "total_cohort_revenue")


@register("cohort_view", _REPORT)
def q_cohort_view(spark, sf_dir):
    """CREATE OR REPLACE VIEW over the report, then all of the view."""
    return _as_double(C.register_cohort_view(spark, cohort_orders(spark, sf_dir)), "total_cohort_revenue")


@register("first_purchase", _AGED + "SELECT DISTINCT buyer AS user_external_id, began AS cohort_month FROM aged")
def q_first_purchase(spark, sf_dir):
    return C.first_purchase(cohort_orders(spark, sf_dir))


@register("cohort_size", _AGED + "SELECT began AS cohort_month, count(DISTINCT buyer) AS cohort_size FROM aged GROUP BY began")
def q_cohort_size(spark, sf_dir):
    return C.cohort_size(_months(spark, sf_dir))


_ROWS = f"""buyer AS user_external_id, CAST(date_trunc('month', ordered) AS TIMESTAMP) AS activity_month,
       began AS cohort_month, CAST(age AS INTEGER) AS period_num, CAST(amount AS DOUBLE) AS total_amount
FROM aged WHERE {_IN}"""


@register("user_activity", _AGED + "SELECT " + _ROWS)
def q_user_activity(spark, sf_dir):
    return _as_double(C.user_activity(cohort_orders(spark, sf_dir)), "total_amount")


@register("cohort_activity", _AGED + f"""
SELECT began AS cohort_month, CAST(age AS INTEGER) AS period_num, count(DISTINCT buyer) AS active_users,
       CAST(sum(amount) AS DOUBLE) AS period_revenue
FROM aged WHERE {_IN} GROUP BY began, age""")
def q_cohort_activity(spark, sf_dir):
    return _as_double(C.cohort_activity(_months(spark, sf_dir)), "period_revenue")


@register("cohort_pivot", _AGED + "SELECT began AS cohort_month, count(DISTINCT buyer) AS cohort_size, " + ", ".join(
    f"{_active(i)} AS period_{i}_active" for i in range(C.PERIODS)) + " FROM aged GROUP BY began")
def q_cohort_pivot(spark, sf_dir):
    return C.cohort_pivot(_months(spark, sf_dir))


@register("cohort_revenue", _AGED + f"""
SELECT began AS cohort_month, CAST(sum(amount) AS DOUBLE) AS total_cohort_revenue FROM aged WHERE {_IN} GROUP BY began""")
def q_cohort_revenue(spark, sf_dir):
    return _as_double(C.cohort_revenue(_months(spark, sf_dir)), "total_cohort_revenue")


@register("user_activity_join", _AGED + f"""
SELECT began AS cohort_month, count(*) AS orders_in_window, count(DISTINCT buyer) AS users
FROM aged WHERE {_IN} GROUP BY began""")
def q_user_activity_join(spark, sf_dir):
    """E1, counted: orders of each cohort within its window, from the row-level join."""
    return C.orders_in_window(C.user_activity(cohort_orders(spark, sf_dir)))


@register("cohort_window_filter", _AGED + f"""
SELECT buyer AS user_external_id, ordered AS order_date, began AS cohort_month, CAST(amount AS DOUBLE) AS total_amount
FROM aged WHERE {_IN}""")
def q_cohort_window_filter(spark, sf_dir):
    return C.in_cohort_window(C.with_cohort_month(cohort_orders(spark, sf_dir))).select(
        C.USER, "order_date", "cohort_month", F.col("total_amount").cast("double").alias("total_amount"))


@register("month_trunc", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS order_month FROM orders""")
def q_month_trunc(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", month_trunc("o_orderdate").alias("order_month"))


@register("period_num", _AGED + "SELECT o_orderkey, CAST(age % 12 AS INTEGER) AS period_num FROM aged")
def q_period_num(spark, sf_dir):
    """Month field of AGE(order month, cohort month) for every order (wraps at 12)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias(C.USER),
                                              F.col("o_orderdate").alias("order_date"))
    return C.with_cohort_month(o).select(
        "o_orderkey", period_num(month_trunc("order_date"), F.col("cohort_month")).alias("period_num"))


@register("retention_pct", _AGED + f"""
, size AS (SELECT began, count(DISTINCT buyer) AS n FROM aged GROUP BY began)
SELECT began AS cohort_month, CAST(age AS INTEGER) AS period_num, count(DISTINCT buyer) AS active_users,
       any_value(n) AS cohort_size, {pct_sql('count(DISTINCT buyer)', 'any_value(n)')} AS retention_pct
FROM aged JOIN size USING (began) WHERE {_IN} GROUP BY began, age""")
def q_retention_pct(spark, sf_dir):
    """I13 on the long form: exact half-up percentages per (cohort, period)."""
    return C.retention(_months(spark, sf_dir))
