"""The driver tables seen as the marketplace's operational tables.

Mapping (SURVEY 2.N): customer -> users, part -> products, orders -> orders,
lineitem -> order_items and shipments, supplier -> warehouses, and the
``events`` table -> user status changes (repeated satellite versions, with
``event_type = 'error'`` standing for a delete).  Each function returns
source rows shaped like the operational table (business columns only, wire
values already typed), reading only the columns it needs so the Parquet scan
prunes the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import epoch_millis
from ..functions.numeric import to_money


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _key(c: str):
    return F.col(c).cast("string")


def _money_text(c: str):
    """Wire form of a DECIMAL column: its text at scale 2."""
    return to_money(c).cast("string")


def cohort_orders(spark: SparkSession, sf_dir: str, extra: list[str] | None = None) -> DataFrame:
    """Orders as the cohort report reads them (user key kept in its native type), and ``extra`` columns."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_external_id"),
        F.col("o_orderdate").alias("order_date"),
        to_money("o_totalprice").alias("total_amount"), *(extra or []),
    )


# Wire rows: one column per source attribute, in wire types (strings for keys
# and decimals, bigint millis for timestamps).  Attributes the driver tables do
# not carry are simply absent; the decoder turns absent keys into NULL.

def users_rows(spark: SparkSession, sf_dir: str, key: int | None = None) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    if key is not None:
        c = c.where(F.col("c_custkey") == key)
    return c.select(
        _key("c_custkey").alias("user_external_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("status"),
    )


def products_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        _key("p_partkey").alias("product_sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        _money_text("p_retailprice").alias("price"),
        F.col("p_size").cast("bigint").alias("weight_grams"),
    )


def orders_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        _key("o_orderkey").alias("order_external_id"),
        _key("o_custkey").alias("user_external_id"),
        F.concat(F.lit("ORD-"), _key("o_orderkey")).alias("order_number"),
        epoch_millis("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        _money_text("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("delivery_type"),
    )


def order_items_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _key("l_orderkey").alias("order_external_id"),
        _key("l_partkey").alias("product_sku"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        _money_text("l_extendedprice").alias("total_price"),
        epoch_millis("l_shipdate").alias("shipped_ms"),
    )


def warehouses_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        _key("s_suppkey").alias("warehouse_code"),
        F.col("s_name").alias("warehouse_name"),
    )


def shipments_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shipment per order line; the pickup point is set for returned lines,
    empty for accepted ones and absent (NULL) otherwise, so all three link-key
    cases of the loader occur."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", _key("l_orderkey"), _key("l_linenumber")).alias("shipment_external_id"),
        _key("l_orderkey").alias("order_external_id"),
        _key("l_suppkey").alias("origin_warehouse_code"),
        F.when(F.col("l_returnflag") == "R", _key("l_suppkey"))
         .when(F.col("l_returnflag") == "A", F.lit("")).alias("destination_pickup_point_code"),
        F.concat(F.lit("TRK-"), _key("l_orderkey"), F.lit("-"), _key("l_linenumber")).alias("tracking_number"),
        F.col("l_linestatus").alias("status"),
        F.col("l_quantity").cast("bigint").alias("package_count"),
        epoch_millis("l_shipdate").alias("shipped_ms"),
    )


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country and region by nation key."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("country"), F.col("r_name").alias("region"))


def user_addresses_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One home address per customer."""
    c = table(spark, sf_dir, "customer").withColumn("nation", F.col("c_nationkey"))
    return c.join(_places(spark, sf_dir), "nation").select(
        F.concat(F.lit("A-"), _key("c_custkey")).alias("address_external_id"),
        _key("c_custkey").alias("user_external_id"), F.lit("home").alias("address_type"), "country", "region",
        (F.col("c_acctbal") > 0).alias("is_default"), F.col("c_custkey").alias("number"))


def pickup_points_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier also runs a pickup point."""
    s = table(spark, sf_dir, "supplier").withColumn("nation", F.col("s_nationkey"))
    return s.join(_places(spark, sf_dir), "nation").select(
        _key("s_suppkey").alias("pickup_point_code"), F.col("s_name").alias("pickup_point_name"), "country", "region",
        (F.col("s_acctbal") > 0).alias("is_active"))


def shipment_movements_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dispatch of every order line; lines without a return flag decision (N) have lost their shipment."""
    li = table(spark, sf_dir, "lineitem")
    shipment = F.concat_ws("-", _key("l_orderkey"), _key("l_linenumber"))
    return li.select(
        F.when(F.col("l_returnflag") != "N", shipment).alias("shipment_external_id"),
        F.lit("dispatch").alias("movement_type"), F.lit("warehouse").alias("location_type"),
        _key("l_suppkey").alias("location_code"), epoch_millis("l_shipdate").alias("movement_datetime"),
        F.col("l_orderkey").alias("number"))


def shipment_status_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", _key("l_orderkey"), _key("l_linenumber")).alias("shipment_external_id"),
        F.col("l_linestatus").alias("new_status"), epoch_millis("l_shipdate").alias("changed_at"),
        (F.col("l_returnflag") == "R").alias("customer_notified"), F.col("l_orderkey").alias("number"))


def status_change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status changes of users from ``events``: ordered by (ts, event_id)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        _key("user_id").alias("user_external_id"),
        F.col("event_type").alias("new_status"),
        F.col("props").alias("change_reason"),
        epoch_millis("ts").alias("changed_at"),
        F.col("ts"),
        (F.col("event_type") == "error").alias("is_delete"),
    )
