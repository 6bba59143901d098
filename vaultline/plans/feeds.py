"""Change-event feeds derived from the driver tables.

Each ``*_decoded`` function returns a decoded event frame (the shape
``operators.decode`` produces) for one marketplace topic; ``*_json`` returns
the same events as raw Kafka-shaped records with JSON values, to exercise the
decoder.  Load times are passed in from the data (order date, ship date,
event time) or a fixed snapshot instant -- never the clock -- so results are
reproducible.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import VaultModel
from ..operators.decode import rows_to_decoded
from ..sources.cdc import snapshot_to_events
from . import marketplace as M

SNAPSHOT_AT = "TIMESTAMP_NTZ'2024-02-01 00:00:00'"


@lru_cache(maxsize=1)
def model() -> VaultModel:
    return VaultModel.load()


def _snapshot_ts():
    return F.expr(SNAPSHOT_AT)


def users_decoded(spark: SparkSession, sf_dir: str, key: int | None = None) -> DataFrame:
    """The users snapshot, of one business key if given."""
    rows = M.users_rows(spark, sf_dir, key)
    return rows_to_decoded(rows, model().source("users"), offset=F.col("user_external_id").cast("bigint"),
                           load_dt=_snapshot_ts())


def user_changes_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """users topic from ``events``: each event sets the user's status; 'error' deletes."""
    rows = M.status_change_rows(spark, sf_dir).withColumnRenamed("new_status", "status")
    return rows_to_decoded(rows, model().source("users"), offset=F.col("event_id"), load_dt=F.col("ts"),
                           deleted=F.col("is_delete"), op="u")


def status_history_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.status_change_rows(spark, sf_dir)
    return rows_to_decoded(rows, model().source("user_status_history"), offset=F.col("event_id"),
                           load_dt=F.col("ts"), deleted=F.col("is_delete"), op="c")


def products_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.products_rows(spark, sf_dir)
    return rows_to_decoded(rows, model().source("products"), offset=F.col("product_sku").cast("bigint"),
                           load_dt=_snapshot_ts())


def orders_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.orders_rows(spark, sf_dir)
    return rows_to_decoded(rows, model().source("orders"), offset=F.col("order_external_id").cast("bigint"),
                           load_dt=F.timestamp_add("MILLISECOND", F.col("order_date"),
                                                   F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")))


def order_items_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.order_items_rows(spark, sf_dir)
    return rows_to_decoded(rows, model().source("order_items"), offset=F.col("order_external_id").cast("bigint"),
                           load_dt=F.timestamp_add("MILLISECOND", F.col("shipped_ms"),
                                                   F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")))


def order_status_decoded(spark: SparkSession, sf_dir: str, lose_parents: bool = False) -> DataFrame:
    """Status history of orders; ``lose_parents`` takes the parent key from urgent (NULL) and low (empty) orders."""
    rows = M.orders_rows(spark, sf_dir).withColumn("number", F.col("order_external_id").cast("bigint"))
    if lose_parents:
        low = F.when(F.col("delivery_type") == "5-LOW", F.lit("")).otherwise(F.col("order_external_id"))
        rows = rows.withColumn("order_external_id", F.when(F.col("delivery_type") != "1-URGENT", low))
    rows = rows.select("number", "order_external_id", F.col("status").alias("new_status"), F.col("order_date").alias("changed_at"))
    return rows_to_decoded(rows, model().source("order_status_history"),
                           offset=F.col("number"),
                           load_dt=F.timestamp_add("MILLISECOND", F.col("changed_at"),
                                                   F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")))


def warehouses_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.warehouses_rows(spark, sf_dir)
    return rows_to_decoded(rows, model().source("warehouses"), offset=F.col("warehouse_code").cast("bigint"),
                           load_dt=_snapshot_ts())


def shipments_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.shipments_rows(spark, sf_dir)
    return rows_to_decoded(rows, model().source("shipments"), offset=F.col("order_external_id").cast("bigint"),
                           load_dt=F.timestamp_add("MILLISECOND", F.col("shipped_ms"),
                                                   F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")))


def user_addresses_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_to_decoded(M.user_addresses_rows(spark, sf_dir), model().source("user_addresses"),
                           offset=F.col("number"), load_dt=_snapshot_ts())


def pickup_points_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_to_decoded(M.pickup_points_rows(spark, sf_dir), model().source("pickup_points"),
                           offset=F.col("pickup_point_code").cast("bigint"), load_dt=_snapshot_ts())


def shipment_movements_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_to_decoded(M.shipment_movements_rows(spark, sf_dir), model().source("shipment_movements"),
                           offset=F.col("number"), load_dt=_snapshot_ts())


def shipment_status_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_to_decoded(M.shipment_status_rows(spark, sf_dir), model().source("shipment_status_history"),
                           offset=F.col("number"), load_dt=_snapshot_ts())


# topic name -> decoded feed builder, for model-driven loads
DECODED_FEEDS = {
    "users": users_decoded,
    "products": products_decoded,
    "orders": orders_decoded,
    "order_items": order_items_decoded,
    "order_status_history": order_status_decoded,
    "warehouses": warehouses_decoded,
    "shipments": shipments_decoded,
    "user_status_history": status_history_decoded,
    "user_addresses": user_addresses_decoded,
    "pickup_points": pickup_points_decoded,
    "shipment_movements": shipment_movements_decoded,
    "shipment_status_history": shipment_status_decoded,
}


# ---------------------------------------------------------------- JSON events

def users_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.users_rows(spark, sf_dir)
    return snapshot_to_events(rows, model().source("users"), offset=F.col("user_external_id").cast("bigint"),
                              timestamp=_snapshot_ts())


def user_changes_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """users topic events from ``events`` as JSON; 'error' events are deletes."""
    rows = M.status_change_rows(spark, sf_dir).withColumnRenamed("new_status", "status")
    rows = rows.select("event_id", "ts", "is_delete", "user_external_id", "status")
    return snapshot_to_events(rows, model().source("users"), offset=F.col("event_id"),
                              timestamp=F.col("ts"), deleted=F.col("is_delete"),
                              op=F.when(F.col("is_delete"), F.lit("d")).otherwise(F.lit("u")))


def orders_json(spark: SparkSession, sf_dir: str, wrap_status: str = "F") -> DataFrame:
    """orders topic; events of orders in status ``wrap_status`` come in a payload envelope."""
    rows = M.orders_rows(spark, sf_dir)
    return snapshot_to_events(rows, model().source("orders"), offset=F.col("order_external_id").cast("bigint"),
                              timestamp=F.timestamp_add("MILLISECOND", F.col("order_date"),
                                                        F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")),
                              wrapped=F.col("status") == wrap_status)


def products_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.products_rows(spark, sf_dir)
    return snapshot_to_events(rows, model().source("products"), offset=F.col("product_sku").cast("bigint"),
                              timestamp=_snapshot_ts())


def warehouses_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.warehouses_rows(spark, sf_dir)
    return snapshot_to_events(rows, model().source("warehouses"), offset=F.col("warehouse_code").cast("bigint"),
                              timestamp=_snapshot_ts())


def status_history_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_status_history topic from ``events`` as JSON ('error' events are deletes)."""
    rows = M.status_change_rows(spark, sf_dir).select(
        "event_id", "ts", "is_delete", "user_external_id", "new_status", "change_reason", "changed_at")
    return snapshot_to_events(rows, model().source("user_status_history"), offset=F.col("event_id"),
                              timestamp=F.col("ts"), deleted=F.col("is_delete"),
                              op=F.when(F.col("is_delete"), F.lit("d")).otherwise(F.lit("c")))
