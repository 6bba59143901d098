"""Vault load queries over the driver tables (hashes, projections, keyed upserts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import coerce_compat, coerce_typed
from ..functions.dates import epoch_days, epoch_millis
from ..functions.hashing import hash_diff, hub_hash, link_hash
from ..operators import decode as D
from ..operators import vault as V
from . import feeds
from . import marketplace as M
from .registry import register
from ..session import fresh_dir
from ..sinks.store import VaultStore
from ..streaming.loader import load_sources
from .sqltext import json_str_sql, md5_json_sql

U = "'user_service.public.users'"
O = "'order_service.public.orders'"


def _m():
    return feeds.model()


def _good(decoded: DataFrame, src_name: str) -> DataFrame:
    src = _m().source(src_name)
    return D.skip_deletes(D.classify(decoded, src), src).where(F.col("reject").isNull())


def _drop_order(df: DataFrame) -> DataFrame:
    return df.drop(V.ORDER)


def _money_double(df: DataFrame) -> DataFrame:
    for f in df.schema.fields:
        if f.dataType.typeName() == "decimal":
            df = df.withColumn(f.name, F.col(f.name).cast("double"))
    return df


# ---- SQL pieces for the oracles -------------------------------------------------

_USERS_SAT_FROM_EVENTS_HASH = md5_json_sql([
    ("date_of_birth", "NULL"), ("email", "NULL"), ("first_name", "NULL"), ("last_name", "NULL"),
    ("phone", "NULL"), ("registration_date", "NULL"), ("status", json_str_sql("event_type"))])

_USERS_SAT_FROM_CUSTOMER_HASH = md5_json_sql([
    ("date_of_birth", "NULL"), ("email", "NULL"), ("first_name", json_str_sql("c_name")),
    ("last_name", "NULL"), ("phone", "NULL"), ("registration_date", "NULL"),
    ("status", json_str_sql("c_mktsegment"))])

_ORDERS_SAT_HASH = md5_json_sql([
    ("order_number", json_str_sql("'ORD-' || CAST(o_orderkey AS VARCHAR)")),
    ("order_date", "CAST(epoch_ms(o_orderdate) AS VARCHAR)"),
    ("status", json_str_sql("o_orderstatus")),
    ("subtotal", "NULL"), ("tax_amount", "NULL"), ("shipping_cost", "NULL"), ("discount_amount", "NULL"),
    ("total_amount", json_str_sql("CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)")),
    ("currency", "NULL"), ("delivery_type", json_str_sql("o_orderpriority")),
    ("payment_method", "NULL"), ("payment_status", "NULL")])

_HISTORY_HASH = md5_json_sql([
    ("old_status", "NULL"), ("new_status", json_str_sql("event_type")),
    ("change_reason", json_str_sql("props")), ("changed_at", "CAST((epoch_us(ts) // 1000) AS VARCHAR)"),
    ("changed_by", "NULL"), ("session_id", "NULL"), ("ip_address", "NULL"), ("user_agent", "NULL")])

_ITEMS_SAT_HASH = md5_json_sql([
    ("quantity", "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"), ("unit_price", "NULL"),
    ("total_price", json_str_sql("CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)")),
    ("product_name_snapshot", "NULL"), ("product_category_snapshot", "NULL"),
    ("product_brand_snapshot", "NULL")])

_HK_U_EVENTS = "md5(CAST(user_id AS VARCHAR))"


# ---- hashes ---------------------------------------------------------------------

@register("hub_hash", "SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR)) AS hk_users FROM customer")
def q_hub_hash(spark, sf_dir):
    c = M.table(spark, sf_dir, "customer")
    return c.select("c_custkey", hub_hash("c_custkey").alias("hk_users"))


@register("link_hash", """
SELECT o_orderkey, o_custkey, md5(CAST(o_orderkey AS VARCHAR)) AS hk_orders,
       md5(CAST(o_custkey AS VARCHAR)) AS hk_users,
       md5(md5(CAST(o_orderkey AS VARCHAR)) || md5(CAST(o_custkey AS VARCHAR))) AS hk_lnk_orders_users
FROM orders""")
def q_link_hash(spark, sf_dir):
    o = M.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ho, hu = hub_hash("o_orderkey"), hub_hash("o_custkey")
    return o.select("o_orderkey", "o_custkey", ho.alias("hk_orders"), hu.alias("hk_users"),
                    link_hash(ho, hu).alias("hk_lnk_orders_users"))


@register("hash_diff", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_external_id, {_ORDERS_SAT_HASH} AS hash_diff FROM orders""")
def q_hash_diff(spark, sf_dir):
    rows = M.orders_rows(spark, sf_dir)
    attrs = _m().target("sat_orders").attrs
    have = set(rows.columns)
    vals = [(a.name, F.col(a.name) if a.name in have else F.lit(None), a.wire_kind) for a in attrs]
    return rows.select("order_external_id", hash_diff(vals).alias("hash_diff"))


# ---- coercion -------------------------------------------------------------------

@register("coerce_typed", """
SELECT o_orderkey,
       CAST(epoch_ms(epoch_ms(o_orderdate)) AS TIMESTAMP) AS order_date,
       CAST(o_orderdate AS DATE)::TIMESTAMP AS order_day,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount
FROM orders""")
def q_coerce_typed(spark, sf_dir):
    o = M.table(spark, sf_dir, "orders")
    wire = o.select("o_orderkey", epoch_millis("o_orderdate").alias("ms"),
                    epoch_days("o_orderdate").alias("days"),
                    F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount"))
    return wire.select(
        "o_orderkey",
        coerce_typed("ms", "timestamp").alias("order_date"),
        coerce_typed("days", "date").cast("timestamp_ntz").alias("order_day"),
        coerce_typed("amount", "decimal").cast("double").alias("total_amount"))


@register("coerce_compat", """
SELECT event_id,
       make_timestamp((epoch_us(ts) // 1000)) AS changed_at,
       CAST(CAST(make_timestamp((epoch_us(ts) // 1000)) AS DATE) AS TIMESTAMP) AS registration_day,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS birth_day
FROM events""")
def q_coerce_compat(spark, sf_dir):
    """The reference loader's guess: event-time millis read as microseconds (2024
    lands in January 1970); a small int in a date-named column read as days."""
    e = M.table(spark, sf_dir, "events").select(
        "event_id", epoch_millis("ts").alias("ms"), epoch_days("ts").alias("days"))
    return e.select("event_id",
                    coerce_compat("ms", "changed_at", "timestamp").alias("changed_at"),
                    coerce_compat("ms", "registration_date", "date").cast("timestamp_ntz").alias("registration_day"),
                    coerce_compat("days", "date_of_birth", "date").cast("timestamp_ntz").alias("birth_day"))


# ---- envelope / decode ----------------------------------------------------------

@register("envelope_unwrap", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_external_id, CAST(o_custkey AS VARCHAR) AS user_external_id,
       CAST(make_timestamp(epoch_ms(o_orderdate) * 1000) AS TIMESTAMP) AS order_date,
       o_orderstatus AS status, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
       'r' AS op
FROM orders""")
def q_envelope_unwrap(spark, sf_dir):
    """Orders events, those of finished orders wrapped in a payload envelope, decoded."""
    src = _m().source("orders")
    dec = D.decode_topic(feeds.orders_json(spark, sf_dir), src)
    return dec.select(
        F.col("after.order_external_id").alias("order_external_id"),
        F.col("after.user_external_id").alias("user_external_id"),
        coerce_typed(F.col("after.order_date"), "timestamp").alias("order_date"),
        F.col("after.status").alias("status"),
        coerce_typed(F.col("after.total_amount"), "decimal").cast("double").alias("total_amount"),
        F.col("op"))


@register("snapshot_events", """
SELECT 'user_service.public.users' AS topic, c_custkey AS "offset", 'r' AS op,
       CAST(json_object('op', 'r', 'before', NULL, 'after',
            json_object('user_external_id', CAST(c_custkey AS VARCHAR), 'first_name', c_name,
                        'status', c_mktsegment)) AS VARCHAR) AS value
FROM customer""")
def q_snapshot_events(spark, sf_dir):
    ev = feeds.users_json(spark, sf_dir)
    return ev.select("topic", "offset", F.get_json_object("value", "$.op").alias("op"), "value")


@register("skip_deletes", f"""
SELECT event_id, CAST(user_id AS VARCHAR) AS user_external_id, event_type AS status
FROM events WHERE event_type <> 'error'""")
def q_skip_deletes(spark, sf_dir):
    src = _m().source("users")
    dec = D.skip_deletes(feeds.user_changes_decoded(spark, sf_dir), src)
    return dec.select(F.col("offset").alias("event_id"), F.col("after.user_external_id").alias("user_external_id"),
                      F.col("after.status").alias("status"))


@register("drop_technical", """
SELECT CAST(c_custkey AS VARCHAR) AS user_external_id, c_name AS first_name, c_mktsegment AS status
FROM customer""")
def q_drop_technical(spark, sf_dir):
    rows = M.users_rows(spark, sf_dir)
    with_tech = rows.select(
        "*", F.expr(feeds.SNAPSHOT_AT).alias("effective_from"),
        F.expr("TIMESTAMP_NTZ'9999-12-31 23:59:59'").alias("effective_to"), F.lit(True).alias("is_current"),
        F.expr(feeds.SNAPSHOT_AT).alias("created_at"), F.expr(feeds.SNAPSHOT_AT).alias("updated_at"),
        F.lit("loader").alias("created_by"), F.lit("loader").alias("updated_by"))
    return V.drop_technical(with_tech)


# ---- keyed loads ----------------------------------------------------------------

@register("hub_upsert", f"""
SELECT {_HK_U_EVENTS} AS hk_users, CAST(user_id AS VARCHAR) AS user_external_id,
       MAX(ts) AS load_dt, {U} AS record_source, MIN(ts) AS first_load_dt
FROM events WHERE event_type <> 'error' GROUP BY user_id""")
def q_hub_upsert(spark, sf_dir):
    """Hub on the users topic fed by every status change: the last load wins,
    load_dt included (deletes leave the hub as it is); first_load_dt keeps the first."""
    src = _m().source("users")
    good = _good(feeds.user_changes_decoded(spark, sf_dir), "users")
    return V.last_rows(good, src, _m().target("hub_users"))


@register("sat_upsert", f"""
SELECT {_HK_U_EVENTS} AS hk_users, {_USERS_SAT_FROM_EVENTS_HASH} AS hash_diff, MAX(ts) AS load_dt,
       {U} AS record_source, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS first_name,
       CAST(NULL AS VARCHAR) AS last_name, CAST(NULL AS VARCHAR) AS phone,
       CAST(NULL AS TIMESTAMP) AS date_of_birth, CAST(NULL AS TIMESTAMP) AS registration_date,
       event_type AS status
FROM events WHERE event_type <> 'error' GROUP BY user_id, event_type""")
def q_sat_upsert(spark, sf_dir):
    """Satellite UNIQUE(hk, hash_diff): A -> B -> A keeps two rows, A with the newest load_dt."""
    src = _m().source("users")
    t = _m().target("sat_users")
    good = _good(feeds.user_changes_decoded(spark, sf_dir), "users")
    out = V.last_rows(good, src, t)
    return out.withColumn("date_of_birth", F.col("date_of_birth").cast("timestamp_ntz"))


@register("link_upsert", f"""
SELECT md5(md5(CAST(o_orderkey AS VARCHAR)) || md5(CAST(o_custkey AS VARCHAR))) AS hk_lnk_orders_users,
       md5(CAST(o_orderkey AS VARCHAR)) AS hk_orders, md5(CAST(o_custkey AS VARCHAR)) AS hk_users,
       MAX(make_timestamp(epoch_ms(o_orderdate) * 1000)) AS load_dt, {O} AS record_source
FROM orders GROUP BY o_orderkey, o_custkey""")
def q_link_upsert(spark, sf_dir):
    src = _m().source("orders")
    t = _m().target("lnk_orders_users")
    good = _good(feeds.orders_decoded(spark, sf_dir), "orders")
    return V.last_rows(good, src, t)


@register("history_append", f"""
SELECT {_HK_U_EVENTS} AS hk_users, ts AS load_dt, {_HISTORY_HASH} AS hash_diff,
       'user_service.public.user_status_history' AS record_source,
       CAST(NULL AS VARCHAR) AS old_status, event_type AS new_status, props AS change_reason,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS changed_at, CAST(NULL AS VARCHAR) AS changed_by,
       CAST(NULL AS VARCHAR) AS session_id, CAST(NULL AS VARCHAR) AS ip_address,
       CAST(NULL AS VARCHAR) AS user_agent
FROM events WHERE event_type <> 'error'""")
def q_history_append(spark, sf_dir):
    """History satellite: every event is a row (DUPLICATE KEY), no dedup."""
    src = _m().source("user_status_history")
    t = _m().target("sat_user_status_history")
    good = _good(feeds.status_history_decoded(spark, sf_dir), "user_status_history")
    return _drop_order(V.history_rows(good, src, t))


@register("history_skip_null", """
SELECT md5(CAST(o_orderkey AS VARCHAR)) AS hk_orders, o_orderstatus AS new_status,
       make_timestamp(epoch_ms(o_orderdate) * 1000) AS changed_at
FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')""")
def q_history_skip_null(spark, sf_dir):
    """Order status history; rows whose parent key is NULL (urgent orders here) or empty (low ones) are skipped."""
    src = _m().source("order_status_history")
    t = _m().target("sat_order_status_history")
    good = _good(feeds.order_status_decoded(spark, sf_dir, lose_parents=True), "order_status_history")
    return V.history_rows(good, src, t).select("hk_orders", "new_status", "changed_at")


@register("link_skip_null", """
SELECT md5(md5(l_orderkey || '-' || l_linenumber) || md5(CAST(l_suppkey AS VARCHAR))) AS hk_lnk_shipments_pickup_points,
       md5(l_orderkey || '-' || l_linenumber) AS hk_shipments, md5(CAST(l_suppkey AS VARCHAR)) AS hk_pickup_points,
       MAX(make_timestamp(epoch_ms(l_shipdate) * 1000)) AS load_dt,
       'logistics_service.public.shipments' AS record_source
FROM lineitem WHERE l_returnflag = 'R'
GROUP BY l_orderkey, l_linenumber, l_suppkey""")
def q_link_skip_null(spark, sf_dir):
    """Pickup-point links: NULL and empty pickup codes are skipped."""
    src = _m().source("shipments")
    t = _m().target("lnk_shipments_pickup_points")
    good = _good(feeds.shipments_decoded(spark, sf_dir), "shipments")
    return V.last_rows(good, src, t)


@register("linksat_load", f"""
SELECT md5(md5(CAST(l_orderkey AS VARCHAR)) || md5(CAST(l_partkey AS VARCHAR))) AS hk_lnk_order_items,
       {_ITEMS_SAT_HASH} AS hash_diff,
       MAX(make_timestamp(epoch_ms(l_shipdate) * 1000)) AS load_dt,
       'order_service.public.order_items' AS record_source,
       CAST(l_quantity AS INTEGER) AS quantity, CAST(NULL AS DOUBLE) AS unit_price,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS total_price,
       CAST(NULL AS VARCHAR) AS product_name_snapshot, CAST(NULL AS VARCHAR) AS product_category_snapshot,
       CAST(NULL AS VARCHAR) AS product_brand_snapshot
FROM lineitem
GROUP BY l_orderkey, l_partkey, CAST(l_quantity AS INTEGER), CAST(l_extendedprice AS DECIMAL(18,2)),
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)""")
def q_linksat_load(spark, sf_dir):
    """Order lines as a satellite on the order-product link, UNIQUE(link key, hash_diff)."""
    src = _m().source("order_items")
    t = _m().target("sat_order_items")
    good = _good(feeds.order_items_decoded(spark, sf_dir), "order_items")
    return _money_double(V.last_rows(good, src, t))


@register("latest_sat_rows", f"""
SELECT * FROM (
  SELECT {_HK_U_EVENTS} AS hk_users, {_USERS_SAT_FROM_EVENTS_HASH} AS hash_diff, MAX(ts) AS load_dt,
         event_type AS status
  FROM events WHERE event_type <> 'error' GROUP BY user_id, event_type)
ORDER BY load_dt DESC, hk_users, hash_diff LIMIT 5""")
def q_latest_sat_rows(spark, sf_dir):
    src = _m().source("users")
    t = _m().target("sat_users")
    good = _good(feeds.user_changes_decoded(spark, sf_dir), "users")
    sat = V.last_rows(good, src, t)
    return V.latest_rows(sat.select("hk_users", "hash_diff", "load_dt", "status"), 5,
                         tie_break=("hk_users", "hash_diff"))


@register("hub_lookup", """
SELECT md5(CAST(c_custkey AS VARCHAR)) AS hk_users, CAST(c_custkey AS VARCHAR) AS user_external_id
FROM customer WHERE CAST(c_custkey AS VARCHAR) = '42'""")
def q_hub_lookup(spark, sf_dir):
    """Equality lookup by business key: the filter is on the key itself and reaches the scan; only the hit is hashed."""
    src = _m().source("users")
    found = feeds.users_decoded(spark, sf_dir, key=42)
    return V.hub_rows(_good(found, "users"), src).select("hk_users", "user_external_id")


def _loaded(spark, decoded: dict[str, DataFrame]) -> DataFrame:
    """(vault_table, kind, row_count): the sources loaded into a new vault, and what the load reports."""
    model = _m()
    store = VaultStore(spark, f"{fresh_dir(spark, 'load')}/vault", model)
    load_sources(decoded, 0, model, store, reread=True)  # the feeds read Parquet files
    kinds = F.create_map(*[F.lit(x) for t in model.targets.values() for x in (t.name, t.kind)])
    return spark.read.parquet(f"{store.root}/_metrics").withColumn("kind", kinds[F.col("vault_table")]) \
        .where(F.col("kind").isNotNull()).select("vault_table", "kind", F.col("rows").alias("row_count"))


# ---- fan-out and model-driven load ---------------------------------------------

@register("topic_fanout", """
SELECT 'hub_orders' AS vault_table, COUNT(DISTINCT o_orderkey) AS row_count FROM orders
UNION ALL SELECT 'lnk_orders_users', COUNT(DISTINCT (o_orderkey, o_custkey)) FROM orders
UNION ALL SELECT 'lnk_orders_user_addresses', 0
UNION ALL SELECT 'sat_orders', COUNT(*) FROM (SELECT DISTINCT o_orderkey, o_orderdate, o_orderstatus,
          CAST(o_totalprice AS DECIMAL(18,2)), o_orderpriority FROM orders)""")
def q_topic_fanout(spark, sf_dir):
    """One orders event -> hub, two links (the address link skips: no address key), satellite: rows written to each."""
    return _loaded(spark, {"orders": feeds.orders_decoded(spark, sf_dir)}).drop("kind")


_MODEL_COUNTS = """
SELECT vault_table, kind, row_count FROM (
  SELECT 'hub_users' AS vault_table, 'hub' AS kind, COUNT(DISTINCT c_custkey) AS row_count FROM customer
  UNION ALL SELECT 'sat_users', 'sat', COUNT(*) FROM (SELECT DISTINCT c_custkey, c_name, c_mktsegment FROM customer)
  UNION ALL SELECT 'hub_products', 'hub', COUNT(DISTINCT p_partkey) FROM part
  UNION ALL SELECT 'sat_products', 'sat', COUNT(*) FROM (SELECT DISTINCT p_partkey, p_name, p_type, p_brand,
            CAST(p_retailprice AS DECIMAL(18,2)), p_size FROM part)
  UNION ALL SELECT 'hub_orders', 'hub', COUNT(DISTINCT o_orderkey) FROM orders
  UNION ALL SELECT 'lnk_orders_users', 'link', COUNT(DISTINCT (o_orderkey, o_custkey)) FROM orders
  UNION ALL SELECT 'lnk_orders_user_addresses', 'link', 0
  UNION ALL SELECT 'sat_orders', 'sat', COUNT(*) FROM (SELECT DISTINCT o_orderkey, o_orderdate, o_orderstatus,
            CAST(o_totalprice AS DECIMAL(18,2)), o_orderpriority FROM orders)
  UNION ALL SELECT 'lnk_order_items', 'link', COUNT(DISTINCT (l_orderkey, l_partkey)) FROM lineitem
  UNION ALL SELECT 'sat_order_items', 'sat', COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_partkey,
            CAST(l_quantity AS BIGINT), CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem)
  UNION ALL SELECT 'sat_order_status_history', 'history', COUNT(*) FROM orders
  UNION ALL SELECT 'hub_warehouses', 'hub', COUNT(DISTINCT s_suppkey) FROM supplier
  UNION ALL SELECT 'sat_warehouses', 'sat', COUNT(*) FROM (SELECT DISTINCT s_suppkey, s_name FROM supplier)
  UNION ALL SELECT 'hub_shipments', 'hub', COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
  UNION ALL SELECT 'lnk_shipments_orders', 'link', COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
  UNION ALL SELECT 'lnk_shipments_warehouses', 'link', COUNT(DISTINCT (l_orderkey, l_linenumber, l_suppkey)) FROM lineitem
  UNION ALL SELECT 'lnk_shipments_pickup_points', 'link',
            COUNT(DISTINCT (l_orderkey, l_linenumber, l_suppkey)) FILTER (WHERE l_returnflag = 'R') FROM lineitem
  UNION ALL SELECT 'sat_shipments', 'sat', COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_linestatus,
            CAST(l_quantity AS BIGINT) FROM lineitem)
  UNION ALL SELECT 'sat_user_status_history', 'history', COUNT(*) FILTER (WHERE event_type <> 'error') FROM events
  UNION ALL SELECT 'hub_user_addresses', 'hub', COUNT(DISTINCT c_custkey) FROM customer
  UNION ALL SELECT 'lnk_user_addresses_users', 'link', COUNT(DISTINCT c_custkey) FROM customer
  UNION ALL SELECT 'sat_user_addresses', 'sat', COUNT(*) FROM (
            SELECT DISTINCT c_custkey, n_name, c_acctbal > 0 FROM customer JOIN nation ON n_nationkey = c_nationkey)
  UNION ALL SELECT 'hub_pickup_points', 'hub', COUNT(DISTINCT s_suppkey) FROM supplier
  UNION ALL SELECT 'sat_pickup_points', 'sat', COUNT(*) FROM (
            SELECT DISTINCT s_suppkey, s_name, n_name, s_acctbal > 0 FROM supplier JOIN nation ON n_nationkey = s_nationkey)
  UNION ALL SELECT 'sat_shipment_movements', 'history', COUNT(*) FROM lineitem WHERE l_returnflag <> 'N'
  UNION ALL SELECT 'sat_shipment_status_history', 'history', COUNT(*) FROM lineitem
)"""


@register("model_driven_load", _MODEL_COUNTS)
def q_model_driven_load(spark, sf_dir):
    """Every topic through the loader, classified by the model alone: rows written to each of the 26 loaded tables."""
    return _loaded(spark, {name: feed(spark, sf_dir) for name, feed in feeds.DECODED_FEEDS.items()})


# ---- conform, insert-ignore -----------------------------------------------------

@register("conform_schema", """
SELECT md5(CAST(o_orderkey AS VARCHAR)) AS hk_orders,
       make_timestamp(epoch_ms(o_orderdate) * 1000) AS load_dt,
       'order_service.public.orders' AS record_source,
       'ORD-' || CAST(o_orderkey AS VARCHAR) AS order_number,
       make_timestamp(epoch_ms(o_orderdate) * 1000) AS order_date, o_orderstatus AS status,
       CAST(NULL AS DOUBLE) AS subtotal, CAST(NULL AS DOUBLE) AS tax_amount,
       CAST(NULL AS DOUBLE) AS shipping_cost, CAST(NULL AS DOUBLE) AS discount_amount,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
       CAST(NULL AS VARCHAR) AS currency, o_orderpriority AS delivery_type,
       CAST(NULL AS TIMESTAMP) AS expected_delivery_date, CAST(NULL AS TIMESTAMP) AS actual_delivery_date,
       CAST(NULL AS VARCHAR) AS payment_method, CAST(NULL AS VARCHAR) AS payment_status
FROM orders""")
def q_conform_schema(spark, sf_dir):
    """Satellite rows conformed to the full target (never-loaded columns as NULL)."""
    src = _m().source("orders")
    t = _m().target("sat_orders")
    good = _good(feeds.orders_decoded(spark, sf_dir), "orders")
    rows = V.sat_rows(good, src, t).drop("hash_diff")
    out = V.conform(rows, t).drop("hash_diff")
    for c in ("expected_delivery_date", "actual_delivery_date"):
        out = out.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return _money_double(out)


@register("insert_absent", f"""
WITH target AS (
  SELECT {_HK_U_EVENTS} AS hk_users, CAST(user_id AS VARCHAR) AS user_external_id,
         MAX(ts) AS load_dt, {U} AS record_source, MIN(ts) AS first_load_dt
  FROM events WHERE event_type <> 'error' GROUP BY user_id),
incoming AS (
  SELECT md5(CAST(c_custkey AS VARCHAR)) AS hk_users, CAST(c_custkey AS VARCHAR) AS user_external_id,
         TIMESTAMP '2024-02-01 00:00:00' AS load_dt, {U} AS record_source,
         TIMESTAMP '2024-02-01 00:00:00' AS first_load_dt FROM customer)
SELECT * FROM target
UNION ALL
SELECT * FROM incoming i WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.hk_users = i.hk_users)""")
def q_insert_absent(spark, sf_dir):
    """INSERT ... ON CONFLICT DO NOTHING: the customer snapshot into a hub loaded from events."""
    from ..operators.quality import insert_absent
    src = _m().source("users")
    target = V.last_rows(_good(feeds.user_changes_decoded(spark, sf_dir), "users"), src, _m().target("hub_users"))
    incoming = _drop_order(V.hub_rows(_good(feeds.users_decoded(spark, sf_dir), "users"), src))
    return insert_absent(incoming, target, ["hk_users"])
