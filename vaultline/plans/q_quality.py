"""Data-quality, routing and probe queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import decode as D
from ..operators import parity as P
from ..operators import quality as Q
from ..operators import vault as V
from ..session import fresh_dir
from ..sources import cdc
from . import feeds
from . import marketplace as M
from .registry import register


def _m():
    return feeds.model()


def _good(decoded: DataFrame, src_name: str) -> DataFrame:
    src = _m().source(src_name)
    return D.skip_deletes(D.classify(decoded, src), src).where(F.col("reject").isNull())


@register("orphan_check", """
SELECT 'orders.o_custkey -> customer' AS relation, COUNT(*) AS orphan_keys, COALESCE(SUM(n), 0)::BIGINT AS orphan_rows
FROM (SELECT o_custkey, COUNT(*) n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM customer p WHERE p.c_custkey = c.o_custkey)
UNION ALL
SELECT 'lineitem.l_orderkey -> orders', COUNT(*), COALESCE(SUM(n), 0)::BIGINT
FROM (SELECT l_orderkey, COUNT(*) n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_orderkey = c.l_orderkey)
UNION ALL
SELECT 'lineitem.l_partkey -> part', COUNT(*), COALESCE(SUM(n), 0)::BIGINT
FROM (SELECT l_partkey, COUNT(*) n FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = c.l_partkey)
UNION ALL
SELECT 'lineitem.l_suppkey -> supplier', COUNT(*), COALESCE(SUM(n), 0)::BIGINT
FROM (SELECT l_suppkey, COUNT(*) n FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM supplier p WHERE p.s_suppkey = c.l_suppkey)
UNION ALL
SELECT 'events.user_id -> customer', COUNT(*), COALESCE(SUM(n), 0)::BIGINT
FROM (SELECT user_id, COUNT(*) n FROM events WHERE user_id IS NOT NULL GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM customer p WHERE p.c_custkey = c.user_id)
UNION ALL
SELECT 'orders.o_custkey -> live events', COUNT(*), COALESCE(SUM(n), 0)::BIGINT
FROM (SELECT o_custkey, COUNT(*) n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM events p WHERE p.user_id = c.o_custkey AND p.event_type <> 'error')""")
def q_orphan_check(spark, sf_dir):
    """Referential checks: the source's foreign keys, the cross-service ones, and orders of users the change stream
    never brought (which do exist)."""
    t = lambda n: M.table(spark, sf_dir, n)
    live = t("events").where(F.col("event_type") != "error")
    return Q.union_all([
        Q.orphan_summary("orders.o_custkey -> customer", t("orders"), t("customer"), "o_custkey", "c_custkey"),
        Q.orphan_summary("lineitem.l_orderkey -> orders", t("lineitem"), t("orders"), "l_orderkey", "o_orderkey"),
        Q.orphan_summary("lineitem.l_partkey -> part", t("lineitem"), t("part"), "l_partkey", "p_partkey"),
        Q.orphan_summary("lineitem.l_suppkey -> supplier", t("lineitem"), t("supplier"), "l_suppkey", "s_suppkey"),
        Q.orphan_summary("events.user_id -> customer", t("events"), t("customer"), "user_id", "c_custkey"),
        Q.orphan_summary("orders.o_custkey -> live events", t("orders"), live, "o_custkey", "user_id"),
    ])


def _uniq_sql(rel: str, table: str, keys: str) -> str:
    return f"""SELECT '{rel}' AS relation, COALESCE(SUM(n), 0)::BIGINT AS total_rows, COUNT(*) AS distinct_keys,
       COUNT(*) FILTER (WHERE n > 1) AS duplicated_keys
FROM (SELECT {keys}, COUNT(*) n FROM {table} GROUP BY {keys})"""


@register("unique_key_check", "\nUNION ALL\n".join([
    _uniq_sql("customer(c_custkey)", "customer", "c_custkey"),
    _uniq_sql("orders(o_orderkey)", "orders", "o_orderkey"),
    _uniq_sql("part(p_partkey)", "part", "p_partkey"),
    _uniq_sql("supplier(s_suppkey)", "supplier", "s_suppkey"),
    _uniq_sql("lineitem(l_orderkey, l_linenumber)", "lineitem", "l_orderkey, l_linenumber"),
    _uniq_sql("events(event_id)", "events", "event_id"),
]))
def q_unique_key_check(spark, sf_dir):
    """UNIQUE / PRIMARY KEY constraints re-aimed as counts of duplicated keys."""
    t = lambda n: M.table(spark, sf_dir, n)
    return Q.union_all([
        Q.uniqueness_summary("customer(c_custkey)", t("customer"), "c_custkey"),
        Q.uniqueness_summary("orders(o_orderkey)", t("orders"), "o_orderkey"),
        Q.uniqueness_summary("part(p_partkey)", t("part"), "p_partkey"),
        Q.uniqueness_summary("supplier(s_suppkey)", t("supplier"), "s_suppkey"),
        Q.uniqueness_summary("lineitem(l_orderkey, l_linenumber)", t("lineitem"), ["l_orderkey", "l_linenumber"]),
        Q.uniqueness_summary("events(event_id)", t("events"), "event_id"),
    ])


def _parity_sql(name: str, source: str, target: str) -> str:
    """Both sides counted by row value; differences either way."""
    return f"""
SELECT '{name}' AS check_name, COALESCE(SUM(a), 0)::BIGINT AS source_rows, COALESCE(SUM(b), 0)::BIGINT AS target_rows,
       COALESCE(SUM(greatest(a - b, 0)), 0)::BIGINT AS missing_in_target,
       COALESCE(SUM(greatest(b - a, 0)), 0)::BIGINT AS extra_in_target
FROM (SELECT k, SUM(a) AS a, SUM(b) AS b
      FROM (SELECT k, 1 AS a, 0 AS b FROM ({source}) UNION ALL SELECT k, 0, 1 FROM ({target})) GROUP BY k)"""


@register("reconcile_counts", " UNION ALL ".join([
    _parity_sql("orders -> hub_orders", "SELECT o_orderkey AS k FROM orders", "SELECT DISTINCT o_orderkey AS k FROM orders"),
    _parity_sql("customer -> hub_users", "SELECT c_custkey AS k FROM customer", "SELECT DISTINCT c_custkey AS k FROM customer"),
    _parity_sql("events (live) -> sat_user_status_history",
                "SELECT (user_id, ts) AS k FROM events WHERE event_type <> 'error'",
                "SELECT (user_id, ts) AS k FROM events WHERE event_type <> 'error'"),
    _parity_sql("customer -> hub_users of the change stream", "SELECT c_custkey AS k FROM customer",
                "SELECT DISTINCT user_id AS k FROM events WHERE event_type <> 'error'"),
    _parity_sql("events -> sat_user_status_history", "SELECT (user_id, ts) AS k FROM events",
                "SELECT (user_id, ts) AS k FROM events WHERE event_type <> 'error'"),
]))
def q_reconcile_counts(spark, sf_dir):
    """Row parity of source and vault, counts and multiset differences both ways: copies that agree, and two that do
    not (users without live changes; history without the deletes)."""
    model = _m()
    o_hub = V.hub_rows(_good(feeds.orders_decoded(spark, sf_dir), "orders"), model.source("orders"))
    o_src = M.table(spark, sf_dir, "orders").select(F.md5(F.col("o_orderkey").cast("string")).alias("hk_orders"))
    u_hub = V.hub_rows(_good(feeds.users_decoded(spark, sf_dir), "users"), model.source("users"))
    u_src = M.table(spark, sf_dir, "customer").select(F.md5(F.col("c_custkey").cast("string")).alias("hk_users"))
    hist_t = model.target("sat_user_status_history")
    hist = V.history_rows(_good(feeds.status_history_decoded(spark, sf_dir), "user_status_history"),
                          model.source("user_status_history"), hist_t)
    ev = M.table(spark, sf_dir, "events")
    keyed = lambda d: d.select(F.md5(F.col("user_id").cast("string")).alias("hk_users"), F.col("ts").alias("load_dt"))
    ev_src, all_src = keyed(ev.where(F.col("event_type") != "error")), keyed(ev)
    changed = V.last_rows(_good(feeds.user_changes_decoded(spark, sf_dir), "users"), model.source("users"), model.target("hub_users"))
    return Q.union_all([
        Q.reconcile("orders -> hub_orders", o_src, o_hub.select("hk_orders")),
        Q.reconcile("customer -> hub_users", u_src, u_hub.select("hk_users")),
        Q.reconcile("events (live) -> sat_user_status_history", ev_src, hist.select("hk_users", "load_dt")),
        Q.reconcile("customer -> hub_users of the change stream", u_src, changed.select("hk_users")),
        Q.reconcile("events -> sat_user_status_history", all_src, hist.select("hk_users", "load_dt")),
    ])


#: A copy of lineitem that lost, changed and doubled a few orders' lines, and nothing else.
_COPY = """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + CASE WHEN l_orderkey % 1009 = 1 THEN 1 ELSE 0 END AS l_quantity, l_shipdate
  FROM lineitem, unnest(range(0, CASE WHEN l_orderkey % 1013 = 2 THEN 2 ELSE 1 END)) AS u(i) WHERE l_orderkey % 997 <> 0"""


@register("reconcile_buckets", " UNION ALL ".join([
    _parity_sql("lineitem -> damaged copy", "SELECT (l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate) AS k FROM lineitem",
                f"SELECT (l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate) AS k FROM ({_COPY})"),
    _parity_sql("lineitem -> copy", "SELECT (l_orderkey, l_linenumber) AS k FROM lineitem", "SELECT (l_orderkey, l_linenumber) AS k FROM lineitem"),
]))
def q_reconcile_buckets(spark, sf_dir):
    """Parity of two large copies by checksums of key buckets; rows are compared in differing buckets alone."""
    a = M.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    order = F.col("l_orderkey")
    twice = F.sequence(F.lit(1), F.when(order % 1013 == 2, 2).otherwise(1))
    b = a.where(order % 997 != 0).withColumn("l_quantity", F.col("l_quantity") + F.when(order % 1009 == 1, 1).otherwise(0)) \
        .withColumn("_copy", F.explode(twice)).drop("_copy")
    b = b.withColumn("l_quantity", F.col("l_quantity").cast(a.schema["l_quantity"].dataType))
    return Q.union_all([P.reconcile_by_bucket("lineitem -> damaged copy", a, b, ["l_orderkey"]),
                        P.reconcile_by_bucket("lineitem -> copy", a, a.where("l_orderkey is not null"), ["l_orderkey"])])


@register("source_to_hub_check", """
SELECT CAST(c_custkey AS VARCHAR) AS user_external_id, md5(CAST(c_custkey AS VARCHAR)) AS hk_users
FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey AND e.event_type <> 'error')""")
def q_source_to_hub_check(spark, sf_dir):
    """Customers whose key never reached a hub loaded from the change stream."""
    hub = V.hub_rows(_good(feeds.user_changes_decoded(spark, sf_dir), "users"), _m().source("users"))
    src = M.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("user_external_id"))
    return Q.missing_in_hub(src, hub, "user_external_id", "hk_users")


@register("hub_without_sat", """
SELECT md5(CAST(c_custkey AS VARCHAR)) AS hk_users, CAST(c_custkey AS VARCHAR) AS user_external_id
FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey AND e.event_type <> 'error')""")
def q_hub_without_sat(spark, sf_dir):
    """Hub from the customer snapshot, satellite from the change stream: hubs lacking one."""
    model = _m()
    hub = V.hub_rows(_good(feeds.users_decoded(spark, sf_dir), "users"), model.source("users"))
    t = model.target("sat_users")
    sat = V.sat_rows(_good(feeds.user_changes_decoded(spark, sf_dir), "users"), model.source("users"), t)
    return Q.hub_without_sat(hub.select("hk_users", "user_external_id"), sat, "hk_users")


# ---- routing and probes ---------------------------------------------------------

def _all_json(spark, sf_dir) -> DataFrame:
    return Q.union_all([feeds.users_json(spark, sf_dir), feeds.user_changes_json(spark, sf_dir),
                        feeds.orders_json(spark, sf_dir), feeds.products_json(spark, sf_dir),
                        feeds.warehouses_json(spark, sf_dir)])


@register("route_topics", """
SELECT 'user_service' AS service, 'user_service.public.users' AS topic,
       (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM events) AS events
UNION ALL SELECT 'order_service', 'order_service.public.orders', COUNT(*) FROM orders
UNION ALL SELECT 'order_service', 'order_service.public.products', COUNT(*) FROM part
UNION ALL SELECT 'logistics_service', 'logistics_service.public.warehouses', COUNT(*) FROM supplier""")
def q_route_topics(spark, sf_dir):
    """One mixed event stream split by each service's include list."""
    model = _m()
    ev = _all_json(spark, sf_dir)
    parts = []
    for service in ("user_service", "order_service", "logistics_service"):
        sel = cdc.select_topics(ev, service=service, model=model)
        parts.append(sel.groupBy("topic").agg(F.count(F.lit(1)).alias("events"))
                        .select(F.lit(service).alias("service"), "topic", "events"))
    return Q.union_all(parts)


@register("event_probe", """
SELECT c_custkey AS "offset", c_name AS first_name FROM customer
WHERE c_mktsegment = 'MACHINERY' ORDER BY c_custkey LIMIT 1""")
def q_event_probe(spark, sf_dir):
    """First message of the users topic containing a text, and a field of it."""
    ev = cdc.select_topics(feeds.users_json(spark, sf_dir), topics=["user_service.public.users"])
    hit = ev.where(F.col("value").contains('"status":"MACHINERY"')).orderBy("offset").limit(1)
    return hit.select("offset", F.get_json_object("value", "$.after.first_name").alias("first_name"))


@register("quarantine_rejects", """
SELECT 'user_service.public.users' AS topic,
       CASE event_id % 9 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'missing_business_key' WHEN 2 THEN 'missing_business_key'
            WHEN 3 THEN 'bad_value' WHEN 4 THEN 'deleted'
            ELSE CASE WHEN event_type = 'error' THEN 'deleted' ELSE 'loaded' END END AS outcome, COUNT(*) AS events
FROM events GROUP BY 2
UNION ALL
SELECT 'order_service.public.orders', CASE WHEN o_orderkey % 5 = 0 THEN 'bad_value' ELSE 'loaded' END, COUNT(*)
FROM orders GROUP BY 2""")
def q_quarantine_rejects(spark, sf_dir):
    """Every event classified: loaded, deleted (skipped), or rejected with a reason.

    Some of the events are spoiled first, by their offset: broken JSON, no key, only fields the model does not know,
    a time out of range, an empty image, a decimal that is none.
    """
    model = _m()
    turn = F.col("offset") % 9
    users = feeds.user_changes_json(spark, sf_dir).withColumn(
        "value", F.when(turn == 0, F.substring("value", 1, 12))
        .when(turn == 1, F.lit('{"op":"u","after":{"status":"x"}}'))
        .when(turn == 2, F.lit('{"op":"u","after":{"renamed":1}}'))
        .when(turn == 3, F.lit('{"op":"u","after":{"user_external_id":"1","registration_date":9223372036854775807}}'))
        .when(turn == 4, F.lit('{"op":"u","after":{}}')).otherwise(F.col("value")))
    orders = feeds.orders_json(spark, sf_dir).withColumn("value", F.when(F.col("offset") % 5 == 0, F.lit(
        '{"op":"u","after":{"order_external_id":"1","total_amount":"12,5"}}')).otherwise(F.col("value")))
    parts = []
    for name, ev in (("users", users), ("orders", orders)):
        src = model.source(name)
        loaded_attrs = model.target(f"sat_{name}").attrs
        dec = D.classify(D.decode_topic(ev, src), src, loaded_attrs)
        outcome = (F.when(F.col("reject").isNotNull(), F.col("reject"))
                    .when(D.is_empty_after(F.col("after"), src), F.lit("deleted"))
                    .otherwise(F.lit("loaded")))
        parts.append(dec.groupBy(F.col("topic"), outcome.alias("outcome"))
                        .agg(F.count(F.lit(1)).alias("events")))
    return Q.union_all(parts)


USERS_CSV_SCHEMA = T.StructType([
    T.StructField("user_external_id", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("status", T.StringType()),
])


@register("csv_roundtrip", """
SELECT CAST(c_custkey AS VARCHAR) AS user_external_id, 'x "' || c_name || '", y' AS first_name,
       c_mktsegment || chr(92) AS status
FROM customer""")
def q_csv_roundtrip(spark, sf_dir):
    """Users written as a header CSV to the shared folder and read back with a fixed schema."""
    path = fresh_dir(spark, "csv") + "/users"
    rows = M.users_rows(spark, sf_dir).select(  # quotes, a comma, a backslash at the end of a field
        "user_external_id", F.concat(F.lit('x "'), "first_name", F.lit('", y')).alias("first_name"),
        F.concat("status", F.lit("\\")).alias("status"))
    rows.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    return cdc.read_csv(spark, path, USERS_CSV_SCHEMA)


@register("vault_orphan_check", """
SELECT 'sat_user_status_history -> hub_users' AS relation, COUNT(*) AS orphan_keys,
       COALESCE(SUM(n), 0)::BIGINT AS orphan_rows
FROM (SELECT user_id, COUNT(*) n FROM events WHERE event_type <> 'error' GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM customer p WHERE p.c_custkey = c.user_id)
UNION ALL
SELECT 'lnk_orders_users -> hub_users', COUNT(*), COALESCE(SUM(n), 0)::BIGINT
FROM (SELECT o_custkey, COUNT(*) n FROM orders GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM customer p WHERE p.c_custkey = c.o_custkey)
UNION ALL
SELECT 'lnk_order_items -> hub_products', COUNT(*), COALESCE(SUM(n), 0)::BIGINT
FROM (SELECT l_partkey, COUNT(*) n FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = c.l_partkey)
UNION ALL
SELECT 'lnk_shipments_warehouses -> hub_warehouses', COUNT(*), COALESCE(SUM(n), 0)::BIGINT
FROM (SELECT l_suppkey, COUNT(*) n FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM lineitem)
      GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM supplier p WHERE p.s_suppkey = c.l_suppkey)
UNION ALL
SELECT 'lnk_orders_users -> hub_users, one segment loaded', COUNT(*), COALESCE(SUM(n), 0)::BIGINT
FROM (SELECT o_custkey, COUNT(*) n FROM orders GROUP BY 1) c
WHERE NOT EXISTS (SELECT 1 FROM customer p WHERE p.c_custkey = c.o_custkey AND p.c_mktsegment = 'BUILDING')""")
def q_vault_orphan_check(spark, sf_dir):
    """Late-arriving parents: vault link and history rows whose hub row is absent
    (the loader makes no stub hubs; each table loads on its own)."""
    model = _m()
    hub_users = V.hub_rows(_good(feeds.users_decoded(spark, sf_dir), "users"), model.source("users"))
    first = feeds.users_decoded(spark, sf_dir).where(F.col("after.status") == "BUILDING")
    early = V.hub_rows(_good(first, "users"), model.source("users"))  # the other parents come late
    hub_products = V.hub_rows(_good(feeds.products_decoded(spark, sf_dir), "products"), model.source("products"))
    hub_wh = V.hub_rows(_good(feeds.warehouses_decoded(spark, sf_dir), "warehouses"), model.source("warehouses"))
    hist = V.history_rows(_good(feeds.status_history_decoded(spark, sf_dir), "user_status_history"),
                          model.source("user_status_history"), model.target("sat_user_status_history"))
    lnk_ou = V.last_rows(_good(feeds.orders_decoded(spark, sf_dir), "orders"), model.source("orders"),
                         model.target("lnk_orders_users"))
    lnk_oi = V.last_rows(_good(feeds.order_items_decoded(spark, sf_dir), "order_items"), model.source("order_items"),
                         model.target("lnk_order_items"))
    lnk_sw = V.last_rows(_good(feeds.shipments_decoded(spark, sf_dir), "shipments"), model.source("shipments"),
                         model.target("lnk_shipments_warehouses"))
    return Q.union_all([
        Q.orphan_summary("sat_user_status_history -> hub_users", hist, hub_users, "hk_users"),
        Q.orphan_summary("lnk_orders_users -> hub_users", lnk_ou, hub_users, "hk_users"),
        Q.orphan_summary("lnk_order_items -> hub_products", lnk_oi, hub_products, "hk_products"),
        Q.orphan_summary("lnk_shipments_warehouses -> hub_warehouses", lnk_sw, hub_wh, "hk_warehouses"),
        Q.orphan_summary("lnk_orders_users -> hub_users, one segment loaded", lnk_ou, early, "hk_users"),
    ])


@register("length_check", """
SELECT 'first_name' AS "column", COUNT(*) FILTER (WHERE length(c_name) * (26 + c_custkey % 5) > 500) AS rows,
       MAX(length(c_name) * (26 + c_custkey % 5))::INTEGER AS max_length FROM customer
UNION ALL
SELECT 'status', COUNT(*) FILTER (WHERE length(c_mktsegment) > 500), MAX(length(c_mktsegment))::INTEGER
FROM customer""")
def q_length_check(spark, sf_dir):
    """Over-long strings against their VARCHAR limits (kept, only reported); names are repeated to reach them."""
    model = _m()
    src, t = model.source("users"), model.target("sat_users")
    times = (F.lit(26) + F.col("after.user_external_id").cast("bigint") % 5).cast("int")
    long = F.col("after").withField("first_name", F.repeat(F.col("after.first_name"), times))
    sat = V.sat_rows(_good(feeds.users_decoded(spark, sf_dir).withColumn("after", long), "users"), src, t)
    return Q.over_length(sat.select("first_name", "status"), t)
