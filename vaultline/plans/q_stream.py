"""Streaming-load queries: events written as files, loaded by Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.decode import record_time_utc
from ..session import fresh_dir
from ..sinks.store import VaultStore
from ..sources.cdc import read_cdc_batch
from ..sources.snapshot import ChunkedSnapshot, at_offset, chunk_bounds, merged_rows
from ..streaming.late_parents import follow, missing_parents
from ..streaming.loader import load_batch, load_sources, run_available
from . import feeds
from . import marketplace as M
from .registry import register

# Arrival boundary used to split the change stream into two deliveries.
SPLIT_AT = "2024-01-15 00:00:00"
# Kafka record time of an event (milliseconds), in DuckDB
TS_MS = "make_timestamp((epoch_us(ts) // 1000) * 1000)"


def _setup(spark, name: str):
    root = fresh_dir(spark, name)
    store = VaultStore(spark, f"{root}/vault", feeds.model())
    return root, store


def _deliver(events: DataFrame, folder: str) -> None:
    """One delivery: new event files appended to the folder the stream watches."""
    events.write.mode("append").json(folder)


def _before(ev: DataFrame) -> DataFrame:
    return ev.where(record_time_utc(F.col("timestamp")) < F.lit(SPLIT_AT).cast("timestamp_ntz"))


def _after(ev: DataFrame) -> DataFrame:
    return ev.where(record_time_utc(F.col("timestamp")) >= F.lit(SPLIT_AT).cast("timestamp_ntz"))


_SAT_USERS_BOTH = """
SELECT hk_users, hash_diff, MAX(load_dt) AS load_dt, 'user_service.public.users' AS record_source,
       CAST(NULL AS VARCHAR) AS email, first_name, CAST(NULL AS VARCHAR) AS last_name,
       CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS TIMESTAMP) AS date_of_birth,
       CAST(NULL AS TIMESTAMP) AS registration_date, status
FROM (
  SELECT md5(CAST(c_custkey AS VARCHAR)) AS hk_users,
         md5('{"date_of_birth": null, "email": null, "first_name": "' || c_name || '", "last_name": null, '
             || '"phone": null, "registration_date": null, "status": "' || c_mktsegment || '"}') AS hash_diff,
         TIMESTAMP '2024-02-01 00:00:00' AS load_dt, c_name AS first_name, c_mktsegment AS status
  FROM customer
  UNION ALL
  SELECT md5(CAST(user_id AS VARCHAR)),
         md5('{"date_of_birth": null, "email": null, "first_name": null, "last_name": null, '
             || '"phone": null, "registration_date": null, "status": "' || event_type || '"}'),
         make_timestamp((epoch_us(ts) // 1000) * 1000), NULL, event_type
  FROM events WHERE event_type <> 'error')
GROUP BY hk_users, hash_diff, first_name, status"""


@register("cdc_stream_ingest", _SAT_USERS_BOTH)
def q_cdc_stream_ingest(spark, sf_dir):
    """Snapshot + change events of users and orders as files -> stream -> vault; sat_users."""
    root, store = _setup(spark, "ingest")
    ev = Q.union_all([feeds.users_json(spark, sf_dir), feeds.user_changes_json(spark, sf_dir),
                      feeds.orders_json(spark, sf_dir)])
    _deliver(ev, f"{root}/events")
    run_available(spark, store.model, store, f"{root}/_checkpoint", f"{root}/events")
    out = store.read("sat_users")
    return out.withColumn("date_of_birth", F.col("date_of_birth").cast("timestamp_ntz"))


@register("stream_resume", f"""
SELECT md5(CAST(user_id AS VARCHAR)) AS hk_users, {TS_MS} AS load_dt, event_type AS new_status
FROM events WHERE event_type <> 'error'""")
def q_stream_resume(spark, sf_dir):
    """Two deliveries, the stream stopped and restarted from its checkpoint in between; a history table would show
    any event that is read again."""
    root, store = _setup(spark, "resume")
    ev = feeds.status_history_json(spark, sf_dir)
    _deliver(_before(ev), f"{root}/events")
    run_available(spark, store.model, store, f"{root}/_checkpoint", f"{root}/events")
    _deliver(_after(ev), f"{root}/events")
    run_available(spark, store.model, store, f"{root}/_checkpoint", f"{root}/events")
    return store.read("sat_user_status_history").select("hk_users", "load_dt", "new_status")


@register("late_arrival_wins", f"""
SELECT md5(CAST(user_id AS VARCHAR)) AS hk_users, CAST(user_id AS VARCHAR) AS user_external_id,
       COALESCE(MAX({TS_MS}) FILTER (WHERE ts < TIMESTAMP '{SPLIT_AT}'), MAX({TS_MS})) AS load_dt,
       'user_service.public.users' AS record_source, MIN({TS_MS}) AS first_load_dt
FROM events WHERE event_type <> 'error' GROUP BY user_id""")
def q_late_arrival_wins(spark, sf_dir):
    """Newer changes delivered first, older ones late: the last arrival wins (no watermark)."""
    root, store = _setup(spark, "late")
    ev = feeds.user_changes_json(spark, sf_dir)
    _deliver(_after(ev), f"{root}/events")
    run_available(spark, store.model, store, f"{root}/_checkpoint", f"{root}/events")
    _deliver(_before(ev), f"{root}/events")
    run_available(spark, store.model, store, f"{root}/_checkpoint", f"{root}/events")
    return store.read("hub_users")


@register("replay_idempotent", """
SELECT md5(CAST(user_id AS VARCHAR)) AS hk_users, make_timestamp((epoch_us(ts) // 1000) * 1000) AS load_dt,
       event_type AS new_status
FROM events WHERE event_type <> 'error'""")
def q_replay_idempotent(spark, sf_dir):
    """A micro-batch delivered twice (same batch id) leaves the history table as after one."""
    root, store = _setup(spark, "replay")
    _deliver(feeds.status_history_json(spark, sf_dir), f"{root}/events")
    batch = read_cdc_batch(spark, f"{root}/events")
    load_batch(batch, 0, store.model, store, load_id="history")
    load_batch(batch, 0, store.model, store, load_id="history")
    return store.read("sat_user_status_history").select("hk_users", "load_dt", "new_status")


@register("bulk_then_stream", f"""
SELECT hk_users, user_external_id, COALESCE(MAX(load_dt) FILTER (WHERE live), MAX(load_dt)) AS load_dt,
       'user_service.public.users' AS record_source, MIN(load_dt) AS first_load_dt, bool_or(live) AS changed
FROM (SELECT md5(CAST(c_custkey AS VARCHAR)) AS hk_users, CAST(c_custkey AS VARCHAR) AS user_external_id,
             {feeds.SNAPSHOT_AT.replace('TIMESTAMP_NTZ', 'TIMESTAMP ')} AS load_dt, false AS live FROM customer
      UNION ALL
      SELECT md5(CAST(user_id AS VARCHAR)), CAST(user_id AS VARCHAR), {TS_MS}, true FROM events WHERE event_type <> 'error')
GROUP BY hk_users, user_external_id""")
def q_bulk_then_stream(spark, sf_dir):
    """A snapshot as a bulk load, then live changes as a stream, both starting at batch 0 of one vault."""
    root, store = _setup(spark, "bulk-stream")
    bulk = load_sources({"users": feeds.users_decoded(spark, sf_dir)}, 0, store.model, store)
    _deliver(feeds.user_changes_json(spark, sf_dir), f"{root}/events")
    run_available(spark, store.model, store, f"{root}/_checkpoint", f"{root}/events")
    hub = store.read("hub_users", keep_order=True)
    return hub.withColumn("changed", F.col("_order.load_id") != bulk.load_id).drop("_order")


#: Three loads of two batches: batch (event_id // 7 % 2) of load (event_id % 3), loaded in this order.
_DEALT = "(event_id % 3 * 2 + event_id // 7 % 2)"
_ARRIVALS = [("a", 0), ("b", 0), ("a", 1), ("c", 0), ("c", 1), ("b", 1)]


def _batch_of(ev: DataFrame, load: str, batch: int) -> DataFrame:
    dealt = F.col("offset") % 3 * 2 + F.floor(F.col("offset") / 7) % 2
    return ev.where(dealt == "abc".index(load) * 2 + batch)


_TICKETS = "CASE " + " ".join(f"WHEN {_DEALT} = {'abc'.index(x) * 2 + b} THEN {i + 1}" for i, (x, b) in enumerate(_ARRIVALS)) + " END"


@register("interleaved_loads", f"""
SELECT md5(CAST(user_id AS VARCHAR)) AS hk_users, arg_max({TS_MS}, (ticket, event_id)) AS load_dt, MIN({TS_MS}) AS first_load_dt,
       MAX(ticket) AS ticket, arg_max(event_id, (ticket, event_id)) AS arrival
FROM (SELECT *, {_TICKETS} AS ticket FROM events WHERE event_type <> 'error') GROUP BY user_id""")
def q_interleaved_loads(spark, sf_dir):
    """Three loads whose batches alternate, record times out of order: a user's last arrival wins, also after a batch
    in the middle (b 0) and one by another driver (c 0) are replayed."""
    root, store = _setup(spark, "interleaved")
    ev = feeds.user_changes_json(spark, sf_dir)
    for load, batch in _ARRIVALS:
        load_batch(_batch_of(ev, load, batch), batch, store.model, store, load_id=load)
        if (load, batch) == ("a", 1):
            load_batch(_batch_of(ev, "b", 0), 0, store.model, store, load_id="b")
    other = VaultStore(spark, store.root, store.model)
    load_batch(_batch_of(ev, "c", 0), 0, store.model, other, load_id="c")
    return other.read("hub_users", keep_order=True).select(
        "hk_users", "load_dt", "first_load_dt", F.col("_order.ticket").alias("ticket"), F.col("_order.offset").alias("arrival"))


@register("redelivered_history", f"""
SELECT md5(CAST(user_id AS VARCHAR)) AS hk_users, {TS_MS} AS load_dt, event_type AS new_status, COUNT(*) AS n
FROM events WHERE event_type <> 'error' GROUP BY ALL""")
def q_redelivered_history(spark, sf_dir):
    """One topic read by three loads: a stream that stops half-way, a backfill of a stretch that begins in the middle of
    what the stream has seen, and the whole topic from its start under a new checkpoint, some files of it twice.  The
    history has every event once."""
    root, store = _setup(spark, "redelivered")
    ev = feeds.status_history_json(spark, sf_dir)
    _deliver(ev.where("offset % 5 < 2"), f"{root}/first")
    run_available(spark, store.model, store, f"{root}/_checkpoint-a", f"{root}/first", feed="statuses")
    load_batch(ev.where("offset % 5 in (1, 2)"), 0, store.model, store, load_id="backfill", feed="statuses")
    _deliver(ev, f"{root}/all")
    _deliver(ev.where("offset % 11 = 0"), f"{root}/all")
    run_available(spark, store.model, store, f"{root}/_checkpoint-b", f"{root}/all", feed="statuses", max_files_per_trigger=3)
    return store.read("sat_user_status_history").groupBy("hk_users", "load_dt", "new_status").agg(F.count(F.lit(1)).alias("n"))


@register("snapshot_meets_changes", """
SELECT u.user_external_id, CASE WHEN e.user_id IS NULL THEN first_name END AS first_name, coalesce(e.status, u.status) AS status
FROM (SELECT CAST(c_custkey AS VARCHAR) AS user_external_id, c_custkey AS id, c_name AS first_name, c_mktsegment AS status FROM customer
      UNION ALL SELECT CAST(user_id AS VARCHAR), user_id, NULL, NULL FROM (SELECT DISTINCT user_id FROM events)
      WHERE user_id NOT IN (SELECT c_custkey FROM customer)) u
LEFT JOIN (SELECT user_id, arg_max(event_type, event_id) AS status FROM events GROUP BY user_id) e ON e.user_id = u.id
WHERE e.status IS DISTINCT FROM 'error'""")
def q_snapshot_meets_changes(spark, sf_dir):
    """Users read in four chunks while their changes (a delete is an 'error') arrive before, between and after the marks
    of each; the merged feed ends in the final state of the source.

    The source as of a log position is the customers with the events up to it; each look at the log finds it longer.
    """
    users = M.users_rows(spark, sf_dir).withColumn("id", F.col("user_external_id").cast("bigint"))
    log = M.status_change_rows(spark, sf_dir).select(
        F.col("event_id").alias("offset"), F.col("user_external_id").cast("bigint").alias("id"), "user_external_id",
        F.lit(None).cast("string").alias("first_name"), F.col("new_status").alias("status"), "is_delete")
    columns = ["id", "user_external_id", "first_name", "status"]
    end = log.agg(F.max("offset")).first()[0] or 0
    clock = iter(range(1, 100))
    now = [0]

    def log_end() -> int:
        now[0] = end * next(clock) // 14
        return now[0]

    def state(at: int) -> DataFrame:
        rows = users.select(*columns, F.lit(-1).cast("bigint").alias("offset"), F.lit(False).alias("is_delete")) \
            .unionByName(log.where(F.col("offset") <= at).select(*columns, "offset", "is_delete"))
        return _last(rows, "offset")

    def _last(rows: DataFrame, order: str) -> DataFrame:
        top = rows.groupBy("id").agg(F.max_by(F.struct(*columns, "is_delete"), order).alias("r"))
        return top.where(~F.col("r.is_delete")).select(*[F.col(f"r.{c}").alias(c) for c in columns])

    def read(lower, upper) -> DataFrame:
        rows = state(end * next(clock) // 14)  # the chunk shows what came while it was read
        if lower is not None:
            rows = rows.where(F.col("id") >= lower)
        return rows if upper is None else rows.where(F.col("id") < upper)
    snapshot = ChunkedSnapshot(spark, fresh_dir(spark, "snapshot"), chunk_bounds(users, "id", 4), read, log_end)
    snapshot.run()
    feed = merged_rows(snapshot, log, "id").select(*columns, "position", F.lit(False).alias("is_delete")) \
        .unionByName(log.select(*columns, at_offset(F.col("offset")).alias("position"), "is_delete"))
    return _last(feed, "position").select("user_external_id", "first_name", "status")


@register("bucketed_join", """
SELECT md5(CAST(c_custkey AS VARCHAR)) AS hk_users, CAST(c_custkey AS VARCHAR) AS user_external_id, 1 + COALESCE(n, 0) AS versions
FROM customer LEFT JOIN (SELECT user_id, COUNT(DISTINCT event_type) AS n FROM events WHERE event_type <> 'error' GROUP BY 1) e
ON e.user_id = c_custkey
UNION ALL
SELECT md5(CAST(user_id AS VARCHAR)), CAST(user_id AS VARCHAR), COUNT(DISTINCT event_type) FROM events
WHERE event_type <> 'error' AND user_id NOT IN (SELECT c_custkey FROM customer) GROUP BY 1, 2""")
def q_bucketed_join(spark, sf_dir):
    """B8: users and their satellite, both written in buckets of the hash key, joined and counted by it bucket by bucket."""
    root, store = _setup(spark, "buckets")
    load_sources({"users": feeds.users_decoded(spark, sf_dir)}, 0, store.model, store)
    load_sources({"users": feeds.user_changes_decoded(spark, sf_dir)}, 0, store.model, store)
    return bucketed_versions(store, root, buckets=8)


def bucketed_versions(store: VaultStore, root: str, buckets: int) -> DataFrame:
    tag = uuid.uuid4().hex[:8]
    hub = store.write_bucketed("hub_users", f"hub_users_{tag}", f"{root}/hub_users_by_key", buckets)
    sat = store.write_bucketed("sat_users", f"sat_users_{tag}", f"{root}/sat_users_by_key", buckets)
    return hub.join(sat, "hk_users").groupBy("hk_users", "user_external_id").agg(F.count(F.lit(1)).alias("versions"))


@register("hash_key_lookup", f"""
SELECT md5(CAST(user_id AS VARCHAR)) AS hk_users, event_type AS status, arg_max(ts, (event_id % 3, event_id)) AS load_dt FROM events
WHERE event_type <> 'error' AND user_id IN (SELECT DISTINCT user_id FROM events WHERE event_type <> 'error' ORDER BY user_id LIMIT 2)
GROUP BY ALL""")
def q_hash_key_lookup(spark, sf_dir):
    """D7 by hash key: two users that are there and one that isn't, out of a satellite written by three loads."""
    root, store = _setup(spark, "lookup")
    ev = feeds.user_changes_decoded(spark, sf_dir)
    for k in range(3):
        load_sources({"users": ev.where(F.col("offset") % 3 == k)}, 0, store.model, store)
    two = M.table(spark, sf_dir, "events").where("event_type <> 'error'").select("user_id").distinct().orderBy("user_id").limit(2)
    keys = [r[0] for r in two.select(F.md5(F.col("user_id").cast("string"))).collect()]  # two rows
    return store.find("sat_users", [*keys, "f" * 32]).select("hk_users", "status", "load_dt")


#: Clicks stand for parents, purchases for children; a parent within twelve hours is in time.
@register("late_parents", f"""
SELECT user_id AS user_external_id, event_id, {TS_MS} AS happened FROM events p WHERE event_type = 'purchase' AND NOT EXISTS (
  SELECT 1 FROM events c WHERE c.event_type = 'click' AND c.user_id = p.user_id
  AND abs(epoch_ms(c.ts) - epoch_ms(p.ts)) <= 12 * 3600 * 1000)""")
def q_late_parents(spark, sf_dir):
    """Two streams in three deliveries, the second with parents before their children and the third after: children
    without a parent in time are reported, each once, over two restarts."""
    root = fresh_dir(spark, "late-parents")
    folder = {kind: fresh_dir(spark, kind) for kind in ("click", "purchase")}
    ev = M.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("user_external_id"), "event_id", "event_type",
        F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp"))).alias("happened"))
    cuts = [F.lit(d).cast("timestamp") for d in ("2024-01-12", "2024-01-20")]
    parts = [ev.where(F.col("happened") < cuts[0]), ev.where((F.col("happened") >= cuts[0]) & (F.col("happened") < cuts[1])),
             ev.where(F.col("happened") >= cuts[1])]
    end = ev.agg(F.max("happened")).first()[0]

    def stream(kind: str) -> DataFrame:
        return spark.readStream.schema("user_external_id bigint, event_id bigint, happened timestamp").json(folder[kind])

    def deliver(part: DataFrame, kind: str) -> None:
        part.where(F.col("event_type") == kind).select("user_external_id", "event_id", "happened").write.mode("append").json(folder[kind])

    def run() -> None:
        report = missing_parents(stream("purchase"), stream("click"), "user_external_id", "happened", "12 HOURS", "30 days")
        follow(report, f"{root}/report", f"{root}/_checkpoint").awaitTermination()
    for i, part in enumerate(parts):
        for kind in ("click", "purchase") if i % 2 else ("purchase", "click"):
            deliver(part, kind)
            run()
    if end is not None:  # both streams go on much later: nothing that was waited for can come any more
        later = spark.range(1).select(F.lit(-1).cast("bigint").alias("user_external_id"), F.lit(-1).cast("bigint").alias("event_id"),
                                      (F.lit(end) + F.expr("INTERVAL 90 days")).alias("happened"))
        for kind in ("click", "purchase"):
            deliver(later.withColumn("event_type", F.lit(kind)), kind)
        run()
    out = spark.read.schema("user_external_id bigint, event_id bigint, happened timestamp").parquet(f"{root}/report")
    return out.where("event_id >= 0").withColumn("happened", F.col("happened").cast("timestamp_ntz"))


@register("batch_metrics", """
SELECT k AS vault_table, n AS rows FROM (
  SELECT 'events:users' AS k, COUNT(*) AS n FROM events
  UNION ALL SELECT 'deleted:users', COUNT(*) FROM events WHERE event_type = 'error'
  UNION ALL SELECT 'rejected:users', 0
  UNION ALL SELECT 'hub_users', COUNT(DISTINCT user_id) FROM events WHERE event_type <> 'error'
  UNION ALL SELECT 'sat_users', COUNT(DISTINCT (user_id, event_type)) FROM events WHERE event_type <> 'error'
  UNION ALL SELECT '_quarantine', 0)""")
def q_batch_metrics(spark, sf_dir):
    """L4: what a loaded batch reports of itself."""
    root, store = _setup(spark, "metrics")
    _deliver(feeds.user_changes_json(spark, sf_dir), f"{root}/events")
    load_batch(read_cdc_batch(spark, f"{root}/events"), 0, store.model, store)
    return spark.read.parquet(f"{store.root}/_metrics").select("vault_table", "rows")
