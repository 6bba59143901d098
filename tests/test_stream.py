"""Stream = batch: the same events in one or several deliveries, with a restart,
a replayed batch in between, give the same vault tables."""

import os
import random
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vaultline.operators import decode as D
from vaultline.operators import quality as Q
from vaultline.plans import feeds
from vaultline.session import fresh_dir
from vaultline.sinks.store import VaultStore, offset_runs
from vaultline.sources.cdc import read_cdc_batch
from vaultline.streaming import loader
from vaultline.streaming.loader import load_batch, load_sources, run_available

TABLES = ["hub_users", "sat_users", "hub_orders", "lnk_orders_users", "sat_orders", "sat_user_status_history"]


def _events(spark):
    return Q.union_all([feeds.users_json(spark, SF_SMALL), feeds.user_changes_json(spark, SF_SMALL),
                        feeds.orders_json(spark, SF_SMALL), feeds.status_history_json(spark, SF_SMALL)])


def _snapshot(store):
    return {t: sorted(tuple(r) for r in store.read(t).collect()) for t in TABLES}


def test_stream_equals_batch_across_deliveries(spark, model):
    ev = _events(spark).persist()
    # one delivery
    root1 = fresh_dir(spark, "t-one")
    ev.write.json(f"{root1}/events")
    s1 = VaultStore(spark, f"{root1}/vault", model)
    run_available(spark, model, s1, f"{root1}/ckpt", f"{root1}/events")
    # three deliveries by topic-independent arrival windows, stream restarted each time
    root3 = fresh_dir(spark, "t-three")
    s3 = VaultStore(spark, f"{root3}/vault", model)
    ts = F.col("timestamp").cast("timestamp_ntz")
    bounds = ["2000-01-01 00:00:00", "2024-01-15 00:00:00"]
    parts = [ev.where(ts < F.lit(bounds[0]).cast("timestamp_ntz")),
             ev.where((ts >= F.lit(bounds[0]).cast("timestamp_ntz")) & (ts < F.lit(bounds[1]).cast("timestamp_ntz"))),
             ev.where(ts >= F.lit(bounds[1]).cast("timestamp_ntz"))]
    for p in parts:
        p.write.mode("append").json(f"{root3}/events")
        run_available(spark, model, s3, f"{root3}/ckpt", f"{root3}/events")
    a, b = _snapshot(s1), _snapshot(s3)
    for t in TABLES:
        assert len(a[t]) == len(b[t]), t
    # keyed tables: same keys and content; arrival order equals event time here
    for t in TABLES:
        assert a[t] == b[t], t
    metrics = spark.read.parquet(f"{root3}/vault/_metrics")
    assert metrics.select("batch_id").distinct().count() == 3
    ev.unpersist()


def test_replay_of_a_batch_and_a_new_delivery(spark, model):
    root = fresh_dir(spark, "t-replay")
    _events(spark).write.json(f"{root}/events")
    store = VaultStore(spark, f"{root}/vault", model)
    batch = read_cdc_batch(spark, f"{root}/events")
    load_batch(batch, 0, model, store, load_id="x")
    before = _snapshot(store)
    load_batch(batch, 0, model, store, load_id="x")           # redelivery of batch 0
    assert _snapshot(store) == before
    load_batch(batch, 1, model, store, load_id="x")           # same events again as a new batch
    after = _snapshot(store)
    for t in TABLES:
        if model.target(t).unique_key:
            assert len(after[t]) == len(before[t]), t      # keyed: absorbed
        else:
            assert len(after[t]) == 2 * len(before[t]), t  # history: a new delivery is new rows


def _user_events(spark, rows):
    """(user, offset, time, status) as change events of users."""
    return spark.createDataFrame(rows, "u string, o bigint, t string, s string").select(
        F.lit("user_service.public.users").alias("topic"), F.lit(0).alias("partition"), F.col("o").alias("offset"),
        F.to_timestamp("t").alias("timestamp"),
        F.to_json(F.struct(F.struct(F.col("u").alias("user_external_id"), F.col("s").alias("status")).alias("after"))).alias("value"))


def test_loads_do_not_touch_each_other(spark, model):
    """Two bulk loads, a stream, and the same stream with a new checkpoint: all begin with batch 0."""
    root = fresh_dir(spark, "t-loads")
    store = VaultStore(spark, f"{root}/vault", model)
    day = "2024-01-0{} 00:00:00"
    load_batch(_user_events(spark, [(f"u{i}", i, day.format(1), "a") for i in range(50)]), 0, model, store, load_id="first")
    load_batch(_user_events(spark, [("v1", 1, day.format(1), "a")]), 0, model, store, load_id="second")
    _user_events(spark, [("u1", 1, day.format(2), "b"), ("w1", 2, day.format(2), "b")]).write.json(f"{root}/events")
    run_available(spark, model, store, f"{root}/ckpt-a", f"{root}/events")
    run_available(spark, model, store, f"{root}/ckpt-b", f"{root}/events")
    again = VaultStore(spark, f"{root}/vault", model)
    assert again.read("hub_users").count() == 52
    latest = {r["hk_users"]: r["_order"]["ticket"] for r in again.read("hub_users", keep_order=True).collect()}
    assert sorted(latest.values()) == [1] * 49 + [2] + [4, 4]
    assert again.ticket("third", 0) == 5 and again.ticket("second", 0) == 2


def test_result_does_not_depend_on_the_batches(spark, model):
    """Record times out of order: one, three and ten batches give the same vault."""
    rows = [(f"u{i % 7}", i, f"2024-01-{(i * 11) % 28 + 1:02d} 00:00:00", f"s{i % 3}") for i in range(60)]
    results = []
    for n in (1, 3, 10):
        store = VaultStore(spark, f"{fresh_dir(spark, 't-batches')}/vault", model)
        for b in range(n):
            load_batch(_user_events(spark, rows[b * 60 // n:(b + 1) * 60 // n]), b, model, store, load_id="x")
        results.append([sorted(map(tuple, store.read(t).collect()), key=str) for t in ("hub_users", "sat_users")])
    assert results[0] == results[1] == results[2]
    hub = {r[1]: str(r[2]) for r in results[0][0]}  # the last offset's time, not the latest time
    assert hub == {u: max((r[1], r[2]) for r in rows if r[0] == u)[1] for u in hub}


def test_loads_without_a_name_keep_their_rows(spark, model):
    """Two bulk loads and two batches, all by default arguments: no one replaces another's rows."""
    store = VaultStore(spark, f"{fresh_dir(spark, 't-default')}/vault", model)
    day = "2024-01-01 00:00:00"
    users = lambda names: D.decode_topic(_user_events(spark, [(u, i, day, "a") for i, u in enumerate(names)]), model.source("users"))
    first = load_sources({"users": users("abcde")}, 0, model, store)
    second = load_sources({"users": users("xyz")}, 0, model, store)
    for u in ("p", "q"):
        load_batch(_user_events(spark, [(u, 0, day, "a")]), 0, model, store)
    assert first.load_id != second.load_id and (first.ticket, second.ticket) == (1, 2)
    assert store.read("hub_users").count() == 10
    load_sources({"users": users("xy")}, 0, model, store, load_id=second.load_id)  # a replay by name
    assert store.read("hub_users").count() == 9


def test_a_replay_leaves_nothing_of_its_first_attempt(spark, model):
    store = VaultStore(spark, f"{fresh_dir(spark, 't-again')}/vault", model)
    name = "load: 1/ä %"
    one = _user_events(spark, [("u1", 1, "2024-01-01 00:00:00", "a")])
    load_batch(one, 0, model, store, load_id=name)
    load_batch(one.where("false"), 0, model, VaultStore(spark, store.root, model), load_id=name)
    assert store.read("hub_users").count() == 0


def test_tickets(spark, model):
    """No number twice, none skipped; a name keeps its number; several drivers on one vault."""
    root = f"{fresh_dir(spark, 't-tickets')}/vault"
    stores = [VaultStore(spark, root, model) for _ in range(4)]
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: stores[i % 4].ticket(f"load {i % 5}/x", i), range(40)))
    assert sorted(got) == list(range(1, 41))
    late = VaultStore(spark, root, model)
    assert [late.ticket(f"load {i % 5}/x", i) for i in range(40)] == got
    assert late.ticket("new", 0) == 41


def _offsets_of(events):
    return sorted(r["offset"] for r in events.select("offset").collect())


@pytest.mark.parametrize("seed", range(4))
def test_offsets_are_loaded_once(spark, model, seed):
    """Random batches with gaps, overlaps, repeats and two partitions, against a set of what was seen."""
    rng = random.Random(seed)
    store = VaultStore(spark, f"{fresh_dir(spark, 't-offsets')}/vault", model)
    seen = set()
    for b in range(6):
        start = rng.choice([0, 4090, 9000])
        ids = [(rng.randint(0, 1), start + rng.randint(0, 40)) for _ in range(rng.randint(1, 60))]
        df = spark.createDataFrame([("t", p, o) for p, o in ids], "topic string, partition int, offset long")
        runs = offset_runs(df)
        got = store.unseen(df, runs, "f", "load", b)
        assert sorted((r["partition"], r["offset"]) for r in got.collect()) == sorted(x for x in ids if x not in seen)
        assert store.unseen(df, runs, "another feed", "load", b).count() == len(ids)
        store.write_offsets(runs, "f", "load", b)
        assert store.unseen(df, runs, "f", "load", b).count() == len([x for x in ids if x not in seen])  # a replay
        seen |= set(ids)
    covered = {(r["partition"], o) for r in store.loaded_offsets("f").collect() for o in range(r["lo"], r["hi"] + 1)}
    assert covered == seen


def test_runs_across_words_and_chunks(spark):
    ids = [*range(60, 70), *range(4000, 4200), 63, 4095, 4096, 8191, *range(127, 400, 2), *range(12288, 16384)]
    df = spark.createDataFrame([("t", p, o) for p in (0, 1) for o in ids + ids[:50]], "topic string, partition int, offset long")
    want, numbers = [], sorted(set(ids))
    for o in numbers:
        if o % 4096 and want and want[-1][1] == o - 1:
            want[-1][1] = o
        else:
            want.append([o, o])
    for p in (0, 1):
        got = offset_runs(df).where(F.col("partition") == p).orderBy("lo").collect()
        assert [(r["chunk"], r["lo"], r["hi"]) for r in got] == [(lo // 4096, lo, hi) for lo, hi in want]


def test_an_event_meets_one_row_of_loaded_offsets(spark, model):
    """Every second offset is loaded: an event is looked up in its word, not compared with the runs of its chunk."""
    store = VaultStore(spark, f"{fresh_dir(spark, 't-meets')}/vault", model)
    all_ = spark.range(8192).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    store.write_offsets(offset_runs(all_.where("offset % 2 = 0")), "f", "load", 0)
    fresh = store.unseen(all_, offset_runs(all_), "f", "load", 1)
    assert sorted(r["offset"] for r in fresh.collect()) == list(range(1, 8192, 2))
    join = [x for x in fresh._jdf.queryExecution().optimizedPlan().toString().splitlines() if "LeftAnti" in x]
    assert len(join) == 1 and "lo#" not in join[0] and "hi#" not in join[0], join


def test_redelivery_is_counted(spark, model):
    store = VaultStore(spark, f"{fresh_dir(spark, 't-again')}/vault", model)
    rows = [(f"u{i}", i, "2024-01-01 00:00:00", "a") for i in range(10)]
    assert load_batch(_user_events(spark, rows[:6]), 0, model, store, feed="f")["redelivered"] == 0
    again = load_batch(_user_events(spark, rows[3:] + rows[7:9]), 0, model, store, feed="f")
    assert again["redelivered"] == 5 and again["events:users"] == 4
    assert store.read("hub_users").count() == 10


def test_one_bad_event_does_not_stop_the_load(spark, model):
    users = "user_service.public.users"
    vals = ['{"after": {"user_external_id": "ok"}}', '{"after": {"user_external_id": "far", "registration_date": 9223372036854775807}}',
            '{"after": {"id": 5}}', '{"after": {}}', '{"after": null}', '{"payload": {"after": {"id": 5}}}', '{nope', '{"after": {"email": "x"}}']
    df = spark.createDataFrame([(users, 0, i, "2024-01-01 00:00:00", v) for i, v in enumerate(vals)],
                               "topic string, partition int, offset bigint, ts string, value string") \
        .select("topic", "partition", "offset", F.to_timestamp("ts").alias("timestamp"), "value")
    store = VaultStore(spark, f"{fresh_dir(spark, 't-bad')}/vault", model)
    m = load_batch(df, 0, model, store)
    assert m["hub_users"] == 1 and m["deleted:users"] == 2
    assert {r["offset"]: r["reject"] for r in store.read("_quarantine").collect()} == {
        1: "bad_value", 2: "missing_business_key", 5: "missing_business_key", 6: "malformed_json", 7: "missing_business_key"}


def test_quarantine_written(spark, model):
    root = fresh_dir(spark, "t-quar")
    rows = [("user_service.public.users", 0, 1, "2024-01-01 00:00:00", '{"after": {"user_external_id": "u1"}}'),
            ("user_service.public.users", 0, 2, "2024-01-01 00:00:00", '{"after": '),
            ("user_service.public.users", 0, 3, "2024-01-01 00:00:00", '{"after": {"email": "x"}}')]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, ts string, value string") \
        .select("topic", "partition", "offset", F.to_timestamp("ts").alias("timestamp"), "value")
    store = VaultStore(spark, f"{root}/vault", model)
    m = load_batch(df, 0, model, store)
    assert m["hub_users"] == 1 and m["_quarantine"] == 2
    assert m["events:users"] == 3 and m["rejected:users"] == 2 and m["deleted:users"] == 0
    q = {r["offset"]: r["reject"] for r in store.read("_quarantine").collect()}
    assert q == {2: "malformed_json", 3: "missing_business_key"}


def test_vault_tables_are_compressed_with_zstd(spark, model):
    store = VaultStore(spark, f"{fresh_dir(spark, 't-zstd')}/vault", model)
    load_sources({"users": feeds.users_decoded(spark, SF_SMALL)}, 0, model, store)
    for table in ("hub_users", "sat_users"):
        files = store.read(table).inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files), files


def test_bucketed_lookup_prunes_buckets(spark, model):
    """A hub lookup by hash key on the bucketed copy reads one bucket."""
    root = fresh_dir(spark, "t-bucket")
    feeds.users_json(spark, SF_SMALL).write.json(f"{root}/events")
    store = VaultStore(spark, f"{root}/vault", model)
    load_batch(read_cdc_batch(spark, f"{root}/events"), 0, model, store)
    name = "vl_test_hub_users"
    store.write_bucketed("hub_users", name, f"{root}/bucketed")
    # Spark drops the bucketed scan for a plain filter (files are still pruned by
    # bucket id); with that rule off the pruning shows in the plan.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        hit = spark.table(name).where(F.col("hk_users") == F.md5(F.lit("42")))
        plan = hit._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 4" in plan, plan
    assert [r["user_external_id"] for r in hit.collect()] == ["42"]


def test_bucketed_tables_join_without_an_exchange(spark, model):
    from vaultline.plans.q_stream import bucketed_versions
    root = fresh_dir(spark, "t-bucket-join")
    store = VaultStore(spark, f"{root}/vault", model)
    load_sources({"users": feeds.users_decoded(spark, SF_SMALL)}, 0, model, store)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = bucketed_versions(store, root, 6)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    assert plan.count("SelectedBucketsCount: 6 out of 6") == 2 or plan.count("Bucketed: true") == 2
    assert df.where("versions = 1").count() == df.count() == 150


def test_lookups_skip_row_groups_by_bloom_filter(spark, model):
    """A key that isn't there lies between the smallest and the largest: only the Bloom filter can tell."""
    store = VaultStore(spark, f"{fresh_dir(spark, 't-bloom')}/vault", model)
    load_sources({"users": feeds.users_decoded(spark, SF_SMALL)}, 0, model, store)

    def scanned(key):
        df = store.find("hub_users", [key])
        n = len(df.collect())
        plan = df._jdf.queryExecution().executedPlan()
        plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
        found = []

        def walk(p):
            p = p.plan() if "QueryStage" in p.nodeName() else p
            children = p.children()
            if children.size() == 0 and p.metrics().contains("numOutputRows"):
                found.append(p.metrics().apply("numOutputRows").value())
            for i in range(children.size()):
                walk(children.apply(i))
        walk(plan)
        return n, sum(found)
    there = store.read("hub_users").orderBy("hk_users").offset(70).first()["hk_users"]
    missing = there[:-1] + ("0" if there[-1] != "0" else "1")
    assert scanned(there)[0] == 1 and scanned(there)[1] >= 1
    assert scanned(missing) == (0, 0)


def test_skip_counters(spark, model):
    root = fresh_dir(spark, "t-skips")
    t = "user_service.public.user_addresses"
    vals = ['{"after": {"address_external_id": "a1", "user_external_id": "u1"}}',
            '{"after": {"address_external_id": "a2", "user_external_id": ""}}',
            '{"after": {"address_external_id": "a3"}}',
            '{"op": "d", "after": null}']
    rows = [(t, 0, i, "2024-01-01 00:00:00", v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, ts string, value string") \
        .select("topic", "partition", "offset", F.to_timestamp("ts").alias("timestamp"), "value")
    m = load_batch(df, 0, model, VaultStore(spark, f"{root}/vault", model))
    assert m["lnk_user_addresses_users"] == 1 and m["skipped:lnk_user_addresses_users"] == 2
    assert m["deleted:user_addresses"] == 1 and m["hub_user_addresses"] == 3


def test_bulk_load_matches_model_driven_counts(spark, model):
    """load_sources writes exactly the rows model_driven_load reports, per table."""
    import __spark_entry__ as E
    store = VaultStore(spark, f"{fresh_dir(spark, 't-bulk')}/vault", model)
    metrics = load_sources({n: f(spark, SF_SMALL) for n, f in feeds.DECODED_FEEDS.items()}, 0, model, store)
    want = {r["vault_table"]: r["row_count"] for r in E.queries()["model_driven_load"](spark, SF_SMALL).collect()}
    got = {t: store.read(t).count() for t in want}
    assert got == want
    assert all(metrics[t] == want[t] for t in want)


def _orders_loaded(spark, model, name, **kw):
    store = VaultStore(spark, f"{fresh_dir(spark, name)}/vault", model)
    metrics = load_sources({n: feeds.DECODED_FEEDS[n](spark, SF_SMALL) for n in ("orders", "shipments", "order_status_history")},
                           0, model, store, **kw)
    return metrics, {t: sorted(map(str, store.read(t).collect())) for t in metrics if t in model.targets}


def test_model_driven_load_caches_nothing(spark, monkeypatch):
    """Its feeds read files: a cached copy of them would take memory and disk in proportion to the largest table."""
    import __spark_entry__ as E
    kept, frame = [], type(spark.range(1))
    real = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: kept.append(self.columns) or real(self, *a))
    assert len(E.queries()["model_driven_load"](spark, SF_SMALL).collect()) == 26
    assert kept == []


def test_a_source_read_again_gives_the_same_rows(spark, model):
    assert _orders_loaded(spark, model, "t-reread", reread=True) == _orders_loaded(spark, model, "t-cached")


def test_large_sources_write_keyed_tables_in_turn(spark, model, monkeypatch):
    """The shuffles of all tables of large sources would be on disk together, or the last ones beside the whole vault."""
    want = _orders_loaded(spark, model, "t-together", reread=True)
    running, most, written, lock, real = set(), [], [], threading.Lock(), VaultStore.write_batch

    def write_batch(self, df, table, *a):
        with lock:
            running.add(table)
            most.append({t for t in running if t != "_quarantine" and model.target(t).unique_key})
        try:
            return real(self, df, table, *a)
        finally:
            with lock:
                running.discard(table)
                written.append(table)
    monkeypatch.setattr(VaultStore, "write_batch", write_batch)
    monkeypatch.setattr(loader, "LARGE_SOURCE", 0)
    assert _orders_loaded(spark, model, "t-turns", reread=True) == want
    assert max(map(len, most)) == 1
    assert written[-1] == "sat_order_status_history" and most[-1] == set()


def test_a_load_leaves_no_shuffle_files(spark, model):
    """They go when a table is written, not when the driver happens to collect its garbage; the setting is as before."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for d in env.localDirsString() for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    before, was = shuffled(), spark.conf.get(key)
    kept = [feeds.orders_decoded(spark, SF_SMALL)]
    load_sources({"orders": kept[0]}, 0, model, VaultStore(spark, f"{fresh_dir(spark, 't-shuffles')}/vault", model))
    for _ in range(50):  # files are removed in the background
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert spark.conf.get(key) == was


def test_stored_hashes_and_order_take_little_room(spark, model):
    """Texts' lengths apart from the texts, and the load time of a row once; read back, the order has it."""
    store = VaultStore(spark, f"{fresh_dir(spark, 't-room')}/vault", model)
    load_sources({"users": feeds.users_decoded(spark, SF_SMALL)}, 0, model, store)
    for path in store.read("hub_users").inputFiles():
        group = pq.ParquetFile(path.removeprefix("file://")).metadata.row_group(0)
        columns = {c.path_in_schema: c for c in map(group.column, range(group.num_columns))}
        assert "DELTA_BYTE_ARRAY" in columns["hk_users"].encodings, columns["hk_users"].encodings
        assert "load_dt" in columns and "_order.load_dt" not in columns
    rows = store.read("hub_users", keep_order=True).collect()
    assert rows and all(r["_order"]["load_dt"] == r["load_dt"] is not None for r in rows)


def test_bounded_micro_batches(spark, model):
    """max_files_per_trigger=1: one micro-batch per delivered file, same vault as one batch."""
    ev = feeds.user_changes_json(spark, SF_SMALL).coalesce(1)
    ts = F.col("timestamp").cast("timestamp_ntz")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    root_a, root_b = fresh_dir(spark, "t-bound-a"), fresh_dir(spark, "t-bound-b")
    for part in (ev.where(ts < cut), ev.where(ts >= cut)):
        part.write.mode("append").json(f"{root_a}/events")
    ev.write.json(f"{root_b}/events")
    a = VaultStore(spark, f"{root_a}/vault", model)
    b = VaultStore(spark, f"{root_b}/vault", model)
    run_available(spark, model, a, f"{root_a}/ckpt", f"{root_a}/events", max_files_per_trigger=1)
    run_available(spark, model, b, f"{root_b}/ckpt", f"{root_b}/events")
    assert spark.read.parquet(f"{root_a}/vault/_metrics").select("batch_id").distinct().count() == 2
    for t in ("hub_users", "sat_users"):
        assert sorted(tuple(r) for r in a.read(t).collect()) == sorted(tuple(r) for r in b.read(t).collect()), t
