"""Chunked snapshots under way while the table changes; parity by bucket checksums."""

import random

import pytest
from pyspark.sql import functions as F

from vaultline.operators import parity as P
from vaultline.operators import quality as Q
from vaultline.session import fresh_dir
from vaultline.sources import snapshot as S


class Table:
    """A table of key -> value, its log of (offset, key, value or None), and a clock of log positions."""

    def __init__(self, seed, keys=60, changes=400):
        rng = random.Random(seed)
        self.start = {k: f"s{k}" for k in range(keys)}
        self.log = [(i + 1, rng.randrange(keys + 20), None if rng.random() < 0.2 else f"c{i}") for i in range(changes)]
        self.now = 0

    def state(self, at):
        out = dict(self.start)
        for o, k, v in self.log[:at]:
            if v is None:
                out.pop(k, None)
            else:
                out[k] = v
        return out


def snapshot(spark, t, steps, bounds=(15, 30, 50)):
    """Every look at the log's end and every read moves the clock on."""
    rng = random.Random(steps)

    def tick():
        t.now = min(len(t.log), t.now + rng.randint(0, steps))
        return t.now

    def read(lower, upper):
        rows = [(k, v) for k, v in t.state(tick()).items() if (lower is None or k >= lower) and (upper is None or k < upper)]
        return spark.createDataFrame(rows, "key long, value string")
    return S.ChunkedSnapshot(spark, fresh_dir(spark, "t-snapshot"), list(bounds), read, tick)


def applied(spark, s, t):
    log = spark.createDataFrame(t.log, "offset long, key long, value string")
    feed = S.merged_rows(s, log, "key").select("key", "value", "position").unionByName(
        log.select("key", "value", S.at_offset(F.col("offset")).alias("position")))
    rows = feed.collect()
    assert len({(r["position"], r["key"]) for r in rows}) == len(rows)
    state = {}
    for r in sorted(rows, key=lambda r: r["position"]):
        state[r["key"]] = r["value"]
    return {k: v for k, v in state.items() if v is not None}


@pytest.mark.parametrize("steps", [0, 3, 60])
def test_snapshot_and_changes_end_in_the_table_s_state(spark, steps):
    t = Table(steps)
    s = snapshot(spark, t, steps)
    assert s.run() == 4
    assert applied(spark, s, t) == t.state(len(t.log))


def test_a_row_that_changed_between_the_marks_is_dropped(spark):
    t = Table(1, keys=3, changes=0)
    t.log = [(1, 0, "new"), (2, 1, None), (3, 2, "later")]
    ends = iter([0, 2])
    s = S.ChunkedSnapshot(spark, fresh_dir(spark, "t-marks"), [], lambda a, b: spark.createDataFrame(
        [(k, v) for k, v in t.start.items()], "key long, value string"), lambda: next(ends))
    s.run()
    log = spark.createDataFrame(t.log, "offset long, key long, value string")
    kept = {r["key"]: r["position"] for r in S.merged_rows(s, log, "key").collect()}
    assert set(kept) == {2} and (2 << S.ROW_BITS) < kept[2] < (3 << S.ROW_BITS)


def test_a_snapshot_goes_on_where_it_stopped(spark):
    t = Table(7)
    s = snapshot(spark, t, 10)
    whole, calls = s.read, []

    def failing(lower, upper):
        calls.append(lower)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return whole(lower, upper)
    s.read = failing
    with pytest.raises(RuntimeError):
        s.run()
    assert s.run() == 2 and calls == [None, 15, 30, 30, 50]
    assert applied(spark, s, t) == t.state(len(t.log))


def test_chunk_bounds(spark):
    rows = spark.range(1000).withColumnRenamed("id", "key")
    bounds = S.chunk_bounds(rows, "key", 4)
    assert len(bounds) == 3 and all(abs(b - 250 * (i + 1)) < 5 for i, b in enumerate(bounds))
    assert S.chunk_bounds(rows.limit(0), "key", 4) == [] and S.chunk_bounds(rows, "key", 1) == []


# ---------------------------------------------------------------- parity

def copies(spark, seed, changes):
    rng = random.Random(seed)
    rows = [(i % 900, rng.choice(["a", "b", None]), i if i % 7 else None) for i in range(1000)]
    other = list(rows)
    for _ in range(changes):
        i = rng.randrange(len(other))
        kind = rng.choice("daucn")
        if kind == "d":
            del other[i]
        elif kind == "a":
            other.append((5000 + i, "new", i))
        elif kind == "u":
            other[i] = (other[i][0], "changed", other[i][2])
        elif kind == "c":
            other.append(other[i])
        else:
            other[i] = (other[i][0], other[i][1], None if other[i][2] is not None else 0)
    kind = "k int, s string, n int"
    return spark.createDataFrame(rows, kind), spark.createDataFrame(other, kind)


@pytest.mark.parametrize("changes", [0, 1, 2, 40])
def test_bucket_parity_equals_the_full_comparison(spark, changes):
    a, b = copies(spark, changes, changes)
    assert P.reconcile_by_bucket("x", a, b, ["k"], 64).collect() == Q.reconcile("x", a, b).collect()
    assert P.reconcile_by_bucket("x", a, b.limit(0), ["k"], 64).collect() == Q.reconcile("x", a, b.limit(0)).collect()


def test_only_differing_buckets_are_compared(spark):
    a, b = copies(spark, 3, 2)
    totals, rows = P.differences(a, b, ["k"], 256)
    assert 0 < totals.first()["buckets"] <= 2
    assert rows.count() < 30  # of 1,000
    same, none = P.differences(a, a, ["k"], 256)
    assert same.first()["buckets"] == 0 and none.count() == 0


def test_repeated_rows_do_not_cancel(spark):
    kind = "k int, s string"
    a = spark.createDataFrame([(1, "x")] * 2 + [(2, "y")] * 2, kind)
    b = spark.createDataFrame([(1, "x")] * 4 + [(2, "y")] * 0, kind)
    assert P.reconcile_by_bucket("x", a, b, ["k"], 1).collect() == Q.reconcile("x", a, b).collect()
