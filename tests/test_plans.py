"""Plan shapes that matter at scale: one scan, pruned columns, partial
aggregation before every shuffle, no join in the one-pass cohort plan."""

import re

from tests.conftest import SF_SMALL
from vaultline.operators import quality as Q
from vaultline.operators import vault as V
from vaultline.plans import cohort as C
from vaultline.plans import feeds
from vaultline.plans.marketplace import cohort_orders, table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan):
    return re.findall(r"FileScan parquet [^\n]*", plan)


def test_one_pass_cohort_plan(spark):
    plan = plan_of(C.cohort_report(cohort_orders(spark, SF_SMALL)))
    s = scans(plan)
    assert len(s) == 1, plan
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in s[0]
    assert "Join" not in plan
    # the first aggregate below the (user, month) shuffle is a map-side partial one
    assert re.search(r"HashAggregate\(keys=\[user_external_id#\d+L?, \w+#\d+\], functions=\[partial_sum", plan), plan


def test_keyed_view_is_partial_then_final(spark):
    src = feeds.model().source("users")
    good = feeds.user_changes_decoded(spark, SF_SMALL)
    plan = plan_of(V.keyed_view(V.hub_rows(good, src), "hk_users"))
    assert "partial_max" in plan and "partial_min" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Window" not in plan


def test_events_are_reduced_before_they_are_hashed(spark):
    """Hubs and links go through the exchange by their business keys, not as hash text."""
    src = feeds.model().source("order_items")
    good = feeds.order_items_decoded(spark, SF_SMALL)
    plan = plan_of(V.load_topic(good, feeds.model(), src)["lnk_order_items"])
    above, below = plan.split("Exchange hashpartitioning")
    assert "md5(" in above and "md5(" not in below and "partial_max" in below, plan


def test_orphan_check_shuffles_link_keys_only(spark):
    from vaultline.plans.q_quality import q_vault_orphan_check
    plan = plan_of(q_vault_orphan_check(spark, SF_SMALL))
    assert "LeftAnti" in plan and "max(" not in plan, plan  # no rows are carried along to count keys


def test_orphans_aggregate_child_keys_before_the_anti_join(spark):
    o, c = table(spark, SF_SMALL, "orders"), table(spark, SF_SMALL, "customer")
    plan = plan_of(Q.orphans(o, c, "o_custkey", "c_custkey"))
    assert "partial_count" in plan
    assert "LeftAnti" in plan
    assert all("ReadSchema: struct<o_custkey:bigint>" in s or "ReadSchema: struct<c_custkey:bigint>" in s
               for s in scans(plan))


def test_no_broadcast_hints_in_library():
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1] / "vaultline"
    for p in root.rglob("*.py"):
        if "llm" in p.parts:  # its broadcasts are of bounded size, and tested there
            continue
        text = p.read_text()
        assert "broadcast(" not in text, p
        assert "localCheckpoint" not in text, p


def test_user_activity_join_counts_the_joined_rows(spark):
    from tools.check_oracle import duck, rows_of
    from vaultline.plans import registry
    got = registry.queries()["user_activity_join"](spark, SF_SMALL)
    assert "Join" in plan_of(got)
    assert rows_of(got.toPandas()) == rows_of(duck(SF_SMALL).sql(registry.oracle_sql()["user_activity_join"]).df())


def test_row_level_cohorts_read_orders_once_for_the_rows(spark):
    """The per-user side comes from the saved aggregate: orders stand once in the plan (and once in the aggregate's job)."""
    found = scans(plan_of(C.user_activity(cohort_orders(spark, SF_SMALL))))
    assert len(found) == 2, found
    assert sum("o_custkey" in s for s in found) == 1 and sum("cohort_month" in s for s in found) == 1, found
