"""From a CSV to the vault and back: read, change events, load, hub lookup, latest satellite rows."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators import vault as V
from vaultline.session import fresh_dir
from vaultline.sinks.store import VaultStore
from vaultline.sources import cdc
from vaultline.streaming.loader import run_available

CSV = '''user_external_id,email,first_name,status
u-1,ann@example.com,"Ann ""A"" O'Neil, Jr.",active
u-2,bob@example.com,"back\\",active
u-3,,Cy,blocked
'''
SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("user_external_id", "email", "first_name", "status")])


def test_csv_to_vault_and_back(spark, model, tmp_path):
    root = fresh_dir(spark, "t-e2e")
    (tmp_path / "users.csv").write_text(CSV)
    users = cdc.read_csv(spark, str(tmp_path / "users.csv"), SCHEMA)
    src = model.source("users")
    number = F.substring("user_external_id", 3, 9).cast("bigint")
    cdc.snapshot_to_events(users, src, offset=number, timestamp=F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")) \
        .write.json(f"{root}/events")
    store = VaultStore(spark, f"{root}/vault", model)
    run_available(spark, model, store, f"{root}/ckpt", f"{root}/events")
    changed = users.where("user_external_id = 'u-1'").withColumn("status", F.lit("gone"))
    cdc.snapshot_to_events(changed, src, offset=F.lit(10), timestamp=F.expr("TIMESTAMP_NTZ'2024-01-02 00:00:00'"), op="u") \
        .write.mode("append").json(f"{root}/events")
    run_available(spark, model, store, f"{root}/ckpt", f"{root}/events")
    hit = store.read("hub_users").where("user_external_id = 'u-1'").collect()
    assert len(hit) == 1 and store.read("hub_users").count() == 3
    sat = store.read("sat_users")
    latest = V.latest_rows(sat.where(F.col("hk_users") == hit[0]["hk_users"]), 5, tie_break=("hash_diff",)).collect()
    assert [(r["first_name"], r["status"]) for r in latest] == [("Ann \"A\" O'Neil, Jr.", "gone"), ("Ann \"A\" O'Neil, Jr.", "active")]
    assert {r["first_name"] for r in sat.collect()} == {"Ann \"A\" O'Neil, Jr.", "back\\", "Cy"}
