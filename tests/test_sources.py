"""Sources: CSV with the users-fixture shape, snapshot events, topic selection."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.session import fresh_dir
from vaultline.sources import cdc

USERS_SCHEMA = T.StructType([
    T.StructField("user_external_id", T.StringType()), T.StructField("email", T.StringType()),
    T.StructField("first_name", T.StringType()), T.StructField("last_name", T.StringType()),
    T.StructField("phone", T.StringType()), T.StructField("date_of_birth", T.DateType()),
    T.StructField("registration_date", T.TimestampNTZType()), T.StructField("status", T.StringType()),
    T.StructField("effective_from", T.TimestampNTZType()), T.StructField("effective_to", T.TimestampNTZType()),
    T.StructField("is_current", T.BooleanType()),
])

# invented rows in the fixture's shape: mixed Latin/Cyrillic, free-format phones, one inactive user
CSV = """user_external_id,email,first_name,last_name,phone,date_of_birth,registration_date,status,effective_from,effective_to,is_current
0b4e7a52-1111-4c1e-9a51-000000000001,anna@example.org,Анна,Смирнова,+7 (900) 000-00-01,1990-04-12,2022-11-15 21:19:17,active,2022-11-15 21:19:17,9999-12-31 23:59:59,True
0b4e7a52-1111-4c1e-9a51-000000000002,"doe, j@example.org",John,"O'Hara, Jr.",555-0102,1985-01-30,2023-02-01 08:00:00,inactive,2023-02-01 08:00:00,9999-12-31 23:59:59,True
"""


def test_csv_honours_quotes_and_types(spark):
    path = fresh_dir(spark, "t-csv")
    with open(f"{path}/users.csv", "w", encoding="utf-8") as f:
        f.write(CSV)
    rows = cdc.read_csv(spark, f"{path}/users.csv", USERS_SCHEMA).orderBy("user_external_id").collect()
    assert len(rows) == 2
    assert rows[0]["first_name"] == "Анна" and str(rows[0]["date_of_birth"]) == "1990-04-12"
    assert str(rows[0]["registration_date"]) == "2022-11-15 21:19:17" and rows[0]["is_current"] is True
    assert rows[1]["email"] == "doe, j@example.org" and rows[1]["last_name"] == "O'Hara, Jr."
    assert rows[1]["status"] == "inactive"


def test_snapshot_events_and_topic_selection(spark, model):
    src = model.source("users")
    rows = spark.createDataFrame([("u1", "Анна", None)], "user_external_id string, first_name string, status string")
    ev = cdc.snapshot_to_events(rows, src, offset=F.lit(7), timestamp=F.expr("TIMESTAMP_NTZ'2024-01-02 03:04:05.678'"),
                                wrapped=F.lit(True))
    r = ev.first()
    assert r["topic"] == "user_service.public.users" and r["offset"] == 7
    msg = json.loads(r["value"])
    assert msg["payload"]["op"] == "r"
    assert msg["payload"]["after"] == {"user_external_id": "u1", "first_name": "Анна", "status": None}
    both = ev.unionByName(cdc.snapshot_to_events(
        spark.createDataFrame([("p1",)], "product_sku string"), model.source("products"),
        offset=F.lit(1), timestamp=F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")))
    assert [x["topic"] for x in cdc.select_topics(both, service="order_service", model=model).collect()] == \
        ["order_service.public.products"]
