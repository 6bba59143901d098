"""The kept cohort report equals the full recomputation after every batch."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vaultline.plans import cohort as C
from vaultline.session import fresh_dir
from vaultline.streaming.cohort_view import CohortView

KIND = "user_external_id string, day string, total_amount decimal(18,2)"


def orders(spark, rows):
    rows = [(u, d, None if x is None else Decimal(x)) for u, d, x in rows]
    return spark.createDataFrame(rows, KIND).withColumn("order_date", F.to_timestamp_ntz("day")).drop("day")


def batches(seed):
    """Five batches; later ones hold earlier first orders, users and dates may be unknown, amounts missing."""
    rng = random.Random(seed)
    out = []
    for b in range(5):
        rows = []
        for _ in range(rng.randint(0, 60)):
            month = rng.randint(1, 18 - 3 * b)
            rows.append((rng.choice([None, *[f"u{i}" for i in range(25)]]),
                         None if rng.random() < 0.05 else f"{2022 + (month - 1) // 12}-{(month - 1) % 12 + 1:02d}-{rng.randint(1, 28):02d} 10:00:00",
                         None if rng.random() < 0.1 else Decimal(rng.randint(0, 9999)) / 100))
        out.append(rows)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_equals_the_full_report_after_each_batch(spark, seed):
    view, so_far = CohortView(spark, fresh_dir(spark, "t-view")), []
    for b, rows in enumerate(batches(seed)):
        so_far += rows
        view.apply(orders(spark, rows), b)
        if b == 3:
            view.apply(orders(spark, rows), b)  # a replay
        want = C.cohort_report(orders(spark, so_far)).collect()
        assert view.report().collect() == want


def test_a_late_first_order_moves_a_user(spark):
    view = CohortView(spark, fresh_dir(spark, "t-move"))
    view.apply(orders(spark, [("a", "2024-05-03 00:00:00", 10), ("b", "2024-05-04 00:00:00", 5)]), 0)
    assert [(str(r["cohort_month"])[:7], r["cohort_size"]) for r in view.report().collect()] == [("2024-05", 2)]
    view.apply(orders(spark, [("a", "2024-03-01 00:00:00", 1)]), 1)
    got = [(str(r["cohort_month"])[:7], r["cohort_size"], float(r["total_cohort_revenue"])) for r in view.report().collect()]
    assert got == [("2024-03", 1, 11.0), ("2024-05", 1, 5.0)]
    view.apply(orders(spark, [("b", "2024-03-09 00:00:00", 2)]), 2)  # its old cohort is empty now and has no row
    got = [(str(r["cohort_month"])[:7], r["cohort_size"], float(r["total_cohort_revenue"])) for r in view.report().collect()]
    assert got == [("2024-03", 2, 18.0)]


def test_follows_a_stream(spark):
    root = fresh_dir(spark, "t-follow")
    view, rows = CohortView(spark, f"{root}/view"), [r for b in batches(9) for r in b]
    for part in (rows[::2], rows[1::2]):
        spark.createDataFrame(part, KIND).coalesce(1).write.mode("append").json(f"{root}/orders")
        stream = spark.readStream.schema(KIND).json(f"{root}/orders").withColumn("order_date", F.to_timestamp_ntz("day")).drop("day")
        view.follow(stream, f"{root}/checkpoint").awaitTermination()
    assert view.report().collect() == C.cohort_report(orders(spark, rows)).collect()
