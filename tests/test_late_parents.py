"""Children without a parent in time, over restarts of two joined streams."""

from pyspark.sql import functions as F

from vaultline.session import fresh_dir
from vaultline.streaming.late_parents import follow, missing_parents

KIND = "k string, id int, at timestamp"


def test_children_are_reported_once_and_only_without_a_parent_in_time(spark):
    folder = {x: fresh_dir(spark, f"t-{x}") for x in ("child", "parent")}
    out = fresh_dir(spark, "t-late")

    def deliver(kind, rows):
        spark.createDataFrame([(k, i, f"2024-01-{day:02d} {hour:02d}:00:00") for k, i, day, hour in rows], "k string, id int, t string") \
            .select("k", "id", F.to_timestamp("t").alias("at")).coalesce(1).write.mode("append").json(folder[kind])

    def run():
        c, p = (spark.readStream.schema(KIND).json(folder[x]) for x in ("child", "parent"))
        follow(missing_parents(c, p, "k", "at", "2 HOURS", "1 hour"), f"{out}/report", f"{out}/_checkpoint").awaitTermination()
        return sorted(r["id"] for r in spark.read.schema(KIND).parquet(f"{out}/report").collect())

    deliver("child", [("early", 1, 1, 10), ("late", 2, 1, 10), ("none", 3, 1, 10), ("far", 4, 1, 10), (None, 5, 1, 10), ("twice", 6, 1, 10)])
    deliver("parent", [("early", 0, 1, 9), ("far", 0, 1, 7), ("twice", 0, 1, 10), ("twice", 0, 1, 11)])
    assert not set(run()) & {1, 2, 6}
    deliver("parent", [("late", 0, 1, 12)])  # after its child, within two hours
    run()
    deliver("child", [("end", 9, 9, 0)])
    deliver("parent", [("other", 0, 9, 0)])
    assert run() == [3, 4, 5]
    assert run() == [3, 4, 5]
