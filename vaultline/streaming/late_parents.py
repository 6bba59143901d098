"""Children whose parent did not come in time: a side report of the stream, beside the load.

The load is stateless and accepts children before their parents.  This report joins the two streams with an outer join
that Spark bounds by watermarks: a child waits in the state store until no parent within ``window`` of it can come any
more, and is reported once if none came.  A parent before the child counts as well as one after it.  State is what lies
within the window (and the streams' delay) of the newest events, whatever the length of the streams; for large windows
set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_parents(children: DataFrame, parents: DataFrame, key: str, at: str, window: str, delay: str) -> DataFrame:
    """Rows of ``children`` (a stream) without a row of ``parents`` (a stream) of the same ``key`` within ``window``.

    ``at`` is the event time of both, and ``delay`` how far their events may come out of order.  Rows without a key have
    no parent and are reported; rows without a time are dropped with the watermark's first step.
    """
    c = children.withWatermark(at, delay).alias("c")
    p = parents.select(F.col(key).alias("_key"), F.col(at).alias("_at")).withWatermark("_at", delay).alias("p")
    near = F.expr(f"p._at >= c.`{at}` - INTERVAL {window} AND p._at <= c.`{at}` + INTERVAL {window}")
    return c.join(p, (F.col(f"c.{key}") == F.col("p._key")) & near, "left_outer").where(F.col("p._at").isNull()) \
        .drop("_key", "_at")


def follow(report: DataFrame, path: str, checkpoint: str, **trigger):
    """Append a report to a folder; the sink's log keeps it exactly once over restarts."""
    return report.writeStream.format("parquet").outputMode("append").option("path", path) \
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
