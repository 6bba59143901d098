"""A snapshot of a live table in chunks, merged with the changes that arrive while it is read.

The table is read in ranges of its key.  Around each chunk the end of the change log is noted, before (*low* mark) and
after (*high* mark).  The chunk shows every change up to the low mark and some of those between the marks, so

* a row whose key changed between its chunk's marks is dropped: the log has its final value, and
* the other rows take their place in the log at the high mark, before all later changes.

The merged feed, applied in the order of its positions, ends in the state of the table, without a lock on it.  Chunks
are written as they are read, with their marks last; a snapshot that is started again goes on with the first chunk that
has none.  Only the marks are seen by the driver; merging is a job over all chunks and the log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A log position is an event's offset times 2 ** ROW_BITS; the rows of a chunk take the numbers in between.
ROW_BITS = 20
#: Marks meet changes by blocks of 2 ** BLOCK_BITS offsets.
BLOCK_BITS = 12
MARKS = "chunk int, low bigint, high bigint"


def chunk_bounds(rows: DataFrame, key: str, chunks: int) -> list:
    """At most ``chunks`` - 1 values of a numeric key that cut the rows into ranges of about equal size."""
    if chunks < 2:
        return []
    cuts = [i / chunks for i in range(1, chunks)]
    found = rows.agg(F.percentile_approx(key, cuts, max(10_000, 20 * chunks)).alias("b")).first()["b"]
    return sorted(set(found or []))


class ChunkedSnapshot:
    """Reads ``read(lower, upper)`` (key >= lower and < upper; None: open) chunk by chunk into ``folder``.

    ``log_end()`` is the last offset of the table's change log at that moment.
    """

    def __init__(self, spark: SparkSession, folder: str, bounds: list, read: Callable[[object, object], DataFrame],
                 log_end: Callable[[], int]):
        self.spark, self.folder, self.read, self.log_end = spark, folder.rstrip("/"), read, log_end
        edges = [None, *bounds, None]
        self.ranges = list(zip(edges[:-1], edges[1:]))

    def _done(self, chunk: int) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/marks/part={chunk}/_SUCCESS")
        return bool(path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path))

    def run(self) -> int:
        """Read the chunks that have no marks yet; returns how many those were."""
        fresh = 0
        for chunk, (lower, upper) in enumerate(self.ranges):
            if self._done(chunk):
                continue
            low = self.log_end()
            self.read(lower, upper).write.mode("overwrite").parquet(f"{self.folder}/rows/chunk={chunk}")
            high = self.log_end()
            self.spark.createDataFrame([(chunk, low, high)], MARKS).coalesce(1).write.mode("overwrite").json(f"{self.folder}/marks/part={chunk}")
            fresh += 1
        return fresh

    def marks(self) -> DataFrame:
        """(chunk, low, high), a row for each chunk."""
        return self.spark.read.schema(MARKS).json([f"{self.folder}/marks/part={i}" for i in range(len(self.ranges))])

    def rows(self) -> DataFrame:
        """The chunks' rows, with their ``chunk``."""
        return self.spark.read.parquet(f"{self.folder}/rows")


def at_offset(offset: Column) -> Column:
    """The position of an event of the log in the merged feed."""
    return F.shiftleft(offset.cast("bigint"), ROW_BITS)


def superseded(changes: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """(key, chunk): keys with a change between a chunk's marks.

    Marks are spread over the blocks of offsets that they cover, so a change meets the marks of its block only; a key
    with very many changes is one row per task and chunk before the shuffle.
    """
    spread = marks.where("high > low").select("chunk", "low", "high", F.explode(F.sequence(
        F.shiftright(F.col("low") + 1, BLOCK_BITS), F.shiftright("high", BLOCK_BITS))).alias("block"))
    c = changes.select(F.col(key).alias("key"), "offset", F.shiftright("offset", BLOCK_BITS).alias("block"))
    return c.join(spread, "block").where((F.col("offset") > F.col("low")) & (F.col("offset") <= F.col("high"))) \
        .select(F.col("key").alias(key), "chunk").distinct()


def merged_rows(snapshot: ChunkedSnapshot, changes: DataFrame, key: str) -> DataFrame:
    """The chunks' rows that stand, with ``position``: their place in the feed.

    ``changes`` (``key``, ``offset``, ...) is the log over the time of the snapshot.  Rows of a chunk are numbered in the
    order of their key; a chunk of 2 ** ROW_BITS rows or more is refused.  Chunks between which the log did not grow share
    their positions, never for one key.
    """
    marks = snapshot.marks()
    keep = snapshot.rows().join(superseded(changes, marks, key), [key, "chunk"], "left_anti").join(marks, "chunk")
    number = F.row_number().over(Window.partitionBy("chunk").orderBy(key))
    number = F.when(number < (1 << ROW_BITS), number).otherwise(F.raise_error(F.lit("a chunk of a snapshot is too large")).cast("int"))
    return keep.withColumn("position", at_offset(F.col("high")) + number).drop("chunk", "low", "high")
