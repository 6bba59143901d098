"""The cohort report kept up to date from a stream of orders, without reading the orders again.

State under a root folder, a folder for each batch of both tables:

    months/batch_id=<n>/    what the batch adds to (user, month): revenue, orders
    cohorts/batch_id=<n>/   what it adds to a cohort's size, activity and revenue

A batch changes its own users only.  Their months before the batch give what they contributed to cohorts so far, which
is taken back, and their months with it give what they contribute now; when an earlier first order arrives late, a user
so moves from one cohort to another with everything bought since.  The report is a sum over the small cohort deltas.

A batch reads the months of earlier batches only and replaces its own folders, so a replay of the last batch changes
nothing; batches come in order.  The users of a batch are joined to the state by a semi-join of distinct keys, and a
user with very many orders is a row for each month and task before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import cohort as C

MONTHS = T.StructType([
    T.StructField(C.USER, T.StringType()), T.StructField("month", T.TimestampNTZType()),
    T.StructField("revenue", T.DecimalType(38, 2)), T.StructField("orders", T.LongType()), T.StructField("batch_id", T.LongType())])


class CohortView:
    def __init__(self, spark: SparkSession, root: str, months: int = C.PERIODS):
        self.spark, self.root, self.months = spark, root.rstrip("/"), months
        self.counts = ["members", "paid", "cohort_size", *[f"period_{i}_active" for i in range(months)]]

    def _read(self, table: str, schema: T.StructType) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")

    def _contribution(self, summed: DataFrame, sign: int) -> DataFrame:
        """What users' months add to (1) or take from (-1) their cohorts.

        ``members`` counts all users of a cohort, the unknown one included, and ``paid`` the months with an amount: a
        cohort without members has no row, one without amounts no revenue.
        """
        um = C.aged(summed, self.months)
        first = (F.col("age") == 0) | F.col("cohort_month").isNull()
        sums = C.cohort_sums(um, self.months, F.count(F.when(first, 1)).alias("members"),
                             F.count(F.when(F.col("in_window") & F.col("revenue").isNotNull(), 1)).alias("paid"))
        return sums.select("cohort_month", *[(F.col(c) * sign).alias(c) for c in self.counts],
                           (F.coalesce("total_cohort_revenue", F.lit(0)) * sign).cast("decimal(38,2)").alias("revenue"))

    def apply(self, orders: DataFrame, batch_id: int) -> None:
        """Add a batch of orders (user, order_date, total_amount)."""
        own = f"{self.root}/months/batch_id={int(batch_id)}"
        C.monthly(orders).select(F.col(C.USER).cast("string").alias(C.USER), F.col("month").cast("timestamp_ntz").alias("month"),
                                 F.col("revenue").cast("decimal(38,2)").alias("revenue"), "orders").write.mode("overwrite").parquet(own)
        state = self._read("months", MONTHS)
        added = state.where(F.col("batch_id") == int(batch_id)).drop("batch_id")
        users = added.select(F.col(C.USER).alias("u")).distinct()
        before = state.where(F.col("batch_id") < int(batch_id)).drop("batch_id") \
            .join(users, F.col(C.USER).eqNullSafe(F.col("u")), "left_semi")

        def together(rows: DataFrame) -> DataFrame:
            return rows.groupBy(C.USER, "month").agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
        changes = self._contribution(together(before.unionByName(added)), 1).unionByName(self._contribution(together(before), -1))
        changes.groupBy("cohort_month").agg(*[F.sum(c).alias(c) for c in [*self.counts, "revenue"]]) \
            .coalesce(1).write.mode("overwrite").parquet(f"{self.root}/cohorts/batch_id={int(batch_id)}")  # a row for each cohort

    def report(self) -> DataFrame:
        """The columns of ``cohort_report`` over all batches."""
        schema = T.StructType([T.StructField("cohort_month", T.TimestampNTZType()), *[T.StructField(c, T.LongType()) for c in self.counts],
                               T.StructField("revenue", T.DecimalType(38, 2)), T.StructField("batch_id", T.LongType())])
        sums = self._read("cohorts", schema).groupBy("cohort_month").agg(*[F.sum(c).alias(c) for c in [*self.counts, "revenue"]])
        return C.report_of(sums.where("members > 0").withColumn("total_cohort_revenue", F.when(F.col("paid") > 0, F.col("revenue"))),
                           self.months)

    def follow(self, orders: DataFrame, checkpoint: str, **trigger):
        """Keep the view up to date from a streaming frame of orders; returns the query."""
        return orders.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint) \
            .trigger(**(trigger or {"availableNow": True})).start()
