"""Change-event sources.

* ``read_cdc_stream``: a streaming DataFrame in the Kafka record shape
  ``(topic, partition, offset, timestamp, value)``.  With a Kafka connector on
  the classpath it subscribes to the topics from the earliest offset; without
  one, it reads JSON-lines files of the same columns from a folder (the tested
  path), one file per arrival.
* ``snapshot_to_events``: rows of an existing table as ``op = 'r'`` events, the
  initial snapshot a change-capture connector emits before live changes.
* ``select_topics``: the include list of one service.
* ``read_csv``: a header CSV with a fixed schema (quotes honoured).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import epoch_millis
from ..model import SourceTable, VaultModel
from ..operators.decode import EVENT_SCHEMA

# event files carry exactly the Kafka record columns
FILE_EVENT_SCHEMA = EVENT_SCHEMA


def read_cdc_stream(spark: SparkSession, topics: list[str], *, path: str | None = None,
                    kafka_options: dict | None = None, max_files_per_trigger: int | None = None,
                    starting_offsets: str = "earliest", group_id: str | None = None) -> DataFrame:
    """Streaming change events of ``topics``, earliest first.

    ``kafka_options`` (e.g. ``{"kafka.bootstrap.servers": ...}``) selects the
    Kafka source; otherwise ``path`` is a folder of JSON-lines event files.
    Offsets are tracked in the query checkpoint; ``group_id`` only names the
    consumer group on the broker (for monitoring and quotas).
    """
    if kafka_options is not None:
        reader = (spark.readStream.format("kafka")
                  .option("subscribe", ",".join(topics))
                  .option("startingOffsets", starting_offsets))
        if group_id:
            reader = reader.option("kafka.group.id", group_id)
        df = reader.options(**kafka_options).load()
        return df.select("topic", "partition", "offset", "timestamp",
                         F.col("value").cast("string").alias("value"))
    if path is None:
        raise ValueError("give kafka_options or a path of event files")
    reader = spark.readStream.schema(FILE_EVENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return select_topics(reader.json(path), topics=topics)


def read_cdc_batch(spark: SparkSession, path: str) -> DataFrame:
    """The same event files read as a bounded DataFrame (replays, backfills)."""
    return spark.read.schema(FILE_EVENT_SCHEMA).json(path)


def event_value(src: SourceTable, rows: DataFrame, op: Column | str = "r",
                wrapped: Column | None = None, deleted: Column | None = None) -> Column:
    """JSON change-event text for wire rows of ``src`` (only columns the rows carry)."""
    have = [f for f in src.wire_schema.fields if f.name in set(rows.columns)]
    after = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in have])
    if deleted is not None:
        after = F.when(~deleted, after)
    op_col = F.lit(op) if isinstance(op, str) else op
    env = F.struct(op_col.alias("op"), F.lit(None).cast("string").alias("before"), after.alias("after"))
    bare = F.to_json(env, {"ignoreNullFields": "false"})
    if wrapped is None:
        return bare
    return F.when(wrapped, F.concat(F.lit('{"payload":'), bare, F.lit("}"))).otherwise(bare)


def snapshot_to_events(rows: DataFrame, src: SourceTable, *, offset: Column,
                       timestamp: Column, partition: Column | None = None,
                       wrapped: Column | None = None, deleted: Column | None = None,
                       op: Column | str = "r") -> DataFrame:
    """Rows of ``src`` as change events in the Kafka record shape."""
    return rows.select(
        F.lit(src.topic).alias("topic"),
        (partition if partition is not None else F.lit(0)).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        # Kafka record timestamps are epoch milliseconds; ``timestamp`` is a UTC wall time
        F.timestamp_millis(epoch_millis(timestamp)).alias("timestamp"),
        event_value(src, rows, op=op, wrapped=wrapped, deleted=deleted).alias("value"),
    )


def read_jdbc_snapshot(spark: SparkSession, url: str, table: str, *, partition_column: str,
                       lower_bound: int, upper_bound: int, num_partitions: int,
                       properties: dict | None = None) -> DataFrame:
    """An operational table read in parallel ranges of ``partition_column``.

    Feed the result to ``snapshot_to_events`` (``op='r'``) to load existing rows
    before live changes.  Not exercised in this repository's tests (no database
    is started here); the call is Spark's standard partitioned JDBC read.
    """
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                           upperBound=upper_bound, numPartitions=num_partitions,
                           properties=dict(properties or {}))


def select_topics(events: DataFrame, *, service: str | None = None,
                  topics: list[str] | None = None, model: VaultModel | None = None) -> DataFrame:
    """Keep the events of one service's include list (or an explicit topic list)."""
    if topics is None:
        if service is None or model is None:
            raise ValueError("give topics, or service and model")
        topics = model.topics_of(service)
    return events.where(F.col("topic").isin(list(topics)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A header CSV with a fixed schema.

    Quoted fields may hold commas, doubled quotes, backslashes (plain characters) and line breaks; for the line
    breaks a file is read as a whole by one task, so large inputs should come as many files.
    """
    return (spark.read.option("header", True).option("mode", "PERMISSIVE")
            .option("quote", '"').option("escape", '"').option("multiLine", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .schema(schema).csv(path))


__all__ = ["EVENT_SCHEMA", "FILE_EVENT_SCHEMA", "read_cdc_stream", "read_cdc_batch",
           "snapshot_to_events", "select_topics", "read_csv", "event_value", "read_jdbc_snapshot"]
