"""Change-event decoding: envelope unwrap, delete skipping, key checks, rejects.

A raw change event has the Kafka record shape
``(topic, partition, offset, timestamp, value)`` with a JSON ``value``
``{"op": .., "before": .., "after": {...}}``, optionally wrapped in
``{"payload": {...}}``.  Decoding yields one row per event:

    topic, partition, offset, load_dt, op, after (struct, wire types), reject

``reject`` is NULL for a good event, else a reason (``malformed_json``,
``missing_business_key``, ``bad_value``).  Only ``after`` is read; ``before``
is never used.  Deletes (``after`` NULL or ``{}``) and tombstones (a NULL
value, the log-compaction marker after a delete) are dropped by
``skip_deletes`` and counted as deletes.  An ``after`` that only carries fields
the model does not know is no delete: it is decoded with all fields NULL and
rejected for its missing key, so that a renamed column is noticed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import coerce_typed
from ..model import SourceTable

EVENT_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.StringType()),
])

def envelope_schema(src: SourceTable) -> T.StructType:
    after = src.wire_schema
    inner = T.StructType([T.StructField("op", T.StringType()), T.StructField("after", after)])
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("after", after),
        T.StructField("payload", inner),
        T.StructField("_malformed", T.StringType()),
    ])


def record_time_utc(ts: Column) -> Column:
    """A record timestamp (an instant) as its UTC wall time, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts),
                           F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def unwrap(parsed: Column) -> tuple[Column, Column]:
    """(op, after) of a parsed envelope: ``payload`` if present, else the message."""
    wrapped = parsed["payload"].isNotNull()
    op = F.when(wrapped, parsed["payload"]["op"]).otherwise(parsed["op"])
    after = F.when(wrapped, parsed["payload"]["after"]).otherwise(parsed["after"])
    return op, after


def decode_topic(events: DataFrame, src: SourceTable, keep_value: bool = False) -> DataFrame:
    """Decode the events of one topic against its wire schema (one pass, no shuffle).

    ``keep_value`` carries the raw JSON along (for the quarantine of rejects).
    """
    ev = events.where(F.col("topic") == src.topic)
    parsed = F.from_json(F.col("value").cast("string"), envelope_schema(src),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"})
    ev = ev.withColumn("_p", parsed)
    op, after = unwrap(F.col("_p"))
    # no known field is set: an empty image is a delete, one with other fields is not
    text = F.col("value").cast("string")
    raw = F.coalesce(F.get_json_object(text, "$.payload.after"), F.get_json_object(text, "$.after"))
    unset = F.lit(True)
    for f in src.wire_schema.fields:
        unset = unset & after[f.name].isNull()
    after = F.when(~(unset & (F.coalesce(raw, F.lit("{}")).rlike(r"^\s*\{\s*\}\s*$"))), after)
    reject = F.when(F.col("value").isNotNull() & (F.col("_p").isNull() | F.col("_p._malformed").isNotNull()),
                    F.lit("malformed_json"))
    extra = [F.col("value")] if keep_value else []
    return ev.select(
        "topic", "partition", "offset",
        record_time_utc(F.col("timestamp")).alias("load_dt"),
        op.alias("op"), after.alias("after"), reject.alias("reject"), *extra)


def rows_to_decoded(rows: DataFrame, src: SourceTable, *, offset: Column, load_dt: Column,
                    deleted: Column | None = None, partition: Column | None = None,
                    op: str = "r") -> DataFrame:
    """Wire-typed source rows packed as decoded events of ``src`` (no JSON round trip).

    Fields of the wire schema that ``rows`` lacks become NULL (a missing
    attribute), exactly as an event without that key decodes.
    """
    have = set(rows.columns)
    fields = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
              for f in src.wire_schema.fields]
    after = F.struct(*fields)
    if deleted is not None:
        after = F.when(~deleted, after)
    return rows.select(
        F.lit(src.topic).alias("topic"),
        (partition if partition is not None else F.lit(0)).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        load_dt.cast("timestamp_ntz").alias("load_dt"),
        (F.when(deleted, F.lit("d")).otherwise(F.lit(op)) if deleted is not None else F.lit(op)).alias("op"),
        after.alias("after"),
        F.lit(None).cast("string").alias("reject"),
    )


def is_empty_after(after: Column, src: SourceTable) -> Column:
    """``after`` is NULL: the decoder makes it so for a missing image and for ``{}``."""
    return after.isNull()


def skip_deletes(decoded: DataFrame, src: SourceTable) -> DataFrame:
    """Drop deletes and empty images; they leave the vault as it is."""
    return decoded.where(F.col("reject").isNotNull() | ~is_empty_after(F.col("after"), src))


def present(c: Column) -> Column:
    """A usable key: not NULL and not the empty string (falsy keys are skipped)."""
    return c.isNotNull() & (c.cast("string") != F.lit(""))


def require_key(df: DataFrame, c) -> DataFrame:
    col = F.col(c) if isinstance(c, str) else c
    return df.where(present(col))


def bad_values(src: SourceTable, attrs) -> Column:
    """True when a wire value is set but cannot be typed into its vault column."""
    bad = F.lit(False)
    for a in attrs:
        w = F.col(f"after.{a.name}")
        bad = bad | (w.isNotNull() & coerce_typed(w, a.declared).isNull())
    return bad


def classify(decoded: DataFrame, src: SourceTable, attrs=()) -> DataFrame:
    """Fill ``reject`` for events that cannot be loaded at all.

    Malformed JSON is already marked by the decoder.  A hub
    table's event without its business key, and a value its declared type
    cannot hold, are rejected here.  Deletes are not rejects.
    """
    reason = F.col("reject")
    live = ~is_empty_after(F.col("after"), src)
    if src.business_key is not None:
        missing = F.col(f"after.{src.business_key.name}").isNull()
    else:  # a table without a hub of its own: nothing the model knows is set
        missing = F.lit(True)
        for f in src.wire_schema.fields:
            missing = missing & F.col(f"after.{f.name}").isNull()
    reason = F.coalesce(reason, F.when(live & missing, F.lit("missing_business_key")))
    if attrs:
        reason = F.coalesce(reason, F.when(live & bad_values(src, attrs), F.lit("bad_value")))
    return decoded.withColumn("reject", reason)


def split_rejects(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): two filters over the same classified frame.

    Persist the input first when both sides are consumed, so the source is
    read once.
    """
    return decoded.where(F.col("reject").isNull()), decoded.where(F.col("reject").isNotNull())
