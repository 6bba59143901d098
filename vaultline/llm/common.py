"""Helpers shared by the training-data operators: tables, written intermediates, the word pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir

#: A word is a run of anything but ASCII white space.
SPACE_CLASS = r"[ \t\n\x0B\f\r]"
WORD = r"[^ \t\n\x0B\f\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors.

    Values that are not repeatable (row ids) are fixed by the write.
    """
    spark = df.sparkSession
    path = f"{fresh_dir(spark, name)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in Arrow batches of 8 MB at most, unless the session has a setting of its own.

    Spark's default of 64 MB is held several times over by each task, on both sides of the pipe.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, "8m")


def text_of(column: str | Column = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def packed(docs: DataFrame) -> DataFrame:
    """``(_doc, _t)``: the whole row as one struct, so that no column of it can clash with ours, and its text."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       text_of("text").alias("_t"))


def id_mod(mod: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)
