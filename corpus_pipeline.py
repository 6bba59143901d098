"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

Each stage calls one training-data operator on everything its predecessor kept:

1. ``quality_rules``: lines that fail the rules go, documents that are rejected go;
2. ``near_dedup``: one document of every class of near duplicates stays, the one with the smallest id;
3. ``decontaminate``: documents of which a twentieth or more lies in benchmark windows go;
4. ``pii``: personal data is replaced by its kind in angle brackets;
5. ``mix``: a row for each pass over a document, so that sources meet their target weights.

The last stage adds ``epoch`` and ``take_words`` to the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaultline.llm import dartminhash, decontaminate, mixing, pii, quality
from vaultline.llm.common import saved, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dartminhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminated),
          ("pii", without_pii), ("mix", mixed)]

#: Classes of near duplicates are connected components of similarities, which one SQL statement cannot build over
#: whole tables at a bearable cost; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
