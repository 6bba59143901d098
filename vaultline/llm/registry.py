"""The training-data queries and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

import corpus_pipeline

from . import (dartminhash, decontaminate, lm, merkle, mixing, pii, pivotal, quality, superkmer, template, toollink, toxicity,
               warc)

QUERIES = {
    "op1_kneser_ney": lm.op1_kneser_ney,
    "op2_dart_minhash": dartminhash.op2_dart_minhash,
    "op3_source_mix": mixing.op3_source_mix,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_pii": pii.op5_pii,
    "op6_substring_dedup": superkmer.op6_substring_dedup,
    "op7_tool_links": toollink.op7_tool_links,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op10_warc": warc.op10_warc,
    "op9_quality_rules": quality.op9_quality_rules,
    "op11_spelling_variants": pivotal.op11_spelling_variants,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_html_extraction": template.op13_html_extraction,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op3_source_mix": mixing.ORACLE,
    "op6_substring_dedup": superkmer.ORACLE,
    "op7_tool_links": toollink.ORACLE,
    "op10_warc": warc.ORACLE,
    "op11_spelling_variants": pivotal.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    if corpus_pipeline.ORACLE_SQL:
        return {**ORACLES, "pipeline": corpus_pipeline.ORACLE_SQL}
    return dict(ORACLES)
