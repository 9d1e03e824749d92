"""The queries op1 to op10: each applies one operator to its whole table."""

from __future__ import annotations

from tollway.llm import decontaminate, extract, licenses, mixing, quality, secrets, sharding, simhash, sql, substrings, suffixes
from tollway.llm.common import table


def op7_quality_rules(spark, sf_dir):
    return quality.measure(table(spark, sf_dir, "documents"))


def op1_suffix_dedup(spark, sf_dir):
    return suffixes.dedup(table(spark, sf_dir, "documents"), texts=False).drop("kept")


def op2_html_extraction(spark, sf_dir):
    return extract.extract(table(spark, sf_dir, "pages"))


def op3_decontamination(spark, sf_dir):
    return decontaminate.match(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op5_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_sharding(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark, sf_dir):
    out = substrings.dedup(table(spark, sf_dir, "documents"), texts=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256", "n_spans")


def op9_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_simhash_dedup(spark, sf_dir):
    return simhash.link(table(spark, sf_dir, "documents"))


def queries() -> dict:
    found = (op1_suffix_dedup, op2_html_extraction, op3_decontamination, op4_secret_scan, op5_source_mixing, op6_sharding, op7_quality_rules, op8_substring_dedup, op9_license_scan, op10_simhash_dedup)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict:
    return {
        "op3_decontamination": sql.OP3,
        "op7_quality_rules": sql.OP7.replace("{stop}", " ".join(quality.STOP_WORDS)),
        "op8_substring_dedup": sql.OP8,
        "op9_license_scan": sql.op9(licenses.PHRASES, licenses.TEMPLATES, licenses.NEEDED),
    }
