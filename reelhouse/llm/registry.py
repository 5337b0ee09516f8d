"""Registered queries of this package and their DuckDB text, where SQL can express them."""

from __future__ import annotations

from . import (collocations, decontaminate, html_wrappers, jaccard_join, language_id, license_scan, lm_scoring, mixing,
               quality_rules, simhash_join, spelling, substring_dedup, toxicity)
from .common import table

QUERIES = {
    "op1_source_mixing": lambda spark, sf: mixing.taken(table(spark, sf, "documents")),
    "op2_language_id": lambda spark, sf: language_id.identify(table(spark, sf, "documents")),
    "op3_lm_scoring": lambda spark, sf: lm_scoring.cross_entropy_difference(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op4_toxicity": lambda spark, sf: toxicity.toxicity(
        table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op5_substring_dedup": lambda spark, sf: substring_dedup.dedup_digest(table(spark, sf, "documents")),
    "op6_license_scan": lambda spark, sf: license_scan.scan(table(spark, sf, "documents")),
    "op7_decontamination": lambda spark, sf: decontaminate.contamination(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op8_quality_rules": lambda spark, sf: quality_rules.verdicts(table(spark, sf, "documents")),
    "op9_html_wrappers": lambda spark, sf: html_wrappers.extract_all(table(spark, sf, "pages")),
    "op10_jaccard_join": lambda spark, sf: jaccard_join.similar_groups(table(spark, sf, "documents")),
    "op11_simhash_join": lambda spark, sf: simhash_join.near_duplicates(table(spark, sf, "documents")),
    "op12_collocations": lambda spark, sf: collocations.collocations(table(spark, sf, "documents")),
    "op13_spelling": lambda spark, sf: spelling.variants(table(spark, sf, "documents")),
}

ORACLE = {
    "op5_substring_dedup": substring_dedup.SQL,
    "op7_decontamination": decontaminate.SQL,
    "op10_jaccard_join": jaccard_join.SQL,
    "op12_collocations": collocations.SQL,
}
