"""Queries of the operators in this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from glossmill.llm import formatdup, labelmap, leakage, mixing, neardup, normalize, oracles, reading
from glossmill.session import spread, table

# The columns that the operators read of the large tables.
COLUMNS = {
    "dictionary_entry_parsed": ("dictionary_entry_parsed_id", "definition", "domain", "usage_label"),
    "dictionary_entry_synonym": ("dictionary_entry_synonym_id", "dictionary_entry_parsed_id", "synonym_text", "source_code"),
    "documents": ("doc_id", "text", "source", "lang"),
}


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spread(table(spark, d, name).select(*COLUMNS[name]))


def _lexicon(op: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: op(_table(spark, d, "dictionary_entry_parsed"), _table(spark, d, "dictionary_entry_synonym"))


def _labels(op: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: op(_table(spark, d, "dictionary_entry_parsed"), table(spark, d, "label_catalog"))


def _leaks(op: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: op(_table(spark, d, "documents"), table(spark, d, "eval_item"))


def _levels(op: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: op(_table(spark, d, "documents"), table(spark, d, "doc_rating"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": lambda spark, d: neardup.found(_table(spark, d, "dictionary_entry_parsed")),
    "p1_links": lambda spark, d: neardup.links(_table(spark, d, "dictionary_entry_parsed")),
    "p1_groups": lambda spark, d: neardup.groups(_table(spark, d, "dictionary_entry_parsed")),
    "p3_found": _lexicon(normalize.found),
    "p3_forms": _lexicon(lambda p, s: normalize.forms(p, s).select("field", "row_id", "form").distinct()),
    "p4_found": _labels(labelmap.found),
    "p4_report": _labels(labelmap.report),
    "p5_found": _lexicon(formatdup.found),
    "p5_records": _lexicon(formatdup.collapsed),
    "p6_found": _leaks(leakage.found),
    "p6_overlaps": _leaks(leakage.overlaps),
    "p6_items": _leaks(leakage.leaked),
    "p7_mix": lambda spark, d: mixing.mixed(_table(spark, d, "documents"), table(spark, d, "mix_target")),
    "p7_shares": lambda spark, d: mixing.shares(_table(spark, d, "documents"), table(spark, d, "mix_target")),
    "p8_levels": _levels(reading.levels),
    "p8_profile": _levels(reading.profile),
    "p8_agreement": _levels(reading.agreement),
}

ORACLES: dict[str, str] = oracles.SQL
