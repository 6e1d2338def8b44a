"""Checks on the tables: hard failures after a merge, coverage, and one summary of all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import text


def _rows(checks: list[tuple[str, str, DataFrame, Column]], warn: int = 0) -> DataFrame:
    out = None
    for phase, name, df, n in checks:
        one = df.agg(n.cast("long").alias("failures")).select(F.lit(phase).alias("phase"), F.lit(name).alias("check_name"), "failures")
        out = one if out is None else out.unionByName(one)
    status = F.when(F.col("failures") == 0, "PASS").when(F.col("failures") <= warn, "WARN").otherwise("FAIL")
    return out.withColumn("status", status)


def post_merge(entries: DataFrame, canonical: DataFrame) -> DataFrame:
    """(phase, check_name, failures, status) of the checks that must hold after a merge."""
    keys = entries.dropDuplicates(["dictionary_entry_id"]).groupBy("source_code", "normalized_word", "sense_number").count().where("count > 1")
    known = canonical.select(F.col("canonical_word_id").alias("k"))
    missing = entries.where("canonical_word_id IS NULL").select("dictionary_entry_id").distinct()
    dangling = entries.where("canonical_word_id IS NOT NULL").select("dictionary_entry_id", "canonical_word_id").distinct().join(known, F.col("canonical_word_id") == F.col("k"), "left_anti")
    n = F.count("*")
    return _rows([("merge", "duplicate keys", keys, n), ("merge", "canonical missing", missing, n), ("merge", "canonical unknown", dangling, n)])


def summary(entries: DataFrame, parsed: DataFrame, synonym: DataFrame, canonical: DataFrame, warn: int = 10) -> DataFrame:
    """(phase, check_name, failures, status) over all tables; up to `warn` failures only warn."""
    ids = lambda df, c: df.select(c).distinct()
    n = F.count("*")
    entry_ids, sense_ids = ids(entries, "dictionary_entry_id"), ids(parsed, "dictionary_entry_parsed_id")
    senses = parsed.dropDuplicates(["dictionary_entry_parsed_id"])
    checks = [
        ("entries", "word blank", entries.dropDuplicates(["dictionary_entry_id"]), F.count_if(text.blank(F.col("word")))),
        ("entries", "without senses", entry_ids.join(ids(parsed, "dictionary_entry_id"), "dictionary_entry_id", "left_anti"), n),
        ("senses", "entry unknown", senses.join(entry_ids, "dictionary_entry_id", "left_anti"), n),
        ("senses", "definition blank", senses, F.count_if(text.blank(F.col("definition")))),
        ("senses", "parent unknown", senses.where("parent_parsed_id IS NOT NULL").join(sense_ids.select(F.col("dictionary_entry_parsed_id").alias("parent_parsed_id")), "parent_parsed_id", "left_anti"), n),
        ("synonyms", "sense unknown", synonym.dropDuplicates(["dictionary_entry_synonym_id"]).join(sense_ids, "dictionary_entry_parsed_id", "left_anti"), n),
        ("canonical", "word blank", canonical, F.count_if(text.blank(F.col("normalized_word")))),
        ("canonical", "word not eligible", canonical, F.count_if(~text.canonical_eligible(F.col("normalized_word")))),
    ]
    return _rows(checks, warn)


def grammar_sample(parsed: DataFrame, n: int = 100, warn: int = 10) -> DataFrame:
    """(sampled, failures, status): a sample of long definitions, the same at each run, checked for simple slips."""
    d = F.col("definition")
    chosen = parsed.where(F.length(d) > 50).select("dictionary_entry_parsed_id", "definition").dropDuplicates(["dictionary_entry_parsed_id"]).orderBy(F.sha2(F.col("dictionary_entry_parsed_id").cast("string"), 256)).limit(n)
    bad = F.count_if(d.rlike(r"\s[,.;:!?]") | d.rlike(r"\s{2,}") | d.rlike(r"[,;]{2,}"))
    status = F.when(F.col("failures") == 0, "PASS").when(F.col("failures") < warn, "WARN").otherwise("FAIL")
    return chosen.agg(F.count("*").alias("sampled"), bad.alias("failures")).withColumn("status", status)


def source_counts(entries: DataFrame, parsed: DataFrame) -> DataFrame:
    """(source_code, entries, parsed, unparsed, senses): the entries of each source with and without senses."""
    e = entries.select("dictionary_entry_id", "source_code").dropDuplicates(["dictionary_entry_id"])
    n = parsed.select("dictionary_entry_id", "dictionary_entry_parsed_id").distinct().groupBy("dictionary_entry_id").agg(F.count("*").alias("n"))
    j = e.join(n, "dictionary_entry_id", "left").groupBy("source_code")
    return j.agg(F.count("*").alias("entries"), F.count("n").alias("parsed"), F.count_if(F.col("n").isNull()).alias("unparsed"), F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("senses"))


def coverage(canonical: DataFrame, pronounced: DataFrame, least: float = 0.5) -> DataFrame:
    """(locale, words, share, status): how many canonical words have a pronunciation in each locale."""
    total = F.lit(max(canonical.count(), 1))
    n = pronounced.select("locale", "canonical_word_id").distinct().groupBy("locale").agg(F.count("*").alias("words"))
    share = F.round(F.col("words") / total, 4)
    return n.select("locale", "words", share.alias("share"), F.when(share >= least, "PASS").when(share > 0, "WARN").otherwise("FAIL").alias("status"))
