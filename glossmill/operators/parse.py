"""The parse stage: from entries of a source to parsed senses and their six child tables, all from one table of senses.

Keys are hashes of what identifies a row, so a run that is repeated gives the same ids, and inserting is an anti join.
Texts in other languages become placeholders and take no part in the child tables; the originals are in a side table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import display, language, text
from glossmill.operators import extract, lexicon, rewrite


@dataclass(frozen=True)
class Parsed:
    """The tables of one run."""

    senses: DataFrame
    aliases: DataFrame
    synonyms: DataFrame
    examples: DataFrame
    references: DataFrame
    etymologies: DataFrame
    other_languages: DataFrame


def sense_key(source: Column, entry_id: Column, title: Column, definition: Column, number: Column) -> Column:
    """The id of a parsed sense. Senses of KAIKKI are the same whatever entry they came with."""
    own = F.when(source == "KAIKKI", F.lit("")).otherwise(F.coalesce(entry_id.cast("string"), F.lit("")))
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (source, title, definition, number)]
    return F.sha2(F.concat_ws("|", own, *parts), 256)


def processed(c: Column, kind: str) -> Column:
    """A text of a kind as it is shown: repaired, as a sentence for definitions, formatted; a placeholder if not English."""
    formatted = {"Example": display.example, "Etymology": display.etymology, "Definition": text.tidy_definition}.get(kind, lambda x: x)
    shown = text.let(text.ocr_normalize(c), lambda clean: F.when(language.contains_non_english(clean), text.placeholder(F.lit(kind), F.lit(False))).otherwise(text.let(clean, formatted)))
    return F.when(text.blank(c), F.lit("")).otherwise(shown)


def insert_or_get(senses: DataFrame, existing: DataFrame) -> DataFrame:
    """Senses that are not stored yet, each id once; existing: dictionary_entry_parsed_key."""
    return senses.dropDuplicates(["dictionary_entry_parsed_key"]).join(existing.select("dictionary_entry_parsed_key").distinct(), "dictionary_entry_parsed_key", "left_anti")


def examples_of_entries(examples: DataFrame) -> DataFrame:
    """Examples (dictionary_entry_id, sense_number, example, source_code) of which each text stands once an entry and source,
    with its first sense, whatever its case."""
    key = F.lower(text.example_key(F.col("example")))
    best = F.min(F.struct("sense_number", "example")).alias("m")
    return examples.groupBy("dictionary_entry_id", "source_code", key.alias("k")).agg(best).select("dictionary_entry_id", F.col("m.sense_number").alias("sense_number"), F.col("m.example").alias("example"), "source_code")


def parse(entries: DataFrame) -> Parsed:
    """entries: dictionary_entry_id, word, definition, raw_fragment, sense_number, source_code, domain, alias.

    An entry without a definition is a sense with an empty one; a word that is missing gives the title `unnamed sense`.
    """
    e = entries.select(
        "dictionary_entry_id", F.coalesce("word", F.lit("unnamed sense")).alias("meaning_title"), F.coalesce("definition", F.lit("")).alias("definition"), F.coalesce("raw_fragment", "definition", F.lit("")).alias("raw_fragment"),
        F.coalesce("sense_number", F.lit(1)).alias("sense_number"), "source_code", "domain", "alias",
    )
    s = e.withColumn("domain", extract.domain(F.col("source_code"), F.col("domain"), F.col("definition"))).withColumn("shown", rewrite.once(processed(F.col("definition"), "Definition")))
    s = s.withColumn("dictionary_entry_parsed_key", sense_key(F.col("source_code"), F.col("dictionary_entry_id"), F.col("meaning_title"), F.col("definition"), F.col("sense_number")))
    senses = s.select("dictionary_entry_parsed_key", "dictionary_entry_id", "meaning_title", F.col("shown").alias("definition"), "raw_fragment", "sense_number", "domain", "source_code").dropDuplicates(["dictionary_entry_parsed_key"])
    english = lambda df, c: df.where(~text.is_placeholder(F.col(c)) & (F.col(c) != ""))
    aliases = english(s.select("dictionary_entry_id", rewrite.once(processed(F.col("alias"), "Alias")).alias("alias"), "source_code"), "alias").distinct()
    found = extract.synonyms(s, "dictionary_entry_parsed_key", "meaning_title", "definition", "source_code").where("confidence >= 60")
    synonyms = english(found.select("dictionary_entry_parsed_key", rewrite.once(text.synonym_key(processed(F.col("synonym"), "Synonym"))).alias("synonym"), "confidence"), "synonym")
    shown = english(s.select("dictionary_entry_id", "sense_number", F.explode(extract.examples(F.col("definition"))).alias("x"), "source_code").select("dictionary_entry_id", "sense_number", rewrite.once(processed(F.col("x"), "Example")).alias("example"), "source_code"), "example")
    refs = s.select("dictionary_entry_parsed_key", F.explode(extract.references(F.col("definition"))).alias("r"), "source_code").select("dictionary_entry_parsed_key", F.col("r.target").alias("target"), F.col("r.type").alias("type"), "source_code").distinct()
    origin = s.select("dictionary_entry_id", extract.etymology(F.col("definition"), lexicon.LANGUAGES).alias("o"), "source_code").where("o IS NOT NULL")
    origin = english(origin.select("dictionary_entry_id", rewrite.once(processed(F.col("o.etymology"), "Etymology")).alias("etymology"), F.col("o.language_code").alias("language_code"), "source_code"), "etymology").distinct()
    other = s.where(text.is_placeholder(F.col("shown"))).select(F.sha2(F.concat_ws("|", F.coalesce("source_code", F.lit("UNKNOWN")), F.lit("Definition"), "definition"), 256).alias("text_id"), "source_code", F.lit("Definition").alias("field"), F.col("definition").alias("text")).distinct()
    return Parsed(senses, aliases, synonyms, examples_of_entries(shown), refs, origin, other)


def manifest(parsed: Parsed) -> DataFrame:
    """(source_code, senses, examples, done): what a run has written of each source; done once it has any sense."""
    n = parsed.senses.groupBy("source_code").agg(F.count("*").alias("senses"))
    x = parsed.examples.groupBy("source_code").agg(F.count("*").alias("examples"))
    return n.join(x, "source_code", "left").select("source_code", "senses", F.coalesce("examples", F.lit(0).cast("long")).alias("examples"), F.lit(True).alias("done"))
