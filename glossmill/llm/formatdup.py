"""Problem 5: duplicates hidden by formatting differences, by progressive partition refinement.

Each step costs more a row than the one before it and sees fewer rows:

1. all rows: a histogram of frequent letters, which no formatting changes and which needs no cleaned text, counted in the
   JVM. Only (field, id, histogram) is kept; a class is an aggregate of it (number of rows, least and greatest id), so a
   class may hold a third of all rows;
2. rows in classes with several ids: their texts are read again and brought into consistent form, once; then the number
   of letters and a histogram of the others;
3. rows that are still in classes with several ids: the exact key, the letters or the sorted letters of the parts.

Null texts and texts without any letter are no records. Repeated deliveries of an id count as one record; the smallest
id of a group stands for it, so ties cannot arise. Empty tables give an empty result; columns other than the named ones
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.llm.normalize import consistent_col, letters_col
from glossmill.operators.skew import attach
from glossmill.session import cut, maybe_broadcast

#: Letters of the first histogram; the second one has the other letters and the digits.
FIRST = "etaoinsrhldcumpg"
SECOND = "".join(c for c in "abcdefghijklmnopqrstuvwxyz0123456789" if c not in FIRST)
# Labels that open a definition of parts that may stand in any order.
PART_LABELS = ("gloss", "usage", "note", "origin")
LABELLED = r"(?i)^\s*(?:" + "|".join(PART_LABELS) + r")\s*:"
WITHIN = ("field", "sense", "source")


def parts_key(form: Column) -> Column:
    """Key of a labelled definition's consistent form: the letters of its parts in order of the alphabet."""
    parts = F.array_sort(F.filter(F.transform(F.split(form, r"[;|\r\n]"), letters_col), lambda x: x != ""))
    return F.concat(F.lit(";"), F.array_join(parts, ";"))


def definition_key(form: Column) -> Column:
    """Key of a definition's consistent form: its letters, or those of its parts."""
    return F.when(form.rlike(LABELLED), parts_key(form)).otherwise(letters_col(form))


def swapped_key(form: Column) -> Column:
    """Key of a synonym's consistent form: its letters, `b, a` being read as `a b`."""
    one = (F.length(form) - F.length(F.replace(form, F.lit(","), F.lit("")))) == 1
    a, b = letters_col(F.substring_index(form, ",", 1)), letters_col(F.substring_index(form, ",", -1))
    return F.when(one & (a != "") & (b != ""), F.concat(b, a)).otherwise(letters_col(form))


def histogram(lowered: Column, letters: str) -> list[Column]:
    """How often each of those letters of one byte occurs in a text in lower case."""
    return [F.octet_length(lowered) - F.octet_length(F.replace(lowered, F.lit(c), F.lit(""))) for c in letters]


def _hash(*columns: Column | str) -> Column:
    """A hash in which nulls agree with each other and with nothing else; xxhash64 alone skips them."""
    return F.xxhash64(*[x for c in columns for x in (c, (F.col(c) if isinstance(c, str) else c).isNull())])


def texts(parsed: DataFrame, synonym: DataFrame) -> DataFrame:
    """(field, id, sense, source, text) of each definition and synonym; only synonyms have a sense and a source."""
    a = parsed.where("definition IS NOT NULL").select(F.lit("definition").alias("field"), F.col("dictionary_entry_parsed_id").alias("id"), F.lit(None).cast("long").alias("sense"), F.lit(None).cast("string").alias("source"), F.col("definition").alias("text"))
    b = synonym.where("synonym_text IS NOT NULL").select(F.lit("synonym_text"), F.col("dictionary_entry_synonym_id"), F.col("dictionary_entry_parsed_id"), F.col("source_code"), F.col("synonym_text"))
    return a.union(b).where("id IS NOT NULL")


def formed(rows: DataFrame) -> DataFrame:
    """Rows (*, text) with the consistent form in place of the text."""
    return rows.withColumn("form", consistent_col(F.col("text"))).drop("text")


def marked(rows: DataFrame) -> DataFrame:
    """(field, id, h) of each text with a letter: the hash of its first histogram and of what copies must agree in."""
    low = F.lower("form")
    # Texts in Chinese characters have few Latin letters to be told apart by.
    han = F.when(F.col("form").rlike(r"[\x{3400}-\x{9fff}]"), F.length(letters_col(F.col("form"))))
    h = _hash(*WITHIN, *histogram(F.col("low"), FIRST), han)
    some = formed(rows).where(F.col("form").rlike(r"[\p{L}\p{N}]"))
    return some.select(*WITHIN, "id", "form", low.alias("low")).select("field", "id", h.alias("h"))


def several(rows: DataFrame) -> DataFrame:
    """rows (h, id and others) whose h has several ids."""
    classes = rows.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    return attach(rows, cut(classes.select("h", "n")), ["h"], "n").drop("n")


def refine(rows: DataFrame, first: DataFrame) -> DataFrame:
    """(field, sense, source, id, keep_id, copies) of each text of rows that has copies; first: marked rows."""
    again = maybe_broadcast(cut(several(first).select("field", "id").distinct()))
    # The ids are matched before the texts are worked on, so that only texts of several take part.
    forms = cut(formed(rows.join(again, ["field", "id"], "left_semi").select(*WITHIN, "id", "text")))
    letters = forms.withColumn("letters", letters_col(F.col("form")))
    second = cut(letters.select("*", _hash(*WITHIN, F.length("letters"), *histogram(F.col("letters"), SECOND)).alias("h")).drop("letters"))
    key = F.when(F.col("field") == "definition", definition_key(F.col("form"))).otherwise(swapped_key(F.col("form")))
    keyed = cut(several(second).select("id", *WITHIN, F.unhex(F.md5(key)).alias("key")).distinct())
    on = [*WITHIN, "key"]
    groups = cut(keyed.groupBy(*on).agg(F.min("id").alias("keep_id"), F.count("*").alias("copies")).where("copies > 1"))
    return attach(keyed, groups, on, "copies").select(*WITHIN, "id", "keep_id", "copies")


def found(parsed: DataFrame, synonym: DataFrame) -> DataFrame:
    """(field, keep_id, copy_id): each copy and the record it collapses into."""
    rows = texts(parsed, synonym)
    return refine(rows, cut(marked(rows))).where("id <> keep_id").select("field", "keep_id", F.col("id").alias("copy_id")).distinct()


def collapsed(parsed: DataFrame, synonym: DataFrame) -> DataFrame:
    """(field, record_id, copies): one row for each record left; a record that occurs once has one copy."""
    rows = texts(parsed, synonym)
    first = cut(marked(rows))
    # One grouping tells the copies of each record, records that are copies of others, and those that occur once.
    told = refine(rows, first).select("field", "id", F.when(F.col("id") == F.col("keep_id"), F.col("copies")).otherwise(0).alias("copies"))
    every = first.select("field", "id", F.lit(None).cast("long").alias("copies"))
    n = every.unionByName(told).groupBy("field", "id").agg(F.max("copies").alias("copies"))
    return n.where("copies IS NULL OR copies > 0").select("field", F.col("id").alias("record_id"), F.coalesce("copies", F.lit(1).cast("long")).alias("copies"))
