"""Answers of several providers to one item, already in a table, merged into one; templates and notes.

Calls to providers are not made here: an answer is a row (item_id, position, answer), null or blank if it failed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import text


def consensus(answers: DataFrame) -> DataFrame:
    """(item_id, answer): the longest answer of each item, of equally long ones the first by position."""
    ok = answers.where(~text.blank(F.col("answer")))
    best = F.max(F.struct(F.length("answer").alias("n"), (-F.col("position")).alias("p"), "answer")).alias("b")
    return ok.groupBy("item_id").agg(best).select("item_id", "b.answer")


def first_success(answers: DataFrame) -> DataFrame:
    """(item_id, answer): the first answer by position that isn't blank."""
    ok = answers.where(~text.blank(F.col("answer")))
    return ok.groupBy("item_id").agg(F.min(F.struct("position", "answer")).alias("b")).select("item_id", "b.answer")


def chosen(providers: list[str], named: str | None = None, most: int | None = None) -> list[str]:
    """The providers to ask, in order: the named one first if it is known, each once, at most so many."""
    order = ([named] if named in providers else []) + [p for p in dict.fromkeys(providers) if p != named]
    return order if most is None else order[: max(most, 0)]


def chunked(items: DataFrame, key: str, size: int) -> DataFrame:
    """items with `chunk`, a number that about `size` of them share; rows of one key are in one chunk, without a sort."""
    n = max(1, -(-items.count() // max(1, size)))
    return items.withColumn("chunk", F.pmod(F.xxhash64(key), F.lit(n)).cast("long"))


def filled(template: str, values: dict[str, Column]) -> Column:
    """A template with each {{name}} replaced by a Column; names without a value, and null values, become empty."""
    import re

    parts = re.split(r"\{\{\s*(\w+)\s*\}\}", template)
    return F.concat(*[F.lit(p) if i % 2 == 0 else F.coalesce(values.get(p, F.lit("")).cast("string"), F.lit("")) for i, p in enumerate(parts)])


def merged_notes(document: Column, suggestions: Column, key: str = "suggestions") -> Column:
    """A JSON document with its other members as they are and `key` set to a list; from none if it isn't an object."""
    members = F.from_json(document, "map<string,string>")
    kept = F.map_filter(F.coalesce(members, F.create_map().cast("map<string,string>")), lambda k, _: k != key)
    return F.to_json(F.map_concat(kept, F.create_map(F.lit(key), F.to_json(suggestions))))


def mean_confidence(confidences: Column) -> Column:
    """The rounded mean of an array of per cents, 0 for none."""
    total = F.aggregate(confidences, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(confidences) > 0, F.round(total / F.size(confidences)).cast("int")).otherwise(0)
