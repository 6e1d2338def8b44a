"""Correctors of texts in a chain, and words that a scan has joined.

A corrector is a function of Columns with a name and a confidence; a chain runs those that the settings allow, one after
the other, and tells which changed a text. External checkers take part as tables of their results (operators/ai.py).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import text
from glossmill.operators.rewrite import once
from glossmill.session import cut, maybe_broadcast

#: Letters of a token from which it may be two words.
JOINED = 6


@dataclass(frozen=True)
class Corrector:
    """One engine of a chain; confidence in per cent."""

    name: str
    apply: Callable[[Column], Column]
    confidence: int = 80


def corrected(df: DataFrame, row_id: str, column: str, chain: Sequence[Corrector], off: tuple[str, ...] = (), enabled: bool = True) -> DataFrame:
    """(row_id, before, after, engines, confidence) of the texts that a chain changes; engines: the names of those that did.

    off: names of correctors that do not run; enabled false: none runs. A corrector whose result would be null or blank
    changes nothing. Null and blank texts stay as they are. confidence is the mean of the engines that changed the text.
    """
    run = [c for c in chain if enabled and c.name not in off]
    out = df.select(row_id, F.col(column).alias("before")).where(~text.blank(F.col("before"))).withColumn("after", F.col("before"))
    out = out.withColumn("engines", F.array().cast("array<string>")).withColumn("sure", F.lit(0))
    for c in run:
        out = out.withColumn("_new", once(c.apply(F.col("after"))))
        changes = ~text.blank(F.col("_new")) & (F.col("_new") != F.col("after"))
        out = out.withColumn("_changes", once(changes))
        out = out.select(
            row_id, "before", F.when(F.col("_changes"), F.col("_new")).otherwise(F.col("after")).alias("after"),
            F.when(F.col("_changes"), F.array_append("engines", F.lit(c.name))).otherwise(F.col("engines")).alias("engines"),
            (F.col("sure") + F.when(F.col("_changes"), c.confidence).otherwise(0)).alias("sure"),
        )
    kept = out.where("after <> before")
    return kept.select(row_id, "before", "after", "engines", F.round(F.col("sure") / F.greatest(F.size("engines"), F.lit(1))).cast("int").alias("confidence")).distinct()


def splits(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(token, split): tokens of JOINED letters or more that the lexicon (word) lacks, and that are two of its words of at least
    two letters each; of several ways to part one that with the shortest first word."""
    known = cut(lexicon.where("word IS NOT NULL").select(F.lower("word").alias("word")).distinct())
    small = maybe_broadcast(known)
    one = tokens.where("token IS NOT NULL").select(F.lower("token").alias("token")).where(F.length("token") >= JOINED).distinct()
    odd = one.join(small.withColumnRenamed("word", "token"), "token", "left_anti")
    ways = odd.withColumn("n", F.explode(F.sequence(F.lit(2), F.length("token") - 2))).select("token", "n", F.substring("token", F.lit(1), F.col("n")).alias("a"), F.substring("token", F.col("n") + 1, F.length("token")).alias("b"))
    both = ways.join(small.withColumnRenamed("word", "a"), "a", "left_semi").join(small.withColumnRenamed("word", "b"), "b", "left_semi")
    return both.groupBy("token").agg(F.min("n").alias("n")).select("token", F.concat(F.substring("token", F.lit(1), F.col("n")), F.lit(" "), F.substring("token", F.col("n") + 1, F.length("token"))).alias("split"))
