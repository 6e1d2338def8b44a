"""Joins of rows with an aggregate of those rows, safe for keys that hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.session import small

#: Most rows of a table that is broadcast whole.
ATTACH_ROWS = 200_000
#: A key is heavy from so many rows; heavy keys are at most total / HEAVY and are broadcast when few.
HEAVY = 100_000
#: Most heavy keys that are broadcast; the rest take the salted way.
HEAVY_KEYS = 100_000
#: Parts into which rows of a heavy key are split if there are too many heavy keys to broadcast.
SALTS = 32


def attach(rows: DataFrame, agg: DataFrame, on: list[str], count: str, heavy: int = HEAVY) -> DataFrame:
    """Inner join of rows with agg, a table by `on` whose column `count` says how many rows each key has.

    A small agg is broadcast whole. Else heavy keys go through a broadcast of those keys only, or, where those are too
    many or too large, through a join on a salted key; the others are shuffled. Keys with nulls are compared as equal.
    Empty inputs give an empty result. agg is read several times, so it should be a table.
    """
    if small(agg, ATTACH_ROWS):
        return _join(rows, F.broadcast(agg), on)
    hot = agg.where(F.col(count) >= heavy)
    if hot.isEmpty():
        return _join(rows, agg, on)
    cold = agg.where(F.col(count) < heavy)
    if small(hot, HEAVY_KEYS):
        return _join(rows, F.broadcast(hot), on).unionByName(_join(_join(rows, F.broadcast(hot.select(*on)), on, "left_anti"), cold, on))
    salted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    copies = agg.withColumn("_salt", F.explode(F.when(F.col(count) >= heavy, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))))
    salted = _join(salted, hot.select(*on).distinct().withColumn("_hot", F.lit(True)), on, "left").withColumn("_salt", F.when(F.col("_hot"), F.col("_salt")).otherwise(F.lit(0)))
    return _join(salted.drop("_hot"), copies, [*on, "_salt"]).drop("_salt")


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on null-safe equality that keeps the left side's key columns once."""
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    condition = None
    for c in on:
        one = left[c].eqNullSafe(F.col(f"_r_{c}"))
        condition = one if condition is None else condition & one
    return left.join(right, condition, how).drop(*[f"_r_{c}" for c in on])
