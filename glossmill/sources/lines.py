"""Lines of text files in order, and blocks of lines, without reading a file in one task.

A split of a file keeps the order of its lines, and splits are ordered by where they begin. Blocks are numbered in two
levels, as running sums are: marks are counted for each split, the counts are summed over the few splits, and within a
split a running count is added. Only a block itself, one entry of a dictionary, ever has to fit into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, pos, line) of text files; pos grows with the line within a split."""
    t = spark.read.text(path)
    return t.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("pos"), F.regexp_replace("value", "^﻿|\r$", "").alias("line"))


#: Lines of a block that are kept; what follows them is no entry of a dictionary, but text that nothing ends.
BLOCK_LINES = 100_000


def running(numbered: DataFrame, column: str) -> DataFrame:
    """numbered with `before`: the sum of a column over all lines of the file before each one."""
    per = numbered.groupBy("file", "split").agg(F.sum(column).alias("n"))
    past = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select("file", "split", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("splits"))
    inside = F.coalesce(F.sum(column).over(Window.partitionBy("file", "split").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return numbered.withColumn("inside", inside).join(before, ["file", "split"]).withColumn("before", F.col("inside") + F.col("splits")).drop("inside", "splits")


def blocks(numbered: DataFrame, starts: Column) -> DataFrame:
    """(file, block, lines): lines from each that `starts` marks up to the next one, in order. Those before are left out.

    A block of more than BLOCK_LINES lines is an error, not a row: its file has no marks, or other ones.
    """
    marked = numbered.withColumn("start", F.coalesce(starts, F.lit(False)).cast("long"))
    at = running(marked.drop("before"), "start").withColumn("block", F.col("before") + F.col("start")).where("block > 0")
    # The lines are numbered before they are collected, so no row can grow without bound.
    line = F.row_number().over(Window.partitionBy("file", "block").orderBy("split", "pos"))
    at = at.withColumn("n", line).where((F.col("n") <= BLOCK_LINES) | F.raise_error(F.concat(F.lit("block without end in "), F.col("file"))).isNotNull())
    ordered = F.array_sort(F.collect_list(F.struct("n", "line")))
    return at.groupBy("file", "block").agg(F.transform(ordered, lambda x: x["line"]).alias("lines"))
