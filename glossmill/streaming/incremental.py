"""The batch functions over files as they arrive: file source, micro-batches, an idempotent sink, a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import text
from glossmill.session import scratch, table


def run(spark: SparkSession, source: str, schema: str, step: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, files: int = 100) -> None:
    """Run step over the files that a checkpoint has not seen, and end. A batch that is run again replaces its own output."""

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def canonical_words_once(spark: SparkSession, sf_dir: str, files: int = 100) -> DataFrame:
    """(normalized_word, entries): canonical headwords of the entries that have arrived, each entry once.

    Batches keep the ids of their entries, so an entry that is delivered again in a later batch does not count twice.
    """
    at = scratch(spark, "stream")
    schema = ", ".join(f"{c} {t}" for c, t in table(spark, sf_dir, "dictionary_entry").dtypes)
    word = text.sanitize_word(F.col("word")).alias("normalized_word")
    step = lambda b: b.dropDuplicates(["dictionary_entry_id"]).select("dictionary_entry_id", word).where(text.canonical_eligible(F.col("normalized_word")))
    # The pattern finds the table whether it is one file or a folder of files.
    run(spark, f"{sf_dir}/dictionary_entry.parquet*", schema, step, f"{at}/out", f"{at}/checkpoint", files)
    out = spark.read.schema("dictionary_entry_id long, normalized_word string, batch int").parquet(f"{at}/out")
    return out.groupBy("dictionary_entry_id").agg(F.min("normalized_word").alias("normalized_word")).groupBy("normalized_word").agg(F.count("*").alias("entries"))
