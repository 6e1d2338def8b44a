"""Session helpers: reading tables, cutting lineage and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of values up to which a table may be broadcast. Both are measured first.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20


def local_session(cpus: int | str = 8, memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("glossmill")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or on one machine a new temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    at = tempfile.mkdtemp(prefix="glossmill-")
    spark.conf.set("spark.checkpoint.dir", at)
    return at


def scratch(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder; what is there is deleted when the driver's JVM ends."""
    at = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return at


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: its lineage ends there, and losing an executor loses nothing.

    The files are deleted when the driver's JVM ends.
    """
    spark = df.sparkSession
    at = scratch(spark, "cut")
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def _width(field: T.StructField) -> Column:
    """Bytes of a column's value in a row, about."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType):
        return F.greatest(F.size(c), F.lit(0)) * 8 + 8
    if isinstance(field.dataType, T.ArrayType | T.StructType | T.MapType):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
    return F.lit(8)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether df has at most so many rows and bytes. Reads no more than it must."""
    width = F.lit(0)
    for f in df.schema.fields:
        width = width + _width(f)
    n, held = df.limit(rows + 1).agg(F.count("*"), F.sum(width.cast("long"))).first()
    return n <= rows and (held or 0) <= size


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it is small, else as it is, for a shuffled join."""
    return F.broadcast(df) if small(df, rows, size) else df


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once a context."""
    import os
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_glossmill_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    at = os.path.join(tempfile.mkdtemp(prefix="glossmill-"), "glossmill.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(root)))
    sc.addPyFile(at)
    sc._glossmill_shipped = True


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores, for work that costs far more than moving its rows.

    Only tables of fewer files than cores are moved; df must be a table or a narrow query over one.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
