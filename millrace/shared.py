"""Intermediate tables in the folder that the driver and all executors share, and numbering that needs one."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` (or the context's checkpoint folder).  Only a session on one machine
    may have neither: it gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = known.get() if known.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{str(base).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a shared folder and read back: the same rows however often it is read."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, name: str, order: list[Column], key: Column | None = None) -> DataFrame:
    """Adds ``name``: 1, 2, 3 in ``order`` among the rows of each ``key`` (of all rows without one).

    Rows are sorted in ranges of key and order, so a key of any size is dealt over many tasks; only the number of rows
    of each key in each range is summed up one range after another."""
    key = F.lit(0) if key is None else key
    placed = rows.withColumn("__key", key)
    placed = kept(placed.repartitionByRange(F.col("__key"), *order).withColumn("__part", F.spark_partition_id()), "numbered")
    before = Window.partitionBy("__k").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(F.col("__key").alias("__k"), F.col("__part").alias("__p")).agg(F.count("*").alias("__n"))
    offsets = counts.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = F.row_number().over(Window.partitionBy("__key", "__part").orderBy(*order))
    found = placed.withColumn("__inside", inside).join(offsets, F.col("__key").eqNullSafe(F.col("__k")) & (F.col("__part") == F.col("__p")))
    return found.select(*rows.columns, (F.col("__offset") + F.col("__inside")).alias(name))
