"""Streams over stored tables, run until everything there is read (``availableNow``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import Table
from ..shared import shared_dir
from . import counters, operators


def _source(spark: SparkSession, d: str, name: str) -> DataFrame:
    path = f"{d}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(d)  # a stream reads folders, not single files


_STORE = "spark.sql.streaming.stateStore.providerClass"


def _run(stream: DataFrame, out: str) -> DataFrame:
    spark = stream.sparkSession
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, operators.ROCKS)  # read when the stream starts
    try:
        q = stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.set(_STORE, before)
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def first_seen_events(spark: SparkSession, d: str) -> DataFrame:
    """Each body once within a day of the events' own time."""
    rows = _source(spark, d, "events").select(F.col("props").alias("body"), F.col("ts").cast("timestamp").alias("ts"))
    return _run(operators.first_seen(rows, F.col("body"), "ts").select("content_hash"), shared_dir(spark, "stream"))


def marked_events(spark: SparkSession, d: str, out: str | None = None) -> DataFrame:
    """With the same ``out``, a later run reads only what is new and knows what was seen."""
    rows = _source(spark, d, "events").select("event_id", F.col("props").alias("body"), F.col("ts").cast("timestamp").alias("ts"))
    return _run(operators.marked(rows, F.col("body"), "ts", ["event_id"]).select("event_id", "is_first"), out or shared_dir(spark, "stream"))


def fresh_events(spark: SparkSession, d: str, as_of: Column) -> DataFrame:
    rows = _source(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return _run(operators.fresh(rows, "at", as_of).select("event_id"), shared_dir(spark, "stream"))


def hourly_events(spark: SparkSession, d: str) -> DataFrame:
    """Counts of each hour and kind.  The stream ends with its last hours still open, so it is told to give what it has
    after every batch, and the last of that counts."""
    out = shared_dir(spark, "stream")
    rows = _source(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("source_name"), (F.col("event_type") != "error").alias("success"))
    counts = operators.hourly(rows, "ts").select(F.col("window.start").alias("hour"), "source_name", "total", "failed")
    table = Table(spark, f"{out}/hours", counts.schema, ["hour", "source_name"], ["total"])
    step = operators.upsert_each_batch(table)
    counts.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return table.read()


def watched_events(spark: SparkSession, d: str) -> DataFrame:
    """Totals of each source as a stream counts them while it writes its rows: the sums of what every batch reported."""
    sources, out = ["click", "view", "purchase", "error"], shared_dir(spark, "stream")
    counted = counters.Counters("events", sources)
    rows = _source(spark, d, "events").select(F.col("event_type").alias("source_name"), (F.col("event_type") != "error").alias("success"), F.col("value").alias("duration"))
    spark.streams.addListener(counted)
    try:
        q = counters.watched(rows, sources, "events").writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)  # reports come after the batch
    finally:
        spark.streams.removeListener(counted)
    found = [(s, x["total"], x["succeeded"], float(x["seconds"])) for s, x in counted.sums[str(q.id)].items()]
    return spark.createDataFrame(found, "source_name string, total long, succeeded long, seconds double")


def upserted_orders(spark: SparkSession, d: str, out: str | None = None) -> DataFrame:
    """The latest order of each customer.  With the same ``out``, a later run reads only what is new and keeps the rest."""
    out = out or shared_dir(spark, "stream")
    rows = _source(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    table = Table(spark, f"{out}/orders", rows.schema, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    step = operators.upsert_each_batch(table)
    rows.writeStream.foreachBatch(step).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return table.read().select("o_custkey", "o_orderkey")
