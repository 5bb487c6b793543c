"""Freshness: dated records by age, undated ones by whether their body was seen before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import is_fresh, with_read
from ..shared import shared_dir

# Sources that add to a date's confidence, and the confidence of undated records.
RELIABLE = ["json_ld", "meta", "time_element"]
BONUS, FIRST, REPEAT = 0.1, 0.3, 0.5


def confidence(date_confidence: Column, source: Column) -> Column:
    raised = F.least(date_confidence + F.lit(BONUS), F.lit(1.0))
    return F.round(F.when(source.isin(RELIABLE), raised).otherwise(date_confidence), 4)


def with_published_date(rows: DataFrame, content: Column, provenance: Column, as_of: Column, name: str) -> DataFrame:
    """Adds ``name``: when a record was published, by its content, else by its provenance.  Dates may be timestamps or texts."""
    rows = with_read(rows, F.array(content.cast("string"), provenance.cast("string")), as_of, "__said")
    return rows.withColumn(name, F.coalesce(F.col("__said")[0]["ts"], F.col("__said")[1]["ts"])).drop("__said")


def body_hash(body: Column) -> Column:
    return F.sha2(F.coalesce(body, F.lit("")), 256)


def annotated(
    records: DataFrame, published: Column, body: Column, date_confidence: Column, date_source: Column, as_of: Column, order: list[str], hours: int = 24, seen: DataFrame | None = None
) -> DataFrame:
    """Adds ``is_fresh``, ``freshness_confidence`` and ``freshness_source``.  Undated records are fresh the
    first time their body occurs, in the order of the columns ``order``.  ``seen`` (column ``hash``, see ``body_hash``)
    holds bodies of earlier runs: they are not new; without it every run begins anew.

    First sightings are found by a minimum per hash, summed up map side first, so a body that many records
    share never gathers in one task; dated records take no part in that shuffle's result."""
    order_key = F.struct(*order)
    rows = records.withColumn("__ts", published).withColumn("__hash", body_hash(body)).withColumn("__key", order_key)
    first = rows.where("__ts is null").groupBy("__hash").agg(F.min("__key").alias("__first"))
    if seen is not None:
        first = first.join(seen.select(F.col("hash").alias("__hash")).distinct(), "__hash", "left_anti")
    rows = rows.join(first, "__hash", "left")
    dated, new = F.col("__ts").isNotNull(), F.coalesce(F.col("__key") == F.col("__first"), F.lit(False))
    source = F.coalesce(date_source, F.lit("unknown"))
    return rows.select(
        *records.columns,
        F.when(dated, is_fresh(F.col("__ts"), as_of, hours)).otherwise(new).alias("is_fresh"),
        F.when(dated, confidence(F.coalesce(date_confidence, F.lit(0.0)), source)).when(new, FIRST).otherwise(REPEAT).alias("freshness_confidence"),
        F.when(dated, source).when(new, "heuristic").otherwise("content_hash_duplicate").alias("freshness_source"),
    )


def split(annotated_records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fresh and stale records: judged once, written in two folders, of which each side reads its own."""
    place = shared_dir(annotated_records.sparkSession, "split")
    annotated_records.withColumn("__side", F.col("is_fresh")).write.partitionBy("__side").parquet(place)
    rows = annotated_records.sparkSession.read.schema(T.StructType([*annotated_records.schema.fields, T.StructField("__side", T.BooleanType())])).parquet(place)
    return rows.where("__side").drop("__side"), rows.where("not __side").drop("__side")


def fresh_only(annotated_records: DataFrame, record_type: str | None = None) -> DataFrame:
    """Fresh records, of one kind (column ``record_type``) if one is named."""
    fresh = annotated_records.where("is_fresh")
    return fresh if record_type is None else fresh.where(F.col("record_type") == record_type)


def first_seen(rows: DataFrame, value: Column, order: list[str]) -> DataFrame:
    """The first row of each value: a minimum, summed up before rows are sent, so a value that many rows have gathers in no task."""
    return rows.groupBy(value.alias("__value")).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("__row")).select("__row.*")
