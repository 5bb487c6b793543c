"""Reports over request metrics: one pass with partial sums for each grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals() -> list[Column]:
    ok = F.col("success")
    n, good = F.count(F.lit(1)), F.count_if(ok)
    seconds = F.sum(F.when(ok, F.col("duration")))
    return [
        n.alias("total"), good.alias("succeeded"), (n - good).alias("failed"), F.round(F.coalesce(good / n, F.lit(0.0)), 6).alias("success_rate"),
        F.round(F.coalesce(F.try_divide(seconds, good), F.lit(0.0)), 6).alias("avg_duration"),
    ]


def by(metrics: DataFrame, column: str) -> DataFrame:
    return metrics.groupBy(column).agg(*totals())


def histogram(metrics: DataFrame, group: str, value: str) -> DataFrame:
    """For each group a map from value to count."""
    counts = metrics.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col(value).isNotNull()).groupBy(group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(value, "n")))).alias("histogram"))


def summary(metrics: DataFrame) -> DataFrame:
    """By source, by domain and over all, in one aggregation."""
    sets = metrics.groupingSets([["source_name"], ["domain"], []], "source_name", "domain")
    return sets.agg(F.grouping_id().cast("long").alias("level"), *totals())
