"""Queues as a log: every operation is a row, states and counts are aggregates over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import QUEUES
from ..shared import shared_dir

#: Operations of the log.
ENQUEUE, DEQUEUE, COMPLETE, FAIL, REQUEUE = "enqueue", "dequeue", "complete", "fail", "requeue"


# The word that the crawl queue of each record type ends with.
CRAWL = {"STARTUP": "startup", "PRODUCT": "product", "RESEARCH_PAPER": "paper", "NEWS": "news", "JOB": "job"}


def queue_of(step: Column, record_type: Column) -> Column:
    """The queue a job goes to: a crawl by its record type, other steps by their name; what fits none is a dead letter."""
    words = F.create_map(*[F.lit(x) for kv in CRAWL.items() for x in kv])
    crawl = F.concat(F.lit("crawl:"), F.try_element_at(words, record_type))
    named = F.when(step == "crawl", crawl).otherwise(step)
    return F.when(named.isin(QUEUES), named).otherwise(F.lit("deadletter"))


def queues_of(jobs: DataFrame, step: Column, record_type: Column) -> dict[str, DataFrame]:
    """Every queue by name, each with its jobs: dealt in one pass into a folder for each queue, of which a queue reads its own."""
    place = shared_dir(jobs.sparkSession, "queues")
    jobs.withColumn("__queue", queue_of(step, record_type)).withColumn("queue", F.col("__queue")).write.partitionBy("__queue").parquet(place)
    schema = T.StructType([*jobs.schema.fields, T.StructField("queue", T.StringType()), T.StructField("__queue", T.StringType())])
    rows = jobs.sparkSession.read.schema(schema).parquet(place)
    return {q: rows.where(F.col("__queue") == q).drop("__queue") for q in QUEUES}


def jobs(log: DataFrame) -> DataFrame:
    """``log`` (queue, job_id, seq, op) as one row per job: last operation, attempts so far, completions and
    failures.  Sums and maxima only, so a job with many operations is combined before it is sent."""
    return log.groupBy("queue", "job_id").agg(
        F.max_by("op", "seq").alias("state"), F.count_if(F.col("op") == REQUEUE).alias("attempt"),
        F.count_if(F.col("op") == COMPLETE).alias("completed"), F.count_if(F.col("op") == FAIL).alias("failed"),
    )


def stats(log: DataFrame) -> DataFrame:
    waiting = F.col("state").isin(ENQUEUE, REQUEUE)
    return jobs(log).groupBy("queue").agg(
        F.count_if(waiting).alias("size"), F.count_if(F.col("state") == DEQUEUE).alias("in_flight"), F.sum("completed").alias("completed"), F.sum("failed").alias("failed"),
    )


def dead(log: DataFrame, most_attempts: int = 3) -> DataFrame:
    """Failed jobs that were tried as often as is allowed: the dead letters."""
    return jobs(log).where((F.col("state") == FAIL) & (F.col("attempt") + 1 >= most_attempts))
