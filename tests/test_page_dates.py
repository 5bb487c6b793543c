"""The fourth step of the date cascade on the dates of pages."""

from datetime import datetime

from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.operators import records


def test_best_date_reads_what_no_format_fits(spark):
    cases = {
        1: [("Tue, 02 Jan 2024 10:00:00 GMT", 0.9, "meta")],
        2: [("no day at all", 0.9, "meta"), ("2024-01-05", 0.8, "time")],
        3: [("on the 7th of March, they said", 0.9, "meta"), ("2024-01-05", 0.8, "time")],
        4: [("  ", 0.9, "meta"), (None, 0.8, "time")],
        5: [],
        6: None,
        7: [("Tue, 02 Jan 2024 10:00:00 +0200", 0.8, "time"), ("2023-12-31", 0.9, "meta")],
        8: [("Tue, 02 Jan 2024 10:00:00 +0200", 0.8, "time")],
    }
    df = spark.createDataFrame(list(cases.items()), "id int, dates array<struct<value:string,confidence:double,source:string>>")
    best = records.with_best_date(df, F.col("dates"), F.lit("2024-01-30 12:00:00").cast("timestamp"), "d")
    got = {r["id"]: r["d"] and (r["d"]["ts"], r["d"]["source"]) for r in best.collect()}
    assert got == {
        1: (datetime(2024, 1, 2, 10), "meta"), 2: (datetime(2024, 1, 5), "time"), 3: (datetime(2024, 3, 7), "meta"), 4: None, 5: None, 6: None,
        7: (datetime(2023, 12, 31), "meta"), 8: (datetime(2024, 1, 2, 8), "time"),
    }


def test_the_plan_holds_the_cascade_once(spark):
    from millrace.plans import catalogue

    one = spark.range(1).select(F.lit("x").alias("s"))
    alone = one.repartition(1).select(dates.cascade(F.col("s"), F.lit("2024-01-30").cast("timestamp")))._jdf.queryExecution().optimizedPlan().toString().count("RLIKE")
    for name in ("date_cascade", "published_date"):
        plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert 0 < plan.count("RLIKE") <= alone <= 42
