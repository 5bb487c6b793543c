"""Counts of rows as they pass, in batches and streams, and what the log says of them."""

import json
import logging

from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace.log import Structured
from millrace.operators import metrics
from millrace.streaming import batch, counters

ROWS = [("a", True, 1.5), ("a", False, 9.0), ("b", True, 0.25), ("x", True, 2.0), (None, None, 1.0), ("a", True, None)]
SCHEMA = "source_name string, success boolean, duration double"


def test_batch_observation_equals_the_report(spark):
    rows, seen = spark.createDataFrame(ROWS, SCHEMA), Observation("run")
    assert counters.watched(rows, ["a", "b", "never"], seen).count() == 6
    got = counters.totals(seen.get, ["a", "b", "never"])
    assert got == {"a": {"total": 3, "succeeded": 2, "seconds": 1.5}, "b": {"total": 1, "succeeded": 1, "seconds": 0.25}, "other": {"total": 2, "succeeded": 1, "seconds": 2.0}}
    want = {r["source_name"]: (r["total"], r["succeeded"]) for r in metrics.by(rows.where("source_name in ('a', 'b')"), "source_name").collect()}
    assert {s: (got[s]["total"], got[s]["succeeded"]) for s in want} == want


def test_stream_totals_are_those_of_all_batches_and_go_to_the_log(spark, tmp_path, caplog):
    for n in range(3):
        spark.createDataFrame([(i, ("click", "view", "error")[i % 3], float(i)) for i in range(n * 10, n * 10 + 10)], "event_id long, event_type string, value double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    with caplog.at_level(logging.INFO, logger="millrace.streaming.counters"):
        got = {r["source_name"]: (r["total"], r["succeeded"], r["seconds"]) for r in batch.watched_events(spark, str(tmp_path)).collect()}
    assert got == {"click": (10, 10, 135.0), "view": (10, 10, 145.0), "error": (10, 0, 0.0)}
    said = [json.loads(Structured().format(r)) for r in caplog.records if r.message == "batch counted"]
    assert said and sum(x["sources"].get("click", {}).get("total", 0) for x in said) == 10 and {"stream", "batch"} <= set(said[0])
    assert any(r.message == "stream ended" for r in caplog.records) or said


def test_no_source_named_counts_all_as_other(spark):
    seen = Observation("all")
    counters.watched(spark.createDataFrame(ROWS, SCHEMA).where(F.lit(True)), [], seen).count()
    assert counters.totals(seen.get, [])["other"]["total"] == 6
