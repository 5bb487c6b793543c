"""The stream that marks repeats: chunks of a large key, restarts, and the state's end."""

import datetime as dt
import random

import pytest

from millrace.streaming import batch, operators

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, props string, ts timestamp"


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


def firsts(rows):
    return {r["event_id"] for r in rows.collect() if r["is_first"]}


@pytest.mark.parametrize("chunk", [3, 10_000])
def test_a_key_with_a_third_of_all_rows_is_taken_in_chunks(spark, tmp_path, chunk):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", chunk)
    try:
        r = random.Random(chunk)
        rows = [(i, "hot" if i % 3 == 0 else f"b{i % 7}", DAY + dt.timedelta(seconds=i)) for i in range(300)]
        r.shuffle(rows)
        put(spark, tmp_path, rows)
        got = batch.marked_events(spark, str(tmp_path))
        assert got.count() == 300
        assert firsts(got) == {min(i for i, b, _ in rows if b == body) for body in {b for _, b, _ in rows}}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_restart_knows_what_was_seen_and_forgets_after_a_day(spark, tmp_path):
    data, out = tmp_path / "data", str(tmp_path / "out")
    put(spark, data, [(1, "a", DAY), (2, "b", DAY), (3, "a", DAY)])
    assert firsts(batch.marked_events(spark, str(data), out)) == {1, 2}
    put(spark, data, [(4, "a", DAY + dt.timedelta(hours=20)), (5, "c", DAY)])
    assert firsts(batch.marked_events(spark, str(data), out)) == {1, 2, 5}
    for i, days in ((6, 5), (7, 9)):  # the watermark passes the end of a and b
        put(spark, data, [(i, f"later{i}", DAY + dt.timedelta(days=days))])
        batch.marked_events(spark, str(data), out)
    put(spark, data, [(8, "a", DAY + dt.timedelta(days=10)), (9, "later7", DAY + dt.timedelta(days=9, hours=1))])
    assert firsts(batch.marked_events(spark, str(data), out)) == {1, 2, 5, 6, 7, 8}


def test_state_is_in_the_disk_store_and_the_setting_is_given_back(spark, tmp_path):
    before = spark.conf.get(batch._STORE)
    put(spark, tmp_path / "d", [(1, "a", DAY)])
    batch.marked_events(spark, str(tmp_path / "d"), str(tmp_path / "o"))
    assert spark.conf.get(batch._STORE) == before != operators.ROCKS
    assert list((tmp_path / "o" / "state" / "state").rglob("*.zip")) or list((tmp_path / "o" / "state" / "state").rglob("*.changelog"))
