"""Structured Streaming twins of the stateful operators."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.dates import is_fresh
from ..operators.storage import Table


def first_seen(rows: DataFrame, value: Column, ts: str, bound: str = "24 hours") -> DataFrame:
    """Rows whose value did not occur within ``bound`` before; state older than that goes."""
    keyed = rows.withColumn("content_hash", F.sha2(value, 256)).withWatermark(ts, bound)
    return keyed.dropDuplicatesWithinWatermark(["content_hash"])


#: State of keyed operators lies in RocksDB: on disk, not in the memory of an executor.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstSeen(StatefulProcessor):
    """Marks the row of a key that ``order`` puts first, if the key is not known.  Rows come in chunks, of which one row is held
    back until it is known not to be the first or the key's rows are over, so a key of any size takes a chunk's memory.  What is kept of a
    key is until when it is known, and one timer, moved on by each batch that has the key; when it goes off the state goes."""

    def __init__(self, order: list[str], ts: str, hours: int) -> None:
        self.order, self.ts, self.keep = order, ts, hours * 3_600_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.until = handle, handle.getValueState("until", T.StructType([T.StructField("ms", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        before, held, last = self.until.get(), None, 0
        for frame in rows:
            frame = frame.sort_values(self.order).assign(is_first=False)
            last = max(last, int(pd.to_datetime(frame[self.ts]).max().timestamp() * 1000))
            if before is None:
                head, frame = frame.iloc[:1], frame.iloc[1:]
                both = head if held is None else pd.concat([held, head]).sort_values(self.order, kind="stable")
                held, frame = both.iloc[:1], pd.concat([both.iloc[1:], frame])
            if len(frame):
                yield frame
        if held is not None:
            yield held.assign(is_first=True)
        until = max(last, timerValues.getCurrentWatermarkInMs()) + self.keep
        if before is not None:
            until = max(until, before[0])
            self.handle.deleteTimer(before[0])
        self.handle.registerTimer(until)
        self.until.update((until,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.until.clear()
        return iter([])


def marked(rows: DataFrame, value: Column, ts: str, order: list[str], hours: int = 24) -> DataFrame:
    """All rows, with ``content_hash`` and ``is_first``: whether the value did not occur within ``hours`` before (in a
    batch the row that ``order`` puts first).  Needs ``ROCKS`` as the session's state store."""
    keyed = rows.withColumn("content_hash", F.sha2(value, 256)).withWatermark(ts, f"{hours} hours")
    out = T.StructType([*keyed.schema.fields, T.StructField("is_first", T.BooleanType())])
    return keyed.groupBy("content_hash").transformWithStateInPandas(FirstSeen(order, ts, hours), out, "Append", "EventTime")


def fresh(rows: DataFrame, ts: str, as_of: Column | None = None, hours: int = 24) -> DataFrame:
    return rows.where(is_fresh(F.col(ts), F.current_timestamp() if as_of is None else as_of, hours))


def upsert_each_batch(table: Table) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the batch's rows put into the stored table as the version after the batch's number,
    made from the versions before it.  A batch that is run again writes the same version, and a stream that starts again
    goes on with what is stored."""

    def run(batch: DataFrame, number: int) -> None:
        table.put(batch, number + 1)

    return run


def hourly(rows: DataFrame, ts: str, late: str = "1 hour") -> DataFrame:
    """Requests and failures in each hour and source."""
    return rows.withWatermark(ts, late).groupBy(F.window(ts, "1 hour"), "source_name").agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("success")).alias("failed"))
