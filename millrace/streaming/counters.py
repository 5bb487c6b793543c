"""Live counters: what a run counts while rows pass, without a pass of its own.

``watched`` puts the counts beside the rows (Spark's ``observe``): totals of each known source, and of all others together.  A batch
gives them through its ``Observation``, a stream with every batch to a ``Counters`` listener, which writes them to the structured log and keeps the
sums of each stream.  What is counted is as many numbers as there are sources named, whatever the rows."""

from __future__ import annotations

import logging
import threading
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)
FIELDS = ("total", "succeeded", "seconds")
OTHER = "other"


def _counts(sources: list[str]) -> list[Column]:
    ok, name = F.coalesce(F.col("success"), F.lit(False)), F.coalesce(F.col("source_name"), F.lit(""))
    out = []
    for i, source in enumerate([*sources, OTHER]):
        mine = name == source if i < len(sources) else ~name.isin(sources) if sources else F.lit(True)
        out += [F.count_if(mine).alias(f"{i}_total"), F.count_if(mine & ok).alias(f"{i}_succeeded"), F.coalesce(F.sum(F.when(mine & ok, F.col("duration"))), F.lit(0.0)).alias(f"{i}_seconds")]
    return out


def totals(counted: dict[str, float], sources: list[str]) -> dict[str, dict[str, float]]:
    """Counts by source; sources of which nothing came are left out."""
    found = {s: {f: counted[f"{i}_{f}"] for f in FIELDS} for i, s in enumerate([*sources, OTHER])}
    return {s: x for s, x in found.items() if x["total"]}


def watched(rows: DataFrame, sources: list[str], by: "Observation | str") -> DataFrame:
    """``rows`` (source_name, success, duration) as they are, counted as they pass: under an ``Observation``, or for a stream under a name."""
    return rows.observe(by, *_counts(sources))


class Counters(StreamingQueryListener):
    """Totals by source of the streams that are watched under ``name``: of each batch to the log, and summed up by stream."""

    def __init__(self, name: str, sources: list[str]) -> None:
        self.name, self.sources, self.lock = name, sources, threading.Lock()
        self.sums: dict[str, dict[str, dict[str, float]]] = defaultdict(dict)
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        log.info("stream started", extra={"stream": str(event.id)})

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        found = totals(row.asDict(), self.sources)
        with self.lock:
            sums = self.sums[str(event.progress.id)]
            for source, counts in found.items():
                known = sums.setdefault(source, dict.fromkeys(FIELDS, 0))
                for f in FIELDS:
                    known[f] += counts[f]
        log.info("batch counted", extra={"stream": str(event.progress.id), "batch": event.progress.batchId, "sources": found})

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended[str(event.id)] = event.exception
        log.info("stream ended", extra={"stream": str(event.id), "error": event.exception})
