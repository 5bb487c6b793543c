"""Deep pages: rows written in order by ranges, with how many each range has, so that an offset opens only the ranges it falls in."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import _fs


@dataclass(frozen=True)
class Ordered:
    """A copy of some rows in an order that tells all rows apart: ``ranges`` folders of rows, one after another, and their counts in one file, which
    is written last.  ``write`` replaces the copy as a whole; a run that ends early leaves the one before."""

    spark: SparkSession
    path: str
    schema: T.StructType

    def write(self, rows: DataFrame, order: list[Column], ranges: int | None = None) -> "Ordered":
        ranges = ranges or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        place = f"{self.path}/data-{uuid.uuid4().hex}"
        dealt = rows.select(*self.schema.names).repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id())
        dealt.sortWithinPartitions("__range", *order).write.partitionBy("__range").parquet(place)
        narrow = T.StructType([T.StructField("__range", T.IntegerType())])
        counts = {r["__range"]: r["count"] for r in self.spark.read.schema(narrow).parquet(place).groupBy("__range").count().collect()}
        fs, jpath = _fs(self.spark, self.path)
        before = self._known()
        made, final = jpath(f"{self.path}/.{uuid.uuid4().hex}"), jpath(f"{self.path}/ranges.json")
        out = fs.create(made, False)
        out.write(bytearray(json.dumps({"place": place, "counts": sorted(counts.items())}).encode()))
        out.close()
        if before["place"]:
            fs.delete(final, False)
        if not fs.rename(made, final):
            raise OSError(f"{final} could not be named")
        if before["place"]:
            fs.delete(jpath(before["place"]), True)
        return self

    def _known(self) -> dict:
        fs, jpath = _fs(self.spark, self.path)
        at = jpath(f"{self.path}/ranges.json")
        if not fs.exists(at):
            return {"place": None, "counts": []}
        stream = fs.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def count(self) -> int:
        return sum(n for _, n in self._known()["counts"])

    def page(self, order: list[Column], limit: int = 100, offset: int = 0) -> DataFrame:
        """``limit`` rows from ``offset`` on, from the ranges that hold them."""
        known = self._known()
        ends = np.cumsum([n for _, n in known["counts"]]) if known["counts"] else np.zeros(0, int)
        first, last = int(np.searchsorted(ends, offset, "right")), int(np.searchsorted(ends, offset + limit, "left"))
        mine = known["counts"][first : last + 1] if limit > 0 else []
        if not mine:
            return self.spark.createDataFrame([], self.schema)
        before = int(ends[first - 1]) if first else 0
        rows = self.spark.read.schema(self.schema).parquet(*[f"{known['place']}/__range={r}" for r, _ in mine])
        return rows.orderBy(*order).offset(offset - before).limit(limit)
