"""Export with a commit: ``df.write.format("export").mode("overwrite").option("path", ...)``, kinds ``csv`` and ``jsonl``.

Tasks write their parts into a staging folder beside the target.  When all are through, the old copy goes and the staged one takes its name; a
failed run's staging folder is deleted, and the target is what it was.  A second run replaces the first whole.  The path is one that all executors share, or an
address of a store that Arrow's file systems reach."""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

KINDS = ("csv", "jsonl")


@dataclass
class Part(WriterCommitMessage):
    name: str
    rows: int


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, kind: str, columns: list[str], overwrite: bool) -> None:
        self.path, self.kind, self.columns, self.overwrite = path, kind, columns, overwrite
        self.job = uuid.uuid4().hex

    def _store(self):
        return stores.FileSystem.from_uri(self.path if "://" in self.path else "file://" + self.path.removeprefix("file:"))

    def _staged(self, folder: str) -> str:
        return f"{folder.rstrip('/')}.staging-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, folder = self._store()
        name, rows = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.{self.kind}", 0
        store.create_dir(self._staged(folder))
        with store.open_output_stream(f"{self._staged(folder)}/{name}") as raw:
            out = io.TextIOWrapper(raw, "utf-8", newline="")
            table = csv.writer(out, lineterminator="\n")
            if self.kind == "csv":
                table.writerow(self.columns)
            for batch in iterator:
                rows += batch.num_rows
                for row in batch.to_pylist():
                    if self.kind == "csv":
                        table.writerow([json.dumps(v, default=str, ensure_ascii=False) if isinstance(v, (dict, list)) else v for v in row.values()])
                    else:
                        out.write(json.dumps(row, default=str, ensure_ascii=False) + "\n")
            out.flush()
            out.detach()
        return Part(name, rows)

    def commit(self, messages: list[Part | None]) -> None:
        store, folder = self._store()
        kept = {m.name for m in messages if m is not None}
        store.create_dir(self._staged(folder))
        for f in store.get_file_info(stores.FileSelector(self._staged(folder))):
            if f.base_name not in kept:  # of a task that was tried again
                store.delete_file(f.path)
        with store.open_output_stream(f"{self._staged(folder)}/_SUCCESS") as f:
            f.write(json.dumps({"rows": sum(m.rows for m in messages if m is not None)}).encode())
        if store.get_file_info(folder).type != stores.FileType.NotFound:
            if not self.overwrite:
                store.delete_dir(self._staged(folder))
                raise FileExistsError(folder)
            store.delete_dir(folder)
        store.move(self._staged(folder), folder)

    def abort(self, messages: list[Part | None]) -> None:
        store, folder = self._store()
        if store.get_file_info(self._staged(folder)).type != stores.FileType.NotFound:
            store.delete_dir(self._staged(folder))


class Export(DataSource):
    """Options: ``path``, ``kind``."""

    @classmethod
    def name(cls) -> str:
        return "export"

    def writer(self, schema, overwrite: bool) -> Writer:
        options = {k.lower(): v for k, v in dict(self.options).items()}
        kind = options.get("kind", "csv")
        if kind not in KINDS:
            raise ValueError(f"kind is one of {', '.join(KINDS)}")
        return Writer(options["path"], kind, schema.fieldNames(), overwrite)


def export(rows: DataFrame, path: str, kind: str = "csv") -> None:
    """A copy for other programs, whole or not at all."""
    spark: SparkSession = rows.sparkSession
    spark.dataSource.register(Export)
    rows.write.format("export").mode("overwrite").option("path", path).option("kind", kind).save()
