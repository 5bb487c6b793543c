"""Tables on Parquet: upsert, paging, counts, anti-joins against what is stored."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Existing rows and new ones, of each key the one of the latest version; new ones win ties."""
    both = existing.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in (*version, "__new")])
    return both.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__new")


#: Rows of a part from which it is split, deltas that are joined into one, and the share of a table's rows that deltas may have before they go into parts.
SPLIT, DELTAS, SHARE = 1_000_000, 8, 0.1
#: Versions that stay readable beside the newest.
KEEP = 2


@dataclass(frozen=True)
class Table:
    """A stored table that is put into by key, in parts by extendible hashing and deltas that are merged when they are read.

    A part holds the rows whose key's hash begins with the part's bits.  ``put`` writes its rows as one delta and a directory file of the new
    version, which names the parts and deltas that count; no part is read for that.  More than ``DELTAS`` deltas become one, and when deltas
    have more than ``SHARE`` of the table's rows (and an eighth of a part's) they are merged into the parts that they fall into; a part that grows past ``split`` rows is split by
    further bits, the others stay as they are.  So what a put writes follows its rows, and what ``get`` reads is one part and the deltas.

    A version counts once its directory file has its name, which is the last thing to happen: a run that ends early leaves the
    table as it was.  Of each key the row of the latest ``version`` columns counts, of equal ones the one put last.  One writer at a time."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    version: list[str]
    split: int = SPLIT

    # -------------------------------------------------------- directory files
    def _known(self, below: int | None = None) -> dict:
        """The directory of the newest version (below a number)."""
        numbers = [n for n in versions(self.spark, self.path) if below is None or n < below]
        if not numbers:
            return {"parts": {}, "deltas": []}
        fs, jpath = _fs(self.spark, self.path)
        stream = fs.open(jpath(f"{self.path}/versions/{max(numbers):010d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, number: int, known: dict) -> None:
        fs, jpath = _fs(self.spark, self.path)
        made, final = jpath(f"{self.path}/versions/.{uuid.uuid4().hex}"), jpath(f"{self.path}/versions/{number:010d}.json")
        out = fs.create(made, False)
        out.write(bytearray(json.dumps(known).encode()))
        out.close()
        if fs.exists(final):  # a version that is put again
            fs.delete(final, False)
        if not fs.rename(made, final):
            raise OSError(f"version {number} of {self.path} could not be named")

    # -------------------------------------------------------- rows
    @property
    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("__h", T.LongType()), T.StructField("__seq", T.LongType())])

    def _load(self, places: list[str]) -> DataFrame:
        return self.spark.read.schema(self._stored).parquet(*places) if places else self.spark.createDataFrame([], self._stored)

    def _latest(self, rows: DataFrame) -> DataFrame:
        best = F.max_by(F.struct(*self._stored.names), F.struct(*self.version, "__seq"))
        return rows.groupBy("__h", *self.keys).agg(best.alias("__best")).select("__best.*")

    def _merged(self, base: DataFrame, deltas: list[dict]) -> DataFrame:
        """Base rows with deltas: only rows of keys that deltas have are compared, the others pass."""
        if not deltas:
            return base
        news = self._load([x["path"] for x in deltas])
        theirs = news.select("__h", *[F.col(k).alias(f"__{k}") for k in self.keys]).distinct()
        same = base["__h"] == theirs["__h"]
        for k in self.keys:
            same = same & base[k].eqNullSafe(theirs[f"__{k}"])
        return base.join(theirs, same, "left_anti").unionByName(self._latest(base.join(theirs, same, "left_semi").unionByName(news)))

    def _write(self, rows: DataFrame, by: str | None = None) -> str:
        place = f"{self.path}/data/{uuid.uuid4().hex}"
        writer = (rows.hint("rebalance", by) if by else rows).write
        (writer.partitionBy(by) if by else writer).parquet(place)
        return place

    def read(self) -> DataFrame:
        known = self._known()
        return self._merged(self._load([p["path"] for p in known["parts"].values()]), known["deltas"]).select(*self.schema.names)

    def put(self, rows: DataFrame, number: int | None = None) -> DataFrame:
        """Puts rows in as version ``number`` (the next one if none is given) and returns the table.  A number that is put
        again is made from the versions before it and replaces what it had."""
        number = latest_version(self.spark, self.path) + 1 if number is None else number
        known = self._known(number)
        rows = rows.select(*self.schema.names).withColumns({"__h": F.xxhash64(*self.keys), "__seq": F.lit(number).cast("long")})
        place = self._write(self._latest(rows))
        delta = {"path": place, "rows": self._load([place]).count()}
        known["deltas"].append(delta)
        held, waiting = (sum(x["rows"] for x in xs) for xs in (known["parts"].values(), known["deltas"]))
        if not known["parts"] and known["deltas"] == [delta] and waiting <= self.split:
            known = {"parts": {"": delta}, "deltas": []}  # a table that begins small begins as one part
        elif waiting > max(SHARE * held, self.split // 8):
            known = self._into_parts(known)
        elif len(known["deltas"]) > DELTAS:
            place = self._write(self._latest(self._load([x["path"] for x in known["deltas"]])).coalesce(1 + waiting // self.split))
            known["deltas"] = [{"path": place, "rows": self._load([place]).count()}]
        self._commit(number, known)
        self.tidy()
        return self.read()

    def _into_parts(self, known: dict) -> dict:
        """The directory with its deltas merged into the parts they fall into, and those split that have become too large."""
        news, parts = self._load([x["path"] for x in known["deltas"]]), known["parts"] or {"": {"rows": 0, "path": None}}
        depth = max(map(len, parts))
        met = news.groupBy(_bits("__h", depth).alias("bits")).count().collect()
        grown: dict[str, int] = {}
        for bits, count in met:
            name = next(bits[:n] for n in range(depth + 1) if bits[:n] in parts)
            grown[name] = grown.get(name, 0) + count
        deeper = {name: len(name) + max(0, (-(-(parts[name]["rows"] + more) // self.split) - 1).bit_length()) for name, more in grown.items()}
        depths = F.create_map(*[F.lit(x) for pair in deeper.items() for x in pair])
        names = F.array(*[F.lit(n) for n in sorted({len(n) for n in deeper})])
        # The part that a row's bits lead to, by the one length at which they name a touched part.
        found = F.filter(F.transform(names, lambda n: F.substring(_bits("__h", depth), F.lit(1), n)), lambda x: F.map_contains_key(depths, x))
        base = self._load([parts[n]["path"] for n in deeper if parts[n]["path"]])
        merged = self._merged(base, known["deltas"]).withColumn("__old", F.element_at(found, -1))
        merged = merged.withColumn("__part", F.concat(F.lit("b"), F.substring(_bits("__h", max(deeper.values())), F.lit(1), F.element_at(depths, F.col("__old")))))
        place = self._write(merged.drop("__old"), "__part")
        counts = self.spark.read.schema(T.StructType([T.StructField("__part", T.StringType())])).parquet(place).groupBy("__part").count().collect()
        kept = {n: p for n, p in parts.items() if n not in deeper}
        return {"parts": kept | {part[1:]: {"rows": count, "path": f"{place}/__part={part}"} for part, count in counts}, "deltas": []}

    def get(self, **key) -> DataFrame:
        """Rows of a key, from the one part it can be in, and the deltas, if the key is whole."""
        known = self._known()
        parts = known["parts"]
        if set(key) == set(self.keys) and parts:
            typed = [F.lit(key[k]).cast(self.schema[k].dataType) for k in self.keys]
            depth = max(map(len, parts))
            bits = self.spark.range(1).select(_bits(F.xxhash64(*typed), depth)).first()[0]
            parts = {n: p for n, p in parts.items() if bits.startswith(n)}
        mine = F.lit(True)
        for k, v in key.items():
            mine = mine & F.col(k).eqNullSafe(F.lit(v))
        rows = self._load([p["path"] for p in parts.values()]).unionByName(self._load([x["path"] for x in known["deltas"]])).where(mine)
        return self._latest(rows).select(*self.schema.names)

    def tidy(self, keep: int = KEEP) -> int:
        """Deletes versions before the last ``keep`` and the newest, and what none of these names; returns how many folders went."""
        fs, jpath = _fs(self.spark, self.path)
        numbers = sorted(versions(self.spark, self.path))
        used = set()
        for n in numbers[-1 - keep :]:
            known = self._known(n + 1)
            used |= {x["path"].split("/data/")[1].split("/")[0] for x in [*known["parts"].values(), *known["deltas"]]}
        for n in numbers[: -1 - keep]:
            fs.delete(jpath(f"{self.path}/versions/{n:010d}.json"), False)
        there = [x.getPath().getName() for x in fs.listStatus(jpath(f"{self.path}/data"))] if fs.exists(jpath(f"{self.path}/data")) else []
        gone = [x for x in there if x not in used]
        for x in gone:
            fs.delete(jpath(f"{self.path}/data/{x}"), True)
        return len(gone)


def _bits(h: Column | str, n: int) -> Column:
    """The first ``n`` bits of a hash as text."""
    h = F.col(h) if isinstance(h, str) else h
    return F.substring(F.lpad(F.bin(h), 64, "0"), 1, n)


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    return jpath(path).getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions whose directory file is there."""
    fs, jpath = _fs(spark, path)
    at = jpath(f"{path}/versions")
    names = [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []
    return [int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith(".")]


def latest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest version that was written whole; 0 if there is none."""
    return max(versions(spark, path), default=0)


def page(table: DataFrame, order: list[Column], limit: int = 100, offset: int = 0) -> DataFrame:
    return table.orderBy(*order).offset(offset).limit(limit)


def record_id(kind: str, url: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{kind.lower()}:"), url), 256)


def not_stored(new: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    return new.join(stored.select(key).distinct(), key, "left_anti")


def capped(rows: DataFrame, source: str, order: list[str], limit: int = 100) -> DataFrame:
    """The first ``limit`` rows of each source: a top-k, which Spark cuts down before the shuffle."""
    w = Window.partitionBy(source).orderBy(*order)
    return rows.withColumn("position", F.row_number().over(w)).where(F.col("position") <= limit)


def create_tables(spark: SparkSession, tables: dict[str, str]) -> None:
    """Makes the tables that are not there; ``tables`` gives their columns by name."""
    for name, columns in tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def export(table: DataFrame, path: str, kind: str = "csv") -> None:
    """A copy for other programs.  CSV has no nested values: they are written as JSON text."""
    nested = ("struct", "array", "map", "variant")
    if kind == "csv":
        table = table.select(*[F.to_json(c).alias(c) if t.startswith(nested) else F.col(c) for c, t in table.dtypes])
        table.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        table.write.mode("overwrite").format(kind).save(path)
