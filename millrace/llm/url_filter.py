"""URL rules by a sort-merge range join.

A host is written backwards, label by label, with a comma after each: ``m.example.org`` becomes
``org,example,m,``.  A rule's host is then a prefix, so it holds for one interval of keys, and the intervals
of nested hosts nest.  Addresses and rules are sorted together by key and path; one sweep keeps a stack of
the rules whose interval it is in, and an address takes the longest rule on the stack whose path begins its own.

The sort is split over tasks at some keys, with a hash of the row as a tie-break, so one host or one address with
a third of all rows is split like any other.  The keys are drawn from all rows by hash, ``DRAWN`` for each task and
of ``CUT`` characters at most, which is all that the driver gets.  A rule goes to every task its interval reaches.
The draw only places rows; results do not depend on it.  Nothing is broadcast.

Defined results: an address that is null or has no ``://`` has an empty host and path; a rule with an empty host
fits every address whose path begins with its own, those too; where rules of equal length fit, the one with the longer host wins, then a block
before an allow; rules repeated are one; an address no rule fits gets ``default``; repeated rows are judged
each by itself; columns other than the id and the address are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rules as verdict, host and path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
DEFAULT = "allow"
#: Keys drawn to place the cuts, for each cut, and their longest length.
DRAWN, CUT = 16, 200


def host_of(url: Column) -> Column:
    return _lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _lower(x: Column) -> Column:
    return F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_key(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, "\\.", -1)), ","), F.lit(",")))


def _place(cuts: list[tuple[str, int]]):
    """The task of each address, by its key and tie-break."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ties = batch.column("key").to_pylist(), batch.column("tie").to_pylist()
            to = [bisect_right(cuts, pair) for pair in zip(keys, ties, strict=True)]
            yield batch.set_column(batch.schema.get_field_index("part"), "part", pa.array(to, pa.int32()))

    return run


def _reach(low: list[str]):
    """Each rule once for every task that its host's interval reaches; ``low``: the keys at which tasks begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("hkey").to_pylist()
            reached = [range(bisect_left(low, k), bisect_right(low, k + "\U0010ffff") + 1) for k in keys]
            row = pa.array([i for i, r in enumerate(reached) for _ in r], pa.int64())
            parts = pa.array([p for r in reached for p in r], pa.int32())
            for a in range(0, len(row), 65_536):
                out = batch.take(row.slice(a, 65_536))
                yield out.append_column("part", parts.slice(a, 65_536))

    return run


class _Stack:
    """The nested hosts that the sweep is in, each with its rules by path."""

    def __init__(self) -> None:
        self.open: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def at(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def rule(self, host_key: str, host: str, path: str, verdict: str) -> None:
        if not self.open or self.open[-1][0] != host_key:
            self.open.append((host_key, {}, []))
        _, rules, lengths = self.open[-1]
        if path not in rules or verdict == "block":
            rules[path] = (host + path, verdict)
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def best(self, path: str) -> tuple[str | None, str | None]:
        found: tuple[str | None, str | None] = (None, None)
        for _, rules, lengths in reversed(self.open):
            hit = next((rules[path[:n]] for n in lengths if n <= len(path) and path[:n] in rules), None)
            if hit and (found[0] is None or len(hit[0]) > len(found[0])):
                found = hit
        return found


def _sweep(default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack, part = _Stack(), None
        for batch in batches:
            ids, hosts, paths, rules, verdicts = [], [], [], [], []
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "hkey", "kind", "id", "host", "path", "verdict")), strict=True):
                p, hkey, kind, i, host, path, verdict = row
                if p != part:
                    stack, part = _Stack(), p
                stack.at(hkey)
                if kind == 0:
                    stack.rule(hkey, host, path, verdict)
                    continue
                rule, own = stack.best(path)
                ids.append(i)
                hosts.append(host)
                paths.append(path)
                rules.append(rule)
                verdicts.append(own or default)
            yield pa.record_batch(
                [pa.array(ids, batch.schema.field("id").type), *(pa.array(x, pa.string()) for x in (hosts, paths, rules, verdicts))],
                names=["id", "host", "path", "rule", "verdict"],
            )

    return run


def judge(pages: DataFrame, rules: DataFrame | Iterable[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """One row per page: the id, ``host``, ``path``, ``rule`` and ``verdict``.  ``rules``: rows of ``verdict``,
    ``host`` and ``path``."""
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.select(
        "id", "host", "path", host_key(F.col("host")).alias("hkey"), F.concat(host_key(F.col("host")), "path").alias("key"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"), F.lit(0).alias("part"),
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # Some keys from everywhere: those whose hash is among the smallest, by the share that is wanted.
    share = min(1.0, DRAWN * tasks / max(1, rows.count()))
    drawn = rows.where(F.abs(F.xxhash64("tie", "key") % F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select(F.substring("key", 1, CUT).alias("key"), "tie")
    drawn = sorted((r["key"], r["tie"]) for r in drawn.collect())
    cuts = [drawn[i * len(drawn) // tasks] for i in range(1, tasks)] if len(drawn) >= tasks else []
    names = ["part", "hkey", "kind", "id", "host", "path", "verdict"]
    placed = rows.select("part", "key", "tie", "hkey", F.lit(1).alias("kind"), "id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    placed = placed.mapInArrow(_place(cuts), placed.schema).select(*names)
    active = rules.where("host is not null and path is not null and verdict is not null").select(_lower(F.col("host")).alias("host"), "path", "verdict").distinct()
    active = active.select(host_key(F.col("host")).alias("hkey"), F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["id"].dataType).alias("id"), "host", "path", "verdict")
    active = active.mapInArrow(_reach([k for k, _ in cuts]), T.StructType([*active.schema.fields, T.StructField("part", T.IntegerType())])).select(*names)
    # A part is a task: dealt by its number, not by a hash of it.
    swept = placed.unionByName(active).repartitionById(tasks, F.col("part")).sortWithinPartitions("part", "hkey", "kind", "path")
    schema = f"id {rows.schema['id'].dataType.simpleString()}, host string, path string, rule string, verdict string"
    return swept.mapInArrow(_sweep(default), schema).withColumnRenamed("id", id_col)


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))


ORACLE = r"""
WITH p AS (SELECT page_id, lower(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')) AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
             row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(r.host || r.path) DESC NULLS LAST) AS k
      FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""
