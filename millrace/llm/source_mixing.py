"""Mixing sources to target weights by capped water-filling.

Every source gets a target in words: its weight's share of the budget, at most ``epochs`` times its own size.  Sources
above that are clamped, what is cut off is shared out again by weight among the others, and so on until nothing is above
its cap.  A round is one sum over the table of sources, so sources may be many; it ends after a few, as the level only
rises and each round clamps for good.

A document is repeated a whole number of times, and a seeded part of each source's documents once more, so far that the
source's words meet its target; the last of them is repeated in part.  The order is that of md5 hashes of seed, id and
text.  Words are summed by source and hash range first; only in the one range of each source in which the target is met
are documents put in order.  So no task holds a source, and no text is moved but in those ranges.

Defined results: null text has size 0; null sources are one source, last in order; sources of size 0 get target 0; rows
that repeat an id, or have none, are documents of their own and told apart by their texts (equal rows are alike, it does
not matter which is taken); without words every target is 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .core import discard, stored

WEIGHTS, BUDGET, EPOCHS, SEED = (3, 1, 2), 1.5, 2, "mix-1"
#: Fewest hash ranges of each source, and how many there are for each shuffle partition.
RANGES, BY_PARTITION = 256, 4
#: Rows of the table of ranges (some 60 bytes each) up to which it is broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 200_000


def sized(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """Adds ``place``, from 0, in code-point order of ``source``, null last: sorted in ranges, whose sizes alone are
    summed up one after another."""
    parts = stored(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = parts.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return parts.join(offsets, "part").withColumn("place", F.col("offset") + inside).drop("part", "offset")


def water_fill(sources: DataFrame, budget: float = BUDGET, epochs: float = EPOCHS) -> DataFrame:
    """``sources``: columns ``source_size`` and ``weight`` and any others, a row each.  Adds ``target``."""
    cap = F.col("source_size") * F.lit(float(epochs))
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0) * budget
    level, clamped = 0.0, -1
    while True:
        over = F.lit(level) * F.col("weight") > cap
        caps, weights, n = sources.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)).first()
        if n == clamped or not weights:
            break
        level, clamped = (total - float(caps or 0)) / float(weights), n
    return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")) if weights else cap)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, epochs: float = EPOCHS, seed: str = SEED, ranges: int | None = None,
) -> DataFrame:
    """One row per input row: ``row`` (all its columns), ``size``, ``source_size``, ``target`` and ``taken``
    (words, repeats counted).  Weights go to the sources in code-point order, null last, over and over."""
    ranges = ranges or max(RANGES, BY_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    told = [F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))]
    key = F.md5(F.concat_ws(":", *told).cast("binary"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(source_col).alias("source"), key.alias("key"))
    # The first 32 bits of the hash in ranges that keep its order.
    rows = rows.withColumn("range", F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(ranges), 32).cast("int"))
    size = sized(F.col("row")[text_col])
    parts = stored(rows.groupBy("source", "range").agg(F.sum(size).alias("words")), "ranges")
    placed = numbered(parts.groupBy("source").agg(F.sum("words").alias("source_size")))
    sources = placed.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    sources = water_fill(sources, budget, epochs).select(F.col("source").alias("t"), "source_size", "target")
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    known = parts.withColumn("earlier", F.coalesce(F.sum("words").over(earlier), F.lit(0))).join(sources, F.col("source").eqNullSafe(F.col("t")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    # Words of a range that are taken once more; where that is some of them, the range is the one the target is met in.
    more = F.round("target").cast("long") - whole * F.col("source_size") - F.col("earlier")
    known = known.select(
        F.col("source").alias("s"), F.col("range").alias("r"), "source_size", "target", whole.alias("whole"),
        F.greatest(F.lit(0).cast("long"), F.least("words", more)).alias("more"), "words",
    )
    known = stored(known, "targets")
    discard(parts)
    met = (F.col("more") > 0) & (F.col("more") < F.col("words"))
    few = known.count() <= BROADCAST_ROWS
    here = F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))

    def joined(part: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(part) if few else part, here).withColumn("size", size)

    inside = Window.partitionBy("source", "range").orderBy("key", F.col("row")[id_col], "size").rowsBetween(Window.unboundedPreceding, -1)
    at_edge = F.least("size", F.greatest(F.lit(0).cast("long"), F.col("more") - F.coalesce(F.sum("size").over(inside), F.lit(0))))
    even = joined(known.where(~met)).withColumn("again", F.when(F.col("more") > 0, F.col("size")).otherwise(F.lit(0)))
    edge = joined(known.where(met)).withColumn("again", at_edge)
    out = [d.select("row", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("again")).alias("taken")) for d in (even, edge)]
    return out[0].unionByName(out[1])


def op5_source_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


ORACLE = """
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
           md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE - coalesce(CAST(sum(cap) OVER b AS DOUBLE), 0)) /
             (CAST(sum(weight) OVER () AS DOUBLE) - coalesce(CAST(sum(weight) OVER b AS DOUBLE), 0)) AS level
      FROM w WINDOW b AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, source LIMIT 1),
t AS (SELECT w.source, w.source_size, least(cap, coalesce((SELECT level FROM m) * weight, cap)) AS target FROM w),
k AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(round(target) / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (SELECT d.doc_id, d.size, d.key, k.source_size, k.target, k.whole, CAST(round(k.target) AS BIGINT) - k.whole * k.source_size AS part,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
      FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + least(size, greatest(0, part - earlier)) AS BIGINT) AS taken FROM r
"""
