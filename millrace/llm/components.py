"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .core import discard, stored


#: Links of a node that one task gets, or more where there are so many links that ``NAMED`` nodes could have more.
SHARE, NAMED = 256, 50_000


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges``: long columns ``a`` and ``b``.  Returns ``node`` and ``label``, the smallest node that its
    links reach; nodes without a link are absent.  Null ends and loops are ignored.

    Every round hangs each node's larger neighbours, then its smaller ones, on the smallest it knows, so a
    group of any size shrinks to a star in a number of rounds that grows with the logarithm of its paths.
    Only minima by node are aggregated (map side first); no node's neighbours are gathered.  Each round is
    written to the shared folder, so a lost executor costs no more than that round."""
    pairs = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    state = stored(pairs, "edges")
    for _ in range(max_rounds):
        share = max(SHARE, 2 * state.count() // NAMED)
        # Large star: larger neighbours go to the least of the node and its neighbours.
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
        large = _with_least(both.where("v > u"), least, share).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: the node and its smaller neighbours go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _with_least(large, least, share).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        last, state = state, stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(last)
        if _stars(state):
            break
    else:
        raise RuntimeError("components did not settle")
    labels = state.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _with_least(links: DataFrame, least: DataFrame, share: int) -> DataFrame:
    """Links with the ``m`` that their end ``u`` knows.  The links of a node with more than ``share`` of them are dealt
    over salts; which nodes these are is broadcast: as all nodes together have two ends a link, there are at most
    ``NAMED`` of them."""
    dealt = least.where(F.col("n") > share).select("u", (1 + F.col("n") / share).cast("int").alias("salts"))
    links = links.join(F.broadcast(dealt), "u", "left").withColumn("salt", F.pmod(F.xxhash64("v"), F.coalesce("salts", F.lit(1))).cast("int"))
    salts = F.when(F.col("n") > share, (F.col("n") / share).cast("int")).otherwise(0)
    every = least.select("u", "m", F.explode(F.sequence(F.lit(0), salts)).alias("salt"))
    return links.select("u", "v", "salt").join(every, ["u", "salt"])


def _stars(state: DataFrame) -> bool:
    """Whether every node hangs on one other, which hangs on none."""
    ends = state.select(F.col("u").alias("node"), F.col("v").alias("up")).unionByName(state.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("up")))
    seen = ends.groupBy("node").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.max(F.col("up").isNull()).alias("holds"))
    return seen.where("low <> high or (low is not null and holds)").isEmpty()
