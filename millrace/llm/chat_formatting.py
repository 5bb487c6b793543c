"""Preference formatting of chat conversations, in built-in functions only.

A preferred and a rejected conversation share their first turns.  The longest common prefix of turns (role
and text equal) is rendered once, as the prompt; what follows in either is a completion of its own, with a
mask that says which characters are learned from: the assistant's words and the mark that ends its turn.

Only the turns of one pair meet, gathered once, with partial lists map side.  Pairs are keyed by number, so a
first turn that a third of all conversations share puts no more than its own pair into a group.

Defined results: turns are ordered by number, then role, then text; null roles and texts are empty; rows
without a conversation number belong to no pair; a pair with one side has a null completion on the other
and an empty prompt; if one conversation begins the other its completion is empty; repeated rows are turns.
Columns other than the four named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"


def _header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), t["text"], F.lit(END))), "")


def _mask(turns: Column, learned: str) -> Column:
    """Runs of characters as ``length:flag``, in order; together they are as long as the completion."""

    def runs(t: Column) -> Column:
        head, body = F.length(_header(t)), F.length(t["text"]) + len(END)
        whole = F.concat((head + body).cast("string"), F.lit(":0"))
        return F.when(t["role"] == learned, F.concat(head.cast("string"), F.lit(":0,"), body.cast("string"), F.lit(":1"))).otherwise(whole)

    return F.array_join(F.transform(turns, runs), ",")


def _turn() -> Column:
    return F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def preference_pairs(turns: DataFrame, pair: Column, chosen: Column, learned: str = "assistant") -> DataFrame:
    """``turns``: columns ``turn``, ``role`` and ``text``; ``pair`` names a row's pair and ``chosen`` its side.
    One row per pair: ``pair_id, n_prefix, prompt, chosen, chosen_mask, rejected, rejected_mask``."""
    rows = turns.select(pair.alias("pair_id"), chosen.alias("side"), _turn().alias("t")).where("pair_id is not null and side is not null")
    both = rows.groupBy("pair_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("side"), F.col("t")))).alias("c"),
        F.sort_array(F.collect_list(F.when(~F.col("side"), F.col("t")))).alias("r"),
    )
    return formatted(both, learned)


def formatted(pairs: DataFrame, learned: str = "assistant") -> DataFrame:
    """``pairs``: ``pair_id`` and the ordered turns of either side, ``c`` and ``r``."""
    n = F.least(F.size("c"), F.size("r"))
    differs = F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (F.get("c", i - 1)["role"] != F.get("r", i - 1)["role"]) | (F.get("c", i - 1)["text"] != F.get("r", i - 1)["text"]),
    )
    both = pairs.withColumn("n_prefix", F.when(n == 0, F.lit(0)).otherwise(F.coalesce(F.array_min(differs) - 1, n)))

    def rest(x: str) -> Column:
        return F.slice(x, F.col("n_prefix") + 1, F.greatest(F.size(x), F.lit(1)))

    def side(x: str, what: Column) -> Column:
        return F.when(F.size(x) > 0, what)

    return both.select(
        "pair_id", F.col("n_prefix").cast("long").alias("n_prefix"), _rendered(F.slice("c", F.lit(1), F.col("n_prefix"))).alias("prompt"),
        side("c", _rendered(rest("c"))).alias("chosen"), side("c", _mask(rest("c"), learned)).alias("chosen_mask"),
        side("r", _rendered(rest("r"))).alias("rejected"), side("r", _mask(rest("r"), learned)).alias("rejected_mask"),
    )


def with_other_ending(turns: DataFrame) -> DataFrame:
    """Every conversation (``conv_id``, ``turn``, ``role``, ``text``) as a pair: ``c`` has its turns in order, ``r`` the
    same turns, every one of them, but for the text of the very last: that is the text of the last turn of the
    conversation numbered one higher (empty if there is none).  Each conversation is gathered once; only last texts
    are moved to their neighbours."""
    of_pair = turns.where("conv_id is not null").select(F.col("conv_id").alias("pair_id"), _turn().alias("t"))
    whole = of_pair.groupBy("pair_id").agg(F.sort_array(F.collect_list("t")).alias("c"))
    other = of_pair.groupBy((F.col("pair_id") - 1).alias("pair_id")).agg(F.max("t")["text"].alias("other"))
    last = F.element_at("c", -1)
    ending = F.struct(last["turn"].alias("turn"), last["role"].alias("role"), F.coalesce("other", F.lit("")).alias("text"))
    both = whole.join(other, "pair_id", "left")
    return both.select("pair_id", "c", F.concat(F.slice("c", F.lit(1), F.size("c") - 1), F.array(ending)).alias("r"))


def op6_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """Every conversation is preferred to itself with the next conversation's ending."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return formatted(with_other_ending(turns))


ORACLE = r"""
WITH w AS (SELECT conv_id AS pair_id, list({'turn': turn, 'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS c
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
g AS (SELECT w.pair_id, w.c, list_append(w.c[1:len(w.c) - 1], {'turn': w.c[-1].turn, 'role': w.c[-1].role, 'text': coalesce(o.c[-1].text, '')}) AS r
      FROM w LEFT JOIN w o ON o.pair_id = w.pair_id + 1),
n AS (SELECT *, least(len(c), len(r)) AS n FROM g),
p AS (SELECT *, coalesce(list_min(list_filter(range(1, n + 1), lambda i: c[i].role <> r[i].role OR c[i].text <> r[i].text)) - 1, n) AS n_prefix FROM n),
h AS (SELECT pair_id, CAST(n_prefix AS BIGINT) AS n_prefix, c[1:n_prefix] AS p, c, r, c[n_prefix + 1:] AS cc, r[n_prefix + 1:] AS rr FROM p)
SELECT pair_id, n_prefix,
  coalesce(list_aggregate(list_transform(p, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '') AS prompt,
  CASE WHEN len(c) > 0 THEN coalesce(list_aggregate(list_transform(cc, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '') END AS chosen,
  CASE WHEN len(c) > 0 THEN coalesce(list_aggregate(list_transform(cc, lambda t: CASE WHEN t.role = 'assistant' THEN (length(t.role) + 5) || ':0,' || (length(t.text) + 8) || ':1' ELSE (length(t.role) + 5 + length(t.text) + 8) || ':0' END), 'string_agg', ','), '') END AS chosen_mask,
  CASE WHEN len(r) > 0 THEN coalesce(list_aggregate(list_transform(rr, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '') END AS rejected,
  CASE WHEN len(r) > 0 THEN coalesce(list_aggregate(list_transform(rr, lambda t: CASE WHEN t.role = 'assistant' THEN (length(t.role) + 5) || ':0,' || (length(t.text) + 8) || ':1' ELSE (length(t.role) + 5 + length(t.text) + 8) || ':0' END), 'string_agg', ','), '') END AS rejected_mask
FROM h
"""
