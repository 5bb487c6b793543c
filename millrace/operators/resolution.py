"""Entity resolution: aliases, exact names, close names (``fuzzy``), embeddings (``vectors``), an audit log."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import parsed_reply
from ..functions.text import LEGAL_MORE, name_normalized
from ..shared import kept
from . import extraction
from .fuzzy import close_texts, fuzzy_pairs, fuzzy_top, indel, score, token_set_ratio  # noqa: F401
from .vectors import nearest  # noqa: F401

# Scores from which a match is taken, reviewed or, among embeddings, taken; and the fallback's confidence.
ACCEPT, REVIEW, EMBEDDING, FALLBACK = 0.95, 0.80, 0.85, 0.7


def _nfc(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFC", s))


_nfc.__annotations__ = {"x": pd.Series, "return": pd.Series}


def canonical_name(name: Column) -> Column:
    """Composed characters, then as ``name_normalized`` with more legal words.  Plain ASCII skips Python's
    work: those rows reach it as nulls."""
    ascii_only = name.rlike(r"^\p{ASCII}*$")
    composed = F.pandas_udf(_nfc, T.StringType())(F.when(~ascii_only, name))
    return name_normalized(F.when(ascii_only, name).otherwise(composed), LEGAL_MORE)


def alias_table(pairs: DataFrame) -> DataFrame:
    """``pairs`` (raw, canonical, seq): both sides normalized, the last of each raw name."""
    named = pairs.select(canonical_name(F.col("raw")).alias("norm"), canonical_name(F.col("canonical")).alias("target"), "seq")
    return named.groupBy("norm").agg(F.max_by("target", "seq").alias("target"))


def resolved(
    names: DataFrame, aliases: DataFrame, candidates: DataFrame, embedded: DataFrame | None = None,
    accept: float = ACCEPT, review: float = REVIEW, embedding: float = EMBEDDING, fallback: float = FALLBACK,
    providers: list[extraction.Provider] | None = None, replies: extraction.Replies | None = None,
) -> DataFrame:
    """``names`` (name_id, raw): one row each with ``canonical``, ``method``, ``confidence`` and
    ``needs_review``.  Aliases come first, then equal names, close ones, embeddings (name_id, name, cosine),
    and last the normalized name itself.  Scores from which each step takes or flags a name can be given.
    With ``providers`` the names between review and acceptance are asked about, see ``reviewed``."""
    # Written once with what is made of them, so that no plan below makes it again.
    rows = kept(names.withColumn("norm", canonical_name(F.col("raw"))), "names")
    cands = kept(candidates.withColumn("cnorm", canonical_name(F.col("candidate"))), "candidates")
    exact = cands.groupBy(F.col("cnorm").alias("norm")).agg(F.min_by("candidate", "candidate_id").alias("same"), F.min("candidate_id").alias("first"))
    left = rows.join(aliases, "norm", "left").join(exact.drop("first"), "norm", "left")
    open_names = left.where("target is null and same is null and norm <> ''").select("norm")
    scored = kept(close_texts(open_names, cands, 100 * review), "close").join(exact.withColumnsRenamed({"norm": "cnorm", "same": "candidate"}), "cnorm")
    best = scored.groupBy("norm").agg(F.max_by(F.struct("candidate", "score"), F.struct("score", -F.col("first"))).alias("best"))
    out = left.join(best, "norm", "left")
    near = F.lit(None).cast("struct<name:string,cosine:double>")
    if embedded is not None:
        top = embedded.groupBy("name_id").agg(F.max_by(F.struct("name", "cosine"), "cosine").alias("near"))
        out, near = out.join(top, "name_id", "left"), F.col("near")
    blank = F.coalesce(F.trim("raw"), F.lit("")) == ""
    close = F.col("best.score") / 100 >= accept
    by_vector = near["cosine"] >= embedding

    def step(canonical: Column, method: str, confidence: Column, review: Column = F.lit(False)) -> Column:
        return F.struct(canonical.alias("canonical"), F.lit(method).alias("method"), F.round(confidence.cast("double"), 4).alias("confidence"), review.alias("needs_review"))

    one = F.lit(1.0)
    found = (
        F.when(blank, step(F.lit(None).cast("string"), "exact", F.lit(0.0)))
        .when(F.col("target").isNotNull(), step(F.col("target"), "alias", one))
        .when(F.col("same").isNotNull(), step(F.col("same"), "exact", one))
        .when(close, step(F.col("best.candidate"), "fuzzy", F.col("best.score") / 100))
        .when(by_vector, step(near["name"], "embedding", near["cosine"]))
        .otherwise(step(F.col("norm"), "exact", F.lit(fallback), F.col("best").isNotNull()))
    )
    out = out.select("name_id", "raw", "norm", found.alias("f")).select("name_id", "raw", "norm", "f.*")
    if providers:
        out = reviewed(out, scored, providers, replies, review)
    return out.drop("norm")


def reviewed(found: DataFrame, scored: DataFrame, providers: list[extraction.Provider], replies: extraction.Replies | None = None, least: float = REVIEW, most: int = 5) -> DataFrame:
    """Names that need a review, each distinct one asked about once with its ``most`` closest known names (``scored``: norm, candidate, score).

    A reply that names one of these with a confidence of at least ``least`` is taken as method ``llm``.  A reply that names none of them, or is
    less sure, settles that the name stands for itself; without a reply that can be read the name still needs its review."""
    found = kept(found, "found")
    w = Window.partitionBy("norm").orderBy(F.col("score").desc(), "first", "candidate")
    open_ = found.where("needs_review").groupBy("norm").agg(F.min("raw").alias("raw"))
    close = scored.join(open_.select("norm"), "norm", "left_semi").withColumn("n", F.row_number().over(w)).where(F.col("n") <= most)
    close = close.groupBy("norm").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "candidate"))), lambda x: x["candidate"]).alias("names"))
    asked = open_.join(close, "norm").withColumn("prompt", extraction.resolution_prompt(F.col("raw"), F.col("names")))
    said = extraction.answers(asked, "prompt", providers, replies).withColumn("v", parsed_reply(F.col("reply")))
    named, sure = F.try_variant_get("v", "$.canonical_name", "string"), F.try_variant_get("v", "$.confidence", "double")
    said = said.where(named.isNotNull()).select("norm", named.alias("named"), F.least(F.coalesce(sure, F.lit(0.0)), F.lit(1.0)).alias("sure"), F.array_contains("names", named).alias("known"))
    out = found.join(said, "norm", "left")
    asked_, taken = F.col("needs_review") & F.col("named").isNotNull(), F.col("needs_review") & F.coalesce(F.col("known") & (F.col("sure") >= least), F.lit(False))
    return out.select(
        "name_id", "raw", "norm", F.when(taken, F.col("named")).otherwise(F.col("canonical")).alias("canonical"), F.when(taken, "llm").otherwise(F.col("method")).alias("method"),
        F.when(taken, F.round("sure", 4)).otherwise(F.col("confidence")).alias("confidence"), (F.col("needs_review") & ~asked_).alias("needs_review"),
    )


def mapping_log(found: DataFrame, entity_type: str = "STARTUP") -> DataFrame:
    return found.select("name_id", F.col("raw").alias("raw_name"), F.col("canonical").alias("canonical_name"), F.lit(entity_type).alias("entity_type"), "method", "confidence")
