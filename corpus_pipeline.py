"""Corpus pipeline: language ID, near duplicates, repeated passages, benchmark leaks, source mixture.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet to the shared
folder, gives it to the next stage, and then deletes it and what the stage stored on its way: only the last result
stays.  Whoever calls a stage by itself can do the same with ``core.noted`` and ``core.discard``.  All but the last
return the columns of ``documents``.

* ``language_id`` learns profiles from the documents that name a language.  A document without a letter goes, and so
  does one that is like none of the languages: the best prediction's score is below ``LEAST_SCORE``.  A document that
  names no language gets the predicted one; a name that is there stays.
* ``ngram_jaccard`` keeps one row of each group of similar texts, that of the smallest id: five-word shingles,
  similarity 0.8 or more (operator 3 has its own contract, three words and 0.9).  Rows are told apart by their
  place, not by their id: of rows that repeat an id or have none, equal or similar texts leave one row, and
  different texts all stay.  Texts without a word are similar to nothing and stay.
* ``substring_dedup`` keeps each repeated passage where it occurs first and cuts it elsewhere (operator 8 by itself
  cuts it everywhere); a document that has nothing left goes, all others stay, and those without such a passage keep
  their text byte for byte.
* ``decontamination`` drops documents that hold a window of a benchmark item.
* ``source_mixing`` gives every document with how much the mix takes of it: ``taken`` words, which are the whole text
  ``repeats`` times and its first ``more_words`` words once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, language_id, ngram_jaccard, source_mixing, substring_dedup
from millrace.llm.core import discard, noted, stored

# Words of a shingle and the similarity, in hundredths, from which two texts are near copies.
SHINGLE, SIMILAR = 5, 80
#: Score of the best prediction below which a text is like none of the languages (0.5: no nearer to it than to all).
LEAST_SCORE = 0.52


def _columns(found: DataFrame, **changed) -> DataFrame:
    """The columns of ``row``, some of them changed."""
    names = found.schema["row"].dataType.names
    return found.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in names])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    langs, prototypes = language_id.learn_prototypes(docs)
    if not langs:  # nothing to compare with: only texts without a letter go
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.identify(docs, langs, prototypes).where(F.col("lang_pred") != "und").where(F.col("score") >= LEAST_SCORE)
    return _columns(found, lang=F.coalesce("row.lang", "lang_pred"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Each row gets a number of its own; it is written down, so that every scan sees the same one.
    mark = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("hash"))
    rows = docs.select(F.monotonically_increasing_id().alias("number"), mark.alias("mark"), F.struct(*docs.columns).alias("row"))
    rows = stored(rows, "rows")
    found = ngram_jaccard.similar_components(rows.select("number", F.col("row.text").alias("text")), id_col="number", size=SHINGLE, numerator=SIMILAR, denominator=100)
    found = found.select(F.col("doc_id").alias("number"), "component_id")
    others = found.where("number <> component_id")
    heads = others.select(F.col("component_id").alias("number"), "component_id").distinct()
    members = stored(others.unionByName(heads).join(rows.select("number", "mark"), "number"), "members")
    # A minimum by group is summed up map side, and the rest goes by number, so no group meets in one task.
    first = members.groupBy("component_id").agg(F.min(F.struct("mark", "number")).alias("first")).select("first.number")
    gone = members.select("number").join(first, "number", "left_anti")
    return _columns(rows.join(gone, "number", "left_anti"))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(docs, keep_first=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    left = found.where("n_removed = 0 or n_removed < n_words")
    return _columns(left, text=text, n_chars=F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("row.n_chars")).cast("long"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _columns(found.where(F.size("spans") == 0))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = source_mixing.mix(docs)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("long")
    return mixed.select(
        *[F.col("row")[c].alias(c) for c in ("doc_id", "text", "lang", "source")], "size", "source_size", "target", "taken",
        whole.alias("repeats"), (F.col("taken") - whole * F.col("size")).alias("more_words"),
    )


STAGES = [
    ("language_id", language_stage),
    ("ngram_jaccard", jaccard_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last: list[str] = []
    for name, stage in STAGES:
        with noted() as made:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(*last, *[x for x in made if x != docs._millrace_path], spark=spark)
        last = [docs._millrace_path]
    return docs


#: Language profiles, components and maximal repeats are beyond SQL; the stages are tested by brute force.
ORACLE_SQL = None
