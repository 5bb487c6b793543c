"""The later steps of a run over stored tables: extraction by a model, resolution of names, and all steps in a row."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as P
from ..operators import chunking, extraction, resolution, storage
from ..schemas import CONTENT, TABLES
from ..session import Settings
from . import crawl

log = logging.getLogger(__name__)


def table(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A stored table; empty if nothing was put there."""
    schema = T.StructType.fromDDL(TABLES[name])
    found = storage.Table(spark, f"{out}/{name}", schema, ["id"], ["id"])
    return found.read()


def providers_of(settings: Settings) -> list[extraction.Provider]:
    """The model service that the settings name, or the offline stand-in."""
    if not settings.provider_url:
        return [extraction.Echo()]
    return [extraction.ChatService(settings.provider_url, settings.provider_model, settings.provider_key, input_tokens=settings.provider_tokens, output_tokens=settings.provider_output_tokens)]


def extract(spark: SparkSession, out: str, record_type: str, providers: list[extraction.Provider], settings: Settings = Settings(), template: str | None = None) -> DataFrame:
    """Stored pages through the providers into ``extracted``; what no provider answers or what breaks a rule goes to
    ``dead_letters`` with its reason.  Returns ``table, n``."""
    raw = storage.Table(spark, f"{out}/raw_documents", T.StructType.fromDDL("normalized_url string, url string, content_hash string, http_status int, raw_html string, fetched_at timestamp"), ["normalized_url", "content_hash"], ["fetched_at", "url"])
    pages = raw.read().select("url", P.page(F.col("raw_html"), "title", "main").alias("page"))
    texts = pages.select("url", F.concat_ws("\n", "page.title", "page.main").alias("text")).where("text <> ''")
    pieces = chunking.chunked(texts, "url", "text", settings.chunk_tokens, settings.chunk_overlap_tokens)
    asked = pieces.withColumn("prompt", extraction.prompt(F.lit(record_type), F.col("chunk"), template))
    found = extraction.validated(extraction.answers(asked, "prompt", providers, extraction.Replies(spark, f"{out}/replies")).drop("prompt", "chunk"), "reply", record_type)
    good, dead = extraction.settled(found)
    names = [f.strip().split(" ")[0] for f in CONTENT[record_type].split(", ")]
    kinds = dict(f.strip().split(" ") for f in CONTENT[record_type].split(", "))
    fields = good.select("url", "chunk_no", "content.*")
    whole = chunking.merged(fields, "url", "chunk_no", [n for n in names if kinds[n] == "string"], [n for n in names if kinds[n] != "string"])
    rows = whole.select("url", F.lit(record_type).alias("record_type"), F.to_json(F.struct(*names)).alias("content"))
    lost = dead.select("url", "chunk_no", "reason", F.coalesce("reply", F.lit("")).alias("reply"))
    counts = []
    for name, part, keys in (("extracted", rows, ["url", "record_type"]), ("dead_letters", lost, ["url", "chunk_no"])):
        stored = storage.Table(spark, f"{out}/{name}", T.StructType([T.StructField(f.name, f.dataType) for f in part.schema]), keys, keys).put(part)
        counts.append(stored.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n")))
    return counts[0].unionByName(counts[1])


def resolve(spark: SparkSession, out: str, now: Column, aliases: DataFrame | None = None, providers: list[extraction.Provider] | None = None) -> DataFrame:
    """Names of stored products' makers against stored companies: a row for each in ``entity_mapping_logs``, and
    confident ones by other than their own name as ``entity_aliases``.  ``aliases`` (raw, canonical, seq) are known
    beforehand; ``providers`` are asked about names that are close to a known one, but not close enough.  Returns the log."""
    companies = table(spark, out, "startups").select("id", "canonical_name")
    known = companies.groupBy("canonical_name").agg(F.min(F.xxhash64("id")).alias("candidate_id")).select("candidate_id", F.col("canonical_name").alias("candidate"))
    names = table(spark, out, "products").select(F.col("product_name").alias("raw"), "source_url").where("raw is not null")
    names = names.groupBy("raw").agg(F.min("source_url").alias("source_url")).withColumn("name_id", F.xxhash64("raw"))
    before = resolution.alias_table(aliases if aliases is not None else spark.createDataFrame([], "raw string, canonical string, seq long"))
    found = resolution.resolved(names.select("name_id", "raw"), before, known, providers=providers, replies=extraction.Replies(spark, f"{out}/replies"))
    logged = resolution.mapping_log(found, "PRODUCT").join(names.select("name_id", "source_url"), "name_id")
    rows = logged.select(F.sha2(F.concat_ws(":", F.lit("PRODUCT"), "raw_name"), 256).alias("id"), "raw_name", "canonical_name", "entity_type", "method", "confidence", "source_url", now.alias("created_at"))
    schema = T.StructType.fromDDL(TABLES["entity_mapping_logs"])
    out_log = storage.Table(spark, f"{out}/entity_mapping_logs", schema, ["id"], ["created_at"]).put(rows)
    sure = out_log.where("confidence >= 0.95 and raw_name <> canonical_name").select(
        F.xxhash64("raw_name", "entity_type").alias("id"), "raw_name", resolution.canonical_name(F.col("raw_name")).alias("normalized_name"), "canonical_name", "entity_type", "method", "confidence"
    )
    storage.Table(spark, f"{out}/entity_aliases", T.StructType.fromDDL(TABLES["entity_aliases"]), ["id"], ["confidence"]).put(sure)
    return out_log


def full(spark: SparkSession, pages: DataFrame, out: str, now: Column, settings: Settings = Settings(), record_type: str = "NEWS") -> DataFrame:
    """Crawled pages into tables, then extraction, then resolution; ``table, n`` of everything."""
    counts = crawl.store(spark, pages, out, now, settings.filter_freshness_hours, settings.max_pages_per_source)
    log.info("crawled", extra={"out": out})
    counts = counts.unionByName(extract(spark, out, record_type, providers_of(settings), settings))
    log.info("extracted", extra={"record_type": record_type})
    found = resolve(spark, out, now, providers=providers_of(settings) if settings.provider_url else None)
    log.info("resolved")
    return counts.unionByName(found.agg(F.lit("entity_mapping_logs").alias("table"), F.count(F.lit(1)).alias("n")))
