"""From fetched pages to stored tables: raw documents, then records by kind, fresh ones only, as upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as P
from ..functions import outline as O
from ..functions.hashing import content_hash
from ..functions.url import normalized
from ..operators import freshness, records, storage
from ..shared import kept

# The date of each kind of record, and the text that undated ones are told apart by.
DATE = {"NEWS": "published_date", "JOB": "date", "RESEARCH_PAPER": "published_date"}
BODY = {"NEWS": "body", "JOB": "description", "RESEARCH_PAPER": "abstract", "PRODUCT": "description", "STARTUP": "description"}


def raw_documents(pages: DataFrame, fetched_at: Column) -> DataFrame:
    """Pages answered with 200, one of each content: that of the smallest address."""
    rows = pages.where("status_code = 200").withColumn("content_hash", content_hash(F.col("html")))
    one = freshness.first_seen(rows, F.col("content_hash"), ["url"])
    return one.select(normalized(F.col("url")).alias("normalized_url"), "url", "content_hash", F.col("status_code").alias("http_status"), F.col("html").alias("raw_html"), fetched_at.alias("fetched_at"))


def records_of(pages: DataFrame, record_type: str, as_of: Column) -> DataFrame:
    """Records of one kind.  Pages of other kinds are left out before any page is parsed."""
    mine = pages.where((F.col("record_type") == record_type) & (F.col("status_code") == 200))
    if record_type in ("NEWS", "JOB"):
        read = mine.withColumn("page", P.page(F.col("html"))).drop("html", "record_type")
        return records.news(read, as_of) if record_type == "NEWS" else records.jobs(read, as_of)
    read = mine.withColumn("page", O.outline(F.col("html"))).drop("html", "record_type")
    return {"RESEARCH_PAPER": records.papers, "PRODUCT": records.products, "STARTUP": records.startups}[record_type](read)


def fresh(found: DataFrame, record_type: str, as_of: Column, hours: int = 24) -> DataFrame:
    content, prov = F.col("content"), F.col("provenance")
    sure = [prov[c] if c in found.schema["provenance"].dataType.names else F.lit(None).cast(t) for c, t in (("date_confidence", "double"), ("date_source", "string"))]
    date = content[DATE[record_type]] if record_type in DATE else F.lit(None).cast("timestamp")
    # The content decides among records of one address: their order must not depend on the run.
    return freshness.annotated(found, date, content[BODY[record_type]], *sure, as_of, ["source_url", "provenance"], hours).where("is_fresh")


def _put(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The table with the rows put in."""
    return storage.Table(spark, path, rows.schema, keys, version).put(rows)


def store(spark: SparkSession, pages: DataFrame, out: str, as_of: Column, hours: int = 24, max_pages: int | None = None) -> DataFrame:
    """``pages`` (url, source_name, record_type, status_code, html) into the tables under ``out``; returns
    ``table, n``: rows of each table, and ``failed``: pages that were not answered with 200.

    Every table is put into part by part, so a run that ends early leaves the older versions whole.
    ``max_pages`` keeps the first pages of each source, as a crawl's page budget does; None keeps all."""
    if max_pages is not None:
        pages = storage.capped(pages, "source_name", ["url"], max_pages).drop("position")
    made = {"raw_documents": _put(spark, f"{out}/raw_documents", raw_documents(pages, as_of), ["normalized_url", "content_hash"], ["fetched_at", "url"])}
    for kind, name in records.TABLE_OF.items():
        found = kept(records_of(pages, kind, as_of), name)  # freshness looks at them twice: pages are parsed once
        rows = records.as_rows(fresh(found, kind, as_of, hours), kind, as_of)
        made[name] = _put(spark, f"{out}/{name}", rows, ["paper_url" if kind == "RESEARCH_PAPER" else "source_url"], ["collected_at", "provenance"])
    counts = [t.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n")) for name, t in made.items()]
    total = pages.agg(F.lit("failed").alias("table"), F.count_if(F.coalesce(F.col("status_code") != 200, F.lit(True))).alias("n"))
    for one in counts:
        total = total.unionByName(one)
    return total
