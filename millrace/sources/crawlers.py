"""A crawler for each source: where its records are found, which links lead to them, and how their pages are read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as P
from ..functions import outline as O
from ..functions.hashing import content_hash
from ..functions.url import allowed, netloc
from ..operators import records
from . import web


@dataclass(frozen=True)
class Crawler:
    """``parse`` makes records of pages with a struct ``page``; ``links`` tells record links on a listing page (None: the
    listing pages are the records' own)."""

    name: str
    base: str
    kind: str
    listings: list[str]
    parse: Callable[[DataFrame, Column], DataFrame]
    links: str | None = None
    domains: list[str] | None = None

    def discover(self, pages: DataFrame) -> DataFrame:
        """``url`` of every record that fetched listing pages (``url``, ``html``) name: distinct, and on a domain that is
        allowed."""
        if self.links is None:
            found = pages.select("url")
        else:
            found = pages.select(F.explode(records.discovered(O.outline(F.col("html")), self.name, self.base)).alias("url"))
        return found.where(allowed(F.col("url"), self.domains)).distinct()

    def read(self, pages: DataFrame, as_of: Column) -> DataFrame:
        """Records of fetched pages (``url``, ``source_name``, ``status_code``, ``html``)."""
        page = P.page(F.col("html")) if self.kind in ("NEWS", "JOB") else O.outline(F.col("html"))
        return self.parse(pages.withColumn("page", page).drop("html"), as_of)


#: How pages of each kind are read.
PARSE: dict[str, Callable[[DataFrame, Column], DataFrame]] = {
    "NEWS": records.news, "JOB": records.jobs, "RESEARCH_PAPER": lambda p, _: records.papers(p), "PRODUCT": lambda p, _: records.products(p), "STARTUP": lambda p, _: records.startups(p),
}
CRAWLERS = {
    name: Crawler(name, base, kind, [base + p for p in paths] or [web.papers_address()], PARSE[kind], records.LINKS.get(name))
    for name, base, kind, paths in web.SOURCES if kind in PARSE
}


def decoded(pages: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Fetched pages (``body`` as bytes) with ``html``: Latin-1 where the answer says so, else UTF-8, whose broken bytes
    become replacement characters.  ``sources`` adds the ``source_id`` of the page's source."""
    latin = F.lower(F.coalesce("content_type", F.lit(""))).rlike("charset=\"?(iso-8859-1|latin-?1)")
    text = F.when(latin, F.decode("body", "ISO-8859-1")).otherwise(F.make_valid_utf8(F.col("body").cast("string")))
    out = pages.withColumn("html", text).withColumn("content_hash", content_hash(F.col("body"))).drop("body")
    if sources is None:
        return out
    return out.join(sources.select(F.col("name").alias("source_name"), F.col("id").alias("source_id")), "source_name", "left")


def summary(pages: DataFrame) -> DataFrame:
    """For every domain how many pages were answered, failed, and with what errors."""
    good = F.coalesce(F.col("status_code") == 200, F.lit(False))
    return pages.groupBy(netloc(F.col("url")).alias("domain")).agg(F.count_if(good).alias("succeeded"), F.count_if(~good).alias("failed"), F.sort_array(F.collect_set("error_class")).alias("errors"))
