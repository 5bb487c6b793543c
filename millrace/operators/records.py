"""News, jobs, papers, products and companies from pages; addresses to read next; records as rows of their tables.

Pages are ``url, source_name, status_code`` and a struct ``page``: ``html.page`` for news and jobs,
``outline.outline`` for the others.  Pages that were not answered with 200, or that show no name, give no
record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import outline as O
from ..functions import text as X
from ..functions.hashing import content_hash
from ..functions.url import arxiv_id, joined
from ..schemas import CONTENT
from .resolution import canonical_name
from .storage import record_id

# Links that lead to records, by source; date formats of paper pages.
LINKS = {"arxiv": "/(abs|pdf)/", "producthunt": "/posts/", "ycombinator": r"/companies\?company="}
PAPER_DATES = ["d MMM yyyy", "MMM d, yyyy", "yyyy-M-d", "d-MMM-yyyy"]
_LD = "array<struct<`@type`:string,`@id`:string,name:string,description:string,url:string,offers:struct<price:string>>>"


def discovered(page: Column, source: str, base: str) -> Column:
    """Addresses of a listing page's records, absolute, in order, repeats kept."""
    return F.transform(F.filter(page["anchors"], lambda a: a["href"].rlike(LINKS[source])), lambda a: joined(F.lit(base), a["href"]))


def first_that_answers(main: DataFrame, fallback: DataFrame) -> DataFrame:
    """``main``, or ``fallback`` where ``main`` has no row: one lazy plan, a single row is looked for."""
    empty = main.limit(1).agg((F.count(F.lit(1)) == 0).alias("__empty"))
    return main.unionByName(fallback.join(F.broadcast(empty), F.col("__empty")).drop("__empty"))


def paper_date(x: Column) -> Column:
    shown = F.initcap(F.trim(x))
    return F.coalesce(*[F.try_to_timestamp(shown, F.lit(f)) for f in PAPER_DATES])


def with_best_date(rows: DataFrame, dates: Column, as_of: Column, name: str = "__date") -> DataFrame:
    """Adds ``name``, a struct of ``ts``, ``confidence`` and ``source``: of the dates that can be read the surest, then the first."""
    rows = D.with_read(rows.withColumn("__dates", dates), F.transform("__dates", lambda d: d["value"]), as_of, "__said")
    read = F.transform(F.arrays_zip(F.col("__dates").alias("date"), F.col("__said").alias("said")), lambda x, i: F.struct((-x["date"]["confidence"]).alias("order"), i.alias("i"), x["said"]["ts"].alias("ts"), x["date"]["confidence"].alias("confidence"), x["date"]["source"].alias("source")))
    return rows.withColumn(name, F.array_min(F.filter(read, lambda d: d["ts"].isNotNull()))).drop("__dates", "__said")


def _kept(pages: DataFrame, record_type: str, name: str, fields: dict[str, Column], source_url: Column | None = None, date: Column | None = None) -> DataFrame:
    """Content structs of a record type; fields that are not given are null."""
    typed = [f.strip().split(" ") for f in CONTENT[record_type].split(", ")]
    content = F.struct(*[fields.get(f, F.lit(None)).cast(t).alias(f) for f, t in typed])
    provenance = F.struct(content_hash(F.to_json(content)).alias("content_hash"), F.col("url").alias("source_url"), F.col("source_name").alias("source_name"), *([] if date is None else [date["source"].alias("date_source"), date["confidence"].alias("date_confidence")]))
    rows = pages.where("status_code = 200").select(
        F.coalesce(source_url if source_url is not None else F.col("url"), F.col("url")).alias("source_url"), "source_name", F.lit(record_type).alias("record_type"),
        content.alias("content"), provenance.alias("provenance"),
    )
    return rows.where(F.col("content")[name] != "")


def news_content(p: Column) -> dict[str, Column]:
    author = F.coalesce(p["meta"]["meta_author"], p["marked"]["author"])
    return {"title": p["title"], "body": p["main"], "author": author, "image_url": F.coalesce(p["meta"]["og_image"], F.get(p["images"], F.lit(0)))}


def job_content(p: Column) -> dict[str, Column]:
    data = F.try_parse_json(p["json_ld"])

    def named(path: str) -> Column:
        return F.try_variant_get(data, path, "string")

    def link(part: str) -> Column:
        return F.get(F.filter(p["links"], lambda u: u.contains(part)), F.lit(0))

    return {
        "company": F.coalesce(named("$.hiringOrganization.name"), p["meta"]["meta_company"], p["marked"]["company"], F.lit("Unknown")), "role": p["title"],
        "location": F.coalesce(named("$.jobLocation.address.addressLocality"), p["meta"]["meta_location"], p["marked"]["location"]), "is_remote": X.is_remote(p["main"]),
        "role_family": X.role_family(p["title"], p["main"]), "application_url": F.coalesce(link("apply"), link("application"), p["marked"]["apply"]), "description": p["main"],
    }


def news(pages: DataFrame, as_of: Column) -> DataFrame:
    pages = with_best_date(pages, F.col("page")["dates"], as_of)
    return _kept(pages, "NEWS", "title", {**news_content(F.col("page")), "published_date": F.col("__date")["ts"]}, date=F.col("__date"))


def jobs(pages: DataFrame, as_of: Column) -> DataFrame:
    pages = with_best_date(pages, F.col("page")["dates"], as_of)
    return _kept(pages, "JOB", "role", {**job_content(F.col("page")), "date": F.col("__date")["ts"]}, date=F.col("__date"))


def papers(pages: DataFrame, base: str = "https://arxiv.org") -> DataFrame:
    p = F.col("page")
    authors = F.flatten(F.transform(O.all_marked(p, "author"), X.authors))
    return _kept(pages, "RESEARCH_PAPER", "title", {
        "title": O.first_marked(p, "title", "h1"), "authors": authors, "paper_url": F.col("url"), "external_id": arxiv_id(F.col("url")),
        "abstract": O.first_marked(p, "abstract|mathjax"), "published_date": paper_date(O.first_marked(p, "date|submitted")),
        "pdf_url": joined(F.lit(base), O.first_anchor(p, "[Pp]DF|pdf")), "category": O.first_marked(p, "category|subject"),
    })


def products(pages: DataFrame) -> DataFrame:
    """From the first product of the page's data list; from its elements where there is none."""
    p = F.col("page")
    items = F.from_json(F.when(p["data"].startswith("["), p["data"]), _LD)
    pages = pages.withColumn("__item", F.get(F.filter(items, lambda i: i["@type"] == "Product"), F.lit(0)))
    item = F.col("__item")
    listed = item.isNotNull()

    def either(data: Column, shown: Column) -> Column:
        return F.when(listed, data).otherwise(shown)

    shown_name = F.coalesce(p["h1"], O.first_marked(p, "title|name"))
    tags = F.filter(O.all_marked(p, "tag|category"), lambda t: F.length(t).between(1, 49))
    return _kept(pages, "PRODUCT", "product_name", {
        "product_name": either(item["name"], shown_name), "description": either(item["description"], O.first_marked(p, "description|tagline")),
        "website": either(item["url"], O.first_anchor(p, "Visit|Website")), "pricing_model": X.pricing(either(item["offers"]["price"], O.first_string(p, "[Pp]ricing|[Cc]ost|[Ff]ree"))),
        "upvotes": F.when(~listed, X.first_number(O.first_marked(p, "votes"))), "tags": F.when(~listed, tags),
    }, F.coalesce(F.nullif(item["url"], F.lit("")), item["@id"]))


def startups(pages: DataFrame) -> DataFrame:
    p = F.col("page")
    return _kept(pages, "STARTUP", "entity_name", {
        "entity_name": F.coalesce(p["h1"], O.first_marked(p, "company-name")), "description": O.first_marked(p, "description|about|bio"),
        "website": O.first_anchor(p, r"www\.|http"), "batch": O.first_string(p, r"[Ss]ummer|[Ww]inter\s+\d{4}"),
    })


# The tables records go to, the word their ids begin with, the columns taken from the content.
TABLE_OF = {"STARTUP": "startups", "PRODUCT": "products", "RESEARCH_PAPER": "research_papers", "JOB": "jobs", "NEWS": "news"}
ID_OF = {"STARTUP": "startup", "PRODUCT": "product", "RESEARCH_PAPER": "paper", "JOB": "job", "NEWS": "news"}
COLUMNS = {
    "STARTUP": ["description", "employee_count", "website", "founded_year", "location", "batch"],
    "PRODUCT": ["product_name", "pricing_model", "website", "description", "tagline"],
    "RESEARCH_PAPER": ["external_id", "title", "authors", "github_url", "github_stars", "published_date", "abstract", "category"],
    "JOB": ["company", "role", "is_remote", "role_family", "location", "description", "application_url"],
    "NEWS": ["title", "body", "author"],
}
_DATED = {"JOB": ("date", "description"), "NEWS": ("published_date", "body")}


def as_rows(records: DataFrame, record_type: str, collected_at: Column) -> DataFrame:
    """Records of one type as rows of its table; the id is a hash of type and address."""
    content, prov = F.col("content"), F.col("provenance")
    known = records.schema["provenance"].dataType.names
    out = [record_id(ID_OF[record_type], F.col("source_url")).alias("id"), F.col("source_url").alias("paper_url" if record_type == "RESEARCH_PAPER" else "source_url")]
    out += [content[c].alias(c) for c in COLUMNS[record_type]]
    if record_type == "STARTUP":
        out += [canonical_name(content["entity_name"]).alias("canonical_name"), F.col("source_name")]
    if record_type in _DATED:
        date, body = _DATED[record_type]
        out += [content[date].alias("published_at"), content_hash(F.coalesce(content[body], F.lit(""))).alias("content_hash")]
        out += [(prov[c] if c in known else F.lit(None)).cast(t).alias(c) for c, t in (("date_source", "string"), ("date_confidence", "double"))]
    return records.select(*out, F.to_json(prov).alias("provenance"), collected_at.alias("collected_at"))


def linked(products_: DataFrame, startups_: DataFrame, maker: str) -> DataFrame:
    """Adds ``startup_id``: the company whose canonical name the column ``maker`` has, of several the smallest id;
    null if none has."""
    ids = startups_.groupBy(F.col("canonical_name").alias("__maker")).agg(F.min("id").alias("startup_id"))
    return products_.withColumn("__maker", canonical_name(F.col(maker))).join(ids, "__maker", "left").drop("__maker")
