"""Every operator as a query over the standard tables, with its SQL where SQL can express it.

``QUERIES[name](spark, directory)`` gives a DataFrame; ``ORACLES[name]`` is the same in DuckDB's dialect.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import hashing as H
from ..functions import html as P
from ..functions import outline as O
from ..functions import text as X
from ..functions import url as U
from ..operators import chunking, enrichment, extraction, freshness, metrics, queues, records, repositories, resolution, storage, vectors
from ..operators.pages import Ordered
from ..schemas import CONTENT, RECORD_TYPES, violations
from ..shared import numbered, shared_dir
from ..sources import crawlers, frontier, web

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Now, for every query that needs one.
AS_OF = "2024-01-30 00:00:00"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


c = F.col
# ------------------------------------------------------------------ addresses
S = r"'^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?'"
SPLIT = f"SELECT page_id, url, regexp_extract(url, {S}, 1) AS s, regexp_extract(url, {S}, 2) AS h, regexp_extract(url, {S}, 3) AS p, regexp_extract(url, {S}, 4) AS q FROM pages"


def _url(name: str, f: Callable[[Column], Column], sql: str) -> None:
    QUERIES[name] = lambda spark, d: table(spark, d, "pages").select("page_id", f(c("url")).alias("value"))
    ORACLES[name] = f"SELECT page_id, {sql} AS value FROM ({SPLIT})"


_NORM = (
    "lower(s) || '://' || regexp_replace(lower(h), '^www\\.', '') || CASE WHEN p = '/' THEN '/' ELSE regexp_replace(p, '/+$', '') END || "
    "CASE WHEN q <> '' THEN '?' || array_to_string(list_sort(string_split(q, '&')), '&') ELSE '' END"
)
_url("url_normalize", U.normalized, _NORM)
_url("url_domain", U.domain, "regexp_replace(lower(h), '^www\\.', '')")
_url("url_valid", U.is_valid, "s <> '' AND h <> ''")
_url("url_fix", lambda u: U.fixed(F.regexp_replace(u, "^https?://", "")), "'https://' || regexp_replace(url, '^https?://', '')")
_url("url_base", U.base, "s || '://' || h")
_url("url_path", U.path, "p")
_url("url_hash", H.url_hash, "sha256(lower(s) || '://' || lower(h) || regexp_replace(p, '/+$', '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END)")
_url("domain_allow", lambda u: U.allowed(F.concat(F.lit("https://"), F.regexp_extract(u, r"([a-z]+\.(?:com|org|net))(?:/|$)", 1)), ["example.com", "example.org"]),
     "regexp_extract(url, '([a-z]+\\.(?:com|org|net))(?:/|$)', 1) IN ('example.com', 'example.org')")


@query(f"SELECT regexp_replace(lower(h), '^www\\.', '') AS domain, count(*) AS pages, count(DISTINCT {_NORM}) AS addresses, count(DISTINCT sha256(html)) AS bodies FROM (SELECT x.*, html FROM ({SPLIT}) x JOIN pages USING (page_id)) GROUP BY 1")
def pages_by_domain(spark, d):
    """Distinct normalized addresses and bodies of each domain."""
    rows = table(spark, d, "pages").select(U.domain(c("url")).alias("domain"), U.normalized(c("url")).alias("u"), H.content_hash(c("html")).alias("h"))
    return rows.groupBy("domain").agg(F.count("*").alias("pages"), F.count_distinct("u").alias("addresses"), F.count_distinct("h").alias("bodies"))


@query(f"SELECT page_id, CAST(floor((row_number() OVER (PARTITION BY h ORDER BY page_id) - 1) / 5.0) AS BIGINT) AS slot FROM ({SPLIT})")
def rate_limit_slots(spark, d):
    return web.rate_slots(table(spark, d, "pages").select("page_id", "url"), "url", ["page_id"]).select("page_id", c("slot").cast("long").alias("slot"))


@query("SELECT event_id, status, status IN (408,429,500,502,503,504) AS retry, least(pow(2, event_id % 8), 60.0) AS delay FROM (SELECT event_id, CAST([200,404,408,429,500,502,503,504][event_id % 8 + 1] AS INTEGER) AS status FROM events)")
def retry_classify(spark, d):
    codes = F.array(*[F.lit(x) for x in (200, 404, 408, 429, 500, 502, 503, 504)])
    rows = table(spark, d, "events").select("event_id", F.element_at(codes, (c("event_id") % 8 + 1).cast("int")).alias("status"))
    return rows.select("event_id", "status", X.retryable(c("status")).alias("retry"), X.retry_delay(c("event_id") % 8, F.lit(None)).alias("delay"))


# ------------------------------------------------------------------ hashes and stored documents
@query("SELECT doc_id, sha256(text) AS hash FROM documents")
def content_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", H.content_hash(c("text")).alias("hash"))


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS content_hash, count(*) AS copies FROM documents GROUP BY 2")
def raw_documents(spark, d):
    rows = table(spark, d, "documents").select("doc_id", H.content_hash(c("text")).alias("content_hash"))
    return rows.groupBy("content_hash").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("SELECT doc_id FROM documents WHERE doc_id % 2 = 1 AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0)")
def new_docs_anti(spark, d):
    rows = table(spark, d, "documents").select("doc_id", H.content_hash(c("text")).alias("content_hash"))
    return storage.not_stored(rows.where("doc_id % 2 = 1"), rows.where("doc_id % 2 = 0"), "content_hash").select("doc_id")


@query("SELECT page_id, sha256('news:' || url) AS id FROM pages")
def entity_ids(spark, d):
    return table(spark, d, "pages").select("page_id", storage.record_id("NEWS", c("url")).alias("id"))


@query("SELECT event_id, sha256('{\"a\": ' || event_id || ', \"k\": ' || CAST(json_extract(props, '$.k') AS VARCHAR) || ', \"z\": \"' || event_type || '\"}') AS hash FROM events")
def dict_hash(spark, d):
    """Objects whose fields come in another order than that of their names."""
    made = F.concat(F.lit('{"z":"'), "event_type", F.lit('",'), F.substr("props", F.lit(2), F.length("props") - 2), F.lit(',   "a":'), c("event_id").cast("string"), F.lit("}"))
    return table(spark, d, "events").select("event_id", H.dict_hash(made).alias("hash"))


# ------------------------------------------------------------------ text
WS = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\\n{{3,}}', E'\\n\\n', 'g'), '[ \\t]+', ' ', 'g'), '\\n \\n', E'\\n\\n', 'g'), '\\n ', E'\\n', 'g'), ' \\n', E'\\n', 'g'), E' \\n\\t\\r')"


def _names(spark, d) -> DataFrame:
    n = table(spark, d, "customer").select(c("c_custkey").alias("id"), F.concat(F.lit("The "), F.regexp_replace("c_name", "#", " & "), F.lit(", Inc. "), F.col("c_mktsegment")).alias("name"))
    return n.unionByName(table(spark, d, "supplier").select((-c("s_suppkey")).alias("id"), F.concat(c("s_name"), F.lit(" Söhne GmbH.")).alias("name")))


NAMES = "SELECT c_custkey AS id, 'The ' || replace(c_name, '#', ' & ') || ', Inc. ' || c_mktsegment AS name FROM customer UNION ALL SELECT -s_suppkey, s_name || ' Söhne GmbH.' FROM supplier"


def _norm_sql(x: str, words: list[str]) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s\\-'']', '', 'g'), '\\b({'|'.join(words)})\\b', '', 'g'), ' +', ' ', 'g'))"


@query(f"SELECT doc_id, {WS.format('text')} AS value FROM documents")
def ws_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", X.blanks_normalized(c("text")).alias("value"))


@query(f"SELECT id, {_norm_sql('name', X.LEGAL)} AS value FROM ({NAMES})")
def name_normalize(spark, d):
    return _names(spark, d).select("id", X.name_normalized(c("name")).alias("value"))


@query(f"SELECT id, {_norm_sql('nfc_normalize(name)', X.LEGAL_MORE)} AS value FROM ({NAMES})")
def canonical_name(spark, d):
    return _names(spark, d).select("id", resolution.canonical_name(c("name")).alias("value"))


@query("SELECT doc_id, CASE WHEN length(text) <= 500 THEN text ELSE regexp_replace(left(text, 500), '\\n{1,2}$', '') END AS value FROM documents")
def truncate(spark, d):
    return table(spark, d, "documents").select("doc_id", X.truncated(c("text"), 500).alias("value"))


@query("SELECT doc_id, CAST(floor(length(text) / 4) AS BIGINT) AS tokens FROM documents")
def token_estimate(spark, d):
    return table(spark, d, "documents").select("doc_id", X.tokens(c("text")).alias("tokens"))


@query("SELECT doc_id, floor(length(text) / 4) > 500 AS too_large FROM documents")
def too_large(spark, d):
    return table(spark, d, "documents").select("doc_id", X.too_large(c("text"), 500).alias("too_large"))


@query("SELECT doc_id, string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM documents")
def split_sentences(spark, d):
    return table(spark, d, "documents").select("doc_id", X.sentences(c("text")).alias("parts"))


_MARKED = "regexp_replace(text, '\\n', E'\\n\\n# ', 'g')"


@query(f"SELECT doc_id, list_filter(list_transform(string_split_regex({_MARKED}, '\\n{{2,}}'), lambda p: trim(p, E' \\n\\t\\r')), lambda p: p <> '') AS parts FROM documents")
def split_paragraphs(spark, d):
    marked = F.regexp_replace("text", "\n", "\n\n# ")
    return table(spark, d, "documents").select("doc_id", X.paragraphs(marked).alias("parts"))


_ASCII_BLANK, _BLANK = r"[\s\x0b]", r"[\s\x0b\x{85}\p{Z}]"


@query(f"SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(text, '{_ASCII_BLANK}+$', ''), '\\n{_ASCII_BLANK}*'), lambda p, i: regexp_replace(CASE WHEN i > 1 THEN '## ' ELSE '' END || p, '^{_BLANK}+|{_BLANK}+$', '', 'g')), lambda p: p <> '') AS parts FROM documents")
def split_headings(spark, d):
    marked = F.regexp_replace("text", r"\n\s*(?=\S)", "\n## ")
    return table(spark, d, "documents").select("doc_id", X.heading_sections(marked).alias("parts"))


# ------------------------------------------------------------------ classifiers
_R, _O = "|".join(X.REMOTE), "|".join(X.ON_SITE)


@query(f"SELECT doc_id, CASE WHEN regexp_matches(lower(text || suffix), '{_R}') THEN true WHEN regexp_matches(lower(text || suffix), '{_O}') THEN false END AS is_remote FROM (SELECT *, [' Remote', ' Office', ''][doc_id % 3 + 1] AS suffix FROM documents)")
def remote_flag(spark, d):
    suffix = F.element_at(F.array(F.lit(" Remote"), F.lit(" Office"), F.lit("")), (c("doc_id") % 3 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", X.is_remote(F.concat("text", suffix)).alias("is_remote"))


_TITLES = ["Backend Engineer", "Postdoc", "UX lead", "Product Owner", "Chef"]


@query("SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(t, '{'|'.join(w)}') THEN '{k}'" for k, w in X.ROLES.items())
       + f" ELSE 'Other' END AS role_family FROM (SELECT p_partkey, lower({_TITLES}[p_partkey % 5 + 1] || chr(10) || p_name) AS t FROM part)")
def role_family(spark, d):
    title = F.element_at(F.array(*[F.lit(t) for t in _TITLES]), (c("p_partkey") % 5 + 1).cast("int"))
    return table(spark, d, "part").select("p_partkey", X.role_family(title, c("p_name")).alias("role_family"))


_PRICES = ["Free", "Freemium plan", "Enterprise", "Premium", "Paid only", "Ask"]


@query("SELECT p_partkey, CASE WHEN contains(p, 'freemium') THEN 'FREEMIUM' WHEN contains(p, 'free') THEN 'FREE' WHEN contains(p, 'enterprise') THEN 'ENTERPRISE' WHEN contains(p, 'paid') OR contains(p, 'premium') THEN 'PAID' END AS pricing "
       f"FROM (SELECT p_partkey, lower({_PRICES}[p_partkey % 6 + 1]) AS p FROM part)")  # fmt: skip
def pricing_norm(spark, d):
    p = F.element_at(F.array(*[F.lit(t) for t in _PRICES]), (c("p_partkey") % 6 + 1).cast("int"))
    return table(spark, d, "part").select("p_partkey", X.pricing(p).alias("pricing"))


@query("SELECT p_partkey, list_filter(list_transform(string_split_regex(p_name || '; ' || p_brand || ',' || p_type, '[;,]'), lambda a: trim(a)), lambda a: length(a) BETWEEN 1 AND 99) AS authors FROM part")
def author_split(spark, d):
    return table(spark, d, "part").select("p_partkey", X.authors(F.concat("p_name", F.lit("; "), "p_brand", F.lit(","), "p_type")).alias("authors"))


@query("SELECT page_id, nullif(regexp_extract('https://arxiv.org/' || CASE WHEN page_id % 3 = 0 THEN 'abs' WHEN page_id % 3 = 1 THEN 'pdf' ELSE 'list' END || '/' || (2400 + page_id % 100) || '.' || page_id || 'v2', '/(abs|pdf)/([0-9]+\\.[0-9]+)', 2), '') AS arxiv_id FROM pages")
def arxiv_id(spark, d):
    kind = F.when(c("page_id") % 3 == 0, "abs").when(c("page_id") % 3 == 1, "pdf").otherwise("list")
    made = F.concat(F.lit("https://arxiv.org/"), kind, F.lit("/"), (2400 + c("page_id") % 100).cast("string"), F.lit("."), c("page_id").cast("string"), F.lit("v2"))
    return table(spark, d, "pages").select("page_id", U.arxiv_id(made).alias("arxiv_id"))


# ------------------------------------------------------------------ pages
def _read(spark, d, *fields: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", "url", "html", P.page(c("html"), *fields).alias("page"))


def _entities(x: str) -> str:
    """The entities of the test pages as characters; like browsers, also those cut before their semicolon."""
    for name, char in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name};?', '{char}', 'g')"
    return x


@query(f"SELECT page_id, trim({_entities('regexp_extract(html, ' + chr(39) + '(?s)<title>(.*?)</title>' + chr(39) + ', 1)')}) AS title FROM pages")
def html_title(spark, d):
    return _read(spark, d, "title").select("page_id", "page.title")


@query(f"SELECT page_id, list_transform(regexp_extract_all(html, '(?s)<h[1-6]>(.*?)</h[1-6]>', 1), lambda x: trim({_entities('x')})) AS headings FROM pages")
def html_headings(spark, d):
    return _read(spark, d, "headings").select("page_id", "page.headings")


_GONE = "'(?s)<nav.*?</nav>|<footer.*?</footer>|<div class=.ad.>.*?</div>|<script.*?</script>|<style.*?</style>|<!--.*?-->|<![^>]*>|<[^>]+>'"
CLEAN = f"trim(regexp_replace({_entities(f'regexp_replace(html, {_GONE}, {chr(39)}{chr(39)}, {chr(39)}g{chr(39)})')}, '[ ' || chr(9) || ']+', ' ', 'g'), ' ' || chr(9) || chr(10) || chr(13))"


@query(f"SELECT page_id, {CLEAN} AS clean_text FROM pages")
def html_clean(spark, d):
    return _read(spark, d, "clean_text").select("page_id", "page.clean_text")


_BODY = "regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1)"


def _bare(x: str) -> str:
    return f"trim({_entities(f'regexp_replace({x}, {chr(39)}<[^>]+>{chr(39)}, {chr(39)}{chr(39)}, {chr(39)}g{chr(39)})')}, ' ' || chr(9) || chr(10) || chr(13))"


#: The article's text; its paragraphs where that is short.
MAIN = f"(SELECT page_id, html, CASE WHEN length({_bare(_BODY)}) > 100 THEN {_bare(_BODY)} ELSE array_to_string(list_filter(list_transform(string_split({_BODY}, '<p>')[2:], lambda x: {_bare('x')}), lambda x: x <> ''), chr(10) || chr(10)) END AS main, trim({_entities('regexp_extract(html, ' + chr(39) + '(?s)<title>(.*?)</title>' + chr(39) + ', 1)')}) AS title FROM pages)"


@query(f"SELECT page_id, main FROM {MAIN}")
def html_main(spark, d):
    return _read(spark, d, "main").select("page_id", "page.main")


def _headed(spark, d, *parts: str) -> DataFrame:
    """Pages with something put into a head of their own before them, read whole."""
    rows = table(spark, d, "pages")
    return rows.select("page_id", "url", "html", P.page(F.concat(_tagged(*parts), "html")).alias("page"))


@query("SELECT page_id, ['canonical_url=https://c/' || page_id, 'meta_author=Ann ' || page_id, 'meta_refresh=5', 'og_image=https://i/' || page_id || '.png', 'published_date=2024-01-02'] AS meta, "
       "'{\"name\": \"N' || page_id || '\", \"datePublished\": \"2024-01-02\"}' AS json_ld, regexp_extract_all(html, '<a href=\"([^\"]+)\"', 1) AS links, ['/one.png', '/' || page_id || '.png'] AS images FROM pages")  # fmt: skip
def html_meta(spark, d):
    rows = _headed(
        spark, d, '<meta name="Author" content="Ann {}"><meta http-equiv="refresh" content="5"><meta property="og:image" content="https://i/{}.png"><link rel="canonical" href="https://c/{}">',
        '<script type="application/ld+json">[{"name": "N{}", "datePublished": "2024-01-02"}]</script><img src="/one.png"><img><img src="/{}.png">',
    )
    named = F.transform(F.array_sort(F.map_entries("page.meta")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rows.select("page_id", named.alias("meta"), "page.json_ld", "page.links", "page.images")


@query("SELECT page_id, make_timestamp(2024, 1, page_id % 28 + 1, 0, 0, 0.0) AS published FROM pages")
def html_dates(spark, d):
    head = F.concat(F.lit('<html><time datetime="2024-01-'), F.lpad((c("page_id") % 28 + 1).cast("string"), 2, "0"), F.lit('"></time>'), c("html"))
    rows = table(spark, d, "pages").select("page_id", P.page(head, "dates").alias("page"))
    return records.with_best_date(rows, c("page.dates"), as_of(), "best").select("page_id", c("best.ts").cast("timestamp_ntz").alias("published"))


def _processed(spark, d) -> DataFrame:
    p = c("page")
    return _read(spark, d).select(
        "page_id", "url", U.normalized(c("url")).alias("normalized_url"), F.lit(200).alias("status_code"), H.content_hash(c("html")).alias("content_hash"),
        p["title"].alias("title"), p["clean_text"].alias("clean_text"), p["headings"].alias("headings"), p["paragraphs"].alias("paragraphs"), p["main"].alias("main"),
        p["marked"].alias("marked"), p["links"].alias("links"), p["images"].alias("images"), p["meta"].alias("meta"), p["json_ld"].alias("json_ld"), as_of().alias("fetched_at"),
    )


_PARTS = "list_transform(string_split(regexp_replace(html, '(?s)<script.*?</script>', '', 'g'), '<p>')[2:], lambda x: regexp_extract(x, '(?s)^(.*?)(?:</p>|</article>|$)', 1))"


@query(f"SELECT page_id, value AS normalized_url, sha256(html) AS content_hash, trim({_entities('regexp_extract(html, ' + chr(39) + '(?s)<title>(.*?)</title>' + chr(39) + ', 1)')}) AS title, {CLEAN} AS clean_text, "
       f"list_transform(regexp_extract_all(html, '(?s)<h[1-6]>(.*?)</h[1-6]>', 1), lambda x: trim({_entities('x')})) AS headings, list_filter(list_transform({_PARTS}, lambda x: {_bare('x')}), lambda x: x <> '') AS paragraphs, TIMESTAMP '{AS_OF}' AS fetched_at FROM pages JOIN ({ORACLES['url_normalize']}) USING (page_id)")  # fmt: skip
def process_documents(spark, d):
    return _processed(spark, d).select("page_id", "normalized_url", "content_hash", "title", "clean_text", "headings", "paragraphs", c("fetched_at").cast("timestamp_ntz").alias("fetched_at"))


@query("SELECT page_id, page_id % 3 > 0 AND page_id % 4 > 0 AS valid FROM pages")
def doc_validate(spark, d):
    """Every third page has lost its text, every fourth its address."""
    needed = ["url", "normalized_url", "content_hash", "title", "clean_text"]
    rows = _processed(spark, d).withColumn("clean_text", F.when(c("page_id") % 3 > 0, c("clean_text")).otherwise("")).withColumn("url", F.when(c("page_id") % 4 > 0, c("url")))
    return rows.select("page_id", F.expr("coalesce(" + " and ".join(f"{x} <> ''" for x in needed) + " and status_code <> 0 and fetched_at is not null, false)").alias("valid"))


_WHO = '<meta name="author" content="Ann {}"><meta property="og:image" content="https://i/{}.png">', '<span class="byline"> Bo {} </span><img src="/b{}.png">'


@query(f"SELECT page_id, 'NEWS' AS record_type, title, main AS body, CASE page_id % 3 WHEN 0 THEN 'Ann ' || page_id WHEN 1 THEN 'Bo ' || page_id END AS author, CASE page_id % 3 WHEN 0 THEN 'https://i/' || page_id || '.png' WHEN 1 THEN '/b' || page_id || '.png' END AS image_url, sha256(main) AS content_hash FROM {MAIN}")
def news_from_pages(spark, d):
    """A third of the pages names author and image in its head, a third shows them, a third does not say."""
    got = records.news_content(c("page"))
    before = F.when(c("page_id") % 3 == 0, _tagged(_WHO[0])).when(c("page_id") % 3 == 1, _tagged(_WHO[1])).otherwise("")
    pages = table(spark, d, "pages").select("page_id", P.page(F.concat(before, "html")).alias("page"))
    return pages.select("page_id", F.lit("NEWS").alias("record_type"), *[v.alias(k) for k, v in got.items()], H.content_hash(c("page.main")).alias("content_hash"))


_HREFS = "regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)"


@query(f"SELECT page_id, 'JOB' AS record_type, CASE page_id % 4 WHEN 0 THEN 'Org ' || page_id WHEN 1 THEN 'Firm ' || page_id WHEN 2 THEN 'Co ' || page_id ELSE 'Unknown' END AS company, title AS role, CASE page_id % 4 WHEN 0 THEN 'Town ' || page_id WHEN 1 THEN 'City ' || page_id WHEN 2 THEN 'Hall ' || page_id END AS location, CASE WHEN regexp_matches(lower(main), '{_R}') THEN true WHEN regexp_matches(lower(main), '{_O}') THEN false END AS is_remote, "
       "CASE " + " ".join(f"WHEN regexp_matches(lower(title || chr(10) || main), '{'|'.join(w)}') THEN '{k}'" for k, w in X.ROLES.items())
       + f" ELSE 'Other' END AS role_family, coalesce(list_filter({_HREFS}, lambda u: contains(u, 'apply'))[1], list_filter({_HREFS}, lambda u: contains(u, 'application'))[1]) AS application_url FROM {MAIN}")
def jobs_from_pages(spark, d):
    """Employer and place from the page's data, from its head, from its elements, or nowhere."""
    got, k = records.job_content(c("page")), c("page_id") % 4
    data = _tagged('<script type="application/ld+json">{"hiringOrganization": {"name": "Org ', "{}", '"}, "jobLocation": {"address": {"addressLocality": "Town ', "{}", '"}}}</script>')
    head = _tagged('<meta name="company" content="Firm {}"><meta name="location" content="City {}">')
    shown = _tagged("<span class='employer'>Co {}</span><span class='job-location'>Hall {}</span>")
    before = F.when(k == 0, data).when(k == 1, head).when(k == 2, shown).otherwise("")
    return table(spark, d, "pages").select("page_id", P.page(F.concat(before, "html")).alias("page")).select("page_id", F.lit("JOB").alias("record_type"), *[got[k].alias(k) for k in ("company", "role", "location", "is_remote", "role_family", "application_url")])


def _listed(spark, d, before: Column) -> DataFrame:
    """Pages with something put before them, as they are read for papers, products and companies."""
    html = F.concat(before, F.coalesce("html", F.lit("")))
    return table(spark, d, "pages").select(c("page_id").cast("string").alias("source_name"), F.concat(F.lit("https://arxiv.org/abs/2401."), c("page_id").cast("string")).alias("url"), F.lit(200).alias("status_code"), O.outline(html).alias("page"))


def _tagged(*parts: str) -> Column:
    """Markup in which ``{}`` stands for the page's id."""
    return F.concat(*[c("page_id").cast("string") if x == "{}" else F.lit(x) for p in parts for x in re.split(r"(\{\})", p) if x])


@query("SELECT page_id, 'https://arxiv.org/abs/2401.' || page_id AS source_url, 'Paper ' || page_id AS title, ['Ann ' || page_id, 'Bo'] AS authors, '2401.' || page_id AS external_id, CASE WHEN page_id % 5 < 4 THEN CAST(DATE '2024-01-01' + CAST(page_id % 300 AS INTEGER) AS TIMESTAMP) END AS published_date, 'https://arxiv.org/pdf/' || page_id AS pdf_url, 'cs.DB' AS category, 'Sum' AS abstract FROM pages")
def papers_from_pages(spark, d):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (c("page_id") % 300).cast("int"))
    said = F.lit("some day")
    for i, f in enumerate(records.PAPER_DATES):
        said = F.when(c("page_id") % 5 == i, F.lower(F.date_format(day, f))).otherwise(said)
    before = F.concat(_tagged("<h1 class='paper-title'>Paper {}</h1><div class='authors'>Ann {}; Bo</div><p class='date'>"), said, _tagged("</p><a href='/pdf/{}'>View PDF</a><i class='subject'>cs.DB</i><b class='abstract'>Sum</b>"))
    r = records.papers(_listed(spark, d, before))
    k = c("content")
    return r.select(c("source_name").cast("long").alias("page_id"), "source_url", k["title"].alias("title"), k["authors"].alias("authors"), k["external_id"].alias("external_id"), k["published_date"].cast("timestamp_ntz").alias("published_date"), k["pdf_url"].alias("pdf_url"), k["category"].alias("category"), k["abstract"].alias("abstract"))


@query("SELECT page_id, 'Tool ' || page_id AS product_name, CASE WHEN page_id % 2 = 0 THEN 'https://p/' || page_id ELSE 'https://w/' || page_id END AS website, CASE WHEN page_id % 2 = 0 THEN 'PAID' ELSE 'FREEMIUM' END AS pricing_model, CASE WHEN page_id % 2 = 1 THEN CAST(page_id AS INTEGER) END AS upvotes, CASE WHEN page_id % 2 = 0 THEN 'For ' || page_id ELSE 'Does ' || page_id END AS description, CASE WHEN page_id % 2 = 1 THEN ['AI', 't' || page_id] END AS tags FROM pages")
def products_from_pages(spark, d):
    """Even pages carry a data list, odd ones show the fields as elements."""
    data = _tagged("<script type='application/ld+json'>[{\"@type\": \"Thing\"}, {\"@type\": \"Product\", \"name\": \"Tool {}\", \"description\": \"For ", "{}", "\", \"url\": \"https://p/", "{}", "\", \"offers\": {\"price\": \"paid\"}}]</script>")
    shown = _tagged("<h1>Tool {}</h1><span class='upvotes'>{} votes</span><a href='https://w/{}'>Visit</a><i>Pricing: freemium</i><p class='description'>Does {}</p><b class='tag'>AI</b><b class='tag'>t{}</b>")
    k = c("content")
    r = records.products(_listed(spark, d, F.when(c("page_id") % 2 == 0, data).otherwise(shown)))
    return r.select(c("source_name").cast("long").alias("page_id"), *[k[x].alias(x) for x in ("product_name", "website", "pricing_model", "upvotes", "description", "tags")])


@query("SELECT page_id, 'Firm ' || page_id AS entity_name, 'Winter 2024' AS batch, 'https://f/' || page_id AS website, 'Makes things' AS description FROM pages")
def startups_from_pages(spark, d):
    before = _tagged("<h1>Firm {}</h1><div class='bio'>Makes things</div><a href='https://f/{}'>http://f</a><b> Winter 2024 </b>")
    k = c("content")
    return records.startups(_listed(spark, d, before)).select(c("source_name").cast("long").alias("page_id"), *[k[x].alias(x) for x in ("entity_name", "batch", "website", "description")])


@query("SELECT page_id, ['https://arxiv.org/abs/' || page_id, 'https://x.example/pdf/1'] AS urls FROM pages")
def links_discovered(spark, d):
    before = _tagged("<a href='/abs/{}'>a</a><a href='/list/'>b</a><a href='//x.example/pdf/1'>c</a>")
    return _listed(spark, d, before).select(c("source_name").cast("long").alias("page_id"), records.discovered(c("page"), "arxiv", "https://arxiv.org").alias("urls"))


@query("SELECT page_id, ['https://www.producthunt.com/posts/p' || page_id] AS products, ['https://www.ycombinator.com/companies?company=c' || page_id] AS companies FROM pages")
def records_discovered(spark, d):
    """Record links of a product and of a company listing."""
    before = _tagged("<a href='/posts/p{}'>a</a><a href='/topics/x'>b</a><a href='/companies?company=c{}'>c</a><a href='/about'>d</a>")
    found = [records.discovered(c("page"), name, crawlers.CRAWLERS[name].base) for name in ("producthunt", "ycombinator")]
    return _listed(spark, d, before).select(c("source_name").cast("long").alias("page_id"), found[0].alias("products"), found[1].alias("companies"))


class _Answers(web.WebPages):
    """Answers without a network: a page that names its address, in Latin-1 or broken UTF-8, or an error."""

    @classmethod
    def name(cls) -> str:
        return "answers"

    @staticmethod
    def fetcher(url: str, timeout: float, limit: int) -> web.Fetched:
        n = int(url.rsplit("/", 1)[1])
        if n % 10 == 9:
            return web.Fetched(404, b"", {})
        if n % 10 == 8:
            raise web.PayloadTooLargeError
        latin = n % 2 == 0
        body = f"<h1>é {n}</h1>".encode("latin-1" if latin else "utf-8") + (b"" if latin else b"\xff")
        return web.Fetched(200, body, {"Content-Type": "text/html; charset=ISO-8859-1" if latin else "text/html"})


def _answers(spark) -> DataFrame:
    spark.dataSource.register(_Answers)
    urls = "\n".join(f"https://s{n % 3}.example/{n}" for n in range(40))
    return spark.read.format("answers").option("urls", urls).option("source", "github").option("max_per_second", 1_000_000).option("base_delay", 0).load()


@query("SELECT 'https://s' || (n % 3) || '.example/' || n AS url, CASE WHEN n % 10 = 9 THEN 404 WHEN n % 10 <> 8 THEN 200 END AS status_code, CASE WHEN n % 10 = 9 THEN '' WHEN n % 10 = 8 THEN NULL ELSE '<h1>é ' || n || '</h1>' || CASE WHEN n % 2 = 1 THEN chr(65533) ELSE '' END END AS html, "
       "CASE n % 10 WHEN 9 THEN 'HTTPError' WHEN 8 THEN 'PayloadTooLargeError' END AS error_class, CAST(14 AS BIGINT) AS source_id FROM (SELECT unnest(range(40)) AS n)")  # fmt: skip
def web_read(spark, d):
    """Pages through the data source, decoded and joined to their source."""
    return crawlers.decoded(_answers(spark), web.sources(spark)).select("url", "status_code", "html", "error_class", "source_id")


@query("SELECT 's' || (n % 3) || '.example' AS domain, count(*) FILTER (WHERE n % 10 < 8) AS succeeded, count(*) FILTER (WHERE n % 10 >= 8) AS failed, list_sort(list_filter(list_distinct(list(CASE n % 10 WHEN 9 THEN 'HTTPError' WHEN 8 THEN 'PayloadTooLargeError' END)), lambda x: x IS NOT NULL)) AS errors FROM (SELECT unnest(range(40)) AS n) GROUP BY 1")
def web_summary(spark, d):
    return crawlers.summary(_answers(spark))


@query()
def crawl_to_store(spark, d):
    """Pages of five kinds read, filtered by freshness, routed and put into their tables; rows per table."""
    from . import crawl

    kind = F.element_at(F.array(*[F.lit(k) for k in RECORD_TYPES]), (c("page_id") % 5 + 1).cast("int"))
    pages = table(spark, d, "pages").select("url", F.lower(kind).alias("source_name"), kind.alias("record_type"), F.when(c("page_id") % 10 == 9, 404).otherwise(200).alias("status_code"), "html")
    return crawl.store(spark, pages, shared_dir(spark, "crawl"), as_of())


# ------------------------------------------------------------------ dates
@query("SELECT o_orderkey, CASE WHEN o_orderkey % 17 IN (7, 8) AND day(o) <= 12 THEN make_timestamp(year(o), day(o), month(o), 0, 0, 0.0) ELSE o END AS ts FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o FROM orders)")
def date_formats(spark, d):
    day = c("o_orderdate").cast("date")
    text = F.lit(None).cast("string")
    for i, f in enumerate(D.FORMATS):
        text = F.when(c("o_orderkey") % 17 == i, F.date_format(day.cast("timestamp"), f)).otherwise(text)
    return table(spark, d, "orders").select("o_orderkey", D.common(text).cast("timestamp_ntz").alias("ts"))


_UNITS = list(D._SECONDS)


@query(f"SELECT event_id, TIMESTAMP '{AS_OF}' - to_seconds((event_id % 50) * {list(D._SECONDS.values())}[event_id % 7 + 1]) AS ts FROM events")
def date_relative(spark, d):
    unit = F.element_at(F.array(*[F.lit(u) for u in _UNITS]), (c("event_id") % 7 + 1).cast("int"))
    said = F.concat((c("event_id") % 50).cast("string"), F.lit(" "), unit, F.lit("s ago"))
    return table(spark, d, "events").select("event_id", D.relative(said, as_of()).cast("timestamp_ntz").alias("ts"))


@query(f"SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN d WHEN 1 THEN d WHEN 2 THEN TIMESTAMP '{AS_OF}' - INTERVAL 3 DAY WHEN 4 THEN d END AS ts, CASE o_orderkey % 5 WHEN 0 THEN 0.99 WHEN 1 THEN 0.95 WHEN 2 THEN 0.85 WHEN 4 THEN 0.7 ELSE 0.0 END::DOUBLE AS confidence FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d FROM orders)")
def date_cascade(spark, d):
    """All four steps; what only the lenient parser reads is the date of a mail header."""
    k, day = c("o_orderkey") % 5, c("o_orderdate").cast("date")
    said = F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.date_format(day, "MMMM d, yyyy")).when(k == 2, "3 days ago").when(k == 4, F.date_format(day, "EEE, dd MMM yyyy")).otherwise("soon")
    rows = D.with_read(table(spark, d, "orders"), F.array(said), as_of(), "read").select("o_orderkey", c("read")[0].alias("x"))
    return rows.select("o_orderkey", c("x.ts").cast("timestamp_ntz").alias("ts"), c("x.confidence").cast("double").alias("confidence"))


@query("SELECT o_orderkey, [strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%b %-d, %Y'), strftime(o_orderdate, '%-m/%-d/%Y')] AS found FROM orders")
def text_dates(spark, d):
    o = c("o_orderdate")
    said = F.concat(F.lit("Paid "), F.date_format(o, "M/d/yyyy"), F.lit(" for "), F.date_format(o, "MMM d, yyyy"), F.lit(" not "), F.date_format(o, "yyyy-MM-dd"), F.lit("."))
    return table(spark, d, "orders").select("o_orderkey", D.in_text(said).alias("found"))


@query(f"SELECT event_id, TIMESTAMP '{AS_OF}' - ts <= INTERVAL 24 HOUR AS fresh FROM events")
def freshness_dated(spark, d):
    return table(spark, d, "events").select("event_id", D.is_fresh(c("ts").cast("timestamp"), as_of()).alias("fresh"))


# ------------------------------------------------------------------ freshness and routing
def _records(spark, d) -> DataFrame:
    """Events as records: every third has no date."""
    e = table(spark, d, "events")
    return e.select(
        "event_id", F.when(c("event_id") % 3 != 0, c("ts").cast("timestamp")).alias("published"), c("props").alias("body"), F.lit(0.95).alias("date_confidence"),
        F.when(c("event_id") % 2 == 0, "meta").alias("date_source"), c("event_type"),
    )


def _annotated(spark, d) -> DataFrame:
    r = _records(spark, d)
    return freshness.annotated(r, c("published"), c("body"), c("date_confidence"), c("date_source"), as_of(), ["event_id"])


FRESH = f"""
SELECT event_id, event_type,
  CASE WHEN dated THEN TIMESTAMP '{AS_OF}' - ts <= INTERVAL 24 HOUR ELSE n = 1 END AS is_fresh,
  CASE WHEN dated THEN CASE WHEN event_id % 2 = 0 THEN 1.0 ELSE 0.95 END WHEN n = 1 THEN 0.3 ELSE 0.5 END::DOUBLE AS freshness_confidence,
  CASE WHEN dated THEN CASE WHEN event_id % 2 = 0 THEN 'meta' ELSE 'unknown' END WHEN n = 1 THEN 'heuristic' ELSE 'content_hash_duplicate' END AS freshness_source
FROM (SELECT *, event_id % 3 <> 0 AS dated, row_number() OVER (PARTITION BY event_id % 3 <> 0, coalesce(props, '') ORDER BY event_id) AS n FROM events)"""


@query(f"SELECT event_id, is_fresh, freshness_confidence, freshness_source FROM ({FRESH})")
def freshness_filter(spark, d):
    return _annotated(spark, d).select("event_id", "is_fresh", c("freshness_confidence").cast("double").alias("freshness_confidence"), "freshness_source")


@query(f"SELECT event_id, event_type, CASE WHEN is_fresh THEN 'fresh' ELSE 'stale' END AS side FROM ({FRESH})")
def freshness_split(spark, d):
    """Records judged once, each read from the side it was written to."""
    sides = zip(freshness.split(_annotated(spark, d)), ("fresh", "stale"), strict=True)
    fresh, stale = (rows.select("event_id", "event_type", F.lit(name).alias("side")) for rows, name in sides)
    return fresh.unionByName(stale)


@query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256(text)")
def freshness_heuristic(spark, d):
    rows = table(spark, d, "documents").select("doc_id", H.content_hash(c("text")).alias("h"))
    return freshness.first_seen(rows, c("h"), ["doc_id"]).select("doc_id")


_KIND = {"click": "NEWS", "view": "JOB", "purchase": "PRODUCT", "signup": "STARTUP"}


_STEPS = ["crawl", "extract", "enrich:github", "resolve:entity", "export:sheets", "other"]


@query(f"SELECT event_id, CASE WHEN event_id % 6 = 0 THEN CASE event_type WHEN 'click' THEN 'crawl:news' WHEN 'view' THEN 'crawl:job' WHEN 'purchase' THEN 'crawl:product' WHEN 'signup' THEN 'crawl:startup' ELSE 'deadletter' END WHEN event_id % 6 = 5 THEN 'deadletter' ELSE {_STEPS}[event_id % 6 + 1] END AS queue, is_fresh FROM ({FRESH})")
def route_records(spark, d):
    """Every record with the queue of its next step."""
    kind = F.lit(None).cast("string")
    for k, v in _KIND.items():
        kind = F.when(c("event_type") == k, v).otherwise(kind)
    step = F.element_at(F.array(*[F.lit(x) for x in _STEPS]), (c("event_id") % 6 + 1).cast("int"))
    return _annotated(spark, d).select("event_id", queues.queue_of(step, kind).alias("queue"), "is_fresh")


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'crawl:news' WHEN 'view' THEN 'crawl:job' WHEN 'purchase' THEN 'crawl:product' WHEN 'signup' THEN 'crawl:startup' ELSE 'deadletter' END AS queue FROM events")
def queue_split(spark, d):
    """Jobs dealt into all ten queues in one pass, and read from each."""
    kind = F.lit(None).cast("string")
    for k, v in _KIND.items():
        kind = F.when(c("event_type") == k, v).otherwise(kind)
    dealt = queues.queues_of(table(spark, d, "events").select("event_id", "event_type"), F.lit("crawl"), kind)
    out = None
    for name, rows in dealt.items():
        one = rows.select("event_id", F.lit(name).alias("queue"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"SELECT event_id, event_type FROM ({FRESH}) WHERE is_fresh AND event_type = 'click'")
def fresh_news(spark, d):
    rows = _annotated(spark, d).withColumn("record_type", F.when(c("event_type") == "click", "NEWS"))
    return freshness.fresh_only(rows, "NEWS").select("event_id", "event_type")


@query(f"SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o WHEN 1 THEN o - INTERVAL 1 DAY END AS published FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o FROM orders)")
def published_date(spark, d):
    """A third says the date itself, a third only in its provenance, a third nowhere."""
    day, k = c("o_orderdate").cast("date"), c("o_orderkey") % 3
    mine = F.when(k == 0, F.date_format(day, "MMMM d, yyyy"))
    prov = F.when(k == 0, "1999-01-01").when(k == 1, F.date_format(F.date_sub(day, 1), "yyyy-MM-dd"))
    rows = freshness.with_published_date(table(spark, d, "orders"), mine, prov, as_of(), "published")
    return rows.select("o_orderkey", c("published").cast("timestamp_ntz").alias("published"))


#: For each record type its fields in order, when each breaks a rule, and a value that does and one that does not.
_BROKEN = {
    "STARTUP": [("entity_name", 7, "null", "'x'"), ("employee_count", 5, "-1", "null"), ("founded_year", 3, "1850", "1990")],
    "PRODUCT": [("product_name", 7, "null", "'x'"), ("pricing_model", 5, "'CHEAP'", "'PAID'"), ("upvotes", 3, "-5", "5")],
    "RESEARCH_PAPER": [("title", 7, "null", "'x'"), ("paper_url", 5, "null", "'u'"), ("github_stars", 3, "-1", "0")],
    "JOB": [("company", 7, "null", "'x'"), ("role", 5, "null", "'r'"), ("salary_min", 3, "-1d", "null"), ("salary_max", 2, "-1d", "1d")],
    "NEWS": [("title", 7, "null", "'x'"), ("body", 5, "null", "'b'")],
}


@query(" UNION ALL ".join(
    f"SELECT p_partkey, '{kind}' AS record_type, list_filter([" + ", ".join(f"CASE WHEN p_size % {n} = 0 THEN '{f}' END" for f, n, _, _ in fields) + "], lambda x: x IS NOT NULL) AS violations FROM part"
    for kind, fields in _BROKEN.items()))
def schema_validate(spark, d):
    """The rules of all five record types."""
    out = None
    for kind, fields in _BROKEN.items():
        rows = table(spark, d, "part").select("p_partkey", *[F.expr(f"if(p_size % {n} = 0, {bad}, {good})").alias(f) for f, n, bad, good in fields])
        rows = rows.select("p_partkey", F.lit(kind).alias("record_type"), violations(kind).alias("violations"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("SELECT doc_id, source, CAST(n AS INTEGER) AS position FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 20")
def page_cap(spark, d):
    return storage.capped(table(spark, d, "documents").select("doc_id", "source"), "source", ["doc_id"], 20)


@query("SELECT DISTINCT url_hash FROM (SELECT sha256(value) AS url_hash FROM pages JOIN (" + ORACLES["url_normalize"] + ") USING (page_id) WHERE trim(url) <> '')")
def frontier_new(spark, d):
    """Addresses of pages, added to a frontier in two overlapping lots: each is in it once."""
    urls = table(spark, d, "pages").select("page_id", "url")
    found = frontier.Frontier(spark, shared_dir(spark, "frontier"))
    found.add(urls.where("page_id % 3 < 2"))
    found.add(urls.where("page_id % 3 > 0"))
    return found.addresses().select("url_hash")


# ------------------------------------------------------------------ stored tables
@query("SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def upsert_latest(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return storage.upsert(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 <> 0"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)")
def get_record(spark, d):
    """A stored record by its key, read from the one part it can be in."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    t = storage.Table(spark, shared_dir(spark, "orders"), o.schema, ["o_orderkey"], ["o_custkey"], 4_000)
    t.put(o)
    return t.get(o_orderkey=o.agg(F.max("o_orderkey")).first()[0])


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100 OFFSET 200")
def list_page(spark, d):
    """From a copy in order, of which a page opens the ranges it falls in."""
    o, order = table(spark, d, "orders").select("o_orderkey", "o_orderdate"), [c("o_orderdate").desc(), c("o_orderkey")]
    return Ordered(spark, shared_dir(spark, "pages"), o.schema).write(o, order).page(order, 100, 200)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def count_by_type(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT doc_id, s.id AS source_id FROM documents d LEFT JOIN (SELECT source, row_number() OVER (ORDER BY source) AS id FROM (SELECT DISTINCT source FROM documents WHERE doc_id % 2 = 0)) s ON d.source = s.source")
def source_join(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    known = numbered(docs.where("doc_id % 2 = 0").select("source").distinct(), "source_id", [c("source")])
    return docs.join(known, "source", "left").select("doc_id", "source_id")


# ------------------------------------------------------------------ request metrics
def _metrics(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        "event_id", c("event_type").alias("source_name"), F.concat(F.lit("d"), (c("user_id") % 7).cast("string")).alias("domain"), (c("event_type") != "error").alias("success"),
        c("value").alias("duration"), F.when(c("event_type") == "error", 500).otherwise(200).alias("status_code"), "ts",
    )


METRICS = "(SELECT event_id, event_type AS source_name, 'd' || (user_id % 7) AS domain, event_type <> 'error' AS success, value AS duration, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code, ts FROM events)"
TOTALS = "count(*) AS total, count(*) FILTER (WHERE success) AS succeeded, count(*) FILTER (WHERE NOT success) AS failed, round(count(*) FILTER (WHERE success) / count(*), 6) AS success_rate, round(coalesce(avg(duration) FILTER (WHERE success), 0), 6) AS avg_duration"


@query(f"SELECT source_name, {TOTALS} FROM {METRICS} GROUP BY 1")
def metrics_by_source(spark, d):
    return metrics.by(_metrics(spark, d), "source_name")


@query(f"SELECT CASE WHEN source_name IN ('click', 'view', 'purchase', 'error') THEN source_name ELSE 'other' END AS source_name, count(*) AS total, count(*) FILTER (WHERE success) AS succeeded, round(coalesce(sum(duration) FILTER (WHERE success), 0), 4) AS seconds FROM {METRICS} GROUP BY 1")
def stream_watched(spark, d):
    """Totals that a stream reports while it runs."""
    from ..streaming.batch import watched_events

    return watched_events(spark, d).withColumn("seconds", F.round("seconds", 4) + 0.0)


@query(f"SELECT domain, {TOTALS} FROM {METRICS} GROUP BY 1")
def metrics_by_domain(spark, d):
    return metrics.by(_metrics(spark, d), "domain")


@query(f"SELECT status_code, count(*) AS n FROM {METRICS} GROUP BY 1")
def status_distribution(spark, d):
    return _metrics(spark, d).groupBy("status_code").agg(F.count("*").alias("n"))


@query(f"SELECT source_name, list_sort(list(status_code || ':' || n)) AS codes FROM (SELECT source_name, status_code, count(*) AS n FROM {METRICS} GROUP BY 1, 2) GROUP BY 1")
def status_histogram(spark, d):
    rows = metrics.histogram(_metrics(spark, d), "source_name", "status_code")
    said = F.transform(F.map_entries("histogram"), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"].cast("string")))
    return rows.select("source_name", F.array_sort(said).alias("codes"))


@query(f"SELECT source_name, domain, CAST(grouping_id(source_name, domain) AS BIGINT) AS level, {TOTALS} FROM {METRICS} GROUP BY GROUPING SETS ((source_name), (domain), ())")
def metrics_summary(spark, d):
    return metrics.summary(_metrics(spark, d))


@query(f"SELECT source_name, count(*) FILTER (WHERE success) AS crawled, count(*) FILTER (WHERE NOT success) AS failed FROM {METRICS} GROUP BY ROLLUP (source_name)")
def crawl_rollup(spark, d):
    return _metrics(spark, d).rollup("source_name").agg(F.count_if("success").alias("crawled"), F.count_if(~c("success")).alias("failed"))


@query(f"SELECT date_trunc('hour', ts) AS hour, source_name, count(*) AS total, count(*) FILTER (WHERE NOT success) AS failed FROM {METRICS} GROUP BY 1, 2")
def metrics_hourly(spark, d):
    rows = _metrics(spark, d).groupBy(F.window(c("ts").cast("timestamp"), "1 hour").alias("w"), "source_name").agg(F.count("*").alias("total"), F.count_if(~c("success")).alias("failed"))
    return rows.select(c("w.start").cast("timestamp_ntz").alias("hour"), "source_name", "total", "failed")


@query(f"SELECT domain AS queue, count(*) FILTER (WHERE success) AS completed, count(*) FILTER (WHERE NOT success) AS failed FROM {METRICS} GROUP BY 1")
def queue_stats(spark, d):
    state = F.when(c("success"), "completed").otherwise("failed")
    return _metrics(spark, d).select(c("domain").alias("queue"), state.alias("state")).groupBy("queue").pivot("state", ["completed", "failed"]).count().na.fill(0)


JOBS = "(SELECT *, last_value(op) OVER (PARTITION BY queue, job_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS state, row_number() OVER (PARTITION BY queue, job_id ORDER BY seq) AS n FROM (SELECT 'd' || (user_id % 7) AS queue, user_id AS job_id, event_id AS seq, CASE event_type WHEN 'view' THEN 'enqueue' WHEN 'click' THEN 'dequeue' WHEN 'purchase' THEN 'complete' WHEN 'signup' THEN 'requeue' ELSE 'fail' END AS op FROM events))"


@query(f"SELECT queue, count(*) FILTER (WHERE n = 1 AND state IN ('enqueue', 'requeue')) AS size, count(*) FILTER (WHERE n = 1 AND state = 'dequeue') AS in_flight, count(*) FILTER (WHERE op = 'complete') AS completed, count(*) FILTER (WHERE op = 'fail') AS failed FROM {JOBS} GROUP BY 1")
def queue_states(spark, d):
    op = F.lit(queues.FAIL)
    for kind, name in (("view", queues.ENQUEUE), ("click", queues.DEQUEUE), ("purchase", queues.COMPLETE), ("signup", queues.REQUEUE)):
        op = F.when(c("event_type") == kind, name).otherwise(op)
    log = table(spark, d, "events").select(F.concat(F.lit("d"), (c("user_id") % 7).cast("string")).alias("queue"), c("user_id").alias("job_id"), c("event_id").alias("seq"), op.alias("op"))
    return queues.stats(log)


# ------------------------------------------------------------------ vectors
_VEC = "embedding::DOUBLE[]"


@query(f"SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.{_VEC}, b.{_VEC}), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_pairs(spark, d):
    e = table(spark, d, "embeddings")
    a, b = e.select(c("vec_id").alias("a"), c("embedding").alias("x")), e.select(c("vec_id").alias("b"), c("embedding").alias("y"))
    return a.join(b, c("b") == c("a") + 1).select("a", "b", (F.round(H.cosine(c("x"), c("y")), 6) + 0.0).alias("cosine"))


def _nearest(spark, d, k: int, exact: bool = True) -> DataFrame:
    e = table(spark, d, "embeddings")
    return vectors.nearest(e.where("vec_id % 100 = 0").select(c("vec_id").alias("query_id"), c("embedding").alias("qvec")), e.select("vec_id", c("embedding").alias("vec")), k, exact=exact)


TOP = f"SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.{_VEC}, v.{_VEC}) AS cosine, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.{_VEC}, v.{_VEC}), 12) DESC, v.vec_id) AS rank FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0"


@query(f"SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(cosine, 6) AS cosine FROM ({TOP}) WHERE rank <= 5")
def embed_topk(spark, d):
    """The queries are the vectors whose id is divisible by 100, against all vectors."""
    return _nearest(spark, d, 5).select("query_id", "rank", "vec_id", (F.round("cosine", 6) + 0.0).alias("cosine"))


@query()
def embed_index(spark, d):
    """As ``embed_topk``, but each query looks only into the cells nearest to it."""
    return _nearest(spark, d, 5, exact=False).select("query_id", "rank", "vec_id", (F.round("cosine", 6) + 0.0).alias("cosine"))


@query(f"SELECT query_id, vec_id, round(cosine, 6) AS cosine, cosine >= 0.85 AS accepted FROM ({TOP.replace('% 100 = 0', '% 100 = 0 AND v.vec_id <> q.vec_id')}) WHERE rank = 1")
def embed_resolve(spark, d):
    best = _nearest(spark, d, 2).where("vec_id <> query_id").groupBy("query_id").agg(F.min_by(F.struct("vec_id", "cosine"), "rank").alias("b"))
    return best.select("query_id", "b.vec_id", (F.round("b.cosine", 6) + 0.0).alias("cosine"), (c("b.cosine") >= resolution.EMBEDDING).alias("accepted"))


# ------------------------------------------------------------------ replies and prompts
@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def llm_json_parse(spark, d):
    reply = F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```\nDone."))
    return table(spark, d, "events").select("event_id", F.try_variant_get(H.parsed_reply(reply), "$.k", "int").alias("k"))


@query("SELECT event_id, '{ \"id\": ' || event_id || ', \"kind\": \"' || event_type || '\"}' AS repaired FROM events")
def json_repair(spark, d):
    broken = F.concat(F.lit("{id: "), c("event_id").cast("string"), F.lit(", kind: '"), "event_type", F.lit("',}"))
    return table(spark, d, "events").select("event_id", H.json_repaired(broken).alias("repaired"))


def _filled(kind: str, text: str) -> str:
    """A request as an SQL expression."""
    before, after = (extraction.TEMPLATES[kind].replace("{schema}", CONTENT[kind]).split("{text}"))
    return " || ".join(["'" + before.replace("'", "''").replace("\n", "' || chr(10) || '") + "'", text, "'" + after + "'"])


@query("SELECT doc_id, CASE doc_id % 5 " + " ".join(f"WHEN {i} THEN {_filled(k, 'text')}" for i, k in enumerate(RECORD_TYPES)) + " END AS prompt FROM documents")
def prompt_build(spark, d):
    kind = F.element_at(F.array(*[F.lit(k) for k in RECORD_TYPES]), (c("doc_id") % 5 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", extraction.prompt(kind, c("text")).alias("prompt"))


@query("SELECT doc_id, 'Find ' || 'title string, body string, published_date timestamp, author string, summary string, image_url string' || ' in <' || text || '>' AS own, 'Part ' || (doc_id % 7) AS part FROM documents")
def prompt_custom(spark, d):
    own = extraction.prompt(F.lit("NEWS"), c("text"), "Find {schema} in <{text}>")
    part = extraction.chunk_prompt(F.lit("NEWS"), c("text"), c("doc_id") % 7, F.lit(7))
    return table(spark, d, "documents").select("doc_id", own.alias("own"), F.initcap(F.regexp_extract(part, r"(part \d+) of 7", 1)).alias("part"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'T' || event_id WHEN 1 THEN 'T' END AS title, CASE event_id % 4 WHEN 1 THEN ['body'] WHEN 2 THEN ['reply'] WHEN 3 THEN ['title', 'body'] ELSE CAST([] AS VARCHAR[]) END AS violations FROM events")
def reply_validate(spark, d):
    """Replies that are whole, that lack a field, that are no JSON, and whose fields are of other kinds."""
    k, i = c("event_id") % 4, c("event_id").cast("string")
    reply = F.when(k == 0, F.concat(F.lit('```json\n{"title": "T'), i, F.lit('", "body": "B", "author": null}\n```'))).when(k == 1, '{title: \'T\',}').when(k == 2, "no idea").otherwise('{"title": ["x"], "body": {"y": 1}}')
    rows = table(spark, d, "events").select("event_id", reply.alias("reply"))
    return extraction.validated(rows, "reply", "NEWS").select("event_id", c("content.title").alias("title"), "violations")


@query()
def extract_records(spark, d):
    """Chunks through the provider chain (the offline stand-in here), replies parsed, chunks merged."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    pieces = chunking.chunked(docs, "doc_id", "text", 2000, 100).withColumn("prompt", extraction.prompt(F.lit("NEWS"), c("chunk")))
    got = extraction.answers(pieces, "prompt", [extraction.Echo()]).withColumn("v", H.parsed_reply(c("reply")))
    fields = got.select("doc_id", "chunk_no", F.try_variant_get("v", "$.title", "string").alias("title"), F.length(F.try_variant_get("v", "$.body", "string")).alias("body_chars"))
    return chunking.merged(fields, "doc_id", "chunk_no", ["title"], ["body_chars"])


@query("SELECT conv_id, list(role ORDER BY turn) AS roles, list(text ORDER BY turn) AS texts FROM conversations GROUP BY 1")
def chat_messages(spark, d):
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    return rows.select("conv_id", c("m.role").alias("roles"), c("m.text").alias("texts"))


@query("SELECT conv_id, arg_max(text, {'l': length(text), 't': -turn}) AS text, arg_max(role, turn) AS role FROM conversations GROUP BY 1")
def merge_chunks(spark, d):
    return chunking.merged(table(spark, d, "conversations"), "conv_id", "turn", ["text"], ["role"])


# ------------------------------------------------------------------ chunks
@query()
def chunk_documents(spark, d):
    rows = chunking.chunked(table(spark, d, "documents"), "doc_id", "text", 200, 20)
    return rows.select("doc_id", "chunk_no", F.length("chunk").alias("n_chars"), H.content_hash(c("chunk")).alias("hash"))


@query("SELECT conv_id, turn, coalesce(right(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), 40), '') || text AS chunk FROM conversations")
def chunk_overlap(spark, d):
    return chunking.overlapped(table(spark, d, "conversations"), "conv_id", "turn", "text", 10)


# ------------------------------------------------------------------ names and aliases
def _aliases(spark, d) -> DataFrame:
    return table(spark, d, "nation").select(F.concat("n_name", F.lit(" Inc.")).alias("raw"), F.concat(F.lit("Nation "), c("n_regionkey").cast("string")).alias("canonical"), c("n_nationkey").alias("seq"))


def _mentions(spark, d) -> DataFrame:
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return table(spark, d, "customer").join(n, c("c_nationkey") == c("n_nationkey"), "left").select(c("c_custkey").alias("name_id"), F.when(c("c_custkey") % 2 == 0, F.concat(F.lit("The "), "n_name")).otherwise(c("c_name")).alias("raw"))


MENTIONS = "(SELECT c_custkey AS name_id, CASE WHEN c_custkey % 2 = 0 THEN n_name END AS hit, n_regionkey AS r FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"


def _joined(spark, d, how: str) -> DataFrame:
    names = _mentions(spark, d).withColumn("norm", resolution.canonical_name(c("raw")))
    return names.join(resolution.alias_table(_aliases(spark, d)), "norm", how)


@query(f"SELECT name_id, CASE WHEN hit IS NOT NULL THEN 'nation ' || r END AS target FROM {MENTIONS}")
def alias_join(spark, d):
    return _joined(spark, d, "left").select("name_id", "target")


@query(f"SELECT name_id FROM {MENTIONS} WHERE hit IS NOT NULL")
def alias_semi(spark, d):
    return _joined(spark, d, "left_semi").select("name_id")


@query(f"SELECT name_id FROM {MENTIONS} WHERE hit IS NULL")
def alias_anti(spark, d):
    return _joined(spark, d, "left_anti").select("name_id")


@query("SELECT 'nation ' || n_regionkey AS target, list(lower(n_name) ORDER BY lower(n_name)) AS names FROM nation GROUP BY n_regionkey")
def alias_reverse(spark, d):
    return resolution.alias_table(_aliases(spark, d)).groupBy("target").agg(F.sort_array(F.collect_set("norm")).alias("names"))


def _fuzzy(spark, d, limit: int) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", resolution.canonical_name(c("p_name")).alias("n"), "p_name")
    names = p.where("p_partkey % 100 = 0").select(c("p_partkey").alias("name_id"), c("n").alias("norm"))
    return resolution.fuzzy_top(names, p.select(c("p_partkey").alias("candidate_id"), c("p_name").alias("candidate"), c("n").alias("cnorm")), limit)


@query()
def fuzzy_topk(spark, d):
    """The queries are the parts whose key is divisible by 100, against all parts."""
    return _fuzzy(spark, d, 5).select("name_id", "rank", "candidate_id", F.round("score", 4).alias("score"))


@query()
def fuzzy_best(spark, d):
    return _fuzzy(spark, d, 1).select("name_id", "candidate", F.round("score", 4).alias("score"))


def _resolved(spark, d) -> DataFrame:
    known = table(spark, d, "supplier").select(c("s_suppkey").alias("candidate_id"), c("s_name").alias("candidate"))
    names = _mentions(spark, d).unionByName(table(spark, d, "supplier").select((-1 - c("s_suppkey")).alias("name_id"), F.concat(c("s_name"), F.lit(" LLC")).alias("raw")))
    return resolution.resolved(names, resolution.alias_table(_aliases(spark, d)), known)


@query()
def entity_resolve(spark, d):
    return _resolved(spark, d)


@query()
def mapping_log(spark, d):
    return resolution.mapping_log(_resolved(spark, d))


# ------------------------------------------------------------------ repositories and feeds
def _papers(spark, d) -> DataFrame:
    return table(spark, d, "part").select(
        c("p_partkey").alias("paper_id"), c("p_brand").alias("title"), F.array(F.lit("Org1"), F.lit("Li")).alias("authors"), F.lit(None).cast("string").alias("github_url"),
        F.concat(F.lit("Code: http://www.github.com/org"), (c("p_partkey") % 3).cast("string"), F.lit("/"), F.regexp_replace("p_brand", "#", "-"), F.lit(".git. and/or github.com/x/y.")).alias("abstract"),
    )


@query("SELECT p_partkey AS paper_id, ['https://github.com/org' || (p_partkey % 3) || '/' || replace(p_brand, '#', '-'), 'https://github.com/x/y'] AS urls FROM part")
def repo_extract(spark, d):
    return _papers(spark, d).select("paper_id", U.repo_urls(c("abstract")).alias("urls"))


@query("SELECT p_partkey AS paper_id, list_sort(list_distinct(['https://github.com/a/a' || (p_partkey % 4), 'https://github.com/b/b', 'https://github.com/d/d' || p_partkey, 'https://github.com/m/m' || (p_partkey % 2)])) AS urls FROM part")
def repo_candidates(spark, d):
    """From the explicit field, the body, the content and the metadata, as an object or as text."""
    i = c("p_partkey").cast("string")
    meta = F.when(c("p_partkey") % 2 == 0, '{"github_url": "https://github.com/m/m0"}').otherwise("see github.com/m/m1.git.")
    rows = table(spark, d, "part").select(
        c("p_partkey").alias("paper_id"), F.concat(F.lit("http://www.github.com/a/a"), (c("p_partkey") % 4).cast("string"), F.lit("/")).alias("github_url"),
        F.lit("at github.com/b/b and github.com/b/b").alias("body"), F.concat(F.lit("https://github.com/d/d"), i).alias("content"), meta.alias("metadata"),
    )
    return rows.select("paper_id", F.array_sort(enrichment.all_candidates(rows)).alias("urls"))


@query("SELECT p_partkey, 'https://github.com/Org/' || replace(p_brand, '#', '-') AS url FROM part")
def repo_url_norm(spark, d):
    made = F.concat(F.element_at(F.array(F.lit("http://www.GitHub.com/Org/"), F.lit("github.com/Org/")), (c("p_partkey") % 2 + 1).cast("int")), F.regexp_replace("p_brand", "#", "-"), F.lit(".git/"))
    return table(spark, d, "part").select("p_partkey", U.repo_url(made).alias("url"))


@query("SELECT p_partkey AS paper_id, round(CASE WHEN p_partkey % 3 = 1 THEN 0.6 ELSE 0.5 END + CASE WHEN contains(lower(replace(p_brand, '#', '-')), lower(p_brand)) THEN 0.3 ELSE 0 END, 4)::DOUBLE AS confidence FROM part")
def repo_confidence(spark, d):
    return _papers(spark, d).select("paper_id", enrichment.confidence(F.element_at(U.repo_urls(c("abstract")), 1), c("title"), c("authors")).cast("double").alias("confidence"))


@query("SELECT p_partkey AS paper_id, CASE WHEN p_partkey % 3 <> 2 THEN 'https://github.com/org' || (p_partkey % 3) || '/' || replace(p_brand, '#', '-') END AS github_url, CASE WHEN p_partkey % 3 <> 2 THEN 7 END AS github_stars FROM part")
def repo_enrich(spark, d):
    papers = _papers(spark, d)
    repos = papers.where("paper_id % 3 <> 2").select(F.element_at(U.repo_urls(c("abstract")), 1).alias("repository_url"), F.lit(7).alias("stars")).distinct()
    return enrichment.enriched(papers, repos).select("paper_id", "github_url", "github_stars")


@query("SELECT page_id, ['https://arxiv.org/abs/2401.' || page_id] AS urls FROM pages")
def arxiv_feed(spark, d):
    feed = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2401.'), c("page_id").cast("string"), F.lit("v1</id></entry></feed>"))
    return table(spark, d, "pages").select("page_id", enrichment.feed_urls(feed).alias("urls"))


@query("SELECT page_id, ['https://ph.example/posts/s' || page_id] AS urls FROM pages")
def graphql_posts(spark, d):
    reply = F.concat(F.lit('{"data":{"posts":{"edges":[{"node":{"id":"1","name":"n","slug":"s'), c("page_id").cast("string"), F.lit('"}}]}}}'))
    return table(spark, d, "pages").select("page_id", enrichment.reply_urls(reply, "https://ph.example").alias("urls"))


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


@query(f"SELECT CAST(id AS BIGINT) AS id, name, base_url, source_type, enabled FROM (VALUES {_values([(i, *s[:3], True) for i, s in enumerate(web.SOURCES, 1)])}) t(id, name, base_url, source_type, enabled)")
def source_list(spark, d):
    return web.sources(spark)


@query("SELECT source_name, record_type, url FROM (VALUES " + _values([(s[0], s[2], s[1] + x) for s in web.SOURCES for x in s[3]]) + ") t(source_name, record_type, url) UNION ALL SELECT 'arxiv', 'RESEARCH_PAPER', "
       "'http://export.arxiv.org/api/query?search_query=cat%3Acs.AI+OR+cat%3Acs.LG+OR+cat%3Acs.CL+OR+cat%3Acs.CV+OR+cat%3Acs.NE+OR+cat%3Astat.ML&start=0&max_results=100&sortBy=submittedDate&sortOrder=descending'")  # fmt: skip
def source_listings(spark, d):
    return web.listings(spark).select("source_name", "record_type", "url")


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'https://api.github.com/repos/Org/' || replace(p_brand, '#', '-') END AS url FROM part")
def repo_api_address(spark, d):
    made = F.concat(F.when(c("p_partkey") % 2 == 0, "https://github.com/Org/").otherwise("https://gitlab.com/Org/"), F.regexp_replace("p_brand", "#", "-"))
    return table(spark, d, "part").select("p_partkey", U.repo_api_url(made).alias("url"))


def _replies(spark, d) -> DataFrame:
    """Replies of the repository service, one for every third part."""
    made = F.to_json(F.struct(F.concat(F.lit("https://github.com/org/r"), c("p_partkey").cast("string")).alias("html_url"), F.concat(F.lit("r"), c("p_partkey").cast("string")).alias("name"), F.struct(F.lit("org").alias("login")).alias("owner"), c("p_size").alias("stargazers_count"), c("p_name").alias("description")))
    return repositories.from_replies(table(spark, d, "part").where("p_partkey % 3 = 0").select(made.alias("body")), "body", as_of())


@query("SELECT p_partkey, p_partkey % 3 = 0 AS verified, CASE WHEN p_partkey % 3 = 0 THEN p_size END AS stars, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS description FROM part")
def repo_lookup(spark, d):
    asked = table(spark, d, "part").select("p_partkey", F.concat(F.lit("http://www.github.com/org/r"), c("p_partkey").cast("string"), F.lit(".git")).alias("url"))
    return repositories.looked_up(asked, "url", _replies(spark, d)).select("p_partkey", "verified", "stars", "description")


@query("SELECT 'https://github.com/org/r' || p_partkey AS repository_url, p_size AS stars FROM part WHERE p_partkey % 3 = 0 AND contains(lower(p_name), 'ring') ORDER BY p_size DESC, 1 LIMIT 10")
def repo_search(spark, d):
    """The ten most starred repositories that match: the limit is the feature."""
    return repositories.search(_replies(spark, d), "ring").select("repository_url", "stars")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS startup_id FROM customer")
def product_startup(spark, d):
    """Products linked to the company that has their maker's canonical name."""
    n = table(spark, d, "nation")
    made = table(spark, d, "customer").join(n, c("c_nationkey") == c("n_nationkey"), "left").select("c_custkey", F.when(c("c_custkey") % 2 == 0, F.concat("n_name", F.lit(", Inc."))).otherwise(c("c_name")).alias("maker"))
    return records.linked(made, n.select(c("n_nationkey").alias("id"), resolution.canonical_name(c("n_name")).alias("canonical_name")), "maker").select("c_custkey", "startup_id")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN least(value, 60) ELSE least(power(2, event_id % 8), 60) END AS seconds FROM events")
def retry_delay(spark, d):
    return table(spark, d, "events").select("event_id", X.retry_delay(c("event_id") % 8, F.when(c("event_id") % 3 == 0, c("value"))).alias("seconds"))


@query("SELECT event_id, CASE WHEN event_id % 20 <= 10 AND event_id % 50 > 25 THEN event_id % 50 - 25 + 1 ELSE 0 END::DOUBLE AS seconds FROM events")
def quota_wait(spark, d):
    return table(spark, d, "events").select("event_id", repositories.quota_wait(c("event_id") % 20, c("event_id") % 50, F.lit(25)).alias("seconds"))


# ------------------------------------------------------------------ streams, run to the end of the table
@query("SELECT sha256(props) AS content_hash FROM events GROUP BY 1")
def stream_first_seen(spark, d):
    from ..streaming.batch import first_seen_events

    return first_seen_events(spark, d)


@query("SELECT event_id, row_number() OVER (PARTITION BY props ORDER BY event_id) = 1 AS is_first FROM events")
def stream_first_marked(spark, d):
    from ..streaming.batch import marked_events

    return marked_events(spark, d)


@query("SELECT date_trunc('hour', ts) AS hour, event_type AS source_name, count(*) AS total, count(*) FILTER (WHERE event_type = 'error') AS failed FROM events GROUP BY 1, 2")
def stream_hourly(spark, d):
    from ..streaming.batch import hourly_events

    return hourly_events(spark, d).select(c("hour").cast("timestamp_ntz").alias("hour"), "source_name", "total", "failed")


@query(f"SELECT event_id FROM events WHERE TIMESTAMP '{AS_OF}' - ts <= INTERVAL 24 HOUR")
def stream_freshness(spark, d):
    from ..streaming.batch import fresh_events

    return fresh_events(spark, d, as_of())


@query("SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def stream_upsert(spark, d):
    from ..streaming.batch import upserted_orders

    return upserted_orders(spark, d)
