"""Pages as a Spark data source, one input partition for each domain, behind a pluggable fetcher."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urlencode, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import url as U
from ..retry import Retry
from ..shared import numbered

SCHEMA = "url string, source_name string, status_code int, content_type string, body binary, headers map<string,string>, fetch_duration double, attempt int, error_class string, retry_after double"
RETRYABLE = {408, 429, 500, 502, 503, 504}
# The sources that are read, the kind of record they hold, and the addresses their records are found from.
SOURCES = [
    ("techcrunch", "https://techcrunch.com", "NEWS", ["/tag/artificial-intelligence/", "/category/ai/"]),
    ("venturebeat", "https://venturebeat.com", "NEWS", ["/category/ai/", "/tag/artificial-intelligence/"]),
    ("thedecoder", "https://thedecoder.com", "NEWS", ["/", "/category/ai-news/"]),
    ("ainews", "https://ai-news.com", "NEWS", ["/", "/news/"]),
    ("mit_tech_review", "https://www.technologyreview.com", "NEWS", ["/topic/artificial-intelligence/"]),
    ("wellfound", "https://wellfound.com", "JOB", ["/jobs?tags=Artificial%20Intelligence", "/jobs?tags=Machine%20Learning"]),
    ("aijobs_net", "https://aijobs.net", "JOB", ["/jobs/"]),
    ("linkedin", "https://www.linkedin.com", "JOB", ["/jobs/search/?keywords=artificial%20intelligence"]),
    ("angellist", "https://angel.co", "JOB", ["/jobs?query=artificial%20intelligence"]),
    ("remoteok", "https://remoteok.com", "JOB", ["/remote-ai-jobs"]),
    ("arxiv", "https://arxiv.org", "RESEARCH_PAPER", []), ("producthunt", "https://www.producthunt.com", "PRODUCT", ["/"]),
    ("ycombinator", "https://www.ycombinator.com", "STARTUP", ["/companies"]), ("github", "https://github.com", "REPOSITORY", []),
]
# Subjects that papers are asked for, and the service that answers.
SUBJECTS = ["cs.AI", "cs.LG", "cs.CL", "cs.CV", "cs.NE", "stat.ML"]
PAPER_SERVICE = "http://export.arxiv.org/api/query"


def papers_address(subjects: list[str] = SUBJECTS, start: int = 0, limit: int = 100, sort: str = "submittedDate", order: str = "descending") -> str:
    """The address that lists papers of some subjects."""
    asked = {"search_query": " OR ".join(f"cat:{x}" for x in subjects), "start": start, "max_results": limit, "sortBy": sort, "sortOrder": order}
    return f"{PAPER_SERVICE}?{urlencode(asked)}"


@dataclass
class Fetched:
    status: int
    body: bytes
    headers: dict[str, str]


class PayloadTooLargeError(Exception):
    pass


class TooManyRedirectsError(Exception):
    pass


@dataclass
class HttpFetcher:
    """GETs (POSTs where there is ``data``) through one opener for each worker process: its headers, at most ``redirects`` redirects, and bodies of at
    most the limit that each call gives (a longer one is an error, as half a page is no page)."""

    user_agent: str = "millrace/0.2"
    headers: dict[str, str] = field(default_factory=dict)
    redirects: int = 10
    data: bytes | None = None
    _openers = {}

    def opener(self):
        import urllib.request

        if self.redirects not in HttpFetcher._openers:
            handler = urllib.request.HTTPRedirectHandler()
            handler.max_redirections = self.redirects
            HttpFetcher._openers[self.redirects] = urllib.request.build_opener(handler)
        return HttpFetcher._openers[self.redirects]

    def __call__(self, url: str, timeout: float, limit: int) -> Fetched:
        import urllib.error
        import urllib.request

        asked = urllib.request.Request(url, self.data, {"User-Agent": self.user_agent, **self.headers})
        try:
            with self.opener().open(asked, timeout=timeout) as r:
                body = r.read(limit + 1)
                if len(body) > limit:
                    raise PayloadTooLargeError(f"more than {limit} bytes")
                return Fetched(r.status, body, dict(r.headers))
        except urllib.error.HTTPError as e:
            if 300 <= e.code < 400:
                raise TooManyRedirectsError(str(e)) from e
            return Fetched(e.code, b"", dict(e.headers))


http_fetch = HttpFetcher()
#: Errors that another attempt would only repeat.
FATAL = {"PayloadTooLargeError", "TooManyRedirectsError"}


@dataclass
class _Domain(InputPartition):
    name: str
    urls: list[str]


class WebPages(DataSource):
    """Options: ``urls`` (one a line), ``source``, ``max_per_second`` (5), ``max_attempts`` (3), ``base_delay`` (1 s),
    ``max_delay`` (60 s), ``timeout`` (30 s), ``max_bytes`` (10 MiB), ``user_agent``, ``header.NAME`` for further
    headers, ``data`` to be posted.  A domain is read by one task, so its rate holds whatever the cluster."""

    fetcher: Callable[[str, float, int], Fetched] = staticmethod(http_fetch)

    @classmethod
    def name(cls) -> str:
        return "webpages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "WebReader":
        fetcher, options = type(self).fetcher, {k.lower(): v for k, v in dict(self.options).items()}
        own = {k.removeprefix("header."): v for k, v in options.items() if k.startswith("header.")}
        if isinstance(fetcher, HttpFetcher) and (own or {"user_agent", "data"} & set(options)):
            data = options["data"].encode() if "data" in options else fetcher.data
            fetcher = HttpFetcher(options.get("user_agent", fetcher.user_agent), {**fetcher.headers, **own}, fetcher.redirects, data)
        return WebReader(options, fetcher)


class WebReader(DataSourceReader):
    def __init__(self, options: dict[str, str], fetcher) -> None:
        self.options, self.fetcher = {k.lower(): v for k, v in options.items()}, fetcher

    def partitions(self):
        by: dict[str, list[str]] = {}
        for u in filter(None, map(str.strip, self.options.get("urls", "").split("\n"))):
            by.setdefault(urlsplit(u).netloc or "unknown", []).append(u)
        return [_Domain(k, v) for k, v in sorted(by.items())] or [_Domain("", [])]

    def read(self, partition: _Domain) -> Iterator[tuple]:
        pause = 1.0 / float(self.options.get("max_per_second", 5))
        for u in partition.urls:
            yield self.one(u)
            if pause > 0.001:
                time.sleep(pause)

    def one(self, url: str) -> tuple:
        retry = Retry(int(self.options.get("max_attempts", 3)), float(self.options.get("base_delay", 1)), float(self.options.get("max_delay", 60)))
        last = None
        for attempt in range(retry.max_attempts):
            began = time.time()
            try:
                r = self.fetcher(url, float(self.options.get("timeout", 30)), int(self.options.get("max_bytes", 10 << 20)))
                after = r.headers.get("Retry-After")
                wait = float(after) if after and after.replace(".", "", 1).isdigit() else None
                error = None if r.status < 400 else "RateLimitError" if r.status == 429 else "HTTPError"
                last = (url, self.options.get("source"), r.status, r.headers.get("Content-Type"), r.body, r.headers, time.time() - began, attempt, error, wait)
                if r.status not in RETRYABLE:
                    return last
            except Exception as e:  # noqa: BLE001  a page that cannot be fetched is a row with its error
                wait, last = None, (url, self.options.get("source"), None, None, None, None, time.time() - began, attempt, type(e).__name__, None)
                if type(e).__name__ in FATAL:
                    return last
            if attempt + 1 < retry.max_attempts:
                time.sleep(retry.delay(attempt, wait))
        return last


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WebPages)


def sources(spark: SparkSession) -> DataFrame:
    rows = [(i, *s[:3], True) for i, s in enumerate(SOURCES, 1)]
    return spark.createDataFrame(rows, "id long, name string, base_url string, source_type string, enabled boolean")


def listings(spark: SparkSession) -> DataFrame:
    """The addresses each source's records are found from, in order."""
    rows = [(name, kind, i, base + path) for name, base, kind, paths in SOURCES for i, path in enumerate(paths)]
    rows.append(("arxiv", "RESEARCH_PAPER", 0, papers_address()))
    return spark.createDataFrame(rows, "source_name string, record_type string, position int, url string")


def read(spark: SparkSession, urls: list[str], settings, source: str | None = None) -> DataFrame:
    """Pages of some addresses, within the limits of the settings."""
    from .frontier import fetched

    addresses = spark.createDataFrame([(u, source) for u in urls], "url string, source_name string")
    return fetched(addresses, limits(settings))


def limits(settings) -> dict[str, str]:
    """The settings' limits as options."""
    named = {"max_per_second": settings.requests_per_second, "max_attempts": settings.max_attempts, "max_bytes": settings.max_response_bytes, "timeout": settings.request_timeout}
    return {k: str(v) for k, v in named.items()}


def rate_slots(requests: DataFrame, url: str, order: list[str], per_second: int = 5) -> DataFrame:
    """The second in which each request may go, counted from its domain's first.  A domain of any size is numbered in
    ranges."""
    rows = requests.withColumn("limiter_domain", U.limiter_domain(F.col(url)))
    rows = numbered(rows, "__n", [F.col(c) for c in order], F.col("limiter_domain"))
    return rows.withColumn("slot", F.floor((F.col("__n") - 1) / per_second)).drop("__n")
