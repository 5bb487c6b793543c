"""The frontier: a stored table of addresses that is read as a stream, and fetching that keeps each domain's rate.

``Frontier.add`` appends the addresses that are new (by hash of the normalized address).  ``Frontier.crawl`` reads what was appended since the
last run as a stream: Spark's checkpoint holds how far it came, so a run that ends early goes on with the batch it was in, and pages are
written once.  (An address of a batch that is run again is fetched again.)

``fetched`` works on tables and streams alike.  All addresses of a domain in a batch meet in one task, and batches follow one another, so the
task's limiter is the domain's: requests begin at least ``1 / max_per_second`` apart, also across batches, as each task
waits that long before a domain's first.  Within a task up to ``connections`` requests are under way, ``per_domain`` of one domain, so a slow domain holds up
no other; of addresses no more than an Arrow batch is held.  No address passes through the driver or an option."""

from __future__ import annotations

import heapq
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import url as U
from ..functions.hashing import content_hash
from .web import SCHEMA, WebReader, http_fetch

#: Requests of a task that are under way at once, and of one domain.
CONNECTIONS, PER_DOMAIN = 100, 5
_TOGETHER = 64


class Pool:
    """Answers of ``one`` for the addresses of some domains, as they come, within each domain's rate."""

    def __init__(self, one: Callable[[str], tuple], per_second: float, connections: int = CONNECTIONS, per_domain: int = PER_DOMAIN) -> None:
        self.one, self.pause, self.connections, self.per_domain = one, 1 / per_second, connections, per_domain
        self.free: dict[str, float] = {}  # when a domain's next request may begin; kept between batches of a task

    def run(self, addresses: list[tuple[str, str]]) -> Iterator[tuple]:
        """``addresses``: (domain, url)."""
        began, left, busy = time.monotonic(), {}, {}
        for domain, url in addresses:
            left.setdefault(domain, deque()).append(url)
            self.free.setdefault(domain, began + self.pause)
        ready = [(self.free[d], d) for d in left]
        heapq.heapify(ready)
        under_way: dict[Future, str] = {}
        with ThreadPoolExecutor(self.connections) as pool:
            while ready or under_way:
                now = time.monotonic()
                while ready and ready[0][0] <= now and len(under_way) < self.connections:
                    _, domain = heapq.heappop(ready)
                    under_way[pool.submit(self.one, left[domain].popleft())] = domain
                    busy[domain] = busy.get(domain, 0) + 1
                    self.free[domain] = time.monotonic() + self.pause
                    if left[domain] and busy[domain] < self.per_domain:
                        heapq.heappush(ready, (self.free[domain], domain))
                idle = max(0.0, ready[0][0] - time.monotonic()) if ready and len(under_way) < self.connections else None
                if not under_way:
                    time.sleep(idle or 0)
                    continue
                done, _ = wait(under_way, timeout=idle, return_when=FIRST_COMPLETED)
                for f in done:
                    domain = under_way.pop(f)
                    busy[domain] -= 1
                    if left[domain] and busy[domain] == self.per_domain - 1:  # it was full, and so not in line
                        heapq.heappush(ready, (self.free[domain], domain))
                    yield f.result()


def fetched(addresses: DataFrame, options: dict[str, str] | None = None, fetcher=http_fetch, connections: int = CONNECTIONS, per_domain: int = PER_DOMAIN, parts: int | None = None) -> DataFrame:
    """Pages of ``addresses`` (url, and source_name if there is one), one row for each, as the ``webpages`` source gives them; ``options`` are that
    source's.  Null and blank addresses are none."""
    options = {k.lower(): str(v) for k, v in (options or {}).items()}
    source = F.col("source_name") if "source_name" in addresses.columns else F.lit(options.get("source")).cast("string")
    rows = addresses.where(F.trim("url") != "").select(F.trim("url").alias("url"), source.alias("source_name"), U.netloc(F.trim("url")).alias("domain"))
    rows = rows.repartition(parts or int(addresses.sparkSession.conf.get("spark.sql.shuffle.partitions")), "domain")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WebReader(options, fetcher)
        pool = Pool(reader.one, float(options.get("max_per_second", 5)), connections, per_domain)
        for batch in batches:
            urls, names = batch.column("url").to_pylist(), batch.column("source_name").to_pylist()
            domains = [d or "unknown" for d in batch.column("domain").to_pylist()]
            of = dict(zip(urls, names, strict=True))
            held = []
            for row in pool.run(list(zip(domains, urls, strict=True))):
                held.append((row[0], of[row[0]], *row[2:]))
                if len(held) == _TOGETHER:
                    yield _rows(held)
                    held = []
            if held:
                yield _rows(held)

    return rows.mapInArrow(run, SCHEMA)


_KINDS = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.binary(), pa.map_(pa.string(), pa.string()), pa.float64(), pa.int32(), pa.string(), pa.float64()]


def _rows(held: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*held, strict=True))
    headers = [None if h is None else list(dict(h).items()) for h in columns[5]]
    made = [pa.array(headers if i == 5 else list(x), t) for i, (x, t) in enumerate(zip(columns, _KINDS, strict=True))]
    return pa.RecordBatch.from_arrays(made, names=[f.split()[0] for f in SCHEMA.split(", ")])


@dataclass(frozen=True)
class Frontier:
    """Addresses that are to be fetched, in a folder: ``addresses`` as they were added, ``pages`` as they were fetched, ``state`` of the stream."""

    spark: SparkSession
    path: str

    def _known(self) -> DataFrame:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/addresses")
        there = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)
        schema = "url string, source_name string, url_hash string"
        return self.spark.read.schema(schema).parquet(f"{self.path}/addresses") if there else self.spark.createDataFrame([], schema)

    def add(self, addresses: DataFrame) -> None:
        """Appends what is new of ``addresses`` (url, and source_name if there is one): each address once."""
        source = F.col("source_name") if "source_name" in addresses.columns else F.lit(None).cast("string")
        rows = addresses.where(F.trim("url") != "").select(F.trim("url").alias("url"), source.alias("source_name")).withColumn("url_hash", content_hash(U.normalized(F.col("url"))))
        once = rows.groupBy("url_hash").agg(F.min(F.struct("url", "source_name")).alias("a"))
        new = once.join(self._known().select("url_hash"), "url_hash", "left_anti")
        new.select("a.url", "a.source_name", "url_hash").write.mode("append").parquet(f"{self.path}/addresses")

    def addresses(self) -> DataFrame:
        return self._known()

    def crawl(self, options: dict[str, str] | None = None, files: int = 16, fetcher=http_fetch, **limits: int) -> DataFrame:
        """Fetches what was added since the last run, ``files`` files of addresses in a batch, and returns all pages there are."""
        schema = self._known().schema
        self.spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path}/addresses")
        rows = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{self.path}/addresses")
        pages = fetched(rows, options, fetcher, **limits)
        run = pages.writeStream.format("parquet").option("path", f"{self.path}/pages").option("checkpointLocation", f"{self.path}/state").trigger(availableNow=True).start()
        run.awaitTermination()
        return self.spark.read.schema(pages.schema).parquet(f"{self.path}/pages")
