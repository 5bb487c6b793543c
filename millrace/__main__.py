"""Command line: ``python -m millrace COMMAND``: queries, run, fetch, crawl, extract, resolve, full, test, init-db, drop-db."""

from __future__ import annotations

import argparse
import logging
import sys
from dataclasses import replace

from pyspark.sql import functions as F

from . import log
from .plans import catalogue, crawl
from .plans import run as steps
from .schemas import RECORD_TYPES, TABLES
from .session import Settings, session

said = logging.getLogger("millrace")


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__)
    parser.add_argument("--debug", action="store_true", help="log everything, in words")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("queries", help="name every query")
    run = sub.add_parser("run", help="show a query's first rows")
    run.add_argument("name", choices=sorted(catalogue.QUERIES), metavar="NAME")
    run.add_argument("directory")
    run.add_argument("--rows", type=int, default=20)
    fetch = sub.add_parser("fetch", help="the sources' listing pages, or some addresses, into Parquet")
    fetch.add_argument("out")
    fetch.add_argument("urls", nargs="*")
    for name, text in (("crawl", "fetched pages into tables"), ("full", "crawl, extract and resolve")):
        load = sub.add_parser(name, help=text)
        load.add_argument("pages", help="Parquet of url, source_name, record_type, status_code, html")
        load.add_argument("out")
    for name, text in (("extract", "stored pages through the model"), ("resolve", "stored names to companies")):
        sub.add_parser(name, help=text).add_argument("out")
    for name in ("crawl", "full", "resolve"):
        sub.choices[name].add_argument("--as-of", help="time that ages are counted from (default: the clock)")
    for name in ("extract", "full"):
        sub.choices[name].add_argument("--type", choices=RECORD_TYPES, default="NEWS")
    sub.choices["extract"].add_argument("--template", help="a request of one's own, with {schema} and {text}")
    sub.add_parser("test", help="run the tests").add_argument("tests", nargs="*", default=["tests/"])
    sub.add_parser("init-db", help="make the tables that are not there")
    sub.add_parser("drop-db", help="drop the tables")
    return parser


def main(args: list[str] | None = None) -> int:
    got = arguments().parse_args(args)
    limits = Settings.from_env()
    limits = replace(limits, debug=limits.debug or got.debug)
    log.configure(limits.log_level, limits.debug)
    if got.command == "queries":
        print("\n".join(catalogue.QUERIES))
        return 0
    if got.command == "test":
        import pytest

        return int(pytest.main(["-q", *got.tests]))
    from .operators import storage
    from .sources import web

    spark = session()
    said.info("started", extra={"command": got.command})
    now = F.lit(got.as_of).cast("timestamp") if getattr(got, "as_of", None) else F.current_timestamp()
    if got.command == "run":
        catalogue.QUERIES[got.name](spark, got.directory).show(got.rows, truncate=80)
    elif got.command == "fetch":
        urls = got.urls or [r["url"] for r in web.listings(spark).collect()]
        web.read(spark, urls, limits).write.mode("overwrite").parquet(got.out)
    elif got.command == "crawl":
        crawl.store(spark, spark.read.parquet(got.pages), got.out, now, limits.filter_freshness_hours, limits.max_pages_per_source).show()
    elif got.command == "extract":
        steps.extract(spark, got.out, got.type, steps.providers_of(limits), limits, got.template).show()
    elif got.command == "resolve":
        steps.resolve(spark, got.out, now).show()
    elif got.command == "full":
        steps.full(spark, spark.read.parquet(got.pages), got.out, now, limits, got.type).show()
    elif got.command == "init-db":
        storage.create_tables(spark, TABLES)
    else:
        storage.drop_tables(spark, list(TABLES))
    said.info("done", extra={"command": got.command})
    return 0


if __name__ == "__main__":
    sys.exit(main())
