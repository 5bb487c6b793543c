"""Relational, streaming and source operators on small tables; every catalogued query beside its SQL."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).parents[1]))
from millrace.functions import outline  # noqa: E402
from millrace.operators import enrichment, extraction, freshness, metrics, queues, records, resolution, storage, vectors  # noqa: E402
from millrace.plans import catalogue, crawl  # noqa: E402
from millrace.schemas import TABLES  # noqa: E402
from millrace.sources import web  # noqa: E402
from verify import compare  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query_equals_its_sql(spark, name):
    said = compare(spark, DATA, name, catalogue.QUERIES[name], catalogue.ORACLES.get(name))
    assert said.split()[0] in ("equal", "rows"), said


def test_entry_lists_every_query():
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "k int, v string, t int")
    new = spark.createDataFrame([(1, "A", 2), (2, "B", 4), (3, "C", 1)], "k int, v string, t int")
    one = storage.upsert(old, new, ["k"], ["t"])
    assert sorted(tuple(r) for r in one.collect()) == [(1, "A", 2), (2, "b", 5), (3, "C", 1)]
    assert sorted(map(tuple, storage.upsert(one, new, ["k"], ["t"]).collect())) == sorted(map(tuple, one.collect()))


def data_files(path):
    return {x: x.stat().st_size for x in (path / "data").rglob("*.parquet")}


def test_stored_table_keeps_what_it_does_not_touch(spark, tmp_path):
    rows = spark.createDataFrame([(i, "a", 1) for i in range(200)], "k long, v string, t int")
    t = storage.Table(spark, str(tmp_path / "t"), rows.schema, ["k"], ["t"], 16)
    assert t.read().count() == 0 and t.get(k=3).count() == 0
    t.put(rows)
    parts = t._known()["parts"]
    assert sum(p["rows"] for p in parts.values()) == 200 and all(p["rows"] <= 32 for p in parts.values())
    t.put(spark.createDataFrame([(7, "b", 2), (300, "c", 1), (None, "n", 1), (7, "a", 1)], rows.schema))
    t.put(spark.createDataFrame([(7, "old", 1)], rows.schema))
    again = storage.Table(spark, str(tmp_path / "t"), rows.schema, ["k"], ["t"], 16)
    assert again.read().count() == 202 and again.get(k=7).first()["v"] == "b" and again.get(k=None).first()["v"] == "n" and again.get(v="c").first()["k"] == 300
    assert again._known()["parts"] == parts and len(again._known()["deltas"]) == 2
    again.put(spark.createDataFrame([(7, "z", 3)], rows.schema), 3)  # the same number again
    assert storage.latest_version(spark, str(tmp_path / "t")) == 3 and again.get(k=7).first()["v"] == "z"
    assert again.tidy(0) == 0 and storage.versions(spark, again.path) == [3] and again.read().count() == 202


def test_stored_table_equals_a_dictionary_over_many_puts(spark, tmp_path, monkeypatch):
    """Deltas are joined and merged, parts split at different depths; every version reads like what was put."""
    monkeypatch.setattr(storage, "DELTAS", 2)
    t = storage.Table(spark, str(tmp_path / "t"), T.StructType.fromDDL("k long, part string, t int"), ["k", "part"], ["t"], 40)
    r, want = random.Random(5), {}
    for n in range(9):
        rows = [(r.choice([None, *range(150)]), r.choice(["x", None]), r.randint(0, 3)) for _ in range(r.choice([5, 80]))]
        t.put(spark.createDataFrame(rows, t.schema))
        for row in rows:
            if row[:2] not in want or row[2] >= want[row[:2]]:
                want[row[:2]] = row[2]
        got = [tuple(x) for x in t.read().collect()]
        assert len(got) == len(want) and {x[:2]: x[2] for x in got} == want
    names = sorted(t._known()["parts"])
    assert len(names) > 2 and all(not b.startswith(a) for a, b in zip(names, names[1:]))
    assert len(storage.versions(spark, t.path)) == 1 + storage.KEEP


def test_a_small_put_writes_little_and_leaves_the_parts_alone(spark, tmp_path):
    rows = spark.range(200_000).selectExpr("id as k", "sha2(string(id), 256) as v", "1 as t")
    t = storage.Table(spark, str(tmp_path / "t"), rows.schema, ["k"], ["t"], 20_000)
    t.put(rows)
    before, parts = data_files(tmp_path / "t"), t._known()["parts"]
    t.put(spark.range(0, 200_000, 1000).selectExpr("id as k", "'new' as v", "2 as t"))
    new = {f: n for f, n in data_files(tmp_path / "t").items() if f not in before}
    assert sum(new.values()) < 0.01 * sum(before.values()) and t._known()["parts"] == parts and len(parts) >= 10
    assert t.read().where("v = 'new'").count() == 200 and t.read().count() == 200_000
    looked = {f.split("/data/")[1] for f in t.get(k=5000).inputFiles()}
    assert t.get(k=5000).first()["v"] == "new" and len({f.split("/")[1] for f in looked if "__part=" in f}) == 1


def test_a_put_that_ends_early_leaves_the_table(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(i, 1) for i in range(30)], "k long, t int")
    t = storage.Table(spark, str(tmp_path / "t"), rows.schema, ["k"], ["t"], 8)
    t.put(rows)

    def killed(self, number, known):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(storage.Table, "_commit", killed)
        t.put(spark.createDataFrame([(i, 2) for i in range(30)], rows.schema))
    assert t.read().agg(F.sum("t")).first()[0] == 30 and storage.latest_version(spark, t.path) == 1
    t.put(spark.createDataFrame([(1, 2)], rows.schema))  # also clears away what the killed run wrote
    assert t.read().agg(F.sum("t")).first()[0] == 31


def test_stream_upsert_goes_on_after_a_restart(spark, tmp_path):
    from millrace.streaming import batch

    schema = "o_custkey long, o_orderkey long, o_orderdate date"
    out, day = str(tmp_path / "out"), __import__("datetime").date
    for i, rows in enumerate([[(1, 10, day(2024, 1, 1)), (2, 11, day(2024, 1, 1))], [(1, 12, day(2024, 1, 2)), (3, 13, day(2024, 1, 1))], []]):
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / "orders.parquet"))
        got = sorted(tuple(r) for r in batch.upserted_orders(spark, str(tmp_path / "in"), out).collect())
        assert got == ([(1, 10), (2, 11)] if i == 0 else [(1, 12), (2, 11), (3, 13)])


def test_freshness_splits_everything_once(spark):
    rows = [(1, "2024-01-29 12:00:00", "x", "meta", 1.0), (2, "2024-01-01 00:00:00", "x", None, 0.9), (3, None, "y", None, None), (4, None, "y", None, None), (5, None, None, None, None), (6, None, "", None, None)]
    df = spark.createDataFrame(rows, "id int, ts string, body string, src string, conf double")
    out = freshness.annotated(df, F.col("ts").cast("timestamp"), F.col("body"), F.col("conf"), F.col("src"), F.lit("2024-01-30").cast("timestamp"), ["id"])
    got = {r["id"]: (r["is_fresh"], r["freshness_confidence"], r["freshness_source"]) for r in out.collect()}
    assert got == {1: (True, 1.0, "meta"), 2: (False, 0.9, "unknown"), 3: (True, 0.3, "heuristic"), 4: (False, 0.5, "content_hash_duplicate"), 5: (True, 0.3, "heuristic"), 6: (False, 0.5, "content_hash_duplicate")}
    fresh, stale = freshness.split(out)
    assert fresh.count() + stale.count() == 6


def test_histogram(spark):
    df = spark.createDataFrame([("a", 200), ("a", 200), ("a", 500), ("b", None)], "g string, v int")
    assert {r["g"]: r["histogram"] for r in metrics.histogram(df, "g", "v").collect()} == {"a": {200: 2, 500: 1}}


def test_resolution_cascade(spark):
    names = spark.createDataFrame([(0, " "), (1, "IBM Inc"), (2, "Acme Robotics LLC"), (3, "deep mind labs"), (4, "acme robots"), (5, "vector co"), (6, "nobody")], "name_id int, raw string")
    aliases = resolution.alias_table(spark.createDataFrame([("ibm", "Old", 1), ("I.B.M", "Big Blue", 2)], "raw string, canonical string, seq int"))
    cands = spark.createDataFrame([(1, "Acme Robotics"), (2, "Deepmind Labs")], "candidate_id int, candidate string")
    near = spark.createDataFrame([(5, "Vec", 0.9), (6, "Far", 0.5)], "name_id int, name string, cosine double")
    out = {r["name_id"]: (r["canonical"], r["method"], r["confidence"], r["needs_review"]) for r in resolution.resolved(names, aliases, cands, near).collect()}
    assert out == {
        0: (None, "exact", 0.0, False), 1: ("big blue", "alias", 1.0, False), 2: ("Acme Robotics", "exact", 1.0, False), 3: ("Deepmind Labs", "fuzzy", 0.963, False),
        4: ("acme robots", "exact", 0.7, True), 5: ("Vec", "embedding", 0.9, False), 6: ("nobody", "exact", 0.7, False),
    }


def test_fuzzy_blocking_loses_nothing_that_shares_a_token(spark):
    texts = ["red small ring", "red ring", "small gear", "blue bolt", "ring red small big"]
    names = spark.createDataFrame(list(enumerate(texts)), "name_id int, norm string")
    cands = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "candidate_id int, candidate string, cnorm string")
    got = {(r["name_id"], r["candidate_id"]) for r in resolution.fuzzy_pairs(names, cands, 60).collect()}
    want = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if set(a.split()) & set(b.split()) and resolution.token_set_ratio(a, b) >= 60}
    assert got == want


def test_provider_chain(spark):
    class Fails:
        name = "fails"

        def answer(self, prompts):
            return [None if p.endswith("x") else "!busy" for p in prompts]

    df = spark.createDataFrame([("Text:\nx",), ("Text:\ny",)], "prompt string")
    assert [r["error"] for r in extraction.answers(df, "prompt", [Fails()]).orderBy("prompt").collect()] == ["no answer", "busy"]
    assert {r["provider"] for r in extraction.answers(df, "prompt", [Fails(), extraction.Echo()]).collect()} == {"echo"}


def test_web_pages_retry_and_fail(spark):
    class Pages(web.WebPages):
        @staticmethod
        def fetcher(url, timeout, limit):
            if "down" in url:
                raise TimeoutError
            return web.Fetched(429 if "busy" in url else 200, b"body"[:limit], {"Content-Type": "text/html", "Retry-After": "0"})

        @classmethod
        def name(cls):
            return "testpages"

    spark.dataSource.register(Pages)
    urls = "https://a/1\nhttps://a/busy\nhttps://b/down"
    rows = spark.read.format("testpages").option("urls", urls).option("max_per_second", "100000").option("base_delay", "0").load().collect()
    got = {r["url"]: (r["status_code"], r["attempt"], r["error_class"], r["retry_after"]) for r in rows}
    assert got == {"https://a/1": (200, 0, None, None) if got["https://a/1"][3] is None else (200, 0, None, 0.0), "https://a/busy": (429, 2, "RateLimitError", 0.0), "https://b/down": (None, 2, "TimeoutError", None)}


def test_web_pages_partitions_are_domains():
    reader = web.WebReader({"urls": "https://a/1\nhttps://b/1\nhttps://a/2"}, web.http_fetch)
    assert [p.urls for p in reader.partitions()] == [["https://a/1", "https://a/2"], ["https://b/1"]]


def test_outline_reads_marks_anchors_strings_and_data():
    got = outline.read("<h1 class='x title'> A <b>B</b></h1><script type='application/ld+json'>[1]</script><a href='/p'> Visit </a><p>One<!-- no --></p>")
    assert got["h1"] == "AB" and got["marked"] == [{"tag": "h1", "cls": "x title", "text": "AB"}]
    assert got["anchors"] == [{"href": "/p", "text": "Visit"}] and got["data"] == "[1]" and got["strings"] == ["A", "B", "Visit", "One"]
    assert outline.read(None) == {"h1": None, "marked": [], "anchors": [], "strings": [], "data": None}


def test_pages_without_name_or_answer_give_no_record(spark):
    rows = [("https://a/1", "s", 404, "<h1>X</h1>"), ("https://a/2", "s", 200, "<p>no name</p>"), ("https://a/3", "s", 200, None), ("https://a/4", "s", 200, "<h1>Y</h1>")]
    pages = spark.createDataFrame(rows, "url string, source_name string, status_code int, html string").withColumn("page", outline.outline(F.col("html")))
    assert [r["content"]["entity_name"] for r in records.startups(pages).collect()] == ["Y"]
    assert [r["content"]["product_name"] for r in records.products(pages).collect()] == ["Y"]
    assert records.papers(pages).count() == 0


def test_fallback_only_where_nothing_was_found(spark):
    a, b = spark.range(2), spark.range(10, 13)
    assert records.first_that_answers(a, b).count() == 2
    assert sorted(r["id"] for r in records.first_that_answers(a.where("id < 0"), b).collect()) == [10, 11, 12]


def test_crawl_stores_fresh_records_once_and_again(spark, tmp_path):
    day = "<time datetime='2024-01-30T00:00:00Z'></time>"
    old = "<time datetime='2023-01-30T00:00:00Z'></time>"
    body = "<main>" + "word " * 40 + "</main>"
    rows = [
        ("https://n/1", "n", "NEWS", 200, f"<title>New</title>{day}{body}"), ("https://n/2", "n", "NEWS", 200, f"<title>Old</title>{old}{body}"),
        ("https://n/3", "n", "NEWS", 500, "<title>Down</title>"), ("https://j/1", "j", "JOB", 200, f"<title>Engineer</title>{day}"),
        ("https://s/1", "s", "STARTUP", 200, "<h1>Acme, Inc.</h1><p class='bio'>a</p>"), ("https://s/2", "s", "STARTUP", 200, "<h1>Acme</h1><p class='bio'>a</p>"),
        ("https://x/1", "x", "OTHER", 200, "<h1>?</h1>"), (None, None, None, None, None),
    ]
    pages = spark.createDataFrame(rows, "url string, source_name string, record_type string, status_code int, html string")
    want = {"raw_documents": 6, "startups": 1, "products": 0, "research_papers": 0, "jobs": 1, "news": 1, "failed": 2}
    for _ in range(2):
        got = {r["table"]: r["n"] for r in crawl.store(spark, pages, str(tmp_path), F.lit("2024-01-30 12:00:00").cast("timestamp")).collect()}
        assert got == want
    assert storage.latest_version(spark, str(tmp_path / "news")) == 2
    assert [r["canonical_name"] for r in storage.Table(spark, str(tmp_path / "startups"), T.StructType.fromDDL(TABLES["startups"]), ["id"], ["id"]).read().collect()] == ["acme"]


def test_queue_log(spark):
    ops = [("q", 1, 1, "enqueue"), ("q", 1, 2, "dequeue"), ("q", 1, 3, "requeue"), ("q", 2, 1, "enqueue"), ("q", 2, 2, "dequeue"), ("q", 2, 3, "fail"), ("q", 3, 1, "enqueue"), ("q", 3, 2, "dequeue")]
    log = spark.createDataFrame(ops, "queue string, job_id int, seq int, op string")
    assert [tuple(r) for r in queues.stats(log).collect()] == [("q", 1, 1, 0, 1)]
    assert queues.dead(log, 1).count() == 1 and queues.dead(log, 2).count() == 0


def test_export_and_tables(spark, tmp_path):
    storage.export(spark.createDataFrame([(1, ["a", 'b"'])], "k int, v array<string>"), str(tmp_path / "c"))
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c")).first()["v"] == '["a","b\\""]'
    spark.sql(f"CREATE DATABASE millrace_test LOCATION '{tmp_path}/db'")
    try:
        names = {f"millrace_test.{k}": v for k, v in TABLES.items()}
        storage.create_tables(spark, names)
        assert spark.sql("SHOW TABLES IN millrace_test").count() == len(TABLES)
        storage.drop_tables(spark, list(names))
        assert spark.sql("SHOW TABLES IN millrace_test").count() == 0
    finally:
        spark.sql("DROP DATABASE millrace_test CASCADE")


# ---------------------------------------------------------------- sources, providers and the steps of a run
def test_fetcher_limits_redirects_headers_and_bodies(spark):
    import json
    import re
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen = []

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append(dict(self.headers))
            if self.path == "/loop":
                self.send_response(302)
                self.send_header("Location", f"/loop?{len(seen)}")
                self.end_headers()
            elif self.path.startswith("/loop?"):
                self.path = "/loop"
                return self.do_GET()
            else:
                self.send_response(404 if self.path == "/none" else 200)
                self.end_headers()
                self.wfile.write(b"x" * 50)

        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            self.send_response(200)
            self.end_headers()
            n = re.search(r"first: (\d+)", asked["query"])[1]
            self.wfile.write(json.dumps({"data": {"posts": {"edges": [{"node": {"id": "1", "name": "n", "slug": f"s{n}"}}]}}}).encode())

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    try:
        fetch = web.HttpFetcher("reader/1", {"X-Own": "y"}, redirects=3)
        assert fetch(f"{base}/a", 5, 50).body == b"x" * 50 and seen[-1]["User-Agent"] == "reader/1" and seen[-1]["X-Own"] == "y"
        assert fetch.opener() is fetch.opener()
        assert fetch(f"{base}/none", 5, 50).status == 404
        reader = web.WebReader({"base_delay": "0"}, fetch)
        assert [reader.one(f"{base}{p}")[8] for p in ("/a", "/none", "/loop")] == [None, "HTTPError", "TooManyRedirectsError"]
        asked = web.WebPages({"urls": f"{base}/q", "max_per_second": "1000000", **enrichment.posts_request(7)}).reader(None)
        (row,) = asked.read(asked.partitions()[0])
        assert row[2] == 200
        replies = spark.createDataFrame([(row[4].decode(),)], "reply string")
        assert replies.select(enrichment.reply_urls(F.col("reply"), "https://ph.example")).first()[0] == ["https://ph.example/posts/s7"]
        small = web.WebReader({"base_delay": "0", "max_bytes": "49"}, fetch)
        assert small.one(f"{base}/a")[7:9] == (0, "PayloadTooLargeError")
    finally:
        server.shutdown()


def test_retry_waits_and_gives_up():
    from millrace.retry import HTTP, RATE_LIMIT, Retry

    assert [HTTP.delay(i, draw=lambda: 0.5) for i in range(8)] == [1.5, 2.5, 4.5, 8.5, 16.5, 32.5, 60, 60] and HTTP.delay(0, 90) == 60
    assert (RATE_LIMIT.max_attempts, RATE_LIMIT.delay(0, draw=lambda: 0), RATE_LIMIT.delay(9)) == (5, 2, 300)
    waits, calls = [], []

    def fails(x):
        calls.append(x)
        raise KeyError("no")

    with pytest.raises(KeyError):
        Retry(3, jitter=False).call(fails, 1, wait=waits.append)
    assert (waits, calls) == ([1, 2], [1, 1, 1])
    with pytest.raises(KeyError):
        Retry().call(fails, 2, wait=waits.append, fatal=(KeyError,))
    assert calls == [1, 1, 1, 2]


def test_chat_service_tries_again_and_names_its_errors():
    import json

    from millrace.retry import Retry

    good = (200, {}, json.dumps({"choices": [{"message": {"content": "{}"}}]}))
    replies, sent, waits = [], [], []

    def post(url, headers, body, timeout):
        sent.append((url, headers["Authorization"], body["messages"][-1]["content"], timeout))
        return replies.pop(0)

    p = extraction.ChatService("http://s/v1", "m", "key", post=post, wait=waits.append, input_tokens=10, retry=Retry(3, jitter=False))
    replies[:] = [(429, {"Retry-After": "7"}, ""), (500, {}, "oops"), good]
    assert p.answer(["hi"]) == ["{}"] and waits == [7, 2] and sent[0] == ("http://s/v1/chat/completions", "Bearer key", "hi", 120.0)
    replies[:] = [(413, {}, "")]
    assert p.one("hi").startswith("!PayloadTooLargeError") and not replies
    assert p.one("x" * 44).startswith("!PayloadTooLargeError: more than 10 tokens")
    replies[:] = [(500, {}, "")] * 3
    assert p.one("hi").startswith("!ProviderUnavailableError: status 500")
    replies[:] = [(429, {}, "")] * 3
    assert p.one("hi").startswith("!RateLimitError")


def test_templates_are_filled_once(spark):
    df = spark.createDataFrame([("see {schema} and {text}", "acme")], "t string, n string")
    row = df.select(
        extraction.prompt(F.lit("JOB"), F.col("t")).alias("a"), extraction.prompt(F.lit("?"), F.col("t"), "<{text}>{schema}{other}").alias("b"),
        extraction.resolution_prompt(F.col("n"), F.array(F.lit("Acme Inc"), F.lit("Ace"))).alias("c"), extraction.chunk_prompt(F.lit("NEWS"), F.col("t"), F.lit(2), F.lit(3)).alias("d"),
        extraction.filled(extraction.TEMPLATES["GENERAL"], schema=F.lit("s"), text=F.lit(None)).alias("e"),
    ).first()
    assert row["a"].endswith("Text:\nsee {schema} and {text}") and "company string" in row["a"]
    assert row["b"].startswith("<see {schema} and {text}>title string") and row["b"].endswith("{other}")
    assert "Name:\nacme\n" in row["c"] and row["c"].endswith("Acme Inc\nAce") and "part 2 of 3" in row["d"] and row["e"].endswith("Text:\n")
    assert set(extraction.TEMPLATES) == {*extraction.ASK, "GENERAL", "CHUNK", "RESOLVE"}


def test_reduced_chunks(spark):
    from millrace.operators import chunking

    long = " ".join(f"Word{i} is here." for i in range(100))
    df = spark.createDataFrame([(["short", long, ""],), ([],), (None,)], "cs array<string>")
    got = [r[0] for r in df.select(chunking.reduced(F.col("cs"), 60, 10)).collect()]
    assert got[0][0] == "short" and got[0][-1] == "" and got[1] == [] and got[2] is None
    inner = got[0][1:-1]
    assert len(inner) > 5 and all(len(c) // 4 <= 60 for c in inner) and all(b.startswith(a[-40:]) for a, b in zip(inner, inner[1:]))


def test_freshness_knows_earlier_runs(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, body string")
    seen = spark.createDataFrame([("b",), ("b",)], "x string").select(freshness.body_hash(F.col("x")).alias("hash"))
    none = F.lit(None)
    for known, fresh in ((None, {1, 3}), (seen, {1})):
        out = freshness.annotated(df, none.cast("timestamp"), F.col("body"), none.cast("double"), none.cast("string"), F.lit("2024-01-30").cast("timestamp"), ["id"], seen=known)
        assert {r["id"] for r in out.where("is_fresh").collect()} == fresh


def test_steps_of_a_run(spark, tmp_path):
    from millrace.plans import run

    body = "<main>" + "word " * 40 + "</main><time datetime='2024-01-30T00:00:00Z'></time>"
    rows = [
        ("https://n/1", "n", "NEWS", 200, f"<title>New</title>{body}"), ("https://s/1", "s", "STARTUP", 200, "<h1>Acme Robotics</h1>"),
        ("https://p/1", "p", "PRODUCT", 200, "<h1>Acme Robotics, Inc.</h1><p class='tagline'>a</p>"), ("https://p/2", "p", "PRODUCT", 200, "<h1>Other thing</h1><p class='tagline'>b</p>"),
    ]
    pages = spark.createDataFrame(rows, "url string, source_name string, record_type string, status_code int, html string")
    out, now = str(tmp_path / "out"), F.lit("2024-01-30 12:00:00").cast("timestamp")
    for _ in range(2):
        got = {r["table"]: r["n"] for r in run.full(spark, pages, out, now).collect()}
        assert (got["raw_documents"], got["startups"], got["products"], got["news"], got["extracted"], got["dead_letters"], got["entity_mapping_logs"]) == (4, 1, 2, 1, 4, 0, 2)
    log = {r["raw_name"]: (r["canonical_name"], r["method"]) for r in run.table(spark, out, "entity_mapping_logs").collect()}
    assert log == {"Acme Robotics, Inc.": ("acme robotics", "exact"), "Other thing": ("other thing", "exact")}
    assert run.table(spark, out, "entity_aliases").count() == 1

    class Half:
        name = "half"

        def answer(self, prompts):
            return ['{"title": "t"}' if "New" in p else "!PayloadTooLargeError: big" for p in prompts]

    counts = {r["table"]: r["n"] for r in run.extract(spark, str(tmp_path / "two"), "NEWS", [Half()]).collect()}
    assert counts == {"extracted": 0, "dead_letters": 0}
    crawl.store(spark, pages, str(tmp_path / "two"), now)
    counts = {r["table"]: r["n"] for r in run.extract(spark, str(tmp_path / "two"), "NEWS", [Half()]).collect()}
    dead = {r["reason"] for r in spark.read.parquet(str(tmp_path / "two" / "dead_letters" / "v=*" / "part=*")).collect()}
    assert counts == {"extracted": 0, "dead_letters": 4} and dead == {"PayloadTooLargeError: big", "invalid: body"}


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    import json
    import logging

    from millrace import __main__ as cli
    from millrace import log

    monkeypatch.setattr(cli, "session", lambda: spark)
    assert cli.main(["queries"]) == 0 and "url_normalize" in capsys.readouterr().out
    spark.createDataFrame([("https://s/1", "s", "STARTUP", 200, "<h1>Acme</h1>")], "url string, source_name string, record_type string, status_code int, html string").write.parquet(str(tmp_path / "pages"))
    assert cli.main(["full", str(tmp_path / "pages"), str(tmp_path / "out"), "--as-of", "2024-01-30"]) == 0
    assert cli.main(["extract", str(tmp_path / "out"), "--type", "STARTUP", "--template", "{schema} {text}"]) == 0
    assert cli.main(["--debug", "resolve", str(tmp_path / "out")]) == 0
    line = log.Structured().format(logging.makeLogRecord({"msg": "crawled %s", "args": ("a",), "name": "x", "levelname": "INFO", "pages": 3}))
    assert {k: json.loads(line)[k] for k in ("event", "pages", "level")} == {"event": "crawled a", "pages": 3, "level": "info"}
    assert "pages=3" in log.Structured(True).format(logging.makeLogRecord({"msg": "m", "pages": 3}))
    log.configure("WARNING")


def test_settings_from_the_environment(monkeypatch):
    from millrace.session import Settings

    monkeypatch.setenv("CHUNK_TOKENS", "12")
    monkeypatch.setenv("DEBUG", "yes")
    monkeypatch.setenv("PROVIDER_URL", "http://s")
    got = Settings.from_env()
    assert (got.chunk_tokens, got.debug, got.provider_url, got.max_attempts) == (12, True, "http://s", 3)


def test_nearest_against_all_pairs(spark):
    import numpy as np

    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.integers(-2, 3, 4)]) for i in range(60)] + [(60, None), (61, [0.0] * 4), (62, [1.0]), (63, [None, 1.0, 1.0, 1.0])]
    store = spark.createDataFrame(rows, "vec_id long, vec array<double>").repartition(3)
    queries = store.where("vec_id % 7 = 0").selectExpr("vec_id as query_id", "vec as qvec")
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows[:60] if np.linalg.norm(v)}
    want = set()
    for q in [i for i in unit if i % 7 == 0]:
        best = sorted(unit, key=lambda i: (-round(float(unit[q] @ unit[i]), 12), i))[:3]
        want |= {(q, i, round(float(unit[q] @ unit[i]), 9)) for i in best}
    for cells, together in ((None, 20_000), (1, 7), (9, 2)):  # parts of cells on both sides
        found = vectors.Index.of(store, cells=cells, together=together).search(queries, 3, exact=True).collect()
        assert {(x["query_id"], x["vec_id"], round(x["cosine"], 9)) for x in found} == want


def test_index_recall_and_share_of_the_rows_it_looks_at(spark):
    """Against the exact search on the largest test table that there is; the share of rows looked at is half of the cells."""
    import numpy as np

    d = next((x for x in ("/root/testdata/sf0.1", "/root/testdata/sf0.01", "/root/testdata/sf0.001") if Path(x).exists()), None)
    if d is None:
        pytest.skip("no test tables")
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    store, queries = e.selectExpr("vec_id", "embedding as vec"), e.where("vec_id % 20 = 0").selectExpr("vec_id as query_id", "embedding as qvec")
    index = vectors.Index.of(store)
    exact, found = ({(r["query_id"], r["vec_id"]) for r in index.search(queries, 5, exact=x).collect()} for x in (True, False))
    assert len(exact & found) / len(exact) >= 0.9
    assert int(index.sizes.sum()) == store.count() and len(index.middles) == int(np.sqrt(store.count()))


def test_index_of_nothing_and_of_equal_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, vec array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, qvec array<double>")
    assert vectors.nearest(queries, none).count() == 0
    same = spark.range(50).selectExpr("id as vec_id", "array(1d, 1d) as vec")
    assert [r["vec_id"] for r in vectors.Index.of(same, together=6).search(queries, 3).orderBy("rank").collect()] == [0, 1, 2]


def test_rows_are_numbered_without_one_task(spark):
    from millrace.shared import numbered

    rows = spark.range(1000).selectExpr("id", "if(id % 3 = 0, null, if(id % 5 = 0, 'b', 'a')) as k").repartition(7)
    got = {r["id"]: r["n"] for r in numbered(rows, "n", [F.col("id").desc()], F.col("k")).collect()}
    own = {}
    for r in sorted(rows.collect(), key=lambda r: -r["id"]):
        own.setdefault(r["k"], []).append(r["id"])
    assert got == {i: n for ids in own.values() for n, i in enumerate(ids, 1)}
    assert sorted(r["n"] for r in numbered(rows, "n", [F.col("id")]).collect()) == list(range(1, 1001))


def test_crawlers_discover_and_read(spark):
    from millrace.sources.crawlers import CRAWLERS, Crawler

    assert {x.kind for x in CRAWLERS.values()} == {"NEWS", "JOB", "RESEARCH_PAPER", "PRODUCT", "STARTUP"} and CRAWLERS["arxiv"].listings[0].startswith("http://export")
    now = F.lit("2024-01-30").cast("timestamp")
    pages = spark.createDataFrame([("https://l/1", "producthunt", 200, "<a href='/posts/a'>x</a><a href='/posts/a'>x</a><a href='https://other.example/posts/b'>y</a><h1>Tool</h1>")], "url string, source_name string, status_code int, html string")
    ph = CRAWLERS["producthunt"]
    assert sorted(r["url"] for r in ph.discover(pages).collect()) == ["https://other.example/posts/b", "https://www.producthunt.com/posts/a"]
    assert [r["content"]["product_name"] for r in ph.read(pages, now).collect()] == ["Tool"]
    own = Crawler(ph.name, ph.base, ph.kind, ph.listings, ph.parse, ph.links, ["www.producthunt.com"])
    assert [r["url"] for r in own.discover(pages).collect()] == ["https://www.producthunt.com/posts/a"]
    assert [r["url"] for r in CRAWLERS["remoteok"].discover(pages).collect()] == ["https://l/1"]
    for x in CRAWLERS.values():
        assert x.read(pages, now).count() in (0, 1)
