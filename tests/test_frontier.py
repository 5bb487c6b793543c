"""The frontier as a stream against local servers: rates, concurrent requests, restarts.  Nothing stands in for the fetcher."""

import threading
import time
from collections import defaultdict
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from millrace.sources import frontier


class Server:
    """Notes when each path is asked for, and how many requests are under way."""

    def __init__(self, slow=0.0):
        self.asked, self.now, self.most, lock = [], 0, 0, threading.Lock()

        class Handler(BaseHTTPRequestHandler):
            def do_GET(handler):  # noqa: N802, N805
                with lock:
                    self.asked.append((time.monotonic(), handler.path))
                    self.now += 1
                    self.most = max(self.most, self.now)
                time.sleep(slow)
                missing = handler.path.startswith("/missing")
                handler.send_response(404 if missing else 200)
                handler.send_header("Content-Type", "text/html")
                handler.end_headers()
                handler.wfile.write(f"<h1>{handler.path}</h1>".encode())
                with lock:
                    self.now -= 1

            def log_message(self, *_):
                pass

        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.base = f"http://127.0.0.1:{self.http.server_port}"
        threading.Thread(target=self.http.serve_forever, daemon=True).start()


@pytest.fixture
def servers():
    made = [Server(), Server(slow=0.5)]
    yield made
    for s in made:
        s.http.shutdown()
        s.http.server_close()


OPTIONS = {"max_per_second": "20", "max_attempts": "1"}


def urls(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "url string")


def test_stream_fetches_each_address_once_and_goes_on_after_a_restart(spark, tmp_path, servers):
    quick, slow = servers
    found = frontier.Frontier(spark, str(tmp_path))
    found.add(urls(spark, [f"{quick.base}/{i}" for i in range(30)] + [f"{quick.base}/3#top", "", None, f"{slow.base}/missing"]))
    pages = {r["url"]: r for r in found.crawl(OPTIONS).collect()}
    assert len(pages) == 31 and bytes(pages[f"{quick.base}/7"]["body"]) == b"<h1>/7</h1>"
    assert pages[f"{slow.base}/missing"]["status_code"] == 404 and pages[f"{slow.base}/missing"]["error_class"] == "HTTPError"
    found.add(urls(spark, [f"{quick.base}/{i}" for i in range(25, 40)]))
    again = frontier.Frontier(spark, str(tmp_path))
    assert again.crawl(OPTIONS).count() == 41 and again.crawl(OPTIONS).count() == 41
    asked = [p for _, p in quick.asked]
    assert len(asked) == len(set(asked)) == 40


def test_no_domain_exceeds_its_rate_over_batches(spark, tmp_path, servers):
    quick, _ = servers
    found = frontier.Frontier(spark, str(tmp_path))
    for lot in range(3):  # a batch for each file
        found.add(urls(spark, [f"{quick.base}/{lot}/{i}" for i in range(15)]))
    found.crawl(OPTIONS, files=1)
    times = sorted(t for t, _ in quick.asked)
    assert len(times) == 45
    for i in range(len(times) - 20):
        assert times[i + 20] - times[i] > 0.9  # no more than 20 begin in a second


def test_requests_are_under_way_together_but_few_of_one_domain(spark, servers):
    quick, slow = servers
    rows = [f"{slow.base}/{i}" for i in range(12)] + [f"{quick.base}/{i}" for i in range(12)]
    out = frontier.fetched(urls(spark, rows), {"max_per_second": "100", "max_attempts": "1"}, per_domain=4, parts=1).collect()
    assert len(out) == 24 and 2 <= slow.most <= 4
    began, ended = min(t for t, _ in slow.asked), max(t for t, _ in slow.asked)
    assert ended - began < 12 * 0.5 / 2  # not one after another
    assert max(t for t, _ in quick.asked) < ended  # the slow domain holds up no other


def test_pool_keeps_order_of_a_domain_and_its_pause():
    begun = defaultdict(list)

    def one(url):
        begun[url[0]].append((time.monotonic(), url))
        return (url,)

    got = [r[0] for r in frontier.Pool(one, 50, 8, 2).run([(u[0], u) for u in ("a1", "b1", "a2", "a3", "b2")])]
    assert sorted(got) == ["a1", "a2", "a3", "b1", "b2"] and [u for _, u in begun["a"]] == ["a1", "a2", "a3"]
    times = [t for t, _ in begun["a"]]
    assert all(b - a > 0.015 for a, b in zip(times, times[1:]))


def test_frontier_of_nothing(spark, tmp_path):
    found = frontier.Frontier(spark, str(tmp_path))
    found.add(urls(spark, [None, " "]))
    assert found.addresses().count() == 0 and found.crawl(OPTIONS).count() == 0
