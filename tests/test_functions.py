"""Literal cases and properties of the column functions."""

from __future__ import annotations

import datetime as dt
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import dates, hashing, html, text, url
from millrace.operators import chunking, enrichment, resolution

AS_OF = "2024-01-30 00:00:00"


def values(spark, xs, f, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_url_normalized(spark):
    cases = {
        "https://Example.com/path/": "https://example.com/path", "HTTP://WWW.Ex.com:80/A//?b=1&a=#f": "http://ex.com/A?a=&b=1", "https://a.com:443/X#f": "https://a.com/X",
        "https://ex.com/": "https://ex.com/", "https://ex.com": "https://ex.com", "": "", "  ": "", "https://ex.com//": "https://ex.com", "http://e.x/?b=2&c=&a=1&flag": "http://e.x/?a=1&b=2&c=&flag=",
        "http://e.x/p?a=2&b=0&a=1": "http://e.x/p?a=2&a=1&b=0", "http://e.x/p?q=a+b&r=%C3%A9": "http://e.x/p?q=a+b&r=%C3%A9",
    }
    got = values(spark, list(cases), url.normalized)
    assert dict(zip(cases, got)) == cases
    assert values(spark, got, url.normalized) == got
    assert values(spark, [None], url.normalized) == [None]


def test_url_parts(spark):
    assert values(spark, ["https://www.A.com:8080/x", "x"], url.domain) == ["a.com:8080", ""]
    assert values(spark, ["https://a", "a.com", "", None], url.is_valid) == [True, False, False, False]
    assert values(spark, ["a.com/x", "http://a", " ", "//a.com"], url.fixed) == ["https://a.com/x", "http://a", "", "https://a.com"]
    assert values(spark, ["https://h/x", "a/b", ""], url.limiter_domain) == ["h", "a", "unknown"]
    assert values(spark, ["http://www.GitHub.com/O/r.git/", "github.com/o/r"], url.repo_url) == ["https://github.com/O/r", "https://github.com/o/r"]
    assert values(spark, ["see https://github.com/o/r.git. and/or github.com/o/r, x/y"], url.repo_urls) == [["https://github.com/o/r"]]
    assert values(spark, ["https://arxiv.org/abs/2401.1v2", "https://arxiv.org/list/2401.1"], url.arxiv_id) == ["2401.1", None]


def test_names(spark):
    cases = ["Émile & Söhne GmbH.", "The Acme Co. Holdings, Inc", "l'é co-op", "", None, "Café Ltd", "company"]
    assert values(spark, cases, resolution.canonical_name) == ["émile söhne", "acme", "l'é -op", "", None, "café", ""]
    got = values(spark, cases[:4], resolution.canonical_name)
    assert values(spark, got, resolution.canonical_name) == [g.replace("-op", "-op") for g in got]


def test_text(spark):
    assert values(spark, ["a \n\n\n\n b\t\tc \n d "], text.blanks_normalized) == ["a\n\nb c\nd"]
    assert values(spark, ["ab\n\ncd"], lambda x: F.array(text.truncated(x, 3), text.truncated(x, 4), text.truncated(x, 5))) == [["ab", "ab", "ab\n\nc"]]
    assert values(spark, ["WFH ok", "our office", "x", None], text.is_remote) == [True, False, None, None]
    assert values(spark, ["guide"], lambda x: F.array(text.role_family(x, F.lit("")), text.role_family(x, F.lit(""), True))) == [["Design", "Other"]]
    assert values(spark, ["Freemium", "free", "Premium", "?", None], text.pricing) == ["FREEMIUM", "FREE", "PAID", None, None]
    assert values(spark, ["# A\nx\n## B\ny"], text.heading_sections) == [["# A\nx", "## B\ny"]]
    assert values(spark, [" A B; ;C,"], text.authors) == [["A B", "C"]]


def test_dates(spark):
    d = lambda *x: dt.datetime(*x)
    cases = {
        "2024-01-15": (d(2024, 1, 15), 0.99), "2024": (d(2024, 1, 1), 0.99), "2024-02": (d(2024, 2, 1), 0.99), "20240115": (d(2024, 1, 15), 0.99), "2024-W03-1": (d(2024, 1, 15), 0.99),
        "2024-015": (d(2024, 1, 15), 0.99), "2024-01-15T10:00:00+02:00": (d(2024, 1, 15, 8), 0.99), "31/12/2024": (d(2024, 12, 31), 0.95), "1/5/2024": (d(2024, 1, 5), 0.95),
        "January 5, 2024": (d(2024, 1, 5), 0.95), "Jan 5 2024": (d(2024, 1, 5), 0.95), "3 days ago": (d(2024, 1, 27), 0.85), "5m ago": (d(2023, 9, 2), 0.85), "Yesterday": (d(2024, 1, 29), 0.85),
        "10:15": (None, 0.0), "junk": (None, 0.0), "": (None, 0.0), None: (None, 0.0),
    }
    got = values(spark, list(cases), lambda x: dates.cascade(x, F.lit(AS_OF).cast("timestamp")))
    assert {k: (g["ts"], g["confidence"]) for k, g in zip(cases, got)} == cases
    said = spark.createDataFrame([("on the 5th of March 2023, they said",)], "x string")
    fuzzy = dates.with_read(said, F.array("x", F.lit("junk"), F.lit("2 hours ago")), F.lit(AS_OF).cast("timestamp"), "read").first()["read"]
    assert [(x["ts"], x["confidence"]) for x in fuzzy[:2]] == [(d(2023, 3, 5), 0.70), (None, 0.0)] and fuzzy[2]["confidence"] == 0.85
    said = ["1 second ago", "2 weeks  ago", "3y ago", "4 d ago", "5days ago", "6s ago"]
    ago = [x["ts"] and (d(2024, 1, 30) - x["ts"]).total_seconds() for x in values(spark, said, lambda x: F.struct(dates.relative(x, F.lit("2024-01-30").cast("timestamp")).alias("ts")))]
    assert ago == [1, 2 * 604800, 3 * 365 * 86400, None, None, None]
    assert values(spark, ["Sept 5, 2024 or Mai 5, 2024, 5/6/2024 x2024-01-02"], dates.in_text) == [["Sept 5, 2024", "5/6/2024"]]
    assert values(spark, ["On 2024-01-02T03:04:05Z and January 3 2024, 2024/1/5"], dates.in_text) == [["2024-01-02T03:04:05Z", "January 3 2024", "2024/1/5"]]


def test_json(spark):
    assert values(spark, ["{a: 'x', b:[1,2,],}"], hashing.json_repaired) == ['{ "a": "x", "b":[1,2]}']
    replies = ['```json\n{"k": 1}\n```', "{k: 2,}", "no", None]
    assert values(spark, replies, lambda x: F.try_variant_get(hashing.parsed_reply(x), "$.k", "int")) == [1, 2, None, None]
    one, two = values(spark, ['{"b":1,"a":2}', '{"a": 2, "b": 1}'], hashing.dict_hash)
    assert one == two and values(spark, ["x"], hashing.dict_hash) == [None]
    assert values(spark, ["test content"] * 2, hashing.content_hash)[0].startswith("6ae8a755")


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert [r[0] and round(r[0], 6) for r in df.select(hashing.cosine(F.col("a"), F.col("b"))).collect()] == [0.707107, None, None]


def test_html():
    page = html.read(
        '<html><head><title>T &amp; x</title><meta property="og:image" content="i.png"><meta name="Author" content="Ann"><link rel="canonical" href="/c">'
        '<script type="application/ld+json">[{"datePublished":"2024-01-02"}]</script><script>var x = "</p>";</script></head>'
        '<body><nav>no</nav><div class="heading">H</div><div class="ad">buy</div><h1>A</h1><p>B<p>C &copy;<!-- c --></p></b><time datetime="2024-01-01">then</time><a href="/apply">go</a>'
    )
    assert page["title"] == "T & x" and page["headings"] == ["A"] and page["paragraphs"] == ["B", "C ©"]
    assert page["clean_text"] == "T & xHABC ©thengo" and "script" not in page["clean_text"]
    assert page["meta"] == {"og_image": "i.png", "meta_author": "Ann", "canonical_url": "/c", "published_date": "2024-01-02"}
    assert [x["source"] for x in page["dates"]] == ["time_element", "json_ld"] and page["links"] == ["/apply"]
    assert html.read(None)["title"] == "" and html.read("<p>short</p>")["title"] == "Untitled"
    assert html.read("<div class=heading>H</div>", whole_words=False)["clean_text"] == ""


def test_feeds(spark):
    feed = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2401.00001v1</id></entry><entry><id>http://arxiv.org/abs/2401.00002v3</id></entry></feed>'
    assert values(spark, [feed], enrichment.feed_urls) == [["https://arxiv.org/abs/2401.00001", "https://arxiv.org/abs/2401.00002"]]
    df = spark.createDataFrame([("https://github.com/janedoe/fastnet", "FastNet: quick nets", ["JaneDoe", "Li"]), ("https://github.com/a/b", "", None)], "u string, t string, a array<string>")
    assert [r[0] for r in df.select(enrichment.confidence(F.col("u"), F.col("t"), F.col("a"))).collect()] == [0.9, 0.5]


@pytest.mark.parametrize("a,b,score", [("open ai research", "open ai", 100), ("acme robotics", "acme robots", 91.6667), ("deep mind labs", "deepmind labs", 96.2963), ("red widget", "blue bolt", 31.5789), ("small ring", "small gear", 70), ("", "a", 0)])
def test_token_set_ratio(a, b, score):
    assert round(resolution.token_set_ratio(a, b), 4) == score


@given(st.text("ab c", max_size=12), st.text("ab c", max_size=12))
def test_token_set_ratio_properties(a, b):
    assert 0 <= resolution.token_set_ratio(a, b) <= 100
    assert resolution.token_set_ratio(a, b) == pytest.approx(resolution.token_set_ratio(b, a))


@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
def test_indel(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    assert resolution.indel(a, b) == len(a) + len(b) - 2 * rows[-1][-1]


@settings(deadline=None)
@given(st.text("ab .!\n#", max_size=300), st.integers(1, 20))
def test_chunks_fit_and_cover(x, limit):
    parts = chunking.split_text(x, limit)
    assert all(len(p) // 4 <= limit for p in parts)
    assert "".join("".join(parts).split()) == "".join(x.split())


def test_chunks_of_an_unbreakable_text():
    assert [len(p) for p in chunking.split_text("x" * 50_000, 6000)] == [24_000, 24_000, 2_000]


def test_nfc_is_what_python_says():
    assert resolution._nfc(__import__("pandas").Series(["é", None])).tolist() == [unicodedata.normalize("NFC", "é"), None]
