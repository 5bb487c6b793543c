"""Registered queries that SQL cannot express, against plain Python over all pairs or all chunks."""

from __future__ import annotations

import hashlib
import json
import re
from pathlib import Path

import pytest

from millrace.operators import chunking
from millrace.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
LEGAL = set("inc incorporated corp corporation llc limited ltd co company the group holdings llp plc gmbh sa as".split())



def common(a: str, b: str) -> int:
    """Longest common subsequence, cell by cell."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a: str, b: str) -> float:
    return 200 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    one, two = (" ".join(sorted(s)) for s in (x - y, y - x))
    if both and not (one and two):
        return 100.0
    if not both:
        return ratio(one, two)
    return max(ratio(f"{both} {one}", f"{both} {two}"), ratio(both, f"{both} {one}"), ratio(both, f"{both} {two}"))


def test_fuzzy_queries_against_all_pairs(spark):
    parts = {r["p_partkey"]: r["p_name"] for r in spark.read.parquet(f"{DATA}/part.parquet").collect()}
    norm = {k: " ".join(w for w in re.sub(r"[^\w\s\-']", "", v.lower()).split()) for k, v in parts.items()}
    want = {}
    for q in (k for k in parts if k % 100 == 0):
        scored = sorted(((token_set(norm[q], norm[k]), -k) for k in parts), reverse=True)
        want[q] = [(round(s, 4), -k) for s, k in scored if s >= 80][:5]
    got = {}
    for r in catalogue.fuzzy_topk(spark, DATA).collect():
        got.setdefault(r["name_id"], {})[r["rank"]] = (r["score"], r["candidate_id"])
    assert {q: [ranks[i] for i in sorted(ranks)] for q, ranks in got.items()} == {q: w for q, w in want.items() if w}
    best = {r["name_id"]: (r["score"], r["candidate"]) for r in catalogue.fuzzy_best(spark, DATA).collect()}
    assert best == {q: (w[0][0], parts[w[0][1]]) for q, w in want.items() if w}


def test_resolution_queries_against_all_pairs(spark):
    nations = {r["n_nationkey"]: r for r in spark.read.parquet(f"{DATA}/nation.parquet").collect()}
    known = {r["s_suppkey"]: r["s_name"] for r in spark.read.parquet(f"{DATA}/supplier.parquet").collect()}

    def norm(x):
        return " ".join(w for w in re.sub(r"[^\w\s\-']", "", x.lower()).split() if w not in LEGAL)

    aliases = {norm(f"{n['n_name']} Inc."): norm(f"Nation {n['n_regionkey']}") for n in nations.values()}
    names = {}
    for r in spark.read.parquet(f"{DATA}/customer.parquet").collect():
        n = nations.get(r["c_nationkey"])
        names[r["c_custkey"]] = (f"The {n['n_name']}" if n else None) if r["c_custkey"] % 2 == 0 else r["c_name"]
    names |= {-1 - k: f"{v} LLC" for k, v in known.items()}
    want = {}
    for i, raw in names.items():
        if not (raw or "").strip():
            want[i] = (None, "exact", 0.0, False)
            continue
        n = norm(raw)
        same = [v for k, v in sorted(known.items()) if norm(v) == n]
        score, best = max(((token_set(n, norm(v)), -k) for k, v in known.items()), default=(0, 0))
        if n in aliases:
            want[i] = (aliases[n], "alias", 1.0, False)
        elif same:
            want[i] = (same[0], "exact", 1.0, False)
        elif score / 100 >= 0.95:
            want[i] = (known[-best], "fuzzy", round(score / 100, 4), False)
        else:
            want[i] = (n, "exact", 0.7, score >= 80)
    rows = catalogue.entity_resolve(spark, DATA).collect()
    assert {r["name_id"]: (r["canonical"], r["method"], r["confidence"], r["needs_review"]) for r in rows} == want and len(rows) == len(names)
    log = {r["name_id"]: (r["raw_name"], r["canonical_name"], r["method"], r["confidence"], r["entity_type"]) for r in catalogue.mapping_log(spark, DATA).collect()}
    assert log == {i: (names[i], *want[i][:3], "STARTUP") for i in names}


def cut(text: str, room: int) -> list[str]:
    """The chunks of a text by the rules as they are written down: each way in turn, all pieces first, joined afterwards."""
    if len(text) // 4 <= room:
        return [text]
    marks = {"heading": r"\n(?=\s*#{1,6}\s+\S)", "tag": r"(?i)(?=<h[1-6][\s>])", "paragraph": r"\n{2,}", "sentence": r"(?<=[.!?])\s+"}
    for kind, mark in marks.items():
        parts = [p.strip() for p in re.split(mark, text) if p.strip()]
        if len(parts) < 2:
            continue
        small = sum((cut(p, room) for p in parts), [])
        if kind in ("heading", "tag"):
            return small
        out = small[:1]
        for p in small[1:]:
            whole = out[-1] + ("\n\n" if kind == "paragraph" else " ") + p
            out = [*out[:-1], whole] if len(whole) // 4 <= room else [*out, p]
        return out
    return [text[i : i + 4 * room] for i in range(0, len(text), 4 * room)]


def with_ends(own: list[str], chars: int) -> list[str]:
    return own[:1] + [a[-chars:] + b for a, b in zip(own, own[1:])]


def chunks_of(text: str, limit: int, overlap: int) -> list[str]:
    return with_ends(cut(text, limit if len(text) // 4 <= limit else limit - overlap), 4 * overlap)


def test_chunk_query_against_the_rules_written_out(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {(r["doc_id"], r["chunk_no"]): (r["n_chars"], r["hash"]) for r in catalogue.chunk_documents(spark, DATA).collect()}
    want = {(i, n): (len(c), hashlib.sha256(c.encode()).hexdigest()) for i, t in texts.items() if t is not None for n, c in enumerate(chunks_of(t, 200, 20))}
    assert got == want and any(n > 3 for _, n in want)


def test_chunks_of_texts_with_every_kind_of_cut(spark):
    words = "one two three. four five! six seven? " * 6
    odd = ["", " ", None, "x" * 5000, "# a\n" + words + "\n## b\n" + words, f"<h1>t</h1>{words}<H2 class='x'>u</H2>{words}", "\n\n".join([words] * 5), words * 9, f"{words}\n\n{'y' * 3000}\n\nz", "é. " * 2000]
    rows = spark.createDataFrame(list(enumerate(odd)), "id int, text string")
    chunking.register(spark)
    rows.createOrReplaceTempView("odd_texts")
    want = [(i, n, c) for i, t in enumerate(odd) if t is not None for n, c in enumerate(chunks_of(t, 60, 7))]
    assert sorted(map(tuple, spark.sql("SELECT id, chunk_no, chunk FROM odd_texts, LATERAL chunks(text, 60, 7)").collect())) == sorted(want)
    assert sorted(map(tuple, chunking.chunked(rows, "id", "text", 60, 7).collect())) == sorted(want)
    assert "".join(split := chunking.split_text("a b. " * 500, 50)) and all(len(c) // 4 <= 50 for c in split)


def test_long_texts_take_linear_time():
    import time

    took = []
    for n in (20_000, 80_000):
        text = " ".join(f"word{i % 97}." for i in range(n))
        began = time.perf_counter()
        assert sum(1 for _ in chunking.pieces(text, 6000)) > 1
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0] + 0.05


def test_extraction_query_merges_what_the_chunks_said(spark):
    said = {}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        for chunk in chunks_of(r["text"], 2000, 100) if r["text"] is not None else []:
            said.setdefault(r["doc_id"], []).append(((chunk.strip().splitlines() or [""])[0][:80], len(chunk)))
    want = {i: (max((t for t, _ in x), key=len), x[-1][1]) for i, x in said.items()}
    got = {r["doc_id"]: (r["title"], r["body_chars"]) for r in catalogue.extract_records(spark, DATA).collect()}
    assert got == want


def test_crawl_query_counts_what_there_is(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    got = {r["table"]: r["n"] for r in catalogue.crawl_to_store(spark, DATA).collect()}
    good = [r for r in pages if r["page_id"] % 10 != 9]
    assert got["failed"] == len(pages) - len(good) and got["raw_documents"] == len({r["html"] for r in good})
    kinds = dict(zip(["startups", "products", "research_papers", "jobs", "news"], range(5)))
    assert got["jobs"] and got["news"]
    for table, k in kinds.items():
        assert 0 <= got[table] <= sum(r["page_id"] % 5 == k for r in good)


def test_replies_hash_like_sorted_json(spark):
    rows = spark.read.parquet(f"{DATA}/events.parquet").limit(50).collect()
    got = {r["event_id"]: r["hash"] for r in catalogue.dict_hash(spark, DATA).collect()}
    for r in rows:
        made = json.dumps({"z": r["event_type"], **json.loads(r["props"]), "a": r["event_id"]}, sort_keys=True)
        assert got[r["event_id"]] == hashlib.sha256(made.encode()).hexdigest()
