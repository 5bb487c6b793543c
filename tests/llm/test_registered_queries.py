"""The registered queries themselves on a table with every odd case, and what blocks of documents take in memory."""

from __future__ import annotations

import hashlib
import random
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from test_corpus_operators import PAIRS, frame, same, some_docs  # noqa: E402

from millrace.llm import core, lm_scoring, media_columns, ngram_jaccard, queries, source_mixing, substring_dedup  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("registered"))
    frame(spark, some_docs()).write.parquet(f"{path}/documents.parquet")
    return path


def test_ngram_jaccard_query(spark, folder):
    got = ngram_jaccard.op3_ngram_jaccard(spark, folder).select("doc_id", "n_shingles", "component_id")
    same([tuple(r) for r in got.collect()], brute.components(PAIRS))


def test_mixing_query_and_its_sql(spark, folder):
    import duckdb

    got = source_mixing.op5_source_mixing(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    found = con.execute(source_mixing.ORACLE)
    names = [c[0] for c in found.description]
    same([tuple(r) for r in got.select(*names).collect()], found.fetchall())


def test_mixing_many_sources_and_ranges(spark):
    """More sources than tasks, and targets that fall into the middle of a document."""
    r = random.Random(3)
    rows = [(i, " ".join(["w"] * r.randint(0, 30)), None, r.choice([None, *(f"s{k}" for k in range(40))])) for i in range(900)] + [(None, "a b c", None, "s1")] * 40
    out = source_mixing.mix(frame(spark, rows), ranges=7).collect()
    size, target = brute.mixed_sizes([(x[3], len(brute.words(x[1]))) for x in rows])
    assert len(out) == len(rows)
    for s in size:
        mine = [x for x in out if x["row"]["source"] == s]
        assert {(x["source_size"], round(x["target"], 6)) for x in mine} == {(size[s], round(target[s], 6))}
        assert abs(sum(x["taken"] for x in mine) - target[s]) <= 1 and all(x["taken"] <= 2 * x["size"] for x in mine)


def test_scoring_query(spark, folder):
    got = lm_scoring.op7_lm_scoring(spark, folder).collect()
    want = brute.base_scores(PAIRS, lambda i: not brute.held_out(i, 7, 2))
    same([(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got], [(*w[:5], round(w[5], 6)) for w in want])
    assert all(r["score"] < 0 for r in got)


def test_dedup_query(spark, folder):
    got = substring_dedup.op8_substring_dedup(spark, folder).collect()
    want = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute.without_repeats(PAIRS)]
    same([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got], want)


def plain_feature(payload: bytes) -> str:
    """Field by field: 8 by 8 fields of an image 192 wide, which are lighter than its mean."""
    rows = [payload[i : i + 192] for i in range(0, len(payload), 192)]
    cut = [i * len(rows) // 8 for i in range(9)]
    mean, bits = sum(payload) / len(payload), ""
    for a, z in zip(cut, cut[1:]):
        for k in range(8):
            field = [x for row in rows[a:z] for x in row[k * 24 : k * 24 + 24]]
            bits += "1" if (sum(field) / len(field) if field else 0) > mean else "0"
    return f"192x{len(rows)};mean={mean:.3f};hash={int(bits, 2):016x}"


def test_media_query(spark, folder):
    got = media_columns.op10_media_columns(spark, folder).collect()
    assert len(got) == len(PAIRS)
    seen = {}
    for r, (i, text) in zip(sorted(got, key=lambda r: repr((r["doc_id"], r["n_bytes"], r["payload_sha256"]))), sorted(PAIRS, key=lambda p: repr((p[0], len((p[1] or "").encode()), hashlib.sha256(brute.payload(p[1])[1]).hexdigest()))), strict=True):
        raw, p = brute.payload(text)
        media = media_columns.to_png(p)
        assert (r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (i, len(raw), len(p), hashlib.sha256(p).hexdigest())
        assert (r["tail_crc32"], r["media_bytes"], r["media_sha256"]) == (zlib.crc32(p[-16:]), len(media), hashlib.sha256(media).hexdigest())
        assert seen.setdefault(text or "", r["feature"]) == r["feature"]
        if len(p) < 200_000:
            assert r["feature"] == plain_feature(p)


def test_pages_of_the_web_stay_aligned(spark, tmp_path):
    """Real pages with pictures put between their parts: every one comes back in its place with its caption."""
    import re

    from millrace.llm.media_columns import assembled, read_html, resolve, sequences

    path = Path("/root/testdata/sf0.001/pages.parquet")
    if not path.exists():
        pytest.skip("no test tables")
    pages = spark.read.parquet(str(path)).limit(40)
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    digest = lambda i, k: hashlib.sha256(f"{i}:{k}".encode()).hexdigest()
    made = {}
    for i, h in html.items():
        parts = re.split(r"(?=<p>)", h)
        made[i] = "".join(f"{p}<figure><img src='sha256:{digest(i, k)}'><figcaption>no. {k} &amp; more</figcaption></figure>" for k, p in enumerate(parts))
    rows = spark.createDataFrame(list(made.items()), "page_id long, html string").repartition(3)
    store = spark.createDataFrame([(digest(i, k), f"{i}:{k}") for i in made for k in range(0, 60, 2)], "digest string, media string")
    got = {r["key"]: r["parts"] for r in assembled(resolve(sequences(rows, "page_id", "html"), store), "media").collect()}
    for i, h in made.items():
        want = read_html(h)
        assert [p["position"] for p in got[i]] == list(range(len(want)))
        assert [(p["kind"], p["text"], p["digest"], p["caption"]) for p in got[i]] == [(p["kind"], p["text"], p["digest"], p["caption"]) for p in want]
        pictures = [p for p in got[i] if p["kind"] == "media"]
        assert [p["caption"] for p in pictures] == [f"no. {k} & more" for k in range(len(pictures))]
        assert all(p["media"] == (f"{i}:{k}" if k % 2 == 0 and k < 60 else None) for k, p in enumerate(pictures))


@pytest.mark.parametrize("name", queries.QUERIES)
def test_queries_on_empty_tables(spark, tmp_path, name):
    schemas = {
        "documents": "doc_id long, text string, lang string, source string, n_chars long", "benchmark": "item_id long, text string", "labels": "doc_id long, quality int, toxic int",
        "pages": "page_id long, url string, html string", "conversations": "conv_id long, turn long, role string, text string",
    }
    for table, schema in schemas.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


# ---------------------------------------------------------------- blocks
def test_blocks_follow_bytes_not_ids(spark):
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 else i * 1_000_000, f"text {i} " * (1 + i % 50), None, None) for i in range(2000)] + [(7, "long " * 100_000, None, None)]
    found = core.blocked(frame(spark, rows), "text", "test", F.col("doc_id") == 7, 20_000).select("block", F.octet_length("row.text").alias("n"), (F.col("row.doc_id") == 7).alias("apart")).collect()
    blocks = {}
    for r in found:
        blocks.setdefault(r["block"], []).append(r)
    assert len(found) == len(rows) and len(blocks) > 20
    for number, own in blocks.items():
        assert sum(r["n"] for r in own) <= 20_000 or len(own) == 1
        assert {bool(r["apart"]) for r in own} == {number % 2 == 1}


def peak_of_workers(spark) -> float:
    """MB that any Python worker has had at most."""

    def run(batches):
        import resource

        import pyarrow as pa

        for _ in batches:
            pass
        yield pa.record_batch({"mb": pa.array([resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1e3])})

    return max(r["mb"] for r in spark.range(0, 64, 1, 16).mapInArrow(run, "mb double").collect())


@pytest.mark.parametrize("kind", ["256 texts of 1 MB", "a third of all rows on one id"])
def test_memory_of_blocks(spark, tmp_path, kind):
    """Both operators on blocks, within a small part of an executor's 3,000 MB."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    r = np.random.default_rng(1)
    words = np.array(["".join(map(chr, r.integers(97, 123, r.integers(2, 9)))) for _ in range(5000)])
    if kind.startswith("256"):
        rows = [(i, " ".join(words[r.integers(0, 5000, 155_000)])) for i in range(256)]
    else:
        rows = [(7 if i % 3 == 0 else i, " ".join(words[r.integers(0, 5000, 60)])) for i in range(60_000)]
    pq.write_table(pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}), f"{tmp_path}/documents.parquet", row_group_size=max(1, len(rows) // 4))
    assert substring_dedup.op8_substring_dedup(spark, str(tmp_path)).agg(F.sum("n_words")).first()[0] == sum(t.count(" ") + 1 for _, t in rows)
    assert lm_scoring.op7_lm_scoring(spark, str(tmp_path)).agg(F.count_if(F.col("score") < 0)).first()[0] == len(rows)
    assert peak_of_workers(spark) < 1200
