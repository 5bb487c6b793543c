"""Repeated byte strings against brute force, and the parts of the merge sort by themselves."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from test_corpus_operators import frame, some_docs  # noqa: E402

from millrace.llm import core, suffix_dedup  # noqa: E402
from millrace.llm.suffix_dedup import Shape  # noqa: E402


def result(out):
    return sorted((str(r["row"]["doc_id"]), r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in out.collect())


def wanted(rows, width):
    return sorted((str(i), *x) for i, *x in brute.repeated_bytes([r[:2] for r in rows], width))


def copied_docs(seed: int, n: int = 60) -> list[tuple]:
    """Texts of few letters with pieces of each other, so that repeats meet, overlap and end anywhere."""
    r = random.Random(seed)
    texts = ["".join(r.choice("abé ") for _ in range(r.randint(0, 160))) for _ in range(n)]
    for i in range(n):
        a, b = texts[r.randrange(n)], r.randint(5, 90)
        at, to = r.randint(0, max(0, len(a) - b)), r.randint(0, len(texts[i]))
        texts[i] = texts[i][:to] + a[at : at + b] + texts[i][to:]
    texts += ["a" * 150, "ab" * 80, texts[3], texts[3], None, "", "é" * 40, "\x00" * 70, "x\x00" * 30]
    return [(i, t, None, None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("width,hot,block", [(200, 1 << 18, 1 << 20), (50, 1 << 18, 700), (33, 2, 3000), (24, 5, 700), (9, 1 << 18, 1 << 20), (3, 3, 2000), (1, 9, 5000)])
def test_suffix_dedup_is_brute_force(spark, width, hot, block):
    rows = copied_docs(width)
    out = suffix_dedup.remove_repeated_strings(frame(spark, rows), width=width, hot=hot, block_bytes=block)
    assert result(out) == wanted(rows, width)


def test_suffix_dedup_on_odd_documents(spark):
    rows = some_docs()
    out = suffix_dedup.remove_repeated_strings(frame(spark, rows), hot=3)
    assert result(out) == wanted(rows, 200)
    for r in out.collect():
        body = (r["row"]["text"] or "").encode()
        assert b"".join(body[a:z] for a, z in zip([0, *[s["end"] for s in r["spans"]]], [*[s["begin"] for s in r["spans"]], len(body)], strict=True)) == bytes(r["kept"])


def test_suffix_dedup_query_and_empty_table(spark, tmp_path):
    rows = some_docs()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = suffix_dedup.op11_suffix_dedup(spark, str(tmp_path)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == wanted(rows, 200)
    assert suffix_dedup.remove_repeated_strings(frame(spark, [])).count() == 0


def test_edge_that_a_third_of_all_documents_share(spark):
    """Every entry at the edges differs: they go string by string, joined in each task before they are sent."""
    r = random.Random(4)
    passage = "".join(r.choice("abcdefgh ") for _ in range(150))
    rows = [(i, "".join(r.choice("abcdefgh ") for _ in range(60)) + (passage if i % 3 == 0 else "") + "".join(r.choice("abcdefgh ") for _ in range(60)), None, None) for i in range(300)]
    same = [suffix_dedup.remove_repeated_strings(frame(spark, rows), width=60, hot=hot) for hot in (10, 1 << 18)]
    assert result(same[0]) == result(same[1]) == wanted(rows, 60)


def test_samples_follow_from_the_strings_alone():
    r = random.Random(1)
    text = bytes(r.choice(b"ab") for _ in range(3000))
    data = np.frombuffer(b"zz" + text + b"yy" + text, np.uint8)
    offsets = np.array([0, len(text) + 2, len(data)])
    shape = Shape.of(60)
    at = np.concatenate([x for x, _ in suffix_dedup.samples(data, offsets, shape)])
    here, there = set((at[at < offsets[1]] - 2).tolist()), set((at[at >= offsets[1]] - offsets[1] - 2).tolist())
    assert {p for p in here if p >= shape.left} == {p for p in there if p >= shape.left} and len(at) < len(data) / 4
    known = set(at.tolist())
    assert all(any(p in known for p in range(start, start + shape.sample)) for start in range(2, len(text) - 58))


def test_samples_do_not_depend_on_pieces(monkeypatch):
    r = random.Random(2)
    texts = pa.array(["".join(r.choice("ab") for _ in range(n)) for n in (500, 0, 90, 30, 2000)])
    (s,) = core.slices(texts)
    whole = [np.concatenate(x) for x in zip(*suffix_dedup.samples(s.data, s.offsets, Shape.of(60)), strict=True)]
    monkeypatch.setattr(suffix_dedup, "PIECE", 97)
    pieces = [np.concatenate(x) for x in zip(*suffix_dedup.samples(s.data, s.offsets, Shape.of(60)), strict=True)]
    assert all(np.array_equal(a, b) for a, b in zip(whole, pieces, strict=True))


@pytest.mark.parametrize("k", [1, 2, 3, 7, 16])
def test_loser_tree_merges_front_coded_runs(k):
    r = random.Random(k)
    everything, runs = [], []
    for _ in range(k):
        own = sorted({bytes(r.choice(b"ab") for _ in range(9)) for _ in range(r.randint(0 if k > 1 else 1, 60))})
        everything += own
        rows = np.frombuffer(b"".join(own), np.uint8).reshape(-1, 9)
        runs.append(suffix_dedup.decode_run(suffix_dedup.encode_run(rows, suffix_dedup._common(rows)), 9) if own else ([], []))
    of_run, of_place, common = suffix_dedup.merge(runs, 9)
    merged = [runs[a][0][b] for a, b in zip(of_run, of_place, strict=True)]
    assert merged == sorted(everything) and common[:1] == [0] * len(common[:1])
    for a, b, h in zip(merged[:-1], merged[1:], common[1:], strict=True):
        assert h == next((i for i in range(9) if a[i] != b[i]), 9)


def test_a_known_prefix_is_never_compared_again(monkeypatch):
    """Characters compared stay near the sum of distinguishing prefixes, whatever the length of what runs share."""
    looked = []

    class Counting(bytes):
        def __getitem__(self, i):
            if isinstance(i, slice):
                looked.append(i.start)
            return bytes.__getitem__(self, i)

    shared = b"x" * 100
    own = [[Counting(shared + bytes([a, b])) for b in range(20)] for a in range(8)]
    runs = [(keys, [0] + [101] * 19) for keys in own]
    suffix_dedup.merge(runs, 102)
    assert sum(x < 100 for x in looked) <= 2 * 7 and len(looked) < 8 * 20
