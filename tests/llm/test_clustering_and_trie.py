"""Centroid clustering and the conversation trie against plain Python, with odd rows, ties, long conversations and empty tables."""

from __future__ import annotations

import hashlib
import random
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from millrace.llm import centroid_clustering as clustering  # noqa: E402
from millrace.llm import conversation_trie  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, cluster string, x int, distance string, upper string, k int"


def vectors(seed: int, n: int, size: int = 64):
    r = random.Random(seed)
    middles = [[r.uniform(-1, 1) for _ in range(size)] for _ in range(9)]
    rows = [(i, [float(np.float32(m + r.gauss(0, 0.2))) for m in r.choice(middles)]) for i in range(n)]
    rows += [(5, rows[7][1]), (5, rows[7][1]), (None, rows[3][1]), (n, [0.0] * size), (n + 1, [0.5] * size), (n + 2, [-0.5] * size)]
    return rows + [(n + 3, None), (n + 4, []), (n + 5, [1.0] * (size - 1)), (n + 6, [None] + [1.0] * (size - 1)), (n + 7, [float("nan")] * size), (n + 8, [float("inf")] + [0.0] * (size - 1))]


def table(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 5) for r in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("n", [8, 400])
def test_clustering_query_against_plain_rounds(spark, tmp_path, n):
    rows = vectors(n, n)
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = clustering.op12_centroid_clustering(spark, str(tmp_path)).collect()
    want, points = brute.clusters(rows)
    assert sorted((str(r["vec_id"]), r["cluster"], r["distance"]) for r in got) == sorted((str(a), b, c) for a, b, c in want)
    total = sum(d for _, _, d in want)
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    for r in got:
        assert r["inertia"] == total and r["centroid_sha256"] == digest[r["cluster"]] and r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])


def test_clustering_query_and_its_sql(spark, tmp_path):
    table(spark, [r for r in vectors(2, 120) if r[0] is not None]).write.parquet(f"{tmp_path}/embeddings.parquet")
    names = "vec_id cluster distance cluster_inertia inertia centroid_sha256".split()
    got = clustering.op12_centroid_clustering(spark, str(tmp_path)).select(*names)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    found = con.execute(f"SELECT {','.join(names)} FROM ({clustering.ORACLE})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(found)


def test_bounds_hold_and_save_scans(spark):
    rows = [(i, v) for i, v in vectors(6, 1500) if v is not None]
    found, c = clustering.cluster(clustering.whole_numbers(table(spark, rows)), clusters=9, rounds=6)
    seen = found.collect()
    for r in seen:
        d = np.sqrt(((np.array(r["x"]) - c.points) ** 2).sum(axis=1))
        assert r["cluster"] == d.argmin() and r["upper"] >= d[r["cluster"]] and r["lower"] <= np.delete(d, r["cluster"]).min()
    assert sum(r["scanned"] for r in seen) < len(seen) / 2


def test_ambiguous_vectors_are_decided_in_whole_numbers():
    points = np.array([[0, 0], [10, 0], [10, 0]])
    c = clustering.Centroids(points, np.zeros(3))
    x = np.array([[5, 0], [5, 7], [6, 0], [10, 0]])
    cluster, upper, lower, scanned = clustering.assign(x, np.array([1, 1, 2, 2]), np.full(4, 9.0), np.full(4, 0.0), c)
    assert cluster.tolist() == [0, 0, 1, 1] and scanned.all()


def test_clustering_of_nothing_and_of_too_large_components(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert clustering.op12_centroid_clustering(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="a component times 64"):
        clustering.whole_numbers(table(spark, [(1, [3e6] * 64)])).collect()


# ---------------------------------------------------------------- conversation trie
TALK = "conv_id long, turn long, role string, text string, c long, len long, d long, k1 string, at string, run int"
NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def talks(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 6) for r in rows], TALK).repartition(3)


def some_talks():
    r = random.Random(9)
    rows = []
    for c in [*range(60), 75, 76, 79, 101, 999, 1000, 1004]:
        say = random.Random(c % 7)
        for t in range(r.randint(1, 14)):
            rows.append((c, t, ("user", "assistant", None)[t % 3], say.choice(["hello", "né", "", None, "what now", "go on"])))
    rows += [(40, None, "system", "first"), (41, None, None, None), (None, 1, "user", "nobody's"), (7, 0, rows[7][2], "x"), (200, 1, "a", "b"), (200, 1, "a", "b"), (-3, 0, "user", "hello"), (-5, 0, "user", "hello")]
    seen, out = {}, []
    for row in rows:  # turns of one number are equal or absent
        if seen.setdefault(row[:2], row) == row:
            out.append(row)
    return out


def test_trie_query_against_plain_python_and_sql(spark, tmp_path):
    rows = some_talks()
    talks(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(str, map(tuple, conversation_trie.op13_conversation_trie(spark, str(tmp_path)).select(*NAMES).collect())))
    assert got == sorted(map(str, brute.trie(rows)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert got == sorted(map(str, con.execute(f"SELECT {','.join(NAMES)} FROM ({conversation_trie.ORACLE})").fetchall()))


def test_trie_in_short_runs_is_the_same(spark, monkeypatch):
    """A conversation of many turns, and many that end at one node, go over several runs."""
    monkeypatch.setattr(conversation_trie, "RUN", 3)
    rows = [r for r in some_talks() if (r[0] or 0) < 30] + [(10, 100 + t, "user", f"t{t % 4}") for t in range(40)] + [(c, 0, "user", "same") for c in range(300, 330, 5)]
    got = conversation_trie.trie(talks(spark, rows)).select(*NAMES).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.trie(rows)))


def test_trie_of_turnless_conversations_and_of_nothing(spark):
    alone = [(c, 0, "user", "x") for c in range(40) if __import__("zlib").crc32(str(c).encode()) % 9 > 0 and c % 5]
    got = conversation_trie.trie(talks(spark, alone)).select(*NAMES).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.trie(alone))) and len(got) == 1
    assert conversation_trie.trie(talks(spark, [])).count() == 0
    assert conversation_trie.trie(talks(spark, [(None, 1, "a", "b")])).count() == 0
