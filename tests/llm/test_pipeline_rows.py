"""The near-duplicate stage against brute force with its own shingles and similarity."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from test_corpus_operators import frame, prose, some_docs  # noqa: E402


def near_copies(spark, path, rows):
    import corpus_pipeline

    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    return corpus_pipeline.STAGES[1][1](spark, docs, str(path)).select("doc_id", "text").collect()


def test_near_duplicates_have_five_words_and_four_fifths(spark, tmp_path):
    base = prose(40, 100)
    spaced = base.split(" ")
    spaced[50] = "edit"
    loose = base.split(" ")
    for i in range(5, 100, 10):
        loose[i] = f"edit{i}"
    texts = [base, f"{base} {prose(41, 20)}", " ".join(spaced), " ".join(loose), *[t for t in dict.fromkeys(d[1] for d in some_docs()) if t and t.strip()]]
    pairs = list(enumerate(texts))
    want = sorted(i for i, _, top in brute.components(pairs, 5, 80, 100) if i == top)
    assert want != sorted(i for i, _, top in brute.components(pairs) if i == top)
    got = sorted(r["doc_id"] for r in near_copies(spark, tmp_path, [(i, t, "en", "a") for i, t in pairs]))
    assert got == want and 1 not in got and 3 in got


def test_one_row_of_each_group_stays(spark, tmp_path):
    a, b, c, d, e = (prose(50 + i, 60) for i in range(5))
    rows = [(5, a), (5, a), (5, a), (None, b), (None, b), (1, c), (7, f"{c} tail"), (7, d), (None, e), (2, e), (2, "few words"), (2, "other words"), (9, None), (9, None)]
    got = near_copies(spark, tmp_path, [(i, t, "en", "a") for i, t in rows])
    want = [(5, a), (None, b), (1, c), (7, d), (2, e), (2, "few words"), (2, "other words"), (9, None), (9, None)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_a_repeated_row_survives_the_run_once(spark, tmp_path):
    import corpus_pipeline

    rows = [(1, prose(60, 60)), (1, prose(60, 60)), (None, prose(61, 60)), (None, prose(61, 60)), (2, prose(62, 60))]
    frame(spark, [(i, t, "en", "a") for i, t in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((repr(r["doc_id"]), r["size"]) for r in got) == [("1", 60), ("2", 60), ("None", 60)]


def test_rows_against_brute_force(spark, tmp_path):
    rows = [d for d in some_docs() if d[1] and d[1].strip()]
    groups = {}
    for (number, _, top), d in zip(brute.components([(i, d[1]) for i, d in enumerate(rows)], 5, 80, 100), rows, strict=True):
        groups.setdefault(top, []).append((d[0] is None, d[0] or 0, number))
    want = sorted(repr(rows[min(g)[2]][0]) for g in groups.values())
    assert sorted(repr(r["doc_id"]) for r in near_copies(spark, tmp_path, rows)) == want
