"""The pipeline's stages against brute force, each on its own input, and the whole run."""

from __future__ import annotations

import importlib.util
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from test_corpus_operators import ITEMS, frame, plain_vector, prose, some_docs  # noqa: E402

pytestmark = pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="the pipeline is not there")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    frame(spark, some_docs()).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]


def by_language(docs):
    """Prototypes from all documents that name a language; texts without a letter or like none of them go."""
    import numpy as np

    vectors = [plain_vector(d[1]) for d in docs]
    sums = {}
    for d, v in zip(docs, vectors, strict=True):
        if d[1] is not None and d[2] is not None and v.any():
            sums[d[2]] = sums.get(d[2], 0) + v
    langs = sorted(sums)
    unit = {k: sums[k] / np.linalg.norm(sums[k]) for k in langs}
    middle = sum(unit.values()) / len(unit)
    out = []
    for d, v in zip(docs, vectors, strict=True):
        if v.any():
            u = v / np.linalg.norm(v) - middle
            cosines = [float(u @ (unit[k] - middle) / np.linalg.norm(u) / np.linalg.norm(unit[k] - middle)) for k in langs]
            if (1 + max(cosines)) / 2 >= 0.52:
                out.append((*d[:2], d[2] or langs[int(np.argmax(np.round(cosines, 12)))], *d[3:]))
    return out


def one_of_each(docs):
    found = brute.components([(i, d[1]) for i, d in enumerate(docs)], 5, 80, 100)
    groups = {}
    for (number, n, top), d in zip(found, docs, strict=True):
        groups.setdefault((top, n and None), []).append((d[0] is None, d[0] or 0, number))
    return [docs[min(g)[2]] for g in groups.values()]


def expected(name, docs):
    pairs = [(d[0], d[1]) for d in docs]
    if name == "language_id":
        return by_language(docs)
    if name == "ngram_jaccard":
        return one_of_each(docs)
    if name == "substring_dedup":
        out = []
        for d, (_, n, removed, kept) in zip(docs, brute.without_repeats(pairs, keep_first=True), strict=True):
            if removed == 0:
                out.append(d)
            elif removed < n:
                out.append((d[0], kept, d[2], d[3], len(kept)))
        return out
    return [d for d, hit in zip(docs, brute.leaks(pairs, ITEMS), strict=True) if not hit[5]]


def test_stages_and_run(spark, folder):
    import corpus_pipeline

    docs = first = spark.read.parquet(f"{folder}/documents.parquet")
    names, letters = docs.columns, {d[0] for d in rows(docs) if any(x.isalpha() for x in d[1] or "")}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        have = rows(docs)
        out = stage(spark, docs, folder)
        assert out.columns == names
        out.write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        assert sorted(map(repr, rows(out))) == sorted(map(repr, expected(name, have))), name
        if name == "language_id":  # the prediction decides, not the letters alone
            left = {d[0] for d in rows(out)}
            assert left < letters and len(left) > 20 and all(d[2] for d in rows(out))
        docs = first if name == "language_id" else out  # the other stages get all documents
    want = rows(docs)
    assert len(want) > 20 and sum(prose(1, 60) in (d[1] or "") for d in want) == 0 < sum(prose(1, 60) in (d[1] or "") for d in have)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    size, target = brute.mixed_sizes([(d[3], len(brute.words(d[1]))) for d in want])
    assert sorted(map(repr, ((r["doc_id"], r["text"], r["lang"], r["source"]) for r in last))) == sorted(map(repr, (d[:4] for d in want)))
    for s in size:
        mine = [r for r in last if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= 1
        assert all(r["taken"] == r["repeats"] * r["size"] + r["more_words"] and r["taken"] <= 2 * r["size"] for r in mine)


def test_run_leaves_nothing_but_its_result(spark, folder):
    import corpus_pipeline
    from millrace.llm.core import scratch_dir

    def tables():
        return {x.name for x in Path(scratch_dir(spark).removeprefix("file:")).iterdir() if x.name.startswith("millrace-")}

    before = tables()
    whole = corpus_pipeline.run(spark, folder)
    assert [x.rsplit("-", 1)[0] for x in tables() - before] == ["millrace-pipeline-source_mixing"]
    again = corpus_pipeline.run(spark, folder)
    assert whole.count() > 10 and sorted(map(repr, whole.collect())) == sorted(map(repr, again.collect()))


def test_a_stage_can_be_started_twice_before_it_is_read(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        one, two = stage(spark, docs, folder), stage(spark, docs, folder)
        assert one.count() == two.count(), name


def test_empty_documents(spark, tmp_path):
    import corpus_pipeline

    path = str(tmp_path)
    frame(spark, []).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_documents_without_languages_stay(spark, tmp_path):
    import corpus_pipeline

    docs = frame(spark, [(1, "abc", None, None), (2, "12", None, None), (3, None, None, None)])
    assert [r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path)).collect()] == [1]


def test_stages_are_five():
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard", "substring_dedup", "decontamination", "source_mixing"]
