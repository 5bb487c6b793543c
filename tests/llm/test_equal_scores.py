"""Scores of operators 4 and 9 depend on the text alone, whatever lies beside it and however the input is split."""

from __future__ import annotations

import random
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from test_corpus_operators import frame, prose  # noqa: E402

from millrace.llm import core, language_id, toxicity  # noqa: E402


@pytest.fixture(scope="module")
def texts():
    r = random.Random(8)
    return [prose(500 + i, r.randint(1, 200)) for i in range(120)] + ["", None, "a", "é " * 300_000, "word " * 300_000]


@pytest.mark.parametrize("parts", [1, 7])
def test_each_text_five_times_in_other_splits(spark, texts, parts):
    r = random.Random(parts)
    rows = [(i, t, ("en", "fr", "de")[i % 3], "a") for i, t in enumerate(texts * 5)]
    r.shuffle(rows)
    docs = frame(spark, rows).repartition(parts)
    model = language_id.learn_prototypes(docs)
    seen = defaultdict(set)
    for x in language_id.identify(docs.select("doc_id", "text"), *model).collect():
        seen[x["row"]["text"]].add((x["lang_pred"], x["score"]))
    weights = np.random.default_rng(1).normal(size=toxicity.FEATURES)
    for x in toxicity.score(docs.select("doc_id", "text"), toxicity.Model(weights, 0.1)).collect():
        seen["toxic", texts[x["doc_id"] % len(texts)]].add(x["score"])
    assert len(seen) == 2 * len(set(texts)) and all(len(x) == 1 for x in seen.values())


def test_prototypes_do_not_depend_on_the_split(spark, texts):
    rows = [(i, t, ("en", "fr", "de")[i % 3], "a") for i, t in enumerate(texts)]
    made = [language_id.learn_prototypes(frame(spark, rows).repartition(n)) for n in (1, 5)]
    assert made[0][0] == made[1][0] and np.array_equal(made[0][1], made[1][1])


def test_bundles_are_exact_at_large_counts():
    space = language_id.Space.get()
    r = np.random.default_rng(2)
    keys = np.sort(r.choice(language_id.GRAMS, 9000, replace=False))
    counts = r.integers(0, 100_000_000, 9000)
    want = (space.vectors(keys, np.int64) * counts[:, None]).sum(axis=0)
    assert np.array_equal(space.bundle(keys, counts), want.astype(float))


def test_vectors_judged_alone_and_together():
    r = np.random.default_rng(3)
    judge = language_id.Judge(list("abcdef"), r.normal(size=(6, language_id.DIMENSIONS)))
    v = r.integers(-50, 50, (300, language_id.DIMENSIONS)).astype(float)
    together = judge(v)
    alone = [judge(v[i : i + 1]) for i in range(300)]
    assert [x[0][0] for x in alone] == list(together[0]) and [x[1][0] for x in alone] == list(together[1])


def test_toxicity_of_a_document_is_that_of_its_slice():
    some = [prose(i, 50) for i in range(40)]
    model = toxicity.Model(np.random.default_rng(4).normal(size=toxicity.FEATURES), -0.2)
    (whole,) = core.slices(pa.array(some))
    together = model.score(*toxicity.features(whole))
    alone = [model.score(*toxicity.features(next(core.slices(pa.array([t])))))[0] for t in some]
    assert alone == list(together)
