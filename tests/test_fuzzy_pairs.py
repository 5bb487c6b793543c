"""Close names against all pairs."""

import random

import pytest

from millrace.operators import fuzzy, resolution


@pytest.mark.parametrize("cutoff", [60, 80, 95])
def test_fuzzy_pairs_are_those_of_all_pairs(spark, cutoff):
    r = random.Random(3)
    texts = ["nvidea", "nvidia", "internationalbusinessmachine", "internationalbusinessmachines", "deep mind labs", "deepmind labz", "é", "aéb", "a", "ab", "ba", "red ring", "ringred"]
    for _ in range(40):
        word = "".join(r.choice("abcé") for _ in range(r.randint(3, 9)))
        i = r.randrange(len(word))
        texts += [word, word[:i] + r.choice("abc ") + word[i:], f"{word[:i]}{word[i + 1:]} {r.choice('xy')}"]
    texts = [t for t in dict.fromkeys(" ".join(t.split()) for t in texts) if t]
    names = spark.createDataFrame([*enumerate(texts), (-1, ""), (-2, texts[0])], "name_id int, norm string")
    cands = spark.createDataFrame([(i, t, t) for i, t in enumerate([*texts, ""])], "candidate_id int, candidate string, cnorm string")
    got = sorted((r["name_id"], r["candidate_id"], r["score"]) for r in resolution.fuzzy_pairs(names, cands, cutoff).collect())
    scores = [(i, j, resolution.token_set_ratio(a, b)) for i, a in [*enumerate(texts), (-2, texts[0])] for j, b in enumerate(texts)]
    want = sorted(x for x in scores if x[2] >= cutoff)
    assert got == want
    assert any(not set(texts[i].split()) & set(texts[j].split()) for i, j, _ in want if i >= 0)


def test_misspelt_names_without_a_common_token_resolve(spark):
    aliases = resolution.alias_table(spark.createDataFrame([], "raw string, canonical string, seq int"))
    names = spark.createDataFrame([(1, "Nvidea"), (2, "InternationalBusinessMachine")], "name_id int, raw string")
    cands = spark.createDataFrame([(1, "Nvidia"), (2, "InternationalBusinessMachines")], "candidate_id int, candidate string")
    out = {r["name_id"]: (r["canonical"], r["method"], r["needs_review"]) for r in resolution.resolved(names, aliases, cands).collect()}
    assert out == {1: ("nvidea", "exact", True), 2: ("InternationalBusinessMachines", "fuzzy", False)}


def invented(seed, n):
    r = random.Random(seed)
    words = ["".join(r.choice("etaoinshrdlucmfwé") for _ in range(r.randint(2, 9))) for _ in range(n // 4)]
    names = [" ".join(r.choice(words) for _ in range(r.choice([1, 1, 2, 3]))) for _ in range(n)]

    def wrong(x):
        i = r.randrange(len(x))
        return r.choice([x[:i] + x[i + 1 :], x[:i] + r.choice("abc") + x[i:], x[:i] + r.choice("xyz ") + x[i + 1 :], " ".join(reversed(x.split()))])

    return names, [y for y in (" ".join(wrong(x).split()) for x in names) if y]


@pytest.mark.parametrize("strength", [1, 2, 3])
def test_misspellings_against_all_pairs_and_few_pairs_are_looked_at(spark, monkeypatch, strength):
    monkeypatch.setattr(fuzzy, "TWO", 1 if strength > 1 else 1 << 40)
    monkeypatch.setattr(fuzzy, "THREE", 1 if strength > 2 else 1 << 40)
    known, misspelt = invented(4, 2000)
    misspelt = sorted(set(misspelt))[:: 7 if strength == 2 else 40]
    names = spark.createDataFrame([(t,) for t in misspelt], "norm string")
    cands = spark.createDataFrame([(t,) for t in sorted(set(known))], "cnorm string")
    got = {(r["norm"], r["cnorm"]): r["score"] for r in fuzzy.close_texts(names, cands, 80.0).collect()}
    assert got == {(a, b): x for a in misspelt for b in set(known) if (x := resolution.token_set_ratio(a, b)) >= 80}
    looked = fuzzy.candidate_pairs(names.toDF("name"), cands.toDF("name"), 80.0).count()
    assert looked < 0.01 * len(misspelt) * cands.count()


def test_pairs_looked_at_grow_less_than_the_product(spark):
    looked = []
    for n in (500, 4000):
        known, misspelt = invented(5, n)
        sides = [spark.createDataFrame([(t,) for t in sorted(set(x))], "name string").repartition(4) for x in (misspelt, known)]
        looked.append(fuzzy.candidate_pairs(*sides, 80.0).count() / (sides[0].count() * sides[1].count()))
    assert looked[1] < looked[0] / 2


def test_hot_tokens_are_split_over_salts(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "SHARE", 3)
    names = [f"acme {i}" for i in range(30)] + ["acme", "zeta"]
    a = spark.createDataFrame([(t,) for t in names], "norm string")
    b = spark.createDataFrame([(t,) for t in names[::2]], "cnorm string")
    got = {(r["norm"], r["cnorm"]) for r in fuzzy.close_texts(a, b).collect()}
    assert got == {(x, y) for x in names for y in names[::2] if resolution.token_set_ratio(x, y) >= 80}
