"""Each operator against brute force, with nulls, empty and very long texts, ties, repeated rows, empty
tables and columns of clashing names."""

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

from millrace.llm import (  # noqa: E402
    chat_formatting, core, decontamination, language_id, lm_scoring, media_columns, ngram_jaccard, source_mixing,
    substring_dedup, toxicity, url_filter,
)

#: Columns that operators use for themselves.
CLASHING = "row string, block long, bucket int, answer string, size int, key string, id int, value string, words int, target double, n int, node long, class long, label long, range int, range2 int, spans string, items string, kept string, lang_pred string, score double, part int, kind string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghilmnoprstuvé") for _ in range(r.randint(1, 8))) for _ in range(n))


def some_docs() -> list[tuple]:
    r = random.Random(5)
    passage, long = prose(1, 60), prose(2, 40_000)
    texts = [prose(100 + i, r.randint(3, 120)) for i in range(40)]
    texts += [texts[0], texts[0], texts[1].upper(), texts[2] + " tail", long, long + " x", "a " * 80, "word", "two words", "word", None, None, "", "  \n\t ", "\u00a0 \u2003x\x85y", "né " * 36]
    texts += [f"{prose(200 + i, 30)} {passage} {prose(300 + i, 20)}" for i in range(4)]
    near = prose(7, 200).split(" ")
    for i in range(12):  # a chain of near copies
        near[(i * 17) % 200] = f"edit{i}"
        texts.append(" ".join(near))
    rows = [(i, t, ("en", "fr", None)[i % 3], ("a", "b", "B", None)[i % 4]) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[5], "en", "a"), (None, None, None, None), (-7, texts[4], "fr", "é")]
    return rows


def frame(spark, rows):
    extra = len(SCHEMA.split(",")) - 5
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *[None] * extra) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, some_docs()).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


PAIRS = [(r[0], r[1]) for r in some_docs()]


# ---------------------------------------------------------------- substring dedup
@pytest.mark.parametrize("window", [35, 5, 1])
def test_substring_dedup(docs, window):
    out = substring_dedup.remove_repeats(docs, window=window, block_bytes=2000)
    assert out.schema["row"].dataType.names == docs.columns
    same([tuple(r) for r in out.select("row.doc_id", "n_words", "n_removed", "kept").collect()], brute.without_repeats(PAIRS, window))


@pytest.mark.parametrize("window,size", [(35, 3000), (5, 1 << 20)])
def test_substring_dedup_that_keeps_the_first(docs, window, size):
    """What goes is repeated, and every word sequence of the window's length that was there before still is, somewhere,
    unless a longer repeat went across it."""
    out = [tuple(r) for r in substring_dedup.remove_repeats(docs, window=window, keep_first=True, block_bytes=size).select("row.doc_id", "row.text", "n_removed", "kept").collect()]
    every = {repr((i, t)): n for (i, t), (_, _, n, _) in zip(PAIRS, brute.without_repeats(PAIRS, window), strict=True)}
    assert all(n <= every[repr((i, t))] for i, t, n, _ in out)
    assert sum(n for *_, n, _ in out) < sum(every.values())
    passage = prose(1, 60)
    assert sum(passage in k for *_, k in out) == 1
    for i in (0, 1, 4):
        assert sum(k.encode() == b" ".join(brute.words(PAIRS[i][1])) for *_, k in out) == (1 if len(brute.words(PAIRS[i][1])) >= window else sum(t == PAIRS[i][1] for _, t in PAIRS))


def test_substring_dedup_empty(empty):
    assert substring_dedup.remove_repeats(empty).count() == 0


# ---------------------------------------------------------------- n-gram Jaccard join
def test_ngram_jaccard(docs):
    out = ngram_jaccard.similar_components(docs)
    same([tuple(r) for r in out.collect()], brute.components(PAIRS))


@pytest.mark.parametrize("size,num,den", [(1, 70, 100), (5, 80, 100)])
def test_ngram_jaccard_other_thresholds(docs, size, num, den):
    out = ngram_jaccard.similar_components(docs, size=size, numerator=num, denominator=den, cell_bits=14, fragments=3)
    same([tuple(r) for r in out.collect()], brute.components(PAIRS, size, num, den))


@pytest.mark.parametrize("hot,cell_bits", [(2, 21), (3, 14)])
def test_ngram_jaccard_with_split_buckets(docs, hot, cell_bits):
    out = ngram_jaccard.similar_components(docs, hot=hot, cell_bits=cell_bits, fragments=5)
    same([tuple(r) for r in out.collect()], brute.components(PAIRS))


def proposed(spark, rows, **how):
    """Results, and how many pairs each round proposed."""
    seen, real = [], ngram_jaccard._Join.verify
    ngram_jaccard._Join.verify = lambda self, pairs, name: (seen.append((name, pairs.count())), real(self, pairs, name))[1]
    try:
        return [tuple(r) for r in ngram_jaccard.similar_components(frame(spark, rows), **how).collect()], dict(seen)
    finally:
        ngram_jaccard._Join.verify = real


@pytest.mark.parametrize("shared", [91, 93, 94])
def test_documents_that_share_a_common_text_and_stay_apart_propose_no_square(spark, shared):
    """200 documents of 102 words share most n-grams, which all fall into their prefixes' reach, and none is similar."""
    core, m = prose(11, shared), 200
    rows = [(i, f"{prose(5000 + i, 102 - shared)} {core}", None, None) for i in range(m)]
    got, pairs = proposed(spark, rows, hot=16)
    same(got, brute.components([(r[0], r[1]) for r in rows]))
    assert len({r[2] for r in got}) == m
    assert pairs.get("star", 0) <= m and pairs.get("rest", 0) <= m


def test_two_groups_behind_one_common_ngram(spark):
    """Members of the second group are not like the hub, only like each other: the second round finds them."""
    clause, one, two = prose(21, 12), prose(22, 90), prose(23, 90)
    rows = [(i, f"{clause} {one if i % 2 else two} tail{i}", None, None) for i in range(60)]
    got, pairs = proposed(spark, rows, hot=8)
    same(got, brute.components([(r[0], r[1]) for r in rows]))
    assert len({r[2] for r in got}) == 2 and pairs["star"] <= 6 * 60


def test_order_is_cut_into_fragments_of_equal_weight():
    import numpy as np

    cells = np.array([5, 0, 1, 100, 1, 7, 3, 11], np.uint32)
    order = ngram_jaccard.Order(cells, 3, 16)
    by = np.lexsort((np.arange(8), cells))
    assert (np.diff(order.fragment[by].astype(int)) >= 0).all() and order.fragment[by][0] == 0
    grams = (np.arange(8, dtype=np.uint64) << np.uint64(61)) + np.uint64(9)
    assert (np.diff(order.fragment[order.cell(grams[order.sort(grams, np.zeros(8, int))])].astype(int)) >= 0).all()
    even = ngram_jaccard.Order(np.full(1 << 10, 4, np.uint32), 10, 16)
    assert set(np.bincount(even.fragment)) == {8}


def test_ngram_jaccard_empty(empty):
    assert ngram_jaccard.similar_components(empty).count() == 0


def test_ngram_jaccard_group_of_near_copies_is_not_expanded(spark):
    base = prose(9, 300).split(" ")
    rows = []
    for i in range(120):
        w = list(base)
        w[i * 2] = f"own{i}"
        w[(i * 7) % 300] = f"more{i}"
        rows.append((i, " ".join(w), None, None))
    got = ngram_jaccard.similar_components(frame(spark, rows)).collect()
    assert {r["component_id"] for r in got} == {0}


# ---------------------------------------------------------------- decontamination
ITEMS = [(1, prose(1, 60)), (2, "two words"), (10, prose(500, 12)), (3, None), (4, "?!"), (2, prose(102, 9)), (None, prose(102, 3)), (5, "né né né")]


@pytest.mark.parametrize("limit", [decontamination.AUTOMATON_WORDS, 40, 15])
def test_decontamination(spark, docs, limit):
    """One automaton, or several passes with items cut into pieces."""
    items = spark.createDataFrame([(*x, 0) for x in ITEMS], "item_id long, text string, row int")
    out = decontamination.digest(decontamination.find_leaks(docs, items, limit=limit))
    same([tuple(r) for r in out.collect()], brute.leaks(PAIRS, ITEMS))


def test_decontamination_query(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(*x, 0) for x in ITEMS], "item_id long, text string, row int").write.parquet(f"{tmp_path}/benchmark.parquet")
    same([tuple(r) for r in decontamination.op1_decontamination(spark, str(tmp_path)).collect()], brute.leaks(PAIRS, ITEMS))


def test_an_automaton_holds_no_more_words_than_allowed(spark):
    items = spark.createDataFrame([(1, prose(1, 500)), (2, prose(2, 30))], "item_id long, text string").coalesce(1)
    sizes = []
    real = decontamination.Automaton
    pieces = items.selectExpr("string(item_id) as item", "text").mapInArrow(decontamination._pieces(10, 60), "item string, words array<long>")
    for held in decontamination._passes(pieces, 60):
        sizes.append(sum(len(w) for _, w in held))
        assert sum(len(k) for k in real(held).automaton) <= 10 * sizes[-1]
    assert max(sizes) <= 60 and len(sizes) >= 9


def test_decontamination_spans_point_into_the_original(spark):
    docs = frame(spark, [(1, "Où?  Two,\nWORDS — and two words", None, None)])
    items = spark.createDataFrame([(2, "two words")], "item_id long, text string")
    (row,) = decontamination.find_leaks(docs, items).collect()
    raw = row["row"]["text"].encode()
    assert [raw[s["start"] : s["end"]].decode() for s in row["spans"]] == ["Two,\nWORDS", "two words"]


def test_decontamination_empty(spark, docs, empty):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_leaks(docs, items).where(F.size("items") > 0).count() == 0
    assert decontamination.find_leaks(empty, items).count() == 0


# ---------------------------------------------------------------- URL rules
URLS = [None, "", "no scheme", "http://Example.ORG/es/x?q#f", "https://a.b.example.org/en/1", "https://example.org", "ftp://org/", "http://x.org/", "://com/fr/a",
        "http://example.com/de/", "http://a.com/fr/?/de/", "http://examplexorg/es/", "http://.org/es/", "http://org./es/", "http://example.org:80/es/", "a://b://example.org/es/", "http://com/de", "http://é.com/fr/é"]


def judged(url, rules):
    import re

    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [r for r in rules if (not r[1] or host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else "allow"


@pytest.mark.parametrize("rules", [url_filter.RULES, [*url_filter.RULES, ("block", "a.b.example.org", "/en/"), ("allow", "example.org", "/en/10"), ("block", "com", "/"), ("block", "org", "/")], [("block", "", "/e"), ("allow", "", ""), ("block", "org", "/es/")], []])
def test_url_filter(spark, rules):
    rows = [(i, u, "x") for i, u in enumerate(URLS * 30)] + [(3, URLS[3], "x"), (None, URLS[4], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = [tuple(r) for r in url_filter.judge(pages, rules).collect()]
    same(got, [(i, *judged(u, rules)) for i, u, _ in rows])


def test_url_query(spark, tmp_path):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] * 2 + [(i, "http://hot.example.org/es/1", "x") for i in range(400)] + [(None, "http://x.org/" + "long" * 100_000, "x")]
    spark.createDataFrame(rows, "page_id long, url string, path string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in url_filter.op2_url_filter(spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect()]
    same(got, [(i, *judged(u, url_filter.RULES)) for i, u, _ in rows])


def test_url_filter_empty(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


# ---------------------------------------------------------------- toxicity
def test_toxicity_finds_planted_words_and_reads_no_clean_labels(spark):
    r = random.Random(3)
    rows = [(i, prose(1000 + i, 60) + (f" {r.choice(['vile', 'awful'])}, x" if i % 8 == 0 else "")) for i in range(600)]
    docs = spark.createDataFrame([*rows, (None, None), (601, None), (602, ""), (603, "vile " * 20_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(400)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    got = {x["doc_id"]: x["score"] for x in toxicity.score(docs, model).collect()}
    toxic, clean = [got[i] for i in range(400, 600) if i % 8 == 0], [got[i] for i in range(400, 600) if i % 8]
    assert min(toxic) > 0.5 > sorted(clean)[int(0.98 * len(clean))]
    assert 0 <= got[601] == got[602] <= 1
    flipped = labels.where("toxic = 1 or doc_id % 3 = 0")  # fewer clean labels change the prior alone
    other = {x["doc_id"]: x["score"] for x in toxicity.score(docs, toxicity.learn(docs, flipped)).collect()}
    assert min(other[i] for i in range(400, 600) if i % 8 == 0) > max(sorted(other[i] for i in range(400, 600) if i % 8)[:-4])


def plain_features(text):
    """Word by word, without the slices."""
    import numpy as np
    import pyarrow as pa

    out = set()
    for w in brute.ALNUM.findall((text or "").encode().lower()):
        (s,) = core.slices(pa.array([w], pa.binary()).cast(pa.string(), safe=False))
        out |= set(toxicity.features(s)[0].tolist())
    return np.array(sorted(out), np.int64)


def test_toxicity_query_against_plain_arithmetic(spark, tmp_path):
    """The registered query: its split, its sample, the features of each document one by one, the sum of weights."""
    import numpy as np

    r = random.Random(8)
    rows = [(i, prose(3000 + i, 25) + (" vilelylong" + r.choice("abc") + " bad" if i % 6 == 0 else "")) for i in range(180)]
    docs = [*rows, (180, None), (181, ""), (182, "?!"), (None, "vilelylonga"), (3, rows[3][1]), (183, "vilelylongd " * 50)]
    labels = [(i, int(i % 6 == 0)) for i in range(170)] + [(1, None), (None, 1), (1, 0)]
    spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string").write.parquet(f"{tmp_path}/documents.parquet")
    seen, real = {}, toxicity.fit
    toxicity.fit = lambda pos, unl, prior, **k: seen.setdefault("m", (pos, unl, prior, real(pos, unl, prior, **k)))[3]
    try:
        got = []
        for name in ("one", "two"):
            flip = [(i, t if t is None or not brute.held_out(i, 5, 0) else 1 - t) for i, t in labels] if name == "two" else labels
            spark.createDataFrame(flip, "doc_id long, toxic int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
            got.append(sorted(map(repr, toxicity.op4_toxicity(spark, str(tmp_path)).collect())))
        rows_out = toxicity.op4_toxicity(spark, str(tmp_path)).collect()
    finally:
        toxicity.fit = real
    assert got[0] == got[1]  # held-out labels are not read
    pos, unl, prior, model = seen["m"]
    train = {i: t for i, t in labels if i is not None and t is not None and not brute.held_out(i, 5, 0)}
    texts = dict(d for d in docs if d[0] is not None)
    share = sum(train.values()) / len(train)
    assert prior == pytest.approx(share + 2 * (share * (1 - share) / len(train)) ** 0.5)
    held, shown = np.zeros(toxicity.FEATURES), np.zeros(toxicity.FEATURES)
    for i, t in train.items():
        f = plain_features(texts[i])
        shown[f] += 1
        held[f] += t
    names = toxicity.telling(held, shown, sum(train.values()), len(train))
    assert [x.tolist() for x in unl] == [np.intersect1d(plain_features(texts[i]), names).tolist() for i in sorted(train)]
    assert len(pos) == sum(train.values())
    want = []
    for i, text in docs:
        score = 1 / (1 + np.exp(-(model.bias + model.weights[plain_features(text)].sum())))
        want.append((i, brute.held_out(i, 5, 0), round(float(score), 9), int(score >= 0.5)))
    same([(x["doc_id"], x["held_out"], round(x["score"], 9), x["predicted"]) for x in rows_out], want)
    assert all(x["predicted"] == 1 for x in rows_out if x["doc_id"] == 183 or x["doc_id"] in range(0, 180, 6))


def test_toxicity_steps_against_the_risk():
    """The gradient against differences of the risk where the clean part is positive; where it is not, it is that part's."""
    import numpy as np

    r = np.random.default_rng(2)
    sides = [(r.integers(0, 6, 40), np.sort(r.integers(0, 10, 40)), 10), (r.integers(0, 6, 90), np.sort(r.integers(0, 30, 90)), 30)]
    w, e = r.normal(size=7) * 0.1, 1e-6
    _, g = toxicity.risk(w, sides, 0.2)
    for k in range(7):
        up, down = w.copy(), w.copy()
        up[k], down[k] = up[k] + e, down[k] - e
        assert g[k] == pytest.approx((toxicity.risk(up, sides, 0.2)[0] - toxicity.risk(down, sides, 0.2)[0]) / (2 * e), abs=1e-6)
    low = np.append(np.zeros(6), -9.0)
    assert toxicity.risk(low, [sides[0], sides[0]], 0.99)[0] > 0
    flat = toxicity.risk(np.append(np.zeros(6), 3.0), [sides[0], (sides[1][0], sides[1][1], 30)], 0.9999)
    assert np.isfinite(flat[1]).all()


def test_toxicity_without_examples(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for d in (docs, empty):
        rows = toxicity.score(d.select("doc_id", "text"), toxicity.learn(d.select("doc_id", "text"), none)).collect()
        assert len(rows) == d.count() and all(0 <= r["score"] <= 1 for r in rows)


# ---------------------------------------------------------------- mixing
def test_mixing(docs):
    out = [r.asDict(True) for r in source_mixing.mix(docs).collect()]
    size, target = brute.mixed_sizes([(r[3], len(brute.words(r[1]))) for r in some_docs()])
    taken = dict.fromkeys(size, 0)
    for r in out:
        s = r["row"]["source"]
        assert r["size"] == len(brute.words(r["row"]["text"])) and r["source_size"] == size[s]
        assert r["target"] == pytest.approx(target[s]) and r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert len(out) == len(some_docs())
    assert all(abs(taken[s] - target[s]) <= 1 for s in size)


def test_mixing_again_and_dealt_otherwise(docs):
    one, two = (sorted(repr((r["row"]["doc_id"], r["size"], r["taken"])) for r in source_mixing.mix(d).collect()) for d in (docs, docs.repartition(7)))
    assert one == two


def test_mixing_empty(empty, spark):
    assert source_mixing.mix(empty).count() == 0
    (row,) = source_mixing.mix(frame(spark, [(1, None, None, None)])).collect()
    assert (row["size"], row["target"], row["taken"]) == (0, 0.0, 0)


# ---------------------------------------------------------------- chat formatting
TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", "héllo"), (1, 2, "user", "more"), (1, 3, "assistant", "yes"), (2, 0, "user", "hi"), (3, 0, None, None),
         (4, 0, "system", ""), (4, 1, "user", "x" * 200_000), (5, 0, "user", "t"), (5, 0, "user", "t"), (None, 0, "user", "lost"), (7, None, "user", "n")]


def rendered(turns):
    text = "".join(f"<|{r}|>\n{t}<|end|>\n" for _, r, t in turns)
    runs = ",".join(f"{len(r) + 5}:0,{len(t) + 8}:1" if r == "assistant" else f"{len(r) + 5 + len(t) + 8}:0" for _, r, t in turns)
    return text, runs


def paired(rows):
    sides = {}
    for pair, side, *turn in rows:
        if pair is not None and side is not None:
            sides.setdefault(pair, ([], []))[0 if side else 1].append((turn[0], turn[1] or "", turn[2] or ""))
    out = []
    for pair, (c, r) in sides.items():
        for x in (c, r):
            x.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        n = next((i for i, (a, b) in enumerate(zip(c, r)) if a[1:] != b[1:]), min(len(c), len(r)))
        out.append((pair, n, rendered(c[:n])[0], *(rendered(c[n:]) if c else (None, None)), *(rendered(r[n:]) if r else (None, None))))
    return out


def test_chat_formatting(spark):
    other = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "user", "hi"), (2, 1, "user", "on"), (3, 0, "", ""), (4, 0, "system", ""), (8, 0, "user", "only")]
    rows = [(p, True, *t) for p, *t in TURNS] + [(p, False, *t) for p, *t in other] + [(1, None, 0, "user", "x")]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv long, side boolean, turn long, role string, text string, c string")
    out = chat_formatting.preference_pairs(turns, F.col("conv"), F.col("side"))
    same([tuple(r) for r in out.collect()], paired(rows))
    for r in out.collect():
        for text, mask in ((r["chosen"], r["chosen_mask"]), (r["rejected"], r["rejected_mask"])):
            assert text is None or sum(int(x.split(":")[0]) for x in mask.split(",") if x) == len(text)


def conversations(spark, path, rows):
    spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, c string").write.parquet(f"{path}/conversations.parquet")
    return chat_formatting.op6_chat_formatting(spark, str(path))


def with_endings(rows):
    own = {}
    for i, *turn in rows:
        if i is not None:
            own.setdefault(i, []).append((turn[0], turn[1] or "", turn[2] or ""))
    for x in own.values():
        x.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    out = []
    for i, c in own.items():
        r = [*c[:-1], (*c[-1][:2], own[i + 1][-1][2] if i + 1 in own else "")]
        n = next((k for k, (a, b) in enumerate(zip(c, r)) if a[1:] != b[1:]), len(c))
        out.append((i, n, rendered(c[:n])[0], *rendered(c[n:]), *rendered(r[n:])))
    return out


def test_chat_query_loses_no_turn(spark, tmp_path):
    """Null, tied and repeated turns stay on both sides; only the very last turn's text is another."""
    rows = [*TURNS, (20, None, "system", "s"), (20, 0, "user", "q"), (20, 1, "assistant", "A"), (20, 1, "assistant", "B"), (21, 0, "user", "t"), (21, 0, "user", "t"), (22, 0, "user", "t")]
    out = conversations(spark, tmp_path, rows)
    got = {r["pair_id"]: r for r in out.collect()}
    same([tuple(r) for r in got.values()], with_endings(rows))
    assert got[20]["n_prefix"] == 3 and got[20]["prompt"].count("<|end|>") == 3 and (got[20]["chosen"].count("<|end|>"), got[20]["rejected"].count("<|end|>")) == (1, 1)
    assert got[21]["n_prefix"] == 2 and got[21]["chosen"] == got[21]["rejected"] == ""
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()


def test_chat_query_and_its_sql_agree_on_odd_turns(spark, tmp_path):
    import duckdb

    rows = [t for t in TURNS if t[0] != 4] + [(20, None, None, "s"), (20, 1, "assistant", "A"), (20, 1, "assistant", "B"), (21, 0, "user", None), (21, 0, "user", None)]
    out = conversations(spark, tmp_path, rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    found = con.execute(chat_formatting.ORACLE)
    names = [c[0] for c in found.description]
    same([tuple(r) for r in out.select(*names).collect()], found.fetchall())


def test_chat_formatting_empty_and_native(spark, tmp_path):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = chat_formatting.preference_pairs(none, F.col("conv_id"), F.lit(True))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()
    assert conversations(spark, tmp_path, []).count() == 0


# ---------------------------------------------------------------- LM scoring
def test_lm_scoring_counts_and_base(docs):
    def learn(i):
        return not brute.held_out(i, 7, 2)

    out = lm_scoring.score_documents(docs, core.split_mod(F.col("doc_id"), 7) != 2, block_bytes=2000).collect()
    want = brute.base_scores(PAIRS, learn)
    same([(r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in out], [(*w[:5], round(w[5], 6)) for w in want])
    assert all(r["score"] < 0 for r in out)


def test_lm_scoring_is_the_stated_mixture(spark):
    """One document: with the weights the same model learns, the score is the sum of the mixture's logs."""
    import math

    rows = [(i, f"a b a c w{i % 5}") for i in range(64)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = {}
    real = lm_scoring.learn_weights
    lm_scoring.learn_weights = lambda *a, **k: seen.setdefault("w", real(*a, **k))
    try:
        got = {r["doc_id"]: r["score"] for r in lm_scoring.score_documents(df, F.lit(True), block_bytes=50).collect()}
    finally:
        lm_scoring.learn_weights = real
    toks = [[*t.split(), "</s>"] for _, t in rows]
    c, pairs, ctx = {}, {}, {}
    for t in toks:
        for a, b in zip(["<s>", *t[:-1]], t):
            c[b] = c.get(b, 0) + 1
            pairs[a, b] = pairs.get((a, b), 0) + 1
            ctx[a] = ctx.get(a, 0) + 1
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(toks):
        total = 0.0
        for a, b in zip(["<s>", *t[:-1]], t):
            w = seen["w"][min(int(math.log2(ctx[a] + 1)), lm_scoring.CONTEXTS - 1)]
            total += math.log10(w[0] * pairs[a, b] / ctx[a] + w[1] * c[b] / n + w[2] / (v + 1))
        assert got[i] == pytest.approx(total, abs=1e-9)


def test_learned_weights_raise_the_likelihood():
    import numpy as np

    b, p, s, n = np.array([3, 3, 3]), np.array([0.5, 0.0, 0.0]), np.array([0.01, 0.2, 0.0]), np.array([60, 30, 10])
    w = lm_scoring.learn_weights(b, p, s, n, 1e-3)[3]

    def log(w):
        return (n * np.log(w[0] * p + w[1] * s + w[2] * 1e-3)).sum()

    assert w.sum() == pytest.approx(1) and log(w) > log(np.full(3, 1 / 3))


def test_lm_scoring_without_training_or_rows(docs, empty):
    assert lm_scoring.score_documents(empty, F.lit(True)).count() == 0
    out = lm_scoring.score_documents(docs, F.lit(False)).collect()
    assert len(out) == len(PAIRS) and all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in out)


# ---------------------------------------------------------------- language ID
def test_language_id(spark):
    r = random.Random(1)
    kinds = {"aa": "abcde", "bb": "edzyx", "cc": "éèàùß"}
    make = lambda k, n: " ".join("".join(r.choice(kinds[k]) for _ in range(4)) for _ in range(n))
    rows = [(i, make(k, 30), k) for i in range(90) for k in [list(kinds)[i % 3]]]
    odd = [(100, None, "aa"), (101, "", "aa"), (102, "12 34 !?", "bb"), (103, "abcd", None), (104, make("bb", 300_000), "bb"), (None, "éèàù", "cc"), (105, "𐐀𐐁", None)]
    docs = frame(spark, [(*x, "s") for x in rows + odd])
    out = language_id.identify(docs, *language_id.learn_prototypes(docs.where("doc_id < 60"))).collect()
    got = {r["row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in out}
    assert len(out) == len(rows) + len(odd)
    assert all(got[i][0] == k for i, _, k in rows)
    assert [got[i] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert got[104][0] == "bb" and got[None][0] == "cc" and got[103][0] == "aa" and got[105][0] != "und"
    assert all(0 <= s <= 1 for _, s in got.values())


def test_language_id_empty(empty, docs):
    langs, prototypes = language_id.learn_prototypes(empty)
    assert langs == [] and language_id.identify(empty, langs, prototypes).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, langs, prototypes).collect()} == {"und"}


def plain_grams(text):
    """N-grams of one text, letter by letter."""
    alphabet = language_id._alphabet()
    codes = [26]
    for ch in [*(text or ""), " "]:
        code = int(alphabet[ord(ch)]) if ord(ch) < 65536 else language_id._hashed(ord(ch)) if ch.isalpha() else 26
        if code != 26 or codes[-1] != 26:
            codes.append(code)
    return [tuple(codes[i : i + 3]) for i in range(len(codes) - 2)]


def plain_vector(text):
    import numpy as np

    places = language_id.Space.get().places
    total = np.zeros(language_id.DIMENSIONS)
    for x, y, z in plain_grams(text):
        total += places[0][x].astype(int) * places[1][y] * places[2][z]
    return total


ODD_TEXTS = ["abab", "", "a", " a", "a ", "12 34", "né né é", "\U00010400\U00010401x", None, "x" * 50, "Où-\u00a0là?", "  \n", prose(77, 300)]


def test_vectors_are_sums_of_bound_letters():
    import numpy as np
    import pyarrow as pa

    s = language_id.Space.get()
    (one,) = core.slices(pa.array(ODD_TEXTS, pa.string()))
    got = s.texts(one)
    for v, text in zip(got, ODD_TEXTS, strict=True):
        assert np.array_equal(v, plain_vector(text)), text
    for piece in (4, 5, 7, 64):
        for text in ODD_TEXTS:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            counts = s.counts_of_long(raw, piece)
            assert counts.sum() == len(plain_grams(text)), (piece, text)
            keys = np.flatnonzero(counts)
            assert np.array_equal(s.bundle(keys, counts[keys]), plain_vector(text))


def test_long_text_with_one_letter_is_no_other_than_a_short_one(spark):
    docs = frame(spark, [(1, " " * 1_048_576 + "a", "en", None), (2, " " * 10 + "a", "en", None), (3, "a" + "7" * 2_000_000, "en", None), (4, prose(1, 9), "en", None), (5, "éé", "fr", None)])
    got = {r["row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs, *language_id.learn_prototypes(docs)).collect()}
    assert got[1] == got[2] == got[3] and got[1][0] == "en"


def test_language_query_against_plain_arithmetic(spark, tmp_path):
    """The registered query: prototypes from the training part alone, centred cosine, largest wins."""
    import numpy as np

    rows = [(d[0], d[1], d[2]) for d in some_docs()] + [(1000 + i, t, "xx" if i % 2 else None) for i, t in enumerate(ODD_TEXTS)]
    frame(spark, [(*r, None) for r in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    vectors = [plain_vector(t) for _, t, _ in rows]
    sums = {}
    for (i, t, lang), v in zip(rows, vectors, strict=True):
        if t is not None and lang is not None and not brute.held_out(i, 3, 1) and v.any():
            sums[lang] = sums.get(lang, 0) + v
    langs = sorted(sums)
    unit = {k: v / np.linalg.norm(v) for k, v in sums.items()}
    middle = sum(unit.values()) / len(unit)
    want = []
    for (i, _, _), v in zip(rows, vectors, strict=True):
        best, score = "und", 0.0
        if v.any():
            u = v / np.linalg.norm(v) - middle
            cosines = [float(u @ (unit[k] - middle) / np.linalg.norm(u) / np.linalg.norm(unit[k] - middle)) for k in langs]
            best, score = langs[int(np.argmax(np.round(cosines, 12)))], (1 + max(cosines)) / 2
        want.append((i, brute.held_out(i, 3, 1), best, round(score, 6)))
    got = language_id.op9_language_id(spark, str(tmp_path)).collect()
    same([(r["doc_id"], r["held_out"], r["lang_pred"], round(r["score"], 6)) for r in got], want)


def test_language_column_that_is_none(spark):
    docs = spark.createDataFrame([(i, "abc", f"l{i}") for i in range(9)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        language_id.learn_prototypes(docs, most=8)


# ---------------------------------------------------------------- media columns
def test_media_round_trip(spark, docs):
    rows = docs.select("doc_id", "text", media_columns.payload_of(F.col("text")).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    store = media_columns.store(rows.select("digest", "payload"))
    known = {r["digest"]: r for r in media_columns.measured(store).collect()}
    stored = {r["digest"]: r["media"] for r in store.collect()}
    for _, text in PAIRS:
        _, p = brute.payload(text)
        r = known[hashlib.sha256(p).hexdigest()]
        media = bytes(stored[r["digest"]])
        assert media_columns.from_png(media).tobytes() == p
        assert (r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(p), r["digest"], zlib.crc32(p[-16:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())


def test_media_damage_is_seen():
    media = bytearray(media_columns.to_png(b"x" * 192))
    media[45] ^= 1
    with pytest.raises(ValueError):
        media_columns.from_png(bytes(media))


def test_media_sequences_stay_aligned(spark):
    one, two = "a" * 64, "b" * 64
    html = f'<p>One &amp; <b>more</b></p><figure><img src="x/sha256:{one}.png" alt="alt"><figcaption>Cap</figcaption></figure><script>no()</script>tail<img src="plain.png" title="t"><img src="sha256:{two}">'
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "just text")], "page long, html string")
    store = spark.createDataFrame([(one, b"1")], "digest string, media binary")
    out = media_columns.assembled(media_columns.resolve(media_columns.sequences(pages, "page", "html"), store), "media")
    got = {r["key"]: [(p["position"], p["kind"], p["text"], p["caption"], p["media"] and bytes(p["media"])) for p in r["parts"]] for r in out.collect()}
    assert got == {
        1: [(0, "text", "One & more", None, None), (1, "media", None, "Cap", b"1"), (2, "text", "tail", None, None), (3, "media", None, "t", None), (4, "media", None, None, None)],
        4: [(0, "text", "just text", None, None)],
    }


def test_media_empty(spark, tmp_path, empty):
    path = str(tmp_path)
    empty.write.parquet(f"{path}/documents.parquet")
    assert media_columns.op10_media_columns(spark, path).count() == 0


# ---------------------------------------------------------------- components
@pytest.mark.parametrize("share", [256, 3])
def test_components_of_hubs_and_paths(spark, monkeypatch, share):
    from millrace.llm import components

    monkeypatch.setattr(components, "SHARE", share)
    r = random.Random(6)
    edges = [(500, i) for i in range(100, 160)] + [(i, i + 1) for i in range(1000, 1040)] + [(r.randint(0, 90), r.randint(0, 90)) for _ in range(60)] + [(None, 3), (7, 7), (160, 100)] * 2
    up = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {x["node"]: x["label"] for x in got} == {x: top(x) for x in up} and len(got) == len(up)
