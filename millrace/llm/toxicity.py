"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents count as positive.  Unlabelled text is that of every labelled document whose label
is left unread: a mixture that holds the toxic ones in their natural share.  With the class prior ``p`` the risk of a
linear classifier is ``p * E_pos[loss(+)] + max(0, E_unl[loss(-)] - p * E_pos[loss(-)])``: the second part estimates
the risk on the clean documents and is kept from falling below zero, where it would only fit noise.  The prior is the
toxic share of all labels, raised by two standard errors: too low a prior calls toxic text clean, too high a one is
what the second part is made for.

The model is a numpy logistic one over hashed words and beginnings of words.  It is fitted at the driver on a sample
of labelled documents, ``POSITIVES`` toxic ones and ``UNLABELLED`` of all, those with the smallest hashes of their ids,
whole texts.  Their features are made and counted by the executors; the driver gets how many hold each feature, and of
each document those of the ``LARGEST`` features that tell most.  Scoring reads every document once and moves nothing.

Defined results: null and wordless texts get the score of a document without words; labels that are null
are no labels; an id that is labelled twice is toxic if any label says so; of labelled rows that repeat an id one is
learned from; without confirmed examples every score is the class prior; repeated rows are scored alike; columns other
than id, text and label are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .core import ALNUM, U64, discard, mix, slices, split_mod, stored, word_hashes, word_spans

#: Largest training sample, in labelled documents.
POSITIVES, UNLABELLED = 3000, 9000
FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
#: Bytes of a beginning; words that are no longer have none.
BEGINNING = 6
#: A feature is used if so many sampled positives have it, if its rates among positives and unlabelled documents differ
#: by so many standard errors, and if it is among so many that differ most.
LEAST_DOCUMENTS, ERRORS, LARGEST = 3, 3.0, 4096
ROUNDS, RATE, DECAY = 1000, 0.05, 1e-4


def features(s) -> tuple[np.ndarray, np.ndarray]:
    """Hashed distinct words and beginnings of each document, and where each document's begin."""
    starts, ends, first = word_spans(s.data, s.offsets, ALNUM)
    owner = np.repeat(np.arange(len(s)), np.diff(first))
    long = ends - starts > BEGINNING
    whole = word_hashes(s.data, starts, ends, ALNUM)
    begins = mix(word_hashes(s.data, starts[long], starts[long] + BEGINNING, ALNUM) ^ U64(0x6A09E667F3BCC909))
    key = np.concatenate([owner, owner[long]]) << FEATURE_BITS | (np.concatenate([whole, begins]) >> U64(64 - FEATURE_BITS)).astype(np.int64)
    key = np.unique(key)
    return key & (FEATURES - 1), np.searchsorted(key, np.arange(len(s) + 1) << FEATURE_BITS)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in slices(batch.column("text")):
            words, begin = features(s)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").slice(s.row, len(s)),
                "words": pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(words.astype(np.int32))),
            })


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many positive and how many unlabelled documents of a task have each feature."""
    counts = np.zeros((2, FEATURES), np.int64)
    for batch in batches:
        words = batch.column("words")
        own = words.flatten().to_numpy()
        size = np.diff(words.offsets.to_numpy())
        for row, side in enumerate(("pos", "unl")):
            counts[row] += np.bincount(own[np.repeat(batch.column(side).to_numpy(zero_copy_only=False), size)], minlength=FEATURES)
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.record_batch({"word": pa.array(used), "pos": pa.array(counts[0, used]), "unl": pa.array(counts[1, used])})


def _of(names: np.ndarray):
    """The features of each document that are among ``names``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            own = words.flatten().to_numpy()
            use = np.isin(own, names)
            ends = np.concatenate([[0], np.cumsum(use)])[np.concatenate([[0], np.cumsum(np.diff(words.offsets.to_numpy()))])]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "words": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(own[use])),
                "pos": batch.column("pos"), "unl": batch.column("unl"),
            })

    return run


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, words: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Each document's weights are added up by themselves and in order: equal texts have equal scores."""
        size = np.diff(begin)
        total = np.bincount(np.repeat(np.arange(len(size)), size), weights=self.weights[words], minlength=len(size))
        return 1 / (1 + np.exp(-np.clip(self.bias + total, -40, 40)))


def telling(held: np.ndarray, seen: np.ndarray, n_positive: int, n_unlabelled: int) -> np.ndarray:
    """Features worth a weight, ascending, by how many positives hold and how many unlabelled documents show each."""
    both = (held + seen + 1) / (n_positive + n_unlabelled + 2)
    error = np.sqrt(both * (1 - both) * (1 / n_positive + 1 / n_unlabelled))
    apart = np.abs(held / n_positive - seen / n_unlabelled) / error
    use = np.flatnonzero((held >= min(LEAST_DOCUMENTS, n_positive)) & (apart >= ERRORS))
    return np.sort(use[np.lexsort((use, -apart[use]))[:LARGEST]])


def risk(w: np.ndarray, sides, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative risk of weights (the bias last) without decay, and the direction to step against.  A side is
    (feature of each entry, document of each entry, documents)."""

    def margin(side):
        idx, owner, n = side
        return np.bincount(owner, weights=w[idx], minlength=n) + w[-1]

    def gradient(side, each):
        idx, owner, _ = side
        return np.append(np.bincount(idx, weights=each[owner], minlength=len(w) - 1), each.sum())

    zp, zu = margin(sides[0]), margin(sides[1])
    sp, su = 1 / (1 + np.exp(-np.clip(zp, -40, 40))), 1 / (1 + np.exp(-np.clip(zu, -40, 40)))
    clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    # The part that estimates the clean documents' risk: where it is negative, only it is stepped back from.
    rest = gradient(sides[1], su / len(su)) - prior * gradient(sides[0], sp / len(sp))
    toxic = prior * np.logaddexp(0, -zp).mean()
    return toxic + max(0.0, clean), prior * gradient(sides[0], (sp - 1) / len(sp)) + rest if clean >= 0 else -rest


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = ROUNDS) -> Model:
    """Minimises the non-negative risk over features of whole documents with Adam."""
    prior = float(np.clip(prior, 1e-4, 1 - 1e-4))
    model = Model(np.zeros(FEATURES), float(np.log(prior / (1 - prior))))
    if not positive or not unlabelled:
        return model
    names = np.unique(np.concatenate([*positive, *unlabelled]))
    sides = [(np.searchsorted(names, np.concatenate(x)), np.repeat(np.arange(len(x)), [len(d) for d in x]), len(x)) for x in (positive, unlabelled)]
    w = np.zeros(len(names) + 1)
    w[-1] = model.bias
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        _, g = risk(w, sides, prior)
        g[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    model.weights[names] = w[:-1]
    model.bias = float(w[-1])
    return model


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) that may be learned from."""
    spark = docs.sparkSession
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") > 0).cast("long")), F.lit(0))).first()
    share = toxic / n if n else 0.5
    prior = share + 2 * (share * (1 - share) / n) ** 0.5 if n else share
    by_hash = [F.xxhash64("doc_id", F.lit(17)), F.col("doc_id")]
    pos_ids = {r[0] for r in known.where("toxic > 0").select("doc_id").orderBy(*by_hash).limit(positives).collect()}
    unl_ids = {r[0] for r in known.select("doc_id").orderBy(*by_hash).limit(unlabelled).collect()}
    if not pos_ids:
        return fit([], [], prior)
    wanted = spark.createDataFrame([(i, i in pos_ids, i in unl_ids) for i in sorted(pos_ids | unl_ids)], "doc_id long, pos boolean, unl boolean")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(wanted.select("doc_id")), "doc_id")
    words = rows.mapInArrow(_featurise, "doc_id long, words array<int>").groupBy("doc_id").agg(F.min("words").alias("words"))
    words = stored(words.join(F.broadcast(wanted), "doc_id"), "sample")
    flags = [F.col(c).cast("long") for c in ("pos", "unl")]
    n_pos, n_unl = words.agg(*[F.coalesce(F.sum(f), F.lit(0)) for f in flags]).first()
    counts = words.select("words", "pos", "unl").mapInArrow(_counted, "word long, pos long, unl long").groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("unl").alias("unl")).toPandas()
    held, seen = np.zeros(FEATURES), np.zeros(FEATURES)
    held[counts["word"]], seen[counts["word"]] = counts["pos"], counts["unl"]
    names = telling(held, seen, n_pos, n_unl) if n_pos and n_unl else np.zeros(0, np.int64)
    pos, unl = [], []
    for r in words.select("doc_id", "words", "pos", "unl").mapInArrow(_of(names), "doc_id long, words array<int>, pos boolean, unl boolean").orderBy("doc_id").toLocalIterator():
        for side, there in ((pos, r["pos"]), (unl, r["unl"])):
            if there:
                side.append(np.array(r["words"], np.int64))
    discard(words)
    return fit(pos, unl, prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column("text")):
                yield pa.record_batch({"doc_id": batch.column("doc_id").slice(s.row, len(s)), "score": pa.array(shared.value.score(*features(s)))})

    return docs.mapInArrow(run, "doc_id long, score double")


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = split_mod(F.col("doc_id"), 5) == 0
    model = learn(docs.where(~held_out), labels.where(~held_out))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
