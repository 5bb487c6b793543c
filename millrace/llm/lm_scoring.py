"""Language-model scores by deleted interpolation.

A token's probability mixes three estimates: how often it followed the token before it, how often it
occurs at all, and a uniform floor.  The weights depend on how often the context occurred (a bucket for
each power of two).  They are learned by expectation-maximisation on deleted counts: every eighth training document, by a hash of id and
text, is taken out of all counts, and its tokens are predicted from the rest.

Counts of words and word pairs come from every training document.  Documents are dealt into blocks of some
1 MB of text as they are read (those that are deleted into blocks of their own).  Each block asks for its own
distinct keys, so frequent words are summed before they travel, and gets the totals back in the order it
asked; no vocabulary is broadcast or collected.  Text is shuffled once, and a block is all that a task holds:
ids that repeat, are null or far apart, and runs of long texts, make no difference to it.

Defined results: null or blank text has one token, the end of the text; an id that is null counts as the
empty text when documents are split; repeated rows are documents of their own; without training documents
every probability comes from the floor; where no document is deleted (tables of a few) the weights are equal.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .core import (
    ASK_SQL, LOWER, SLICE_BYTES, U64, Asker, Deal, blocked, buckets, by_block, merge_asked, mix, pack, slices, split_mod,
    stored, text_bytes, together, unpack, word_hashes, word_spans,
)

KEY_BITS = 56
#: One in so many training documents is deleted from the counts to learn the weights.
DELETED = 8
CONTEXTS = 32
#: Steps of an estimate's logarithm per factor of two, and the cells so made, when the weights are learned.
STEPS, CELLS = 8, 320
ROUNDS = 60
_BEGIN, _END = U64(0x2545F4914F6CDD1D), U64(0x9FB21C651E98DF25)
_PAIR = U64(0xD6E8FEB86659FD93)


class Tokens:
    """Token keys of some documents: words and an end each, the pair with the token before, the contexts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, deal: Deal) -> None:
        starts, ends, first = word_spans(data, offsets, LOWER)
        h = word_hashes(data, starts, ends, LOWER)
        docs = len(offsets) - 1
        self.first = first + np.arange(docs + 1)
        n = len(h) + docs
        word = np.ones(n, bool)
        word[self.first[1:] - 1] = False
        token = np.empty(n, U64)
        token[word], token[~word] = h, _END
        before = np.empty(n, U64)
        before[1:] = token[:-1]
        before[self.first[:-1]] = _BEGIN
        self.owner = np.repeat(np.arange(docs), np.diff(self.first))
        self.token, self.context = deal.cut(mix(token)), deal.cut(mix(before))
        self.pair = deal.cut(mix(before * _PAIR + token))
        self.begin = deal.cut(mix(np.full(1, _BEGIN)))


def _ask(deal: Deal):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asker = Asker(deal, 3)
        for batch in batches:
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            rows = batch.column("row")
            train = rows.field("train").to_numpy(zero_copy_only=False).astype(float)
            deleted = train * (blocks & 1)
            for s in slices(rows.field("text")):
                t = Tokens(s.data, s.offsets, deal)
                mine = slice(s.row, s.row + len(s))
                begin, docs = np.repeat(t.begin, len(s)), np.arange(len(s))
                for keys, owner, word in ((t.token, t.owner, 1), (t.pair, t.owner, 0), (begin, docs, 0)):
                    known = train[mine][owner]
                    asker.add_docs(blocks[mine], owner, keys, [known, deleted[mine][owner], known * word])
                yield from asker.rows()
        yield from asker.rows(force=True)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """For each block that asked, the two totals of its keys in order; and a row of the range's own sizes:
    tokens, distinct tokens and deleted tokens, without pairs."""
    bucket = table.column("bucket")[0].as_py()
    _, (total, deleted, words), own = merge_asked(table, 3)
    sizes = [int(words.sum()), int((words > 0).sum()), int(deleted[words > 0].sum())]
    return pa.table({
        "block": pa.array([*own, None], pa.int64()),
        "bucket": pa.array([bucket] * (len(own) + 1), pa.int32()),
        "answer": pa.array([*(pack(np.concatenate([total[p], deleted[p]])) for p in own.values()), None], pa.binary()),
        "sizes": pa.array([*([None] * len(own)), sizes], pa.list_(pa.int64())),
    })


class _Counts:
    """The totals that a block asked for, looked up by key."""

    def __init__(self, tokens: Tokens, answers: dict[int, bytes]) -> None:
        self.keys = np.unique(np.concatenate([tokens.token, tokens.pair, tokens.begin]))
        parts = [unpack(answers[b]).reshape(2, -1) for b in sorted(answers)]
        self.total, self.deleted = np.concatenate(parts, axis=1).astype(np.float64)

    def get(self, keys: np.ndarray, rest: bool = False) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        return self.total[at] - self.deleted[at] if rest else self.total[at]


def _estimates(t: Tokens, counts: _Counts, n: float, rest: bool = False):
    """Pair and single estimates of each token, and the bucket of its context's frequency."""
    context = counts.get(t.context, rest)
    bucket = np.minimum(np.log2(context + 1).astype(np.int64), CONTEXTS - 1)
    pair = np.divide(counts.get(t.pair, rest), context, out=np.zeros(len(context)), where=context > 0)
    return pair, counts.get(t.token, rest) / max(n, 1.0), bucket


def _cell(p: np.ndarray) -> np.ndarray:
    """0 for no probability, else a step of its logarithm."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(1 + np.rint(-np.log2(np.where(p > 0, p, 1)) * STEPS), 1, CELLS - 1), 0).astype(np.int64)


def cell_value(cell: np.ndarray) -> np.ndarray:
    return np.where(cell > 0, 2.0 ** (-(cell - 1) / STEPS), 0.0)


def _events(deal: Deal, n_rest: float):
    """How often each (bucket, pair estimate, single estimate) occurs among deleted tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for _, table, answers in by_block(batches):
            if table is None or not answers:
                continue
            rows = table.column("row").combine_chunks()
            data, offsets = text_bytes(rows.field("text"))
            t = Tokens(data, offsets, deal)
            use = rows.field("train").to_numpy(zero_copy_only=False)[t.owner]
            pair, single, bucket = (x[use] for x in _estimates(t, _Counts(t, answers), n_rest, rest=True))
            code, count = np.unique((bucket * CELLS + _cell(pair)) * CELLS + _cell(single), return_counts=True)
            for c, k in zip(code.tolist(), count.tolist(), strict=True):
                total[c] = total.get(c, 0) + k
        yield pa.record_batch({"code": pa.array(list(total), pa.int64()), "n": pa.array(list(total.values()), pa.int64())})

    return run


def learn_weights(bucket: np.ndarray, pair: np.ndarray, single: np.ndarray, n: np.ndarray, floor: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (pair, single, floor) of each bucket by expectation-maximisation over ``n`` held-out events
    of each kind.  Buckets start from the weights of all events together, and a little mass always stays
    on each part."""
    parts = np.stack([pair, single, np.full(len(pair), floor)], axis=1)

    def fit(w: np.ndarray, rows: np.ndarray) -> np.ndarray:
        p, k = parts[rows], n[rows].astype(float)
        for _ in range(rounds):
            share = p * w
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
            w = (share * k[:, None]).sum(axis=0) + 1e-3
            w = w / w.sum()
        return w

    out = np.full((CONTEXTS, 3), 1 / 3)
    if len(n):
        out[:] = fit(out[0], np.ones(len(n), bool))
        for b in np.unique(bucket):
            out[b] = fit(out[b], bucket == b)
    out[0] = np.array([0, *out[0][1:]]) / max(out[0][1:].sum(), 1e-300)
    return out


def _score(deal: Deal, n: int, v: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = 1.0 / (v + 1)
        for _, table, answers in by_block(batches):
            if table is None:
                continue
            rows = table.column("row").combine_chunks()
            data, offsets = text_bytes(rows.field("text"))
            t = Tokens(data, offsets, deal)
            counts = _Counts(t, answers)
            pair, single, bucket = _estimates(t, counts, n)
            w = weights[bucket]
            p = w[:, 0] * pair + w[:, 1] * single + w[:, 2] * floor
            c = counts.get(t.token)
            base = np.log10((c + 1) / (n + v + 1))
            begin = t.first[:-1]
            yield pa.record_batch({
                "doc_id": rows.field("doc_id"), "held_out": pa.array(~rows.field("train").to_numpy(zero_copy_only=False)),
                "n_tokens": pa.array(np.diff(t.first)), "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64), begin)),
                "base_score": pa.array(np.add.reduceat(base, begin)), "score": pa.array(np.add.reduceat(np.log10(p), begin)),
            })

    return run


def score_documents(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = SLICE_BYTES) -> DataFrame:
    """``train``: boolean column, whether a row's text may be learned from.  One row per input row:
    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` (log10)."""
    deal = Deal(buckets(docs.sparkSession), KEY_BITS)
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    rows = blocked(keyed, "text", "texts", F.col("train") & (F.pmod(F.xxhash64("doc_id", "text"), F.lit(DELETED)) == 0), block_bytes)
    asks = rows.mapInArrow(_ask(deal), ASK_SQL)
    ranges = stored(asks.groupBy("bucket").applyInArrow(_answer, "block long, bucket int, answer binary, sizes array<long>"), "counts")
    sums = ranges.where("block is null").agg(*[F.coalesce(F.sum(F.col("sizes")[i]), F.lit(0)).alias(str(i)) for i in range(3)]).first()
    n, v, n_deleted = (int(x) for x in sums)
    answers = ranges.where("block is not null")
    odd = "block % 2 = 1"
    events = together(rows.where(odd), answers.where(odd)).mapInArrow(_events(deal, float(n - n_deleted)), "code long, n long")
    found = events.groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    code, count = found["code"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
    bucket, pair, single = code // (CELLS * CELLS), code // CELLS % CELLS, code % CELLS
    weights = learn_weights(bucket, cell_value(pair), cell_value(single), count, 1.0 / (v + 1))
    scored = together(rows, answers).mapInArrow(
        _score(deal, n, v, weights), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_documents(docs, split_mod(F.col("doc_id"), 7) != 2)
