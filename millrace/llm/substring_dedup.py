"""Exact substring deduplication by fixed-block anchors.

Each document is cut into non-overlapping reference blocks of ``anchor = (window + 1) // 2`` words; every
window of ``window`` words holds one whole block.  All rolling windows of that length probe the blocks of
the whole corpus.  Where a probe meets a block that is not itself, the hit is extended: the windows around
it are compared in full, and windows that occur twice join up to maximal repeats, whose words go.

Documents are dealt into blocks of some 1 MB of text as they are read; a block is all that a task holds.
Probes travel as sorted, distinct key differences for each block (about three bytes a word), so a passage that
a third of all documents hold is sent once per block.  The answer is a bit per key.  Text is shuffled once,
and once more only for documents with hits.  Nothing is broadcast.

``keep_first`` leaves each window where it occurs first (blocks in the order they were read, then the documents
of a block in theirs) and removes it elsewhere: no passage is lost to a corpus that way.

Defined results: null or blank text has no words and an empty ``kept``; a text shorter than the window
is kept; equal windows inside one document count, overlapping ones too; repeated rows are documents of
their own, so their windows are repeats; further columns are carried in ``row`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .core import (
    ASK_SQL, PLAIN, SLICE_BYTES, Asker, Deal, ask_rows, blocked, buckets, by_block, discard, merge_asked, pack_sorted, slices, stored, text_bytes,
    together, unpack_sorted, windows, word_hashes, word_spans,
)

WINDOW = 35
#: Bits of an anchor's key, which only proposes, and of a window's, which decides.
ANCHOR_BITS, WINDOW_BITS = 40, 64
ANSWER_SQL = "block long, bucket int, answer binary"


def _bits(mask: np.ndarray) -> bytes:
    return len(mask).to_bytes(4, "little") + np.packbits(mask).tobytes()


def _unbits(blob: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8, offset=4), count=int.from_bytes(blob[:4], "little")).astype(bool)


def _anchors(deal: Deal, window: int, anchor: int, h: np.ndarray, first: np.ndarray):
    """Probe keys, the word and document of each, and whether it is a reference block."""
    value, at = windows(h, first, anchor)
    owner = np.searchsorted(first, at, "right") - 1
    long = np.diff(first)[owner] >= window
    value, at, owner = value[long], at[long], owner[long]
    return deal.cut(value), at, owner, (at - first[owner]) % anchor == 0


def _ask_anchors(deal: Deal, text: str, window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asker = Asker(deal, 2)
        for batch in batches:
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            for s in slices(batch.column("row").field(text)):
                starts, ends, first = word_spans(s.data, s.offsets, PLAIN)
                keys, _, owner, is_block = _anchors(deal, window, anchor, word_hashes(s.data, starts, ends, PLAIN), first)
                asker.add_docs(blocks[s.row :], owner, keys, [np.ones(len(keys)), is_block.astype(float)])
                yield from asker.rows()
        yield from asker.rows(force=True)

    return run


def _answer_anchors(table: pa.Table) -> pa.Table:
    """A bit for each of a block's keys: it occurs twice, and one of the occurrences is a reference block."""
    bucket = table.column("bucket")[0].as_py()
    _, totals, own = merge_asked(table, 2)
    hit = (totals[0] >= 2) & (totals[1] >= 1)
    return pa.table({
        "block": pa.array(list(own), pa.int64()),
        "bucket": pa.array([bucket] * len(own), pa.int32()),
        "answer": pa.array([_bits(hit[p]) for p in own.values()], pa.binary()),
    })


def _known(answers: dict[int, bytes], keys: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """For each of ``keys`` the bit of its place among the block's ``distinct`` keys."""
    if not len(keys):
        return np.zeros(0, bool)
    bits = np.concatenate([_unbits(answers[b]) for b in sorted(answers)])
    return bits[np.searchsorted(distinct, keys)]


_DONE = [("kind", pa.int8()), ("block", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("values", pa.binary()),
         ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]
_DONE_SQL = "kind byte, block long, bucket int, keys binary, values binary, n_words long, n_removed long, kept string"


def _rows(kind: int, n: int, block: int, row: pa.Array, **have) -> pa.RecordBatch:
    made = {"kind": pa.array(np.full(n, kind, np.int8)), "block": pa.array(np.full(n, block, np.int64)), **have}
    cols = {name: made[name] if name in made else pa.nulls(n, t) for name, t in _DONE}
    return pa.RecordBatch.from_pydict({**cols, "row": row})


class _Block:
    """Words and keys of one block's documents."""

    def __init__(self, table: pa.Table, text: str, original: bool) -> None:
        self.text, self.original = text, original
        self.rows = table.column("row").combine_chunks()
        self.data, self.offsets = text_bytes(self.rows.field(text))
        self.starts, self.ends, self.first = word_spans(self.data, self.offsets, PLAIN)
        self.h = word_hashes(self.data, self.starts, self.ends, PLAIN)

    def __len__(self) -> int:
        return len(self.rows)

    def given_back(self, part: np.ndarray) -> pa.Array:
        """Input rows as results hold them: without the text, unless it is wanted beside ``kept``."""
        rows = self.rows.take(pa.array(part))
        if self.original:
            return rows
        fields = list(rows.type)
        return pa.StructArray.from_arrays([pa.nulls(len(rows), f.type) if f.name == self.text else rows.field(f.name) for f in fields], fields=fields)

    def kept(self, i: int, gone: np.ndarray) -> str:
        a, z = int(self.first[i]), int(self.first[i + 1])
        drop = gone[a:z]
        if not drop.any():
            return b" ".join(self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().split()).decode()
        parts, edge = [], np.flatnonzero(np.diff(np.concatenate([[True], drop, [True]]).astype(np.int8)))
        for b, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            parts += self.data[self.starts[a + b] : self.ends[a + e - 1]].tobytes().split()
        return b" ".join(parts).decode()

    def done(self, block: int, which: np.ndarray, gone: np.ndarray) -> Iterator[pa.RecordBatch]:
        for part in np.array_split(which, max(1, int(np.ceil(len(which) / 512)))):
            if len(part):
                removed = np.concatenate([[0], np.cumsum(gone)])[self.first]
                yield _rows(
                    0, len(part), block, self.given_back(part),
                    n_words=pa.array(np.diff(self.first)[part]), n_removed=pa.array(np.diff(removed)[part]),
                    kept=pa.array([self.kept(int(i), gone) for i in part], pa.string()),
                )


def _extend(deal: Deal, deal2: Deal, text: str, window: int, anchor: int, original: bool):
    """Documents without a hit are done; of the others, the windows around hits are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table, answers in by_block(batches):
            if table is None:
                continue
            b = _Block(table, text, original)
            near = _near(b, deal, window, anchor, answers)
            keys, docs = deal2.cut(near[0]), near[2]
            has = np.zeros(len(b), bool)
            has[docs] = True
            yield from b.done(block, np.flatnonzero(~has), np.zeros(len(b.starts), bool))
            if has.any():
                which = np.flatnonzero(has)
                for part in np.array_split(which, max(1, int(np.ceil(len(which) / 512)))):
                    yield _rows(1, len(part), block, b.rows.take(pa.array(part)))
                distinct, count = np.unique(keys, return_counts=True)
                ask = ask_rows(deal2, block, distinct, [count])
                sent = {c: ask.column(c) for c in ("bucket", "keys", "values")}
                yield _rows(2, ask.num_rows, block, pa.nulls(ask.num_rows, b.rows.type), **sent)

    return run


def _near(b: _Block, deal: Deal, window: int, anchor: int, answers: dict[int, bytes]):
    """Full windows that hold a probe with a hit: value, first word and document."""
    keys, at, _, _ = _anchors(deal, window, anchor, b.h, b.first)
    hit = np.zeros(len(b.h) + 1, np.int64)
    hit[at[_known(answers, keys, np.unique(keys))]] = 1
    before = np.concatenate([[0], np.cumsum(hit)])
    value, begin = windows(b.h, b.first, window)
    close = before[begin + window - anchor + 1] > before[begin]
    value, begin = value[close], begin[close]
    return value, begin, np.searchsorted(b.first, begin, "right") - 1


def _finish(deal2: Deal, text: str, window: int, original: bool, keep_first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table, answers in by_block(batches):
            if table is None:
                continue
            b = _Block(table, text, original)
            value, begin = windows(b.h, b.first, window)
            keys = deal2.cut(value)
            repeated = np.zeros(len(keys), bool)
            if answers:
                found = [_split_answer(answers[k]) for k in sorted(answers)]
                repeated = np.isin(keys, np.concatenate([k for k, _ in found]))
                if keep_first:  # of the windows that occur first in this block, the first one stays
                    first_here = np.concatenate([k[here] for k, here in found])
                    at = np.flatnonzero(repeated & np.isin(keys, first_here))
                    repeated[at[np.unique(keys[at], return_index=True)[1]]] = False
            step = np.zeros(len(b.h) + 1, np.int64)
            np.add.at(step, begin[repeated], 1)
            np.add.at(step, begin[repeated] + window, -1)
            yield from b.done(block, np.arange(len(b)), np.cumsum(step)[:-1] > 0)

    return run


def _answer_keys(table: pa.Table) -> pa.Table:
    """Windows that occur twice, for each block that asked, and a bit for each: no earlier block has it."""
    bucket = table.column("bucket")[0].as_py()
    distinct, totals, own = merge_asked(table, 1)
    earliest = np.full(len(distinct), np.iinfo(np.int64).max)
    for block, p in own.items():
        np.minimum.at(earliest, p, block)
    twice = {block: np.sort(p[totals[0][p] >= 2]) for block, p in own.items()}
    twice = {block: p for block, p in twice.items() if len(p)}
    return pa.table({
        "block": pa.array(list(twice), pa.int64()),
        "bucket": pa.array([bucket] * len(twice), pa.int32()),
        "answer": pa.array([_bits(earliest[p] == block) + pack_sorted(distinct[p]) for block, p in twice.items()], pa.binary()),
    })


def _split_answer(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = 4 + -(-int.from_bytes(blob[:4], "little") // 8)
    return unpack_sorted(blob[n:]), _unbits(blob[:n])


def remove_repeats(docs: DataFrame, text_col: str = "text", window: int = WINDOW, original: bool = True, keep_first: bool = False, block_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per input row: ``row`` (all input columns), ``n_words``, ``n_removed`` and ``kept``, the
    words that no repeated window covers, joined by one space.  ``original=False`` leaves the text in ``row``
    null, so that it is not stored twice; ``keep_first``: see above."""
    if window < 1:
        raise ValueError("window must be at least one word")
    anchor = (window + 1) // 2
    n = buckets(docs.sparkSession)
    deal, deal2 = Deal(n, ANCHOR_BITS), Deal(n, WINDOW_BITS)
    rows = blocked(docs, text_col, "texts", size=block_bytes)
    schema = T.StructType([*T._parse_datatype_string(_DONE_SQL).fields, T.StructField("row", rows.schema["row"].dataType)])
    asks = rows.mapInArrow(_ask_anchors(deal, text_col, window, anchor), ASK_SQL)
    # Written, so that the keys that were sent are gone before the texts are.
    answers = stored(asks.groupBy("bucket").applyInArrow(_answer_anchors, ANSWER_SQL), "answers")
    mid = stored(together(rows, answers).mapInArrow(_extend(deal, deal2, text_col, window, anchor, original), schema), "repeats")
    discard(rows, answers)
    more = mid.where("kind = 2").select("bucket", "block", "keys", "values").groupBy("bucket").applyInArrow(_answer_keys, ANSWER_SQL)
    rest = together(mid.where("kind = 1").select("block", "row"), more).mapInArrow(_finish(deal2, text_col, window, original, keep_first), schema)
    done = ["row", "n_words", "n_removed", "kept"]
    return mid.where("kind = 0").select(*done).unionByName(rest.select(*done))


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, original=False).select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
starts AS MATERIALIZED (
  SELECT r, i, md5_number(array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM texts WHERE len(w) >= {WINDOW})),
gone AS MATERIALIZED (
  SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS p FROM starts SEMI JOIN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1) USING (h)),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS k
  FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM texts) ANTI JOIN gone USING (r, p) GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM texts LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)
"""
