"""Exact removal of repeated byte strings by a distributed merge sort of suffixes that never compares a known prefix again.

A string of ``width`` bytes is repeated if it begins twice anywhere.  Sorting every suffix would move the corpus some hundred times, so
the array is sparse: of each run of ``Shape.sample`` neighbouring starts only the suffix with the smallest hashed gram is sorted
(the leftmost of equal ones).  What is sampled depends on nothing but bytes inside the string, so equal strings hold
equal sampled suffixes at equal places, at most ``Shape.left`` bytes behind their start.  An entry is the suffix cut at ``width`` bytes,
followed by the ``left`` bytes in front of it, backwards.

1. Sampled suffixes whose first ``width - left`` bytes nobody else has cannot belong to a repeat.  Which do is told by 64-bit hashes, counted by
   key range and answered with a bit; a collision only lets through an entry that the sort then finds alone.
2. The entries of the others are sorted in runs of at most ``RUN``, equal ones joined, and sent front-coded: the length of the
   prefix shared with the entry before, and the rest.  They are dealt by the hash of their first ``width - left`` bytes,
   which all that could be partners share.
3. A loser tree merges the runs of a range.  Its players carry the common prefix with the last winner; the longer one wins unseen and
   equal ones are compared from there on.  It yields the sorted entries with the common prefix of neighbours.
4. Entries that share ``width - d`` bytes forwards are neighbours there, those that share ``d`` backwards are neighbours in the order of what is in front.
   For each ``d``, two occurrences in one class of both orders are a repeat that starts ``d`` bytes earlier.  As all repeated strings
   around a sampled suffix hold it, they cover one span.
5. Spans go back to the documents' blocks, are joined, and cut out.

A beginning that very many suffixes share (more than ``HOT``, such as the edge of a passage that a third of all documents hold, where every entry
differs) is taken out of 2 and goes string by string: the starts around it are counted by hash once more, and
those that are repeated are sorted and merged as entries without left part, where equal ones are joined in each
task before they are sent.  So no task holds more of them than there are runs.

Texts are handled in blocks of some ``BLOCK`` bytes, a longer text alone; nothing is broadcast, and results do not depend on how texts are dealt.

Defined results: null counts as empty; matches never cross documents; texts shorter than ``width`` stay; repeated rows are documents of
their own, so they are repeats; overlapping repeats inside one text count; columns beside the text are carried in ``row`` untouched.  Texts are UTF-8, where
byte 255 cannot occur: it fills entries up behind a text's end and in front of its beginning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .core import (
    _CODE, _POWERS, _ZSTD, ASK_SQL, U64, Asker, Deal, blocked, buckets, by_block, discard, merge_asked, mix, noted, pack, slices, stored, text_bytes, together, unpack,
)

WIDTH = 200
BLOCK = 8 << 20
#: Entries of one run, and sharers of a beginning from which it goes string by string.
RUN, HOT = 1 << 16, 1 << 18
#: Starts that are looked at together.
PIECE = 1 << 21
_FILL = 0xFF


@dataclass(frozen=True)
class Shape:
    """Lengths that follow from the width: ``sample`` neighbouring starts share a sampled suffix, chosen by ``gram`` bytes."""

    width: int
    sample: int
    gram: int

    @classmethod
    def of(cls, width: int) -> "Shape":
        if width < 1:
            raise ValueError("width must be at least one byte")
        return cls(width, 1 << max(0, (width // 3).bit_length() - 1), max(1, min(8, width // 2)))

    @classmethod
    def whole(cls, width: int) -> "Shape":
        """Every start is an entry of its own, with nothing in front."""
        return cls(width, 1, 1)

    @property
    def left(self) -> int:
        return self.sample - 1

    @property
    def shared(self) -> int:
        return self.width - self.left

    @property
    def entry(self) -> int:
        return self.width + self.left


def _starts(offsets: np.ndarray, a: int, z: int, width: int) -> np.ndarray:
    """Which of the places a..z begin a string of ``width`` bytes inside one document."""
    valid = np.ones(z - a, bool)
    first = max(0, int(np.searchsorted(offsets, a, "right")) - 1)
    for end in offsets[first + 1 :]:
        low = end - width + 1
        if low >= z:
            break
        begin = max(offsets[first], low)
        valid[max(0, begin - a) : max(0, end - a)] = False
        first += 1
    return valid


def _sampled(data: np.ndarray, valid: np.ndarray, shape: Shape) -> np.ndarray:
    """Places of the sampled suffixes of the valid starts."""
    if shape.sample == 1:
        return np.flatnonzero(valid)
    n = len(valid) + shape.sample - 1
    raw = np.zeros(n + 8, np.uint8)
    raw[: min(len(data), n + 8)] = data[: n + 8]
    gram = np.ndarray((n,), "<u8", buffer=raw.tobytes(), strides=(1,)) & U64((1 << 8 * shape.gram) - 1)
    low = (gram * U64(0x9E3779B97F4A7C15)) & ~U64((1 << 24) - 1) | np.arange(n, dtype=U64)
    size = 1
    while size < shape.sample:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    chosen = (low[: len(valid)][valid] & U64((1 << 24) - 1)).astype(np.int64)
    return chosen[np.concatenate([[True], np.diff(chosen) > 0])] if len(chosen) else chosen


def samples(data: np.ndarray, offsets: np.ndarray, shape: Shape) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of sampled suffixes of some documents, ascending, and the hash of their first ``shared`` bytes."""
    last = -1
    for a in range(0, len(data), PIECE):
        z = min(a + PIECE, len(data))
        valid = _starts(offsets, a, z, shape.width)
        if not valid.any():
            continue
        here = data[a : z + shape.entry]
        at = _sampled(here, valid, shape)
        at = at[at + a > last]
        if len(at):
            last = int(at[-1]) + a
            yield at + a, hashes(here, at, shape.shared)


def hashes(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    up, down = _POWERS.get(len(data))
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_CODE[data] * up, out=sums[1:])
    return mix((sums[at + size] - sums[at]) * down[at])


# ---------------------------------------------------------------- entries and runs
def entries(data: np.ndarray, offsets: np.ndarray, at: np.ndarray, owner: np.ndarray, shape: Shape) -> np.ndarray:
    """One row of bytes per place: ``width`` bytes from it on, then the ``left`` ones in front of it, backwards."""
    padded = np.concatenate([np.full(shape.left, _FILL, np.uint8), data, np.full(shape.width, _FILL, np.uint8)])
    around = np.lib.stride_tricks.sliding_window_view(padded, shape.entry)[at]
    out = np.concatenate([around[:, shape.left :], around[:, : shape.left][:, ::-1]], axis=1)
    behind, before = offsets[owner + 1] - at, at - offsets[owner]
    for i in np.flatnonzero(behind < shape.width):
        out[i, behind[i] : shape.width] = _FILL
    for i in np.flatnonzero(before < shape.left):
        out[i, shape.width + before[i] :] = _FILL
    return out


def _order(rows: np.ndarray) -> np.ndarray:
    """The order of rows of bytes."""
    if not rows.shape[1]:
        return np.arange(len(rows))
    rows = np.ascontiguousarray(rows)
    return np.argsort(rows.view(np.dtype((np.void, rows.shape[1]))).ravel(), kind="stable")


def _common(rows: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before it (none before the first)."""
    out = np.zeros(len(rows), np.int64)
    for a in range(1, len(rows), 16384):
        z = min(a + 16384, len(rows))
        differs = rows[a:z] != rows[a - 1 : z - 1]
        out[a:z] = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1]) if rows.shape[1] else 0
    return out


def encode_run(rows: np.ndarray, common: np.ndarray) -> bytes:
    """Sorted rows front-coded: common prefixes, and what follows them."""
    rest = rows[np.arange(rows.shape[1]) >= common[:, None]].tobytes()
    packed = pack(common)
    return len(packed).to_bytes(4, "little") + packed + len(rest).to_bytes(4, "little") + bytes(_ZSTD.compress(rest, asbytes=True))


def decode_run(blob: bytes, entry: int) -> tuple[list[bytes], list[int]]:
    n = int.from_bytes(blob[:4], "little")
    common = unpack(blob[4 : 4 + n]).astype(np.int64).tolist()
    size = int.from_bytes(blob[4 + n : 8 + n], "little")
    rest, at, last, out = _ZSTD.decompress(blob[8 + n :], size, asbytes=True) if size else b"", 0, b"", []
    for h in common:
        last = last[:h] + rest[at : at + entry - h]
        at += entry - h
        out.append(last)
    return out, common


def merge(runs: list[tuple[list[bytes], list[int]]], entry: int) -> tuple[list[int], list[int], list[int]]:
    """Loser tree over sorted runs with common prefixes: run and place of each entry in order, and its common prefix with the one before."""
    k = len(runs)
    place, known = [0] * k, [0] * k  # known: common prefix with the last winner; -1: the run is over
    keys = [r[0] for r in runs]
    head = [r[0][0] if r[0] else None for r in runs]
    for r in range(k):
        if head[r] is None:
            known[r] = -1
    tree = [-1] * max(k, 1)

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's known prefix becomes the one with the winner where both had the same."""
        x, y = known[a], known[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        s, t = head[a], head[b]
        differ = int.from_bytes(s[x:], "big") ^ int.from_bytes(t[x:], "big")
        h = entry - (differ.bit_length() + 7) // 8
        if h == entry or s[h] < t[h]:
            known[b] = h
            return a, b
        known[a] = h
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        won, tree[node] = play(build(2 * node), build(2 * node + 1))
        return won

    won = build(1) if k > 1 else 0
    of_run, of_place, common = [], [], []
    while k and known[won] >= 0:
        i = place[won]
        of_run.append(won)
        of_place.append(i)
        common.append(known[won])
        i += 1
        place[won] = i
        if i < len(keys[won]):
            head[won], known[won] = keys[won][i], runs[won][1][i]
        else:
            known[won] = -1
        node = (won + k) // 2
        while node:
            rival = tree[node]
            x, y = known[won], known[rival]
            if x < y:
                won, tree[node] = rival, won
            elif x == y:
                won, tree[node] = play(won, rival)
            node //= 2
    return of_run, of_place, common


def repeats(rows: np.ndarray, common: np.ndarray, count: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct entry, sorted, the least and the most ``d`` of the repeated strings that start d bytes before it; the most is
    -1 where there is none.  ``count``: occurrences of each entry."""
    n = len(rows)
    low, high = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    ahead = shape.width - (rows[:, : shape.width] == _FILL).sum(axis=1)
    behind = shape.left - (rows[:, shape.width :] == _FILL).sum(axis=1)
    common = common.copy()
    common[:1] = 0
    group = np.cumsum(common < shape.shared)
    alone = np.bincount(group)[group] == 1
    sure = alone & (count >= 2) & (shape.width - ahead <= behind)
    low[sure], high[sure] = np.maximum(shape.width - ahead[sure], 0), behind[sure]
    which = np.flatnonzero(~alone)
    if not len(which):
        return low, high
    front = rows[which, shape.width :]
    order = _order(front)
    shared_front = _common(front[order])
    shared, ahead, behind, count = np.minimum(common[which], shape.width), ahead[which], behind[which], count[which]
    least, most = np.full(len(which), shape.entry), np.full(len(which), -1)
    back = np.empty(len(which), np.int64)
    for d in range(shape.left + 1):
        forward = np.cumsum(shared < shape.width - d)
        back[order] = np.cumsum(shared_front < d)
        fits = np.flatnonzero((ahead >= shape.width - d) & (behind >= d))
        if not len(fits):
            continue
        _, place = np.unique(forward[fits] * (len(which) + 1) + back[fits], return_inverse=True)
        hit = fits[np.bincount(place, weights=count[fits])[place] >= 2]
        least[hit], most[hit] = np.minimum(least[hit], d), d
    low[which], high[which] = least, most
    return low, high


# ---------------------------------------------------------------- stages
_MID = [("kind", pa.int8()), ("block", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("values", pa.binary()), ("at", pa.int64()), ("hot", pa.list_(pa.int64())),
        ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()), ("kept_sha256", pa.string())]
_MID_SQL = ("kind byte, block long, bucket int, keys binary, values binary, at long, hot array<long>, n_bytes long, n_removed long, "
            "spans array<struct<begin:long,end:long>>, kept binary, kept_sha256 string")  # fmt: skip
_RUN_SQL = "bucket int, block long, keys binary, values binary"
_DONE = ["row", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"]


def _ask(deal: Deal, text: str, shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asker = Asker(deal, 1)
        for batch in batches:
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            for s in slices(batch.column("row").field(text)):
                for at, keys in samples(s.data, s.offsets, shape):
                    owner = np.searchsorted(s.offsets, at, "right") - 1
                    asker.add_docs(blocks[s.row :], owner, keys, [np.ones(len(keys))])
                yield from asker.rows()
        yield from asker.rows(force=True)

    return run


def _answer(hot: int):
    """For each of a block's keys: 0 if it occurs once, 1 if more often, 2 if more than ``hot`` times."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        _, (total,), own = merge_asked(table, 1)
        said = (total >= 2).astype(U64) + (total > hot).astype(U64)
        return pa.table({"block": pa.array(list(own), pa.int64()), "bucket": pa.array([bucket] * len(own), pa.int32()), "answer": pa.array([pack(said[p]) for p in own.values()], pa.binary())})

    return run


def _runs(block: int, deal: Deal, data: np.ndarray, offsets: np.ndarray, at: np.ndarray, keys: np.ndarray, shape: Shape) -> Iterator[dict]:
    """Sorted, front-coded runs of some suffixes by key range, each entry once, and where it occurs."""
    bucket = ((deal.cut(keys) >> U64(32)) * U64(deal.n)) >> U64(32)
    for a in range(0, len(at), RUN):
        some, dealt = at[a : a + RUN], bucket[a : a + RUN].astype(">u4")
        owner = np.searchsorted(offsets, some, "right") - 1
        rows = np.concatenate([dealt[:, None].view(np.uint8).reshape(-1, 4), entries(data, offsets, some, owner, shape)], axis=1)
        order = _order(rows)
        rows, common = rows[order], _common(rows[order])
        new = common < rows.shape[1]
        count = np.diff(np.append(np.flatnonzero(new), len(new)))
        of_doc, inside = owner[order], some[order] - offsets[owner[order]]
        first = np.cumsum(np.append(0, count))
        rows, common, dealt = rows[new], common[new], dealt[order][new].astype(np.int64)
        cuts = np.flatnonzero(np.append(True, np.diff(dealt) > 0))
        for b, e in zip(cuts, [*cuts[1:], len(dealt)], strict=True):
            known = np.maximum(common[b:e] - 4, 0)
            known[0] = 0
            where = [pack(count[b:e]), pack(of_doc[first[b] : first[e]]), pack(inside[first[b] : first[e]])]
            yield {"bucket": int(dealt[b]), "block": block, "keys": encode_run(rows[b:e, 4:], known), "values": b"".join(len(w).to_bytes(4, "little") + w for w in where)}


def _where(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at : at + 4], "little")
        out.append(unpack(blob[at + 4 : at + 4 + n]).astype(np.int64))
        at += 4 + n
    return out


def _merge(shape: Shape):
    """All runs of a range: merged, judged, and the spans around each occurrence by block."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        runs = [decode_run(x, shape.entry) for x in table.column("keys").to_pylist()]
        where = [_where(x) for x in table.column("values").to_pylist()]
        of_run, of_place, common = merge(runs, shape.entry)
        common = np.array(common, np.int64)
        new = common < shape.entry
        new[0] = True
        rows = np.frombuffer(b"".join(runs[r][0][i] for r, i, first in zip(of_run, of_place, new.tolist(), strict=True) if first), np.uint8).reshape(-1, shape.entry)
        which, first = np.cumsum(new) - 1, np.cumsum([0] + [len(r[0]) for r in runs])
        entry = np.empty(first[-1], np.int64)  # the distinct entry of each run's entries, one run after another
        entry[first[np.array(of_run)] + np.array(of_place)] = which
        counts = np.concatenate([w[0] for w in where])
        low, high = repeats(rows, common[new], np.bincount(entry, weights=counts, minlength=len(rows)), shape)
        entry = np.repeat(entry, counts)
        block = np.repeat(table.column("block").to_numpy(), [len(w[1]) for w in where])
        of_doc, inside = np.concatenate([w[1] for w in where]), np.concatenate([w[2] for w in where])
        hit = high[entry] >= 0
        found = [x[hit] for x in (block, of_doc, inside - high[entry], inside + shape.width - low[entry])]
        found = [x[np.argsort(found[0], kind="stable")] for x in found]
        cuts = np.flatnonzero(np.append(True, np.diff(found[0]) != 0)) if len(found[0]) else np.zeros(0, np.int64)
        ends = [*cuts[1:], len(found[0])]
        return pa.table({
            "block": pa.array(found[0][cuts], pa.int64()), "bucket": pa.array([bucket] * len(cuts), pa.int32()),
            "answer": pa.array([b"".join(len(p).to_bytes(4, "little") + p for p in (pack(x[a:z]) for x in found[1:])) for a, z in zip(cuts, ends, strict=True)], pa.binary()),
        })

    return run


def _batch(schema: pa.DataType, n: int, row: pa.Array | None = None, **have) -> pa.RecordBatch:
    cols = {name: have[name] if name in have else pa.nulls(n, t) for name, t in _MID}
    return pa.RecordBatch.from_pydict({**cols, "row": pa.nulls(n, schema) if row is None else row})


def _finished(kind: pa.DataType, text: str, rows: pa.Array, data: np.ndarray, offsets: np.ndarray, which: np.ndarray, spans: dict[int, tuple[np.ndarray, np.ndarray]], texts: bool) -> Iterator[pa.RecordBatch]:
    """Result rows of the documents ``which`` without the bytes of their ``spans``."""
    none = (np.zeros(0, np.int64),) * 2
    for part in np.array_split(which, max(1, -(-len(which) // 512))):
        if not len(part):
            continue
        kept, begins, ends, sizes = [], [], [], []
        for i in part.tolist():
            body = data[offsets[i] : offsets[i + 1]]
            b, e = spans.get(i, none)
            cut = [body[x:y].tobytes() for x, y in zip([0, *e.tolist()], [*b.tolist(), len(body)], strict=True)]
            kept.append(b"".join(cut))
            begins.append(b)
            ends.append(e)
            sizes.append(len(body))
        own = rows.take(pa.array(part))
        if not texts:
            own = pa.StructArray.from_arrays([pa.nulls(len(own), f.type) if f.name == text else own.field(f.name) for f in kind], fields=list(kind))
        edges = pa.array(np.cumsum([0] + [len(b) for b in begins]).astype(np.int32))
        pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(begins)), pa.array(np.concatenate(ends))], ["begin", "end"])
        yield _batch(
            kind, len(part), own, kind=pa.array(np.zeros(len(part), np.int8)), n_bytes=pa.array(sizes, pa.int64()), n_removed=pa.array([s - len(k) for s, k in zip(sizes, kept, strict=True)], pa.int64()),
            spans=pa.ListArray.from_arrays(edges, pairs), kept=pa.array(kept, pa.binary()) if texts else pa.nulls(len(part), pa.binary()), kept_sha256=pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
        )


def _extract(deal: Deal, text: str, shape: Shape, texts: bool):
    """Documents without a shared suffix are done; of the others, runs of entries, and the hot beginnings of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table, answers in by_block(batches):
            if table is None:
                continue
            rows = table.column("row").combine_chunks()
            data, offsets = text_bytes(rows.field(text))
            found = list(samples(data, offsets, shape))
            at, keys = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, U64))
            said = np.concatenate([unpack(answers[b]) for b in sorted(answers)]) if answers else np.zeros(0, U64)
            said = said[np.searchsorted(np.unique(keys), keys)] if len(keys) else said
            has = np.zeros(len(rows), bool)
            has[np.searchsorted(offsets, at[said > 0], "right") - 1] = True
            yield from _finished(rows.type, text, rows, data, offsets, np.flatnonzero(~has), {}, texts)
            hot = at[said == 2]
            hot_owner = np.searchsorted(offsets, hot, "right") - 1
            which = np.flatnonzero(has)
            for part in np.array_split(which, max(1, -(-len(which) // 512))):
                if len(part):
                    edges = np.searchsorted(hot_owner, np.append(part, part[-1] + 1))
                    lists = pa.array([(hot[a:z] - offsets[i]).tolist() for i, a, z in zip(part, edges, edges[1:], strict=False)], pa.list_(pa.int64()))
                    yield _batch(rows.type, len(part), rows.take(pa.array(part)), kind=pa.array(np.ones(len(part), np.int8)), block=pa.array(np.full(len(part), block)), at=pa.array(part), hot=lists)
            for r in _runs(block, deal, data, offsets, at[said == 1], keys[said == 1], shape):
                yield _batch(rows.type, 1, kind=pa.array([2], pa.int8()), **{k: pa.array([v], t) for (k, t), v in zip(_MID[1:5], (r["block"], r["bucket"], r["keys"], r["values"]), strict=True)})

    return run


def _near_hot(row: pa.Array, text: str, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of some documents: bytes, offsets, and the starts of strings around their hot beginnings with their hashes."""
    data, offsets = text_bytes(row.field("row").field(text))
    hot = row.field("hot")
    size = np.array(hot.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    owner = np.repeat(np.arange(len(row)), size)
    at = hot.flatten().to_numpy().astype(np.int64) + offsets[owner]
    starts = at[:, None] - np.arange(shape.left, -1, -1)[None, :]
    inside = (starts >= offsets[owner][:, None]) & (starts + shape.width <= offsets[owner + 1][:, None])
    starts = np.unique(starts[inside])
    keys = np.zeros(len(starts), U64)
    for a in range(0, len(data), PIECE):
        mine = (starts >= a) & (starts < a + PIECE)
        if mine.any():
            keys[mine] = hashes(data[a : a + PIECE + shape.width], starts[mine] - a, shape.width)
    return data, offsets, starts, keys


def _ask_hot(deal: Deal, text: str, shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asker = Asker(deal, 1)
        for batch in batches:
            blocks, row = batch.column("block").to_numpy(zero_copy_only=False), batch.column("row")
            for a in range(0, batch.num_rows, 256):
                part = row.slice(a, 256)
                _, offsets, starts, keys = _near_hot(part, text, shape)
                asker.add_docs(blocks[a:], np.searchsorted(offsets, starts, "right") - 1, keys, [np.ones(len(keys))])
                yield from asker.rows()
        yield from asker.rows(force=True)

    return run


def _extract_hot(deal: Deal, text: str, shape: Shape):
    whole = Shape.whole(shape.width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table, answers in by_block(batches):
            if table is None or not answers:
                continue
            row = table.column("row").combine_chunks()
            data, offsets, starts, keys = _near_hot(row, text, shape)
            said = np.concatenate([unpack(answers[b]) for b in sorted(answers)])[np.searchsorted(np.unique(keys), keys)] > 0
            names = row.field("at").to_numpy()
            for r in _runs(block, deal, data, offsets, starts[said], keys[said], whole):
                count, of_doc, inside = _where(r["values"])
                where = [pack(count), pack(names[of_doc]), pack(inside)]
                r["values"] = b"".join(len(w).to_bytes(4, "little") + w for w in where)
                yield pa.record_batch({"bucket": pa.array([r["bucket"]], pa.int32()), "block": pa.array([block]), "keys": pa.array([r["keys"]]), "values": pa.array([r["values"]])})

    return run


def _joined(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching spans made one."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > end[:-1])
    return begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def _cut(text: str, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table, answers in by_block(batches):
            if table is None:
                continue
            both = table.column("row").combine_chunks()
            rows, names = both.field("row"), both.field("at").to_numpy()
            data, offsets = text_bytes(rows.field(text))
            spans: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            if answers:
                of_doc, begin, end = (np.concatenate(x) for x in zip(*[_where(a) for a in answers.values()], strict=True))
                order = np.argsort(of_doc, kind="stable")
                of_doc, begin, end = of_doc[order], begin[order], end[order]
                edges = np.stack([np.searchsorted(of_doc, names), np.searchsorted(of_doc, names, "right")], axis=1)
                spans = {i: _joined(begin[a:z], end[a:z]) for i, (a, z) in enumerate(edges.tolist()) if z > a}
            yield from _finished(rows.type, text, rows, data, offsets, np.arange(len(rows)), spans, texts)

    return run


def remove_repeated_strings(docs: DataFrame, text_col: str = "text", width: int = WIDTH, texts: bool = True, block_bytes: int = BLOCK, hot: int = HOT) -> DataFrame:
    """One row per input row: ``row`` (all its columns), ``n_bytes``, ``n_removed``, ``spans`` (begin and end of each maximal removed run), ``kept``
    (the bytes that remain) and ``kept_sha256``.  ``texts=False`` leaves ``kept`` and the text in ``row`` null."""
    shape, n = Shape.of(width), buckets(docs.sparkSession)
    whole, deal = Shape.whole(width), Deal(n, 64)
    with noted() as made:
        rows = blocked(docs, text_col, "texts", size=block_bytes)
        schema = T.StructType([*T._parse_datatype_string(_MID_SQL).fields, T.StructField("row", rows.schema["row"].dataType)])
        answer_sql = "block long, bucket int, answer binary"
        answers = stored(rows.mapInArrow(_ask(deal, text_col, shape), ASK_SQL).groupBy("bucket").applyInArrow(_answer(hot), answer_sql), "answers")
        mid = stored(together(rows, answers).mapInArrow(_extract(deal, text_col, shape, texts), schema), "runs")
        discard(rows, answers)
        ordered = mid.where("kind = 2").select("bucket", "block", "keys", "values")
        spans = ordered.groupBy("bucket").applyInArrow(_merge(shape), answer_sql)
        open_ = mid.where("kind = 1").select("block", F.struct("at", "hot", "row").alias("row"))
        around = open_.where("size(row.hot) > 0")
        asked = around.mapInArrow(_ask_hot(deal, text_col, shape), ASK_SQL).groupBy("bucket").applyInArrow(_answer(np.iinfo(np.int64).max), answer_sql)
        strings = together(around, asked).mapInArrow(_extract_hot(deal, text_col, shape), _RUN_SQL).groupBy("bucket").applyInArrow(_merge(whole), answer_sql)
        # One answer row per block and range: those of the second kind get numbers of their own.
        spans = stored(spans.unionByName(strings.withColumn("bucket", F.col("bucket") + n)), "spans")
        rest = together(open_, spans).mapInArrow(_cut(text_col, texts), schema)
        out = stored(mid.where("kind = 0").select(*_DONE).unionByName(rest.select(*_DONE)), "cut")
        discard(*[p for p in made if p not in (out._millrace_path, rows._millrace_path, answers._millrace_path)], spark=docs.sparkSession)
    return out


def op11_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = remove_repeated_strings(docs, texts=False)
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


ORACLE = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS b FROM documents),
starts AS MATERIALIZED (
  SELECT r, i, md5_number(substr(b, 2 * i + 1, {2 * WIDTH})) AS h FROM (SELECT r, b, unnest(range(len(b) // 2 - {WIDTH - 1})) AS i FROM texts WHERE len(b) >= {2 * WIDTH})),
twice AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {WIDTH} THEN 0 ELSE 1 END AS new FROM starts SEMI JOIN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1) USING (h)),
runs AS (SELECT r, run, min(i) AS a, max(i) + {WIDTH} AS z FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM twice) GROUP BY r, run),
gaps AS (
  SELECT r, a, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS since FROM (
    SELECT r, a, z FROM runs UNION ALL SELECT r, len(b) // 2, len(b) // 2 FROM texts)),
rest AS (SELECT r, string_agg(substr(b, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept FROM gaps JOIN texts USING (r) GROUP BY r),
removed AS (SELECT r, sum(z - a) AS n, count(*) AS spans FROM runs GROUP BY r)
SELECT doc_id, (len(b) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM texts JOIN rest USING (r) LEFT JOIN removed USING (r)
"""
