"""Shared pieces of the corpus operators: slicing Arrow text columns, hashing words without
Python objects, packing sorted keys, and intermediate tables in the shared folder.

Texts are handled as UTF-8 bytes.  A slice holds whole documents of about ``SLICE_BYTES``; a longer
document is a slice of its own, so memory follows the longest single document, never a partition.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20
U64 = np.uint64


# ---------------------------------------------------------------- shared folder
def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, or the context's checkpoint folder.  Only
    a session on one machine (master ``local``) may do without: a temporary folder becomes its checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = base.get() if base.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(base)
    return str(base).rstrip("/")


#: Spark's own setting to delete the shuffle files of a statement when it is over.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts the lineage with a table that outlives any executor.
    The shuffle files of the writing go as soon as the table is there."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/millrace-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._millrace_path = path
    made = getattr(_KEPT, "paths", None)
    if made is not None:
        made.append(path)
    return out


_KEPT = threading.local()


def discard(*tables: DataFrame | str, spark: SparkSession | None = None) -> None:
    """Deletes intermediate tables of ``stored`` that nothing will read again."""
    for x in tables:
        path = x if isinstance(x, str) else x._millrace_path
        spark = spark or x.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def noted() -> Iterator[list[str]]:
    """Paths of the tables that ``stored`` writes inside, for a later ``discard``."""
    before, _KEPT.paths = getattr(_KEPT, "paths", None), []
    try:
        yield _KEPT.paths
    finally:
        _KEPT.paths = before


def buckets(spark: SparkSession, per_partition: int = 2) -> int:
    """Number of key ranges to deal out; it follows the number of shuffle partitions, which is what a
    user sizes by the data."""
    return max(8, per_partition * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def split_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null ids count as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def blocked(docs: DataFrame, text_col: str, name: str, apart: Column | None = None, size: int = SLICE_BYTES) -> DataFrame:
    """Rows dealt into blocks of about ``size`` bytes of text in the order they are read, a longer text alone: columns
    ``block`` and the struct ``row`` (all columns).  Blocks follow bytes and not ids, so neither an id with a third of
    all rows nor a run of long texts makes a large one.  Rows that ``apart`` is true of get blocks of their own, with odd
    numbers.  Written to the shared folder, so that every later reading sees the same blocks."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.coalesce(F.lit(False) if apart is None else apart, F.lit(False)).alias("apart"))
    schema = T.StructType([T.StructField("block", T.LongType()), rows.schema["row"]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            odd = batch.column("apart").to_numpy(zero_copy_only=False)
            for side in np.unique(odd):
                rows = batch.column("row").filter(pa.array(odd == side))
                for s in slices(rows.field(text_col), size):
                    numbers = pa.array(np.full(len(s), block + int(side), np.int64))
                    yield pa.RecordBatch.from_arrays([numbers, rows.slice(s.row, len(s))], names=["block", "row"])
                    block += 2

    return stored(rows.mapInArrow(run, schema), name)


# ---------------------------------------------------------------- words
def _rng_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)


_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)
#: Separators of words: space and bytes 9 to 13.
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_CODE = _rng_table(20240601)


@dataclass(frozen=True)
class Words:
    """How bytes form words: ``is_word`` by byte, and the code of each byte for hashing."""

    is_word: np.ndarray
    code: np.ndarray


#: Blank-separated words as they are, and with A-Z lower-cased.
PLAIN = Words(~_BLANK, _CODE)
LOWER = Words(~_BLANK, _CODE[_LOWER])
#: Runs of letters, digits and non-ASCII bytes, with A-Z lower-cased.
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
ALNUM = Words(_ALNUM, _CODE[_LOWER])
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * SLICE_BYTES)
            self.up, self.down = powers(_BASE, size), powers(_INVERSE, size)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray, how: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of each document's first word (one more at the
    end).  Words do not cross documents."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = how.is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


_PIECE = 4 * SLICE_BYTES


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, how: Words) -> np.ndarray:
    """64-bit hash of each word: a polynomial over byte codes, taken from running sums, piece by piece."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        base = starts[at]
        last = max(at + 1, int(np.searchsorted(ends, base + _PIECE, "right")))
        s, e = starts[at:last] - base, ends[at:last] - base
        up, down = _POWERS.get(int(e[-1]))
        sums = np.zeros(int(e[-1]) + 1, U64)
        np.cumsum(how.code[data[base : base + e[-1]]] * up, out=sums[1:])
        out[at:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64))
        at = last
    return out


def windows(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words inside one document, and the word at which it begins."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    up, down = _POWERS.get(len(h))
    sums = np.zeros(len(h) + 1, U64)
    np.cumsum(h * up, out=sums[1:])
    value = mix((sums[width:] - sums[:-width]) * down[:n])
    inside = np.ones(n, bool)
    for end in first[1:-1]:
        inside[max(0, end - width + 1) : end] = False
    at = np.flatnonzero(inside)
    return value[at], at


@dataclass
class Slice:
    """Some whole documents: row numbers in the batch from ``row`` on, bytes and offsets."""

    row: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def doc(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, body = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array | pa.ChunkedArray, size: int = SLICE_BYTES) -> Iterator[Slice]:
    data, offsets = text_bytes(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(min(n, max(row + 1, np.searchsorted(offsets, offsets[row] + size, "right") - 1, 1)))
        end = min(end, row + 4096)
        yield Slice(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


# ---------------------------------------------------------------- packed arrays
_ZSTD = pa.Codec("zstd", compression_level=1)


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers by byte plane, compressed: leading zero bytes cost next to nothing."""
    planes = np.ascontiguousarray(values.astype(U64).view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(4, "little") + bytes(_ZSTD.compress(planes.tobytes(), asbytes=True))


def unpack(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    if not n:
        return np.zeros(0, U64)
    planes = np.frombuffer(_ZSTD.decompress(blob[4:], 8 * n, asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(U64).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending integers by their differences."""
    return pack(np.diff(values, prepend=U64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=U64)


# ---------------------------------------------------------------- keys dealt out and answered
@dataclass(frozen=True)
class Deal:
    """Keys of ``width`` bits, cut by their top bits into ``n`` ranges."""

    n: int
    width: int

    def cut(self, h: np.ndarray) -> np.ndarray:
        return h >> U64(64 - self.width)

    def bounds(self, keys: np.ndarray) -> np.ndarray:
        """Where each range begins among ascending keys, and the end."""
        top = keys >> U64(self.width - 32) if self.width > 32 else keys << U64(32 - self.width)
        return np.searchsorted((top * U64(self.n)) >> U64(32), np.arange(self.n + 1, dtype=U64))


#: One row for each block of documents and key range.
ASK = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("values", pa.binary())])
ASK_SQL = "bucket int, block long, keys binary, values binary"


def ask_rows(deal: Deal, block: int, keys: np.ndarray, values: list[np.ndarray]) -> pa.RecordBatch:
    """``keys``: ascending and distinct; ``values``: parallel arrays of counts, packed one after another."""
    at = deal.bounds(keys)
    used = np.flatnonzero(at[1:] > at[:-1])
    cut = [(int(at[b]), int(at[b + 1])) for b in used]
    return pa.record_batch(
        [
            pa.array(used.astype(np.int32)),
            pa.array(np.full(len(used), block, np.int64)),
            pa.array([pack_sorted(keys[a:z]) for a, z in cut], pa.binary()),
            pa.array([pack(np.concatenate([v[a:z].astype(U64) for v in values])) for a, z in cut], pa.binary()),
        ],
        schema=ASK,
    )


def merge_asked(table: pa.Table, n_values: int) -> tuple[np.ndarray, list[np.ndarray], dict[int, np.ndarray]]:
    """All rows of one key range: the distinct keys, each value's total, and for each block the places
    of its own distinct keys, ascending."""
    blocks = table.column("block").to_numpy()
    keys = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
    values = [unpack(x).reshape(n_values, -1) for x in table.column("values").to_pylist()]
    everything = np.concatenate(keys)
    distinct, place = np.unique(everything, return_inverse=True)
    totals = []
    for i in range(n_values):
        each = np.concatenate([v[i] for v in values]).astype(np.float64)
        totals.append(np.bincount(place, weights=each, minlength=len(distinct)).astype(np.int64))
    own: dict[int, np.ndarray] = {}
    at = 0
    for block, k in zip(blocks.tolist(), keys, strict=True):
        mine = place[at : at + len(k)]
        own[block] = np.union1d(own[block], mine) if block in own else mine
        at += len(k)
    return distinct, totals, own


def by_block(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table, dict[int, list[bytes]]]]:
    """Groups a stream sorted by (block, bucket): rows of bucket -1 are documents in column ``row``, the
    others answers in column ``answer``.  Gives each block's documents and its answers in key order."""
    block, rows, answers = None, [], {}
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        ids = batch.column("block").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            if block is not None and ids[a] != block:
                yield block, pa.concat_tables(rows) if rows else None, answers
                rows, answers = [], {}
            block = int(ids[a])
            part = table.slice(a, z - a)
            bucket = part.column("bucket").to_numpy()
            is_doc = bucket == -1
            if is_doc.any():
                rows.append(part.filter(pa.array(is_doc)).select(["row"]))
            if not is_doc.all():
                other = part.filter(pa.array(~is_doc))
                for b, x in zip(other.column("bucket").to_pylist(), other.column("answer").to_pylist(), strict=True):
                    answers[b] = x
    if block is not None:
        yield block, pa.concat_tables(rows) if rows else None, answers


def together(docs: DataFrame, answers: DataFrame) -> DataFrame:
    """Documents (block, row) and answers (block, bucket, answer) of the same block side by side, in order."""
    left = docs.select("block", F.lit(-1).alias("bucket"), "row", F.lit(None).cast("binary").alias("answer"))
    right = answers.select("block", "bucket", F.lit(None).cast(docs.schema["row"].dataType).alias("row"), "answer")
    both = left.unionByName(right)
    return both.repartition(F.col("block")).sortWithinPartitions("block", "bucket")


class Asker:
    """Gathers keys with counts by block and gives them out as rows, each key of a block once."""

    def __init__(self, deal: Deal, n_values: int, limit: int = 1_000_000) -> None:
        self.deal, self.n_values, self.limit = deal, n_values, limit
        self.held: dict[int, list[tuple[np.ndarray, list[np.ndarray]]]] = {}
        self.size = 0

    def add(self, block: int, keys: np.ndarray, values: list[np.ndarray]) -> None:
        if len(keys):
            self.held.setdefault(int(block), []).append((keys, values))
            self.size += len(keys)

    def add_docs(self, blocks: np.ndarray, owner: np.ndarray, keys: np.ndarray, values: list[np.ndarray]) -> None:
        """``owner``: the document of each key, ascending; ``blocks``: the block of each document."""
        if not len(keys):
            return
        of_key = blocks[owner]
        cuts = np.flatnonzero(np.diff(of_key)) + 1
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            self.add(of_key[a], keys[a:z], [v[a:z] for v in values])

    def rows(self, force: bool = False) -> Iterator[pa.RecordBatch]:
        if self.size < self.limit and not force:
            return
        for block, parts in self.held.items():
            keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            sums = [
                np.bincount(place, weights=np.concatenate([v[i] for _, v in parts]), minlength=len(keys))
                for i in range(self.n_values)
            ]
            yield ask_rows(self.deal, block, keys, sums)
        self.held, self.size = {}, 0
