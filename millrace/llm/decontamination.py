"""Benchmark decontamination with one Aho-Corasick automaton.

Windows of ``WINDOW`` words of every test item (or the whole item, where it is shorter) form one automaton over
normalised text: A-Z lower-cased, everything but letters, digits and non-ASCII bytes a break between words.  Its letters
are whole words, numbered by the vocabulary of the items, so a window is a path of ten nodes and not of sixty.  Each
document is scanned once; matches are word ranges, which are mapped to byte spans of the original.

A worker builds an automaton once and keeps it for its later tasks.  Its size is bounded: items are cut into pieces (that
overlap, so that no window is lost), and pieces of at most ``AUTOMATON_WORDS`` words in all go into one automaton, which
makes ``WINDOW`` nodes of some 60 bytes for each.  A larger benchmark takes several passes, one automaton at a time; each
writes the rows with the hits so far to the shared folder for the next.  The driver holds the pieces of one pass.

Defined results: null text, or text without words, has no hits; items without words count nowhere; items that repeat an
id are one item with all their windows; windows of items without an id are hits, but no item is named for them; repeated
rows are judged each by itself; columns other than the id and the text are ignored.  Words are told apart by 64-bit
hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .core import ALNUM, discard, slices, stored, word_hashes, word_spans

WINDOW = 10
#: Most words of items in one automaton.
AUTOMATON_WORDS = 400_000
#: Most words of a piece of an item.
PIECE = 20_000


def _pieces(window: int, most: int):
    """Hashes of the words of each item, in pieces that overlap by a window less a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column("text")):
                starts, ends, first = word_spans(s.data, s.offsets, ALNUM)
                h = word_hashes(s.data, starts, ends, ALNUM).view(np.int64)
                names, parts = [], []
                for i, name in enumerate(batch.column("item").slice(s.row, len(s)).to_pylist()):
                    a, z = int(first[i]), int(first[i + 1])
                    step = most - window + 1
                    for b in range(a, max(z - window + 1, a + 1), step) if z > a else ():
                        names.append(name)
                        parts.append(h[b : min(b + most, z)])
                yield pa.record_batch({"item": pa.array(names, pa.string()), "words": pa.array(parts, pa.list_(pa.int64()))})

    return run


class Automaton:
    """Finds windows among numbered words."""

    _made: "tuple[str, Automaton] | None" = None

    def __init__(self, pieces: list[tuple[str | None, np.ndarray]], window: int = WINDOW) -> None:
        every = np.concatenate([w for _, w in pieces]) if pieces else np.zeros(0, np.int64)
        self.vocabulary = np.unique(every)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        place: dict[tuple[int, ...], int] = {}
        owners: list[set[str]] = []
        for item, words in pieces:
            own = (np.searchsorted(self.vocabulary, words) + 1).tolist()
            for i in range(max(1, len(own) - window + 1)):
                key = tuple(own[i : i + window])
                at = place.setdefault(key, len(place))
                if at == len(owners):
                    owners.append(set())
                    self.automaton.add_word(key, at)
                if item is not None:
                    owners[at].add(item)
        self.length = np.array([len(k) for k in place], np.int64)
        shared: dict[frozenset, frozenset] = {}
        self.owners = [shared.setdefault(f, f) for f in map(frozenset, owners)]
        if place:
            self.automaton.make_automaton()

    @classmethod
    def of(cls, shared) -> "Automaton":
        """The automaton of a broadcast value, made once by each worker."""
        token = shared.value[0]
        if cls._made is None or cls._made[0] != token:
            cls._made = None  # the last one goes before the next is built
            cls._made = (token, cls(*shared.value[1:]))
        return cls._made[1]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Numbers of words by their hashes; 0 for words that no item has."""
        if not len(self.vocabulary):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at + 1, 0)

    def scan(self, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, frozenset[str]]]:
        """Every window in the texts of a slice: its text, first word, word after the last, and items."""
        if not len(self.length):
            return
        # A break after each text: no window goes on in the next.
        texts = np.repeat(np.arange(len(first) - 1), np.diff(first))
        letters = np.zeros(len(h) + len(first), np.int64)
        letters[np.arange(len(h)) + texts] = self.numbers(h)
        # Runs of words that items have; one that is shorter than every window leads the automaton nowhere.
        edge = np.diff((letters > 0).astype(np.int8), prepend=0)
        begin, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
        long = end - begin >= self.length.min()
        size = (end - begin)[long] + 1  # with the break behind it
        place = np.repeat(begin[long] - np.cumsum(size) + size, size) + np.arange(size.sum())
        breaks = first[1:] + np.arange(len(first) - 1)
        for e, at in self.automaton.iter(tuple(letters[place].tolist())):
            i = int(np.searchsorted(breaks, place[e]))
            last = int(place[e]) - i + 1
            yield i, int(last - self.length[at]), last, self.owners[at]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


_HITS = "n_words long, spans array<struct<first:long,last:long,start:long,end:long>>, items array<string>"
_SPANS = pa.list_(pa.struct([(k, pa.int64()) for k in ("first", "last", "start", "end")]))


def _scan(shared, text: str, more: bool):
    """``more``: the rows have hits of an earlier pass, which are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton.of(shared)
        for batch in batches:
            rows = batch.column("row")
            for s in slices(rows.field(text)):
                starts, ends, first = word_spans(s.data, s.offsets, ALNUM)
                covered: dict[int, list[tuple[int, int]]] = {}
                ids: dict[int, set[str]] = {}
                if more:
                    for i, (spans, items) in enumerate(zip(*(batch.column(c).slice(s.row, len(s)).to_pylist() for c in ("spans", "items")), strict=True)):
                        if spans:
                            covered[i], ids[i] = [(int(first[i]) + x["first"], int(first[i]) + x["last"]) for x in spans], set(items)
                for i, a, z, owners in automaton.scan(word_hashes(s.data, starts, ends, ALNUM).view(np.int64), first):
                    covered.setdefault(i, []).append((a, z))
                    ids.setdefault(i, set()).update(owners)
                spans = [
                    [{"first": a - int(first[i]), "last": z - int(first[i]), "start": int(starts[a] - s.offsets[i]), "end": int(ends[z - 1] - s.offsets[i])} for a, z in merged(covered.get(i, []))]
                    for i in range(len(s))
                ]
                yield pa.record_batch({
                    "row": rows.slice(s.row, len(s)), "n_words": pa.array(np.diff(first)), "spans": pa.array(spans, _SPANS),
                    "items": pa.array([sorted(ids.get(i, ())) for i in range(len(s))], pa.list_(pa.string())),
                })

    return run


def _passes(pieces: DataFrame, limit: int) -> Iterator[list[tuple[str | None, np.ndarray]]]:
    """Pieces for one automaton after another: as many as ``limit`` words allow.  At least one pass."""
    held: list[tuple[str | None, np.ndarray]] = []
    size = 0
    for r in pieces.toLocalIterator():
        if held and size + len(r["words"]) > limit:
            yield held
            held, size = [], 0
        held.append((r["item"], np.array(r["words"], np.int64)))
        size += len(r["words"])
    yield held


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, limit: int = AUTOMATON_WORDS,
) -> DataFrame:
    """One row per document row: ``row`` (all its columns), ``n_words``, ``spans`` (disjoint ranges of hit
    words ``first`` to before ``last``, and their bytes ``start`` to before ``end`` in the original UTF-8 text)
    and ``items`` (ids of the items met, as sorted strings)."""
    spark = docs.sparkSession
    items = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    pieces = items.mapInArrow(_pieces(window, max(window, min(PIECE, limit))), "item string, words array<long>")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string(_HITS).fields])
    out = before = None
    for chosen in _passes(pieces, limit):
        if out is not None:  # the rows with the hits so far, for one more pass
            before, last = stored(out, "leaks"), before
            rows = before
            if last is not None:
                discard(last)
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, chosen, window))
        out = rows.mapInArrow(_scan(shared, text_col, before is not None), schema)
    return out


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digest(find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""
WITH items AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS key
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
starts AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS key
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs JOIN (SELECT DISTINCT n FROM windows) ON len(w) >= n)),
met AS MATERIALIZED (SELECT r, i, n, item FROM starts JOIN windows USING (n, key)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM met) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM met WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
