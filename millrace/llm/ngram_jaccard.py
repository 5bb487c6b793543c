"""Set similarity self-join on word n-grams by vertical partitioning.

All n-grams get one global order, rare ones first: by how often their hash cell occurs in the corpus (a table of
fixed size, filled from every document), then by hash.  The order is cut into fragments that hold equally many
occurrences.  Two sets that are similar enough share an n-gram among the first few of each; those prefixes propose
pairs.  For proposed pairs the overlap is counted in each fragment by itself and summed per pair: first from the
numbers of n-grams in fine fragments, whose smaller ones bound it, then from the n-grams in coarse fragments, which
gives the exact intersection.

Groups of copies: equal sets are one class from the start.  In each bucket of a shared prefix n-gram all classes are
first paired with one hub only, the class with the fewest rarer n-grams.  After that only pairs whose ends are still
in different components are proposed, so no group is expanded into all its pairs, and no link that could join two
components is lost.  Of such a pair the smaller set must hold the n-gram in a shorter prefix (it needs more of its
own members), and the larger one looks only at the sizes its place in the order leaves open: documents that share a
common text but differ elsewhere meet in a bucket and yet propose nothing.

Buckets of common n-grams are split: the occurrence table says how many members a bucket can have at most, and every
``HOT`` of them are a salt of their own, for finding the hub, for pairing and for what a hub is compared with.

Defined results: null, empty or blank text has no n-grams and is linked with nothing; a text with fewer
words than ``size`` has its whole sequence as one n-gram; repeated rows are equal sets; columns other
than the id and the text are ignored.  N-grams and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .core import LOWER, U64, discard, mix, pack, slices, stored, unpack, windows, word_hashes, word_spans

SIZE, NUMERATOR, DENOMINATOR = 3, 90, 100
#: Cells of the occurrence table (4 bytes each), whatever the size of the corpus.
CELL_BITS = 21
#: Cells of the table that travel in one row.
_PIECE = 1 << 14
#: Fragments of the order in which n-grams are compared, and in which their number is.
FRAGMENTS, FINE = 8, 128
#: Members of a bucket, and pairs of a hub, that one task gets.
HOT = 1024
#: Bits of the sieve that spares most documents the last scan's work (2 MB, whatever the size of the corpus).
SIEVE_BITS = 24
#: Sizes of sets are told apart in steps of this factor when pairs are looked for.
_STEP = 1.02


def sets_of(s, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of a slice's documents, ascending in each, and where each document begins."""
    starts, ends, first = word_spans(s.data, s.offsets, LOWER)
    h = word_hashes(s.data, starts, ends, LOWER)
    value, at = windows(h, first, size)
    owner = np.searchsorted(first, at, "right") - 1
    n = np.diff(first)
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        whole = np.zeros(len(short), U64)
        for j, i in enumerate(short.tolist()):
            for x in h[first[i] : first[i + 1]]:
                whole[j] = mix(whole[j : j + 1] * U64(31) + x + U64(n[i]))[0]
        value, owner = np.concatenate([value, whole]), np.concatenate([owner, short])
    by = np.lexsort((value, owner))
    value, owner = value[by], owner[by]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.searchsorted(owner[new], np.arange(len(s) + 1))


def class_of(grams: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One hash for each set, from two sums over its members and its size."""
    sums = [np.concatenate([np.zeros(1, U64), np.cumsum(x, dtype=U64)]) for x in (grams, mix(grams ^ U64(0x5851F42D4C957F2D)))]
    one, two = (x[begin[1:]] - x[begin[:-1]] for x in sums)
    return mix(one + mix(two + np.diff(begin).astype(U64)))


def _tally(size: int, cell_bits: int):
    """A task's part of the occurrence table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << cell_bits, np.uint32)
        any_rows = False
        for batch in batches:
            for s in slices(batch.column("text")):
                np.add.at(cells, (sets_of(s, size)[0] >> U64(64 - cell_bits)).astype(np.int64), 1)
                any_rows = True
        if any_rows:
            for i in range(0, len(cells), _PIECE):
                yield pa.record_batch({"piece": pa.array([i // _PIECE], pa.int32()), "cells": pa.array([pack(cells[i : i + _PIECE])], pa.binary())})

    return run


def _sum_cells(table: pa.Table) -> pa.Table:
    total = 0
    for x in table.column("cells"):
        total = total + unpack(x.as_py())
    return pa.table({"piece": table.column("piece").slice(0, 1), "cells": pa.array([pack(total)], pa.binary())})


def _cells(texts: DataFrame, size: int, cell_bits: int) -> np.ndarray:
    """The whole table at the driver: ``2**cell_bits`` numbers, however large the corpus.  Parts are summed
    in two levels, so no task gets the parts of all others."""
    parts = texts.mapInArrow(_tally(size, cell_bits), "piece int, cells binary").select("piece", "cells", (F.spark_partition_id() % 32).alias("part"))
    for keys in (["piece", "part"], ["piece"]):
        parts = parts.groupBy(*keys).applyInArrow(_sum_cells, "piece int, cells binary")
        if len(keys) == 2:
            parts = parts.withColumn("part", F.lit(0))
    out = np.zeros(1 << cell_bits, np.uint32)
    for r in parts.select("piece", "cells").collect():
        out[r["piece"] * _PIECE : (r["piece"] + 1) * _PIECE] = np.minimum(unpack(bytes(r["cells"])), 0xFFFFFFFF)
    return out


class Order:
    """The global order of n-grams and its cuts."""

    def __init__(self, cells: np.ndarray, cell_bits: int, hot: int) -> None:
        self.cells, self.shift = cells, U64(64 - cell_bits)
        rank = np.lexsort((np.arange(len(cells)), cells))
        before = np.cumsum(cells[rank].astype(np.int64)) - cells[rank]
        self.fragment = np.zeros(len(cells), np.uint8)
        self.fragment[rank] = before * FINE // max(1, int(cells.sum(dtype=np.int64)))
        #: Members of a bucket in one task: ``hot``, or more where cells are so full that they say little of one n-gram.
        self.share = max(hot, 4 * int(cells.mean()))

    def cell(self, grams: np.ndarray) -> np.ndarray:
        return (grams >> self.shift).astype(np.int64)

    def sort(self, grams: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return np.lexsort((grams, self.cells[self.cell(grams)], owner))

    def salts(self, grams: np.ndarray) -> np.ndarray:
        return 1 + self.cells[self.cell(grams)] // self.share


def least_overlap(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Fewest common members of a set of ``n`` with any partner that is similar enough."""
    return -(-num * n // den)


_SETS = "doc_id long, n long, class long, fine array<int>, prefix array<struct<gram:long,place:int,salts:int>>"


def _sets(size: int, num: int, den: int, shared):
    """Each document's set: its size, class, numbers in fine fragments, and its prefix without what no other set has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order: Order = shared.value
        for batch in batches:
            ids = batch.column("doc_id")
            for s in slices(batch.column("text")):
                grams, begin = sets_of(s, size)
                n = np.diff(begin)
                owner = np.repeat(np.arange(len(s)), n)
                fine = np.bincount(owner * FINE + order.fragment[order.cell(grams)], minlength=len(s) * FINE).astype(np.int32)
                first = grams[order.sort(grams, owner)]
                place = np.arange(len(grams)) - begin[owner]
                use = (place < (n - least_overlap(n, num, den) + 1)[owner]) & (order.cells[order.cell(first)] > 1)
                members = [first[use].view(np.int64), place[use].astype(np.int32), order.salts(first[use]).astype(np.int32)]
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner[use], minlength=len(s)))]).astype(np.int32)
                yield pa.record_batch({
                    "doc_id": ids.slice(s.row, len(s)), "n": pa.array(n.astype(np.int64)), "class": pa.array(class_of(grams, begin).view(np.int64)),
                    "fine": pa.ListArray.from_arrays(pa.array(np.arange(0, len(fine) + 1, FINE, dtype=np.int32)), pa.array(fine)),
                    "prefix": pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(m) for m in members], ["gram", "place", "salts"])),
                })

    return run


def _cell(column: str):
    return (F.shiftright(F.xxhash64(column), 64 - SIEVE_BITS) + F.lit(1 << (SIEVE_BITS - 1))).alias("cell")


def _sieve(nodes: DataFrame) -> np.ndarray:
    """Which cells of a table of fixed size (``2**SIEVE_BITS`` bits) the ids in column ``node`` fall into."""
    cell = nodes.select((_cell("node") + 1).alias("cell"))
    parts = cell.groupBy(F.bitmap_bucket_number("cell").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    out = np.zeros((1 << SIEVE_BITS) >> 15, dtype="V4096")
    for r in parts.collect():
        out[r["part"] - 1] = bytes(r["bits"])
    return out.view(np.uint8)


def _let_through(batch: pa.RecordBatch, sieve: np.ndarray) -> pa.RecordBatch:
    cell = batch.column("cell").to_numpy(zero_copy_only=False)
    return batch.filter(pa.array((sieve[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)))


def _sifted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _let_through(batch, shared.value)

    return run


def _segments(size: int, fragments: int, shared_order, shared_sieve):
    """The n-grams of documents that the sieve lets through, cut into the fragments of the order.  The sieve
    lets a few others through as well; no pair names them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, order = shared_sieve.value, shared_order.value
        for batch in batches:
            batch = _let_through(batch, sieve)
            ids = batch.column("node").to_numpy(zero_copy_only=False)
            for s in slices(batch.column("text")):
                grams, begin = sets_of(s, size)
                key = np.repeat(np.arange(len(s)), np.diff(begin)) * fragments + order.fragment[order.cell(grams)].astype(np.int64) * fragments // FINE
                by = np.lexsort((grams, key))
                used, start = np.unique(key[by], return_index=True)
                yield pa.record_batch({
                    "node": pa.array(ids[s.row + used // fragments], pa.int64()), "fragment": pa.array((used % fragments).astype(np.int32)),
                    "grams": pa.ListArray.from_arrays(pa.array(np.append(start, len(by)).astype(np.int32)), pa.array(grams[by].view(np.int64))),
                })

    return run


def _similar(num: int, den: int, shared: str, a: str, b: str):
    """den * |A and B| >= num * |A or B|, in whole numbers."""
    return F.expr(f"{den}L * {shared} >= {num}L * ({a} + {b} - {shared})")


def _may_match(num: int, den: int, a: str, b: str):
    """Whether sets of these sizes, meeting at these places of the order, can still be similar enough."""
    left = f"least({a}n - {a}place, {b}n - {b}place)"
    return F.expr(f"{num + den}L * {left} >= {num}L * ({a}n + {b}n)")


def _step(n: str | Column) -> Column:
    return F.floor(F.log(F.col(n) if isinstance(n, str) else n) / F.lit(math.log(_STEP))).cast("int")


def _salt(node: str, salts: str) -> Column:
    return F.pmod(F.xxhash64(node), F.col(salts)).cast("int")


class _Join:
    """Decides proposed pairs: columns ``x``, ``y``, their sizes ``an``, ``bn`` and ``salts``, into how many parts the
    pairs of ``y`` are dealt.  ``y`` may be the hub of a large bucket, ``x`` has few pairs."""

    def __init__(self, docs: DataFrame, sets: DataFrame, size: int, num: int, den: int, fragments: int, order) -> None:
        self.docs, self.sets, self.size, self.num, self.den, self.fragments, self.order = docs, sets, size, num, den, fragments, order

    def sieve(self, pairs: DataFrame):
        nodes = pairs.select(F.col("x").alias("node")).union(pairs.select("y"))
        return self.docs.sparkSession.sparkContext.broadcast(_sieve(nodes))

    def _both(self, pairs: DataFrame, rows: DataFrame, value: str, *keys: str) -> DataFrame:
        """Pairs with the ``value`` that ``rows`` (by ``node``) have for either end, as ``xv`` and ``yv``."""
        dealt = pairs.groupBy("y").agg(F.max("salts").alias("most"))
        one = rows.select(F.col("node").alias("x"), *keys, F.col(value).alias("xv"))
        two = rows.select(F.col("node").alias("y"), *keys, F.col(value).alias("yv")).join(dealt, "y")
        two = two.select("y", *keys, "yv", F.explode(F.sequence(F.lit(0), F.col("most") - 1)).alias("salt"))
        return pairs.join(one, "x").withColumn("salt", _salt("x", "salts")).join(two, ["y", "salt", *keys])

    def possible(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs whose overlap may be large enough: in no fine fragment can it exceed the smaller number."""
        rows = self.sets.where("n > 0 and doc_id is not null").select("doc_id", _cell("doc_id"), "fine")
        rows = rows.mapInArrow(_sifted(self.sieve(pairs)), rows.schema)
        fine = stored(rows.select(F.col("doc_id").alias("node"), "fine"), f"{name}-fine")
        most = F.aggregate(F.zip_with("xv", "yv", lambda a, b: F.least(a, b)), F.lit(0).cast("long"), lambda n, c: n + c)
        both = self._both(pairs, fine, "fine").withColumn("shared", most).where(_similar(self.num, self.den, "shared", "an", "bn"))
        out = stored(both.select("x", "y", "an", "bn", "salts"), f"{name}-possible")
        discard(fine)
        return out

    def verify(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that are similar, as ``a`` and ``b``."""
        pairs = self.possible(pairs, name)
        texts = self.docs.where("doc_id is not null").select(F.col("doc_id").alias("node"), _cell("doc_id"), "text")
        segments = texts.mapInArrow(_segments(self.size, self.fragments, self.order, self.sieve(pairs)), "node long, fragment int, grams array<long>")
        segments = stored(segments, f"{name}-segments")
        parts = self._both(pairs, segments, "grams", "fragment").select("x", "y", "an", "bn", "fragment", F.size(F.array_intersect("xv", "yv")).alias("part"))
        # Rows that repeat an id repeat its fragments: each counts once.
        each = [F.coalesce(F.max(F.when(F.col("fragment") == f, F.col("part"))), F.lit(0)) for f in range(self.fragments)]
        overlap = parts.groupBy("x", "y", "an", "bn").agg(sum(each[1:], each[0]).cast("long").alias("shared"))
        links = overlap.where(_similar(self.num, self.den, "shared", "an", "bn")).select(F.col("x").alias("a"), F.col("y").alias("b"))
        links = stored(links, f"{name}-links")
        discard(pairs, segments)
        return links


def _buckets(sets: DataFrame) -> DataFrame:
    """Members of prefix n-grams that several classes share: ``gram, salt, salts, node, n, place`` and the hub's ``hub,
    hn, hplace``.  A node stands for a class: the smallest id of its copies."""
    known = sets.where("n > 0 and doc_id is not null")
    nodes = known.groupBy("class").agg(F.min(F.struct("doc_id", "n", "prefix")).alias("one"))
    rows = nodes.select(F.col("one.doc_id").alias("node"), F.col("one.n").cast("int").alias("n"), F.explode("one.prefix").alias("p"))
    rows = rows.select("p.gram", "p.place", "p.salts", "node", "n").withColumn("salt", _salt("node", "salts"))
    mine = Window.partitionBy("gram", "salt")
    rows = rows.withColumn("m", F.count("*").over(mine)).withColumn("hub", F.min(F.struct("place", "n", "node")).over(mine))
    rows = stored(rows.where("m > 1 or salts > 1"), "salted")
    whole = rows.where("salts = 1")
    # The salts of one n-gram agree on a hub; it comes back to each of them.
    agreed = rows.where("salts > 1").groupBy("gram", "salts").agg(F.min("hub").alias("hub"), F.count("*").alias("m")).where("m > 1")
    agreed = agreed.select("gram", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "hub", "m")
    split = rows.where("salts > 1").drop("hub", "m").join(agreed, ["gram", "salt"])
    names = ["gram", "salt", "salts", "node", "n", "place", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hn"), F.col("hub.place").alias("hplace")]
    out = whole.select(*names).unionByName(split.select(*names))
    out._millrace_path = rows._millrace_path
    return out


def _pairs_left(meeting: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of one bucket, other than with its hub, whose labels differ and whose sizes and places leave room for
    enough common members."""
    mixed = meeting.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).drop("hn", "hplace")
    # Buckets with more than one label; their range of labels is found salt by salt.
    ends = mixed.groupBy("gram", "salt", "salts").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    ends = ends.groupBy("gram", "salts").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
    mixed = mixed.join(ends.select("gram", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")), ["gram", "salt"]).where("node <> hub")
    # A larger partner leaves the smaller set fewer places; a smaller one cannot be less than num / den of the larger.
    small = mixed.where(F.expr(f"{num + den}L * (n - place) >= {2 * num}L * n"))
    small = small.select("gram", "salt", _step("n").alias("step"), *[F.col(c).alias(f"a{c}") for c in ("node", "n", "place", "label")])
    least = F.ceil(F.col("n") * num / den)
    most = F.least(F.col("n").cast("long"), F.floor(F.expr(f"{num + den}L * (n - place) / {num}L")) - F.col("n"))
    large = mixed.withColumn("least", least).withColumn("most", most).where("least <= most")
    large = large.select(
        "gram", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.sequence(_step("least"), _step("most")).alias("steps"),
        *[F.col(c).alias(f"b{c}") for c in ("node", "n", "place", "label")],
    ).withColumn("step", F.explode("steps")).drop("steps")
    pairs = small.join(large, ["gram", "salt", "step"]).where("an < bn or (an = bn and anode < bnode)")
    return pairs.where("alabel <> blabel").where(_may_match(num, den, "a", "b")).select(F.col("anode").alias("x"), F.col("bnode").alias("y"), "an", "bn").distinct()


def similar_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
    numerator: int = NUMERATOR, denominator: int = DENOMINATOR, cell_bits: int = CELL_BITS, fragments: int = FRAGMENTS, hot: int = HOT,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by
    links of similarity ``numerator / denominator`` or more."""
    if not 2 * numerator > denominator:
        raise ValueError("the threshold must be over one half")
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = spark.sparkContext.broadcast(Order(_cells(docs.select("text"), size, cell_bits), cell_bits, hot))
    sets = stored(docs.mapInArrow(_sets(size, numerator, denominator, order), _SETS), "sets")
    meeting = _buckets(sets)
    join = _Join(docs, sets, size, numerator, denominator, fragments, order)
    star = (
        meeting.where("node <> hub").where(_may_match(numerator, denominator, "", "h"))
        .groupBy(F.col("node").alias("x"), F.col("hub").alias("y"), F.col("n").alias("an"), F.col("hn").alias("bn")).agg(F.max("salts").alias("salts"))
    )
    star = stored(star, "star")
    links = join.verify(star, "star")
    labels = stored(components(links), "labels")
    rest = _pairs_left(meeting, labels, numerator, denominator).withColumn("salts", F.lit(1))
    rest = stored(rest, "rest")
    discard(meeting, star)
    if not rest.isEmpty():
        more = join.verify(rest, "rest")
        if not more.isEmpty():
            discard(labels)
            labels = stored(components(links.unionByName(more)), "labels")
        discard(more)
    discard(rest, links)
    own = sets.where("n > 0 and doc_id is not null")
    reps = own.groupBy("class").agg(F.min("doc_id").alias("node"))
    final = stored(reps.join(labels, "node", "left").select("class", F.coalesce("label", "node").alias("label")), "classes")
    discard(labels)
    linked = own.join(final, "class").select("doc_id", F.col("n").alias("n_shingles"), F.col("label").alias("component_id"))
    alone = sets.where("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    out = stored(linked.unionByName(alone), "components")
    discard(sets, final)
    return out


def op3_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return similar_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = """
WITH texts AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM texts WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
ends AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (WITH RECURSIVE r AS (SELECT a, b FROM ends UNION SELECT r.a, ends.b FROM r JOIN ends ON r.b = ends.a) SELECT * FROM r)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, least(doc_id, min(b)) AS component_id FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON a = doc_id GROUP BY doc_id
"""
