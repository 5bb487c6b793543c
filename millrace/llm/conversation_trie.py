"""Prefix trie of conversations by smallest-member ownership.

Conversations that begin with the same turns share the nodes of those turns.  Every node belongs to the smallest
conversation that passes through it, so the nodes that a conversation owns are a suffix of its path, and (owner, depth)
names a node.  A node's identity is the depth and the running exclusive-or of two 64-bit hashes of (place, role, text).

* Windows along each conversation give every turn the identity of its prefix and the tokens from it to the end.
* The owner of a node is a minimum by identity.  A conversation's first owned depth follows from how many nodes it owns,
  and windows of its path are so marked owned or not.
* One group-by of identities then adds up what a subtree needs: each member brings the tokens of its path from here on less
  those of the nodes it owns from here on, whether the next node is its own (a child), and whether it owns a leaf at its end.

Nothing is gathered by node: only counts, sums and minima are, with partial sums before the exchange.  Turns of a conversation
are numbered over ranges and handled in runs of ``RUN``, so a conversation with a third of all turns is dealt over many tasks.
The members that end at a node are first joined in strings of at most ``RUN`` ids, and one task hashes the strings of a node
one after another as they come in order (a SHA-256 cannot be split).

Defined results: rows without a conversation id belong to none; null role or text is empty; turns of one conversation with the
same number are ordered by a hash of role and text, so repeated rows stay beside each other and reruns agree; null turn numbers
come first; an empty table has no node; columns other than the four are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import numbered
from .core import discard, noted, stored

#: Turns of a conversation that one window handles, and ids in one string of ended members.
RUN = 4096
#: Turns of another conversation that may begin one, and how many conversations share such a beginning.
BORROWED, FAMILY = 9, 5


def turns_of(rows: DataFrame) -> DataFrame:
    """``conv``, ``at`` (1, 2, ... in order), two hashes of role and text, and ``tokens`` (bytes of the text): no text moves."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    narrow = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.xxhash64(F.lit(17), role, text).alias("g1"),
        F.xxhash64(F.lit("second"), text, role).alias("g2"), F.octet_length(text).cast("long").alias("tokens"),
    )
    return numbered(narrow, "at", [F.col("turn").asc_nulls_first(), F.col("g1"), F.col("g2")], F.col("conv")).drop("turn")


def rebuilt(turns: DataFrame, borrowed: int = BORROWED, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """Conversations ``c`` with ``len``, and their paths (``c``, ``len``, ``d``, hashes, tokens): the first h turns of the conversation
    ``c - c % family``, then their own after the first h; h is the CRC-32 of c modulo ``borrowed``."""
    h = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(borrowed)).cast("int")
    n = turns.groupBy(F.col("conv").alias("c")).agg(F.count("*").alias("n"))
    known = n.withColumn("h", h).withColumn("root", F.col("c") - F.col("c") % family)
    heads = n.select(F.col("c").alias("root"), F.least("n", F.lit(borrowed)).alias("have"))
    known = known.join(heads, "root", "left").withColumn("p", F.least("h", F.coalesce("have", F.lit(0))))
    known = stored(known.select("c", "root", "n", "h", "p", (F.col("p") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "conversations")
    # A conversation's own turns meet it in runs, so that a long one lies on no single task.
    runs = known.select("*", F.explode(F.sequence(F.lit(0), (F.col("n") / RUN).cast("int"))).alias("run"))
    own = turns.withColumn("run", (F.col("at") / RUN).cast("int")).join(runs, (F.col("conv") == F.col("c")) & (runs["run"] == (F.col("at") / RUN).cast("int")))
    own = own.where("at > h").select("c", "len", (F.col("at") - F.col("h") + F.col("p")).alias("d"), "g1", "g2", "tokens")
    first = turns.where(F.col("at") < borrowed)
    begin = first.join(known, first["conv"] == known["root"]).where("at <= p").select("c", "len", F.col("at").alias("d"), "g1", "g2", "tokens")
    return known.select("c", "len"), own.unionByName(begin)


def paths(turns: DataFrame) -> DataFrame:
    """Adds the identity of each prefix (``k1``, ``k2``), that of the prefix before it (``p1``, ``p2``) and ``rest``, the tokens from this turn to the end."""
    here = turns.withColumn("g1", F.xxhash64("g1", "d")).withColumn("g2", F.xxhash64("d", "g2")).withColumn("run", (F.col("d") / RUN).cast("int"))
    inside = Window.partitionBy("c", "run").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("rc").orderBy("rr").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("rc").orderBy("rr").rowsBetween(1, Window.unboundedFollowing)
    sums = here.groupBy(F.col("c").alias("rc"), F.col("run").alias("rr")).agg(F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2"), F.sum("tokens").alias("t"))
    sums = sums.select("rc", "rr", *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(f"b{x[1]}") for x in ("x1", "x2")], (F.col("t") + F.coalesce(F.sum("t").over(after), F.lit(0))).alias("left"))
    here = here.withColumns({"i1": F.bit_xor("g1").over(inside), "i2": F.bit_xor("g2").over(inside), "gone": F.sum("tokens").over(inside) - F.col("tokens")})
    found = here.join(sums, (F.col("c") == F.col("rc")) & (F.col("run") == F.col("rr")))
    k1, k2 = F.col("i1").bitwiseXOR(F.col("b1")), F.col("i2").bitwiseXOR(F.col("b2"))
    return found.select("c", "len", "d", "run", "tokens", k1.alias("k1"), k2.alias("k2"), k1.bitwiseXOR(F.col("g1")).alias("p1"), k2.bitwiseXOR(F.col("g2")).alias("p2"), (F.col("left") - F.col("gone")).alias("rest"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (e1, e2, ed, part): one digest for each node, of its strings joined by commas."""
    key, digest = None, None

    def done():
        return pa.record_batch({"e1": pa.array([key[0]]), "e2": pa.array([key[1]]), "ed": pa.array([key[2]]), "ends_sha256": pa.array([digest.hexdigest()])})

    for batch in batches:
        for e1, e2, ed, ids in zip(*(batch.column(c).to_pylist() for c in ("e1", "e2", "ed", "ids")), strict=True):
            if key == (e1, e2, ed):
                digest.update(b",")
            else:
                if key is not None:
                    yield done()
                key, digest = (e1, e2, ed), hashlib.sha256()
            digest.update(ids.encode())
    if key is not None:
        yield done()


def ended(ends: DataFrame) -> DataFrame:
    """``e1, e2, ed`` and the digest of the members ``c`` that end at that node, in ascending order."""
    part = F.floor(F.col("c") / RUN)
    strings = ends.groupBy("e1", "e2", "ed", part.alias("part")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x.cast("string")), ",").alias("ids"))
    sorted_ = strings.repartition("e1", "e2", "ed").sortWithinPartitions("e1", "e2", "ed", "part")
    return sorted_.select("e1", "e2", "ed", "ids").mapInArrow(_digests, "e1 long, e2 long, ed long, ends_sha256 string")


def trie(conversations: DataFrame, borrowed: int = BORROWED, family: int = FAMILY) -> DataFrame:
    """One row per node of the rebuilt ``conversations`` (conv_id, turn, role, text), the root included."""
    with noted() as made:
        turns = stored(turns_of(conversations), "turns")
        known, path = rebuilt(turns, borrowed, family)
        path = stored(paths(path), "paths")
        node = ["k1", "k2", "d"]
        # Who owns what: a conversation's owned nodes are a suffix of its path.
        owners = path.groupBy(*node).agg(F.min("c").alias("c"), F.max("len").alias("deepest"), F.max("tokens").alias("tokens"))
        owned = owners.groupBy("c").agg(F.count("*").alias("owns"), F.sum("tokens").alias("kept"), F.max((F.col("deepest") == F.col("d")).cast("long")).alias("leaf"))
        own = known.join(owned, "c", "left").select(
            "c", "len", (F.col("len") - F.coalesce("owns", F.lit(0)) + 1).alias("since"), F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("leaf", F.lit(0)).alias("leaf")
        )
        own = stored(own, "owned")
        runs = own.select("c", "since", "kept", "leaf", F.explode(F.sequence(F.lit(0), (F.col("len") / RUN).cast("int"))).alias("run"))
        marked = path.join(runs, ["c", "run"])
        saves, child = F.greatest(F.col("rest") - F.col("kept"), F.lit(0)), ((F.col("d") < F.col("len")) & (F.col("since") <= F.col("d") + 1)).cast("long")
        totals = [F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(child).alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum(saves).alias("saved_tokens")]
        found = marked.groupBy(*node).agg(*totals, F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max((F.col("since") == F.col("d")).cast("int")).alias("starts"))
        found = stored(found, "nodes")
        root = _root(own, path)
        # A node's parent is its owner's too, unless its owner starts here; then the parent is looked up, and depth 1 hangs on the root.
        above = found.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("d") + 1).alias("d"), F.col("conv_id").alias("over"))
        looked = found.where("starts = 1 and d > 1").join(above, ["p1", "p2", "d"], "left").withColumn("parent_conv_id", F.col("over"))
        first = F.lit(root[0] if root else None).cast("long")
        plain = found.where("starts = 0 or d = 1").withColumn("parent_conv_id", F.when(F.col("d") == 1, first).otherwise(F.col("conv_id")))
        columns = ["k1", "k2", "d", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
        nodes = plain.select(*columns).unionByName(looked.select(*columns))
        if root:
            nodes = nodes.unionByName(conversations.sparkSession.createDataFrame([(0, 0, 0, root[0], None, *root[1:])], "k1 long, k2 long, d long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"))
        ends = path.where("d = len").select(F.col("k1").alias("e1"), F.col("k2").alias("e2"), F.col("d").cast("long").alias("ed"), "c")
        ends = ended(ends.unionByName(known.where("len = 0").select(F.lit(0).cast("long").alias("e1"), F.lit(0).cast("long").alias("e2"), F.lit(0).cast("long").alias("ed"), "c")))
        out = nodes.join(ends, (F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2")) & (F.col("d") == F.col("ed")), "left")
        none = F.lit(hashlib.sha256(b"").hexdigest())
        out = out.select("conv_id", F.col("d").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))
        out = stored(out, "trie")
        discard(*[x for x in made if x != out._millrace_path], spark=out.sparkSession)
    return out


def _root(own: DataFrame, path: DataFrame) -> tuple | None:
    """Owner, conversations, children, leaves and saved tokens of the root; nothing without conversations.  Its tokens are none itself,
    and it is a leaf where no conversation has a turn."""
    first = own.agg(F.min("c"), F.count("*"), F.sum("leaf"), F.sum("kept"), F.sum((F.col("since") == 1).cast("long") * (F.col("len") > 0).cast("long"))).first()
    if not first[1]:
        return None
    whole = path.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    return first[0], first[1], first[4], first[2] or 1, whole - first[3]


def op13_conversation_trie(spark, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))


ORACLE = """
WITH numbered AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
heads AS (SELECT DISTINCT c, c - c % 5 AS root FROM numbered),
bits AS (
  SELECT c, root, list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i::INT, 1))::UBIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], list_transform(range(8), lambda z: 0::UBIGINT)),
      lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)) AS crc
  FROM heads),
h AS (SELECT c, root, (xor(crc, 4294967295::UBIGINT) % 9)::BIGINT AS h FROM bits),
turns AS (
  SELECT h.c, 0 AS part, n.pos, n.role, n.text FROM h JOIN numbered n ON n.c = h.root AND n.pos <= h.h
  UNION ALL
  SELECT h.c, 1, n.pos, n.role, n.text FROM h JOIN numbered n ON n.c = h.c AND n.pos > h.h),
path AS (SELECT c, list({'role': role, 'text': text} ORDER BY part, pos) AS p FROM turns GROUP BY c),
whole AS (SELECT h.c, coalesce(p, []) AS p FROM h LEFT JOIN path USING (c)),
member AS (SELECT c, d AS depth, list_slice(p, 1, d) AS k, len(p) AS n FROM (SELECT *, unnest(range(len(p) + 1)) AS d FROM whole)),
node AS (
  SELECT k, depth, min(c) AS conv_id, count(*) AS n_convs, max(n) AS deepest,
         CASE WHEN depth > 0 THEN (count(*) - 1) * strlen(k[depth].text) ELSE 0 END AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = depth), '')) AS ends_sha256
  FROM member GROUP BY k, depth),
below AS (
  SELECT a.k, sum(b.saved)::BIGINT AS saved_tokens, count(*) FILTER (b.deepest = b.depth) AS n_leaves, count(*) FILTER (b.depth = a.depth + 1) AS n_children
  FROM node a JOIN node b ON b.depth >= a.depth AND list_slice(b.k, 1, a.depth) = a.k GROUP BY a.k)
SELECT node.conv_id, node.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, node.n_convs, n_children, n_leaves, saved_tokens, node.ends_sha256
FROM node JOIN below ON below.k = node.k LEFT JOIN node up ON node.depth > 0 AND up.depth = node.depth - 1 AND up.k = list_slice(node.k, 1, up.depth)
"""
