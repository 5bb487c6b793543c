"""Token-bounded chunks: headings, then paragraphs, then sentences, then characters."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import CHARS_PER_TOKEN


def _tokens(x: str) -> int:
    return len(x) // CHARS_PER_TOKEN


#: How texts are cut, and what joins the pieces again while they fit: markdown headings, HTML headings, paragraphs, sentences.
WAYS = [(r"\n(?=\s*#{1,6}\s+\S)", None), (r"(?i)(?=<h[1-6][\s>])", None), (r"\n{2,}", "\n\n"), (r"(?<=[.!?])\s+", " ")]


def _packed(pieces: Iterable[str], glue: str, limit: int) -> Iterator[str]:
    """Greedy: pieces join while the whole stays in the limit.  Only lengths are added up until a chunk is whole."""
    held, size = [], 0
    for p in pieces:
        both = size + len(glue) + len(p)
        if held and both // CHARS_PER_TOKEN > limit:
            yield glue.join(held)
            held, size = [p], len(p)
        else:
            size = both if held else len(p)
            held.append(p)
    if held:
        yield glue.join(held)


def pieces(text: str, limit: int, way: int = 0) -> Iterator[str]:
    """Pieces of at most ``limit`` tokens each, one after another.  A text is looked at once for each way of cutting."""
    if _tokens(text) <= limit:
        yield text
        return
    for i in range(way, len(WAYS)):
        pattern, glue = WAYS[i]
        cut = [p.strip() for p in re.split(pattern, text) if p.strip()]
        if len(cut) > 1:
            whole = (q for p in cut for q in pieces(p, limit, i))
            yield from whole if glue is None else _packed(whole, glue, limit)
            return
    size = limit * CHARS_PER_TOKEN
    yield from (text[i : i + size] for i in range(0, len(text), size))


def split_text(text: str, limit: int) -> list[str]:
    return list(pieces(text, limit))


@F.udtf(returnType="chunk_no int, chunk string")
class Chunks:
    """A text's chunks as rows, each with the end of the one before in front; null has none.  Only the chunk that is being made is held beside the text."""

    def eval(self, text: str, limit: int, overlap: int):
        if text is None:
            return
        room, before = limit if _tokens(text) <= limit else limit - overlap, ""
        for i, own in enumerate(pieces(text, room)):
            yield i, before + own
            before = own[-overlap * CHARS_PER_TOKEN :] if overlap else ""


def chunks(text: Column, limit: int = 6000, overlap: int = 300) -> Column:
    """Array of chunks without overlap, each small enough that the overlap fits in front of it."""

    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda s: None if s is None else split_text(s, limit if _tokens(s) <= limit else limit - overlap))

    run.__annotations__ = {"x": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, T.ArrayType(T.StringType()))(text)


def reduced(pieces: Column, limit: int, overlap: int = 300) -> Column:
    """An array of chunks in which those over the limit are cut again as texts of their own; the others stay."""

    def run(x: pd.Series) -> pd.Series:
        def one(chunk: str) -> list[str]:
            if _tokens(chunk) <= limit:
                return [chunk]
            own = split_text(chunk, max(1, limit - overlap))
            return [(own[i - 1][-overlap * CHARS_PER_TOKEN :] if i and overlap else "") + c for i, c in enumerate(own)]

        return x.map(lambda cs: None if cs is None else [c for chunk in cs for c in one(chunk)])

    run.__annotations__ = {"x": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, T.ArrayType(T.StringType()))(pieces)


def chunked(docs: DataFrame, key: str, text: str, limit: int = 6000, overlap: int = 300) -> DataFrame:
    """One row per chunk: key, ``chunk_no`` and ``chunk``, which begins with the end of the chunk before."""
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    made = rows.lateralJoin(Chunks(F.col("__text").outer(), F.lit(limit), F.lit(overlap)))
    return made.select(F.col("__key").alias(key), "chunk_no", "chunk")


def register(spark: SparkSession, name: str = "chunks") -> None:
    """The chunker for SQL: ``SELECT ... FROM docs, LATERAL chunks(text, 6000, 300)``."""
    spark.udtf.register(name, Chunks)


def overlapped(pieces: DataFrame, key: str, order: str, text: str, overlap: int) -> DataFrame:
    """Pieces with the last ``overlap`` tokens of the piece before in front."""
    w = Window.partitionBy(key).orderBy(order)
    before = F.coalesce(F.right(F.lag(text).over(w), F.lit(overlap * CHARS_PER_TOKEN)), F.lit(""))
    return pieces.select(key, order, F.concat(before, text).alias("chunk"))


def merged(results: DataFrame, key: str, order: str, texts: list[str], others: list[str]) -> DataFrame:
    """Results of a text's chunks as one: the longest string (the earliest of equals), else the last value."""
    longest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(F.length(c), -F.col(order)))).alias(c) for c in texts]
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in others]
    return results.groupBy(key).agg(*longest, *last)
