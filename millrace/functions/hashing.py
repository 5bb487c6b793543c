"""Content hashes, vectors and JSON repair."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import url as U


def content_hash(x: Column) -> Column:
    """SHA-256 of bytes or of UTF-8 text."""
    return F.sha2(x, 256)


def url_hash(x: Column) -> Column:
    return F.sha2(U.lightly_normalized(x), 256)


@F.pandas_udf(T.StringType())
def dict_hash(x: pd.Series) -> pd.Series:
    """SHA-256 of a JSON object with its keys sorted; null if it is none."""
    import hashlib

    def one(s):
        try:
            return hashlib.sha256(json.dumps(json.loads(s), sort_keys=True, default=str).encode()).hexdigest()
        except (TypeError, ValueError):
            return None

    return x.map(one)


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision; null if a vector is zero or the lengths differ."""
    zero = F.lit(0.0)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), zero, lambda s, x: s + x)

    def norm(v: Column) -> Column:
        return F.sqrt(F.aggregate(v, zero, lambda s, x: s + x.cast("double") * x.cast("double")))

    return F.when(F.size(a) == F.size(b), F.try_divide(dot, norm(a) * norm(b)))


def json_body(reply: Column) -> Column:
    """What stands in a reply's first code fence, or the whole reply, trimmed."""
    fenced = F.regexp_extract(reply, r"(?s)```(?:json)?\s*(.*?)```", 1)
    return F.trim(F.when(fenced != "", fenced).otherwise(reply))


def json_repaired(x: Column) -> Column:
    """Trailing commas dropped, single quotes doubled, bare keys quoted."""
    x = F.regexp_replace(x, r",\s*}", "}")
    x = F.replace(F.regexp_replace(x, r",\s*]", "]"), F.lit("'"), F.lit('"'))
    return F.regexp_replace(x, r"([{,])\s*([A-Za-z_][A-Za-z0-9_]*)\s*:", '$1 "$2":')


def parsed_reply(reply: Column) -> Column:
    """A reply as VARIANT: as it is, else repaired, else null."""
    body = json_body(reply)
    return F.coalesce(F.try_parse_json(body), F.try_parse_json(json_repaired(body)))
