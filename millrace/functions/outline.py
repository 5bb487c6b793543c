"""What listing pages are read by: marked elements, anchors, strings and data blocks, one parse per page."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import UNREAD, Node, Tree

SCHEMA = "h1 string, marked array<struct<tag:string,cls:string,text:string>>, anchors array<struct<href:string,text:string>>, strings array<string>, data string"
# Parts of class names that mark a field of a paper, product or company.
MARKS = ["title", "name", "abstract", "mathjax", "date", "submitted", "category", "subject", "author", "description", "tagline", "votes", "tag", "about", "bio"]


def _own_text(node: Node) -> str:
    """The element's strings, each stripped, joined without a separator."""
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x.strip())
        elif x.tag not in UNREAD:
            stack.extend(reversed(x.parts))
    return "".join(out)


def read(html: str | None) -> dict:
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    h1, data = None, None
    marked, anchors, strings = [], [], []
    for n in list(tree.root.walk()):
        cls = n.attrs.get("class", "")
        if n.tag == "h1" and h1 is None:
            h1 = _own_text(n)
        if cls and any(m in cls for m in MARKS):
            marked.append({"tag": n.tag, "cls": cls, "text": _own_text(n)})
        if n.tag == "a" and n.attrs.get("href"):
            anchors.append({"href": n.attrs["href"], "text": _own_text(n)})
        if n.tag == "script" and data is None and n.attrs.get("type") == "application/ld+json":
            data = "".join(p for p in n.parts if isinstance(p, str)).strip()
        if n.tag not in UNREAD:
            strings += [p.strip() for p in n.parts if isinstance(p, str) and p.strip()]
    return {"h1": h1, "marked": marked, "anchors": anchors, "strings": strings, "data": data}


def _outline(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read(x) for x in html], columns=["h1", "marked", "anchors", "strings", "data"])


_outline.__annotations__ = {"html": pd.Series, "return": pd.DataFrame}


def outline(html: Column) -> Column:
    """Struct of a listing page; nondeterministic for the same reason as ``html.page``."""
    return F.pandas_udf(_outline, SCHEMA).asNondeterministic()(html)


def all_marked(page: Column, classes: str) -> Column:
    """Texts of the elements whose class matches the pattern, in order."""
    return F.transform(F.filter(page["marked"], lambda m: m["cls"].rlike(classes)), lambda m: m["text"])


def first_marked(page: Column, classes: str, tag: str | None = None) -> Column:
    hits = F.filter(page["marked"], lambda m: m["cls"].rlike(classes) & (F.lit(True) if tag is None else m["tag"] == tag))
    return F.get(hits, F.lit(0))["text"]


def first_anchor(page: Column, text: str) -> Column:
    """Where the first anchor leads whose text matches the pattern."""
    return F.get(F.filter(page["anchors"], lambda a: a["text"].rlike(text)), F.lit(0))["href"]


def first_string(page: Column, pattern: str) -> Column:
    return F.get(F.filter(page["strings"], lambda s: s.rlike(pattern)), F.lit(0))
