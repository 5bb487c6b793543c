"""HTML read once per page, into one struct, by the standard library's parser in an Arrow batch UDF."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BLANKS

FIELDS = {
    "title": "string", "headings": "array<string>", "paragraphs": "array<string>", "clean_text": "string", "main": "string", "meta": "map<string,string>",
    "json_ld": "string", "dates": "array<struct<value:string,confidence:double,source:string>>", "links": "array<string>", "images": "array<string>", "marked": "map<string,string>",
}
VOID = {"meta", "link", "br", "img", "hr", "input", "area", "base", "col", "embed", "source", "track", "wbr"}
#: Tags whose start ends an open paragraph.
BLOCKS = {"p", "div", "article", "section", "main", "nav", "header", "footer", "aside", "ul", "ol", "li", "table", "form", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figure"}
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
# Elements without readable text, class and id words of page furniture, where the main text is, names of
# dates in the head, classes that mark what news and job pages say of themselves.
UNREAD = {"script", "style", "noscript", "iframe", "svg"}
CLASS_WORDS = {"ad", "ads", "advertisement", "analytics", "tracking", "banner", "sidebar", "navbar", "nav"}
ID_WORDS = {"ad", "ads", "advertisement", "analytics", "tracking"}
MAIN = ["main", "article", ".main", ".content", ".article", ".post", "[role=main]", "#content", "#main"]
DATE_META = ["article:published_time", "published_time", "date", "pubdate", "publish_date"]
MARKED = {
    "author": [".author", ".byline", ".post-author", ".article-author"],
    "company": [".company", ".company-name", ".employer", ".organization"],
    "location": [".location", ".job-location", ".address"],
    "apply": [".apply-button", ".apply-link"],
}


class Node:
    __slots__ = ("tag", "attrs", "parts", "up")

    def __init__(self, tag: str, attrs: dict[str, str], up: "Node | None") -> None:
        self.tag, self.attrs, self.up = tag, attrs, up
        self.parts: list[Node | str] = []

    def walk(self):
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed([p for p in node.parts if isinstance(p, Node)]))

    def text(self, skip=frozenset()) -> str:
        out, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag not in UNREAD and id(x) not in skip:
                stack.extend(reversed(x.parts))
        return "".join(out)

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def fits(self, selector: str) -> bool:
        if selector[0] == ".":
            return selector[1:] in self.classes()
        if selector[0] == "#":
            return self.attrs.get("id") == selector[1:]
        if selector[0] == "[":
            name, _, value = selector[1:-1].partition("=")
            return self.attrs.get(name) == value
        return self.tag == selector


class Tree(HTMLParser):
    """Void elements have no children, block tags end an open paragraph, stray end tags are ignored."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self._close("p")
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.parts.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(tag)

    def handle_endtag(self, tag: str) -> None:
        self._close(tag)

    def _close(self, tag: str) -> None:
        node = self.at
        while node.up is not None and node.tag != tag:
            node = node.up
        if node.up is not None:
            self.at = node.up

    def handle_data(self, data: str) -> None:
        self.at.parts.append(data)


def blanks(x: str) -> str:
    for pattern, to in BLANKS:
        x = re.sub(pattern, to, x)
    return x.strip()


def _words(x: str, known: set[str], whole: bool) -> bool:
    parts = re.split(r"[^a-z]+", x.lower())
    return any(p in known for p in parts) if whole else any(w in x.lower() for w in known)


_TITLE_ENDS = re.compile(r"</title\s*>", re.I)


def read(html: str | None, whole_words: bool = True, fields: frozenset[str] = frozenset(FIELDS)) -> dict:
    """The wanted ``fields`` of a page.  ``whole_words``: furniture is told by whole words of classes and ids;
    otherwise by parts of words.  For the title alone no more is parsed than what leads to its end."""
    html = html or ""
    if fields == {"title"} and (end := _TITLE_ENDS.search(html)):
        name = _title_element(_parsed(html[: end.end()])[1])
        if name:
            return {"title": name}
    tree, body = _parsed(html)
    made = {}

    def furniture() -> set[int]:
        return {
            id(n) for n in body
            if n.tag in ("nav", "footer", "header") or _words(n.attrs.get("class", ""), CLASS_WORDS, whole_words) or _words(n.attrs.get("id", ""), ID_WORDS, whole_words)
        }

    if fields & {"clean_text", "main"}:
        skip = furniture()
        made["clean_text"] = blanks(tree.root.text(skip))
    if fields & {"paragraphs", "main"}:
        made["paragraphs"] = [t for n in body if n.tag == "p" for t in [n.text().strip()] if t]
    if "main" in fields:
        main = next((t for s in MAIN for n in body if n.fits(s) for t in [n.text(skip - {id(n)}).strip()] if len(t) > 100), None)
        made["main"] = main or "\n\n".join(made["paragraphs"]) or made["clean_text"]
    if "title" in fields:
        made["title"] = _title(html, body)
    if "headings" in fields:
        made["headings"] = [n.text().strip() for n in body if n.tag in HEADINGS]
    if fields & {"meta", "json_ld", "dates"}:
        made["meta"], made["json_ld"], made["dates"] = _metadata(body)
    if "links" in fields:
        made["links"] = [n.attrs["href"] for n in body if n.tag == "a" and n.attrs.get("href")]
    if "images" in fields:
        made["images"] = [n.attrs["src"] for n in body if n.tag == "img" and n.attrs.get("src")]
    if "marked" in fields:
        found = {k: next((n for s in v for n in body if n.fits(s)), None) for k, v in MARKED.items()}
        made["marked"] = {k: n.text().strip() or n.attrs.get("href", "") for k, n in found.items() if n is not None}
    return {k: made[k] for k in fields}


def _parsed(html: str) -> tuple[Tree, list[Node]]:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree, list(tree.root.walk())[1:]


def _title_element(body: list[Node]) -> str:
    title = next((n for n in body if n.tag == "title"), None)
    return title.text().strip() if title is not None and not any(isinstance(p, Node) for p in title.parts) else ""


def _title(html: str, body: list[Node]) -> str:
    """The title's text; without one that of the first heading, then the first text of some length."""
    name = _title_element(body)
    name = name or next((x for t in (("h1",), ("h1", "h2", "h3")) for x in [n.text().strip() for n in body if n.tag in t][:1] if x), "")
    if not name and html.strip():
        name = next((p.strip()[:200] for n in body if n.tag not in UNREAD for p in n.parts if isinstance(p, str) and len(p.strip()) > 10), "Untitled")
    return name


def _metadata(body: list[Node]) -> tuple[dict, str | None, list]:
    meta: dict[str, str] = {}
    dates, ld, ld_dates = [], None, []
    for n in body:
        if n.tag == "time" and n.attrs.get("datetime"):
            dates.append({"value": n.attrs["datetime"], "confidence": 0.95, "source": "time_element"})
        elif n.tag == "script" and n.attrs.get("type") == "application/ld+json":
            try:
                data = json.loads("".join(p for p in n.parts if isinstance(p, str)))
            except ValueError:
                continue
            item = data[0] if isinstance(data, list) and data else data
            if isinstance(item, dict):
                ld = json.dumps(item, ensure_ascii=False)
                ld_dates += [{"value": str(item[k]), "confidence": 0.95, "source": "json_ld"} for k in ("datePublished", "dateCreated", "dateModified") if item.get(k)]
        elif n.tag == "meta":
            prop, value = n.attrs.get("property", ""), n.attrs.get("content", "")
            if prop.startswith("og:"):
                meta["og_" + prop[3:].lower()] = value
            key = n.attrs.get("name") or n.attrs.get("http-equiv")
            if key:
                meta["meta_" + key.lower()] = value
        elif n.tag == "link" and n.attrs.get("rel") == "canonical" and n.attrs.get("href"):
            meta["canonical_url"] = n.attrs["href"]
    named = {(n.attrs.get("name") or n.attrs.get("property", "")): n.attrs.get("content", "") for n in reversed(body) if n.tag == "meta"}
    meta_dates = [{"value": named[k], "confidence": 0.9, "source": "meta"} for k in DATE_META if named.get(k)]
    ld_item = json.loads(ld) if ld else {}
    published = next((x for x in (ld_item.get("datePublished"), ld_item.get("dateCreated"), *(meta.get(k) for k in ("og_published_time", "og_published", "meta_published", "meta_date"))) if x), None)
    if published:
        meta["published_date"] = str(published)
    return meta, ld, dates + ld_dates + meta_dates


def page(html: Column, *fields: str) -> Column:
    """Struct of the named fields of a page, all of them if none is named.  Marked nondeterministic so that no plan
    reads a page twice."""
    names = list(fields or FIELDS)
    wanted = frozenset(names)

    def run(html: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read(x, fields=wanted) for x in html], columns=names)

    run.__annotations__ = {"html": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, ", ".join(f"{k} {FIELDS[k]}" for k in names)).asNondeterministic()(html)
