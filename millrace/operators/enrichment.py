"""Papers and their repositories; feeds and replies as rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.url import path, repo_url, repo_urls

# Base confidence, a repository named like the title, an author in its address.
BASE, NAMED, AUTHOR = 0.5, 0.3, 0.1


def candidates(explicit: Column, *texts: Column) -> Column:
    """Repository addresses a paper names, normalized and distinct."""
    found = F.concat(F.array(explicit), *[F.coalesce(repo_urls(t), F.array().cast("array<string>")) for t in texts])
    return F.array_distinct(F.transform(F.filter(found, lambda u: u.isNotNull() & (u != "")), repo_url))


def confidence(repo: Column, title: Column, authors: Column) -> Column:
    where = F.lower(F.regexp_replace(path(repo), "^/+|/+$", ""))
    name, t = F.element_at(F.split(where, "/"), -1), F.lower(F.coalesce(title, F.lit("")))
    named = F.when((t != "") & (name != "") & (F.contains(t, name) | F.contains(name, t)), NAMED).otherwise(0.0)
    n = F.coalesce(F.size(F.filter(authors, lambda a: F.contains(where, F.lower(a)))), F.lit(0))
    return F.round(F.least(F.lit(BASE) + named + F.lit(AUTHOR) * F.greatest(n, F.lit(0)), F.lit(1.0)), 4)


#: Columns of papers in which repositories are looked for, where they are there.
TEXTS = ["title", "abstract", "description", "body", "content"]


def named_in_metadata(metadata: Column) -> Column:
    """Repositories in metadata: the field ``github_url`` of a JSON object, else whatever a text names."""
    given = F.try_variant_get(F.try_parse_json(metadata), "$.github_url", "string")
    return F.when(given.isNotNull(), F.array(given)).otherwise(F.coalesce(repo_urls(metadata), F.array().cast("array<string>")))


def all_candidates(papers: DataFrame) -> Column:
    """Candidates from everything that the papers have: ``github_url``, the columns in ``TEXTS``, and ``metadata``."""
    found = candidates(F.col("github_url") if "github_url" in papers.columns else F.lit(None).cast("string"), *[F.col(t) for t in TEXTS if t in papers.columns])
    if "metadata" not in papers.columns:
        return found
    return F.array_distinct(F.concat(found, F.transform(named_in_metadata(F.col("metadata")), repo_url)))


def enriched(papers: DataFrame, repos: DataFrame) -> DataFrame:
    """``papers`` (paper_id, title, authors and what ``all_candidates`` reads) with the known repository of highest
    confidence, the address that sorts last among equals; nulls if none is known."""
    pairs = papers.select("paper_id", "title", "authors", F.explode(all_candidates(papers)).alias("repository_url"))
    scored = pairs.join(repos, "repository_url").withColumn("confidence", confidence(F.col("repository_url"), F.col("title"), F.col("authors")))
    best = scored.groupBy("paper_id").agg(F.max_by(F.struct("repository_url", "stars", "confidence"), F.struct("confidence", "repository_url")).alias("b"))
    return papers.select("paper_id").join(best, "paper_id", "left").select(
        "paper_id", F.col("b.repository_url").alias("github_url"), F.col("b.stars").alias("github_stars"), F.col("b.confidence").alias("github_match_confidence")
    )


def feed_urls(xml: Column) -> Column:
    """Page addresses of an Atom feed's entries, without versions."""
    entries = F.from_xml(xml, "entry array<struct<id:string>>")["entry"]
    return F.transform(entries, lambda e: F.concat(F.lit("https://arxiv.org/abs/"), F.regexp_extract(e["id"], r"/abs/([0-9]+\.[0-9]+)", 1)))


def posts_request(first: int = 20, order: str = "VOTES") -> dict[str, str]:
    """Options of the page source that ask a GraphQL service for posts; ``reply_urls`` reads what it answers."""
    asked = f"query {{ posts(first: {first}, order: {order}) {{ edges {{ node {{ id name url slug }} }} }} }}"
    return {"data": json.dumps({"query": asked}), "header.Content-Type": "application/json"}


def reply_urls(reply: Column, base: str) -> Column:
    """Addresses of the posts in a GraphQL reply."""
    schema = "data struct<posts:struct<edges:array<struct<node:struct<id:string,name:string,url:string,slug:string>>>>>"
    return F.transform(F.from_json(reply, schema)["data"]["posts"]["edges"], lambda e: F.coalesce(e["node"]["url"], F.concat(F.lit(f"{base}/posts/"), e["node"]["slug"])))
