"""Code repositories: replies as rows, lookups, search, and how long a spent quota makes callers wait."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.url import repo_url

_REPLY = "html_url string, name string, owner struct<login:string>, stargazers_count int, description string"
#: Requests that stay unused before callers wait for the quota to be filled.
RESERVE = 10


def from_replies(replies: DataFrame, body: str, fetched_at: Column) -> DataFrame:
    """Rows of ``github_repositories``; replies that name no repository go."""
    r = F.from_json(F.col(body), _REPLY)
    rows = replies.select(r.alias("r"), F.col(body).alias("raw_response")).where("r.html_url is not null")
    return rows.select(
        repo_url(F.col("r.html_url")).alias("repository_url"), F.col("r.owner.login").alias("owner"), F.col("r.name").alias("repo"), F.col("r.stargazers_count").alias("stars"),
        F.col("r.description").alias("description"), fetched_at.alias("fetched_at"), "raw_response",
    )


def looked_up(rows: DataFrame, url: str, repositories: DataFrame) -> DataFrame:
    """Adds ``verified`` and what is known of the repository; each repository is looked up once."""
    known = repositories.groupBy("repository_url").agg(F.max_by(F.struct("stars", "description", "fetched_at"), "fetched_at").alias("__r"))
    out = rows.withColumn("repository_url", repo_url(F.col(url))).join(known, "repository_url", "left")
    return out.withColumn("verified", F.col("__r").isNotNull()).select("*", "__r.*").drop("__r")


def search(repositories: DataFrame, words: str, per_page: int = 10) -> DataFrame:
    """Repositories whose name or description holds the words, most stars first: a top-k."""
    q = F.lit(words.lower())
    hit = F.contains(F.lower(F.col("repo")), q) | F.coalesce(F.contains(F.lower(F.col("description")), q), F.lit(False))
    return repositories.where(hit).orderBy(F.col("stars").desc_nulls_last(), "repository_url").limit(per_page)


def quota_wait(remaining: Column, reset: Column, now: Column) -> Column:
    """Seconds to wait before the next request (``reset`` and ``now`` in seconds)."""
    spent = (remaining <= RESERVE) & (reset > now)
    return F.when(spent, reset - now + 1).otherwise(F.lit(0)).cast("double")
