"""Text functions: blanks, names, sentences, keywords."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal words that names lose, in two lists.
LEGAL = ["inc", "incorporated", "corp", "corporation", "llc", "limited", "ltd", "co", "company", "the", "group", "holdings"]
LEGAL_MORE = [*LEGAL, "llp", "plc", "gmbh", "sa", "as"]
# Words that tell whether a job is remote.
REMOTE = ["remote", "work from home", "wfh", "telecommute", "virtual", "distributed"]
ON_SITE = ["onsite", "in-office", "office"]
# Words of each role family, tried in this order.
ROLES = {
    "Engineering": ["engineer", "developer", "software", "backend", "frontend", "full stack", "full-stack", "devops", "ml engineer", "machine learning"],
    "Research": ["research", "scientist", "phd", "postdoc"],
    "Design": ["design", "ui", "ux", "product designer"],
    "Product": ["product manager", "product owner", "pm"],
}
CHARS_PER_TOKEN = 4
# Runs of blanks and what they become, in this order.
BLANKS = [(r"\n{3,}", "\n\n"), (r"[ \t]+", " "), (r"\n \n", "\n\n"), (r"\n ", "\n"), (r" \n", "\n")]


def stripped(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def blanks_normalized(x: Column) -> Column:
    """At most one empty line and one blank in a row; no blanks around line ends or the whole."""
    for pattern, to in BLANKS:
        x = F.regexp_replace(x, pattern, to)
    return stripped(x)


def name_normalized(x: Column, legal: list[str] = LEGAL) -> Column:
    """Lower case, letters, digits, blanks, hyphens and apostrophes only, legal words gone."""
    x = F.regexp_replace(F.lower(x), r"(?U)[^\w\s\-']", "")
    return stripped(blanks_normalized(F.regexp_replace(x, rf"(?U)\b({'|'.join(legal)})\b", "")))


def truncated(x: Column, n: int = 10000) -> Column:
    """The first ``n`` characters, whole paragraphs joined as they were; a cut in or right after the empty
    line between paragraphs leaves none of it."""
    return F.when(F.length(x) <= n, x).otherwise(F.regexp_replace(F.substring(x, 1, n), r"\n{1,2}$", ""))


def tokens(x: Column) -> Column:
    """Estimate: a token for every four characters."""
    return F.floor(F.length(x) / CHARS_PER_TOKEN).cast("long")


def too_large(x: Column, limit: int = 6000) -> Column:
    return tokens(x) > limit


def sentences(x: Column) -> Column:
    return F.split(x, r"(?<=[.!?])\s+")


def paragraphs(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, r"\n{2,}"), stripped), lambda p: p != "")


def heading_sections(x: Column) -> Column:
    """Pieces that begin at a markdown heading."""
    return F.filter(F.transform(F.split(x, r"\n(?=\s*#{1,6}\s+\S)"), stripped), lambda p: p != "")


def _any(x: Column, words: list[str]) -> Column:
    return x.rlike("|".join(words))


def is_remote(content: Column) -> Column:
    """True, False, or null if nothing tells."""
    c = F.lower(content)
    return F.when(_any(c, REMOTE), True).when(_any(c, ON_SITE), False)


def role_family(title: Column, content: Column, word_boundary: bool = False) -> Column:
    """First family with a word in title or content.  ``word_boundary``: whole words only."""
    both = F.lower(F.concat_ws("\n", title, content))
    out = F.lit("Other")
    for family, words in reversed(ROLES.items()):
        listed = [rf"\b{w}\b" for w in words] if word_boundary else words
        out = F.when(_any(both, listed), F.lit(family)).otherwise(out)
    return out


def pricing(x: Column) -> Column:
    p = F.lower(x)
    return (
        F.when(p.contains("freemium"), "FREEMIUM").when(p.contains("free"), "FREE")
        .when(p.contains("enterprise"), "ENTERPRISE").when(p.contains("paid") | p.contains("premium"), "PAID")
    )


def first_number(x: Column) -> Column:
    return F.nullif(F.regexp_extract(x, r"\d+", 0), F.lit("")).try_cast("int")


def authors(x: Column) -> Column:
    """Names between commas and semicolons, trimmed, 1 to 99 characters."""
    return F.filter(F.transform(F.split(x, "[;,]"), lambda a: F.trim(a)), lambda a: F.length(a).between(1, 99))


def retryable(status: Column) -> Column:
    return F.coalesce(status.isin(408, 429, 500, 502, 503, 504), F.lit(False))


def retry_delay(attempt: Column, retry_after: Column, base: float = 1.0, most: float = 60.0) -> Column:
    """Seconds to wait: what the server asked for, else doubling; never over ``most``.  Without jitter."""
    return F.least(F.coalesce(retry_after.cast("double"), F.lit(base) * F.pow(F.lit(2.0), attempt)), F.lit(most))
