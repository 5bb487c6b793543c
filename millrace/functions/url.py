"""URL functions, column in, column out.  Null in, null out; all are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def scheme(url: Column) -> Column:
    return F.regexp_extract(url, _SPLIT, 1)


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, _SPLIT, 2)


def path(url: Column) -> Column:
    """The path as it is, trailing slash kept."""
    return F.regexp_extract(url, _SPLIT, 3)


def query(url: Column) -> Column:
    return F.regexp_extract(url, _SPLIT, 4)


def domain(url: Column) -> Column:
    """Lower-cased network location without ``www.``; a port stays."""
    return F.regexp_replace(F.lower(netloc(url)), r"^www\.", "")


def limiter_domain(url: Column) -> Column:
    """The key that rate limits go by: network location, else first path segment, else ``unknown``."""
    first = F.element_at(F.split(path(url), "/"), 1)
    return F.coalesce(F.nullif(netloc(url), F.lit("")), F.nullif(first, F.lit("")), F.lit("unknown"))


def is_valid(url: Column) -> Column:
    return F.coalesce((scheme(url) != "") & (netloc(url) != ""), F.lit(False))


def fixed(url: Column) -> Column:
    """Trimmed, with ``https://`` in front where no web scheme is given; blank stays empty."""
    u = F.trim(url)
    return F.when(u == "", F.lit("")).when(u.rlike("(?i)^https?://"), u).otherwise(F.concat(F.lit("https://"), F.ltrim(u, F.lit("/"))))


def base(url: Column) -> Column:
    return F.concat(scheme(url), F.lit("://"), netloc(url))


def sorted_query(q: Column) -> Column:
    """Parameters by name, values of one name in their order, blank values kept, escapes made uniform."""

    def decoded(x: Column) -> Column:
        return F.url_encode(F.coalesce(F.try_url_decode(x), x))

    parts = F.filter(F.split(q, "&"), lambda p: p != "")
    keyed = F.transform(
        parts, lambda p, i: F.struct(decoded(F.substring_index(p, "=", 1)).alias("k"), i.alias("i"), decoded(F.regexp_extract(p, "=(.*)$", 1)).alias("v"))
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat(s["k"], F.lit("="), s["v"])), "&")


def normalized(url: Column) -> Column:
    """Lower-case scheme and host, no ``www.``, default port, fragment or trailing slashes (a path that is
    only ``/`` stays), parameters sorted."""
    u = F.trim(url)
    s = F.lower(scheme(u))
    host = domain(u)
    host = F.when(s == "http", F.regexp_replace(host, ":80$", "")).when(s == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    p = F.when(path(u) == "/", F.lit("/")).otherwise(F.regexp_replace(path(u), "/+$", ""))
    q = sorted_query(query(u))
    head = F.when(s != "", F.concat(s, F.lit("://"))).otherwise(F.lit(""))
    return F.when(u == "", F.lit("")).otherwise(F.concat(head, host, p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit(""))))


def lightly_normalized(url: Column) -> Column:
    """Lower-case scheme and host, no fragment, no trailing slashes; the rest as it is."""
    s, q = F.lower(scheme(url)), query(url)
    tail = F.concat(F.regexp_replace(path(url), "/+$", ""), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
    return F.concat(F.when(s != "", F.concat(s, F.lit("://"))).otherwise(F.lit("")), F.lower(netloc(url)), tail)


def allowed(url: Column, domains: list[str] | None) -> Column:
    """Whether the network location is one of ``domains``, letter by letter; None allows all."""
    return F.lit(True) if domains is None else F.coalesce(netloc(url).isin(domains), F.lit(False))


def repo_url(url: Column) -> Column:
    """A repository's address in one form: https, lower-case host without ``www.``, no ``.git`` or slash."""
    u = F.regexp_replace(F.regexp_replace(F.trim(url), "/+$", ""), r"\.git$", "")
    u = F.when(u.rlike("(?i)^https?://"), F.regexp_replace(u, "(?i)^http://", "https://")).otherwise(F.concat(F.lit("https://"), u))
    host = F.regexp_replace(F.lower(netloc(u)), r"^www\.github\.com$", "github.com")
    return F.concat(F.lower(scheme(u)), F.lit("://"), host, F.regexp_replace(path(u), "/+$", ""))


def repo_api_url(url: Column) -> Column:
    """The repository's address in the web service; null for other hosts."""
    return F.when(netloc(url) == "github.com", F.concat(F.lit("https://api.github.com/repos"), path(url)))


def repo_urls(text: Column) -> Column:
    """Repository addresses in a text, normalized and distinct, in order of appearance."""
    found = F.regexp_extract_all(text, F.lit(r"(?:https?://)?(?:www\.)?github\.com/([A-Za-z0-9-]+/[A-Za-z0-9_.-]+)"), F.lit(1))
    clean = F.transform(found, lambda p: F.regexp_replace(F.regexp_replace(p, r"[.]+$", ""), r"\.git$", ""))
    return F.array_distinct(F.transform(clean, lambda p: F.concat(F.lit("https://github.com/"), p)))


def arxiv_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/(abs|pdf)/([0-9]+\.[0-9]+)", 2), F.lit(""))


def joined(origin: Column, href: Column) -> Column:
    """``href`` as an absolute address, seen from the top of ``origin``."""
    top = base(origin)
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(F.startswith(href, F.lit("//")), F.concat(scheme(origin), F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(top, href)).otherwise(F.concat(top, F.lit("/"), href))
    )
