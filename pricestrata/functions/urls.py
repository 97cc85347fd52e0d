"""URL parts and allowlists without leaving the JVM."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pricestrata.functions.text import strip

_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _SPLIT, group)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def authority(url: Column) -> Column:
    return _part(url, 2)


def host(url: Column) -> Column:
    """Lower-case host without credentials and port; NULL when there is none."""
    name = F.lower(F.regexp_extract(authority(url), r"^(?:.*@)?(\[[^\]]*\]|[^:@]*)(?::[^@]*)?\z", 1))
    return F.when(name != "", name)


def port(url: Column) -> Column:
    return F.regexp_extract(authority(url), r":([0-9]*)\z", 1)


def has_credentials(url: Column) -> Column:
    return F.contains(authority(url), F.lit("@"))


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def fragment(url: Column) -> Column:
    return _part(url, 5)


def query_pairs(url: Column) -> Column:
    """Decoded, sorted ``key=value`` pairs with a non-blank value."""
    pairs = F.filter(F.split(query(url), "&"), lambda p: p.rlike("^[^=]+=.+"))
    return F.array_sort(F.transform(pairs, lambda p: F.try_url_decode(p)))


def raw_pairs(url: Column) -> Column:
    """The parts of the query as they are written."""
    return F.split(query(url), "&")


def values_of(pairs: Column, name: str) -> Column:
    """Decoded non-blank values of one parameter among ``raw_pairs``."""
    # The pattern is asked of pairs of that name only.
    pairs = F.filter(pairs, lambda p: p.startswith(f"{name}=") & p.rlike(rf"^{name}=.+"))
    return F.transform(
        pairs, lambda p: F.try_url_decode(F.substring(p, F.lit(len(name) + 2), F.length(p)))
    )


def query_values(url: Column, name: str) -> Column:
    return values_of(raw_pairs(url), name)


def single_query_value(url: Column, name: str, pattern: str = r"^[0-9]+\z") -> Column:
    """The value of a parameter given exactly once and matching the pattern, else NULL."""
    return single_value(query_values(url, name), pattern)


def single_value(values: Column, pattern: str = r"^[0-9]+\z") -> Column:
    first = F.get(values, F.lit(0))
    return F.when((F.size(values) == 1) & first.rlike(pattern), first)


@F.pandas_udf(StringType())
def _idna_batch(values: pd.Series) -> pd.Series:
    def encode(value: str) -> str | None:
        try:
            return value.encode("idna").decode("ascii")
        except UnicodeError:
            return None

    return values.map(encode, na_action="ignore")


def ascii_host(url: Column) -> Column:
    name = F.regexp_replace(host(url), r"\.+\z", "")
    foreign = name.rlike(r"[^\x00-\x7f]")
    return F.when(foreign, _idna_batch(F.when(foreign, name))).otherwise(name)


def url_verdict(url: Column, allowed: list[str] | Column) -> Column:
    """NULL when the URL may be used, else the first reason against it."""
    inside = (
        F.array_contains(allowed, ascii_host(url))
        if isinstance(allowed, Column)
        else ascii_host(url).isin(allowed)
    )
    return (
        F.when(scheme(url) != "https", "SCHEME")
        .when(has_credentials(url), "CREDENTIALS")
        .when(host(url).isNull(), "NO_HOST")
        .when(~F.coalesce(inside, F.lit(False)), "HOST")
        .when(~port(url).isin("", "443"), "PORT")
    )


def same_url(left: Column, right: Column) -> Column:
    """Equal path and equal query as a multimap, order free."""
    return (path(left) == path(right)) & (query_pairs(left) == query_pairs(right))


def without_dots(link: Column) -> Column:
    """A link's path with its ``.`` and ``..`` segments resolved; the rest stays as written.

    Only links that have such a segment are cut up; the root is never left.
    """
    tail = F.regexp_extract(link, r"[?#].*\z", 0)
    way = F.regexp_replace(link, r"[?#].*\z", "")
    parts = F.split(way, "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda done, x: F.when(x == ".", done)
        .when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, x)),
    )
    closing = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    closed = F.when(joined.endswith("/"), joined).otherwise(F.concat(joined, closing))
    return F.when(way.rlike(r"(^|/)\.\.?(/|\z)"), F.concat(closed, tail)).otherwise(link)


def absolute(base: Column, href: Column) -> Column:
    """Join a link to the page it was found on."""
    return resolved(base, page_parts(base), strip(href))


def page_parts(base: Column) -> dict[str, Column]:
    """What ``resolved`` needs of a page's address; a page with many links computes it once."""
    folder = F.regexp_replace(path(base), r"[^/]*\z", "")
    return {
        "scheme": scheme(base),
        "origin": F.concat(scheme(base), F.lit("://"), authority(base)),
        "path": path(base),
        "folder": F.when(folder == "", F.lit("/")).otherwise(folder),
    }


def resolved(base: Column, page: dict[str, Column], href: Column) -> Column:
    """A stripped link joined to the page with these parts."""
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(page["scheme"], F.lit(":"), href))
        .when(href.startswith("/"), F.concat(page["origin"], without_dots(href)))
        .when(href.startswith("?"), F.concat(page["origin"], page["path"], href))
        .when((href == "") | href.startswith("#"), F.regexp_replace(base, r"#.*\z", ""))
        .otherwise(F.concat(page["origin"], without_dots(F.concat(page["folder"], href))))
    )
