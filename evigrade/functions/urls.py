"""Column functions on URLs.  Parts are cut by regular expressions, since parsers refuse many real URLs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from evigrade.functions import vocab
from evigrade.functions.text import filled

_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def netloc(c: Column | str) -> Column:
    return F.regexp_extract(filled(c), _AUTHORITY, 1)


def path(c: Column | str) -> Column:
    rest = F.regexp_replace(filled(c), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?", "")
    return F.regexp_extract(rest, r"^([^?#]*)", 1)


def query(c: Column | str) -> Column:
    return F.regexp_extract(filled(c), r"^[^?#]*\?([^#]*)", 1)


def domain(c: Column | str) -> Column:
    """Host in lower case without user, port and www."""
    host = F.regexp_replace(F.lower(netloc(c)), r"^.*@", "")
    return F.regexp_replace(F.regexp_extract(host, r"^([^:]*)", 1), r"^www\.", "")


def site(c: Column | str) -> Column:
    """Authority in lower case without www; user and port stay."""
    return F.regexp_replace(F.lower(netloc(c)), r"^www\.", "")


def slug(c: Column | str) -> Column:
    """host__path as a file name; root for no path."""
    base = F.replace(F.regexp_replace(path(c), "^/+|/+$", ""), F.lit("/"), F.lit("_"))
    base = F.regexp_replace(F.regexp_replace(base, "[^A-Za-z0-9._-]+", "-"), "^[-._]+|[-._]+$", "")
    base = F.left(F.coalesce(F.nullif(base, F.lit("")), F.lit("root")), F.lit(80))
    host = F.regexp_replace(F.regexp_replace(netloc(c), "[^A-Za-z0-9.-]+", "-"), "^-+|-+$", "")
    return F.when(host != "", F.concat(host, F.lit("__"), base)).otherwise(base)


def decoded_path(c: Column | str) -> Column:
    """The path with percent codes resolved; a plus sign stays."""
    raw = path(c)
    return F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)


def segments(c: Column | str, most: int = 30) -> Column:
    parts = F.filter(F.split(F.regexp_replace(decoded_path(c), "^/+|/+$", ""), r"[/_-]+"), lambda s: s != "")
    return F.slice(parts, 1, most)


def identifiers(c: Column | str, most: int = 12) -> Column:
    """Distinct tokens of the whole URL that look like identifiers."""
    tokens = F.split(filled(c), r"[/&?=#._-]+")
    return F.slice(F.array_distinct(F.filter(tokens, lambda t: t.rlike("^[A-Za-z0-9]{8,14}$"))), 1, most)


def title_hint(c: Column | str) -> Column:
    words = F.filter(segments(c, 1 << 20), lambda s: ~s.rlike("^[A-Za-z0-9]{8,14}$"))
    return F.array_join(F.slice(words, 1, 14), " ")


def has_search_key(c: Column | str) -> Column:
    """Whether a query parameter with a value has a name that searches use."""
    pairs = F.split(query(c), "&")
    keys = "|".join(vocab.SEARCH_KEYS)
    return F.exists(pairs, lambda p: p.rlike(rf"(?i)^(?:{keys})=.+"))


def is_category(c: Column | str) -> Column:
    return path(c).rlike(f"(?i){vocab.CATEGORY_PATH}") | has_search_key(c)


def is_non_product(c: Column | str) -> Column:
    return path(c).rlike(f"(?i){vocab.NON_PRODUCT_PATH}")


def origin(c: Column | str) -> Column:
    return F.regexp_extract(filled(c), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def without_query(c: Column | str) -> Column:
    return F.regexp_extract(filled(c), r"^([^?#]*)", 1)


@F.pandas_udf(StringType())
def join_url(base: pd.Series, link: pd.Series) -> pd.Series:
    """A link resolved against its page (RFC 3986)."""
    from urllib.parse import urljoin

    return pd.Series([urljoin(b or "", x) if x is not None else None for b, x in zip(base, link)], dtype=object)


