"""Object-store URI and key arithmetic as native column expressions.

Semantics follow Python string splitting on "/": ``uri.split("/")[2]`` is the
bucket, ``"/".join(uri.split("/")[3:])`` the key, ``key.split("/")[-1]`` the base
name, ``key.rsplit("/", 3)[0]`` the prefix three levels up. Out-of-range parts
give the empty string instead of raising.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bucket(uri: Column | str) -> Column:
    """Third "/"-part: the bucket of ``s3://bucket/key`` (host of an URL)."""
    return F.split_part(_c(uri), F.lit("/"), F.lit(3))


def key(uri: Column | str) -> Column:
    """Everything after the third "/"."""
    return F.regexp_extract(_c(uri), r"(?s)^[^/]*/[^/]*/[^/]*/(.*)$", 1)


def base_name(path: Column | str) -> Column:
    """Last "/"-part."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def strip_scheme(uri: Column | str, scheme: str = "s3://") -> Column:
    """Remove every occurrence of the scheme marker (as ``str.replace`` does)."""
    return F.replace(_c(uri), F.lit(scheme), F.lit(""))


def first_level(path: Column | str) -> Column:
    """Part before the first "/" (the whole text if there is none)."""
    return F.substring_index(_c(path), "/", 1)


def after_first_level(path: Column | str) -> Column:
    """Part after the first "/" (empty if there is none)."""
    return F.regexp_extract(_c(path), r"(?s)^[^/]*/(.*)$", 1)


def slash_count(path: Column | str) -> Column:
    c = _c(path)
    return F.length(c) - F.length(F.replace(c, F.lit("/"), F.lit("")))


def drop_last_levels(path: Column | str, levels: int = 3) -> Column:
    """``path.rsplit("/", levels)[0]``: with fewer slashes, the first part."""
    c = _c(path)
    return (F.when(slash_count(c) >= levels,
                   F.regexp_replace(c, "(/[^/]*){%d}$" % levels, ""))
            .otherwise(first_level(c)))


def compose_uri(bucket_col: Column | str, key_col: Column | str, scheme: str = "s3://") -> Column:
    return F.concat(F.lit(scheme), _c(bucket_col), F.lit("/"), _c(key_col))


def has_marker(path: Column | str, marker: str) -> Column:
    return _c(path).contains(marker)
