"""Small text helpers: capitalisation, UTC day tokens, run names, JSON fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def capitalize(text: Column | str) -> Column:
    """First character upper, the rest lower (``str.capitalize``, not ``initcap``)."""
    c = _c(text)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2), F.length(c))))


def day_token(ts: Column | str | None = None) -> Column:
    """``yyyyMMdd`` in UTC, whatever the session zone (default: now).

    A ``timestamp_ntz`` has no zone and is taken as it reads.
    """
    c = F.current_timestamp() if ts is None else _c(ts)
    # Seconds since the epoch as a zone-less date: no session zone is involved.
    utc = F.date_add(F.lit("1970-01-01").cast("date"),
                     F.floor(F.unix_micros(c.cast("timestamp")) / 86_400_000_000).cast("int"))
    zoneless = F.typeof(c) == "timestamp_ntz"
    return F.when(zoneless, F.date_format(c.cast("timestamp_ntz"), "yyyyMMdd")).otherwise(
        F.date_format(utc, "yyyyMMdd"))


def run_name(prefix: str, model_type: Column | str) -> Column:
    """Run / job name ``<prefix>-<Make>`` for a make."""
    return F.concat(F.lit(prefix + "-"), capitalize(model_type))


def json_field(text: Column | str, path: str) -> Column:
    """One field of a JSON text as a string (``$.a.b`` paths)."""
    return F.get_json_object(_c(text), path)
