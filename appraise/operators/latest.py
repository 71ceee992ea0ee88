"""Newest / best row selection.

Per key, selection is a ``min_by`` over an ordering struct: a hash aggregate
with partial aggregation, so a key holding a third of all rows is reduced on
the map side and no task sorts a whole group. The global newest row is an
ordered ``limit(1)`` (TakeOrderedAndProject: one candidate per partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType


def newest_first(ts: Column | str, kind: DataType | None = None) -> Column:
    """Sort key that puts the newest time first in ascending order.

    Instants (``timestamp``) use epoch microseconds. Wall-clock values
    (``timestamp_ntz``) are ordered by their own digits, never through the
    session zone, where two values in a daylight-saving gap would collide.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    if isinstance(kind, TimestampNTZType):
        return -wall_clock_micros(c)
    if isinstance(kind, DateType):
        return -F.unix_date(c)
    return -F.unix_micros(c.cast("timestamp"))


def wall_clock_micros(c: Column) -> Column:
    """Microseconds of a ``timestamp_ntz`` since 1970-01-01 00:00, from its own fields.

    Field extraction on wall-clock values does not consult the session zone
    (formatting and casts to ``timestamp`` do).
    """
    return (F.unix_date(c.cast("date")).cast("long") * F.lit(86_400_000_000)
            + F.hour(c).cast("long") * F.lit(3_600_000_000)
            + F.minute(c).cast("long") * F.lit(60_000_000)
            + (F.extract(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long"))


def _kind(df: DataFrame, col: str) -> DataType:
    return df.schema[col].dataType


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tie: str,
                   values: Sequence[str]) -> DataFrame:
    """Per key: the row with the newest ``ts``; ties go to the smallest ``tie``."""
    order = F.struct(newest_first(ts, _kind(df, ts)).alias("t"), F.col(tie).alias("k"))
    picked = F.min_by(F.struct(*[F.col(v) for v in values]), order).alias("__p")
    return (df.filter(F.col(ts).isNotNull())
            .groupBy(*keys).agg(picked)
            .select(*keys, *[F.col(f"__p.{v}").alias(v) for v in values]))


def latest_one(df: DataFrame, ts: str, tie: str) -> DataFrame:
    """The single newest row (ties: smallest ``tie``)."""
    return df.filter(F.col(ts).isNotNull()).orderBy(F.col(ts).desc(), F.col(tie).asc()).limit(1)


def preference_rank(col: Column | str, preferred: Sequence[str], how: str = "endswith") -> Column:
    """0 for the first preferred marker, 1 for the next, ...; NULL for none."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for i, p in enumerate(preferred):
        test = c.endswith(p) if how == "endswith" else (c == F.lit(p))
        expr = F.when(test, F.lit(i)) if expr is None else expr.when(test, F.lit(i))
    return expr


def latest_with_fallback(df: DataFrame, keys: Sequence[str], kind: str,
                         preferred: Sequence[str], ts: str, tie: str,
                         values: Sequence[str], how: str = "endswith") -> DataFrame:
    """Per key: newest row of the first kind present, else of the next kind."""
    ranked = df.withColumn("__rank", preference_rank(kind, preferred, how))
    order = F.struct(F.col("__rank").alias("r"), newest_first(ts, _kind(df, ts)).alias("t"),
                     F.col(tie).alias("k"))
    picked = F.min_by(F.struct(*[F.col(v) for v in values]), order).alias("__p")
    base = ranked.filter(F.col("__rank").isNotNull() & F.col(ts).isNotNull())
    grouped = base.groupBy(*keys) if keys else base
    return grouped.agg(picked).select(*keys, *[F.col(f"__p.{v}").alias(v) for v in values])


def best_per_key(df: DataFrame, keys: Sequence[str], metric: str, tie: str,
                 values: Sequence[str]) -> DataFrame:
    """Per key: the row with the smallest metric (ties: smallest ``tie``)."""
    order = F.struct(F.col(metric).alias("m"), F.col(tie).alias("k"))
    picked = F.min_by(F.struct(*[F.col(v) for v in values]), order).alias("__p")
    base = df.filter(F.col(metric).isNotNull())
    grouped = base.groupBy(*keys) if keys else base
    return grouped.agg(picked).select(*keys, *[F.col(f"__p.{v}").alias(v) for v in values])


def top_k(df: DataFrame, metric: str, tie: str, k: int = 0) -> DataFrame:
    """The k-th best row (k = 0 is the best) by ascending metric."""
    return (df.filter(F.col(metric).isNotNull())
            .orderBy(F.col(metric).asc(), F.col(tie).asc()).offset(k).limit(1))


def attach_latest(df: DataFrame, latest: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left-join each row to the newest companion row of its key.

    The companion side has one row per key. Both sides grow with the data, so
    no broadcast is forced: AQE broadcasts it at run time when it measures
    small and splits skewed keys of the left side otherwise.
    """
    return df.join(latest, list(on), "left")


def best_of_newest_job(trials: DataFrame, values: Sequence[str]) -> DataFrame:
    """Per make: the best completed trial of the newest search that completed one.

    ``trials``: job, trial_id, model_type, status, created_at, rmse and ``values``.
    A search is as new as its newest completed trial (ties: smallest job). Two
    aggregates with map-side folding; the join is on (make, job), one row a make.
    """
    done = trials.filter(F.col("status") == "Completed")
    newest = latest_per_key(done, ["model_type"], "created_at", "job", ["job"])
    mine = done.join(newest, ["model_type", "job"], "left_semi")
    return best_per_key(mine, ["model_type"], "rmse", "trial_id", ["job", "trial_id", "rmse", *values])
