"""Column-layout operators: target first, positional slices, first rows, shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_target(df: DataFrame, target: str | None = None) -> tuple[str, list[str]]:
    """(target, features): the named target, or column 0 when none is named."""
    cols = df.columns
    t = target or cols[0]
    if t not in cols:
        raise ValueError(f"target column {t!r} missing")
    return t, [c for c in cols if c != t]


def target_first(df: DataFrame, target: str) -> DataFrame:
    """Same rows with the target moved to column 0 (a projection, not a join)."""
    t, feats = split_target(df, target)
    return df.select(t, *feats)


def column_slice(df: DataFrame, start: int = 0, stop: int | None = None) -> DataFrame:
    """Columns ``[start:stop]`` by position."""
    return df.select(*df.columns[start:stop])


def first_and_last(df: DataFrame) -> DataFrame:
    """Column 0 and the last column."""
    cols = df.columns
    return df.select(cols[0], cols[-1]) if len(cols) > 1 else df.select(cols[0])


def first_n(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first n rows in a stated order (a top-k, not an arbitrary sample)."""
    return df.orderBy(*[F.col(c).asc() for c in order_by]).limit(n)


def shape(df: DataFrame, name: str) -> DataFrame:
    """One row: table name, row count, column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))


def select_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Select the model's feature columns by name; fail on any missing one."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return df.select(*features)
