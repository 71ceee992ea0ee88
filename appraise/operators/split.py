"""Reproducible train / validation / test split.

Rows are ordered by a seeded hash of a key: the first 32 bits of
``md5(key || ':' || seed)``. The order depends only on the key and the seed,
never on partitioning or file order, so a rerun (or a retried task) gives the
same split.

Two forms:

* ``split_fraction`` – each row is placed by comparing its hash with the
  fraction; a pure projection, no shuffle, sizes approximately right.
* ``split_exact`` – exact sizes, as the usual two-stage rule gives them
  (test = ceil(0.1 n), validation = ceil(0.2 (n - test))). Instead of a global
  ``row_number`` (which pulls every row into one task) the cut point in hash
  order is found with two bounded histogram passes (65,536 buckets on the top
  16 bits, then 65,536 on the low 16 bits inside the one boundary bucket) and a
  tie pass over the rows sharing the exact boundary hash. Where the cut falls
  inside one key, its rows are cut by a 64-bit hash of the whole row, found in the
  same passes. Membership is then a per-row predicate ``(h, key, row) <= (H, K, R)``:
  the final assignment is a map, not a shuffle, and no task ever holds more
  than one histogram. Only where rows equal in every column lie across a cut do
  they need numbers: the table is then written once with a running id, and
  the cut takes as many copies as it lacks, by id.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from appraise.session import written

# Split fractions and seeds of the training preparation.
TEST_SIZE = 0.1
VALIDATION_SIZE = 0.2
TRAIN_SEEDS = (293, 342)
TUNE_SEEDS = (8939, 304)

_BITS = 32
_SCALE = 1 << _BITS


def hash32(key: Column | str, seed: int, how: str = "md5") -> Column:
    """A seeded 32-bit hash of the key, as an integer in [0, 2^32).

    ``md5``: first 8 hex digits of md5(key:seed); any SQL engine can reproduce
    it. ``xxhash64``: top 32 bits of Spark's native xxhash64(seed, key), several
    times cheaper per row, for inputs where the split need not be reproduced
    outside Spark.
    """
    k = F.col(key) if isinstance(key, str) else key
    if how == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), k), 32)
    if how != "md5":
        raise ValueError(f"unknown hash {how!r}")
    return F.conv(_digits(k, seed), 16, 10).cast("bigint")


def _digits(k: Column, seed: int) -> Column:
    """The 8 lower-case hex digits that the ``md5`` form of ``hash32`` reads as a number."""
    return F.substring(F.md5(F.concat(k.cast("string"), F.lit(f":{seed}"))), 1, 8)


def hash32_sql(key_sql: str, seed: int) -> str:
    return (f"CAST(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':{seed}'), 1, 8))"
            f" AS BIGINT)")


def fraction_threshold(fraction: float) -> int:
    """h / 2^32 < fraction  <=>  h < ceil(fraction * 2^32) for integer h."""
    return int(math.ceil(fraction * _SCALE))


def split_quotas(n: int, test_size: float = TEST_SIZE,
                 validation_size: float = VALIDATION_SIZE) -> tuple[int, int, int]:
    """(train, validation, test) row counts: ceil on the held-out part, in doubles."""
    n_test = int(math.ceil(test_size * n)) if n else 0
    rest = n - n_test
    n_val = int(math.ceil(validation_size * rest)) if rest else 0
    return rest - n_val, n_val, n_test


def split_fraction(df: DataFrame, key: str, test_size: float = TEST_SIZE,
                   validation_size: float = VALIDATION_SIZE,
                   seeds: Sequence[int] = TRAIN_SEEDS, out_col: str = "split",
                   how: str = "md5") -> DataFrame:
    """Approximate two-stage split as a single projection."""
    return df.withColumn(
        out_col,
        F.when(_below(key, seeds[0], how, test_size), F.lit("test"))
        .when(_below(key, seeds[1], how, validation_size), F.lit("validation"))
        .otherwise(F.lit("train")))


def _below(key: str, seed: int, how: str, fraction: float) -> Column:
    """Whether the key's null-safe hash is below the fraction. Hex digits of one length order like
    their numbers, so ``md5`` compares text: reading the number takes longer than the digest."""
    most = fraction_threshold(fraction)
    if how != "md5" or not 0 < most < _SCALE or not 0 <= seed < _SCALE:
        return _null_safe(key, seed, how) < F.lit(most)
    digits = F.coalesce(_digits(F.col(key), seed), F.lit(f"{seed:08x}"))
    return digits < F.lit(f"{most:08x}")


@dataclass(frozen=True)
class Cut:
    """Rows with (h, key, row hash) up to the stated place are inside the quota.

    ``everything`` / ``nothing`` cover the quota = n and quota = 0 cases.
    ``key_value`` None means every row with ``h == hash_value`` is inside (null
    keys are compared as their token). ``inner`` decides among the rows of the
    boundary key itself, by the parts of the row's hash and, among copies, its number.
    """
    hash_value: int | None = None
    key_value: object = None
    everything: bool = False
    nothing: bool = False
    inner: Cut | None = None

    def predicate(self, h: Column, key: Column, parts: Sequence[Column] = ()) -> Column:
        """``parts``: the 32-bit columns that inner cuts compare, one after the other."""
        if self.everything:
            return F.lit(True)
        if self.nothing:
            return F.lit(False)
        below, at = h < F.lit(self.hash_value), h == F.lit(self.hash_value)
        if self.key_value is None:
            return below | at
        before = below | (at & (key < F.lit(self.key_value)))
        edge = at & (key == F.lit(self.key_value))
        return before | (edge if self.inner is None else edge & self.inner.predicate(parts[0], F.lit(0), parts[1:]))

    @property
    def depth(self) -> int:
        return 0 if self.inner is None else 1 + self.inner.depth


def key_token(key: str) -> Column:
    """The key as text, null keys as an empty-key token of their own (sorts first)."""
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("?"))


def _walk(hist: list[tuple[int, int]], quota: int) -> tuple[int, int, int]:
    """Sorted (bucket, count); return (boundary bucket, rows before it, its count)."""
    before = 0
    for bucket, cnt in hist:
        if before + cnt >= quota:
            return bucket, before, cnt
        before += cnt
    raise ValueError("quota exceeds row count")


class Copies(Exception):
    """Rows that agree in every column lie across a cut."""


def find_cut(df: DataFrame, h: str, key: str, quota: int, total: int | None = None,
             top_hist: list[tuple[int, int]] | None = None, rows: DataFrame | None = None,
             parts: Sequence[str] = ()) -> Cut:
    """Locate the quota-th row in (h, key, parts) order with bounded aggregations.

    ``rows`` holds the ``parts`` columns (unsigned 32 bits each), read only if a cut
    falls inside one key.
    """
    if quota <= 0:
        return Cut(nothing=True)
    if top_hist is None:
        top_hist = sorted(tuple(r) for r in df.groupBy(F.shiftright(F.col(h), 16).alias("b"))
                          .count().collect())
    if total is None:
        total = sum(c for _, c in top_hist)
    if quota >= total:
        return Cut(everything=True)
    b1, before1, _ = _walk(top_hist, quota)
    low = (df.filter(F.shiftright(F.col(h), 16) == F.lit(b1))
           .groupBy((F.col(h).bitwiseAND(F.lit(0xFFFF))).alias("b")).count().collect())
    b2, before2, cnt2 = _walk(sorted(tuple(r) for r in low), quota - before1)
    hash_value = (b1 << 16) | b2
    need = quota - before1 - before2
    if need == cnt2:
        return Cut(hash_value=hash_value)
    # Keys that share the full 32-bit hash (about n / 2^32 of them): one count each.
    edge = df.filter(F.col(h) == F.lit(hash_value))
    for value, count in sorted(tuple(r) for r in edge.groupBy(key).count().collect()):
        if need <= count:
            break
        need -= count
    if need == count:
        return Cut(hash_value=hash_value, key_value=value)
    if not parts:
        raise Copies
    # The boundary key repeats: its rows are cut by the next part.
    inside = rows.filter((F.col(h) == F.lit(hash_value)) & (F.col(key) == F.lit(value))).withColumn(key, F.lit(0))
    inner = find_cut(inside, parts[0], key, need, rows=inside, parts=parts[1:])
    return Cut(hash_value=hash_value, key_value=value, inner=inner)


_PARTS = ("__row_a", "__row_b", "__copy_a", "__copy_b")


def _halves(c: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(c, 32), c.bitwiseAND(F.lit(0xFFFFFFFF))


def split_exact(df: DataFrame, key: str, test_size: float = TEST_SIZE,
                validation_size: float = VALIDATION_SIZE,
                seeds: Sequence[int] = TRAIN_SEEDS, out_col: str = "split",
                how: str = "md5") -> DataFrame:
    """Exact-size two-stage split by (hash of the key, key, 64-bit hash of the row).

    Keys may repeat or be null (null keys hash as a token of their own); rows of
    one key stay together except at the two cuts, where the hash of the whole row
    decides. Of rows equal in every column across a cut, as many go in as the
    quota lacks; the table is written to the scratch folder with running ids for that.
    """
    try:
        return _split_exact(df, key, test_size, validation_size, seeds, out_col, how, None)
    except Copies:
        numbered = written(df.withColumn("__copy", F.monotonically_increasing_id()), "split-copies")
        return _split_exact(numbered, key, test_size, validation_size, seeds, out_col, how, "__copy").drop("__copy")


def _split_exact(df: DataFrame, key: str, test_size: float, validation_size: float, seeds: Sequence[int],
                 out_col: str, how: str, copy: str | None) -> DataFrame:
    h1c, h2c, kc = "__h1", "__h2", "__key"
    parts = [*_halves(F.xxhash64(F.lit(seeds[0]), *[F.col(f"`{c}`") for c in df.columns if c != copy]))]
    if copy:
        parts += _halves(F.col(copy))
    names = _PARTS[:len(parts)]
    h1, h2, token = _null_safe(key, seeds[0], how), _null_safe(key, seeds[1], how), _ordered(df, key)
    # The cut search scans the hashed keys several times: keep them (the key and
    # two longs) instead of recomputing md5 on every pass. Lost blocks are
    # recomputed from the scan. Whole rows are hashed only where a cut falls
    # inside one key.
    rows = df.select(token.alias(kc), h1.alias(h1c), h2.alias(h2c), *[p.alias(n) for p, n in zip(parts, names)])
    keyed = rows.select(kc, h1c, h2c).persist(StorageLevel.MEMORY_AND_DISK)
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)      # filled only if a cut asks for it
    try:
        top1 = sorted(tuple(r) for r in keyed.groupBy(F.shiftright(F.col(h1c), 16).alias("b"))
                      .count().collect())
        n = sum(c for _, c in top1)
        _, n_val, n_test = split_quotas(n, test_size, validation_size)
        cut1 = find_cut(keyed, h1c, kc, n_test, n, top1, kept, names)
        late = ~cut1.predicate(F.col(h1c), F.col(kc), [F.col(c) for c in names])
        # A cut inside one key asks for the row hash too: kept likewise for the second cut's passes.
        rest = keyed.filter(late) if cut1.inner is None else kept.filter(late)
        cut2 = find_cut(rest, h2c, kc, n_val, n - n_test, None, kept.filter(late), names)
    finally:
        keyed.unpersist()
        kept.unpersist()
    return df.withColumn(
        out_col,
        F.when(cut1.predicate(h1, token, parts), F.lit("test"))
        .when(cut2.predicate(h2, token, parts), F.lit("validation"))
        .otherwise(F.lit("train")))


def _null_safe(key: str, seed: int, how: str) -> Column:
    """The key's hash; a null key hashes as the seed's empty token."""
    return F.coalesce(hash32(key, seed, how), F.lit(seed).cast("long"))


def _ordered(df: DataFrame, key: str) -> Column:
    """The key in its own order where it is a number, else as text; nulls first."""
    if isinstance(df.schema[key].dataType, IntegralType):
        return F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    return key_token(key)


def split_exact_sql(table: str, key: str, test_size: float = TEST_SIZE,
                    validation_size: float = VALIDATION_SIZE,
                    seeds: Sequence[int] = TRAIN_SEEDS) -> str:
    """Brute-force SQL form: two nested global row_numbers (the oracle)."""
    return f"""
WITH h AS (
  SELECT {key}, {hash32_sql(key, seeds[0])} AS h1, {hash32_sql(key, seeds[1])} AS h2
  FROM {table}),
s1 AS (
  SELECT *, row_number() OVER (ORDER BY h1, {key}) AS rn1, count(*) OVER () AS n FROM h),
t AS (
  SELECT *, rn1 <= ceil(n * CAST({test_size!r} AS DOUBLE)) AS is_test FROM s1),
s2 AS (
  SELECT *, row_number() OVER (PARTITION BY is_test ORDER BY h2, {key}) AS rn2,
         count(*) OVER (PARTITION BY is_test) AS m FROM t)
SELECT {key},
       CASE WHEN is_test THEN 'test'
            WHEN rn2 <= ceil(m * CAST({validation_size!r} AS DOUBLE)) THEN 'validation'
            ELSE 'train' END AS split
FROM s2"""
