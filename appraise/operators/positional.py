"""Positional (zip) join: row i of one table beside row i of the other.

Spark tables have no row order, so each side states its order. Positions are
assigned without a global single-partition sort: the side is range-partitioned
on its order key and sorted within partitions, each row takes its local index
(``monotonically_increasing_id`` minus the partition's first id), the result is
checkpointed to the shared checkpoint folder (so ids stay fixed if an executor
is lost), and per-partition counts (one row per partition, a bounded table)
give each partition its offset. The two sides then meet in an equi-join on the
unique position (no skew possible), full outer so the shorter side pads with
NULLs.

Files do have an order: their names, and the lines in them. ``with_file_position``
numbers the rows of a file scan that way without any sort: a row's place in its block
is its running id minus the block's first, and the counts of the blocks before it
(one row per block) give the offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_position(df: DataFrame, order_by: Sequence[str], name: str = "pos") -> DataFrame:
    """Add a 0-based position following ``order_by`` (ascending)."""
    # A hash of the whole row breaks ties among equal order keys, so a key value
    # repeated across a third of the rows still spreads over many range partitions.
    tie = F.xxhash64(*[F.col(c) for c in df.columns]).alias("__tie")
    cols = [F.col(c).asc() for c in order_by] + [F.col("__tie").asc()]
    local = (df.withColumn("__tie", tie).repartitionByRange(*cols).sortWithinPartitions(*cols)
             .withColumn("__pid", F.spark_partition_id())
             .withColumn("__mid", F.monotonically_increasing_id())
             .checkpoint(eager=True))
    counts = local.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"),
                                        F.min("__mid").alias("__first"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: the window over it is tiny by construction.
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    return (local.join(F.broadcast(offsets.select("__pid", "__off", "__first")), "__pid")
            .withColumn(name, F.col("__off") + F.col("__mid") - F.col("__first"))
            .drop("__pid", "__mid", "__off", "__first", "__tie"))


def with_file_position(scan: DataFrame, name: str = "pos") -> DataFrame:
    """Add a 0-based position in file order to a plain file scan (``spark.read...``, unfiltered).

    Files follow one another by path. Blank lines and headers, which the reader
    skips, have no position.
    """
    rows = scan.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
                       F.monotonically_increasing_id().alias("__mid"))
    blocks = rows.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    # One row per file block: the window and the broadcast are small by construction.
    w = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    return (rows.join(F.broadcast(offsets.select("__file", "__block", "__off", "__first")), ["__file", "__block"])
            .withColumn(name, F.col("__off") + F.col("__mid") - F.col("__first"))
            .drop("__file", "__block", "__mid", "__off", "__first"))


def zip_files(left: DataFrame, right: DataFrame, name: str = "pos") -> DataFrame:
    """Line i of one set of files beside line i of another; the shorter side is padded with NULLs."""
    return with_file_position(left, name).join(with_file_position(right, name), name, "full_outer")


def zip_join(left: DataFrame, right: DataFrame, left_order: Sequence[str],
             right_order: Sequence[str], name: str = "pos") -> DataFrame:
    """Row-by-row concatenation; the shorter side is padded with NULLs."""
    lp = with_position(left, left_order, name)
    rp = with_position(right, right_order, name)
    return lp.join(rp, name, "full_outer")
