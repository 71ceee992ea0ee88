"""Outputs published as a whole.

A run writes everything into a folder of its own, ``{base}/runs/{run_id}``, and then
appends one row to ``{base}/manifest``; that row, one file put in place at once, is the
commit. Readers go by the manifest alone, so they see all of a run or nothing of it:
a run killed between two of its tables leaves a folder that no row names. A rerun
of a day commits a newer row and takes the older one's place; ``sweep_list`` names
the folders that no reader can reach any more.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = ("model_type string, run_date string, run_id string, path string, tables array<string>, "
                   "committed_at timestamp")


def publish(spark: SparkSession, base: str, model_type: str, run_date: str,
            tables: Sequence[tuple[str, Callable[[str], None]]], committed_at: dt.datetime | None = None) -> str:
    """Write each (name, write) into the run's folder, ``write(path)`` one after the other, then commit.

    Returns the run id. If a writer fails nothing is committed.
    """
    run_id = uuid.uuid4().hex[:12]
    path = f"{base}/runs/{run_id}"
    for name, write in tables:
        write(f"{path}/{name}")
    at = committed_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    spark.createDataFrame([(model_type, run_date, run_id, path, [n for n, _ in tables], at)], MANIFEST_SCHEMA) \
        .coalesce(1).write.mode("append").parquet(f"{base}/manifest")
    return run_id


def committed(spark: SparkSession, base: str) -> DataFrame:
    """The manifest row in force per (model_type, run_date): the newest, ties by run id."""
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{base}/manifest")
    newest = F.max(F.struct("committed_at", "run_id", "path", "tables")).alias("m")
    return rows.groupBy("model_type", "run_date").agg(newest).select("model_type", "run_date", "m.*")


def committed_path(spark: SparkSession, base: str, model_type: str, run_date: str | None = None) -> str | None:
    """Folder of the run in force of a make and day (newest day if not given); None if there is none."""
    rows = committed(spark, base).filter(F.col("model_type") == model_type)
    if run_date is not None:
        rows = rows.filter(F.col("run_date") == run_date)
    row = rows.orderBy(F.desc("run_date")).first()
    return row["path"] if row else None


def sweep_list(spark: SparkSession, base: str) -> DataFrame:
    """``run_id`` of replaced and never committed runs, from the files that lie under ``runs``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{base}/runs").select("path")
    there = files.select(F.regexp_extract("path", "/runs/([^/]+)/", 1).alias("run_id")).distinct()
    return there.join(committed(spark, base).select("run_id"), "run_id", "left_anti")
