"""Shared helpers of the training-data operators.

Words are maximal runs of characters outside ``[\\x20\\x09-\\x0D]``; a null text
counts as the empty text everywhere. Intermediate tables are written to the
folder named by ``spark.checkpoint.dir`` (``cut``), so a lost executor never
loses them and lineage stays short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from appraise.session import scratch_path

SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
NO_ID = -(1 << 63)          # stands for a null id inside tasks (sorts first)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def id_of(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(f"`{col}`").cast("long"), F.lit(NO_ID))


def real_id(col: str) -> Column:
    """Back from the inner id: null where the id was null."""
    return F.when(F.col(col) != NO_ID, F.col(col))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, _th, _text``: rows of one id but different texts are different documents."""
    d = docs.select(id_of(id_col).alias("_id"), text_of(text_col).alias("_text"))
    return d.select("_id", F.xxhash64("_text").alias("_th"), "_text")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: computed once, survives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def one_thread() -> None:
    """Keep numpy's linear algebra to one thread: a task has one core, and further threads only wait on it."""
    import ctypes
    import glob
    import os
    for path in glob.glob(os.path.join(os.path.dirname(np.__file__), os.pardir, "numpy.libs", "*openblas*")):
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_",
                     "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def binary_rows(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string (or binary) Arrow column, without decoding."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    width = np.int64 if large else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width, count=column.offset + len(column) + 1)[column.offset:]
    whole = memoryview(data) if data is not None else memoryview(b"")
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        yield bytes(whole[a:b])


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema)
