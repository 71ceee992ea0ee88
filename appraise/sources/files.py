"""Delimited-file sources and sinks, object listings and newest-file choice.

Schemas are declared per feed (``inferSchema`` costs a full extra pass over the
data and guesses types per file). Sinks partition by run attributes
(``model_type``, ``split``, ``run_date``) instead of composing dated keys by
hand; with dynamic partition overwrite a rerun replaces only its own
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from appraise.operators.latest import latest_with_fallback

# The auction file kinds, in order of preference.
AUCTION_SUFFIXES = (".csv", ".xlsx")


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str | StructType,
             sep: str = ",", header: bool = True, by_name: bool = True,
             multiline: bool = False) -> DataFrame:
    """Header (or headerless) delimited text with a declared schema.

    Quotes inside fields are doubled, as other CSV writers do. With a header,
    declared columns are matched by *name* and cast JVM-side; a missing column
    fails, and so does a file whose header differs from the first file's (it is
    never read under the wrong names). Headerless files are positional.
    ``multiline`` allows newlines inside fields; such files are not split, so
    keep them small.
    """
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def reader():
        return (spark.read.option("sep", sep).option("mode", "FAILFAST").option("escape", '"')
                .option("multiLine", multiline))

    if not (header and by_name):
        return reader().schema(st).option("header", header).csv(path)
    names = reader().option("header", True).option("inferSchema", False).csv(path)
    missing = [f.name for f in st.fields if f.name not in names.columns]
    if missing:
        raise ValueError(f"columns {missing} missing from {path}")
    files = StructType([f for f in names.schema.fields if f.name in _file_columns(names)])
    raw = reader().schema(files).option("header", True).option("enforceSchema", False).csv(path)
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in st.fields])


def _file_columns(df: DataFrame) -> set[str]:
    """Columns held in the files themselves: partition folders come back typed, file text as strings."""
    return {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}


def read_headerless(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """Positional columns named by the declared schema (e.g. ``prediksi DOUBLE``)."""
    return read_csv(spark, path, schema, header=False)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
              partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Delimited text; partitions replaced dynamically on overwrite."""
    # Per-write option: only this write replaces partitions dynamically; the
    # session setting seen by other writes is left alone.
    w = (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .option("header", header).option("sep", sep).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_dated(df: DataFrame, path: str, run_date: str, model_type: str | None = None,
                header: bool = True, sep: str = ",", fmt: str = "csv") -> None:
    """``{path}/model_type=.../run_date=yyyymmdd/`` layout of a run's output."""
    out = df.withColumn("run_date", F.lit(run_date))
    parts = ["run_date"]
    if model_type is not None:
        out = out.withColumn("model_type", F.lit(model_type))
        parts = ["model_type", "run_date"]
    if fmt == "csv":
        write_csv(out, path, header=header, sep=sep, partition_by=parts)
    else:
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).format(fmt).save(path))


def write_splits(df: DataFrame, path: str, target: str, run_date: str,
                 model_type: str | None, split_col: str = "split", fmt: str = "csv") -> None:
    """Target-first rows, one folder per (model_type, split, run_date).

    The CSV form is headerless, as the training reader expects. ``model_type``
    None gives the older layout without a make level: (split, run_date).
    """
    feats = [c for c in df.columns if c not in (target, split_col)]
    out = df.select(target, *feats, split_col).withColumn("run_date", F.lit(run_date))
    parts = [split_col, "run_date"]
    if model_type is not None:
        out = out.withColumn("model_type", F.lit(model_type))
        parts = ["model_type"] + parts
    if fmt == "csv":
        write_csv(out, path, header=False, partition_by=parts)
    else:
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).format(fmt).save(path))


def read_split(spark: SparkSession, path: str, schema: str, model_type: str | None, split: str,
               run_date: str | None = None) -> DataFrame:
    """One split back, positional columns named by ``schema`` (partition-pruned path)."""
    p = f"{path}/model_type={model_type}/split={split}" if model_type is not None \
        else f"{path}/split={split}"
    p = f"{p}/run_date={run_date}" if run_date else f"{p}/*"
    return read_headerless(spark, p, schema)


def read_splits(spark: SparkSession, path: str, schema: str, model_type: str | None,
                run_date: str, split_col: str = "split") -> DataFrame:
    """Every split of one run in one scan: ``split`` comes from the folder names
    (partition discovery) and the run date is pruned by partition filter."""
    base = f"{path}/model_type={model_type}" if model_type is not None else path
    df = read_headerless(spark, base, schema)
    return (df.filter(F.col("run_date").cast("string") == F.lit(run_date))
            .select(F.col(split_col).cast("string").alias(split_col),
                    *StructType.fromDDL(schema).fieldNames()))


def list_objects(spark: SparkSession, pattern: str, recursive: bool = True) -> DataFrame:
    """(path, modificationTime, length) of every file under a glob; content is not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
            .load(pattern).select("path", "modificationTime", "length"))


def read_bodies(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, content) of every file: file bodies as bytes."""
    return spark.read.format("binaryFile").load(pattern).select("path", "content")


def latest_file(listing: DataFrame, suffixes: Sequence[str] = AUCTION_SUFFIXES) -> str | None:
    """Newest path of the first suffix present, else of the next (ties: smallest path)."""
    row = latest_with_fallback(listing, [], "path", list(suffixes), "modificationTime",
                               "path", ["path"]).first()
    return row["path"] if row else None
