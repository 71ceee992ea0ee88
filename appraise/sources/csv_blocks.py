"""Quoted CSV with newlines inside fields, read by many tasks.

A newline ends a record only outside quotes, and a task that starts in the middle of a
file cannot see on which side it is. So the file is read as plain lines, block by
block, three times. The first pass counts the quotes of every block; their running parity over
a file's blocks (one row per block) says which blocks begin inside a quoted field. In the
other passes a block, told its state, cuts its lines into records while they stream
through. The second keeps the headers and the pieces of records that cross a block's edge, at
most two per block, in the scratch folder, where they are shuffled and joined up; the third
gives all other records. Records become columns by ``from_csv``. Doubled quotes
leave the parity as it is, so they need no care.

Results equal those of Spark's own ``multiLine`` reader, which reads a whole file in one task.
A file whose quotes do not balance is an error, as are a header that differs
between files and a missing column. An empty folder gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from appraise.session import written

WHOLE, HEAD, TAIL = 0, 1, 2       # a record; the end of one begun before the block; the beginning of one not ended in it

_PIECES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.int8()), ("first", pa.bool_()),
                     ("closed", pa.bool_()), ("text", pa.string())])
_PIECES_DDL = "file string, block long, kind byte, first boolean, closed boolean, text string"


def block_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, block, value``: physical lines with the place of their file block."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def open_blocks(lines: DataFrame) -> DataFrame:
    """``file, block, is_open``: whether a block begins inside quotes. One row per block."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    per = lines.groupBy("file", "block").agg(F.sum(quotes.cast("long")).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1).alias("is_open"))


class _Block:
    """The lines of one block as they stream through."""

    def __init__(self, file, block, is_open):
        self.file, self.block, self.is_open = file, block, is_open
        self.held: list[str] | None = [] if is_open else None
        self.kind = HEAD if is_open else WHOLE
        self.first = block == 0

    def _piece(self, kinds, firsts, closed, texts):
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.file] * n, pa.string()), pa.array([self.block] * n, pa.int64()), pa.array(kinds, pa.int8()),
             pa.array(firsts, pa.bool_()), pa.array(closed, pa.bool_()), texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())],
            schema=_PIECES)

    def take(self, values: pa.Array):
        quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
        after = (np.cumsum(quotes) + self.is_open) % 2 == 1
        if not self.is_open and not after.any():            # every line is a record
            yield self._piece([WHOLE] * len(values), [self.first] + [False] * (len(values) - 1), [True] * len(values), values)
            self.first = False
            return
        lines, start, kinds, firsts, texts = values.to_pylist(), 0, [], [], []
        for end in np.flatnonzero(~after).tolist():
            held = self.held or []
            texts.append("\n".join([*held, *lines[start:end + 1]]))
            kinds.append(HEAD if self.kind == HEAD else WHOLE)
            firsts.append(self.first and self.kind != HEAD)
            self.first, self.kind, self.held, start = False, WHOLE, None, end + 1
        if start < len(lines):
            self.held = (self.held or []) + lines[start:]
            if self.kind != HEAD:
                self.kind = TAIL
        self.is_open = bool(after[-1])
        if texts:
            yield self._piece(kinds, firsts, [True] * len(texts), texts)

    def end(self):
        if self.held:
            yield self._piece([self.kind], [self.first and self.kind == TAIL], [False], ["\n".join(self.held)])


def _records(batches):
    now = None
    for batch in batches:
        files, blocks, is_open = (batch.column(c).to_pylist() for c in ("file", "block", "is_open"))
        keys = list(zip(files, blocks))
        starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        for s, e in zip(starts, [*starts[1:], len(keys)]):
            if now is None or (now.file, now.block) != keys[s]:
                if now is not None:
                    yield from now.end()
                if is_open[s] is None:
                    raise ValueError("the file was split into other blocks than in the first pass: read it again")
                now = _Block(*keys[s], is_open[s])
            yield from now.take(batch.column("value").slice(s, e - s))
    if now is not None:
        yield from now.end()


def csv_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``record, first``: the text of every record; ``first`` marks the first of its file."""
    lines = block_lines(spark, path)
    # A table of one row per file block, held by every task: 100 TB in blocks of 128 MB are 800,000 rows.
    known = lines.join(F.broadcast(written(open_blocks(lines), "csv-blocks")), ["file", "block"], "left")
    pieces = known.select("file", "block", "is_open", "value").mapInArrow(_records, _PIECES_DDL)
    kept = written(pieces.filter((F.col("kind") != WHOLE) | F.col("first")), "csv-edges")
    # The literal lets a search for headers skip the pass over all records.
    whole = pieces.filter((F.col("kind") == WHOLE) & ~F.col("first")).select(F.col("text").alias("record"), F.lit(False).alias("first"))
    heads = kept.filter(F.col("kind") == WHOLE).select(F.col("text").alias("record"), "first")
    torn = kept.filter(F.col("kind") != WHOLE)
    # Edge pieces in file order: a tail begins a record, heads go on until one is closed.
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    place = torn.select("file", "block", "kind", "closed").withColumn(
        "nth", F.sum((F.col("kind") == TAIL).cast("long")).over(order))
    joined = torn.drop("closed").join(place, ["file", "block", "kind"]).groupBy("file", "nth").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "kind", "text"))), lambda p: p["text"]),
                     "\n").alias("record"),
        F.max("first").alias("first"), F.max("closed").alias("closed"))
    ended = joined.withColumn("record", F.when(F.col("closed"), F.col("record")).otherwise(
        F.raise_error(F.concat(F.lit("a quote is not closed in "), "file"))))
    return whole.unionByName(heads).unionByName(ended.select("record", "first"))


def read_quoted_csv(spark: SparkSession, path: str | Sequence[str], schema: str | StructType, sep: str = ",",
                    header: bool = True) -> DataFrame:
    """Delimited text whose quoted fields may hold newlines, split over tasks.

    With a header, declared columns are found by name and cast; without one they are positional.
    """
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    records = csv_records(spark, path)
    bare = F.regexp_replace("record", "\r$", "")
    rows = records.select(F.when(F.col("first"), F.ltrim(bare, F.lit("﻿"))).otherwise(bare).alias("record"), "first") \
        .filter(F.col("record") != "")
    how = {"sep": sep, "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    if not header:
        return rows.select(F.from_csv("record", st.simpleString()[len("struct<"):-1].replace(":", " "), how).alias("r")).select("r.*")
    heads = [r["record"] for r in rows.filter("first").select("record").distinct().limit(2).collect()]
    if len(heads) > 1:
        raise ValueError(f"headers differ between the files of {path}: {heads}")
    if not heads:
        return spark.createDataFrame([], st)
    names = _fields(spark, heads[0], how)
    missing = [f.name for f in st.fields if f.name not in names]
    if missing:
        raise ValueError(f"columns {missing} missing from {path}")
    every = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    ddl = ", ".join(f"{f.name} string" for f in every)
    parsed = rows.filter(~F.col("first")).select(F.from_csv("record", ddl, how).alias("r"))
    return parsed.select(*[F.col(f"r.c{names.index(f.name)}").cast(f.dataType).alias(f.name) for f in st.fields])


def _fields(spark: SparkSession, line: str, how: dict) -> list[str]:
    """The names of a header record."""
    wide = line.count(how["sep"]) + 1
    row = spark.range(1).select(F.from_csv(F.lit(line), ", ".join(f"c{i} string" for i in range(wide)), how | {"mode": "PERMISSIVE"})
                                .alias("r")).select("r.*").first()
    return [x for x in row if x is not None]
