"""Quoted CSV in blocks against Spark's own whole-file reader."""
import random

import pytest
from pyspark.sql import functions as F

from appraise.session import scratch_path
from appraise.sources.csv_blocks import block_lines, csv_records, read_quoted_csv
from appraise.sources.files import read_csv, write_csv

SCHEMA = "a bigint, t string, b double"


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def made(n, seed, longest=12):
    rng = random.Random(seed)
    bits = ["word", "\n", '"', ",", ";", " ", "é", '""', "\n\n", "x" * 40, "\r\n"]
    return [(i, "q" + "".join(rng.choice(bits) for _ in range(rng.randrange(longest))) + "z", i / 4) for i in range(n)]


@pytest.mark.parametrize("sep,files,seed", [(",", 1, 1), (";", 1, 2), (",", 3, 3)])
def test_many_blocks_equal_the_whole_file_reader(spark, small_blocks, sep, files, seed):
    rows = made(600, seed) + [(1000, "q" + "long\n" * 900 + "z", 1.0), (1001, 'q"' * 701, 2.0)]
    path = scratch_path(spark, "csv")
    write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(files), path, sep=sep)
    lines = block_lines(spark, path)
    assert lines.select("file", "block").distinct().count() > 20 and lines.rdd.getNumPartitions() > 20
    got = sorted(map(tuple, read_quoted_csv(spark, path, SCHEMA, sep).collect()))
    assert got == sorted(map(tuple, read_csv(spark, path, SCHEMA, sep, multiline=True).collect()))
    assert got == sorted(rows)


def test_headerless_and_order_of_columns(spark, small_blocks):
    rows = made(200, 5)
    path = scratch_path(spark, "csv")
    write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, header=False)
    assert sorted(map(tuple, read_quoted_csv(spark, path, SCHEMA, header=False).collect())) == sorted(rows)
    path = scratch_path(spark, "csv")
    write_csv(spark.createDataFrame(rows, SCHEMA).select("b", "a", "t").coalesce(1), path)
    assert sorted(map(tuple, read_quoted_csv(spark, path, "t string, a bigint").collect())) == sorted((t, a) for a, t, _ in rows)


def test_errors_and_empty(spark, small_blocks):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("a,t\n1,\"open\n" + "x\n" * 900,)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception, match="not closed"):
        csv_records(spark, path).collect()
    path = scratch_path(spark, "csv")
    write_csv(spark.createDataFrame(made(5, 1), SCHEMA), path)
    with pytest.raises(ValueError, match="missing"):
        read_quoted_csv(spark, path, "nope string")
    other = spark.createDataFrame(made(5, 1), SCHEMA).withColumnRenamed("t", "u")
    write_csv(other, path, mode="append")
    with pytest.raises(ValueError, match="differ"):
        read_quoted_csv(spark, path, SCHEMA)
    empty = scratch_path(spark, "csv")
    spark.createDataFrame([], "value string").write.text(empty)
    assert read_quoted_csv(spark, empty, SCHEMA).collect() == []


def test_carriage_returns_and_blank_lines(spark):
    path = scratch_path(spark, "csv")
    text = 'a,t,b\r\n1,"x\r\ny",0.5\r\n\n2,plain,\r\n'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    got = sorted(map(tuple, read_quoted_csv(spark, path, "a bigint, t string").filter(F.col("a").isNotNull()).collect()))
    assert got == [(1, "x\r\ny"), (2, "plain")]


def test_blocks_are_cut_into_records_once(spark, tmp_path):
    """The result's plan cuts the blocks once; headers and edge pieces come from the scratch folder."""
    path = str(tmp_path / "once")
    spark.createDataFrame([(1, 'a\n"b"'), (2, "c")], "a bigint, t string").repartition(2).write.option("escape", '"').option(
        "header", True).csv(path)
    df = read_quoted_csv(spark, path, "a bigint, t string")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(tuple, df.collect())) == [(1, 'a\n"b"'), (2, "c")]
