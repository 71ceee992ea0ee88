"""CSV against pandas, splits on hard keys, empty streams, weighted means, day tokens, scratch."""
import math
import os
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from appraise.functions.text import day_token
from appraise.operators.prepare import mean_price_hook
from appraise.operators.routing import routes_table
from appraise.operators.split import split_exact, split_fraction
from appraise.session import scratch_path
from appraise.sources.files import read_csv, write_csv
from appraise.streaming.events import records, run_requests, stream_notifications
from appraise.streaming.sinks import run_available

HARD = ['AVANZA "G", 1.3', "two\nlines", '""', "a;b", "x\\y", 'end"', "plain", " pad "]


def _local(path):
    return path.removeprefix("file:")


@pytest.mark.parametrize("sep", [",", ";"])
def test_csv_to_and_from_pandas(spark, sep):
    want = list(enumerate(HARD))
    path = scratch_path(spark, "csv")
    write_csv(spark.createDataFrame(want, "i int, t string").coalesce(1), path, sep=sep)
    file = [os.path.join(_local(path), f) for f in os.listdir(_local(path)) if f.endswith(".csv")][0]
    got = pd.read_csv(file, sep=sep, keep_default_na=False)
    assert [tuple(r) for r in got.itertuples(index=False)] == want
    back = scratch_path(spark, "csv")
    os.makedirs(_local(back))
    got.to_csv(os.path.join(_local(back), "a.csv"), sep=sep, index=False)
    rows = read_csv(spark, back, "t string, i int", sep=sep, multiline=True).collect()
    assert sorted((r.i, r.t) for r in rows) == want


def test_csv_with_another_header_order_fails(spark):
    path = scratch_path(spark, "csv")
    os.makedirs(_local(path))
    for name, text in (("a.csv", "Type,tahun,km\nA,2020,7\n"), ("b.csv", "Type,km,tahun\nA,7,2020\n")):
        with open(os.path.join(_local(path), name), "w") as f:
            f.write(text)
    assert read_csv(spark, path + "/a.csv", "km int, tahun int").first() == (7, 2020)
    assert read_csv(spark, path + "/b.csv", "km int, tahun int").first() == (7, 2020)
    with pytest.raises(Exception):
        read_csv(spark, path, "Type string, tahun int, km int").collect()


@pytest.mark.parametrize("keys", [
    [None] * 60 + list(range(940)), ["hot"] * 400 + [f"k{i}" for i in range(600)], [5] * 1000, list(range(1000)),
    [i % 30 for i in range(1000)], [None if i % 3 == 0 else "x" for i in range(1000)]])
def test_exact_split_sizes_on_hard_keys(spark, keys):
    kind = "string" if any(isinstance(k, str) for k in keys) else "long"
    df = spark.createDataFrame(list(zip(keys, range(1000))), f"k {kind}, n long").repartition(4)
    out = Counter(r.split for r in split_exact(df, "k").collect())
    assert out == {"test": 100, "validation": math.ceil(0.2 * 900), "train": 720}


def test_tied_equal_rows_are_split_to_size(spark):
    out = Counter(r.split for r in split_exact(spark.createDataFrame([("a",)] * 50, "k string"), "k").collect())
    assert out == {"test": 5, "validation": 9, "train": 36}


def test_fraction_split_of_null_keys_follows_the_seed(spark):
    df = spark.createDataFrame([(None,)] * 10, "k string")
    out = {s: {r.split for r in split_fraction(df, "k", seeds=(s, s)).collect()} for s in (1, (1 << 32) - 1)}
    assert all(len(v) == 1 for v in out.values()) and out[1] == {"test"} and out[(1 << 32) - 1] == {"train"}


def test_stream_without_files_gives_no_rows(spark):
    incoming, sink = scratch_path(spark, "in"), scratch_path(spark, "sink")
    os.makedirs(_local(incoming))
    out = run_requests(records(stream_notifications(spark, incoming)), routes_table(spark))
    assert run_available(out, sink, scratch_path(spark, "ckpt")) == 0
    assert spark.read.parquet(sink).count() == 0


def test_mean_price_weighs_lots(spark):
    crawl = spark.createDataFrame([("k", 100.0, 3), ("k", 200.0, 1), ("k", None, 9)], "k string, price double, n_lots long")
    auction = spark.createDataFrame([("k",), ("z",)], "k string")
    got = mean_price_hook(["k"], weight="n_lots")(auction, crawl).collect()
    assert {r.k: r.mean_price for r in got} == {"k": 125.0, "z": None}


def test_day_token_is_utc_in_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
        df = spark.range(1).select(F.timestamp_seconds(F.lit(1704063600)).alias("t"),
                                   F.lit("2024-01-01 23:00:00").cast("timestamp_ntz").alias("n"))
        assert df.select(day_token("t"), day_token("n")).first() == ("20231231", "20240101")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
