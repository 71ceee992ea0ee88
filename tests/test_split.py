import duckdb
import pytest

from appraise.operators.split import (split_exact, split_exact_sql, split_fraction,
                                      split_quotas)
from conftest import SMALL


@pytest.mark.parametrize("n,test,val,train", [(1000, 100, 180, 720), (101, 11, 18, 72),
                                              (7, 1, 2, 4)])
def test_quotas(n, test, val, train):
    assert split_quotas(n) == (train, val, test)


def test_exact_sizes_and_brute_force(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").select("o_orderkey")
    got = {r[0]: r[1] for r in split_exact(orders, "o_orderkey").collect()}
    n = len(got)
    train, val, test = split_quotas(n)
    counts = {s: sum(1 for v in got.values() if v == s) for s in ("train", "validation", "test")}
    assert counts == {"train": train, "validation": val, "test": test}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{SMALL}/orders.parquet'")
    want = dict(con.execute(split_exact_sql("orders", "o_orderkey")).fetchall())
    assert got == want


def test_exact_split_ignores_partitioning(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").select("o_orderkey")
    a = {tuple(r) for r in split_exact(orders, "o_orderkey").collect()}
    b = {tuple(r) for r in split_exact(orders.repartition(7), "o_orderkey").collect()}
    assert a == b


def test_exact_split_small_quota_ties(spark):
    df = spark.range(7).withColumnRenamed("id", "k")
    out = split_exact(df, "k").groupBy("split").count().collect()
    assert {r[0]: r[1] for r in out} == {"test": 1, "validation": 2, "train": 4}


def test_fraction_split_is_a_projection(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").select("o_orderkey")
    df = split_fraction(orders, "o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    counts = {r[0]: r[1] for r in df.groupBy("split").count().collect()}
    n = sum(counts.values())
    assert abs(counts["test"] / n - 0.1) < 0.03
    assert abs(counts["validation"] / n - 0.18) < 0.04
    assert split_fraction(orders.repartition(5), "o_orderkey").exceptAll(df).count() == 0


def test_xxhash_exact_split_sizes(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    out = {r[0]: r[1] for r in split_exact(df, "k", how="xxhash64").groupBy("split").count()
           .collect()}
    train, val, test = split_quotas(5000)
    assert out == {"train": train, "validation": val, "test": test}
    a = {tuple(r) for r in split_exact(df.repartition(3), "k", how="xxhash64").collect()}
    b = {tuple(r) for r in split_exact(df, "k", how="xxhash64").collect()}
    assert a == b
