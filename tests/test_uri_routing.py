import pytest

from appraise.functions import text, uri
from appraise.operators.routing import routes_table, route_paths

KEYS = ["a", "a/b", "a/b/c", "a/b/c/d", "a/b/c/d/e", "in/training/toyota/lelang/20240101/a.csv",
        "", "/x/y/z/w"]


def test_key_arithmetic_matches_python(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "k string")
    out = df.select("k", uri.drop_last_levels("k", 3).alias("p"), uri.base_name("k").alias("b"),
                    uri.first_level("k").alias("f")).collect()
    for r in out:
        assert r["p"] == r["k"].rsplit("/", 3)[0], r["k"]
        assert r["b"] == r["k"].split("/")[-1]
        assert r["f"] == r["k"].split("/", 1)[0]


def test_bucket_and_key(spark):
    u = "s3://bkt/in/training/toyota/lelang/20240101/a.csv"
    r = spark.createDataFrame([(u,)], "u string").select(
        uri.bucket("u").alias("b"), uri.key("u").alias("k"),
        uri.strip_scheme("u").alias("s")).first()
    assert r["b"] == u.split("/")[2]
    assert r["k"] == "/".join(u.split("/")[3:])
    assert r["s"] == u.replace("s3://", "")


def test_capitalize_is_not_initcap(spark):
    r = spark.createDataFrame([("toyota yaris",)], "t string") \
        .select(text.capitalize("t").alias("c")).first()
    assert r["c"] == "toyota yaris".capitalize()


def test_routes_fixture(spark):
    paths = spark.createDataFrame(
        [("s3://b/in/training/toyota/lelang/20240101/a.csv",),
         ("s3://b/in/training/daihatsu/other/a.csv",)], "path string")
    out = route_paths(paths, "path", routes_table(spark)).collect()
    assert [(r["model_type"], r["run_name"]) for r in out] == [("toyota", "Training-Toyota")]


def test_many_routes_have_no_bound(spark):
    routes = routes_table(spark, [f"m{i}" for i in range(10_500)])
    paths = spark.createDataFrame([("in/m7/lelang/a.csv",), ("in/m10499/lelang/b.csv",), ("in/m/lelang/c.csv",)], "p string")
    got = {(r.p, r.model_type) for r in route_paths(paths, "p", routes).collect()}
    assert got == {("in/m7/lelang/a.csv", "m7"), ("in/m10499/lelang/b.csv", "m10499")}
