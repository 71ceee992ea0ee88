import datetime as dt

from appraise.operators.latest import latest_per_key
from appraise.operators.positional import zip_join, with_position
from appraise.sources.files import latest_file

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)


def listing(spark, rows):
    return spark.createDataFrame(rows, "path string, modificationTime timestamp")


def test_newest_file_rules(spark):
    # equal times -> smallest path
    assert latest_file(listing(spark, [("b.csv", T0), ("a.csv", T0)])) == "a.csv"
    # newer .xlsx beside older .csv -> the .csv
    assert latest_file(listing(spark, [("new.xlsx", T1), ("old.csv", T0)])) == "old.csv"
    # only .xlsx -> the .xlsx
    assert latest_file(listing(spark, [("x.xlsx", T0), ("y.xlsx", T1)])) == "y.xlsx"
    assert latest_file(listing(spark, [("x.txt", T0)])) is None


def test_latest_per_key_hot_key(spark):
    rows = [("hot", i, T0 + dt.timedelta(seconds=i % 50)) for i in range(3000)] + \
           [("cold", 1, T0)]
    df = spark.createDataFrame(rows, "k string, id long, ts timestamp")
    got = {r["k"]: r["id"] for r in latest_per_key(df, ["k"], "ts", "id", ["id"]).collect()}
    assert got == {"hot": 49, "cold": 1}


def test_zip_pads_shorter_side(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "a long, av string")
    b = spark.createDataFrame([(10, "p"), (20, "q")], "b long, bv string")
    rows = sorted(zip_join(a, b, ["a"], ["b"]).collect(), key=lambda r: r["pos"])
    assert [(r["a"], r["b"]) for r in rows] == [(1, 10), (2, 20), (3, None)]


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 9).withColumnRenamed("id", "k").orderBy("k")
    pos = with_position(df.repartition(13), ["k"]).collect()
    assert sorted((r["pos"], r["k"]) for r in pos) == [(i, i) for i in range(5000)]


def test_wall_clock_order_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("""SELECT * FROM VALUES
            ('k', 1L, timestamp_ntz'2024-03-10 03:30:00'),
            ('k', 0L, timestamp_ntz'2024-03-10 02:30:00') AS t(k, id, ts)""")
        got = latest_per_key(df, ["k"], "ts", "id", ["id"]).first()["id"]
        assert got == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_positions_spread_a_hot_order_key(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") < 2000, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    out = with_position(df, ["k"])
    pos = sorted(r["pos"] for r in out.collect())
    assert pos == list(range(6000))
    # rows of the hot key sit in one block of positions, before every other key
    hot = sorted(r["pos"] for r in out.filter("k = 0").collect())
    assert hot == list(range(2000))
