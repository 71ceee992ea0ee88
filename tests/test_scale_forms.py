"""Forms for large inputs against the plain ones: routes, labels, page lookup, split of copies, file order, publishing."""
import random

import pytest
from pyspark.sql import functions as F

from appraise.functions.labels import TRIM, label, label_by_table, rules_frame
from appraise.operators.lookup import bloom_words, landed_pages, may_hold
from appraise.operators.positional import with_file_position, zip_files
from appraise.operators.routing import route_paths
from appraise.operators.split import split_exact, split_quotas
from appraise.session import scratch_path
from appraise.sources.files import write_csv
from appraise.sources.publish import committed, committed_path, publish, sweep_list


def routes_frame(spark, needles):
    rows = [(f"r{i}", n, "", "run") for i, n in enumerate(needles)]
    return spark.createDataFrame(rows, "run_name string, model_type string, suffix string, x string") \
        .withColumn("prefix", F.lit(None).cast("string")).drop("x")


def test_routes_by_pieces_equal_contains(spark):
    rng = random.Random(1)
    parts = ["a", "ab", "toyota", "x", "lelang", "", "é"]
    paths = ["/".join(rng.choice(parts) for _ in range(rng.randrange(1, 7))) for _ in range(300)] + ["", None, "/", "//"]
    needles = sorted({"/".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(60)})
    df = spark.createDataFrame(list(enumerate(paths)), "i int, p string")
    got = route_paths(df, "p", routes_frame(spark, needles), few=3).select("i", "model_type").collect()
    want = [(i, n) for i, p in enumerate(paths) if p is not None for n in needles if n in p]
    assert sorted(map(tuple, got)) == sorted(want)
    plain = route_paths(df, "p", routes_frame(spark, needles), few=1000).select("i", "model_type").collect()
    assert sorted(map(tuple, plain)) == sorted(want)


def test_two_hundred_thousand_routes(spark):
    routes = spark.range(200_000).select(F.concat(F.lit("make"), F.col("id").cast("string")).alias("model_type"),
                                         F.lit("in/").alias("prefix"), F.lit("/lelang/").alias("suffix"), F.lit("r").alias("run_name"))
    paths = spark.range(2000).select("id", F.concat(F.lit("s3://b/in/make"), (F.col("id") * 101).cast("string"), F.lit("/lelang/d/f.csv")).alias("p"))
    out = route_paths(paths, "p", routes)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.filter(F.concat(F.lit("make"), (F.col("id") * 101).cast("string")) != F.col("model_type")).count() == 0
    assert out.count() == sum(i * 101 < 200_000 for i in range(2000))


def test_label_table_equals_case(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(" GEVSLOZX") for _ in range(rng.randrange(0, 14))) for _ in range(500)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = label_by_table(df, "t", rules_frame(spark, TRIM), TRIM.default, "a").withColumn("b", label("t", TRIM))
    assert both.count() == len(texts) and both.filter("NOT a <=> b").count() == 0


def test_label_table_of_fifty_thousand_keywords(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(1, 9))) for _ in range(60000)})[:50000]
    rng.shuffle(words)
    texts = ["".join(rng.choice("abcdefgh ijk") for _ in range(rng.randrange(0, 40))) for _ in range(300)]
    rules = spark.createDataFrame([(i, w, f"l{i % 9}") for i, w in enumerate(words)], "rank long, keyword string, label string")
    got = label_by_table(spark.createDataFrame([(t,) for t in texts], "t string"), "t", rules, "none", "label").collect()
    rank = {w: i for i, w in enumerate(words)}
    for r in got:
        held = [rank[r.t[i:j]] for i in range(len(r.t)) for j in range(i + 1, min(len(r.t), i + 9) + 1) if r.t[i:j] in rank]
        assert r.label == (f"l{min(held) % 9}" if held else "none")
    assert len(got) == len(texts)
    with_empty = rules.limit(20).unionByName(spark.createDataFrame([(10, "", "all")], rules.schema)).filter("rank <> 10 OR keyword = ''")
    got = label_by_table(spark.createDataFrame([("zzz",), (None,)], "t string"), "t", with_empty, "none", "label").collect()
    assert {r.t: r.label for r in got} == {"zzz": "all", None: None}


def test_pages_not_wanted_never_reach_an_exchange(spark):
    pages = spark.range(5000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), F.repeat(F.lit("x"), 50).alias("html")) \
        .unionByName(spark.createDataFrame([(None, "y")], "url string, html string"))
    wanted = spark.range(100).select(F.concat(F.lit("u"), (F.col("id") * 60).cast("string")).alias("url"))
    assert sorted(r.url for r in landed_pages(pages, wanted).collect()) == sorted(f"u{i * 60}" for i in range(84))
    bits = 2048
    kept = may_hold(pages, "url", bloom_words(wanted, "url", bits), bits)
    assert kept.join(wanted, "url").count() == 84 and kept.count() < 300
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = landed_pages(pages, wanted)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    page_side = plan[plan.index("SortMergeJoin"):]
    exchange = page_side.index("Exchange hashpartitioning(url")
    assert page_side[exchange:].count("BroadcastHashJoin") >= 2       # the filter runs below the exchange


@pytest.mark.parametrize("n,distinct", [(1000, 6), (1000, 1), (101, 3), (7, 2), (1, 1), (0, 1)])
def test_split_exact_of_copies(spark, n, distinct):
    df = spark.range(n).select((F.col("id") % distinct).alias("k"), F.lit("same").alias("t")).repartition(4)
    train, validation, test = split_quotas(n)
    got = {r["split"]: r["count"] for r in split_exact(df, "k").groupBy("split").count().collect()}
    assert (got.get("train", 0), got.get("validation", 0), got.get("test", 0)) == (train, validation, test)
    if n == 1000 and distinct == 6:
        assert (test, validation, train) == (100, 180, 720)
        keyless = spark.range(n).select(F.lit(None).cast("string").alias("k"))
        got = {r["split"]: r["count"] for r in split_exact(keyless, "k").groupBy("split").count().collect()}
        assert got == {"train": 720, "validation": 180, "test": 100}


def test_lines_of_many_blocks_meet_by_number(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        paths = [scratch_path(spark, x) for x in ("l", "r")]
        write_csv(spark.range(1500).selectExpr("id", "concat('v', id) AS v").orderBy(F.desc("id")).coalesce(2), paths[0])
        write_csv(spark.range(1300).selectExpr("id AS j", "repeat('w', int(id % 9)) AS w").orderBy("j").coalesce(1), paths[1], header=False)
        left = spark.read.option("header", True).schema("id bigint, v string").csv(paths[0])
        right = spark.read.schema("j bigint, w string").csv(paths[1])
        assert left.rdd.getNumPartitions() > 8
        files = sorted(r.f for r in left.select("_metadata.file_path").distinct().withColumnRenamed("file_path", "f").collect())
        order = [r.id for f in files for r in spark.read.option("header", True).schema("id bigint, v string").csv(f).coalesce(1).collect()]
        out = zip_files(left, right)
        assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.pos, r.id, r.j) for r in out.collect())
        assert len(got) == 1500 and [p for p, _, _ in got] == list(range(1500))
        assert [i for _, i, _ in got] == order
        assert [j for _, _, j in got[:1300]] == list(range(1300)) and got[1300][2] is None
        assert with_file_position(right).filter("pos <> j").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_half_written_run_is_never_read_and_rerun_replaces(spark):
    base = scratch_path(spark, "pub")

    def tables(n, dies=False):
        def fail(path):
            raise OSError("lost")
        write = lambda path: spark.range(n).write.parquet(path)
        return [("train", write), ("test", fail if dies else write)]
    first = publish(spark, base, "toyota", "20240101", tables(3))
    with pytest.raises(OSError):
        publish(spark, base, "toyota", "20240101", tables(4, dies=True))
    path = committed_path(spark, base, "toyota", "20240101")
    assert path.endswith(first) and spark.read.parquet(f"{path}/train").count() == 3
    second = publish(spark, base, "toyota", "20240101", tables(5))
    later = publish(spark, base, "toyota", "20240102", tables(6))
    publish(spark, base, "daihatsu", "20240103", tables(7))
    assert committed_path(spark, base, "toyota", "20240101").endswith(second)
    assert committed_path(spark, base, "toyota").endswith(later)
    assert committed_path(spark, base, "honda") is None
    assert committed(spark, base).count() == 3
    lost = {r.run_id for r in sweep_list(spark, base).collect()}
    assert first in lost and second not in lost and len(lost) == 2
