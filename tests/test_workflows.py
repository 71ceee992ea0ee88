import datetime as dt


from appraise.operators.latest import latest_one, top_k
from appraise.operators.prepare import mean_price_hook
from appraise.plans.workflows import export_splits, prepare
from appraise.session import scratch_path
from appraise.sources.files import read_split
from appraise.sources.registry import typed_params


def _auction(spark, n=1000):
    return spark.createDataFrame(
        [(float(i), f"T{i % 5}", 2010 + i % 7, float(i % 11)) for i in range(n)],
        "harga double, Type string, tahun int, km double")


def test_prepare_exact_with_hook_and_export(spark):
    auction = _auction(spark)
    crawl = spark.createDataFrame([(2010 + i % 7, float(i)) for i in range(50)],
                                  "tahun int, price double")
    hook = mean_price_hook(["tahun"], digits=6)
    prep = prepare(auction, crawl, hook, key="harga", exact=True, target="harga")
    assert prep.data.columns[0] == "harga" and "mean_price" in prep.features
    sizes = {r[0]: r[1] for r in prep.data.groupBy("split").count().collect()}
    assert sizes == {"train": 720, "validation": 180, "test": 100}
    path = scratch_path(spark, "export")
    export_splits(prep, path, "toyota", run_date="20240101")
    types = {"Type": "string", "tahun": "int", "km": "double", "mean_price": "double"}
    schema = "harga double, " + ", ".join(f"{c} {types[c]}" for c in prep.features)
    back = read_split(spark, path, schema, "toyota", "test", "20240101")
    assert back.count() == 100
    # the first column of the headerless file is the target
    want = prep.data.filter("split = 'test'").select("harga")
    assert back.select("harga").exceptAll(want).count() == 0


def test_top_k_and_latest_one(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, 3.0, t0), (2, 1.0, t0), (3, 1.0, t0 + dt.timedelta(1)),
                                (4, 2.0, t0 + dt.timedelta(1))],
                               "id long, rmse double, ts timestamp")
    assert top_k(df, "rmse", "id", 0).first()["id"] == 2
    assert top_k(df, "rmse", "id", 1).first()["id"] == 3
    assert latest_one(df, "ts", "id").first()["id"] == 3


def test_typed_params(spark):
    df = spark.createDataFrame([({"max_depth": "7", "eta": "0.25", "num_round": "120",
                                  "subsample": "0.8", "colsample_bytree": "0.6",
                                  "min_child_weight": "3", "gamma": "2"},)],
                               "params map<string,string>")
    r = df.select(*typed_params()).first()
    assert (r["max_depth"], r["eta"], r["num_round"], r["gamma"]) == (7, 0.25, 120, 2)


def test_legacy_split_layout(spark):
    df = spark.createDataFrame([(float(i), i % 3, "train" if i % 2 else "test") for i in range(20)],
                               "y double, x int, split string")
    from appraise.sources.files import write_splits
    path = scratch_path(spark, "legacy")
    write_splits(df, path, "y", "20240101", None)
    back = read_split(spark, path, "y double, x int", None, "test", "20240101")
    assert back.count() == 10


def test_tuned_params_from_trials(spark):
    from appraise.plans.workflows import tuned_params
    from appraise.sources.registry import TRIALS_SCHEMA
    now = dt.datetime(2024, 1, 1)
    trials = spark.createDataFrame([
        ("j1", 1, "toyota", "Completed", now, 5.0, {"max_depth": "4", "eta": "0.2"}),
        ("j1", 2, "toyota", "Completed", now, 3.0, {"max_depth": "8", "num_round": "120"}),
        ("j1", 3, "toyota", "Failed", now, 1.0, {"max_depth": "9"}),
        ("j4", 4, "daihatsu", "Completed", now, 0.5, {"max_depth": "3"})], TRIALS_SCHEMA)
    p = tuned_params(trials, "toyota")
    assert (p.max_depth, p.num_round, p.eta) == (8, 120, 0.1)
    assert tuned_params(trials, "honda").max_depth == 5


def test_newest_model_of_a_make(spark):
    from appraise.plans.workflows import newest_model
    from appraise.sources.registry import MODELS_SCHEMA
    t0 = dt.datetime(2024, 1, 1)
    models = spark.createDataFrame([
        ("Toyota-b", "toyota", t0 + dt.timedelta(days=1), "p/b", {}, 1.0),
        ("Toyota-a", "toyota", t0 + dt.timedelta(days=1), "p/a", {}, 1.0),
        ("Toyota-old", "toyota", t0, "p/old", {}, 1.0),
        ("Daihatsu-x", "daihatsu", t0 + dt.timedelta(days=9), "p/x", {}, 1.0)], MODELS_SCHEMA)
    assert newest_model(models, "toyota") == ("Toyota-a", "p/a")
    assert newest_model(models, "honda") is None
