"""Queries on files the library itself writes, lists and reads back, and on rows that repeat.

Registries, reports, published runs and object listings live under the shared
checkpoint folder for the length of a query.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions.labels import label_by_table
from appraise.operators.latest import best_of_newest_job, latest_per_key
from appraise.operators.metrics import write_report
from appraise.operators.positional import zip_files
from appraise.operators.routing import route_paths
from appraise.operators.split import TEST_SIZE, VALIDATION_SIZE, split_exact, split_fraction
from appraise.plans.appraisal import scored_lots
from appraise.plans.files import _SPLIT_CASE, RUN_DATE, TRAIN_COLS
from appraise.plans.registry import query
from appraise.session import scratch_path
from appraise.sources.files import latest_file, list_objects, read_bodies, read_headerless, write_csv
from appraise.sources.publish import committed_path, publish
from appraise.sources.registry import (PARAM_TYPES, models_from_events, read_models, read_trials, record_trials,
                                       register_model, trials_from_events, typed_params)
from appraise.sources.tables import read_table


# --- files written, listed and read (S7, S9, K4) ---------------------------

@query("latest_file", sql="SELECT p_partkey || ',' || p_brand AS line FROM part WHERE p_size % 2 = 1")
def latest_file_body(spark: SparkSession, base: str) -> DataFrame:
    """Three drops of files one after the other: the folder of the newest CSV, its bodies as lines."""
    part = read_table(spark, base, "part").select("p_partkey", "p_brand", "p_size")
    path = scratch_path(spark, "lots")
    for parity in (0, 1):
        write_csv(part.filter(F.col("p_size") % 2 == parity).drop("p_size"), f"{path}/drop={parity}", header=False)
    part.select(F.col("p_brand").alias("value")).write.text(f"{path}/drop=2")
    newest = latest_file(list_objects(spark, path), (".csv", ".xlsx"))
    bodies = read_bodies(spark, f"{newest.rsplit('/', 1)[0]}/*.csv")
    lines = bodies.select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line"))
    return lines.filter("line <> ''")


@query("object_listing", sql="SELECT p_brand, count(*) * 4 AS n_bytes FROM part GROUP BY p_brand")
def object_listing(spark: SparkSession, base: str) -> DataFrame:
    """Bytes per folder of a listing: four bytes a row were written."""
    path = scratch_path(spark, "listing")
    read_table(spark, base, "part").select("p_brand", F.lit("abc").alias("value")).write.partitionBy("p_brand").text(path)
    folder = F.url_decode(F.regexp_extract("path", "p_brand=([^/]*)/", 1))
    return list_objects(spark, path).filter(F.col("path").endswith(".txt")).groupBy(folder.alias("p_brand")) \
        .agg(F.sum("length").alias("n_bytes"))


@query("report_file", sql=f"""
WITH s AS (SELECT {_SPLIT_CASE} AS split, l_extendedprice - l_quantity * p_retailprice AS d
           FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT split, round(sqrt(avg(d * d)), 4) AS value, round(stddev_pop(d), 4) AS standard_deviation FROM s GROUP BY split""")
def report_file(spark: SparkSession, base: str) -> DataFrame:
    """The nested report written as JSON, one object per split, and read back with its schema."""
    path = scratch_path(spark, "report")
    write_report(scored_lots(spark, base), path, "l_extendedprice", "prediction", ["split"])
    back = spark.read.schema("split string, regression_metrics struct<rmse: struct<value: double, standard_deviation: double>>") \
        .json(path)
    rmse = F.col("regression_metrics.rmse")
    return back.select("split", F.round(rmse["value"], 4).alias("value"),
                       F.round(rmse["standard_deviation"], 4).alias("standard_deviation"))


# --- registries (K6, S10, S11, F16) -----------------------------------------

_MAKES = ("click", "purchase", "view")


@query("registered_models", sql=f"""
SELECT event_type AS model_type, name, path FROM (
  SELECT event_type, upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || '-model-' || event_id AS name,
         'models/' || event_type || '/' || event_id AS path,
         row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || '-model-' || event_id) AS rn
  FROM events WHERE ts IS NOT NULL AND event_type IN {_MAKES}) WHERE rn = 1""")
def registered_models(spark: SparkSession, base: str) -> DataFrame:
    """Per make the newest stand-in model and an older one registered, row by row; the newest read back."""
    models = models_from_events(read_table(spark, base, "events")).filter(F.col("model_type").isin(*_MAKES))
    path = scratch_path(spark, "models")
    newest = latest_per_key(models, ["model_type"], "created_at", "name", ["name", "path", "created_at"])
    for r in newest.collect():                  # one row a make
        at = r["created_at"]
        register_model(spark, path, r["name"], r["model_type"], r["path"], {"max_depth": 5}, 1.0, at)
        register_model(spark, path, "older", r["model_type"], "models/older", {}, None, at - dt.timedelta(days=1))
    return latest_per_key(read_models(spark, path), ["model_type"], "created_at", "name", ["name", "path"])


_NUMBERS = {"max_depth": "event_id % 8 + 3", "subsample": "(event_id % 50) / 100.0 + 0.5", "colsample_bytree": "0.75",
            "num_round": "event_id % 451 + 50", "eta": "(event_id % 30 + 1) / 100.0", "min_child_weight": "event_id % 10 + 1",
            "gamma": "event_id % 5 + 1"}


@query("recorded_trials", sql=f"""
WITH t AS (SELECT *, event_id // 100 AS job FROM events WHERE event_type <> 'error' AND ts IS NOT NULL),
j AS (SELECT event_type, job FROM (SELECT event_type, job, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, CAST(job AS VARCHAR)) AS rn FROM t) WHERE rn = 1),
b AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS rn FROM t JOIN j USING (event_type, job) WHERE value IS NOT NULL)
SELECT event_type AS model_type, event_id AS trial_id,
       {", ".join(f"CAST({v} AS {'DOUBLE' if PARAM_TYPES[k] == 'double' else 'INTEGER'}) AS {k}" for k, v in _NUMBERS.items())}
FROM b WHERE rn = 1""")
def recorded_trials(spark: SparkSession, base: str) -> DataFrame:
    """Trials recorded with all parameters as text; the newest search's best ones back, each in its type."""
    events = read_table(spark, base, "events")
    texts = F.create_map(*[x for k, v in _NUMBERS.items() for x in (F.lit(k), F.expr(f"CAST({v} AS STRING)"))])
    trials = trials_from_events(events.withColumn("texts", texts))
    made = trials.join(events.select(F.col("event_id").alias("trial_id"), texts.alias("texts")), "trial_id") \
        .drop("params").withColumnRenamed("texts", "params")
    path = scratch_path(spark, "trials")
    record_trials(made, path)
    best = best_of_newest_job(read_trials(spark, path), ["params"])
    return best.select("model_type", "trial_id", *typed_params())


# --- published as a whole (K1, K2, K3, K8) ----------------------------------

@query("published_splits", sql=f"""
SELECT {_SPLIT_CASE} AS split, l_extendedprice, l_quantity, l_discount, l_tax, l_linenumber FROM lineitem""")
def published_splits(spark: SparkSession, base: str) -> DataFrame:
    """Three split files published as one run: after a run that dies half way and one that is replaced."""
    li = read_table(spark, base, "lineitem").select("l_orderkey", *[c.split()[0] for c in TRAIN_COLS.split(", ")])
    rows = split_fraction(li, "l_orderkey").drop("l_orderkey")
    path = scratch_path(spark, "published")

    def tables(sign):
        def writer(part):
            mine = rows.filter(F.col("split") == part).drop("split").withColumn("l_tax", F.col("l_tax") * sign)
            return lambda to: write_csv(mine, to, header=False)
        return [(part, writer(part)) for part in ("train", "validation", "test")]

    def dies(to):
        raise OSError("lost")
    publish(spark, path, "toyota", RUN_DATE, tables(-1))
    try:
        publish(spark, path, "toyota", RUN_DATE, [*tables(-2)[:1], ("validation", dies)])
    except OSError:
        pass
    publish(spark, path, "toyota", RUN_DATE, tables(1))
    run = committed_path(spark, path, "toyota", RUN_DATE)
    out = None
    for part in ("train", "validation", "test"):
        one = read_headerless(spark, f"{run}/{part}", TRAIN_COLS).withColumn("split", F.lit(part))
        out = one if out is None else out.unionByName(one)
    return out


# --- file order, repeated rows, many rules, many routes (J2, M1, P1, J4) ------

@query("zip_files", sql="""
WITH c AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, c_custkey, c_name FROM customer),
s AS (SELECT row_number() OVER (ORDER BY s_suppkey DESC) - 1 AS pos, s_suppkey, s_name FROM supplier)
SELECT coalesce(c.pos, s.pos) AS pos, c.c_custkey, c.c_name, s.s_suppkey, s.s_name
FROM c FULL OUTER JOIN s ON c.pos = s.pos""")
def zip_files_q(spark: SparkSession, base: str) -> DataFrame:
    """Two sets of CSV files, each written in its own order, side by side line by line."""
    paths = [scratch_path(spark, x) for x in ("left-lines", "right-lines")]
    write_csv(read_table(spark, base, "customer").select("c_custkey", "c_name").orderBy("c_custkey"), paths[0], header=False)
    write_csv(read_table(spark, base, "supplier").select("s_suppkey", "s_name").orderBy(F.desc("s_suppkey")), paths[1], header=False)
    left = spark.read.schema("c_custkey bigint, c_name string").csv(paths[0])
    right = spark.read.schema("s_suppkey bigint, s_name string").csv(paths[1])
    return zip_files(left, right)


@query("split_exact_copies", sql=f"""
WITH c AS (SELECT count(*) AS n, CAST(ceil(count(*) * {TEST_SIZE!r}::DOUBLE) AS BIGINT) AS t FROM lineitem),
d AS (SELECT n, t, CAST(ceil((n - t) * {VALIDATION_SIZE!r}::DOUBLE) AS BIGINT) AS v FROM c)
SELECT 'test' AS split, t AS n FROM d UNION ALL SELECT 'validation', v FROM d
UNION ALL SELECT 'train', n - t - v FROM d""")
def split_exact_copies(spark: SparkSession, base: str) -> DataFrame:
    """Exact split of rows with seven distinct values in all, so equal rows lie across both cuts."""
    rows = read_table(spark, base, "lineitem").select((F.col("l_linenumber") % 7).alias("k"))
    return split_exact(rows, "k").groupBy("split").agg(F.count("*").alias("n"))


@query("label_dictionary", sql="""
WITH r AS (SELECT row_number() OVER (ORDER BY p_partkey) AS rank, split_part(p_name, ' ', 1 + CAST(p_partkey % 2 AS INTEGER)) || CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE '' END AS keyword,
                  p_brand AS label FROM part),
u AS (SELECT keyword, min(rank) AS rank FROM r WHERE keyword <> '' GROUP BY keyword),
x AS (SELECT s.p_partkey, min(u.rank) AS rank FROM (SELECT p_partkey, reverse(p_name) || ' ' || p_name AS t FROM part WHERE p_partkey % 5 <> 0) s JOIN u ON contains(s.t, u.keyword) GROUP BY 1)
SELECT p.p_partkey, CASE WHEN p.p_partkey % 5 = 0 THEN NULL ELSE coalesce(r.label, 'none') END AS label
FROM part p LEFT JOIN x USING (p_partkey) LEFT JOIN r USING (rank)""")
def label_dictionary(spark: SparkSession, base: str) -> DataFrame:
    """A keyword rule per listing: a dictionary that grows with the table, the lowest rank kept."""
    part = read_table(spark, base, "part")
    word = F.split_part("p_name", F.lit(" "), (1 + F.col("p_partkey") % 2).cast("int"))
    space = F.when(F.col("p_partkey") % 3 == 0, " ").otherwise("")
    rules = part.select(F.concat(word, space).alias("keyword"), F.struct("p_partkey", "p_brand").alias("r")) \
        .filter("keyword <> ''").groupBy("keyword").agg(F.min("r").alias("r")) \
        .select(F.col("r.p_partkey").alias("rank"), "keyword", F.col("r.p_brand").alias("label"))
    text = F.when(F.col("p_partkey") % 5 != 0, F.concat(F.reverse("p_name"), F.lit(" "), "p_name"))
    return label_by_table(part.select("p_partkey", text.alias("t")), "t", rules, "none", "label").select("p_partkey", "label")


@query("route_many", sql="""
WITH r AS (SELECT DISTINCT split_part(url, '/', 4) || '/' || split_part(url, '/', 5) AS model_type FROM pages)
SELECT p.page_id, r.model_type FROM pages p JOIN r ON contains(p.url, r.model_type)""")
def route_many(spark: SparkSession, base: str) -> DataFrame:
    """A route per distinct path head of the landed pages: as many routes as the table gives."""
    pages = read_table(spark, base, "pages").select("page_id", "url")
    head = F.concat(F.split_part("url", F.lit("/"), F.lit(4)), F.lit("/"), F.split_part("url", F.lit("/"), F.lit(5)))
    routes = pages.select(head.alias("model_type")).distinct().select(
        "model_type", F.lit("").alias("prefix"), F.lit("").alias("suffix"), F.lit("run").alias("run_name"))
    return route_paths(pages, "url", routes).select("page_id", "model_type")
