"""Path, newest-row, routing and column-layout queries on the landed tables.

Stand-ins: ``pages.url`` plays the object paths, ``events`` the object listing
and the model / tuning registries (``event_type`` is the make, ``ts`` the
creation time, ``value`` the validation RMSE, ``props`` the parameters).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions import text, uri
from appraise.operators.columns import column_slice, first_and_last, first_n, shape, target_first
from appraise.operators.latest import (attach_latest, best_of_newest_job, best_per_key, latest_one,
                                       latest_per_key, latest_with_fallback, top_k)
from appraise.operators.routing import route_paths, routes_table
from appraise.plans.registry import query
from appraise.sources.registry import models_from_events, trials_from_events
from appraise.sources.tables import read_table
from appraise.streaming.events import joined_paths

KEY_SQL = "regexp_extract(url, '(?s)^[^/]*/[^/]*/[^/]*/(.*)$', 1)"


def _pages(spark, base):
    return read_table(spark, base, "pages").select("page_id", "url")


@query("uri_parts", sql=r"""
SELECT page_id, split_part(url, '/', 3) AS bucket,
       regexp_extract(url, '(?s)^[^/]*/[^/]*/[^/]*/(.*)$', 1) AS key,
       regexp_extract(url, '([^/]*)$', 1) AS base_name
FROM pages""")
def uri_parts(spark: SparkSession, base: str) -> DataFrame:
    """Bucket, key and base name of every path."""
    return _pages(spark, base).select("page_id", uri.bucket("url").alias("bucket"),
                                      uri.key("url").alias("key"),
                                      uri.base_name("url").alias("base_name"))


_S3 = "'s3://' || split_part(url, '/', 3) || '/' || regexp_extract(url, '(?s)^[^/]*/[^/]*/[^/]*/(.*)$', 1)"
_NOSCHEME = f"replace({_S3}, 's3://', '')"
_KEY = f"regexp_extract({_NOSCHEME}, '(?s)^[^/]*/(.*)$', 1)"


@query("uri_prefix", sql=f"""
SELECT page_id, {_S3} AS s3_uri,
       split_part({_NOSCHEME}, '/', 1) AS bucket,
       {_KEY} AS key,
       CASE WHEN length({_KEY}) - length(replace({_KEY}, '/', '')) >= 3
            THEN regexp_replace({_KEY}, '(/[^/]*){{3}}$', '')
            ELSE split_part({_KEY}, '/', 1) END AS prefix,
       split_part({_KEY}, '/', 1) AS first_level
FROM pages""")
def uri_prefix(spark: SparkSession, base: str) -> DataFrame:
    """Compose an s3 URI per path, strip the scheme, split bucket/key, prefixes."""
    p = _pages(spark, base).withColumn(
        "s3_uri", uri.compose_uri(uri.bucket("url"), uri.key("url")))
    p = p.withColumn("__ns", uri.strip_scheme("s3_uri"))
    p = p.withColumn("__key", uri.after_first_level("__ns"))
    return p.select("page_id", "s3_uri", uri.first_level("__ns").alias("bucket"),
                    F.col("__key").alias("key"),
                    uri.drop_last_levels("__key", 3).alias("prefix"),
                    uri.first_level("__key").alias("first_level"))


@query("capitalize", sql="""
SELECT p_partkey, upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS name_cap,
       upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS type_cap
FROM part""")
def capitalize_q(spark: SparkSession, base: str) -> DataFrame:
    """``str.capitalize`` of listing names and types."""
    part = read_table(spark, base, "part")
    return part.select("p_partkey", text.capitalize("p_name").alias("name_cap"),
                       text.capitalize("p_type").alias("type_cap"))


@query("day_token", sql="""
SELECT event_id, strftime(ts, '%Y%m%d') AS day FROM events""")
def day_token_q(spark: SparkSession, base: str) -> DataFrame:
    """UTC ``yyyymmdd`` token of each event time."""
    ev = read_table(spark, base, "events")
    return ev.select("event_id", text.day_token("ts").alias("day"))


@query("json_field", sql="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_field_q(spark: SparkSession, base: str) -> DataFrame:
    """One JSON field of each event's properties, typed."""
    ev = read_table(spark, base, "events")
    return ev.select("event_id", text.json_field("props", "$.k").cast("int").alias("k"))


@query("latest_by_key", sql="""
SELECT user_id, event_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn
  FROM events WHERE ts IS NOT NULL) WHERE rn = 1""")
def latest_by_key(spark: SparkSession, base: str) -> DataFrame:
    """Newest row per key; ties go to the smallest id."""
    ev = read_table(spark, base, "events")
    return latest_per_key(ev, ["user_id"], "ts", "event_id", ["event_id", "event_type", "ts"])


@query("latest_one", sql="""
SELECT event_id, user_id, ts FROM events WHERE event_type = 'view' AND ts IS NOT NULL
ORDER BY ts DESC, event_id LIMIT 1""")
def latest_one_q(spark: SparkSession, base: str) -> DataFrame:
    """The single newest row of one kind."""
    ev = read_table(spark, base, "events").filter(F.col("event_type") == "view")
    return latest_one(ev, "ts", "event_id").select("event_id", "user_id", "ts")


@query("latest_with_fallback", sql="""
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY
              CASE event_type WHEN 'purchase' THEN 0 ELSE 1 END, ts DESC, event_id) AS rn
  FROM events WHERE event_type IN ('purchase', 'click') AND ts IS NOT NULL) WHERE rn = 1""")
def latest_with_fallback_q(spark: SparkSession, base: str) -> DataFrame:
    """Per key: newest of the preferred kind, else newest of the fallback kind."""
    ev = read_table(spark, base, "events")
    return latest_with_fallback(ev, ["user_id"], "event_type", ["purchase", "click"], "ts",
                                "event_id", ["event_id", "event_type"], how="equals")


@query("attach_latest", sql="""
WITH l AS (
  SELECT user_id, event_id AS latest_event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn
    FROM events WHERE ts IS NOT NULL) WHERE rn = 1)
SELECT e.event_id, e.user_id, l.latest_event_id FROM events e LEFT JOIN l USING (user_id)""")
def attach_latest_q(spark: SparkSession, base: str) -> DataFrame:
    """Each row with the newest companion row of its key."""
    ev = read_table(spark, base, "events")
    latest = latest_per_key(ev, ["user_id"], "ts", "event_id", ["event_id"]) \
        .withColumnRenamed("event_id", "latest_event_id")
    return attach_latest(ev.select("event_id", "user_id"), latest, ["user_id"])


_MODELS_SQL = """
  SELECT upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || '-model-'
           || CAST(event_id AS VARCHAR) AS name,
         event_type AS model_type, ts AS created_at
  FROM events"""


@query("latest_model", sql=f"""
SELECT model_type, name, created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY model_type ORDER BY created_at DESC, name) AS rn
  FROM ({_MODELS_SQL}) m
  WHERE contains(name, upper(substr(model_type, 1, 1)) || lower(substr(model_type, 2)))
    AND created_at IS NOT NULL) WHERE rn = 1""")
def latest_model(spark: SparkSession, base: str) -> DataFrame:
    """Newest registered model per make (name filter by the capitalised make)."""
    models = models_from_events(read_table(spark, base, "events"))
    named = models.filter(F.col("name").contains(text.capitalize("model_type")))
    return latest_per_key(named, ["model_type"], "created_at", "name", ["name", "created_at"])


_TRIALS_SQL = """
  SELECT 'HPO-' || upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || '-'
           || CAST(event_id // 100 AS VARCHAR) AS job, ts AS created_at,
         event_id AS trial_id, event_type AS model_type,
         CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Completed' END AS status,
         value AS rmse, props
  FROM events"""


@query("best_params", sql=f"""
SELECT model_type, job, rmse, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM (
  SELECT *, row_number() OVER (PARTITION BY model_type ORDER BY rmse, trial_id) AS rn
  FROM ({_TRIALS_SQL}) t WHERE status = 'Completed' AND rmse IS NOT NULL) WHERE rn = 1""")
def best_params(spark: SparkSession, base: str) -> DataFrame:
    """Best completed trial per make and its parameter cast to its type."""
    trials = trials_from_events(read_table(spark, base, "events"))
    done = trials.filter(F.col("status") == "Completed")
    best = best_per_key(done, ["model_type"], "rmse", "trial_id", ["job", "rmse", "params"])
    return best.select("model_type", "job", "rmse",
                       F.col("params").getItem("k").cast("int").alias("k"))


@query("top_trial", sql=f"""
SELECT job, rmse FROM ({_TRIALS_SQL}) t WHERE status = 'Completed' AND rmse IS NOT NULL
ORDER BY rmse, trial_id LIMIT 1 OFFSET 1""")
def top_trial(spark: SparkSession, base: str) -> DataFrame:
    """The k-th best trial overall (k = 1: the runner-up)."""
    trials = trials_from_events(read_table(spark, base, "events"))
    return top_k(trials.filter(F.col("status") == "Completed"), "rmse", "trial_id", 1) \
        .select("job", "rmse")


_ROUTE_MAKES = ("en", "fr")


@query("route_paths", sql="""
SELECT p.page_id, p.url, r.model_type, r.run_name
FROM pages p JOIN (VALUES ('en', '/', 'Training-En'), ('fr', '/', 'Training-Fr'))
     AS r(model_type, suffix, run_name)
  ON contains(p.url, r.model_type || r.suffix)""")
def route_paths_q(spark: SparkSession, base: str) -> DataFrame:
    """Paths routed to the makes whose folder marker they contain."""
    routes = routes_table(spark, _ROUTE_MAKES, "/", "Training")
    return route_paths(_pages(spark, base), "url", routes) \
        .select("page_id", "url", "model_type", "run_name")


@query("day_token_utc", sql="""
SELECT event_id, strftime(ts, '%Y%m%d') AS ntz_day,
       strftime(to_timestamp(event_id * 40000) AT TIME ZONE 'UTC', '%Y%m%d') AS utc_day FROM events""")
def day_token_utc(spark: SparkSession, base: str) -> DataFrame:
    """UTC day tokens of zoned and of zone-less timestamps."""
    e = read_table(spark, base, "events")
    return e.select("event_id", text.day_token("ts").alias("ntz_day"),
                    text.day_token(F.timestamp_seconds(F.col("event_id") * 40000)).alias("utc_day"))


@query("target_first", sql="""
SELECT l_extendedprice, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem""")
def target_first_q(spark: SparkSession, base: str) -> DataFrame:
    """Lots with the target moved to column 0."""
    return target_first(read_table(spark, base, "lineitem"), "l_extendedprice")


@query("first_and_last", sql="SELECT p_partkey, p_retailprice FROM part")
def first_and_last_q(spark: SparkSession, base: str) -> DataFrame:
    """First and last column by position."""
    return first_and_last(read_table(spark, base, "part"))


@query("column_slice", sql="SELECT p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def column_slice_q(spark: SparkSession, base: str) -> DataFrame:
    """Columns from the second to the last by position."""
    return column_slice(read_table(spark, base, "part"), 1)


@query("first_n", sql="SELECT * FROM part ORDER BY p_partkey LIMIT 11")
def first_n_q(spark: SparkSession, base: str) -> DataFrame:
    """The first 11 listings in key order (the debug cap of the crawl)."""
    return first_n(read_table(spark, base, "part"), 11, ["p_partkey"])


@query("shape", sql="""
SELECT 'lineitem' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, 11 AS n_cols FROM lineitem
UNION ALL SELECT 'part', CAST(count(*) AS BIGINT), 6 FROM part
UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT), 6 FROM orders
UNION ALL SELECT 'events', CAST(count(*) AS BIGINT), 6 FROM events""")
def shape_q(spark: SparkSession, base: str) -> DataFrame:
    """Row and column count of each input table."""
    out = None
    for t in ("lineitem", "part", "orders", "events"):
        s = shape(read_table(spark, base, t), t)
        out = s if out is None else out.unionByName(s)
    return out


@query("paths_joined", sql=f"""
SELECT string_agg('s3://' || split_part(url, '/', 3) || '/' || {KEY_SQL}, ',' ORDER BY n) AS paths
FROM (SELECT page_id, url, 0 AS n FROM pages UNION ALL SELECT page_id, replace(url, 'example', 'copy'), 1 FROM pages)
GROUP BY page_id""")
def paths_joined(spark: SparkSession, base: str) -> DataFrame:
    """Per notification (a page and its copy), the record paths joined in record order."""
    def record(url):
        return F.struct(F.struct(F.struct(uri.bucket(url).alias("name")).alias("bucket"),
                                 F.struct(uri.key(url).alias("key")).alias("object")).alias("s3"))
    pages = _pages(spark, base).withColumn("copy", F.replace("url", F.lit("example"), F.lit("copy")))
    return joined_paths(pages.select(F.array(record("url"), record("copy")).alias("Records")))


@query("newest_job_params", sql=f"""
WITH t AS (SELECT * FROM ({_TRIALS_SQL}) x WHERE status = 'Completed'),
j AS (SELECT model_type, job FROM (
  SELECT *, row_number() OVER (PARTITION BY model_type ORDER BY created_at DESC, job) AS rn
  FROM t WHERE created_at IS NOT NULL) WHERE rn = 1)
SELECT model_type, job, trial_id, rmse, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM (
  SELECT t.*, row_number() OVER (PARTITION BY t.model_type ORDER BY rmse, trial_id) AS rn
  FROM t JOIN j USING (model_type, job) WHERE rmse IS NOT NULL) WHERE rn = 1""")
def newest_job_params(spark: SparkSession, base: str) -> DataFrame:
    """Per make: the newest completed search, its best trial (older searches may hold a lower RMSE)."""
    trials = trials_from_events(read_table(spark, base, "events"))
    return best_of_newest_job(trials, ["params"]).select(
        "model_type", "job", "trial_id", "rmse", F.col("params").getItem("k").cast("int").alias("k"))
