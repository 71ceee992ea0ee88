"""Streaming queries: route arriving files and notify on results.

Notification files are derived from the landed pages (one record per page,
one notification per JSON line), dropped into an
incoming folder under the shared checkpoint folder, and consumed by a file
stream with ``availableNow``. The result is read back from the exactly-once
sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions import uri
from appraise.operators.latest import latest_per_key
from appraise.operators.routing import routes_table
from appraise.plans.files import (KEY_SQL, NOTIFY_MARKER, NOTIFY_SQL, RECIPIENTS,
                                  S3_PATH_SQL, page_records)
from appraise.plans.registry import query
from appraise.session import scratch_path
from appraise.sources.tables import read_table
from appraise.streaming.companions import attach_companion_as_of, deliver_once
from appraise.streaming.events import (attach_companion, notification_rows, records,
                                       run_requests, stream_notifications)
from appraise.streaming.sinks import run_available


def land_notifications(spark: SparkSession, base: str) -> str:
    """Write one notification per page as JSON lines into a fresh incoming folder."""
    recs = page_records(spark, base)
    record = F.struct(
        F.col("event_time").alias("eventTime"), F.col("event_name").alias("eventName"),
        F.struct(F.struct(F.col("bucket").alias("name")).alias("bucket"),
                 F.struct(F.col("key").alias("key")).alias("object")).alias("s3"))
    path = scratch_path(spark, "incoming")
    (recs.select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("value"))
     .write.text(path))
    return path


def companion_listing(spark: SparkSession, base: str) -> DataFrame:
    """Static listing of companion (crawl) files: one per page under its language folder."""
    pages = read_table(spark, base, "pages").select("page_id", "url")
    key = uri.key("url")
    return pages.select(
        F.concat(uri.first_level(key), F.lit("/crawling")).alias("prefix"),
        F.concat(uri.first_level(key), F.lit("/crawling/"), F.col("page_id").cast("string"),
                 F.lit(".csv")).alias("path"),
        F.timestamp_seconds(F.col("page_id")).alias("modificationTime"))


_ROUTES_SQL = "(VALUES ('en', '/', 'Training-En'), ('fr', '/', 'Training-Fr')) AS rt(model_type, suffix, run_name)"
_PREFIX_SQL = ("CASE WHEN length(key) - length(replace(key, '/', '')) >= 3 "
               "THEN regexp_replace(key, '(/[^/]*){3}$', '') ELSE split_part(key, '/', 1) END")


@query("stream_route", sql=f"""
WITH r AS (SELECT {S3_PATH_SQL} AS s3_path, {KEY_SQL} AS key FROM pages),
c AS (
  SELECT lang || '/crawling' AS prefix,
         lang || '/crawling/' || CAST(max(page_id) AS VARCHAR) || '.csv' AS companion_path
  FROM (SELECT split_part({KEY_SQL}, '/', 1) AS lang, page_id FROM pages) GROUP BY lang)
SELECT r.s3_path, rt.model_type, rt.run_name, c.companion_path
FROM r JOIN {_ROUTES_SQL} ON contains(r.s3_path, rt.model_type || rt.suffix)
LEFT JOIN c ON c.prefix = ({_PREFIX_SQL.replace('key', 'r.key')}) || '/crawling'""")
def stream_route(spark: SparkSession, base: str) -> DataFrame:
    """Arriving files routed to makes, with the newest companion file attached."""
    incoming = land_notifications(spark, base)
    routes = routes_table(spark, ("en", "fr"), "/", "Training")
    newest = latest_per_key(companion_listing(spark, base), ["prefix"], "modificationTime",
                            "path", ["path"]).withColumnRenamed("path", "companion_path")
    stream = stream_notifications(spark, incoming)
    out = attach_companion(run_requests(records(stream), routes), newest) \
        .select("s3_path", "model_type", "run_name", "companion_path")
    sink = scratch_path(spark, "route-sink")
    run_available(out, sink, scratch_path(spark, "route-ckpt"))
    return spark.read.parquet(sink).drop("batch_id")


@query("stream_notify", sql=NOTIFY_SQL)
def stream_notify(spark: SparkSession, base: str) -> DataFrame:
    """Arriving result files turned into notification rows."""
    incoming = land_notifications(spark, base)
    stream = stream_notifications(spark, incoming)
    out = notification_rows(records(stream), RECIPIENTS, NOTIFY_MARKER)
    sink = scratch_path(spark, "notify-sink")
    run_available(out, sink, scratch_path(spark, "notify-ckpt"))
    return spark.read.parquet(sink).drop("batch_id")


@query("stream_notify_once", sql=NOTIFY_SQL)
def stream_notify_once(spark: SparkSession, base: str) -> DataFrame:
    """Every notification delivered three times, in files of their own: one message each."""
    incoming = land_notifications(spark, base)
    for _ in range(2):
        spark.read.text(incoming).write.mode("append").text(incoming + "-again")
    stream = records(stream_notifications(spark, f"{incoming}*"))
    out = notification_rows(deliver_once(stream), RECIPIENTS, NOTIFY_MARKER)
    sink = scratch_path(spark, "once-sink")
    run_available(out, sink, scratch_path(spark, "once-ckpt"))
    return spark.read.parquet(sink).drop("batch_id")


def _land_events(spark: SparkSession, base: str) -> str:
    """Notifications of two kinds, a file per event: crawl files (purchases) and auction files (clicks)."""
    e = read_table(spark, base, "events").filter("ts IS NOT NULL AND event_type IN ('click', 'purchase')")
    folder = F.concat(F.lit("in/"), (F.col("user_id") % 40).cast("string"))
    key = F.when(F.col("event_type") == "purchase", F.concat(folder, F.lit("/crawling/"), F.col("event_id").cast("string"), F.lit(".csv"))) \
        .otherwise(F.concat(folder, F.lit("/lelang/d/"), F.col("event_id").cast("string"), F.lit(".csv")))
    record = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("eventTime"), F.lit("put").alias("eventName"),
                      F.struct(F.struct(F.lit("b").alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")).alias("s3"))
    path = scratch_path(spark, "arrivals")
    e.select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("value")).write.text(path)
    return path


@query("stream_companion_as_of", sql="""
WITH e AS (SELECT event_id, event_type, ts, 'in/' || (user_id % 40) AS folder FROM events WHERE ts IS NOT NULL AND event_type IN ('click', 'purchase')),
c AS (SELECT folder, ts, min(folder || '/crawling/' || event_id || '.csv') AS path FROM e WHERE event_type = 'purchase' GROUP BY folder, ts)
SELECT 's3://b/' || r.folder || '/lelang/d/' || r.event_id || '.csv' AS s3_path, c.path AS companion_path
FROM (SELECT * FROM e WHERE event_type = 'click') r ASOF LEFT JOIN c ON r.folder = c.folder AND r.ts >= c.ts""")
def stream_companion_as_of(spark: SparkSession, base: str) -> DataFrame:
    """Auction files with the newest crawl file of their folder as of their own arrival."""
    path = _land_events(spark, base)

    def arrivals():
        return records(stream_notifications(spark, path)).withColumn("event_ts", F.to_timestamp("event_time"))
    crawl = arrivals().filter(F.col("key").contains("/crawling/")).select(
        F.substring_index("key", "/crawling/", 1).alias("prefix"), F.col("key").alias("path"), "event_ts")
    asked = arrivals().filter(F.col("key").contains("/lelang/")).select(
        uri.drop_last_levels("key", 3).alias("prefix"), "event_ts", "s3_path")
    sink = scratch_path(spark, "as-of-sink")
    run_available(attach_companion_as_of(asked, crawl).select("s3_path", "companion_path"), sink, scratch_path(spark, "as-of-ckpt"))
    return spark.read.parquet(sink).drop("batch_id")
