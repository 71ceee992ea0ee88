"""Object-arrival notifications as a stream, routed to runs and to messages.

A notification file is JSON ``{"Records": [{eventTime, eventName, s3: {bucket:
{name}, object: {key}}}, ...]}``. The stream reads new files as they land
(``readStream.json`` with a declared schema), explodes the records, and:

* routes each path to the make whose folder it sits in (broadcast routes
  table), attaches the newest companion file per prefix (stream-static join)
  and emits one run request row per match;
* turns result paths (``/with_header/``) into notification rows.

Both are plain projections, a broadcast theta join and a stream-static
equi-join: no state store, no watermark, nothing grows with the stream. The
checkpoint folder holds only source offsets, so a restart never repeats a file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions import uri
from appraise.operators.routing import RESULT_MARKER, route_paths

NOTIFICATION_SCHEMA = ("Records array<struct<eventTime: string, eventName: string, "
                       "s3: struct<bucket: struct<name: string>, object: struct<key: string>>>>")

SUBJECT = "Prediction results"
BODY_HEAD = "<html><body><p>New scoring output: <b>"
BODY_AT = "</b>, received at "
BODY_STORED = ".</p><p>Location: "
BODY_TAIL = "</p></body></html>"


def records(notifications: DataFrame) -> DataFrame:
    """One row per record: event_time, event_name, bucket, key, s3_path."""
    r = notifications.select(F.explode("Records").alias("r"))
    out = r.select(F.col("r.eventTime").alias("event_time"),
                   F.col("r.eventName").alias("event_name"),
                   F.col("r.s3.bucket.name").alias("bucket"),
                   F.col("r.s3.object.key").alias("key"))
    return out.withColumn("s3_path", uri.compose_uri("bucket", "key"))


def joined_paths(notifications: DataFrame, sep: str = ",") -> DataFrame:
    """Per notification, its record paths joined in record order (a per-row array op)."""
    paths = F.transform("Records", lambda r: F.concat(
        F.lit("s3://"), r["s3"]["bucket"]["name"], F.lit("/"), r["s3"]["object"]["key"]))
    return notifications.select(F.array_join(paths, sep).alias("paths"))


def read_notifications(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Landed notifications: JSON lines, or one (pretty-printed) object per file."""
    return spark.read.schema(NOTIFICATION_SCHEMA).option("multiLine", multiline).json(path)


def stream_notifications(spark: SparkSession, path: str, max_files: int | None = None,
                         multiline: bool = False) -> DataFrame:
    reader = spark.readStream.schema(NOTIFICATION_SCHEMA).option("multiLine", multiline)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def run_requests(recs: DataFrame, routes: DataFrame) -> DataFrame:
    """Matching (path, make) pairs: the run to start and its input path."""
    return route_paths(recs, "s3_path", routes).select(
        "s3_path", "bucket", "key", "model_type", "run_name")


def companion_prefix(key_col: str = "key", levels: int = 3, folder: str = "crawling"):
    """Prefix of the companion folder: key three levels up, then ``/crawling``."""
    return F.concat(uri.drop_last_levels(key_col, levels), F.lit("/" + folder))


def scoring_companion_prefix(key_col: str = "key", model_col: str = "model_type",
                             folder: str = "crawling"):
    """Scoring trigger: ``<first level>/training/<make>/crawling``."""
    return F.concat(uri.first_level(key_col), F.lit("/training/"), F.col(model_col),
                    F.lit("/" + folder))


def attach_companion(requests: DataFrame, newest: DataFrame, prefix=None) -> DataFrame:
    """Stream-static join: newest companion file (``prefix``, ``companion_path``)."""
    p = companion_prefix() if prefix is None else prefix
    return requests.withColumn("prefix", p).join(newest, "prefix", "left")


def attach_run_inputs(requests: DataFrame, best_params: DataFrame | None = None,
                      newest_model: DataFrame | None = None) -> DataFrame:
    """Stream-static joins on the make: tuned parameters and / or the newest model.

    ``best_params``: model_type, params (one row per make, e.g. from
    ``operators.latest.best_per_key`` over the trials registry);
    ``newest_model``: model_type, model_name, model_path.
    """
    out = requests
    if best_params is not None:
        out = out.join(best_params.select("model_type", "params"), "model_type", "left")
    if newest_model is not None:
        out = out.join(newest_model.select("model_type", "model_name", "model_path"),
                       "model_type", "left")
    return out


def notification_rows(recs: DataFrame, recipients: Sequence[str],
                      marker: str = RESULT_MARKER) -> DataFrame:
    """One message row per result file: to, subject, html_body, attachment_path, file_name."""
    hit = recs.filter(uri.has_marker("s3_path", marker))
    body = F.concat(F.lit(BODY_HEAD), F.col("event_name"), F.lit(BODY_AT), F.col("event_time"),
                    F.lit(BODY_STORED), F.col("s3_path"), F.lit(BODY_TAIL))
    return hit.select(F.lit(",".join(recipients)).alias("to"), F.lit(SUBJECT).alias("subject"),
                      body.alias("html_body"), F.col("s3_path").alias("attachment_path"),
                      uri.base_name("key").alias("file_name"))


def body_sql(name: str, time: str, path: str) -> str:
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    return (f"{q(BODY_HEAD)} || {name} || {q(BODY_AT)} || {time} || {q(BODY_STORED)} || "
            f"{path} || {q(BODY_TAIL)}")
