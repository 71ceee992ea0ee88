"""File round trips, zip join, preparation hooks and notification rows.

Files are written under the shared checkpoint folder (never a machine-local
temporary folder) and read back with declared schemas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions import uri
from appraise.operators.columns import target_first
from appraise.operators.positional import zip_join
from appraise.operators.prepare import apply_hook, identity_hook, mean_price_hook
from appraise.operators.split import (TEST_SIZE, TRAIN_SEEDS, VALIDATION_SIZE,
                                      fraction_threshold, hash32_sql, split_fraction)
from appraise.plans.registry import query
from appraise.session import scratch_path
from appraise.sources.csv_blocks import read_quoted_csv
from appraise.sources.files import (latest_file, read_csv, read_splits, write_csv,
                                    write_dated, write_splits)
from appraise.sources.tables import read_table
from appraise.sources.workbook import read_workbooks, write_workbooks
from appraise.streaming.events import body_sql, notification_rows

PART_SCHEMA = ("p_partkey bigint, p_name string, p_brand string, p_type string, "
               "p_size int, p_retailprice double")
RUN_DATE = "20240101"


def _roundtrip(spark: SparkSession, base: str, sep: str) -> DataFrame:
    part = read_table(spark, base, "part")
    path = scratch_path(spark, "csv-roundtrip")
    write_dated(part, path, RUN_DATE, model_type="toyota", sep=sep)
    return read_csv(spark, f"{path}/model_type=toyota/run_date={RUN_DATE}", PART_SCHEMA, sep=sep)


@query("csv_roundtrip", sql="SELECT * FROM part")
def csv_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """Listings written as header CSV under model_type/run_date and read back."""
    return _roundtrip(spark, base, ",")


@query("csv_roundtrip_semicolon", sql="SELECT * FROM part")
def csv_roundtrip_semicolon(spark: SparkSession, base: str) -> DataFrame:
    """Same with ``;`` as the separator."""
    return _roundtrip(spark, base, ";")


_SPLIT_CASE = f"""CASE WHEN {hash32_sql('l_orderkey', TRAIN_SEEDS[0])} < {fraction_threshold(TEST_SIZE)} THEN 'test'
            WHEN {hash32_sql('l_orderkey', TRAIN_SEEDS[1])} < {fraction_threshold(VALIDATION_SIZE)} THEN 'validation'
            ELSE 'train' END"""
TRAIN_COLS = ("l_extendedprice double, l_quantity double, l_discount double, l_tax double, "
              "l_linenumber int")


@query("csv_headerless", sql=f"""
SELECT {_SPLIT_CASE} AS split, l_extendedprice, l_quantity, l_discount, l_tax, l_linenumber
FROM lineitem""")
def csv_headerless(spark: SparkSession, base: str) -> DataFrame:
    """Target-first headerless split files, read back positionally per split."""
    li = read_table(spark, base, "lineitem")
    feats = li.select("l_orderkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
                      "l_linenumber")
    split = split_fraction(feats, "l_orderkey").drop("l_orderkey")
    path = scratch_path(spark, "splits")
    write_splits(split, path, "l_extendedprice", RUN_DATE, "toyota")
    return read_splits(spark, path, TRAIN_COLS, "toyota", RUN_DATE)


_LISTING_SQL = """SELECT 'lots/' || event_type || '/' || event_id || CASE event_id % 3 WHEN 0 THEN '.xlsx' WHEN 1 THEN '.csv' ELSE '.txt' END AS path, ts AS t FROM events"""


@query("latest_listed", sql=f"""
SELECT path FROM ({_LISTING_SQL}) l WHERE path LIKE '%.csv' AND t IS NOT NULL ORDER BY t DESC, path LIMIT 1""")
def latest_file_q(spark: SparkSession, base: str) -> DataFrame:
    """Newest CSV of a listing (XLSX only where there is no CSV, other kinds never)."""
    e = read_table(spark, base, "events")
    kind = F.when(F.col("event_id") % 3 == 0, ".xlsx").when(F.col("event_id") % 3 == 1, ".csv").otherwise(".txt")
    listing = e.select(F.concat(F.lit("lots/"), "event_type", F.lit("/"), F.col("event_id").cast("string"),
                                kind).alias("path"), F.col("ts").alias("modificationTime"))
    return spark.createDataFrame([(latest_file(listing),)], "path string")


@query("csv_text_roundtrip", sql="""
SELECT doc_id, nullif(text, '') AS text, lang FROM documents
UNION ALL SELECT -1 - doc_id, '"' || text || '", "a;b"\n', lang FROM documents""")
def csv_text_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """Whole texts with newlines, quotes and separators written as CSV and read back in blocks.

    An empty text is written as a quoted empty field and reads back as null.
    """
    d = read_table(spark, base, "documents").select("doc_id", "text", "lang")
    quoted = F.concat(F.lit('"'), "text", F.lit('", "a;b"\n'))
    both = d.unionByName(d.select((-1 - F.col("doc_id")).alias("doc_id"), quoted.alias("text"), "lang"))
    path = scratch_path(spark, "csv-text")
    write_csv(both, path)
    return read_quoted_csv(spark, path, "doc_id bigint, text string, lang string")


@query("zip_join", sql="""
WITH c AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, c_custkey, c_name FROM customer),
s AS (SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS pos, s_suppkey, s_name FROM supplier)
SELECT coalesce(c.pos, s.pos) AS pos, c.c_custkey, c.c_name, s.s_suppkey, s.s_name
FROM c FULL OUTER JOIN s ON c.pos = s.pos""")
def zip_join_q(spark: SparkSession, base: str) -> DataFrame:
    """Row i of customers beside row i of suppliers, padded with NULLs."""
    c = read_table(spark, base, "customer").select("c_custkey", "c_name")
    s = read_table(spark, base, "supplier").select("s_suppkey", "s_name")
    return zip_join(c, s, ["c_custkey"], ["s_suppkey"])


@query("hook_identity", sql="""
SELECT p_retailprice, p_partkey, p_name, p_brand, p_type, p_size FROM part""")
def hook_identity(spark: SparkSession, base: str) -> DataFrame:
    """Default hook: the auction table unchanged, target moved first."""
    part = read_table(spark, base, "part")
    crawl = read_table(spark, base, "lineitem")
    return target_first(apply_hook(part, crawl, identity_hook), "p_retailprice")


@query("hook_price_join", sql="""
SELECT p.p_partkey, p.p_brand, p.p_type, p.p_retailprice, m.mean_price
FROM part p LEFT JOIN (
  SELECT p_brand, p_type, round(avg(p_retailprice), 6) AS mean_price FROM part GROUP BY 1, 2) m
  USING (p_brand, p_type)""")
def hook_price_join(spark: SparkSession, base: str) -> DataFrame:
    """Ready hook: each auction row with the crawl's mean price for its key."""
    part = read_table(spark, base, "part")
    auction = part.select("p_partkey", "p_brand", "p_type", "p_retailprice")
    crawl = part.select("p_brand", "p_type", F.col("p_retailprice").alias("price"))
    hook = mean_price_hook(["p_brand", "p_type"], digits=6)
    return apply_hook(auction, crawl, hook)


EVENT_TIME = "2024-01-01T00:00:00.000Z"
EVENT_NAME = "ObjectCreated:Put"
NOTIFY_MARKER = "/en/"
RECIPIENTS = ("results@example.com",)


def page_records(spark: SparkSession, base: str) -> DataFrame:
    """Notification records standing in for result files: one per landed page."""
    pages = read_table(spark, base, "pages").select("page_id", "url")
    return pages.select(
        "page_id", F.lit(EVENT_TIME).alias("event_time"), F.lit(EVENT_NAME).alias("event_name"),
        uri.bucket("url").alias("bucket"), uri.key("url").alias("key"),
    ).withColumn("s3_path", uri.compose_uri("bucket", "key"))


S3_PATH_SQL = ("'s3://' || split_part(url, '/', 3) || '/' || "
               "regexp_extract(url, '(?s)^[^/]*/[^/]*/[^/]*/(.*)$', 1)")
KEY_SQL = "regexp_extract(url, '(?s)^[^/]*/[^/]*/[^/]*/(.*)$', 1)"
NOTIFY_SQL = f"""
WITH r AS (SELECT {S3_PATH_SQL} AS s3_path, {KEY_SQL} AS key FROM pages)
SELECT '{",".join(RECIPIENTS)}' AS "to", 'Prediction results' AS subject,
       {body_sql(repr(EVENT_NAME), repr(EVENT_TIME), 's3_path')} AS html_body,
       s3_path AS attachment_path, regexp_extract(key, '([^/]*)$', 1) AS file_name
FROM r WHERE contains(s3_path, '{NOTIFY_MARKER}')"""


@query("notify_messages", sql=NOTIFY_SQL)
def notify_messages(spark: SparkSession, base: str) -> DataFrame:
    """One notification row per result path under the marker folder."""
    return notification_rows(page_records(spark, base), RECIPIENTS, NOTIFY_MARKER)


@query("workbook_scan", sql="SELECT * FROM part")
def workbook_scan(spark: SparkSession, base: str) -> DataFrame:
    """Listings written as several XLSX workbooks and scanned back in parallel."""
    part = read_table(spark, base, "part")
    path = scratch_path(spark, "workbooks")
    write_workbooks(part, path)
    return read_workbooks(spark, path, PART_SCHEMA)
