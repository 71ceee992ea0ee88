"""Queries whose derived rows reach the branches the landed tables never do.

Texts, keys and pages are derived from the landed tables with Spark: keyword
mixes for the labels, deep keys for the prefixes, broken and hidden scripts for
the page parse, crawl tables with repeated lots, repeated split keys, and
notifications for both triggers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions import uri
from appraise.functions.labels import (ENGINE_CC, TRANSMISSION, TRANSMISSION_GROUPED, TRIM, label, label_sql)
from appraise.operators.latest import best_of_newest_job, latest_per_key
from appraise.operators.lookup import lookup_listings
from appraise.operators.prepare import apply_hook, mean_price_hook
from appraise.operators.routing import routes_table, scoring_routes
from appraise.operators.split import TEST_SIZE, VALIDATION_SIZE, split_exact
from appraise.plans.pages import listing_pages, search_url
from appraise.plans.registry import query
from appraise.session import scratch_path
from appraise.sources.pages import parse_pages
from appraise.sources.registry import models_from_events, trials_from_events
from appraise.sources.tables import read_table
from appraise.streaming.events import (attach_companion, attach_run_inputs, records, run_requests,
                                       scoring_companion_prefix, stream_notifications)
from appraise.streaming.sinks import run_available

_WORDS = ("M/T", "A/T MT", "MT", "AT", "CVT")
_TRIMS = (" G", " VELOZ", " S", " E", "")
_ENGINES = ("1.3", "1.5", "2.0")


def _pick(values, by):
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(by, F.lit(len(values))) + 1).cast("int"))


def _pick_sql(values, by: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[({by}) % {len(values)} + 1]"


_TEXT_SQL = (f"'AVANZA ' || {_pick_sql(_ENGINES, 'p_partkey')} || {_pick_sql(_TRIMS, 'p_partkey // 3')} || ' ' || "
             f"{_pick_sql(_WORDS, 'p_partkey // 15')}")


@query("label_branches", sql=f"""
SELECT p_partkey, {label_sql('x', TRANSMISSION)} AS transmisi, {label_sql('x', TRANSMISSION_GROUPED)} AS grouped,
       {label_sql('x', TRIM)} AS type_detail, {label_sql('x', ENGINE_CC)} AS cc
FROM (SELECT p_partkey, CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE {_TEXT_SQL} END AS x FROM part)""")
def label_branches(spark: SparkSession, base: str) -> DataFrame:
    """Every keyword, every default and null texts; both transmission rule orders."""
    k = F.col("p_partkey")
    text = F.concat(F.lit("AVANZA "), _pick(_ENGINES, k), _pick(_TRIMS, F.floor(k / 3)), F.lit(" "),
                    _pick(_WORDS, F.floor(k / 15)))
    x = F.when(k % 97 != 0, text)
    return read_table(spark, base, "part").select(
        k, label(x, TRANSMISSION).alias("transmisi"), label(x, TRANSMISSION_GROUPED).alias("grouped"),
        label(x, TRIM).alias("type_detail"), label(x, ENGINE_CC).alias("cc"))


@query("prefix_levels", sql="""
SELECT page_id, CASE WHEN page_id % 5 >= 3 THEN regexp_replace(k, '(/[^/]*){3}$', '') ELSE split_part(k, '/', 1) END AS prefix
FROM (SELECT page_id, array_to_string(list_transform(range(page_id % 5 + 1), lambda i: 'l' || i || page_id), '/') AS k FROM pages)""")
def prefix_levels(spark: SparkSession, base: str) -> DataFrame:
    """Keys of one to five levels, three levels dropped (or the first kept)."""
    p = read_table(spark, base, "pages").select("page_id")
    key = F.array_join(F.transform(F.sequence(F.lit(0), (F.col("page_id") % 5).cast("int")), lambda i: F.concat(
        F.lit("l"), i.cast("string"), F.col("page_id").cast("string"))), "/")
    return p.withColumn("k", key).select("page_id", uri.drop_last_levels("k", 3).alias("prefix"))


_TAG = '<script type="application/ld+json">'
_LIST = '[{"itemListElement":[{"item":{"offers":{"price":5}}}]}]'
# (html, reason): one page of each kind; ``found`` where the reason is null.
_KINDS = (("<p>none</p>", "no_script"), (_TAG + '{"a":1}</script>', "not_list"), (_TAG + "[1,</script>", "bad_json"),
          (_TAG + "[]</script>", "empty_list"), (_TAG + '[{"a":1}]</script>', "no_item_list"),
          (f"<!-- {_TAG}{_LIST}</script> -->", "no_script"),
          (f'<script data-type="application/ld+json">{_LIST}</script>', "no_script"),
          (f'<script type="application/ld+json2">{_LIST}</script>', "no_script"),
          (f"<!-- {_TAG}[]</script> --><SCRIPT id=a TYPE=application/ld+json>{_LIST}</script>", None))


@query("miss_reasons", sql=f"""
SELECT page_id, ([{", ".join("NULL" if r is None else repr(r) for _, r in _KINDS)}])[page_id % {len(_KINDS)} + 1] AS reason
FROM pages""")
def miss_reasons(spark: SparkSession, base: str) -> DataFrame:
    """Pages with each kind of script: the parse's reason, null where a listing is found."""
    pages = read_table(spark, base, "pages").select(
        "page_id", "url", _pick([h for h, _ in _KINDS], F.col("page_id")).alias("html"))
    return parse_pages(pages, keep=("page_id", "url")).select("page_id", "reason")


@query("crawl_mean_price", sql="""
WITH lots AS (SELECT p_brand, p_type, p_retailprice AS price FROM part),
rows AS (SELECT a.p_brand AS b, l.price FROM part a JOIN lots l USING (p_brand, p_type))
SELECT p_partkey, round(m, 4) AS mean_price
FROM part JOIN (SELECT b, avg(price) AS m FROM rows GROUP BY b) ON p_brand = b""")
def crawl_mean_price(spark: SparkSession, base: str) -> DataFrame:
    """Crawl, then the hook: the mean over one row per lot, from rows that stand for many lots."""
    part = read_table(spark, base, "part")
    lots = part.select("p_brand", "p_type", search_url().alias("url"))
    found, _ = lookup_listings(lots, "url", ["p_brand"], listing_pages(part))
    hook = mean_price_hook(["p_brand"], weight="n_lots", digits=4)
    return apply_hook(part.select("p_partkey", "p_brand"), found, hook).select("p_partkey", "mean_price")


@query("split_exact_repeated", sql=f"""
WITH c AS (SELECT count(*) AS n, CAST(ceil(count(*) * {TEST_SIZE!r}::DOUBLE) AS BIGINT) AS t FROM lineitem),
d AS (SELECT n, t, CAST(ceil((n - t) * {VALIDATION_SIZE!r}::DOUBLE) AS BIGINT) AS v FROM c)
SELECT 'test' AS split, t AS n FROM d UNION ALL SELECT 'validation', v FROM d
UNION ALL SELECT 'train', n - t - v FROM d""")
def split_exact_repeated(spark: SparkSession, base: str) -> DataFrame:
    """Exact split of lots by order key, which repeats and is null on every ninth line."""
    li = read_table(spark, base, "lineitem").withColumn(
        "k", F.when(F.col("l_linenumber") % 9 != 4, F.col("l_orderkey")))
    return split_exact(li, "k").groupBy("split").agg(F.count("*").alias("n"))


# --- the two triggers -----------------------------------------------------

_TYPES = ("click", "purchase", "nothing")


def _land(spark: SparkSession, keys: DataFrame) -> str:
    """Notifications (one JSON line each) of bucket ``b`` for a ``key`` column."""
    record = F.struct(F.lit("t").alias("eventTime"), F.lit("put").alias("eventName"), F.struct(
        F.struct(F.lit("b").alias("name")).alias("bucket"), F.struct("key").alias("object")).alias("s3"))
    path = scratch_path(spark, "incoming")
    keys.select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("value")).write.text(path)
    return path


def _companions(events: DataFrame, prefix) -> DataFrame:
    """Newest crawl file per folder: one file per event."""
    listing = events.select(prefix.alias("prefix"), F.concat(prefix, F.lit("/"), F.col("event_id").cast("string"),
                                                             F.lit(".csv")).alias("path"), "ts")
    return latest_per_key(listing, ["prefix"], "ts", "path", ["path"]).withColumnRenamed("path", "companion_path")


def _run(spark: SparkSession, out: DataFrame) -> DataFrame:
    sink = scratch_path(spark, "sink")
    run_available(out, sink, scratch_path(spark, "ckpt"))
    return spark.read.parquet(sink).drop("batch_id")


@query("stream_training_requests", sql="""
WITH t AS (
  SELECT event_type, 'HPO-' || upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || '-' || CAST(event_id // 100 AS VARCHAR) AS job,
         event_id, ts, value, props FROM events WHERE event_type <> 'error'),
j AS (SELECT event_type, job FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, job) AS rn FROM t WHERE ts IS NOT NULL) WHERE rn = 1),
b AS (SELECT event_type, k FROM (
  SELECT event_type, json_extract_string(props, '$.k') AS k, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS rn
  FROM t JOIN j USING (event_type, job) WHERE value IS NOT NULL) WHERE rn = 1),
c AS (SELECT event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, CAST(event_id AS VARCHAR) || '.csv') AS rn FROM events WHERE ts IS NOT NULL) WHERE rn = 1)
SELECT 's3://b/root/' || e.event_type || '/lelang/' || o.o_orderkey || '/f.csv' AS s3_path, e.event_type AS model_type,
       'Training-' || upper(substr(e.event_type, 1, 1)) || lower(substr(e.event_type, 2)) AS run_name, b.k AS k,
       'root/' || e.event_type || '/crawling/' || c.event_id || '.csv' AS companion_path
FROM orders o JOIN (SELECT unnest(['click', 'purchase']) AS event_type, unnest([0, 1]) AS i) e ON o.o_orderkey % 3 = e.i
LEFT JOIN b USING (event_type) LEFT JOIN c USING (event_type)""")
def stream_training_requests(spark: SparkSession, base: str) -> DataFrame:
    """Auction files -> training runs with the newest search's best parameters and the newest crawl file."""
    orders, events = read_table(spark, base, "orders"), read_table(spark, base, "events")
    keys = orders.select(F.concat(F.lit("root/"), _pick(_TYPES, F.col("o_orderkey")), F.lit("/lelang/"),
                                  F.col("o_orderkey").cast("string"), F.lit("/f.csv")).alias("key"))
    best = best_of_newest_job(trials_from_events(events), ["params"]).select("model_type", "params")
    newest = _companions(events, F.concat(F.lit("root/"), "event_type", F.lit("/crawling")))
    req = run_requests(records(stream_notifications(spark, _land(spark, keys))), routes_table(spark, _TYPES[:2]))
    out = attach_run_inputs(attach_companion(req, newest), best)
    return _run(spark, out.select("s3_path", "model_type", "run_name", F.col("params")["k"].alias("k"), "companion_path"))


@query("stream_scoring_requests", sql="""
WITH m AS (SELECT event_type, name FROM (
  SELECT event_type, upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || '-model-' || event_id AS name, ts,
         row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) || '-model-' || event_id) AS rn
  FROM events WHERE ts IS NOT NULL) WHERE rn = 1),
c AS (SELECT event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, CAST(event_id AS VARCHAR) || '.csv') AS rn FROM events WHERE ts IS NOT NULL) WHERE rn = 1)
SELECT 's3://b/root/batch-transform/' || e.event_type || '/' || o.o_orderkey || '.csv' AS s3_path, e.event_type AS model_type,
       'BatchTransform-' || upper(substr(e.event_type, 1, 1)) || lower(substr(e.event_type, 2)) AS run_name, m.name AS model_name,
       'root/training/' || e.event_type || '/crawling/' || c.event_id || '.csv' AS companion_path
FROM orders o JOIN (SELECT unnest(['click', 'purchase']) AS event_type, unnest([0, 1]) AS i) e ON o.o_orderkey % 3 = e.i
LEFT JOIN m USING (event_type) LEFT JOIN c USING (event_type)""")
def stream_scoring_requests(spark: SparkSession, base: str) -> DataFrame:
    """Scoring files -> scoring runs with the newest model of the make and its training crawl file."""
    orders, events = read_table(spark, base, "orders"), read_table(spark, base, "events")
    keys = orders.select(F.concat(F.lit("root/batch-transform/"), _pick(_TYPES, F.col("o_orderkey")), F.lit("/"),
                                  F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("key"))
    models = models_from_events(events).withColumnsRenamed({"name": "model_name", "path": "model_path"})
    model = latest_per_key(models, ["model_type"], "created_at", "model_name", ["model_name", "model_path"])
    newest = _companions(events, F.concat(F.lit("root/training/"), "event_type", F.lit("/crawling")))
    req = run_requests(records(stream_notifications(spark, _land(spark, keys))), scoring_routes(spark, _TYPES[:2]))
    out = attach_run_inputs(attach_companion(req, newest, scoring_companion_prefix()), newest_model=model)
    return _run(spark, out.select("s3_path", "model_type", "run_name", "model_name", "companion_path"))
