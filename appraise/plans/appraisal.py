"""Labelling, split and quality queries on the auction stand-in tables.

Stand-ins: ``part`` is the auction / listing table (``p_name`` is the free-text
type, ``p_retailprice`` a listed price) and ``lineitem`` the lot table whose
``l_extendedprice`` is the target; ``orders.o_orderkey`` is the split key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions.labels import (ENGINE_CC, TRANSMISSION, TRANSMISSION_GROUPED, TRIM,
                                       label, label_sql)
from appraise.operators.metrics import regression_metrics, report_json
from appraise.operators.split import (TRAIN_SEEDS, TEST_SIZE, VALIDATION_SIZE,
                                      fraction_threshold, hash32_sql, split_exact,
                                      split_exact_sql, split_fraction)
from appraise.plans.registry import query
from appraise.sources.tables import read_table

DIGITS = 6


def _type_text(col: str = "p_name"):
    return F.upper(F.col(col))


def scored_lots(spark: SparkSession, base: str) -> DataFrame:
    """Lots joined to their listing, labelled, split and scored by the price rule.

    The rule model ``l_quantity * p_retailprice`` keeps this slice free of ML so
    every number can be checked in SQL. The join is a plain equi-join: both
    sides grow with the data, so Catalyst/AQE choose sort-merge (or a runtime
    broadcast when the listing side measures small) and AQE splits skewed keys.
    """
    lots = read_table(spark, base, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    # Labels are computed on the listing side, once per listing, before the join.
    listings = read_table(spark, base, "part").select(
        "p_partkey", "p_retailprice",
        label(_type_text(), TRIM).alias(TRIM.name),
        label(_type_text(), TRANSMISSION).alias(TRANSMISSION.name))
    labelled = lots.join(listings, lots.l_partkey == listings.p_partkey)
    return (split_fraction(labelled, "l_orderkey")
            .withColumn("prediction", F.col("l_quantity") * F.col("p_retailprice")))


@query("appraisal_report", sql=f"""
WITH lots AS (
  SELECT l.l_orderkey, l.l_extendedprice AS y, l.l_quantity * p.p_retailprice AS pred,
         {label_sql('upper(p.p_name)', TRIM)} AS type_detail,
         {label_sql('upper(p.p_name)', TRANSMISSION)} AS transmisi
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
s AS (
  SELECT *, CASE WHEN {hash32_sql('l_orderkey', TRAIN_SEEDS[0])} < {fraction_threshold(TEST_SIZE)} THEN 'test'
                 WHEN {hash32_sql('l_orderkey', TRAIN_SEEDS[1])} < {fraction_threshold(VALIDATION_SIZE)} THEN 'validation'
                 ELSE 'train' END AS split
  FROM lots)
SELECT split, type_detail, transmisi,
       CAST(count(CASE WHEN y IS NOT NULL AND pred IS NOT NULL THEN 1 END) AS BIGINT) AS n,
       round(sqrt(avg(power(y - pred, 2))), {DIGITS}) AS rmse,
       round(stddev_pop(y - pred), {DIGITS}) AS residual_std,
       CAST(count(CASE WHEN y IS NULL OR pred IS NULL THEN 1 END) AS BIGINT) AS n_null
FROM s GROUP BY split, type_detail, transmisi""")
def appraisal_report(spark: SparkSession, base: str) -> DataFrame:
    """Flagship: RMSE and residual std per split and label of the rule-scored lots."""
    return regression_metrics(scored_lots(spark, base), "l_extendedprice", "prediction",
                              by=["split", TRIM.name, TRANSMISSION.name], digits=DIGITS)


@query("label_keywords", sql=f"""
SELECT p_partkey, p_name,
       {label_sql('upper(p_name)', TRANSMISSION)} AS transmisi,
       {label_sql('upper(p_name)', TRIM)} AS type_detail,
       {label_sql('upper(p_name)', ENGINE_CC)} AS cc
FROM part""")
def label_keywords(spark: SparkSession, base: str) -> DataFrame:
    """Transmission, trim and engine-size labels of every listing text."""
    part = read_table(spark, base, "part")
    t = _type_text()
    return part.select("p_partkey", "p_name",
                       label(t, TRANSMISSION).alias("transmisi"),
                       label(t, TRIM).alias("type_detail"),
                       label(t, ENGINE_CC).alias("cc"))


_PREC_TEXT = "concat_ws(' ', upper(p_name), upper(p_type), p_brand)"


@query("label_keywords_precedence", sql=f"""
SELECT p_partkey,
       {label_sql(_PREC_TEXT, TRANSMISSION)} AS transmisi_ordered,
       {label_sql(_PREC_TEXT, TRANSMISSION_GROUPED)} AS transmisi_grouped
FROM part""")
def label_keywords_precedence(spark: SparkSession, base: str) -> DataFrame:
    """Same text under the original keyword order and the grouped order."""
    part = read_table(spark, base, "part")
    t = F.concat_ws(" ", F.upper("p_name"), F.upper("p_type"), F.col("p_brand"))
    return part.select("p_partkey", label(t, TRANSMISSION).alias("transmisi_ordered"),
                       label(t, TRANSMISSION_GROUPED).alias("transmisi_grouped"))


@query("split_fraction", sql=f"""
SELECT o_orderkey,
       CASE WHEN {hash32_sql('o_orderkey', TRAIN_SEEDS[0])} < {fraction_threshold(TEST_SIZE)} THEN 'test'
            WHEN {hash32_sql('o_orderkey', TRAIN_SEEDS[1])} < {fraction_threshold(VALIDATION_SIZE)} THEN 'validation'
            ELSE 'train' END AS split
FROM orders""")
def split_fraction_q(spark: SparkSession, base: str) -> DataFrame:
    """Hash-fraction split of every order key (a projection, no shuffle)."""
    return split_fraction(read_table(spark, base, "orders").select("o_orderkey"), "o_orderkey")


@query("split_exact", sql=split_exact_sql("orders", "o_orderkey"))
def split_exact_q(spark: SparkSession, base: str) -> DataFrame:
    """Exact-size split of every order key (bounded histograms, map-side assignment)."""
    return split_exact(read_table(spark, base, "orders").select("o_orderkey"), "o_orderkey")


@query("split_sizes", sql=f"""
SELECT split, CAST(count(*) AS BIGINT) AS n FROM ({split_exact_sql('orders', 'o_orderkey')}) s
GROUP BY split""")
def split_sizes(spark: SparkSession, base: str) -> DataFrame:
    """Row count per split of the exact split."""
    return split_exact_q(spark, base).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("eval_metrics", sql=f"""
WITH s AS (
  SELECT CASE WHEN {hash32_sql('l.l_orderkey', TRAIN_SEEDS[0])} < {fraction_threshold(TEST_SIZE)} THEN 'test'
              WHEN {hash32_sql('l.l_orderkey', TRAIN_SEEDS[1])} < {fraction_threshold(VALIDATION_SIZE)} THEN 'validation'
              ELSE 'train' END AS split,
         l.l_extendedprice AS y, l.l_quantity * p.p_retailprice AS pred
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT split, CAST(count(CASE WHEN y IS NOT NULL AND pred IS NOT NULL THEN 1 END) AS BIGINT) AS n,
       round(sqrt(avg(power(y - pred, 2))), {DIGITS}) AS rmse,
       round(stddev_pop(y - pred), {DIGITS}) AS residual_std,
       CAST(count(CASE WHEN y IS NULL OR pred IS NULL THEN 1 END) AS BIGINT) AS n_null
FROM s GROUP BY split""")
def eval_metrics(spark: SparkSession, base: str) -> DataFrame:
    """RMSE and population residual std per split."""
    return regression_metrics(scored_lots(spark, base), "l_extendedprice", "prediction",
                              by=["split"], digits=DIGITS)


_REPORT_DIGITS = 4


@query("eval_report", sql=f"""
WITH s AS (
  SELECT CASE WHEN {hash32_sql('l.l_orderkey', TRAIN_SEEDS[0])} < {fraction_threshold(TEST_SIZE)} THEN 'test'
              WHEN {hash32_sql('l.l_orderkey', TRAIN_SEEDS[1])} < {fraction_threshold(VALIDATION_SIZE)} THEN 'validation'
              ELSE 'train' END AS split,
         l.l_extendedprice AS y, l.l_quantity * p.p_retailprice AS pred
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
m AS (
  SELECT split, round(sqrt(avg(power(y - pred, 2))), {_REPORT_DIGITS}) AS rmse,
         round(stddev_pop(y - pred), {_REPORT_DIGITS}) AS residual_std
  FROM s GROUP BY split)
SELECT split, CAST(to_json({{'regression_metrics': {{'rmse': {{'value': rmse,
       'standard_deviation': residual_std}}}}}}) AS VARCHAR) AS report
FROM m""")
def eval_report(spark: SparkSession, base: str) -> DataFrame:
    """The nested JSON report per split."""
    m = regression_metrics(scored_lots(spark, base), "l_extendedprice", "prediction",
                           by=["split"], digits=_REPORT_DIGITS)
    return m.select("split", report_json().alias("report"))
