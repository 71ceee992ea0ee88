"""Landed web pages (url, html) and their parsed JSON-LD listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions import markup

PAGES_SCHEMA = "url string, html string"


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed pages; any format with ``url`` and ``html`` columns."""
    reader = spark.read.format(fmt)
    if fmt in ("json", "csv"):
        reader = reader.schema(PAGES_SCHEMA)
    return reader.load(path).select("url", "html")


def parse_pages(pages: DataFrame, keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per page: kept columns, found flag, miss reason, price texts.

    The result leaves through ``inline_outer`` of a one-element array: filters
    that callers put on ``found`` / ``reason`` / ``price_texts`` (or that Spark
    infers for a later ``explode``) refer to generator output and cannot be
    pushed below it, so the page regex and JSON parse run once per page instead
    of once more inside a pushed-down filter.
    """
    script = markup.first_jsonld("html")
    parsed = pages.select(*keep, script.alias("__script"))
    parsed = parsed.withColumn("__parsed", markup.parse_listing("__script"))
    result = F.struct(
        markup.listing_found("__parsed").alias("found"),
        markup.miss_reason("__script", "__parsed").alias("reason"),
        F.when(markup.listing_found("__parsed"), markup.listing_price_texts("__parsed"))
        .alias("price_texts"))
    return parsed.select(*keep, F.inline_outer(F.array(result)))


def listing_prices(parsed: DataFrame, keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per listing of every found page: kept columns, price text, price.

    ``price_texts`` is NULL on pages without a listing and ``explode`` of NULL
    gives no row.
    """
    return (parsed.select(*keep, F.explode("price_texts").alias("price_text"))
            .withColumn("price", markup.price_value("price_text")))


def page_links(pages: DataFrame, keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per anchor link of every page."""
    return pages.select(*keep, F.explode(markup.links("html")).alias("link"))
