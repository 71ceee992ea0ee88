"""Page queries: links, JSON-LD listings, misses and the per-URL lookup.

The landed ``pages`` table holds no JSON-LD, so listing pages are derived from
``part`` with Spark: listings are grouped by a search URL (brand and type) and
spread over result pages of about 20 entries by a hash of the listing key, the
way a search site pages its results. Listings with ``p_size > 25`` carry their
price as a quoted string, the rest as a JSON number; every other page writes
its script tag in upper case with single quotes and an extra attribute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions import markup
from appraise.functions.labels import _sql_str
from appraise.operators.lookup import lookup_listings
from appraise.plans.registry import query
from appraise.plans.workflows import listing_url
from appraise.sources.pages import listing_prices, page_links, parse_pages
from appraise.sources.tables import read_table

PAGE_SIZE = 20


def search_url(brand: str = "p_brand", ptype: str = "p_type"):
    slug = F.lower(F.regexp_replace(F.col(brand), "[^A-Za-z0-9]+", "-"))
    return F.concat(F.lit("https://listings.example/"), slug, F.lit("/"), F.lower(F.col(ptype)))


SEARCH_URL_SQL = ("'https://listings.example/' || lower(regexp_replace(p_brand, '[^A-Za-z0-9]+', '-', 'g'))"
                  " || '/' || lower(p_type)")


def listing_pages(part: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """(url, page_no, html) result pages built from the listing table."""
    keyed = part.select("p_partkey", "p_size", "p_retailprice", search_url().alias("url"))
    sizes = keyed.groupBy("url").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(page_size)).cast("bigint").alias("n_pages"))
    paged = keyed.join(sizes, "url").withColumn(
        "page_no", F.pmod(F.xxhash64("p_partkey"), F.col("n_pages")))
    price = F.col("p_retailprice").cast("string")
    token = F.when(F.col("p_size") > 25, F.concat(F.lit('"'), price, F.lit('"'))).otherwise(price)
    item = F.concat(F.lit('{"item":{"offers":{"price":'), token, F.lit("}}}"))
    pages = paged.groupBy("url", "page_no").agg(
        F.array_join(F.collect_list(item), ",").alias("items"))
    open_tag = F.when(F.col("page_no") % 2 == 0, F.lit('<script type="application/ld+json">')) \
        .otherwise(F.concat(F.lit("<SCRIPT data-page='"), F.col("page_no").cast("string"),
                            F.lit("' TYPE='application/ld+json'>")))
    html = F.concat(F.lit("<!DOCTYPE html><html><head><title>results</title>"), open_tag,
                    F.lit('[{"@type":"ItemList","itemListElement":['), F.col("items"),
                    F.lit("]}]</script></head><body><p>results</p></body></html>"))
    return pages.select("url", "page_no", html.alias("html"))


@query("page_links", sql=f"""
SELECT page_id, unnest(regexp_extract_all(html, {_sql_str(markup.ANCHOR_HREF)}, 1)) AS link
FROM pages""")
def page_links_q(spark: SparkSession, base: str) -> DataFrame:
    """Every anchor link of every landed page."""
    return page_links(read_table(spark, base, "pages"), keep=("page_id",))


_SCRIPT_SQL = f"regexp_extract(html, {_sql_str(markup.JSONLD_SCRIPT)}, 1)"


@query("jsonld_misses", sql=f"""
WITH s AS (SELECT page_id, url, {_SCRIPT_SQL} AS script FROM pages),
r AS (
  SELECT page_id, url,
    CASE WHEN trim(script) = '' THEN 'no_script'
         WHEN NOT starts_with(ltrim(script), '[') THEN 'not_list'
         WHEN NOT json_valid(script) THEN 'bad_json'
         WHEN json_array_length(script) = 0 THEN 'empty_list'
         WHEN json_extract(script, '$[0].itemListElement') IS NULL THEN 'no_item_list'
    END AS reason
  FROM s)
SELECT page_id, url, reason FROM r WHERE reason IS NOT NULL""")
def jsonld_misses(spark: SparkSession, base: str) -> DataFrame:
    """Landed pages that yield no listing, with the reason."""
    parsed = parse_pages(read_table(spark, base, "pages"), keep=("page_id", "url"))
    return parsed.filter(~F.col("found")).select("page_id", "url", "reason")


@query("jsonld_prices", sql=f"""
SELECT {SEARCH_URL_SQL} AS url, p_retailprice AS price FROM part""")
def jsonld_prices(spark: SparkSession, base: str) -> DataFrame:
    """Every listing price read back from the result pages' JSON-LD."""
    pages = listing_pages(read_table(spark, base, "part"))
    return listing_prices(parse_pages(pages)).select("url", "price")


@query("jsonld_found", sql=f"""
SELECT {SEARCH_URL_SQL} AS url, CAST(count(*) AS BIGINT) AS n_listings FROM part GROUP BY 1""")
def jsonld_found(spark: SparkSession, base: str) -> DataFrame:
    """Listings found per search URL over all of its result pages."""
    pages = listing_pages(read_table(spark, base, "part"))
    # Count inside the aggregate (no row filter to push below the parse).
    n = F.when(F.col("found"), F.size("price_texts")).otherwise(F.lit(0))
    return (parse_pages(pages).groupBy("url")
            .agg(F.sum(n).cast("bigint").alias("n_listings"))
            .filter(F.col("n_listings") > 0))


@query("page_lookup", sql=f"""
WITH lots AS (
  SELECT {SEARCH_URL_SQL} AS url, p_brand, p_type, CAST(count(*) AS BIGINT) AS n_lots
  FROM part GROUP BY 1, 2, 3)
SELECT l.url, l.p_brand, l.p_type, l.n_lots, p.p_retailprice AS price
FROM lots l JOIN part p ON l.url = {SEARCH_URL_SQL.replace('p_brand', 'p.p_brand').replace('p_type', 'p.p_type')}""")
def page_lookup(spark: SparkSession, base: str) -> DataFrame:
    """Each listing's search URL looked up in the result pages, one row per price."""
    part = read_table(spark, base, "part")
    lots = part.select("p_brand", "p_type", search_url().alias("url"))
    found, _ = lookup_listings(lots, "url", ["p_brand", "p_type"], listing_pages(part))
    return found.select("url", "p_brand", "p_type", "n_lots", "price")


@query("links_joined", sql=f"""
SELECT page_id, array_to_string(regexp_extract_all(html, {_sql_str(markup.ANCHOR_HREF)}, 1), ',')
       AS links
FROM pages""")
def links_joined(spark: SparkSession, base: str) -> DataFrame:
    """Per page, its links joined with commas in page order (no grouping needed)."""
    pages = read_table(spark, base, "pages")
    return pages.select("page_id", F.array_join(markup.links("html"), ",").alias("links"))


PAGE_URL_TEMPLATE = "https://listings.example/{brand}/{variant}/size-{p_size}?type={p_type}"


@query("page_url", sql="""
SELECT p_partkey,
       'https://listings.example/toyota/avanza/size-' || CAST(p_size AS VARCHAR) || '?type='
         || p_type AS url
FROM part""")
def page_url(spark: SparkSession, base: str) -> DataFrame:
    """A listing search URL per row, composed from the template and row values."""
    part = read_table(spark, base, "part")
    return part.select("p_partkey", listing_url(PAGE_URL_TEMPLATE).alias("url"))
