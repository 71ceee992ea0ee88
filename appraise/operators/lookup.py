"""Per-row page lookup by a computed URL, one output row per listing.

The lookup key is computed per row; many rows share a key (the URL depends on
a handful of label values), so the plan deduplicates first:

1. distinct (url, carried columns) with a row count ``n_lots`` – a hash
   aggregate whose partial step folds hot keys on the map side;
2. pages are held against a Bloom filter of the wanted URLs while they are
   scanned, so the html of pages nobody asks for never reaches an exchange; the
   survivors meet the wanted URLs exactly (semi join) and are parsed once per page;
3. combos joined to listings on url. AQE measures the materialised listing
   stage and broadcasts it only under the broadcast threshold; above it the
   join stays a shuffle join with skew splitting.

Each (combo, listing) pair is emitted once with the number of rows it stands
for, instead of once per row. A URL gives combos x listings rows, which stays
small as long as ``carry`` holds label columns the URL is made of. The parsed
pages (prices and reasons, no html) are written to the shared scratch folder, so reading
both outputs parses a page once and nothing stays in the executors' memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appraise.session import written
from appraise.sources.pages import listing_prices, parse_pages

BLOOM_BITS_PER_KEY = 16
MAX_BLOOM_BITS = 1 << 27        # 2 million words of 64 bits at most, whatever is wanted
BLOOM_SEEDS = (1, 2)


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))


def bloom_words(keys: DataFrame, col: str, bits: int) -> list[DataFrame]:
    """A Bloom filter as tables (word, mask), one per hash function; keys fold into words in Spark."""
    out = []
    for seed in BLOOM_SEEDS:
        at = F.pmod(F.xxhash64(F.lit(seed), F.col(col)), F.lit(bits))
        out.append(keys.select(F.shiftright(at, 6).alias("word"), _bit(at).alias("bit"))
                   .groupBy("word").agg(F.bit_or("bit").alias("mask")))
    return out


def may_hold(df: DataFrame, col: str, words: list[DataFrame], bits: int) -> DataFrame:
    """Rows whose value may be one of the filter's keys; null values never are."""
    out = df
    for seed, table in zip(BLOOM_SEEDS, words):
        at = F.pmod(F.xxhash64(F.lit(seed), F.col(col)), F.lit(bits))
        mask = _bit(at)
        # At most bits / 64 rows by construction, so the size of the broadcast is bounded.
        out = out.join(F.broadcast(table), (F.shiftright(at, 6) == table["word"]) & (table["mask"].bitwiseAND(mask) != 0), "left_semi")
    return out.filter(F.col(col).isNotNull())


def landed_pages(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """Pages whose url is wanted (``wanted``: distinct ``url``)."""
    n = wanted.agg(F.approx_count_distinct("url")).first()[0]
    bits = 64
    while bits < min(MAX_BLOOM_BITS, BLOOM_BITS_PER_KEY * max(n, 1)):
        bits *= 2
    survivors = may_hold(pages, "url", bloom_words(wanted, "url", bits), bits)
    return survivors.join(wanted, "url", "left_semi")


def lookup_listings(rows: DataFrame, url: str, carry: Sequence[str],
                    pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(listings, misses) for the rows' computed URLs.

    listings: url, carried columns, n_lots, price_text, price
    misses:   url, carried columns, n_lots, reason ('no_page' when no page landed)
    """
    combos = rows.groupBy(url, *carry).agg(F.count(F.lit(1)).alias("n_lots"))
    wanted = written(combos.select(F.col(url).alias("url")).filter("url IS NOT NULL").distinct(), "wanted-urls")
    parsed = written(parse_pages(landed_pages(pages, wanted)), "parsed-pages")
    prices = listing_prices(parsed).withColumnRenamed("url", url)
    # No hint and no driver-side count (a count would run the page parse twice):
    # AQE measures the listing stage once it is materialised and broadcasts it
    # only under autoBroadcastJoinThreshold, else keeps the shuffle join.
    found = combos.join(prices, url, "inner")
    page_state = parsed.groupBy("url").agg(F.max(F.col("found").cast("int")).alias("any_found"),
                                           F.min("reason").alias("reason")) \
        .withColumnRenamed("url", url)
    misses = (combos.join(page_state, url, "left")
              .filter(F.col("any_found").isNull() | (F.col("any_found") == 0))
              .select(url, *carry, "n_lots",
                      F.coalesce(F.col("reason"), F.lit("no_page")).alias("reason")))
    return found.select(url, *carry, "n_lots", "price_text", "price"), misses
