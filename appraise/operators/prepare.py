"""Preparation hooks: how the auction table and the crawl table are combined.

A hook is any ``(auction, crawl) -> DataFrame`` callable; it is applied with
``DataFrame.transform`` so it stays part of the one logical plan (an unused
crawl table is never scanned).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Hook = Callable[[DataFrame, DataFrame], DataFrame]


def identity_hook(auction: DataFrame, crawl: DataFrame) -> DataFrame:
    """Default: the auction table as it is."""
    return auction


def mean_price_hook(auction_keys: Sequence[str], crawl_keys: Sequence[str] | None = None,
                    price: str = "price", out: str = "mean_price",
                    digits: int | None = None, weight: str | None = None) -> Hook:
    """Left-join each auction row to the crawl's mean price for its key.

    ``weight`` names the rows a crawl row stands for (``n_lots`` of a crawl
    table): the mean is then that of one row per lot. Rows without a price
    carry no weight.

    The crawl side is aggregated first (partial aggregation folds hot keys),
    so the join sees one row per key; AQE broadcasts it when it measures small.
    """
    crawl_keys = list(crawl_keys or auction_keys)

    def hook(auction: DataFrame, crawl: DataFrame) -> DataFrame:
        m = F.avg(F.col(price))
        if weight is not None:
            w = F.when(F.col(price).isNotNull(), F.col(weight))
            m = F.sum(F.col(price) * w) / F.sum(w)
        if digits is not None:
            m = F.round(m, digits)
        agg = crawl.groupBy(*crawl_keys).agg(m.alias(out))
        for a, c in zip(auction_keys, crawl_keys):
            if a != c:
                agg = agg.withColumnRenamed(c, a)
        return auction.join(agg, list(auction_keys), "left")
    return hook


def apply_hook(auction: DataFrame, crawl: DataFrame, hook: Hook = identity_hook) -> DataFrame:
    return auction.transform(lambda a: hook(a, crawl))
