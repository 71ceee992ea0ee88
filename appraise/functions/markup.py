"""HTML and JSON-LD extraction as native expressions.

A page is searched with a regex for its first ``<script type="application/ld+json">``
block (attribute order, quoting and case are free, comments are skipped), the block is parsed with
``from_json`` against the listing schema, and prices are read from
``[0].itemListElement[*].item.offers.price``. Prices are read as text, since the
JSON may hold a number or a quoted string, and then ``try_cast`` to double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

JSONLD_SCRIPT = (r"(?is)<script(?:\s[^>]*?)?\stype\s*=\s*(?:(?:\"application/ld\+json\"|'application/ld\+json')[^>]*"
                 r"|application/ld\+json(?:\s[^>]*)?)>(.*?)</script\s*>")
COMMENT = r"(?s)<!--.*?-->"
ANCHOR_HREF = r'(?i)<a\s[^>]*?href\s*=\s*"([^"]*)"'

LISTING_SCHEMA = ("array<struct<itemListElement: array<struct<item: struct<"
                  "offers: struct<price: string>>>>>>")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_jsonld(html: Column | str) -> Column:
    """Body of the first JSON-LD script block, NULL when there is none."""
    body = F.regexp_extract(F.regexp_replace(_c(html), COMMENT, ""), JSONLD_SCRIPT, 1)
    return F.when(F.trim(body) != "", body)


def parse_listing(json_text: Column | str) -> Column:
    """Parsed listing array; NULL unless the text is a JSON list."""
    t = _c(json_text)
    return F.when(F.ltrim(t).startswith("["), F.from_json(t, LISTING_SCHEMA))


def listing_found(parsed: Column | str) -> Column:
    p = _c(parsed)
    return (p.isNotNull() & (F.size(p) > 0)
            & F.get(p, 0).getField("itemListElement").isNotNull()).alias("found")


def miss_reason(script: Column | str, parsed: Column | str) -> Column:
    """Why a page yields no listing (NULL when it does)."""
    s, p = _c(script), _c(parsed)
    return (F.when(s.isNull(), F.lit("no_script"))
            .when(~F.ltrim(s).startswith("["), F.lit("not_list"))
            .when(p.isNull(), F.lit("bad_json"))
            .when(F.size(p) == 0, F.lit("empty_list"))
            .when(F.get(p, 0).getField("itemListElement").isNull(), F.lit("no_item_list")))


def listing_price_texts(parsed: Column | str) -> Column:
    """Array of price texts of the first list entry's items."""
    items = F.get(_c(parsed), 0).getField("itemListElement")
    return F.transform(items, lambda x: x.getField("item").getField("offers").getField("price"))


def price_value(price_text: Column | str) -> Column:
    return _c(price_text).try_cast("double")


def links(html: Column | str) -> Column:
    """Every double-quoted ``href`` of an anchor tag, in page order."""
    return F.regexp_extract_all(_c(html), F.lit(ANCHOR_HREF), F.lit(1))
