
from appraise.operators.lookup import lookup_listings
from appraise.sources.pages import listing_prices, page_links, parse_pages

LD = '<script type="application/ld+json">{}</script>'
PAGES = [
    ("two", "<html><head>" + LD.format(
        '[{"itemListElement":[{"item":{"offers":{"price":150000000}}},'
        '{"item":{"offers":{"price":"149000000"}}}]}]') + "</head></html>"),
    ("object", LD.format('{"itemListElement":[{"item":{"offers":{"price":1}}}]}')),
    ("empty", LD.format("[]")),
    ("no_list_key", LD.format('[{"name":"x"}]')),
    ("no_script", "<html><script>var a = 1;</script></html>"),
    ("attr_order", "<SCRIPT id='x' TYPE='application/ld+json'>"
                   '[{"itemListElement":[{"item":{"offers":{"price":7}}}]}]</SCRIPT>'),
]


def test_jsonld_cases(spark):
    pages = spark.createDataFrame(PAGES, "url string, html string")
    parsed = {r["url"]: (r["found"], r["reason"]) for r in parse_pages(pages).collect()}
    assert parsed["two"] == (True, None)
    assert parsed["attr_order"] == (True, None)
    assert parsed["object"] == (False, "not_list")
    assert parsed["empty"] == (False, "empty_list")
    assert parsed["no_list_key"] == (False, "no_item_list")
    assert parsed["no_script"] == (False, "no_script")
    prices = sorted((r["url"], r["price"]) for r in listing_prices(parse_pages(pages)).collect())
    assert prices == [("attr_order", 7.0), ("two", 149000000.0), ("two", 150000000.0)]


def test_links(spark):
    pages = spark.createDataFrame([("p", '<a href="/a">a</a><A class="x" HREF="/b">b</A>')],
                                  "url string, html string")
    assert [r["link"] for r in page_links(pages).collect()] == ["/a", "/b"]


def test_lookup_dedupes_and_reports_misses(spark):
    pages = spark.createDataFrame(PAGES, "url string, html string")
    rows = spark.createDataFrame(
        [("two", "a"), ("two", "a"), ("two", "b"), ("empty", "a"), ("gone", "a")],
        "url string, tag string")
    found, misses = lookup_listings(rows, "url", ["tag"], pages)
    got = sorted((r["tag"], r["n_lots"], r["price"]) for r in found.collect())
    assert got == [("a", 2, 149000000.0), ("a", 2, 150000000.0),
                   ("b", 1, 149000000.0), ("b", 1, 150000000.0)]
    m = {(r["url"], r["reason"]) for r in misses.collect()}
    assert m == {("empty", "empty_list"), ("gone", "no_page")}


def test_read_landed_pages_json(spark):
    import json
    import os

    from appraise.session import scratch_path
    from appraise.sources.pages import read_pages
    from appraise.sources.workbook import local_path
    folder = local_path(scratch_path(spark, "landed"))
    os.makedirs(folder)
    with open(os.path.join(folder, "pages.json"), "w") as fh:
        for url, html in PAGES:
            fh.write(json.dumps({"url": url, "html": html, "extra": 1}) + "\n")
    pages = read_pages(spark, folder, fmt="json")
    assert pages.columns == ["url", "html"] and pages.count() == len(PAGES)
    assert listing_prices(parse_pages(pages)).count() == 3
