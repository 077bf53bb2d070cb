"""Sitemap indexes, filters, and ids and categories of addresses."""

import pytest
from pyspark.sql import functions as F

from offerweave.functions import extract as ex
from offerweave.sources import readers as rd

NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:image="http://www.google.com/schemas/sitemap-image/1.1"'


def test_index_leads_to_product_addresses(spark):
    loc = lambda kind, *urls: "".join(f"<{kind}><loc> {u} </loc><image:image><image:loc>pic</image:loc></image:image></{kind}>" for u in urls)
    files = [
        ("i", f"<sitemapindex {NS}>{loc('sitemap', 'product-2', 'post-1', 'product-1')}</sitemapindex>"), ("product-1", f"<urlset {NS}>{loc('url', '/en/products/1', '/en/products/2')}</urlset>"),
        ("product-2", f"<urlset {NS}>{loc('url', '/en/products/2', '/el/products/2', '/en/products')}</urlset>"), ("post-1", f"<urlset {NS}>{loc('url', '/en/products/7')}</urlset>"),
    ]
    table = spark.createDataFrame(files, "path string, body string")
    urls = lambda *filters: [r.url for r in rd.sitemap_urls(rd.sub_sitemaps(table, "i", filters[0]), filters[1]).orderBy("ordinal", "pos").collect()]
    assert urls("product", r"/en/products/\d+$") == ["/en/products/2", "/en/products/1"]
    assert urls("", "") == ["/en/products/2", "/el/products/2", "/en/products", "/en/products/7", "/en/products/1"]
    assert rd.sitemap_urls(table.filter("path = 'i'").select(F.lit(0).alias("ordinal"), "body")).collect() == []
    with pytest.raises(Exception, match="no such sitemap"):
        rd.sub_sitemaps(table.filter("path <> 'product-1'"), "i").collect()


def test_ids_and_categories_of_addresses(spark):
    urls = ["https://s/en/products/196585", "https://s/en/about", "https://s/product/gaming/x/77/", "https://s/", "https://s/product/"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(ex.id_after_products(F.col("u")), ex.numeric_id(F.col("u")), ex.top_category(F.col("u"), "https://s")).collect()
    assert [tuple(r) for r in rows] == [("196585", "196585", "products"), ("about", None, "about"), ("", "77", "gaming"), ("", None, None), ("", None, None)]
