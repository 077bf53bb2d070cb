"""Offers that no tier can tell apart are clustered as one listing."""

import os

from offerweave.operators import reports as rp
from offerweave.operators import resolve as rs
from offerweave.operators import tiers as tr
from offerweave.operators.enrich import enrich_once
from offerweave.plans import adapter as ad
from tests.test_offers import offers

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ODD = (
    {"title": "abcd12 x", "mpn_root": "R"}, {"title": "abcd12 x", "mpn_root": "R"}, {"title": "other", "mpn_root": "R", "category": "d"}, {"title": "lone", "category": None},
    {"title": "lone", "category": None}, {"title": None, "vendor": None}, {"title": None, "vendor": None}, {"title": "m one", "mpn": "M1", "identifier_source": "sku"},
    {"title": "m two", "mpn": "M1", "identifier_source": "api"}, {"title": "m three", "mpn": "M1", "identifier_source": None}, {"title": "e one", "ean": "12345678"}, {"title": "e two", "ean": "12345678"},
    {"title": "efgh34 one", "category": None, "ean": "87654321", "mpn_root": "Q"}, {"title": "efgh34 two", "category": None, "ean": "87654321", "mpn_root": "Q"},
)


def plain(df, *columns):
    return sorted(str([str(r[c]) for c in columns]) for r in df.collect())


def same(spark, o, by_listing):
    edges = tr.tier_edges(o).cache()
    each = tr.clusters(o, edges).cache()
    assert plain(by_listing, "offer_idx", "component") == plain(each, "offer_idx", "component")
    codes = tr.chosen_codes(o).select("offer_idx", "code")
    assert plain(by_listing.filter("chosen_code is not null"), "offer_idx", "chosen_code") == plain(codes, "offer_idx", "code")
    wanted, got = rs.contributions(each, edges).cache(), rs.key_contributions(by_listing).cache()
    assert plain(got, "component", "size", "tiers", "match_method") == plain(wanted, "component", "size", "tiers", "match_method")
    columns = ("component", "match_key", "key_kind")
    assert plain(rs.match_keys(by_listing, got), *columns) == plain(rs.match_keys(each, wanted), *columns)
    before = tr.clusters(o, tr.star_edges(tr.mpn_root_keys(o)))
    columns = ("component", "parts", "singles", "clusters", "kind")
    assert plain(rp.grown_from(tr.first_tier(by_listing)), *columns) == plain(rp.grown(before, each), *columns)


def test_listings_cluster_as_their_offers_do(spark):
    o = offers(spark, *ODD).cache()
    same(spark, o, tr.clusters_by_keys(o).cache())


def test_each_part_is_enriched_once(spark):
    assert ad._parts(spark, SF).count() == ad.table(spark, SF, "part").count()
    same(spark, ad.offers(spark, SF), ad.clustered(spark, SF))


def test_equal_texts_are_enriched_once(spark):
    columns = ["store_product_id", "brand_norm", "brand_from_title", "is_suspicious_brand", "effective_brand", "title_norm", "title_key", "ean_key", "mpn_root_key", "mpn_key", "model_codes"]
    plainly = offers(spark, *ODD)
    given = plainly.select(*plainly.columns[: plainly.columns.index("brand_norm")])
    assert enrich_once(given).columns == plainly.columns and plain(enrich_once(given), *columns) == plain(plainly, *columns)


def test_empty(spark):
    assert tr.clusters_by_keys(offers(spark, *ODD).filter("offer_idx < 0")).collect() == []
