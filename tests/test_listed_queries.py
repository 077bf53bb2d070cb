"""Queries on clusters read a row for each listing, never one for each offer."""

import os
import random

import pytest

from offerweave.operators import catalog as ct
from offerweave.operators import reports as rp
from offerweave.operators import resolve as rs
from offerweave.operators import tiers as tr
from offerweave.operators.components import connected_components
from offerweave.operators.enrich import number_groups
from offerweave.plans import adapter as ad
from offerweave.plans import catalog_queries as cq
from offerweave.plans import rule_queries as rq  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FINDINGS = {
    "F2": "A29_cluster_sizes", "F3": "A33_language_clusters", "F4": "A36_review_reasons", "F5": "J15_J16_O3_inner_edges", "F6": "K3_largest_clusters", "F7": "K6_stratified_clusters",
    "F8": "U5_J8_J9_identity", "F9": "U6_W5_collision_merge", "F10": "U8_J13_subscriptions", "F14": "A13_W4_representatives", "F15": "A31_method_shares", "F16": "G4_resolved_products",
    "F17": "G5_bridged_clusters", "F18": "A9_match_method", "F19": "G6_redirects", "F20": "J11_link_offers", "F21": "G7_bridged_stores", "F22": "K6_cross_brand_clusters",
}


KEPT: dict = {}


def rows(df, *columns):
    return sorted(str([str(r[c]) for c in columns or sorted(df.columns)]) for r in df.collect())


@pytest.mark.parametrize("finding", FINDINGS)
def test_offers_are_not_enriched_one_by_one(spark, monkeypatch, finding):
    def never(*_):
        raise AssertionError("a row for each offer was enriched, numbered or clustered")

    for name in ("_numbered", "offers", "clustered"):
        monkeypatch.setattr(ad, name, never)
    monkeypatch.setattr(ad, "_KEPT", KEPT)
    # the plan is made and its shared tables are written; that the rows are right is for tests/test_queries.py
    cq.QUERIES[FINDINGS[finding]](spark, SF).schema  # noqa: B018


def test_places_give_the_numbers_of_all_offers(spark):
    columns = ("offer_idx", "store", "store_product_id", "component")
    assert rows(ad.assigned(spark, SF), *columns) == rows(ad.clustered(spark, SF), *columns)


def test_suppliers_below_zero_and_missing(spark, tmp_path):
    parts = ad.table(spark, SF, "part").limit(12)
    parts.write.parquet(f"{tmp_path}/part.parquet")
    keys = [r.p_partkey for r in parts.collect()]
    lines = [(1, k, s, 1) for k in keys for s in (None, -13, -12, -7, -1, 0, 1, 5, 10, 100, 7)]
    made = spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int")
    made.selectExpr("*", "1.0d as l_extendedprice", "'O' as l_linestatus", "timestamp_ntz'1999-01-01 00:00:00' as l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    columns = ("offer_idx", "store", "store_product_id", "component")
    assert rows(ad.assigned(spark, str(tmp_path)), *columns) == rows(ad.clustered(spark, str(tmp_path)), *columns)
    listed, each = ad.listed(spark, str(tmp_path)), ad.clustered(spark, str(tmp_path))
    assert rows(rp.cluster_sizes(listed)) == rows(rp.cluster_sizes(each))
    assert rows(rs.representatives(ad.priced(spark, str(tmp_path)))) == rows(rs.representatives(each))


def test_listings_count_for_their_offers(spark):
    listed, each = ad.listed(spark, SF), ad.clustered(spark, SF)
    assert listed.count() < each.count()
    for report in (rp.cluster_sizes, rp.cluster_facts, rp.languages, rs.key_contributions, rs.categories, tr.review_signals):
        assert rows(report(listed)) == rows(report(each))
    assert rows(rp.grown_from(tr.first_tier(listed))) == rows(rp.grown_from(tr.first_tier(each)))
    assert rows(rs.representatives(ad.priced(spark, SF))) == rows(rs.representatives(each))


def test_groups_are_numbered_in_order(spark):
    groups = [(s, f"{p:03d}", random.Random(s * 100 + p).randint(1, 9)) for s in range(5) for p in range(60)]
    got = {(r.s, r.p): r.first for r in number_groups(spark.createDataFrame(groups, "s int, p string, n bigint"), ["s", "p"], "n").collect()}
    at = 0
    for s, p, n in sorted(groups):
        assert got[s, p] == at
        at += n


def test_one_task_contracts_as_rounds_do(spark):
    rng = random.Random(7)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1030)] + [(2**40, 5), (3, 3), (None, 4)]
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    assert rows(connected_components(df, in_one_task=10_000)) == rows(connected_components(df))
    assert connected_components(df.limit(0), in_one_task=100).collect() == []


def test_links_by_component(spark):
    state = spark.createDataFrame([("a", "1", 7, -1, "unmatched"), ("a", "2", 8, -1, "unmatched")], "store string, store_product_id string, component bigint, product_id bigint, match_method string")
    links = spark.createDataFrame([(7, 3, "linked")], "component bigint, product_id bigint, match_method string")
    assert rows(ct.link_offers(state, links, by=("component",)), "store_product_id", "product_id", "match_method") == ["['1', '3', 'linked']", "['2', '-1', 'unmatched']"]
