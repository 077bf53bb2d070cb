"""Shared tables have a row for each part, and queries read texts only where they need them."""

import os

from pyspark.sql import functions as F

from offerweave.operators import tiers as tr
from offerweave.operators.enrich import number_each
from offerweave.plans import adapter as ad
from offerweave.plans import catalog_queries as cq

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_one_node_for_each_part(spark, monkeypatch):
    monkeypatch.setattr(ad, "_KEPT", {})
    real, nodes = ad.listing_components, []
    monkeypatch.setattr(ad, "listing_components", lambda rows: nodes.append(rows.count()) or real(rows))
    parts = ad._components(spark, SF)
    assert nodes == [parts.count()] == [parts.select("l_partkey").distinct().count()]


def test_clusters_are_counted_without_texts(spark, monkeypatch):
    def never(*_):
        raise AssertionError("the texts of parts were joined")

    monkeypatch.setattr(ad, "listed", never)
    for name in ("K3_largest_clusters", "A36_review_reasons", "J15_J16_O3_inner_edges", "G5_bridged_clusters", "G7_bridged_stores", "A31_method_shares", "A9_match_method"):
        cq.QUERIES[name](spark, SF).schema  # noqa: B018


def test_rows_for_both_listings(spark, tmp_path):
    # part, trusted, offer, category, brand, root, mpn, title, codes; offers 20 and 22 have a part number as their only key
    rows = [
        (1, True, 3, "tv", "LG", "r1", "m1", None, []), (1, False, 1, "tv", "LG", "r1", "m1", None, []), (2, True, 20, "tv", "LG", None, "m2", None, []), (2, False, 9, "tv", "LG", None, "m2", None, []),
        (3, True, 22, "tv", "LG", None, "m2", None, []), (4, False, 23, "tv", "LG", None, "m2", None, []), (5, True, 24, "tv", "LG", None, None, "t", ["abc12"]), (5, False, 30, "tv", "LG", None, None, "t", ["abc12"]),
        (6, False, 31, "tv", "LG", None, None, None, ["abc12"]), (7, True, 32, "tv", None, None, None, None, []), (7, False, 33, "tv", None, None, None, None, []),
    ]
    each = spark.createDataFrame(rows, "k int, reliable boolean, offer_idx bigint, category string, effective_brand string, mpn_root_key string, mpn_key string, title_key string, model_codes array<string>")
    each = each.withColumn("offers", F.lit(1).cast("bigint"))
    each.write.parquet(f"{tmp_path}/each")
    both = each.groupBy("k").agg(
        F.min("offer_idx").alias("offer_idx"), F.min(F.when(F.col("reliable"), F.col("offer_idx"))).alias("first_trusted"), F.bool_or("reliable").alias("reliable"), F.sum("offers").alias("offers"),
        *[F.first(c).alias(c) for c in tr.LOOKED_AT],
    )
    both.write.parquet(f"{tmp_path}/both")
    want = {(r.k, r.reliable): r.component for r in tr.listing_components(spark.read.parquet(f"{tmp_path}/each")).collect()}
    got = {r.k: r for r in tr.listing_components(spark.read.parquet(f"{tmp_path}/both")).collect()}
    assert want == {(k, t): None if got[k].apart and not t else got[k].component for k, t in want}
    assert want[2, True] == want[3, True] == 20 and want[2, False] is None and want[7, True] is None and want[6, False] == want[5, True] == 24


def test_groups_of_a_row_are_numbered_together(spark):
    sizes = {f"{p}": [p % 3, 0, p % 2 + 1] for p in range(40)}
    got = {r.p: r.firsts for r in number_each(spark.createDataFrame(list(sizes.items()), "p string, n array<int>"), ["p"], "n", 3).collect()}
    at = 0
    for place in range(3):
        for p in sorted(sizes):
            assert got[p][place] == at
            at += sizes[p][place]
