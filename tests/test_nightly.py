"""Whole nights, over snapshots of state."""

import json

import pytest
from pyspark.sql import functions as F

from offerweave import nightly
from offerweave.operators import catalog as ct
from offerweave.sources import state as st


def row(store, i, title, price=10.0, kind="Phones", **more):
    return {"store": store, "store_product_id": i, "title": title, "vendor": "Sony", "product_type": kind, "sku": None, "price": price, "available": True, "image_url": None, "product_url": "u", "mpn": None, "mpn_root": None, "ean": None, "identifier_source": "none"} | more


@pytest.fixture
def night(spark, tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "map.csv").write_text("store,raw_product_type,product_count,canonical_category\na,Phones,2,phones\nb,Phones,2,phones\n")

    def go(a, b, day, *flags):
        for name, rows in (("a", a), ("b", b)):
            if rows is not None:
                (tmp_path / f"data/{name}.json").write_text(json.dumps(rows))
        return nightly.main(["--data", str(tmp_path / "data"), "--state", str(tmp_path / "state"), "--map", str(tmp_path / "map.csv"), "--stores", "a=4", "b=2", "--as-of", f"2024-01-0{day}", *flags])

    def table(name):
        return st.read_table(spark, nightly.current(spark, str(tmp_path / "state")), name).collect()

    go.table, go.root = table, str(tmp_path / "state")
    return go


def test_nights(spark, night):
    a = [row("a", "1", "Sony xyz100", mpn_root="R1"), row("a", "2", "Sony thing two"), row("a", "3", "Cable", kind="Unmapped")]
    b = [row("b", "1", "Sony xyz100 black", 11.0, mpn_root="R1"), row("b", "2", "Sony thing other")]
    assert night(a, b, 1) == 0 and nightly.current(spark, night.root) is None  # dry
    assert night(a, b, 1, "--write") == 0
    offers = {(r.store, r.store_product_id): r for r in night.table("store_products")}
    assert set(offers) == {("a", "1"), ("a", "2"), ("b", "1"), ("b", "2")} and sorted(r.id for r in offers.values()) == [1, 2, 3, 4]
    assert offers["a", "1"].product_id == offers["b", "1"].product_id != offers["a", "2"].product_id
    one = next(r for r in night.table("products") if r.id == offers["a", "1"].product_id)
    assert (one.offer_count, one.store_count, one.match_method, float(one.min_price), float(one.max_price)) == (2, 2, "mpn_root", 10.0, 11.0)
    assert len(night.table("price_history")) == 4
    # a price changes, one offer goes, store b fails the gate and stays as it was
    assert night([row("a", "1", "Sony xyz100", 9.0, mpn_root="R1"), row("a", "9", "Sony newcomer")], [row("b", "1", "x")][:0], 2, "--write") == 1
    after = {(r.store, r.store_product_id): r for r in night.table("store_products")}
    assert (float(after["a", "1"].current_price), after["a", "2"].available, after["b", "1"].available) == (9.0, False, True)
    assert after["a", "9"].id == 5 and after["a", "1"].product_id == offers["a", "1"].product_id and after["a", "9"].product_id not in {r.product_id for r in offers.values()}
    assert len(night.table("price_history")) == 7
    # what the two others have in common merges their products
    same = {"ean": None, "mpn_root": "R7"}
    assert night([row("a", "1", "Sony xyz100", 9.0, mpn_root="R1"), row("a", "9", "Sony newcomer", **same)], [row("b", "1", "Sony xyz100 black", 11.0, mpn_root="R1"), row("b", "2", "Sony thing other", **same)], 3, "--write") == 0
    last = {(r.store, r.store_product_id): r for r in night.table("store_products")}
    old, gone = sorted((after["b", "2"].product_id, after["a", "9"].product_id))
    assert last["a", "9"].product_id == last["b", "2"].product_id == old
    assert [(r.old_id, r.new_id) for r in night.table("merged_products")] == [(gone, old)] and gone not in {r.id for r in night.table("products")}
    before = nightly.current(spark, night.root)
    assert night([], [], 4, "--write") == 2 and nightly.current(spark, night.root) == before


def test_chains_end_at_the_last_survivor(spark):
    pairs = spark.createDataFrame([(2, 3), (1, 2), (3, 4), (7, 8)], "survivor bigint, absorbed bigint")
    old = spark.createDataFrame([(9, 4), (5, 8), (6, 1)], "old_id bigint, new_id bigint")
    assert sorted(tuple(r) for r in ct.redirects(old, pairs).collect()) == [(2, 1), (3, 1), (4, 1), (5, 7), (6, 1), (8, 7), (9, 1)]
    for ring in ([(1, 2), (2, 1)], [(1, 2), (2, 3), (3, 1)], [(1, 1)]):
        with pytest.raises(ValueError, match="itself"):
            ct.final_pairs(spark.createDataFrame(ring, "survivor bigint, absorbed bigint"))
    assert ct.final_pairs(pairs.filter(F.lit(False))).collect() == []
