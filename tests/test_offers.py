import random

import pytest
from pyspark.sql import functions as F

from offerweave.operators import catalog as ct
from offerweave.operators import ingest as ig
from offerweave.operators import reports as rp
from offerweave.operators import resolve as rs
from offerweave.operators import tiers as tr
from offerweave.operators.components import connected_components
from offerweave.operators.enrich import enrich, number_offers
from offerweave.sources import readers as rd
from offerweave.sources import schema as sc

OFFER = "store string, store_product_id string, title string, vendor string, category string, mpn string, mpn_root string, ean string, identifier_source string, price double, available boolean, image_url string"


def offers(spark, *rows):
    base = {"store": "s", "store_product_id": "1", "title": "Thing", "vendor": "Acme", "category": "c", "mpn": None, "mpn_root": None, "ean": None, "identifier_source": "none", "price": 1.0, "available": True, "image_url": None}
    full = [tuple((base | {"store_product_id": f"p{i:03d}"} | r).values()) for i, r in enumerate(rows)]
    return enrich(number_offers(spark.createDataFrame(full, OFFER)))


def parts(df):
    return sorted(sorted(r.m) for r in df.groupBy("component").agg(F.collect_list("offer_idx").alias("m")).collect())


@pytest.mark.parametrize("seed", range(4))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    n = 60
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range((20, 45, 60, 0)[seed])] + [(100 + i, 101 + i) for i in range(40)]
    root = {i: i for e in edges for i in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    touched = {i for a, b in edges if a != b for i in (a, b)}
    assert got == {i: find(i) for i in touched}
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).collect() == []


def test_effective_brand_and_keys(spark):
    o = {r.store_product_id: r for r in offers(spark, {"vendor": None, "title": "iROBOT L121040 Roomba Combo 205", "mpn_root": "L121040"}, {"vendor": "PHLIPS", "mpn": "FC8243/09"}, {"vendor": "Philips", "mpn": "FC8243/09"}).collect()}
    assert "irobot" in o["p000"].mpn_root_key and o["p000"].title_key is None
    assert o["p001"].mpn_key == o["p002"].mpn_key


def test_tiers(spark):
    o = offers(spark, {"mpn_root": "A1"}, {"mpn_root": "A1", "title": "x"}, {"mpn_root": "A1", "title": "y"}, {"mpn": "M1", "title": "q", "identifier_source": "sku"}, {"mpn": "M1", "title": "w", "identifier_source": "api"}, {"mpn": "M1", "title": "e"}).cache()
    assert sorted((r.src, r.dst) for r in tr.star_edges(tr.mpn_root_keys(o)).collect()) == [(0, 1), (0, 2)]
    assert [(r.src, r.dst) for r in tr.star_edges(tr.mpn_keys(o)).collect()] == [(3, 4)]


def test_codes_do_not_chain(spark):
    o = offers(spark, {"title": "rare1 common1"}, {"title": "common1 common2"}, {"title": "common2 rare3"})
    assert tr.star_edges(tr.model_code_keys(o)).collect() == []
    same = offers(spark, {"title": "Foo abcd12"}, {"title": "Bar abcd12"}, {"title": "Bar abcd12", "category": "d"})
    assert tr.star_edges(tr.model_code_keys(same)).collect() == []  # two blocks
    assert [r.spread for r in tr.block_spread(same).collect()] == [2]


def test_ean_names_the_method_but_does_not_cluster(spark):
    o = offers(spark, {"title": "aa", "ean": "12345678"}, {"title": "bb", "ean": "12345678"}, {"title": "cc", "mpn_root": "R"}, {"title": "dd", "mpn_root": "R"})
    edges = tr.tier_edges(o).cache()
    c = tr.clusters(o, edges).cache()
    assert parts(c) == [[0], [1], [2, 3]]
    assert {r.component: r.match_method for r in rs.contributions(c, edges).collect()} == {0: "unmatched", 1: "unmatched", 2: "mpn_root"}


def test_keys_and_representatives(spark):
    o = offers(spark, {"title": "Τηλέφωνο", "mpn_root": "R", "price": 5.0, "image_url": ""}, {"title": "Phone", "mpn_root": "R", "price": None, "category": "d", "image_url": "i", "store": "t"})
    edges = tr.tier_edges(o).cache()
    c = tr.clusters(o, edges).cache()
    key = rs.match_keys(c, rs.contributions(c, edges)).first()
    assert (key.match_key, key.key_kind) == ("mpnroot|acme|r", "mpn_root")
    r = rs.representatives(c).first()
    assert (r.canonical_title, r.image_url, r.min_price, r.max_price, r.store_count, r.review_reason) == ("Phone", "i", 5.0, 5.0, 2, "cross-category: ['c', 'd']")
    assert {x.reason for x in tr.review_signals(c).collect()} == set()


def test_identity_and_aftermath(spark):
    c = spark.createDataFrame([(0, "s", "a"), (0, "s", "b"), (2, "s", "c"), (3, "s", "d"), (4, "s", "e")], "component bigint, store string, store_product_id string")
    keys = spark.createDataFrame([(0, "k0"), (2, "k2"), (3, "k3"), (4, "k4")], "component bigint, match_key string")
    linked = spark.createDataFrame([("s", "a", 7), ("s", "b", 3)], "store string, store_product_id string, product_id bigint")
    products = spark.createDataFrame([(9, "k2"), (10, "k3"), (11, "k3")], "id bigint, match_key string")
    got = rs.resolve_identity(c, keys, linked, products)
    assert {(r.component, r.resolution, r.product_id, tuple(r.absorbed)) for r in got.collect()} == {(0, "merged", 3, (7,)), (2, "key_lookup", 9, ()), (3, "ambiguous_key", 10, ()), (4, "new", None, ())}
    pairs = ct.absorbed_pairs(got, linked.filter("product_id = 3"))
    assert [tuple(r) for r in pairs.collect()] == [(3, 7)] and ct.absorbed_pairs(got, linked).collect() == []
    subs = spark.createDataFrame([("x", 7), ("y", 7), ("y", 3), ("z", 1)], "email string, product_id bigint")
    assert sorted(tuple(r) for r in ct.repoint_subscriptions(subs, pairs).collect()) == [("x", 3), ("y", 3), ("z", 1)]
    old = spark.createDataFrame([(5, 7), (6, 1)], "old_id bigint, new_id bigint")
    assert sorted(tuple(r) for r in ct.redirects(old, pairs).collect()) == [(5, 3), (6, 1), (7, 3)]
    assert [r.product_id for r in ct.new_ids(got.filter("resolution = 'new'").select("component"), 100).collect()] == [100]
    merged = rs.merge_collisions(c, spark.createDataFrame([(0, 5), (2, 5), (3, None), (4, None)], "component bigint, product_id bigint"))
    assert {(r.component, r.store_product_id) for r in merged.collect()} == {(0, "a"), (0, "b"), (0, "c"), (3, "d"), (4, "e")}


def test_ingest_traps(spark):
    stage = "store string, store_product_id string, title string, vendor string, product_type string, sku string, mpn string, mpn_root string, ean string, identifier_source string, price double, available boolean, image_url string, product_url string"
    row = lambda i, t, p, a: ("s", i, "t" + str(p), "v", t, None, None, None, None, "none", p, a, None, "u")
    mapping = spark.createDataFrame([("s", "T", "c"), ("s", "spaced ", "c")], "store string, raw_product_type string, category string")
    first = ig.with_category(spark.createDataFrame([row("1", "T", 1.0, True), row("2", "T", 2.0, True), row("3", "T", 3.0, False), row("4", "spaced", 1.0, True)], stage), mapping)
    assert {r.store_product_id: r.category for r in first.collect()}["4"] is None
    t1, t2 = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    empty = ig.upsert(first.limit(0).select(*ig.KEY, *[F.lit(None).cast("double" if c == "current_price" else "boolean" if c == "available" else "string").alias(c) for c in ig.FIELDS], t1.alias("first_seen_at"), t1.alias("last_scraped_at"), t1.alias("last_changed_at")), first, t1).cache()
    assert {r.change for r in empty.collect()} == {"inserted"} and empty.count() == 3
    second = ig.with_category(spark.createDataFrame([row("1", "T", 1.0, True), row("2", "X", 9.0, True)], stage), mapping)
    after = ig.mark_disappeared(ig.upsert(empty.drop("change"), second, t2), second, t2, second).cache()
    got = {r.store_product_id: r for r in after.collect()}
    assert {k: v.change for k, v in got.items()} == {"1": "unchanged", "2": "untouched", "3": "untouched"}  # 2 was seen, though without a category
    gone = ig.mark_disappeared(ig.upsert(empty.drop("change"), second.filter("store_product_id = '1'"), t2), second.filter("store_product_id = '1'"), t2, second)
    one = {r.store_product_id: r for r in gone.collect()}["2"]
    assert (one.change, one.available) == ("disappeared", False) and one.last_scraped_at < one.last_changed_at
    assert ig.history(gone, t2).count() == 1


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"store":"s","store_product_id":"1","price":1.5,"title":"x"},{"store":"s","store_product_id":"1","title":"y","available":true}]')
    rows = rd.store_files(spark, [str(tmp_path / "a.json"), str(tmp_path / "none.json")])
    last = rd.last_per_key(rows, ["store", "store_product_id"]).collect()
    assert rows.count() == 2 and [r.title for r in last] == ["y"]
    assert rd.store_files(spark, [str(tmp_path / "none.json")]).count() == 0
    csv = spark.createDataFrame([("s ", "a", "c", 0), ("s", "a ", "d", 1), ("s", "b", " ", 2)], "store string, raw_product_type string, canonical_category string, ordinal bigint")
    assert [tuple(r) for r in rd.category_map(csv, ("c", "d")).collect()] == [("s", "a", "d")]
    with pytest.raises(Exception, match="unknown category"):
        rd.category_map(csv, ("c",)).collect()
    with pytest.raises(Exception, match="not allowed"):
        sc.require(csv, "store", ("x",)).collect()
    bodies = spark.createDataFrame([(0, '<urlset xmlns="http://x"><url><loc> u1 </loc></url><url><loc>u2</loc></url></urlset>'), (1, "<urlset><url><loc>u1</loc></url></urlset>")], "ordinal int, body string")
    assert [(r.url, r.pos) for r in rd.sitemap_urls(bodies).orderBy("ordinal", "pos").collect()] == [("u1", 0), ("u2", 1)]
    import gzip

    files = spark.createDataFrame([("a", bytearray(gzip.compress(b"x"))), ("b", bytearray(b"y"))], "path string, content binary")
    assert {r.path: r.body for r in rd.maybe_gzip(files).collect()} == {"a": "x", "b": "y"}
    pages = spark.createDataFrame([(1, [{"id": 1}, {"id": 2}]), (2, [{"id": 2}]), (3, []), (4, [{"id": 5}])], "page int, items array<struct<id:int>>")
    assert sorted(r.id for r in rd.pages_until_empty(pages).collect()) == [1, 2]
    tree = spark.createDataFrame([("r", None, "0"), ("a", "r", "1"), ("b", "a", "2"), ("c", "r", "1")], "id string, parent string, level string")
    assert sorted(r.id for r in rd.leaf_categories(tree, 4).collect()) == ["b", "c"]
    lines = rd.copy_text(spark.createDataFrame([("a\tb\\", None, True)], "x string, y string, z boolean"), ["x", "y", "z"]).first().line
    assert lines == "a\\tb\\\\\t\\N\tt"


def test_reports(spark):
    o = offers(spark, {"title": "gadget zz9000"}, {"title": "770nc thing", "store": "t"}, {"title": "zz9000 again", "store": "t"}).cache()
    cover = {r.store: r for r in rp.coverage(o).collect()}
    assert cover["TOTAL"].offers == 3 and cover["t"].model_codes == 2
    assert {(r.code, r.kind) for r in rp.blocked_codes(o).collect()} == {("770nc", "suffix")}
    assert [r.code for r in rp.store_bridges(o, "s", "t").collect()] == ["zz9000"]
    before = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (3, 3), (4, 4), (5, 4)], "offer_idx bigint, component bigint")
    after = spark.createDataFrame([(0, 0), (1, 0), (2, 0), (3, 3), (4, 4), (5, 4)], "offer_idx bigint, component bigint")
    assert [(r.component, r.kind) for r in rp.grown(before, after).collect()] == [(0, "grew")]


def test_stream_keeps_snapshots(spark, tmp_path):
    from offerweave.streaming.changes import upsert_stream, windowed_changes

    cols = "store string, store_product_id string, title string, vendor string, product_type string, category string, sku string, mpn string, mpn_root string, ean string, identifier_source string, price double, available boolean, image_url string, product_url string"
    spark.createDataFrame([("s", "1", "t", "v", "T", "c", None, None, None, None, "none", 1.0, True, None, "u")], cols).write.parquet(str(tmp_path / "in"))
    none = spark.createDataFrame([], cols.replace("price double", "current_price double") + ", first_seen_at timestamp, last_scraped_at timestamp, last_changed_at timestamp")
    stream = spark.readStream.schema(cols).parquet(str(tmp_path / "in"))
    q = upsert_stream(stream, none, str(tmp_path / "out")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out/state-0")).first().change == "inserted"
    assert spark.read.parquet(str(tmp_path / "out/history")).count() == 1
    events = spark.createDataFrame([(1, "2024-01-01 00:10:00", "a", 1.0), (2, "2024-01-01 00:20:00", "a", 2.0)], "id int, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    assert [(r.n, r.total) for r in windowed_changes(events).collect()] == [(2, 3.0)]
