"""Paged listings that stop by themselves."""

from offerweave.sources import readers as rd


def test_each_listing_stops_by_itself(spark):
    pages = [("a", 1, ["a1"], "false", 9), ("a", 2, [], "false", 9), ("a", 3, ["a3"], "false", 9)]  # an empty page
    pages += [("b", p, [f"b{p}"], "True" if p == 4 else "false", 9) for p in range(1, 7)]  # a flag in text
    pages += [("c", p, [f"c{p}", "c0"], "false", 6) for p in range(1, 7)]  # a total
    pages += [("d", p, [f"d{p}"], "false", 9) for p in range(1, 9)]  # the cap
    pages += [("e", 1, ["e1"], None, 9), ("e", 2, ["e2"], None, 9), (None, 1, ["n1"], "false", None), (None, 2, ["n2"], "false", None)]
    frame = spark.createDataFrame([(s, p, [(i,) for i in ids], c, t) for s, p, ids, c, t in pages], "store string, page int, items array<struct<id string>>, complete string, total int")
    got = sorted(r.id for r in rd.pages_until_empty(frame, ["store"], 5).collect())
    assert got == sorted(["a1", *(f"b{p}" for p in range(1, 5)), "c0", "c1", "c2", "c3", *(f"d{p}" for p in range(1, 6)), "e1", "n1"])
    plain = frame.drop("complete", "total")
    assert {r.id[0] for r in rd.pages_until_empty(plain, ["store"]).collect()} == set("abcden") and rd.pages_until_empty(plain, ["store"]).filter("id = 'd8'").count() == 1
