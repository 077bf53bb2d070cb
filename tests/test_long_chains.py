"""Clusters are whole however long their chains are; the SQL beside the queries lowers labels eight times and stops."""

import duckdb
import pytest

from offerweave.plans import adapter as ad
from offerweave.plans import catalog_queries as cq
from offerweave.plans import rule_queries as rq  # noqa: F401

#: Pairs of parts with one root part number each; the second of a pair has the title and category of the next pair's first.
PAIRS = 20
#: What the one cluster of 40 parts and 80 offers gives.  112-0 is the first offer by text, so its number is 0.
FINDINGS = {
    "F1": ("A10_A11_common_brand", ["component", "brand"], [(0, "apple")]),
    "F2": ("A29_cluster_sizes", ["component", "size", "stores", "categories"], [(0, 80, 2, 2)]),
    "F3": ("A36_review_reasons", ["reason", "n"], [("cross-category", 1)]),
    "F4": ("G5_bridged_clusters", ["component", "parts", "singles", "clusters", "kind"], [(0, 20, 0, 20, "bridged")]),
    "F5": ("K3_largest_clusters", ["component", "size"], [(0, 80)]),
    "F6": ("J15_J16_O3_inner_edges", ["component", "edges"], [(0, 60)]),
    "F7": ("A33_language_clusters", ["component", "langs", "stores"], [(0, "EN", 2)]),
}


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("chain"))
    types, parts = ("STANDARD", "SMALL"), []
    for i in range(PAIRS):
        first = 16 + 24 * i  # vendor APPLE, code 770nc
        parts += [(first, types[i % 2], i + 1), (first + 3000, types[(i + 1) % 2], i + 2)]
    made = spark.createDataFrame(parts, "p_partkey bigint, p_type string, p_size int").selectExpr("*", "'cold plate' as p_name", "'Brand#1' as p_brand")
    made.write.parquet(f"{d}/part.parquet")
    lines = spark.createDataFrame([(1, k, s, 1) for k, *_ in parts for s in (0, 2)], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int")
    lines.selectExpr("*", "1.0d as l_extendedprice", "'O' as l_linestatus", "timestamp_ntz'1999-01-01 00:00:00' as l_shipdate").write.parquet(f"{d}/lineitem.parquet")
    return d


@pytest.fixture(scope="module")
def duck(chain):
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"create view {t} as select * from '{chain}/{t}.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("finding", FINDINGS)
def test_a_long_chain_is_one_cluster(spark, chain, duck, finding):
    name, columns, expected = FINDINGS[finding]
    got = [tuple(r) for r in cq.QUERIES[name](spark, chain).select(columns).collect()]
    assert got == expected
    sql, rounds = cq.ORACLES[name], ad._sql_rounds()
    assert sql.count(rounds) == 1
    in_order = lambda text: duck.execute(f"select {', '.join(columns)} from ({text})").fetchall()
    # with rounds enough for the chain the same SQL gives the same rows; with its own eight it splits the cluster
    assert in_order(sql.replace(rounds, ad._sql_rounds(2 * PAIRS))) == expected
    assert in_order(sql) != expected
