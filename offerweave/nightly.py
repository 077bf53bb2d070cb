"""One night: gate, ingest, enrich, cluster, resolve, aftermath, commit.

    python -m offerweave.nightly --data DIR --state DIR --map CSV --stores s=expected ... [--write]

State is a folder of snapshots, each with all tables; the highest one that was finished is
current.  A run without ``--write`` is dry: it does everything but the commit.  Exit codes: 0
all stores passed the gate, 1 some did not and the others were written, 2 none did.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerweave.operators import catalog as ct
from offerweave.operators import ingest as ig
from offerweave.operators import resolve as rs
from offerweave.operators import tiers as tr
from offerweave.operators.enrich import enrich_once, number_offers
from offerweave.plans.scratch import materialize
from offerweave.sources import readers as rd
from offerweave.sources import state as st


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the last finished snapshot; None before the first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in fs.listStatus(path(root))) if fs.exists(path(root)) else []
    done = [n for n in names if n.startswith("v") and fs.exists(path(f"{root}/{n}/_DONE"))]
    return f"{root}/{done[-1]}" if done else None


def _commit(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> str:
    """Write the next snapshot; a run that stops before the mark leaves the last one current."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    last = current(spark, root)
    target = f"{root}/v{int(last.rsplit('/v', 1)[1]) + 1 if last else 1:08d}"
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(path(target), True)  # what a stopped run left
    ct.commit(tables, target)
    fs.create(path(f"{target}/_DONE")).close()
    return target


def _minted(rows: DataFrame, order: list[str], first: int, name: str) -> DataFrame:
    """``rows`` with a new ``name``, rising with ``order`` from ``first``."""
    if rows.isEmpty():
        return rows.withColumn(name, F.lit(None).cast("bigint"))
    held = rows.withColumn("component", F.struct(*order)).withColumnRenamed("product_id", "_product")
    return ct.new_ids(held, first).drop("component").withColumnRenamed("product_id", name).withColumnRenamed("_product", "product_id")


def _next(table: DataFrame, column: str = "id") -> int:
    return (table.agg(F.max(column)).first()[0] or 0) + 1


def _as(name: str, df: DataFrame) -> DataFrame:
    """The columns of a state table, cast to its types."""
    fields = df.sparkSession.createDataFrame([], st.STATE[name]).schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def _ingest(tables: dict[str, DataFrame], staging: DataFrame, passed: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new offers, new history rows, counters) from the rows of the stores that passed."""
    rows = rd.last_per_key(staging.join(passed.select("store"), "store", "left_semi"), ig.KEY)
    mapped = materialize(ig.with_category(rows, tables["category_map"]), "mapped")
    old = tables["store_products"]
    known = old.select(*ig.KEY, "id", "product_id", "match_method")
    changed = ig.upsert(old.select(*ig.KEY, *ig.FIELDS, "first_seen_at", "last_scraped_at", "last_changed_at"), mapped, as_of)
    changed = materialize(ig.mark_disappeared(changed, mapped, as_of, passed).join(known, ig.KEY, "left"), "changed")
    new = _minted(changed.filter("id is null").drop("id"), ig.KEY, _next(old), "id")
    state = materialize(changed.filter("id is not null").unionByName(new), "state")
    history = state.filter(F.col("change").isin("inserted", "changed", "disappeared")).select(F.col("id").alias("store_product_id"), F.col("current_price").alias("price"), "available", as_of.alias("recorded_at"))
    return state, history, ig.counters(mapped, state)


def _resolve(tables: dict[str, DataFrame], state: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """Products, links and what follows merges: the new tables, and ``decisions``."""
    offers = state.drop("product_id", "match_method", "change").withColumnRenamed("current_price", "price")
    offers = materialize(enrich_once(number_offers(offers.drop("id"))), "offers")
    clustered = materialize(tr.clusters_by_keys(offers), "clustered")
    contributed = materialize(rs.key_contributions(clustered), "contributed")
    keys = materialize(rs.match_keys(clustered, contributed), "keys")
    linked = state.filter("product_id is not null").select(*ig.KEY, "product_id")
    decisions = materialize(rs.resolve_identity(clustered, keys, linked, tables["products"]), "decisions")
    merged = materialize(rs.merge_collisions(clustered, decisions.select("component", "product_id")), "merged")
    minted = _minted(decisions.filter("resolution = 'new'").select("component").withColumn("c", F.col("component")).drop("component"), ["c"], _next(tables["products"]), "minted")
    ids = decisions.join(minted.withColumnRenamed("c", "component"), "component", "left").select("component", F.coalesce("product_id", "minted").alias("product_id"))
    ids = materialize(ids, "ids")
    facts = rs.representatives(merged).join(contributed.select("component", "match_method"), "component").join(keys.select("component", "match_key"), "component").join(decisions.select("component", "resolution"), "component")
    why = F.when(F.col("resolution") == "ambiguous_key", F.lit("ambiguous_key"))
    facts = facts.withColumn("review_reason", F.nullif(rs.add_reason(F.col("review_reason"), why), F.lit(""))).withColumn("needs_review", F.col("needs_review") | why.isNotNull())
    products = materialize(_as("products", facts.join(ids, "component").withColumn("id", F.col("product_id")).withColumn("updated_at", as_of)), "products")
    links = merged.join(ids, "component").join(contributed.select("component", "match_method"), "component").select(*ig.KEY, "product_id", "match_method")
    state = materialize(ct.link_offers(state, links), "linked")
    pairs = ct.final_pairs(ct.absorbed_pairs(decisions, state.filter("product_id is not null").select("product_id")))
    kept = tables["products"].join(products.select("id"), "id", "left_anti")
    old = tables["merged_products"]
    moved = ct.redirects(old, pairs).join(old.withColumnRenamed("new_id", "was"), "old_id", "left")
    return {
        "store_products": _as("store_products", state),
        "products": ct.delete_absorbed(kept.unionByName(products), pairs),
        "merged_products": _as("merged_products", moved.withColumn("merged_at", F.when(F.col("new_id").eqNullSafe(F.col("was")), F.col("merged_at")).otherwise(as_of))),
        "price_subscriptions": _as("price_subscriptions", ct.repoint_subscriptions(tables["price_subscriptions"], pairs)),
        "decisions": decisions,
    }


def run(spark: SparkSession, root: str, staging: DataFrame, mapping: DataFrame, expected: DataFrame, as_of: Column, exit_codes: DataFrame | None = None, write: bool = False) -> dict[str, DataFrame]:
    """One night over ``staging`` (rows of store files with ``ordinal``) and the state below ``root``.

    Stores that fail the gate are left out altogether: their offers are neither changed nor
    marked as gone.  ``mapping(store, raw_product_type, category)`` is added to the state's map.
    Returns ``gate``, ``counters``, ``decisions`` and the new tables; with ``write`` they are committed.
    """
    place = current(spark, root)
    tables = {name: st.read_table(spark, place, name) if place else spark.createDataFrame([], schema) for name, schema in st.STATE.items()}
    tables["category_map"] = materialize(ig.upsert_mapping(tables["category_map"], mapping.select("store", "raw_product_type", "category")), "map")
    gate = materialize(ig.sane_stores(staging.groupBy("store").agg(F.count("*").alias("count")), expected, exit_codes), "gate")
    passed = gate.filter("passed")
    if passed.isEmpty():
        return {"gate": gate}
    state, history, counters = _ingest(tables, staging, passed, as_of)
    done = _resolve(tables, state, as_of)
    new = {name: tables[name] for name in st.STATE} | {k: v for k, v in done.items() if k in st.STATE}
    new["price_history"] = _as("price_history", tables["price_history"].unionByName(history.withColumn("price", F.col("price").cast("decimal(18,4)"))))
    new["category_map"] = _as("category_map", tables["category_map"])
    if write:
        _commit(spark, root, new)
    return new | {"gate": gate, "counters": counters, "decisions": done["decisions"]}


def main(argv: list[str] | None = None) -> int:
    said = argparse.ArgumentParser(description=__doc__.split("\n", 1)[0])
    said.add_argument("--data", required=True, help="folder of <store>.json files")
    said.add_argument("--state", required=True, help="folder of snapshots")
    said.add_argument("--map", required=True, help="CSV of store, raw_product_type, product_count, canonical_category")
    said.add_argument("--stores", nargs="+", required=True, metavar="STORE=ROWS", help="stores and the rows they are expected to have")
    said.add_argument("--as-of", help="time of the run; now if absent")
    said.add_argument("--write", action="store_true", help="commit; without it the run is dry")
    args = said.parse_args(argv)
    spark = SparkSession.builder.appName("nightly").getOrCreate()
    stores = dict(x.partition("=")[::2] for x in args.stores)
    staging = materialize(rd.store_files(spark, [f"{args.data}/{s}.json" for s in stores]), "staging")
    raw = rd.read_category_csv(spark, args.map)
    allowed = tuple(r[0] for r in raw.select(F.trim("canonical_category")).distinct().collect() if r[0])
    expected = spark.createDataFrame([(s, int(n)) for s, n in stores.items()], "store string, expected int")
    as_of = (F.lit(args.as_of) if args.as_of else F.lit(str(spark.sql("select current_timestamp()").first()[0]))).cast("timestamp")
    done = run(spark, args.state, staging, rd.category_map(raw, allowed), expected, as_of, write=args.write)
    gate = done["gate"].orderBy("store").collect()
    for r in gate:
        print(f"{r['store']}: {r['count']} rows, {'passed' if r['passed'] else 'failed'}")
    if "counters" in done:
        for r in done["counters"].orderBy("store").collect():
            print(f"{r['store']}: {r['inserted']} inserted, {r['changed']} changed, {r['unchanged']} unchanged, {r['disappeared']} disappeared, {r['skipped']} skipped")
        for r in done["decisions"].groupBy("resolution").count().orderBy("resolution").collect():
            print(f"{r['resolution']}: {r['count']} products")
        print("committed" if args.write else "dry run, nothing written")
    bad = [r for r in gate if not r["passed"]]
    return 2 if len(bad) == len(gate) else 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
