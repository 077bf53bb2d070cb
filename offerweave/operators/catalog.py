"""The product catalog: new ids, links, and what follows a merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerweave.plans.scratch import materialize


def new_ids(new: DataFrame, first: int) -> DataFrame:
    """``product_id`` for new components, rising with the component from ``first``."""
    held = materialize(new.repartitionByRange("component").withColumn("_part", F.spark_partition_id()), "new-products")
    sizes = held.groupBy("_part").agg(F.count("*").alias("_c"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = F.broadcast(sizes.select("_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_s")))
    n = F.row_number().over(Window.partitionBy("_part").orderBy("component"))
    return held.withColumn("_n", n).join(shifts, "_part").withColumn("product_id", (F.lit(first - 1) + F.col("_n") + F.col("_s")).cast("bigint")).drop("_part", "_n", "_s")


def link_offers(state: DataFrame, links: DataFrame, by: tuple[str, ...] = ("store", "store_product_id")) -> DataFrame:
    """State rows with the product and method of ``links(store, store_product_id, product_id, match_method)``, or of links by what else ``by`` names."""
    new = links.select(*by, F.col("product_id").alias("n_pid"), F.col("match_method").alias("n_method"))
    joined = state.join(new, list(by), "left")
    return joined.withColumn("product_id", F.coalesce("n_pid", "product_id")).withColumn("match_method", F.coalesce("n_method", "match_method")).drop("n_pid", "n_method")


def absorbed_pairs(decisions: DataFrame, linked: DataFrame) -> DataFrame:
    """``(survivor, absorbed)`` of merges; products that offers still point at stay alive."""
    pairs = decisions.filter("resolution = 'merged'").select(F.col("product_id").alias("survivor"), F.explode("absorbed").alias("absorbed"))
    return pairs.join(linked.select(F.col("product_id").alias("absorbed")).distinct(), "absorbed", "left_anti").select("survivor", "absorbed")


def repoint_subscriptions(subs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Subscriptions of absorbed products move to the survivor, one per email; the others go with the product."""
    moved = subs.join(pairs, subs["product_id"] == pairs["absorbed"])
    first = moved.groupBy("email", "survivor").agg(F.min("absorbed").alias("from"))
    have = subs.select("email", F.col("product_id").alias("survivor"))
    fresh = first.join(have, ["email", "survivor"], "left_anti").select("email", F.col("survivor").alias("product_id"))
    return subs.join(pairs.select(F.col("absorbed").alias("product_id")), "product_id", "left_anti").select("email", "product_id").unionByName(fresh)


def final_pairs(pairs: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(survivor, absorbed)`` where no survivor is itself absorbed: chains within a batch end at their last survivor.

    Each round doubles the hops that a pair spans.  A cycle is an error.
    """
    current = materialize(pairs.select("survivor", "absorbed").distinct(), "merges")
    for _ in range(max_rounds):
        hop = current.select(F.col("absorbed").alias("survivor"), F.col("survivor").alias("to"))
        longer = materialize(current.join(hop, "survivor", "left"), "merges")
        if longer.filter("to is not null").isEmpty():
            return current
        if not longer.filter("to = absorbed or survivor = absorbed").isEmpty():
            break
        current = longer.select(F.coalesce("to", "survivor").alias("survivor"), "absorbed")
    raise ValueError("a product is merged into itself")


def redirects(existing: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(old_id, new_id)`` with the new pairs; every chain, within the batch as well, is one hop long."""
    last = final_pairs(pairs)
    new = last.select(F.col("absorbed").alias("old_id"), F.col("survivor").alias("new_id"))
    kept = existing.select("old_id", "new_id").join(new.select("old_id"), "old_id", "left_anti")
    hop = last.select(F.col("absorbed").alias("new_id"), F.col("survivor").alias("to"))
    shorter = kept.join(hop, "new_id", "left").select("old_id", F.coalesce("to", "new_id").alias("new_id"))
    return shorter.unionByName(new)


def delete_absorbed(products: DataFrame, pairs: DataFrame) -> DataFrame:
    return products.join(pairs.select(F.col("absorbed").alias("id")), "id", "left_anti")


def store_counts(products: DataFrame, state: DataFrame) -> DataFrame:
    """Products whose store_count differs from the distinct stores of their offers, with the right one."""
    counted = state.filter("product_id is not null").groupBy(F.col("product_id").alias("id")).agg(F.count_distinct("store").alias("counted"))
    return products.join(counted, "id").filter(~F.col("store_count").eqNullSafe(F.col("counted"))).select("id", F.col("counted").alias("store_count"))


def commit(tables: dict[str, DataFrame], root: str) -> None:
    """Write each table as a new snapshot below ``root``; nothing is overwritten in place."""
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/{name}")
