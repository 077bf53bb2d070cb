"""Snapshots of store offers: category mapping, upsert with change capture, disappeared offers.

State tables are Parquet snapshots; every function returns the new state or the rows to
append, and only a caller that writes them commits.  ``as_of`` is the one time of a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerweave.plans.scratch import broadcast_if_small, materialize

KEY = ["store", "store_product_id"]
FIELDS = ["title", "vendor", "product_type", "category", "sku", "mpn", "mpn_root", "ean", "identifier_source", "current_price", "available", "image_url", "product_url"]
BROADCAST_STORES = 10_000


def with_category(staging: DataFrame, mapping: DataFrame) -> DataFrame:
    """Left join on (store, product type), exact and untrimmed."""
    m = mapping.select("store", F.col("raw_product_type").alias("product_type"), "category")
    return staging.drop("category").join(m, ["store", "product_type"], "left")


def unmapped(staging: DataFrame, mapping: DataFrame) -> DataFrame:
    """Distinct trimmed (store, product type) pairs without a mapping."""
    pairs = staging.select("store", F.trim("product_type").alias("product_type")).filter("product_type <> ''").distinct()
    return pairs.join(mapping.select("store", F.trim("raw_product_type").alias("product_type")), ["store", "product_type"], "left_anti")


def upsert_mapping(existing: DataFrame, new: DataFrame) -> DataFrame:
    key = ["store", "raw_product_type"]
    return existing.join(new.select(*key), key, "left_anti").unionByName(new)


def _changed(old: Column, new: Column) -> Column:
    return ~old.eqNullSafe(new)


def upsert(state: DataFrame, staging: DataFrame, as_of: Column) -> DataFrame:
    """The new state, with ``change``: inserted, changed, unchanged or untouched.

    A change is a different price or availability; first_seen_at stays, last_scraped_at moves
    for scraped rows, last_changed_at for inserted and changed ones.
    """
    new = staging.filter("category is not null").select(*KEY, *[F.col("price" if c == "current_price" else c).alias(f"n_{c}") for c in FIELDS], F.lit(True).alias("n_here"))
    both = state.withColumn("o_here", F.lit(True)).join(new, KEY, "full")
    here, old = F.coalesce("n_here", F.lit(False)), F.coalesce("o_here", F.lit(False))
    differs = _changed(F.col("current_price"), F.col("n_current_price")) | _changed(F.col("available"), F.col("n_available"))
    change = F.when(~here, "untouched").when(~old, "inserted").when(differs, "changed").otherwise("unchanged")
    return both.withColumn("change", change).select(
        *KEY, *[F.when(here, F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) for c in FIELDS],
        F.when(F.col("change") == "inserted", as_of).otherwise(F.col("first_seen_at")).alias("first_seen_at"),
        F.when(here, as_of).otherwise(F.col("last_scraped_at")).alias("last_scraped_at"),
        F.when(F.col("change").isin("inserted", "changed"), as_of).otherwise(F.col("last_changed_at")).alias("last_changed_at"), "change",
    )


def mark_disappeared(state: DataFrame, scraped: DataFrame, as_of: Column, stores: DataFrame) -> DataFrame:
    """Available offers of ``stores`` that were not scraped become unavailable; ``change`` says so.

    ``scraped`` are the ids before uncategorised rows go; its keys must not be null.
    """
    seen = scraped.select(*KEY).distinct().withColumn("seen", F.lit(True))
    judged = broadcast_if_small(materialize(stores.select("store").distinct().withColumn("judged", F.lit(True)), "judged-stores"), BROADCAST_STORES)
    gone = F.col("available") & F.col("judged").isNotNull() & F.col("seen").isNull()
    out = state.join(seen, KEY, "left").join(judged, "store", "left").withColumn("gone", F.coalesce(gone, F.lit(False)))
    return (
        out.withColumn("available", F.when(F.col("gone"), F.lit(False)).otherwise(F.col("available")))
        .withColumn("last_changed_at", F.when(F.col("gone"), as_of).otherwise(F.col("last_changed_at")))
        .withColumn("change", F.when(F.col("gone"), "disappeared").otherwise(F.col("change"))).drop("gone", "seen", "judged")
    )


def history(state: DataFrame, as_of: Column) -> DataFrame:
    """Price-history rows of what was inserted, changed or disappeared."""
    rows = state.filter(F.col("change").isin("inserted", "changed", "disappeared"))
    return rows.select(*KEY, F.col("current_price").alias("price"), "available", as_of.alias("recorded_at"))


def counters(staging: DataFrame, state: DataFrame) -> DataFrame:
    """How many rows were inserted, changed, unchanged, disappeared and skipped, per store."""
    done = state.groupBy("store").agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("inserted", "changed", "unchanged", "disappeared")])
    skipped = staging.groupBy("store").agg(F.count_if(F.col("category").isNull()).alias("skipped"))
    return done.join(skipped, "store", "left").withColumn("skipped", F.coalesce("skipped", F.lit(0)))


def sane_stores(counts: DataFrame, expected: DataFrame, exit_codes: DataFrame | None = None) -> DataFrame:
    """Stores whose file holds at least half of the expected rows.

    With ``exit_codes(store, code)`` only those count whose code is 0; others have no rows.
    """
    joined = expected.join(counts, "store", "left")
    ran = F.lit(True)
    if exit_codes is not None:
        joined = joined.join(exit_codes.select("store", "code"), "store", "left")
        ran = F.coalesce(F.col("code") == 0, F.lit(False))
    joined = joined.withColumn("count", F.when(ran, F.coalesce("count", F.lit(0))).otherwise(0))
    return joined.withColumn("passed", ran & (F.col("count") >= F.floor(F.col("expected") / 2))).drop("code")


def phase_two(rows: DataFrame, candidates: DataFrame, mapped: DataFrame, statuses: DataFrame, most: int) -> DataFrame:
    """Rows whose availability a second look settled.

    Only candidate ids of mapped product types are looked at, the first ``most`` by id;
    ``statuses(store_product_id, status_available)`` holds the looks that worked, others change nothing.
    """
    asked = rows.join(candidates.select("store_product_id").distinct(), "store_product_id", "left_semi").join(mapped.select("product_type").distinct(), "product_type", "left_semi")
    asked = asked.select("store_product_id").distinct().orderBy("store_product_id").limit(most)
    settled = statuses.join(asked, "store_product_id", "left_semi").select("store_product_id", "status_available")
    return rows.join(settled, "store_product_id", "left").withColumn("available", F.coalesce("status_available", "available")).drop("status_available")
