"""State tables: their columns, creation that can be repeated, and checks.

Tables are Parquet folders below one root.  A column that an older snapshot lacks is not
written into it: reading supplies its default, so nothing is rewritten when columns are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerweave.sources.readers import exists
from offerweave.sources.schema import STAGING

_OFFER = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STAGING if f.name not in ("price", "scraped_at"))

#: Table -> columns, as a schema string.
STATE = {
    "category_map": "store string, raw_product_type string, category string",
    "store_products": f"id bigint, {_OFFER}, current_price decimal(18,4), category string, first_seen_at timestamp, last_scraped_at timestamp, last_changed_at timestamp, product_id bigint, match_method string",
    "price_history": "store_product_id bigint, price decimal(18,4), available boolean, recorded_at timestamp",
    "products": "id bigint, category string, brand string, canonical_title string, normalized_title string, ean string, mpn_root string, mpn string, image_url string, match_method string, match_key string, "
    "offer_count int, store_count int, min_price decimal(18,4), max_price decimal(18,4), has_available_offer boolean, needs_review boolean, review_reason string, updated_at timestamp",
    "merged_products": "old_id bigint, new_id bigint, merged_at timestamp",
    "price_subscriptions": "email string, product_id bigint",
    "raw_products": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STAGING),
}

#: (table, column) -> value where a row has none.
DEFAULTS = {
    ("store_products", "match_method"): "unmatched",
    ("products", "match_method"): "unmatched",
    ("products", "needs_review"): False,
    ("products", "store_count"): 0,
}


def ensure_tables(spark: SparkSession, root: str, dry_run: bool = False) -> list[str]:
    """Create the tables that are missing below ``root``, empty; returns their names."""
    missing = [name for name in STATE if not exists(spark, f"{root}/{name}")]
    for name in [] if dry_run else missing:
        spark.createDataFrame([], STATE[name]).write.parquet(f"{root}/{name}")
    return missing


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table with all of its columns; missing ones and nulls take their defaults."""
    df = spark.read.schema(STATE[name]).parquet(f"{root}/{name}")
    filled = {column: value for (table, column), value in DEFAULTS.items() if table == name}
    return df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in filled.items()}) if filled else df


def missing_columns(spark: SparkSession, root: str, name: str) -> list[str]:
    """Columns that a table's files do not hold; reading supplies them."""
    there = set(spark.read.parquet(f"{root}/{name}").columns)
    return [c for c in spark.createDataFrame([], STATE[name]).columns if c not in there]
