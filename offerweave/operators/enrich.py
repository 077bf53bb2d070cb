"""Offers with normalised brand, title, keys and model codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerweave.functions import text as tx
from offerweave.plans.scratch import materialize


def number_offers(offers: DataFrame) -> DataFrame:
    """``offer_idx`` from 0 in order of (store, store_product_id), with one exchange and no task that sorts all rows.

    Rows are dealt by ranges and sorted within them; the running id that each then gets holds its
    range and its place there, which the sizes of the ranges before turn into a number.
    """
    ranges = int(offers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = offers.repartitionByRange(ranges, "store", "store_product_id").sortWithinPartitions("store", "store_product_id")
    held = materialize(ranged.withColumn("_id", F.monotonically_increasing_id()), "numbered")  # the ranges must not be drawn anew
    part = F.shiftright("_id", 33)
    sizes = held.groupBy(part.alias("_part")).agg(F.count("*").alias("_c"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = F.broadcast(sizes.select("_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_shift")))  # a row for each range
    numbered = held.withColumn("_part", part).join(shifts, "_part")
    return numbered.withColumn("offer_idx", (F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_shift")).cast("bigint")).drop("_part", "_id", "_shift")


def number_groups(groups: DataFrame, order: list[str], size: str) -> DataFrame:
    """``first``: how many offers the groups before hold, in order of ``order``; ``size`` names how many each has.  No task sorts all groups."""
    return number_each(groups.withColumn("_sizes", F.array(size)), order, "_sizes", 1).withColumn("first", F.get("firsts", F.lit(0))).drop("_sizes", "firsts")


def number_each(rows: DataFrame, order: list[str], sizes: str, places: int) -> DataFrame:
    """``firsts``: how many offers the groups before hold, where a row has a group for each of ``places``, as large as the array ``sizes`` says.

    Groups are in order of their place, then of ``order``.  No task sorts all rows, and a row's groups travel together.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = materialize(rows.repartitionByRange(ranges, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    each = [F.get(sizes, F.lit(i)).cast("bigint") for i in range(places)]
    sums = held.groupBy("_part").agg(*[F.sum(x).alias(f"_{i}") for i, x in enumerate(each)])
    before, every = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    lower = [sum((F.sum(f"_{j}").over(every) for j in range(i)), F.lit(0)) for i in range(places)]
    shifts = [(F.coalesce(F.sum(f"_{i}").over(before), F.lit(0)) + lower[i]) for i in range(places)]
    shifts = F.broadcast(sums.select("_part", F.array(*shifts).alias("_shifts")))  # a row for each range
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = held.select("*", *[F.coalesce(F.sum(x).over(within), F.lit(0)).alias(f"_{i}") for i, x in enumerate(each)]).join(shifts, "_part")
    firsts = F.array(*[(F.col(f"_{i}") + F.get("_shifts", F.lit(i))).cast("bigint") for i in range(places)])
    return summed.withColumn("firsts", firsts).drop("_part", "_shifts", *[f"_{i}" for i in range(places)])


#: All that ``enrich`` looks at.
TEXTS = ("title", "vendor", "category", "ean", "mpn", "mpn_root")


def enrich_once(offers: DataFrame) -> DataFrame:
    """``enrich`` where offers with equal texts, told by two 64-bit hashes, are looked at once."""
    seen = [*[F.col(c).isNull() for c in TEXTS], *TEXTS]
    marked = offers.withColumn("_t1", F.xxhash64(*seen)).withColumn("_t2", F.xxhash64(F.lit("texts"), *seen))
    texts = materialize(enrich(marked.select("_t1", "_t2", *TEXTS).distinct()).drop(*TEXTS), "texts")
    return marked.join(texts, ["_t1", "_t2"]).drop("_t1", "_t2")


def enrich(offers: DataFrame) -> DataFrame:
    """Add the derived columns; identifier keys use the effective brand, the title key the vendor's."""
    brands = offers.withColumn("brand_norm", tx.normalize_brand(F.col("vendor"))).withColumn("brand_from_title", tx.brand_from_title(F.col("title")))
    trusted = brands.withColumn("is_suspicious_brand", tx.suspicious_brand(F.col("brand_norm"), F.col("brand_from_title")))
    trusted = trusted.withColumn("effective_brand", F.when(F.col("is_suspicious_brand"), F.col("brand_from_title")).otherwise(F.col("brand_norm")))
    titled = trusted.withColumn("title_norm", tx.normalize_title(F.col("title"), F.col("brand_norm")))
    return (
        titled.withColumn("title_key", tx.title_key(F.col("brand_norm"), F.col("category"), F.col("title_norm")))
        .withColumn("ean_key", tx.ean_key(F.col("ean")))
        .withColumn("mpn_root_key", tx.brand_key("mpnroot", F.col("effective_brand"), F.col("mpn_root")))
        .withColumn("mpn_key", tx.brand_key("mpn", F.col("effective_brand"), F.col("mpn")))
        .withColumn("model_codes", tx.model_codes(F.col("title")))
    )
