"""Coverage, distributions, top lists and collision reports, all as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerweave.functions import text as tx
from offerweave.operators.tiers import each_store, weight

PRESENT = ("title_key", "ean_key", "mpn_root_key", "mpn_key")


def bucket(n: Column, edges: tuple[int, ...]) -> Column:
    """The label of the range that a count falls into: ``1``, ``2-5``, ``6+``."""
    out = F.lit(f"{edges[-1]}+")
    for low, high in reversed(list(zip(edges, edges[1:], strict=False))):
        out = F.when(n < high, str(low) if high == low + 1 else f"{low}-{high - 1}").otherwise(out)
    return out


def totals(offers: DataFrame, by: str = "store") -> DataFrame:
    return offers.groupBy(by).agg(F.count("*").alias("offers"))


def coverage(offers: DataFrame) -> DataFrame:
    """How many offers of each store, and of all (TOTAL), have each key."""
    rolled = offers.rollup("store").agg(F.count("*").alias("offers"), *[F.count(c).alias(c) for c in PRESENT], F.count_if(F.size("model_codes") > 0).alias("model_codes"))
    return rolled.withColumn("store", F.coalesce("store", F.lit("TOTAL")))


def block_sizes(offers: DataFrame) -> DataFrame:
    return offers.groupBy(F.coalesce("category", F.lit("")).alias("category"), F.coalesce("effective_brand", F.lit("")).alias("brand")).agg(F.count("*").alias("size"))


def histogram(rows: DataFrame, value: str, edges: tuple[int, ...]) -> DataFrame:
    return rows.groupBy(bucket(F.col(value), edges).alias("bucket")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def top(rows: DataFrame, value: str, names: list[str], n: int) -> DataFrame:
    """The n largest, ties by name."""
    return rows.orderBy(F.desc(value), *names).limit(n)


def suspicious_summary(offers: DataFrame) -> DataFrame:
    bad = F.col("is_suspicious_brand")
    return offers.groupBy("store").agg(F.count_if(bad).alias("suspicious"), F.count_if(bad & F.col("brand_from_title").isNotNull()).alias("recoverable"), F.count_if(bad & F.col("brand_from_title").isNull()).alias("unrecoverable"))


def brand_fixes(offers: DataFrame, n: int = 15) -> DataFrame:
    fixes = offers.filter("is_suspicious_brand and brand_from_title is not null").groupBy("brand_norm", "brand_from_title").agg(F.count("*").alias("n"))
    return top(fixes, "n", ["brand_norm", "brand_from_title"], n)


def code_counts(offers: DataFrame) -> DataFrame:
    return offers.select(F.explode("model_codes").alias("code")).groupBy("code").agg(F.count("*").alias("offers"))


def codes_per_offer(offers: DataFrame) -> DataFrame:
    return offers.groupBy(F.size("model_codes").alias("codes")).agg(F.count("*").alias("offers"))


def code_blocks(offers: DataFrame) -> DataFrame:
    """Per code: offers, blocks, stores."""
    block = F.struct(F.coalesce("category", F.lit("")).alias("c"), F.coalesce("effective_brand", F.lit("")).alias("b"))
    each = offers.select("store", "category", "effective_brand", F.explode("model_codes").alias("code"))
    return each.groupBy("code").agg(F.count("*").alias("offers"), F.count_distinct(block).alias("blocks"), F.count_distinct("store").alias("stores"))


def good_codes(offers: DataFrame) -> DataFrame:
    """Codes of one block and two to five offers; ``bridge`` if they join stores."""
    return code_blocks(offers).filter("blocks = 1 and offers between 2 and 5").withColumn("bridge", F.col("stores") >= 2)


def store_bridges(offers: DataFrame, a: str, b: str) -> DataFrame:
    """Codes that both stores have."""
    each = offers.select("store", F.explode("model_codes").alias("code"))
    return each.groupBy("code").agg(F.collect_set("store").alias("s")).filter(F.array_contains("s", a) & F.array_contains("s", b)).select("code", F.size("s").alias("stores"))


def matchable_codes(offers: DataFrame) -> DataFrame:
    """(category, brand, code) that two or more offers share."""
    each = offers.select(F.coalesce("category", F.lit("")).alias("category"), F.coalesce("effective_brand", F.lit("")).alias("brand"), F.explode("model_codes").alias("code"))
    return each.groupBy("category", "brand", "code").agg(F.count("*").alias("offers")).filter("offers > 1")


def blocked_codes(offers: DataFrame) -> DataFrame:
    """Distinct codes that are specifications or, if not those, series suffixes."""
    codes = offers.select(F.explode("model_codes").alias("code")).distinct()
    kind = F.when(tx.is_spec_code(F.col("code")), "spec").when(tx.is_series_suffix(F.col("code")), "suffix")
    return codes.withColumn("kind", kind).filter("kind is not null")


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    """How many offers, stores and categories; equal ones are put together first, so no row is repeated for its counts."""
    sizes = clustered.groupBy("component", F.coalesce("category", F.lit("")).alias("category")).agg(F.sum(weight(clustered)).alias("n"))
    sizes = sizes.groupBy("component").agg(F.sum("n").alias("size"), F.count("*").alias("categories"))
    return sizes.join(store_counts(clustered), "component").select("component", "size", "stores", "categories")


def offer_counts(clustered: DataFrame) -> DataFrame:
    """``(component, size)``"""
    return clustered.groupBy("component").agg(F.sum(weight(clustered)).alias("size"))


def store_counts(clustered: DataFrame) -> DataFrame:
    """``(component, stores)``"""
    seen = clustered.select("component", each_store(clustered).alias("store")).groupBy("component", "store").agg(F.count("*").alias("n"))
    return seen.groupBy("component").agg(F.count("store").alias("stores"))


def collisions(keys: DataFrame) -> DataFrame:
    """Match keys that two or more clusters propose."""
    return keys.groupBy("match_key").agg(F.count("*").alias("clusters")).filter("clusters > 1")


def shares(rows: DataFrame, value: str) -> DataFrame:
    """Counts of each value and their share of all rows."""
    counts = rows.groupBy(value).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # over the few distinct values
    return counts.select(value, "n", F.round(F.col("n") * 100.0 / total, 2).alias("pct"))


def reason_counts(decisions: DataFrame) -> DataFrame:
    parts = decisions.select(F.explode(F.split("review_reason", "; ")).alias("part"))
    return parts.groupBy(F.trim(F.substring_index("part", ":", 1)).alias("reason")).agg(F.count("*").alias("n"))


def category_fill(rows: DataFrame) -> DataFrame:
    """Mapped rows and products per category of rows(product_count, category); unreadable counts are 0."""
    n = F.coalesce(F.col("product_count").try_cast("bigint"), F.lit(0))
    return rows.groupBy(F.coalesce("category", F.lit("(excluded)")).alias("category")).agg(F.count("*").alias("rows"), F.sum(n).alias("products"))


def grown(before: DataFrame, after: DataFrame) -> DataFrame:
    """Components of ``after`` that hold several of ``before``: how many, and how many offers were alone."""
    old = before.select("offer_idx", F.col("component").alias("old"))
    return grown_from(after.select("offer_idx", "component").join(old, "offer_idx"), old)


def grown_from(both: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """``grown`` where each offer has its component before, ``old``, and its ``component`` now; ``before`` holds all offers of then, if there were more.

    The offers of rows without ``old`` were each alone.
    """
    counts = both.groupBy("component", "old").agg(F.sum(weight(both)).alias("n"))
    before = both if before is None else before
    sizes = before.groupBy("old").agg(F.sum(weight(before)).alias("was"))
    joined = counts.join(sizes, "old", "left").withColumn("was", F.coalesce("was", F.lit(1)))
    out = joined.groupBy("component").agg(F.sum(F.when(F.col("old").isNull(), F.col("n")).otherwise(1)).alias("parts"), F.coalesce(F.sum(F.when(F.col("was") == 1, F.col("n"))), F.lit(0)).alias("singles"), F.count_if(F.col("was") > 1).alias("clusters"))
    return out.filter("parts > 1").withColumn("kind", F.when(F.col("clusters") == 0, "new").when(F.col("clusters") == 1, "grew").otherwise("bridged"))


def diverse_sample(rows: DataFrame, kind: str, order: str, n: int = 5) -> DataFrame:
    """The first row of each distinct kind, then others in order, n rows."""
    firsts = rows.groupBy(kind).agg(F.min(order).alias("_first"))
    joined = rows.join(firsts, rows[kind].eqNullSafe(firsts[kind])).drop(firsts[kind])
    return joined.orderBy(F.col(order) != F.col("_first"), order).limit(n).drop("_first")


def languages(clustered: DataFrame) -> DataFrame:
    """``(component, langs, stores)`` of clusters of several stores."""
    titles = clustered.select("component", tx.language(F.col("title")).alias("lang")).distinct()
    langs = titles.groupBy("component").agg(F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("langs"))
    stores = store_counts(clustered).filter("stores > 1")
    return langs.join(stores, "component")


def cluster_facts(clustered: DataFrame) -> DataFrame:
    """``cluster_sizes`` with the number of brands."""
    brands = clustered.groupBy("component").agg(F.count_distinct(F.coalesce("brand_norm", F.lit(""))).alias("brands"))
    return cluster_sizes(clustered).join(brands, "component")


def stratified_clusters(sizes: DataFrame, n: int = 15) -> DataFrame:
    """The five largest, then clusters of several stores, categories or, where counted, brands, then others; n rows."""
    mixed = F.lit(False)
    for c in ("stores", "categories", "brands"):
        mixed = (mixed | (F.col(c) > 1)) if c in sizes.columns else mixed
    largest = sizes.orderBy(F.desc("size"), "component").limit(5).select("component", F.lit(0).alias("p"))
    ranked = sizes.join(F.broadcast(largest), "component", "left").withColumn("p", F.coalesce("p", F.when(mixed, 1).otherwise(2)))
    return ranked.orderBy("p", F.desc("size"), "component").limit(n).drop("p")


def key_verdict(keys: DataFrame) -> DataFrame:
    """One row: clusters, distinct match keys, keys and clusters in collisions, and GO if there are none."""
    per_key = keys.groupBy("match_key").agg(F.count("*").alias("c"))
    facts = per_key.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("clusters"), F.count("*").alias("keys"), F.count_if(F.col("c") > 1).alias("colliding_keys"), F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias("colliding_clusters"))
    return facts.withColumn("verdict", F.when(F.col("colliding_keys") == 0, "GO").otherwise("REVIEW NEEDED"))


def greek_only(clustered: DataFrame) -> DataFrame:
    """Clusters of several stores all of whose titles are Greek."""
    facts = clustered.groupBy("component").agg(F.count("*").alias("size"), F.count_distinct("store").alias("stores"), F.bool_and(tx.language(F.col("title")) == "EL").alias("greek"))
    return facts.filter("greek and stores > 1").drop("greek")


def title_inspection(offers: DataFrame, n: int = 30) -> DataFrame:
    """The first n offers before and after normalisation, with a better brand where theirs looks wrong."""
    first = offers.orderBy("offer_idx").limit(n)
    return first.select("offer_idx", "vendor", F.col("brand_norm").alias("brand"), "title", F.col("title_norm").alias("normal"), F.array_join("model_codes", ",").alias("models"), F.when(F.col("is_suspicious_brand"), F.col("brand_from_title")).alias("suggested"))
