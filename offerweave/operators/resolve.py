"""Clusters to products: match method, match key, representative fields, identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerweave.functions.text import GREEK
from offerweave.operators.tiers import chosen_codes, each_store, ean_keys, inner_edges, reliable, star_edges, weight
from offerweave.plans.scratch import materialize

PRIORITY = ("ean", "mpn_root", "mpn", "model_code", "title")


def contributions(clustered: DataFrame, edges: DataFrame) -> DataFrame:
    """``(component, tiers, match_method)`` of every cluster; edges within one cluster count.

    Offers with one EAN form a star too, but it only names the method and joins no clusters.
    """
    every = edges.select("src", "dst", "tier").unionByName(star_edges(ean_keys(clustered)).withColumn("tier", F.lit("ean")))
    at = clustered.select("offer_idx", "component")
    a = at.select(F.col("offer_idx").alias("src"), F.col("component").alias("c1"))
    b = at.select(F.col("offer_idx").alias("dst"), F.col("component").alias("c2"))
    inner = every.join(a, "src").join(b, "dst").filter("c1 = c2")
    return _with_method(clustered, inner.groupBy(F.col("c1").alias("component")).agg(F.sort_array(F.collect_set("tier")).alias("tiers")))


def key_contributions(clustered: DataFrame) -> DataFrame:
    """What ``contributions`` gives for the edges of all tiers, from ``clusters_by_keys`` and without those edges."""
    block = F.when(F.coalesce("effective_brand", F.lit("")) != "", F.concat(F.coalesce("category", F.lit("")), F.lit("\u0001"), "effective_brand", F.lit("\u0001")))
    keys = {
        "mpn_root": F.col("mpn_root_key"), "mpn": F.when(reliable(), F.col("mpn_key")), "model_code": F.concat(block, "chosen_code"),
        "title": F.concat(block, "title_key"), "ean": F.col("ean_key"),
    }
    # the rows are read once, with a key of each tier in turn
    each = F.array_compact(F.array(*[F.when(key.isNotNull(), F.struct(F.lit(name).alias("tier"), key.alias("key"))) for name, key in keys.items()]))
    keyed = clustered.select("component", "offer_idx", weight(clustered).alias("offers"), F.explode(each).alias("x"))
    found = inner_edges(keyed, F.col("x"), by="tier").select("component", "tier")
    return _with_method(clustered, found.groupBy("component").agg(F.sort_array(F.collect_set("tier")).alias("tiers")))


def _with_method(clustered: DataFrame, tiers: DataFrame) -> DataFrame:
    method = F.lit("unmatched")
    for name in reversed(PRIORITY):
        method = F.when(F.array_contains("tiers", name), name).otherwise(method)
    sizes = clustered.groupBy("component").agg(F.sum(weight(clustered)).alias("size"))
    none = F.array().cast("array<string>")
    return sizes.join(tiers, "component", "left").withColumn("tiers", F.coalesce("tiers", none)).withColumn("match_method", method)


def most_common(rows: DataFrame, value: str, alias: str, weight: str | None = None) -> DataFrame:
    """Each component's most frequent non-empty value; then the shortest, then the first by text.  A row counts ``weight`` times, or once."""
    n = F.sum(weight) if weight else F.count("*")
    counts = rows.filter(F.coalesce(F.col(value), F.lit("")) != "").groupBy("component", value).agg(n.alias("c"))
    best = F.min(F.struct((-F.col("c")).alias("c"), F.length(value).alias("l"), F.col(value).alias("v"))).alias("x")
    return counts.groupBy("component").agg(best).select("component", F.col("x.v").alias(alias))


def match_keys(clustered: DataFrame, contributed: DataFrame) -> DataFrame:
    """``(component, match_key, key_kind)``: one identifier shared by the cluster, else its titles.

    Offers of a cluster that agree in all that counts here are put together first.
    """
    filled = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
    coded = clustered
    if "chosen_code" not in clustered.columns:
        coded = clustered.join(chosen_codes(clustered).select("offer_idx", F.col("code").alias("chosen_code")), "offer_idx", "left")
    values = {"ean": filled("ean"), "root": filled("mpn_root"), "mpn": F.when(reliable(), filled("mpn")), "code": F.col("chosen_code")}
    alike = ["component", *[v.alias(c) for c, v in values.items()], "effective_brand", "title_key", F.coalesce("category", F.lit("")).alias("category")]
    rows = materialize(coded.groupBy(*alike).agg(F.sum(weight(coded)).alias("n"), F.min("offer_idx").alias("offer_idx")), "alike")
    facts = rows.groupBy("component").agg(
        F.min("offer_idx").alias("offer_idx"),
        *[x for c in values for x in (F.max(c).alias(f"{c}1"), F.when(F.max(c).isNull(), 0).when(F.min(c) == F.max(c), 1).otherwise(2).alias(f"n_{c}"))],
    )
    # blank categories take part in the vote for the category of a title key
    cats = rows.groupBy("component", "category").agg(F.sum("n").alias("c"))
    cat = cats.groupBy("component").agg(F.min(F.struct((-F.col("c")).alias("c"), F.length("category").alias("l"), "category")).alias("x")).select("component", F.col("x.category").alias("cat"))
    joined = facts.join(contributed.select("component", "tiers"), "component")
    for side in (most_common(rows, "effective_brand", "brand", "n"), most_common(rows, "title_key", "tk", "n"), cat):
        joined = joined.join(side, "component", "left")
    brand = F.lower(F.coalesce("brand", F.lit("")))
    low = lambda c: F.lower(F.trim(F.col(c)))
    kind = (
        F.when(F.array_contains("tiers", "title") | (F.col("n_root") > 1) | (F.col("n_ean") > 1), "title")
        .when(F.col("n_ean") == 1, "ean").when(F.col("n_root") == 1, "mpn_root").when(F.col("n_mpn") == 1, "mpn").when(F.col("n_code") == 1, "model_code").otherwise("title")
    )
    kind = F.when((kind == "title") & F.col("tk").isNull(), "singleton").otherwise(kind)
    key = (
        F.when(F.col("key_kind") == "ean", F.concat(F.lit("ean|"), low("ean1")))
        .when(F.col("key_kind") == "mpn_root", F.concat(F.lit("mpnroot|"), brand, F.lit("|"), low("root1")))
        .when(F.col("key_kind") == "mpn", F.concat(F.lit("mpn|"), brand, F.lit("|"), low("mpn1")))
        .when(F.col("key_kind") == "model_code", F.concat(F.lit("model|"), brand, F.lit("|"), low("code1")))
        .when(F.col("key_kind") == "title", F.concat(F.lit("title|"), F.col("cat"), F.lit("|"), brand, F.lit("|"), F.col("tk")))
    )
    held = materialize(joined.withColumn("key_kind", kind).withColumn("match_key", key).select("component", "match_key", "key_kind", "offer_idx"), "match-keys")
    # the only kind that names an offer, the first of its cluster
    named = F.concat(F.lit("singleton|"), F.col("store"), F.lit("|"), F.col("store_product_id")).alias("match_key")
    single = held.filter("key_kind = 'singleton'").drop("match_key").join(clustered.select("offer_idx", "store", "store_product_id"), "offer_idx").select("component", named, "key_kind")
    return held.filter("key_kind <> 'singleton'").drop("offer_idx").unionByName(single)


def quoted_list(values: Column) -> Column:
    """``['a', 'b']``"""
    return F.concat(F.lit("['"), F.array_join(values, "', '"), F.lit("']"))


def categories(clustered: DataFrame) -> DataFrame:
    """``(component, cats)``: each cluster's categories in order."""
    seen = clustered.groupBy("component", "category").agg(F.count("*").alias("n"))
    return seen.groupBy("component").agg(F.sort_array(F.collect_set(F.when(F.col("category") != "", F.col("category")))).alias("cats"))


def _review(cats: Column) -> tuple[Column, Column]:
    review = F.size(cats) > 1
    return review.alias("needs_review"), F.when(review, F.concat(F.lit("cross-category: "), quoted_list(cats))).alias("review_reason")


def category_reviews(clustered: DataFrame) -> DataFrame:
    """``(component, needs_review, review_reason)`` as ``representatives`` has them."""
    return categories(clustered).select("component", *_review(F.col("cats")))


def representatives(clustered: DataFrame) -> DataFrame:
    """One product row per component: the first English title, most common fields, price range.

    Offers of a cluster with equal texts are put together first.
    """
    picked = F.struct("title", "title_norm", "image_url")
    english = ~F.col("title").rlike(GREEK)
    price = ("low", "high") if "low" in clustered.columns else ("price", "price")
    alike = clustered.groupBy("component", "title", "title_norm", "image_url", "category", "effective_brand", "ean", "mpn_root", "mpn").agg(
        F.min("offer_idx").alias("offer_idx"), F.sum(weight(clustered)).alias("n"), F.min(price[0]).alias("low"), F.max(price[1]).alias("high"), F.bool_or(F.coalesce("available", F.lit(False))).alias("available")
    )
    rows = materialize(alike, "alike")
    facts = rows.groupBy("component").agg(
        F.coalesce(F.min_by(F.when(english, picked), F.when(english, F.col("offer_idx"))), F.min_by(picked, "offer_idx")).alias("t"),
        F.min_by("image_url", F.when(F.coalesce("image_url", F.lit("")) != "", F.col("offer_idx"))).alias("any_image"),
        F.sort_array(F.collect_set(F.when(F.col("category") != "", F.col("category")))).alias("cats"),
        F.sum("n").alias("offer_count"), F.min("low").alias("min_price"), F.max("high").alias("max_price"), F.bool_or("available").alias("has_available_offer"),
    )
    stores = clustered.select("component", each_store(clustered).alias("store")).groupBy("component", "store").agg(F.count("*").alias("n")).groupBy("component").agg(F.count("store").alias("store_count"))
    facts = facts.join(stores, "component")
    for value, alias in (("effective_brand", "brand"), ("category", "category"), ("ean", "ean"), ("mpn_root", "mpn_root"), ("mpn", "mpn")):
        facts = facts.join(most_common(rows, value, alias, "n"), "component", "left")
    return facts.select(
        "component", F.lower("brand").alias("brand"), "category", F.col("t.title").alias("canonical_title"), F.col("t.title_norm").alias("normalized_title"),
        F.coalesce(F.nullif("t.image_url", F.lit("")), "any_image").alias("image_url"), "ean", "mpn_root", "mpn", "offer_count", "store_count",
        "min_price", "max_price", "has_available_offer", *_review(F.col("cats")),
    )


def summaries(clustered: DataFrame) -> DataFrame:
    """The columns of ``representatives`` that need no texts, from rows with ``low`` and ``high``, ``offers`` and ``stores``."""
    rows = clustered.select("component", "effective_brand", "category", "offers", "stores", "low", "high")
    alike = rows.groupBy("component", "effective_brand", "category").agg(
        F.sum("offers").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.array_distinct(F.flatten(F.collect_set("stores"))).alias("stores")
    )
    held = materialize(alike, "summed")
    facts = held.groupBy("component").agg(
        F.sum("n").alias("offer_count"), F.size(F.array_distinct(F.flatten(F.collect_set("stores")))).cast("bigint").alias("store_count"),
        F.min("low").alias("min_price"), F.max("high").alias("max_price"),
    )
    for value, alias in (("effective_brand", "brand"), ("category", "category")):
        facts = facts.join(most_common(held, value, alias, "n"), "component", "left")
    return facts.withColumn("brand", F.lower("brand")).select("component", "brand", "category", "offer_count", "store_count", "min_price", "max_price")


def add_reason(reason: Column, more: Column) -> Column:
    return F.concat_ws("; ", reason, more)


def resolve_identity(clustered: DataFrame, keys: DataFrame, linked: DataFrame, products: DataFrame, by: tuple[str, ...] = ("store", "store_product_id")) -> DataFrame:
    """``(component, resolution, product_id, absorbed)`` against an existing catalog.

    ``linked(store, store_product_id, product_id)`` are offers (or what else ``by`` names) that have a product already,
    ``products(id, match_key)`` the catalog.  One known product: attached.  Several: merged
    into the oldest.  None: looked up by match key, else new.
    """
    known = clustered.select("component", *by).join(linked, list(by))
    ids = known.select("component", "product_id").distinct().groupBy("component").agg(F.sort_array(F.collect_set("product_id")).alias("ids"))
    by_key = products.filter("match_key is not null").groupBy("match_key").agg(F.sort_array(F.collect_set("id")).alias("hits"))
    all_ = keys.join(ids, "component", "left").join(by_key, "match_key", "left")
    n, m = F.coalesce(F.size("ids"), F.lit(0)), F.coalesce(F.size("hits"), F.lit(0))
    n, m = F.greatest(n, F.lit(0)), F.greatest(m, F.lit(0))
    kind = F.when(n == 1, "attached").when(n > 1, "merged").when(m == 1, "key_lookup").when(m > 1, "ambiguous_key").otherwise("new")
    pid = F.when(n >= 1, F.get("ids", F.lit(0))).when(m >= 1, F.get("hits", F.lit(0)))
    none = F.array().cast("array<bigint>")
    return all_.select("component", "match_key", kind.alias("resolution"), pid.alias("product_id"), F.when(n > 1, F.slice("ids", 2, F.greatest(n - 1, F.lit(0)))).otherwise(none).alias("absorbed"), F.when((n < 1) & (m > 1), F.col("hits")).alias("hits"))


def merge_collisions(clustered: DataFrame, decisions: DataFrame) -> DataFrame:
    """Clusters that resolve to one product become one: offers with the winner's ``component``.

    The largest cluster wins, then the one with the smallest component.  Adds ``clusters_merged``.
    """
    sized = decisions.join(clustered.groupBy("component").agg(F.sum(weight(clustered)).alias("size")), "component")
    same = sized.filter("product_id is not null").groupBy("product_id").agg(
        F.min(F.struct((-F.col("size")).alias("s"), "component")).alias("w"), F.count("*").alias("clusters_merged")
    )
    target = sized.join(same, "product_id", "left").select("component", F.coalesce("w.component", "component").alias("winner"), F.coalesce("clusters_merged", F.lit(1)).alias("clusters_merged"))
    return clustered.join(target, "component").withColumn("component", F.col("winner")).drop("winner")
