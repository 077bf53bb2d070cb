"""The registered queries of the offer engine, each with SQL that gives the same rows.

Names begin with the operator ids of the survey.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerweave.functions import extract as ex
from offerweave.functions import text as tx
from offerweave.operators import catalog as ct
from offerweave.operators import ingest as ig
from offerweave.operators import reports as rp
from offerweave.operators import resolve as rs
from offerweave.operators import tiers as tr
from offerweave.plans import adapter as ad
from offerweave.plans.scratch import scratch_root
from offerweave.sources import readers as rd
from offerweave.sources import state as st

FLAGSHIP = "G4_resolved_products"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def on_offers(name: str, sql: str, make: Callable[[DataFrame], DataFrame], base: str = ad.SQL_OFFERS, texts: bool = False) -> None:
    source = ad.offers if base is not ad.SQL_CLUSTERS else ad.listed if texts else ad.listed_keys
    query(name, f"{base} {sql}")(lambda spark, sf_dir: make(source(spark, sf_dir)))


# --- scans, numbering, scalar rules
on_offers("S7_W1_ordered_scan", "select offer_idx, store, store_product_id from o", lambda o: o.select("offer_idx", "store", "store_product_id"))
on_offers("N1_N3_brand", "select offer_idx, brand_norm from o", lambda o: o.select("offer_idx", "brand_norm"))
on_offers("N8_title_norm", "select offer_idx, title_norm from o", lambda o: o.select("offer_idx", "title_norm"))
on_offers("N10_N13_N14_N15_keys", "select offer_idx, ean_key, mpn_root_key, mpn_key, title_key from o", lambda o: o.select("offer_idx", "ean_key", "mpn_root_key", "mpn_key", "title_key"))
on_offers("N16_model_codes", "select offer_idx, coalesce(good_code, '') as codes from o", lambda o: o.select("offer_idx", F.array_join("model_codes", ",").alias("codes")))
on_offers("N18_N20_effective_brand", "select offer_idx, brand_from_title, is_suspicious_brand, effective_brand from o", lambda o: o.select("offer_idx", "brand_from_title", "is_suspicious_brand", "effective_brand"))
on_offers("N12_title_hash", "select offer_idx, substr(sha1(title_norm), 1, 12) as h from o", lambda o: o.select("offer_idx", tx.title_hash(F.col("title_norm")).alias("h")))
on_offers("N22_F11_language", "select 'EN' as lang, count(*) as n from o", lambda o: o.groupBy(tx.language(F.col("title")).alias("lang")).agg(F.count("*").alias("n")))
on_offers("N24_spaced_codes", "select offer_idx, 'gb770nc' as joined from o where k % 3 = 1 union all select offer_idx, 'gbrare' || k || 'z9' from o where k % 3 = 2", lambda o: o.select("offer_idx", F.explode(tx.spaced_codes(F.col("title"), F.col("model_codes"))).alias("joined")))
on_offers("P6_mpn_root", "select distinct mpn, mpn_root from o", lambda o: o.select("mpn", ex.mpn_root(F.col("mpn")).alias("mpn_root")).distinct())
on_offers("P5_mpn_from_title", "select distinct title, case when false then '' end as mpn from o", lambda o: o.select("title", ex.mpn_from_title(F.col("title")).alias("mpn")).distinct())
on_offers("P16_first_word", "select distinct title, split_part(title, ' ', 1) as word from o", lambda o: o.select("title", ex.first_word(F.col("title")).alias("word")).distinct())
on_offers("P20_positive_price", "select offer_idx, case when price > 500 then price::double end as price from o", lambda o: o.select("offer_idx", (ex.positive(F.col("price") - 500) + 500).cast("double").alias("price")))
on_offers("S2_copy_text", "select store || chr(9) || store_product_id || chr(9) || coalesce(vendor, '\\N') || chr(9) || case when available then 't' else 'f' end as line from o", lambda o: rd.copy_text(o, ["store", "store_product_id", "vendor", "available"]))
on_offers("F4_reliable_mpn", "select offer_idx, mpn_key as key from o where identifier_source in ('sku', 'api') and mpn_key is not null", tr.mpn_keys)
on_offers("F5_F6_F7_code_filters", "select distinct code, code = '770nc' as suffix from o where good_code is not null", lambda o: o.select(F.explode("model_codes").alias("code")).distinct().select("code", tx.is_series_suffix(F.col("code")).alias("suffix")))
on_offers("F12_multi_store_keys", "select mpn_root_key as key, count(distinct store) as stores from o where mpn_root_key is not null group by 1 having count(distinct store) >= 2", lambda o: o.filter("mpn_root_key is not null").groupBy(F.col("mpn_root_key").alias("key")).agg(F.count_distinct("store").alias("stores")).filter("stores >= 2"))

# --- groups, codes, edges
for _name, _keys, _key in (("A1_mpn_root_groups", tr.mpn_root_keys, "mpn_root_key"), ("A8_ean_groups", tr.ean_keys, "ean_key")):
    on_offers(_name, f"select {_key} as key, count(*) as n, min(offer_idx) as hub from o where {_key} is not null group by 1 having count(*) > 1",
              lambda o, f=_keys: tr.groups(f(o)).select("key", F.size("members").alias("n"), F.get("members", F.lit(0)).alias("hub")))
on_offers("A2_mpn_groups", "select mpn_key as key, count(*) as n from o where identifier_source in ('sku', 'api') and mpn_key is not null group by 1 having count(*) > 1", lambda o: tr.groups(tr.mpn_keys(o)).select("key", F.size("members").alias("n")))
on_offers("A3_title_groups", "select title_key, count(*) as n from o where title_key is not null and effective_brand <> '' group by category, effective_brand, title_key having count(*) > 1", lambda o: tr.groups(tr.title_keys(o)).select(F.element_at(F.split("key", "\u0001"), -1).alias("title_key"), F.size("members").alias("n")))
on_offers("A4_block_spread", "select code, spread from spread", tr.block_spread, ad.SQL_CODES)
on_offers("A5_code_frequency", "select code, freq from freq", tr.code_frequency, ad.SQL_CODES)
on_offers("A6_chosen_codes", "select offer_idx, chosen as code, freq from chosen", tr.chosen_codes, ad.SQL_CODES)
on_offers("A7_code_groups", "select chosen as code, count(*) as n from chosen join o using (offer_idx) where effective_brand <> '' group by category, effective_brand, chosen having count(*) > 1", lambda o: tr.groups(tr.model_code_keys(o)).select(F.element_at(F.split("key", "\u0001"), -1).alias("code"), F.size("members").alias("n")), ad.SQL_CODES)
on_offers("G1_star_edges", "select hub as src, offer_idx as dst from (select offer_idx, min(offer_idx) over (partition by mpn_root_key) as hub from o where mpn_root_key is not null) where hub <> offer_idx", lambda o: tr.star_edges(tr.mpn_root_keys(o)))


@query("O1_all_edges", ad.SQL_CLUSTERS + """ select tier, count(*) as n from (
  select 'mpn_root' as tier, offer_idx, min(offer_idx) over (partition by mpn_root_key) as hub from cl where mpn_root_key is not null union all
  select 'mpn', offer_idx, min(offer_idx) over (partition by rk) from cl where rk is not null union all
  select 'model_code', offer_idx, min(offer_idx) over (partition by ck) from cl where ck is not null union all
  select 'title', offer_idx, min(offer_idx) over (partition by tk) from cl where tk is not null) where hub <> offer_idx group by tier""")  # fmt: skip
def all_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.edges(spark, sf_dir).groupBy("tier").agg(F.count("*").alias("n"))


# --- components and products
query("G2_G3_components", ad.SQL_CLUSTERS + " select offer_idx, component from cl")(lambda s, d: ad.assigned(s, d).select("offer_idx", "component"))
on_offers("A29_cluster_sizes", "select component, count(*) as size, count(distinct store) as stores, count(distinct coalesce(category, '')) as categories from cl group by 1", rp.cluster_sizes, ad.SQL_CLUSTERS)
on_offers("K3_largest_clusters", "select component, count(*) as size from cl group by 1 order by size desc, component limit 25", lambda c: rp.top(rp.offer_counts(c), "size", ["component"], 25), ad.SQL_CLUSTERS)
on_offers("K5_sample_clusters", "select component, count(*) as size from cl group by 1 order by component limit 10", lambda c: rp.offer_counts(c).orderBy("component").limit(10), ad.SQL_CLUSTERS)
on_offers("K6_stratified_clusters", """, z as (select component, count(*) as size, count(distinct store) as stores, count(distinct coalesce(category, '')) as categories from cl group by 1),
  r as (select *, row_number() over (order by size desc, component) as nth from z)
  select component, size, stores, categories from r order by case when nth <= 5 then 0 when stores > 1 or categories > 1 then 1 else 2 end, size desc, component limit 15""", lambda c: rp.stratified_clusters(rp.cluster_sizes(c)), ad.SQL_CLUSTERS)  # fmt: skip
on_offers("R1_review_signals", """, f as (select component, count(*) as n, count_if(is_suspicious_brand and brand_from_title is null) as lost, count(distinct nullif(effective_brand, '')) as brands from cl group by 1 having count(*) > 1)
  select component, 'unresolved_suspicious_brand' as reason from f where lost > 0 union all select component, 'cross_effective_brand' from f where brands > 1""", tr.review_signals, ad.SQL_CLUSTERS, texts=True)  # fmt: skip

_SQL_METHOD = ad.SQL_CLUSTERS + """, tiers as (
  select component, list_sort(list_distinct(list(tier))) as tiers from (
    select 'mpn_root' as tier, component, offer_idx, min(offer_idx) over (partition by mpn_root_key) as hub from cl where mpn_root_key is not null union all
    select 'mpn', component, offer_idx, min(offer_idx) over (partition by rk) from cl where rk is not null union all
    select 'model_code', component, offer_idx, min(offer_idx) over (partition by ck) from cl where ck is not null union all
    select 'title', component, offer_idx, min(offer_idx) over (partition by tk) from cl where tk is not null union all
    select 'ean', e.component, e.offer_idx, e.hub from (select component, offer_idx, min(offer_idx) over (partition by ean_key) as hub from cl where ean_key is not null) e join cl h on h.offer_idx = e.hub and h.component = e.component
  ) x where hub <> offer_idx group by component
), m as (
  select component, count(*) as size, any_value(tiers) as tiers from cl left join tiers using (component) group by component
), meth as (
  select component, size, coalesce(tiers, []) as tiers, case when list_contains(tiers, 'ean') then 'ean' when list_contains(tiers, 'mpn_root') then 'mpn_root' when list_contains(tiers, 'mpn') then 'mpn'
    when list_contains(tiers, 'model_code') then 'model_code' when list_contains(tiers, 'title') then 'title' else 'unmatched' end as match_method from m
)"""  # fmt: skip

def _contributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.key_contributions(ad.listed_keys(spark, sf_dir))


@query("A9_match_method", _SQL_METHOD + " select component, size, array_to_string(tiers, ',') as tiers, match_method from meth")
def match_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contributed(spark, sf_dir).select("component", "size", F.array_join("tiers", ",").alias("tiers"), "match_method")


@query("A31_method_shares", _SQL_METHOD + " select match_method, count(*) as n, round(count(*) * 100.0 / sum(count(*)) over (), 2)::double as pct from meth group by 1")
def method_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.shares(_contributed(spark, sf_dir), "match_method").withColumn("pct", F.col("pct").cast("double"))


def _sql_common(name: str, value: str, alias: str) -> str:
    return f", {name} as (select component, v as {alias} from (select component, {value} as v, row_number() over (partition by component order by count(*) desc, length({value}), {value}) as nth from cl where coalesce({value}, '') <> '' group by component, {value}) where nth = 1)"


_SQL_KEYS = _SQL_METHOD + _sql_common("mb", "effective_brand", "brand") + _sql_common("mt", "title_key", "tkey") + """, mc as (
  select component, v as cat from (select component, coalesce(category, '') as v, row_number() over (partition by component order by count(*) desc, length(coalesce(category, '')), coalesce(category, '')) as nth from cl group by component, coalesce(category, '')) where nth = 1
), fx as (
  select component, count(distinct ean) as ne, max(ean) as e1, count(distinct mpn_root) as nr, max(mpn_root) as r1, count(distinct case when identifier_source in ('sku', 'api') then mpn end) as nm,
    max(case when identifier_source in ('sku', 'api') then mpn end) as m1, count(distinct chosen) as nc, max(chosen) as c1, arg_min(store || '|' || store_product_id, offer_idx) as first from cl group by 1
), kk as (
  select *, case when list_contains(tiers, 'title') or nr > 1 or ne > 1 then 'title' when ne = 1 then 'ean' when nr = 1 then 'mpn_root' when nm = 1 then 'mpn' when nc = 1 then 'model_code' else 'title' end as kind0
  from fx join meth using (component) left join mb using (component) left join mt using (component) left join mc using (component)
), keys as (
  select component, case when kind0 = 'title' and tkey is null then 'singleton' else kind0 end as key_kind, case kind0 when 'ean' then 'ean|' || lower(e1) when 'mpn_root' then 'mpnroot|' || lower(coalesce(brand, '')) || '|' || lower(r1)
    when 'mpn' then 'mpn|' || lower(coalesce(brand, '')) || '|' || lower(m1) when 'model_code' then 'model|' || lower(coalesce(brand, '')) || '|' || lower(c1)
    else case when tkey is null then 'singleton|' || first else 'title|' || cat || '|' || lower(coalesce(brand, '')) || '|' || tkey end end as match_key from kk
)"""  # fmt: skip


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad._kept(spark, sf_dir, "keys", lambda: rs.match_keys(ad.listed_keys(spark, sf_dir), _contributed(spark, sf_dir)))


query("A12_match_keys", _SQL_KEYS + " select component, match_key, key_kind from keys")(_keys)
query("A30_key_collisions", _SQL_KEYS + " select match_key, count(*) as clusters from keys group by 1 having count(*) > 1")(lambda s, d: rp.collisions(_keys(s, d)))
query("A34_duplicate_keys", _SQL_KEYS + " select match_key, count(*) as n from keys group by 1 having count(*) > 1")(lambda s, d: _keys(s, d).groupBy("match_key").agg(F.count("*").alias("n")).filter("n > 1"))
on_offers("A10_A11_common_brand", _sql_common("mb", "effective_brand", "brand") + " select component, lower(brand) as brand from mb", lambda c: rs.most_common(c, "effective_brand", "brand", "offers").withColumn("brand", F.lower("brand")), ad.SQL_CLUSTERS)

_REP = ["component", "brand", "category", "canonical_title", "image_url", "ean", "mpn_root", "mpn", "offer_count", "store_count", "min_price", "max_price", "has_available_offer", "needs_review", "review_reason"]
_SQL_REP = ad.SQL_CLUSTERS + "".join(_sql_common(f"c_{a}", v, a) for v, a in (("effective_brand", "brand"), ("category", "category"), ("ean", "ean"), ("mpn_root", "mpn_root"), ("mpn", "mpn"))) + """, rep as (
  select component, arg_min(title, offer_idx) as canonical_title, min(offer_idx) as i0, arg_min(image_url, case when image_url is not null then offer_idx end) as any_image,
    list_sort(list_distinct(list(category) filter (category <> ''))) as cats, count(*) as offer_count, count(distinct store) as store_count, min(price)::double as min_price, max(price)::double as max_price,
    bool_or(available) as has_available_offer from cl group by 1
), prod as (
  select component, lower(c_brand.brand) as brand, c_category.category, canonical_title, coalesce((select image_url from cl where offer_idx = i0), any_image) as image_url, c_ean.ean, c_mpn_root.mpn_root, c_mpn.mpn,
    offer_count, store_count, min_price, max_price, has_available_offer, coalesce(len(cats), 0) > 1 as needs_review,
    case when coalesce(len(cats), 0) > 1 then 'cross-category: [''' || array_to_string(cats, ''', ''') || ''']' end as review_reason
  from rep left join c_brand using (component) left join c_category using (component) left join c_ean using (component) left join c_mpn_root using (component) left join c_mpn using (component)
)"""  # fmt: skip


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rep = rs.representatives(ad.priced(spark, sf_dir))
    return rep.withColumn("min_price", F.col("min_price").cast("double")).withColumn("max_price", F.col("max_price").cast("double")).select(*_REP)


query("A13_W4_representatives", _SQL_REP + f" select {', '.join(_REP)} from prod")(_products)


@query(FLAGSHIP, _SQL_REP + " select component, brand, category, offer_count, store_count, min_price, max_price from prod")
def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = {c: F.col(c).cast("double") for c in ("min_price", "max_price")}
    return rs.summaries(ad.summed(spark, sf_dir)).withColumns(prices)


query("A36_review_reasons", _SQL_REP + " select 'cross-category' as reason, count(*) as n from prod where needs_review having count(*) > 0")(lambda s, d: rp.reason_counts(rs.category_reviews(ad.listed_keys(s, d)).filter("needs_review")))


@query("G5_bridged_clusters", ad.SQL_CLUSTERS + """, was as (select offer_idx, component, min(offer_idx) over (partition by coalesce(mpn_root_key, 'x' || offer_idx)) as old, count(*) over (partition by coalesce(mpn_root_key, 'x' || offer_idx)) as sz from cl),
  gr as (select component, count(distinct old) as parts, count_if(sz = 1) as singles, count(distinct case when sz > 1 then old end) as clusters from was group by 1 having count(distinct old) > 1)
  select *, case when clusters = 0 then 'new' when clusters = 1 then 'grew' else 'bridged' end as kind from gr""")  # fmt: skip
def bridged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all tiers against those of the first tier alone."""
    return rp.grown_from(tr.first_tier(ad.listed_keys(spark, sf_dir)))


# --- reports
on_offers("A18_store_totals", "select store, count(*) as offers from o group by 1", rp.totals)
on_offers("A19_coverage", "select coalesce(store, 'TOTAL') as store, count(*) as offers, count(title_key) as title_key, count(ean_key) as ean_key, count(mpn_root_key) as mpn_root_key, count(mpn_key) as mpn_key, count(good_code) as model_codes from o group by rollup (store)", rp.coverage)
on_offers("A20_block_histogram", """, s as (select count(*) as size from o group by coalesce(category, ''), coalesce(effective_brand, ''))
  select case when size < 2 then '1' when size < 6 then '2-5' when size < 21 then '6-20' when size < 101 then '21-100' when size < 501 then '101-500' else '501+' end as bucket, count(*) as n, sum(size)::bigint as total from s group by 1""", lambda o: rp.histogram(rp.block_sizes(o), "size", (1, 2, 6, 21, 101, 501)))  # fmt: skip
on_offers("K1_largest_blocks", "select coalesce(category, '') as category, coalesce(effective_brand, '') as brand, count(*) as size from o group by 1, 2 order by size desc, 1, 2 limit 25", lambda o: rp.top(rp.block_sizes(o), "size", ["category", "brand"], 25))
on_offers("A21_suspicious_brands", "select store, count_if(is_suspicious_brand) as suspicious, count_if(is_suspicious_brand and brand_from_title is not null) as recoverable, count_if(is_suspicious_brand and brand_from_title is null) as unrecoverable from o group by 1", rp.suspicious_summary)
on_offers("K2_brand_fixes", "select brand_norm, brand_from_title, count(*) as n from o where is_suspicious_brand and brand_from_title is not null group by 1, 2 order by n desc, 1, 2 limit 15", rp.brand_fixes)
on_offers("A22_code_frequency_top", "select code, count(*) as offers from o where good_code is not null group by 1 order by offers desc, code limit 30", lambda o: rp.top(rp.code_counts(o), "offers", ["code"], 30))
on_offers("A23_category_totals", "select coalesce(category, '') as category, count(*) as offers from o group by 1", lambda o: rp.totals(o.withColumn("category", F.coalesce("category", F.lit(""))), "category"))
on_offers("A24_codes_per_offer", "select (good_code is not null)::int as codes, count(*) as offers from o group by 1", rp.codes_per_offer)
on_offers("A25_code_blocks", "select code, count(*) as offers, count(distinct coalesce(category, '') || chr(2) || coalesce(effective_brand, '')) as blocks, count(distinct store) as stores from o where good_code is not null group by 1", rp.code_blocks)
on_offers("A26_good_codes", "select code, count(*) as offers, count(distinct coalesce(category, '') || chr(2) || coalesce(effective_brand, '')) as blocks, count(distinct store) as stores, count(distinct store) >= 2 as bridge from o where good_code is not null group by 1 having count(distinct coalesce(category, '') || chr(2) || coalesce(effective_brand, '')) = 1 and count(*) between 2 and 5", rp.good_codes)
on_offers("A27_store_bridges", "select code, count(distinct store) as stores from o where good_code is not null group by 1 having bool_or(store = 's0') and bool_or(store = 's1')", lambda o: rp.store_bridges(o, "s0", "s1"))
on_offers("A28_matchable_codes", "select coalesce(category, '') as category, coalesce(effective_brand, '') as brand, code, count(*) as offers from o where good_code is not null group by 1, 2, 3 having count(*) > 1", rp.matchable_codes)
on_offers("A32_multi_identifier_clusters", "select component, count(distinct mpn_root) as roots, count(distinct ean) as eans from cl group by 1 having count(distinct mpn_root) > 1 or count(distinct ean) > 1", lambda c: c.groupBy("component").agg(F.count_distinct("mpn_root").alias("roots"), F.count_distinct("ean").alias("eans")).filter("roots > 1 or eans > 1"), ad.SQL_CLUSTERS)
on_offers("A33_language_clusters", "select component, 'EN' as langs, count(distinct store) as stores from cl group by 1 having count(distinct store) > 1", rp.languages, ad.SQL_CLUSTERS, texts=True)
on_offers("A35_store_count", "select component, count(distinct store) as stores from cl group by 1", rp.store_counts, ad.SQL_CLUSTERS)
on_offers("A37_blocked_codes", "select distinct code, 'suffix' as kind from o where code = '770nc'", rp.blocked_codes)
on_offers("A38_identifier_sources", "select identifier_source, count(*) as n, round(count(*) * 100.0 / sum(count(*)) over (), 2)::double as pct from o group by 1", lambda o: rp.shares(o, "identifier_source").withColumn("pct", F.col("pct").cast("double")))
on_offers("A39_mpn_stats", "select store, count(mpn) as present, count_if(mpn is null) as missing, count_if(mpn <> mpn_root) as shortened from o group by 1", lambda o: o.groupBy("store").agg(F.count("mpn").alias("present"), F.count_if(F.col("mpn").isNull()).alias("missing"), F.count_if(F.col("mpn") != F.col("mpn_root")).alias("shortened")))
on_offers("A40_missing_bucket", "select coalesce(vendor, '<missing>') as vendor, count(*) as n from o group by 1", lambda o: o.groupBy(F.coalesce("vendor", F.lit("<missing>")).alias("vendor")).agg(F.count("*").alias("n")))
on_offers("A16_product_types", "select coalesce(nullif(trim(product_type), ''), '(empty)') as product_type, count(*) as n from o group by 1", lambda o: o.groupBy(F.coalesce(F.nullif(F.trim("product_type"), F.lit("")), F.lit("(empty)")).alias("product_type")).agg(F.count("*").alias("n")))
on_offers("A17_category_fill", "select coalesce(category, '(excluded)') as category, count(*) as rows, sum(n)::bigint as products from (select category, product_type, store, count(*) as n from o group by 1, 2, 3) group by 1", lambda o: rp.category_fill(o.groupBy("category", "product_type", "store").agg(F.count("*").cast("string").alias("product_count"))))
on_offers("K4_excluded_types", "select store, product_type, count(*) as n from o where category is null group by 1, 2 order by n desc, store, product_type limit 25", lambda o: rp.top(o.filter("category is null").groupBy("store", "product_type").agg(F.count("*").alias("n")), "n", ["store", "product_type"], 25))
on_offers("K7_first_rows", "select offer_idx, store from o order by offer_idx limit 5", lambda o: o.select("offer_idx", "store").orderBy("offer_idx").limit(5))
on_offers("W7_diverse_sample", ", f as (select product_type, min(offer_idx) as offer_idx from o group by 1) select offer_idx, product_type from f order by offer_idx limit 5", lambda o: rp.diverse_sample(o.select("offer_idx", "product_type"), "product_type", "offer_idx"))
on_offers("W3_first_per_key", "select vendor, min(offer_idx) as offer_idx from o where vendor is not null group by 1", lambda o: rd.first_per_key(o.filter("vendor is not null").select("vendor", "offer_idx", F.col("offer_idx").alias("ordinal")), ["vendor"]).select("vendor", "offer_idx"))
on_offers("W2_last_per_key", "select vendor, max(offer_idx) as offer_idx from o where vendor is not null group by 1", lambda o: rd.last_per_key(o.filter("vendor is not null").select("vendor", "offer_idx", F.col("offer_idx").alias("ordinal")), ["vendor"]).select("vendor", "offer_idx"))
on_offers("F3_store_gate", "select store, count(*) as n, count(*) >= 8000 // 2 as passed from o group by 1", lambda o: ig.sane_stores(o.groupBy("store").agg(F.count("*").alias("count")), o.select("store").distinct().withColumn("expected", F.lit(8000))).select("store", F.col("count").alias("n"), "passed"))
on_offers("J7_unmapped", "select distinct store, product_type from o where category is null", lambda o: ig.unmapped(o, o.filter("category is not null").select("store", F.col("product_type").alias("raw_product_type")).distinct()))
on_offers("J5_J6_fingerprint_join", "select product_type, lower(product_type) as fingerprint, count(*) as n from o group by 1", lambda o: o.groupBy("product_type").agg(F.count("*").alias("n")).select("product_type", tx.fingerprint(F.col("product_type")).alias("fingerprint"), "n"))


# --- snapshots
def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The state after an early snapshot, and the rows of a late one that saw most offers."""
    old = ad.versions(spark, sf_dir, ad.CUTOFF).filter("category is not null").withColumnRenamed("price", "current_price")
    early = F.lit("2000-01-01").cast("timestamp")
    state = old.select(*ig.KEY, *ig.FIELDS, early.alias("first_seen_at"), early.alias("last_scraped_at"), early.alias("last_changed_at"))
    new = ad.versions(spark, sf_dir).filter(F.split("store_product_id", "-")[0].cast("bigint") % 11 != 0)
    return state, new


def _after(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    state, new = _snapshots(spark, sf_dir)
    now = F.lit("2002-01-01").cast("timestamp")
    done = ig.mark_disappeared(ig.upsert(state, new, now), new, now, new)
    return new, done


_SQL_AFTER = ad.SQL_SNAPSHOTS + """, st as (
  select coalesce(n.store, p.store) as store, coalesce(n.store_product_id, p.store_product_id) as store_product_id, coalesce(n.price, p.price)::double as price,
    case when n.k is null then p.available and s.k is not null else n.available end as available,
    case when n.k is not null and p.k is null then 'inserted' when n.k is not null and (n.price is distinct from p.price or n.available is distinct from p.available) then 'changed'
      when n.k is not null then 'unchanged' when p.available and s.k is null then 'disappeared' else 'untouched' end as change
  from old0 p full join new0 n on p.store = n.store and p.store_product_id = n.store_product_id
  left join scraped s on s.store = p.store and s.store_product_id = p.store_product_id
)"""  # fmt: skip


@query("U1_U3_J3_upsert", _SQL_AFTER + " select store, store_product_id, price, available, change from st")
def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _after(spark, sf_dir)[1].select(*ig.KEY, F.col("current_price").cast("double").alias("price"), "available", "change")


@query("U2_price_history", _SQL_AFTER + " select store, store_product_id, price, available from st where change in ('inserted', 'changed', 'disappeared')")
def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ig.history(_after(spark, sf_dir)[1], F.lit("2002-01-01").cast("timestamp"))
    return rows.select(*ig.KEY, F.col("price").cast("double").alias("price"), "available")


@query("A14_A15_F1_counters", _SQL_AFTER + """, d as (select store, count_if(change = 'inserted') as inserted, count_if(change = 'changed') as changed, count_if(change = 'unchanged') as unchanged, count_if(change = 'disappeared') as disappeared from st group by 1)
  select d.*, coalesce((select count(*) from scraped s where s.store = d.store and s.category is null), 0) as skipped from d""")  # fmt: skip
def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ig.counters(*_after(spark, sf_dir))


@query("J4_disappeared", _SQL_AFTER + " select store, store_product_id from st where change = 'disappeared'")
def disappeared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _after(spark, sf_dir)[1].filter("change = 'disappeared'").select(*ig.KEY)


@query("W6_F10_change_log", "select user_id, event_type, count(*) as n, count_if(v is distinct from p) as changes from (select user_id, event_type, value as v, lag(value) over (partition by user_id, event_type order by ts, event_id) as p from events) group by 1, 2")
def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    v = F.col("value")
    order = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    log = ad.table(spark, sf_dir, "events").select("user_id", "event_type", v.alias("v"), F.lag(v).over(order).alias("p"))
    return log.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.count_if(~F.col("v").eqNullSafe(F.col("p"))).alias("changes"))


# --- identity against an existing catalog
def _catalog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Links of two thirds of the parts, with all their offers, to the product of their number, and a catalog of those keys."""
    part = F.col("p_partkey")
    linked = ad.table(spark, sf_dir, "part").filter(part % 3 != 0).select("p_partkey", (F.floor(part / 2) + 1).cast("bigint").alias("product_id"))
    products = _keys(spark, sf_dir).filter("component % 2 = 0").select((F.col("component") + 1_000_000).alias("id"), "match_key")
    return linked, products


_SQL_IDENTITY = _SQL_KEYS + """, lk as (select component, list_sort(list_distinct(list(k // 2 + 1))) as ids from cl where k % 3 <> 0 group by 1),
hit as (select match_key, list_sort(list_distinct(list(component + 1000000))) as hits from keys where component % 2 = 0 group by 1),
dec as (select component, match_key, coalesce(len(ids), 0) as n, coalesce(len(hits), 0) as m, ids, hits from keys left join lk using (component) left join hit using (match_key)),
res as (select component, case when n = 1 then 'attached' when n > 1 then 'merged' when m = 1 then 'key_lookup' when m > 1 then 'ambiguous_key' else 'new' end as resolution,
  case when n >= 1 then ids[1] when m >= 1 then hits[1] end as product_id, case when n > 1 then array_to_string(ids[2:], ',') else '' end as absorbed, ids from dec)"""  # fmt: skip


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad._kept(spark, sf_dir, "decisions", lambda: rs.resolve_identity(ad.listed_keys(spark, sf_dir), _keys(spark, sf_dir), *_catalog(spark, sf_dir), by=("p_partkey",)))


@query("U5_J8_J9_identity", _SQL_IDENTITY + " select component, resolution, product_id, absorbed from res")
def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decisions(spark, sf_dir).select("component", "resolution", "product_id", F.array_join("absorbed", ",").alias("absorbed"))


@query("U6_W5_collision_merge", _SQL_IDENTITY + """, sz as (select component, resolution, product_id, count(*) as size from cl join res using (component) group by all),
  w as (select *, first_value(component) over (partition by coalesce(product_id, -component - 1) order by size desc, component) as winner, count(*) over (partition by coalesce(product_id, -component - 1)) as merged from sz)
  select winner as component, any_value(merged) as clusters_merged, sum(size)::bigint as offers from w group by 1""")  # fmt: skip
def collision_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = rs.merge_collisions(ad.listed_keys(spark, sf_dir), _decisions(spark, sf_dir).select("component", "product_id"))
    return merged.groupBy("component").agg(F.first("clusters_merged").alias("clusters_merged"), F.sum("offers").alias("offers"))


@query("J17_attach_or_create", _SQL_IDENTITY + " select count(*) filter (resolution = 'key_lookup' or resolution = 'ambiguous_key') as would_attach, count(*) filter (resolution = 'new') as would_create from res")
def attach_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("resolution")
    return _decisions(spark, sf_dir).agg(F.count_if(kind.isin("key_lookup", "ambiguous_key")).alias("would_attach"), F.count_if(kind == "new").alias("would_create"))


@query("U8_J12_absorbed", _SQL_IDENTITY + ", ab as (select product_id as survivor, unnest(ids[2:]) as absorbed from res where resolution = 'merged') select survivor, absorbed from ab where absorbed % 2 = 0")
def absorbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absorbed products with odd ids are still pointed at, so they stay."""
    still = _decisions(spark, sf_dir).select(F.explode("absorbed").alias("product_id")).filter("product_id % 2 = 1")
    return ct.absorbed_pairs(_decisions(spark, sf_dir), still)


@query("G6_redirects", _SQL_IDENTITY + """, ab as (select distinct product_id as survivor, unnest(ids[2:]) as absorbed from res where resolution = 'merged'), one as (select absorbed, min(survivor) as survivor from ab group by 1)
  select -absorbed as old_id, survivor as new_id from one union all select absorbed, survivor from one""")  # fmt: skip
def redirected(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _decisions(spark, sf_dir).filter("resolution = 'merged'").select(F.col("product_id").alias("survivor"), F.explode("absorbed").alias("absorbed"))
    pairs = pairs.groupBy("absorbed").agg(F.min("survivor").alias("survivor"))
    before = pairs.select((-F.col("absorbed")).alias("old_id"), F.col("absorbed").alias("new_id"))
    return ct.redirects(before, pairs)


@query("U7_new_ids", _SQL_IDENTITY + " select component, 5000000 + row_number() over (order by component) - 1 as product_id from res where resolution = 'new'")
def minted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ct.new_ids(_decisions(spark, sf_dir).filter("resolution = 'new'").select("component"), 5_000_000)


# --- documents, pages and events
@query("P11_P27_page_fields", r"""select page_id, trim(replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), ' ') as title,
  split_part(split_part(url, '://', 2), '/', 1) as host from pages""")  # fmt: skip
def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.split_part(F.split_part(F.col("url"), F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))
    return ad.table(spark, sf_dir, "pages").select("page_id", ex.page_title(F.col("html")).alias("title"), host.alias("host"))


@query("P27_url_ids", r"""with u as (select p_partkey, p_partkey % 4 as c, case when p_partkey % 3 = 0 then 'x' || p_partkey else p_partkey::varchar end as last from part)
  select p_partkey, coalesce(case when p_partkey % 3 > 0 then last end, last) as id, case when p_partkey % 3 > 0 then last end as number, case c when 0 then 'gaming' when 1 then 'ihos' when 2 then 'books' else 'toys' end as category, c < 2 as wanted from u""")  # fmt: skip
def url_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and top-level categories of one address per part; two of four categories are wanted."""
    k = F.col("p_partkey")
    kind = F.get(F.array(*[F.lit(c) for c in ("gaming", "ihos", "books", "toys")]), (k % 4).cast("int"))
    url = F.concat(F.lit("https://p.example/product/"), kind, F.lit("/products/"), F.when(k % 3 == 0, "x").otherwise(""), k.cast("string"))
    category = ex.top_category(url, "https://p.example")
    return _parts(spark, sf_dir).select("p_partkey", ex.id_after_products(url).alias("id"), ex.numeric_id(F.concat(url, F.lit("/"))).alias("number"), category.alias("category"), category.isin("gaming", "ihos").alias("wanted"))


@query("P11_breadcrumbs", r"""select page_id, len(regexp_extract_all(html, '(?is)<a[^>]*href="[^"]*"[^>]*>[^<]*</a>')) as links from pages""")
def crumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.regexp_extract_all("html", F.lit(r'(?is)<a[^>]*href="[^"]*"[^>]*>[^<]*</a>'), F.lit(0))
    return ad.table(spark, sf_dir, "pages").select("page_id", F.size(links).alias("links"))


@query("P17_P19_event_props", """select event_id, try_cast(json_extract_string(props, '$.k') as integer) as k, case when try_cast(json_extract_string(props, '$.k') as double) > 50 then 'k' else 'none' end as source from events""")
def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.get_json_object("props", "$.k")
    price = ex.select_price([("k", (raw.try_cast("decimal(18,4)") - 50).cast("string"))])
    return ad.table(spark, sf_dir, "events").select("event_id", raw.try_cast("int").alias("k"), price["source"].alias("source"))


@query("N4_N12_first_lines", "select doc_id, split_part(text, chr(10), 1) as title, substr(sha1(split_part(text, chr(10), 1)), 1, 12) as h from documents")
def first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.split_part(F.col("text"), F.lit("\n"), F.lit(1))
    return ad.table(spark, sf_dir, "documents").select("doc_id", title.alias("title"), tx.title_hash(title).alias("h"))


# --- more joins and mutations
def _mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(store, raw_product_type, category) of two product types, in even stores only."""
    pairs = ad.offers(spark, sf_dir).filter("store in ('s0', 's2', 's4') and product_type in ('SMALL', 'LARGE')")
    return pairs.select("store", F.col("product_type").alias("raw_product_type"), F.lower("product_type").alias("category")).distinct()


@query("J1_category_join", f"{ad.SQL_OFFERS} select offer_idx, case when store in ('s0', 's2', 's4') and product_type in ('SMALL', 'LARGE') then lower(product_type) end as category from o")
def category_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ig.with_category(ad.offers(spark, sf_dir), _mapping(spark, sf_dir)).select("offer_idx", "category")


@query("U4_mapping_upsert", f"{ad.SQL_OFFERS} select distinct store, product_type as raw_product_type, case when store in ('s0', 's2', 's4') and product_type in ('SMALL', 'LARGE') then lower(product_type) else 'old' end as category from o")
def mapping_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = ad.offers(spark, sf_dir).select("store", F.col("product_type").alias("raw_product_type"), F.lit("old").alias("category")).distinct()
    return ig.upsert_mapping(old, _mapping(spark, sf_dir))


@query("S15_retry_merge", f"{ad.SQL_OFFERS} select store, store_product_id, case when k % 13 = 0 then 'again' else vendor end as vendor from o")
def retry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.offers(spark, sf_dir).select("store", "store_product_id", "vendor")
    again = rows.filter(F.split("store_product_id", "-")[0].cast("bigint") % 13 == 0).withColumn("vendor", F.lit("again"))
    return rd.merge_retry(rows, again, ig.KEY)


@query("S14_failed_keys", f"{ad.SQL_OFFERS} select store, store_product_id from o where k % 13 <> 0")
def failed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.offers(spark, sf_dir)
    return rd.failed_keys(rows.select(*ig.KEY), rows.filter(F.split("store_product_id", "-")[0].cast("bigint") % 13 == 0), ig.KEY)


@query("J11_link_offers", _SQL_IDENTITY + " select store, store_product_id, coalesce(product_id, -1) as product_id, case when product_id is null then 'unmatched' else 'linked' end as match_method from cl join res using (component)")
def link_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = ad.assigned(spark, sf_dir).select(*ig.KEY, "component", F.lit(-1).cast("bigint").alias("product_id"), F.lit("unmatched").alias("match_method"))
    links = _decisions(spark, sf_dir).filter("product_id is not null").select("component", "product_id", F.lit("linked").alias("match_method"))
    return ct.link_offers(state, links, by=("component",)).drop("component")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each absorbed product with its smallest survivor."""
    merged = _decisions(spark, sf_dir).filter("resolution = 'merged'").select(F.col("product_id").alias("survivor"), F.explode("absorbed").alias("absorbed"))
    survivors = merged.select(F.col("survivor").alias("absorbed")).distinct()
    return merged.groupBy("absorbed").agg(F.min("survivor").alias("survivor")).join(survivors, "absorbed", "left_anti")


_SQL_PAIRS = _SQL_IDENTITY + """, ab as (select product_id as survivor, unnest(ids[2:]) as absorbed from res where resolution = 'merged'),
pr as (select absorbed, min(survivor) as survivor from ab where absorbed not in (select survivor from ab) group by 1)"""  # fmt: skip


@query("U8_J13_subscriptions", _SQL_PAIRS + """, subs as (select 'u' || (absorbed % 7) as email, absorbed as product_id from pr union select 'u0', survivor from pr)
  select distinct email, coalesce(survivor, product_id) as product_id from subs left join pr on pr.absorbed = subs.product_id""")  # fmt: skip
def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir)
    subs = pairs.select(F.concat(F.lit("u"), F.col("absorbed") % 7).alias("email"), F.col("absorbed").alias("product_id"))
    subs = subs.unionByName(pairs.select(F.lit("u0").alias("email"), F.col("survivor").alias("product_id"))).distinct()
    return ct.repoint_subscriptions(subs, pairs)


@query("U8_delete_absorbed", _SQL_PAIRS + " select distinct product_id as id from res where product_id is not null and product_id not in (select absorbed from pr)")
def delete_absorbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = _decisions(spark, sf_dir).filter("product_id is not null").select(F.col("product_id").alias("id")).distinct()
    return ct.delete_absorbed(products, _pairs(spark, sf_dir))


@query("J14_store_count_backfill", f"{ad.SQL_OFFERS} select k as id, count(distinct store) as store_count from o group by 1 having count(distinct store) <> 3")
def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = ad.offers(spark, sf_dir).select("store", F.split("store_product_id", "-")[0].cast("bigint").alias("product_id"))
    return ct.store_counts(state.select(F.col("product_id").alias("id"), F.lit(3).cast("bigint").alias("store_count")).distinct(), state)


@query("P28_J19_phase_two", f"{ad.SQL_OFFERS} select offer_idx, case when k % 17 = 0 and product_type = 'SMALL' then true else available end as available from o")
def phase_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.offers(spark, sf_dir)
    part = F.split("store_product_id", "-")[0].cast("bigint")
    statuses = rows.filter(part % 17 == 0).select("store_product_id", ex.status_available(F.lit("ON_ORDER")).alias("status_available")).distinct()
    return ig.phase_two(rows, rows.filter(part % 17 == 0), rows.filter("product_type = 'SMALL'"), statuses, 1_000_000).select("offer_idx", "available")


@query("J2_history_join", _SQL_AFTER + " select s.store, count(*) as n from st join scraped s using (store, store_product_id) where st.change in ('inserted', 'changed') group by 1")
def history_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, done = _after(spark, sf_dir)
    return done.filter("change in ('inserted', 'changed')").join(new.select(*ig.KEY), ig.KEY).groupBy("store").agg(F.count("*").alias("n"))


@query("P23_availability", f"{ad.SQL_OFFERS} select offer_idx, available as in_stock from o")
def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("available"), "https://schema.org/InStock").otherwise("https://schema.org/SoldOut")
    return ad.offers(spark, sf_dir).select("offer_idx", ex.in_stock(text).alias("in_stock"))


@query("G5_tier_prefix_components", f"{ad.SQL_OFFERS} select offer_idx, min(offer_idx) over (partition by coalesce(mpn_root_key, 'x' || offer_idx)) as component from o")
def first_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.first_tier(ad.offers(spark, sf_dir)).select("offer_idx", F.col("old").alias("component"))


@query("G7_bridged_stores", ad.SQL_CLUSTERS + """, was as (select *, min(offer_idx) over (partition by coalesce(mpn_root_key, 'x' || offer_idx)) as old from cl)
  select component from was where store in ('s0', 's1') group by 1 having bool_or(store = 's0') and bool_or(store = 's1')
    and not list_has_any(list(old) filter (store = 's0'), list(old) filter (store = 's1'))""")  # fmt: skip
def bridged_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters that join two stores whose offers were apart after the first tier."""
    rows = tr.first_tier(ad.listed_keys(spark, sf_dir))
    both = rows.select("component", "old", tr.each_store(rows).alias("store")).filter(F.col("store").isin("s0", "s1"))
    sides = both.groupBy("component", "old").agg(*[F.max((F.col("store") == s).cast("int")).alias(s) for s in ("s0", "s1")])
    found = sides.groupBy("component").agg(F.max("s0").alias("s0"), F.max("s1").alias("s1"), F.max(F.when(F.col("old").isNull(), 0).otherwise(F.col("s0") * F.col("s1"))).alias("shared"))
    return found.filter("s0 = 1 and s1 = 1 and shared = 0").select("component")


# --- source documents: fields of pages and listings made from the parts
def _number() -> Column:
    return F.col("p_partkey").cast("string")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.table(spark, sf_dir, "part")


@query("P1_variant_titles", """select p_partkey, p_name as title from part union all select p_partkey, p_name from part union all select p_partkey, p_name || ' – ' || p_size || 'GB' from part""")
def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = F.explode(F.array(F.lit("Default Title"), F.lit(""), F.concat("p_size", F.lit("GB"))))
    return _parts(spark, sf_dir).select("p_partkey", "p_name", each.alias("variant")).select("p_partkey", ex.variant_title(F.col("p_name"), F.col("variant")).alias("title"))


@query("P2_P3_part_numbers", """select p_partkey, case when p_size % 3 <> 0 then p_brand end as sku,
  case p_partkey % 3 when 0 then 'N' || p_partkey when 1 then 'bar' || p_partkey end as mpn from part""")  # fmt: skip
def part_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    article = F.concat(F.lit("A"), _number())
    listed = F.expr("CASE p_partkey % 3 WHEN 0 THEN concat(' ;A', p_partkey, '; N', p_partkey, ' ;x') WHEN 1 THEN concat('A', p_partkey, ';') END")
    barcodes = F.expr("CASE WHEN p_partkey % 3 < 2 THEN concat(';bar', p_partkey, ';other') END")
    sku = F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_brand"))
    return _parts(spark, sf_dir).select("p_partkey", ex.mpn_from_sku(sku).alias("sku"), ex.mpn_from_lists(listed, barcodes, article).alias("mpn"))


@query("P4_bracketed_mpn", "select p_partkey, case when p_partkey % 3 > 0 then 'AB-' || lpad(p_partkey::varchar, 7, '0') end as mpn from part")
def bracketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat(F.lit(" (AB-"), F.lpad(_number(), 7, "0"), F.lit(")"))
    more = F.expr("CASE p_partkey % 3 WHEN 1 THEN ' (1234567)' WHEN 2 THEN ' (ABCDEFG) (X1)' ELSE ' (1234567)' END")
    title = F.concat("p_name", F.when(F.col("p_partkey") % 3 > 0, F.concat(F.lit(" (OLD-1)"), code)).otherwise(""), more)
    return _parts(spark, sf_dir).select("p_partkey", ex.mpn_in_brackets(title).alias("mpn"))


@query("P7_P8_json_ld", "select p_partkey, case when p_partkey % 4 < 3 then p_partkey::varchar end as sku from part")
def linked_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = lambda kind: F.concat(F.lit('{"@context":"https://schema.org","@type":' + kind + ',"sku":"'), _number(), F.lit('"}'))
    block = lambda body: F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    graph = F.concat(F.lit('{"@context":"https://schema.org","@graph":['), item('"WebPage"'), F.lit(","), item('["Thing","Product"]'), F.lit("]}"))
    k = F.col("p_partkey") % 4
    html = F.concat(F.lit("<html>"), block(item('"Organization"')), F.when(k == 0, block(item('"Product"'))).when(k == 1, block(graph)).when(k == 2, block(item('["Product"]'))).otherwise(block(item('"Productions"'))))
    return _parts(spark, sf_dir).select("p_partkey", F.get_json_object(ex.json_ld(html), "$.sku").alias("sku"))


@query("P9_P10_embedded_json", "select p_partkey, case when p_partkey % 5 > 0 then p_partkey::varchar end as id, case when p_partkey % 5 > 0 then '}{ ' || p_name end as note from part")
def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(F.lit('{"a":{"b":[1,{}]},"note":"}{ '), "p_name", F.lit('","id":'), _number(), F.lit("}"))
    html = F.concat(F.lit('<script id="__NEXT_DATA__" type="x">'), F.when(F.col("p_partkey") % 5 > 0, body).otherwise('{"id":'), F.lit("</script>{}"))
    found = ex.embedded_json(html, 'id="__NEXT_DATA__"')
    return _parts(spark, sf_dir).select("p_partkey", found.alias("body")).select("p_partkey", F.get_json_object("body", "$.id").alias("id"), F.get_json_object("body", "$.note").alias("note"))


@query("P12_P13_P14_P15_crumbs_and_titles", """select p_partkey, p_brand as tail, p_name || ' & more' as previous, p_brand as deepest, p_name || ' & Co' as title,
  case when p_partkey % 2 = 0 then 'https://shop.example/i/' else 'https://img/' end || p_partkey as image from part""")  # fmt: skip
def crumb_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = ex.unescape(F.concat(F.lit("Top &gt; "), "p_name", F.lit(" &#62; "), "p_brand", F.lit(" ")))
    html = F.concat(F.lit('<a href="/">Top</a><a class="c" href="/x"> '), "p_name", F.lit(' &amp; more</a><a href="/y">'), "p_brand", F.lit("</a>"))
    title = ex.without_suffix(ex.unescape(F.concat("p_name", F.lit(" &amp; Co - SHOP "))), "Shop")
    even = F.concat(F.lit('<meta property="og:image" content="/i/'), _number(), F.lit('"/>'))
    odd = F.concat(F.lit('<META content="https://img/'), _number(), F.lit('" property="og:image">'))
    image = ex.og_image(F.when(F.col("p_partkey") % 2 == 0, even).otherwise(odd), "https://shop.example")
    crumbs = ex.breadcrumbs(html)
    return _parts(spark, sf_dir).select("p_partkey", ex.path_tail(path).alias("tail"), ex.second_to_last(crumbs).alias("previous"), ex.deepest(crumbs).alias("deepest"), title.alias("title"), image.alias("image"))


@query("P17_P18_P25_attributes", """select p_partkey, p_brand as brand, 'M' || p_partkey as mpn, case when p_partkey % 3 = 0 then lpad(p_partkey::varchar, 13, '0') end as ean from part""")
def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = lambda v: F.array(F.struct(v.alias("value")))
    listed = F.array(F.struct(F.lit("size").alias("identifier"), value(F.lit("1")).alias("values")), F.struct(F.lit("brand").alias("identifier"), value(F.col("p_brand")).alias("values")))
    labels = F.array(F.struct(F.lit(1).alias("id"), F.lit("Colour").alias("label")), F.struct(F.lit(2).alias("id"), F.lit(" MPN").alias("label")), F.struct(F.lit(3).alias("id"), F.lit("Part No").alias("label")))
    values = F.array(*[F.struct(F.lit(i).alias("id"), v.alias("value")) for i, v in ((1, F.lit("red")), (2, F.lit("  ")), (3, F.concat(F.lit(" M"), _number())))])
    own = F.when(F.col("p_partkey") % 3 == 0, F.lpad(_number(), 13, "0")).when(F.col("p_partkey") % 3 == 1, "1234567").otherwise("12345678x")
    specs = F.array(F.struct(F.lit("Weight").alias("name"), F.lit("12345678").alias("value")), F.struct(F.lit("EAN").alias("name"), own.alias("value")), F.struct(F.lit("ean").alias("name"), F.lit("99999999").alias("value")))
    return _parts(spark, sf_dir).select("p_partkey", ex.attribute(listed, "brand").alias("brand"), ex.labelled_value(values, labels, ("mpn", "part no")).alias("mpn"), ex.ean_from_specs(specs).alias("ean"))


@query("P21_P22_P24_availability", """select p_partkey, p_partkey % 4 = 0 as orderable, p_size % 4 in (0, 1) as listed, p_partkey % 3 = 1 as by_status from part""")
def availability_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey") % 4, F.col("p_size") % 4
    buyable = F.when(k < 2, "True").when(k == 2, "false")
    flag = F.when(k == 1, "false")
    text, count = F.when(n == 0, " In Stock ").when(n == 2, "sold out"), F.when(n == 1, 2).when(n == 3, 0)
    status = F.when(F.col("p_partkey") % 3 == 1, "LAST_PIECES").when(F.col("p_partkey") % 3 == 2, "GONE")
    return _parts(spark, sf_dir).select("p_partkey", ex.orderable(buyable, flag).alias("orderable"), ex.available_text(text, count, ("in stock",)).alias("listed"), ex.status_available(status).alias("by_status"))


@query("N21_fingerprint", "select p_partkey, 'thikipsomi' || regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') as fp from part")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir).select("p_partkey", tx.fingerprint(F.concat(F.lit("Θήκη, ψωμί: "), "p_name")).alias("fp"))


@query("N23_percent", "select p_type, case when count(*) filter (where p_size = 0) = 0 then '0.0%' end as none, '100.0%' as every from part group by p_type")
def percents(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _parts(spark, sf_dir).groupBy("p_type").agg(F.count(F.when(F.col("p_size") == 0, 1)).alias("zero"), F.count("*").alias("n"))
    return counted.select("p_type", tx.percent(F.col("n"), F.col("zero")).alias("none"), tx.percent(F.col("n"), F.col("n")).alias("every"))


# --- sources and sinks: files written to the scratch folder and read again
def _written(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@query("S1_S3_store_files", "select 'n' as store, n_nationkey::varchar as store_product_id, n_name as title, (n_nationkey + 0.5)::double as price, cast(null as varchar) as ean from nation")
def store_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON array of the 25 nations, beside a missing file."""
    row = F.struct(F.lit("n").alias("store"), F.col("n_nationkey").cast("string").alias("store_product_id"), F.col("n_name").alias("title"), (F.col("n_nationkey") + 0.5).alias("price"))
    path = _written(spark, "store-file")
    ad.table(spark, sf_dir, "nation").agg(F.to_json(F.collect_list(row)).alias("value")).write.text(path)
    found = rd.store_files(spark, [path, f"{path}-missing"])
    return found.select("store", "store_product_id", "title", F.col("price").cast("double").alias("price"), "ean")


@query("S4_F2_category_map", """select 's' || (p_partkey % 3) as store, p_type as raw_product_type, case when max(p_partkey) % 2 = 0 then 'even' else 'odd' end as category
  from part where p_partkey % 7 <> 0 group by 1, 2""")  # fmt: skip
def category_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    category = F.when(k % 7 == 0, " ").when(k % 2 == 0, " even").otherwise("odd ")
    store, kind = F.concat(F.lit(" s"), (k % 3).cast("string")), F.concat("p_type", F.lit(" "))
    return rd.category_map(_parts(spark, sf_dir).select(store.alias("store"), kind.alias("raw_product_type"), category.alias("canonical_category"), k.alias("ordinal")), ("even", "odd"))


@query("S5_csv_sink", "select c_custkey, c_name || ', \"' || c_mktsegment || '\"' as label from customer")
def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(spark, "csv")
    label = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))
    rd.write_csv(ad.table(spark, sf_dir, "customer").select("c_custkey", label.alias("label")), path)
    return spark.read.schema("c_custkey bigint, label string").option("header", True).csv(path)


@query("S12_json_sink", "select s_suppkey, case when s_suppkey % 3 = 0 then null else s_name || ' é' end as label, s_acctbal as price from supplier")
def json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(spark, "json")
    label = F.when(F.col("s_suppkey") % 3 != 0, F.concat("s_name", F.lit(" é")))
    rd.write_json(ad.table(spark, sf_dir, "supplier").select("s_suppkey", label.alias("label"), F.col("s_acctbal").alias("price")), path)
    return spark.read.schema("s_suppkey bigint, label string, price double").json(path)


@query("S8_sitemap", """select url, min(ordinal) as ordinal, arg_min(pos, ordinal) as pos from (
  select 'https://p/' || (p_partkey % 500) as url, p_partkey as ordinal, 0 as pos from part union all select 'https://q/' || p_partkey, p_partkey, 1 from part) group by url""")  # fmt: skip
def sitemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    loc = lambda host, n: F.concat(F.lit(f"<url><loc> https://{host}/"), n.cast("string"), F.lit("</loc></url>"))
    body = F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), loc("p", F.col("p_partkey") % 500), loc("q", F.col("p_partkey")), F.lit("</urlset>"))
    return rd.sitemap_urls(_parts(spark, sf_dir).select(F.col("p_partkey").alias("ordinal"), body.alias("body")))


@query("S8_sitemap_index", """select 'https://p/en/products/' || p_partkey as url, (p_partkey // 50) % 20 as sub, count(*) over () as urls from part where (p_partkey // 50) % 20 % 3 <> 1 and p_partkey % 2 = 0""")
def sitemap_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty sitemaps under one index, a third of them of other things; half of the addresses are in another language."""
    k = F.col("p_partkey")
    sub = F.floor(k / 50) % 20
    name = F.concat(F.when(sub % 3 == 1, "post").otherwise("product"), F.lit("-sitemap"), sub.cast("string"), F.lit(".xml"))
    url = F.concat(F.lit("https://p/"), F.when(k % 2 == 0, "en").otherwise("el"), F.lit("/products/"), k.cast("string"))
    image = "<i:image><i:loc>https://p/en/products/9</i:loc></i:image>"
    entry = F.concat(F.lit("<url><loc>"), url, F.lit(f"</loc>{image}</url>"))
    head = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:i="http://x/image"'
    body = F.concat(F.lit(f"<urlset {head}>"), F.array_join(F.collect_list(entry), ""), F.lit("</urlset>"))
    maps = _parts(spark, sf_dir).groupBy(name.alias("path"), sub.alias("sub")).agg(body.alias("body"))
    each = F.transform(F.sort_array(F.collect_list(F.struct("sub", "path"))), lambda x: F.concat(F.lit("<sitemap><loc>"), x["path"], F.lit("</loc></sitemap>")))
    index = maps.groupBy().agg(F.concat(F.lit(f"<sitemapindex {head}>"), F.array_join(each, ""), F.lit("</sitemapindex>")).alias("body"))
    files = maps.select("path", "body").unionByName(index.select(F.lit("index").alias("path"), "body"))
    urls = rd.sitemap_urls(rd.sub_sitemaps(files, "index", "product-sitemap"), "/en/products/[0-9]+$")
    number = F.split_part("url", F.lit("/"), F.lit(-1)).cast("bigint")
    counted = urls.agg(F.count("*").alias("urls"))
    return urls.select("url", (F.floor(number / 50) % 20).alias("sub")).crossJoin(F.broadcast(counted))


@query("S9_gzip_or_plain", "select n_name as line, 2 as files from nation")
def gzip_or_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 nations as gzip and as plain text, read by content."""
    names, path = ad.table(spark, sf_dir, "nation").select("n_name"), _written(spark, "mixed")
    names.write.option("compression", "gzip").text(f"{path}/zipped")
    names.write.text(f"{path}/plain")
    files = spark.read.format("binaryFile").load([f"{path}/zipped", f"{path}/plain"])
    lines = rd.maybe_gzip(files).select("path", F.explode(F.split("body", "\n")).alias("line")).filter("line <> ''")
    return lines.groupBy("line").agg(F.count_distinct(F.element_at(F.split("path", "/"), -2)).cast("int").alias("files"))


@query("S10_pages_until_empty", """select 'a' || (c_custkey % 50) as id, 'v' || min(c_custkey) as v from customer where c_custkey < 97 group by 1
  union all select 'b' || c_custkey, 'w' || c_custkey from customer where c_custkey < 97""")  # fmt: skip
def paginated(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    item = lambda a, b: F.struct(a.alias("id"), b.alias("v"))
    both = F.array(item(F.concat(F.lit("a"), (F.col("c_custkey") % 50).cast("string")), F.concat(F.lit("v"), k)), item(F.concat(F.lit("b"), k), F.concat(F.lit("w"), k)))
    pages = ad.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("page"), F.when(F.col("c_custkey") % 100 != 97, both).alias("items"))
    return rd.pages_until_empty(pages).select("id", F.col("item.v").alias("v"))


@query("S10_paged_listings", """with p as (select c_custkey // 40 as listing, c_custkey % 40 + 1 as page, c_custkey as k from customer),
  m as (select *, page = 20 + listing % 30 as blank, page = 10 + listing * 7 % 50 as done, 2 * (25 + listing * 3 % 40) as total from p),
  r as (select *, sum(case when blank then 0 else 2 end) over w as got, row_number() over w as nth from m window w as (partition by listing order by page)),
  e as (select listing, min(page) as stop from r where blank or done or got >= total or nth >= 35 group by listing),
  i as (select r.listing, page, k from r left join e on r.listing = e.listing where not blank and (stop is null or page <= stop))
  select listing, 'a' || (page % 15) as id, 'v' || min(k) as v from i group by listing, page % 15 union all select listing, 'b' || k, 'w' || k from i""")  # fmt: skip
def paged_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as listings of 40 pages that end by an empty page, a flag, a total or the cap."""
    listing, page, k = F.floor(F.col("c_custkey") / 40), (F.col("c_custkey") % 40 + 1), F.col("c_custkey").cast("string")
    item = lambda a, b: F.struct(a.alias("id"), b.alias("v"))
    both = F.array(item(F.concat(F.lit("a"), (page % 15).cast("string")), F.concat(F.lit("v"), k)), item(F.concat(F.lit("b"), k), F.concat(F.lit("w"), k)))
    pages = ad.table(spark, sf_dir, "customer").select(
        listing.alias("listing"), page.alias("page"), F.when(page != 20 + listing % 30, both).alias("items"),
        F.when(page == 10 + listing * 7 % 50, "True").otherwise("false").alias("complete"), (2 * (25 + listing * 3 % 40)).alias("total"),
    )
    return rd.pages_until_empty(pages, ["listing"], 35).select("listing", "id", F.col("item.v").alias("v"))


@query("S11_category_leaves", """select p_partkey as id, (p_partkey % 5)::varchar as level from part p
  where p_partkey % 5 <> 0 and not exists (select 1 from part c where c.p_partkey // 10 = p.p_partkey)""")  # fmt: skip
def category_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    nodes = _parts(spark, sf_dir).select(k.alias("id"), F.when(k >= 10, F.floor(k / 10)).alias("parent"), (k % 5).cast("string").alias("level"))
    return rd.leaf_categories(nodes)


# --- sets and edge tests
@query("J15_J16_O3_inner_edges", ad.SQL_CLUSTERS + """, hubs as (select offer_idx, component, min(offer_idx) over (partition by mpn_root_key) as hub from cl where mpn_root_key is not null)
  select component, count(*) as edges from hubs where hub <> offer_idx group by component""")  # fmt: skip
def inner_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-tier edges whose two offers ended in one cluster."""
    return tr.inner_edges(ad.listed_keys(spark, sf_dir), F.col("mpn_root_key"))


@query("J10_new_id_by_key", _SQL_IDENTITY + ", fresh as (select component from res where resolution = 'new') select component, 5000000 + row_number() over (order by component) - 1 as product_id from fresh")
def new_id_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = _decisions(spark, sf_dir).filter("resolution = 'new'").select("component")
    return fresh.join(ct.new_ids(fresh, 5_000_000).select("component", "product_id"), "component").select("component", "product_id")


@query("O2_O4_O5_sets", f"{ad.SQL_OFFERS} select distinct category, 'all' as part from o where category is not null union all select 's0 only', store from o group by store having store <> 's0'")
def sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = ad.offers(spark, sf_dir)
    stores = o.select(F.lit("s0 only").alias("category"), F.col("store").alias("part")).distinct()
    rest = stores.join(stores.filter("part = 's0'"), ["category", "part"], "left_anti")
    return o.filter("category is not null").select("category", F.lit("all").alias("part")).distinct().unionByName(rest)


@query("F8_F9_single_block_codes", f"{ad.SQL_CODES} select code, count(*) as blocks from (select distinct code, c, b from el where b not in ('', chr(1))) group by code having count(*) = 1")
def single_block_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = ad.offers(spark, sf_dir).filter("effective_brand <> ''")
    return tr.block_spread(o).filter("spread = 1").select("code", F.col("spread").alias("blocks"))


@query("U9_committed_snapshot", f"{ad.SQL_OFFERS} select store, count(*) as n from o group by store")
def committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _written(spark, "commit")
    ct.commit({"offers": ad.offers(spark, sf_dir).select(*ig.KEY)}, root)
    return spark.read.parquet(f"{root}/offers").groupBy("store").agg(F.count("*").alias("n"))


@query("S6_csv_in_place", "select p_type as store, p_name as raw_product_type, count(*) as product_count, 'seen twice' as canonical_category, count(*) as kept from part group by 1, 2")
def csv_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV that is filled twice, beside the backup of its first state."""
    path, header = _written(spark, "map"), ["store", "raw_product_type", "product_count", "canonical_category"]
    counted = _parts(spark, sf_dir).groupBy(F.col("p_type").alias("store"), F.col("p_name").alias("raw_product_type")).agg(F.count("*").alias("product_count"))
    rd.write_csv(counted.withColumn("canonical_category", F.lit(None).cast("string")), path)
    again = F.when(F.col("canonical_category").isNull(), "seen").otherwise(F.concat("canonical_category", F.lit(" twice")))
    for _ in range(2):
        rd.update_csv(spark, path, header, lambda df: df.withColumn("canonical_category", again))
    read = lambda p: spark.read.schema("store string, raw_product_type string, product_count bigint, canonical_category string").option("header", True).csv(p)
    kept = read(f"{path}.bak").filter("canonical_category is null").select("store", "raw_product_type", F.col("product_count").alias("kept"))
    return read(path).join(kept, ["store", "raw_product_type"])


@query("S13_side_sink", f"{ad.SQL_OFFERS} select store, store_product_id, case when k % 19 = 0 then 'second' else title end as title from o")
def side_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows of some keys arrive; the later one replaces what the sink held."""
    held = ad.offers(spark, sf_dir).select(*ig.KEY, "title")
    some = held.filter(F.split("store_product_id", "-")[0].cast("bigint") % 19 == 0).drop("title")
    arrived = F.explode(F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(v).alias("title")) for i, v in ((1, "first"), (2, "second"))]))
    return rd.side_sink(held, some.select(*ig.KEY, arrived.alias("x")).select(*ig.KEY, "x.*"), ig.KEY)


@query("U10_state_tables", """select * from (values ('category_map', 3), ('store_products', 21), ('price_history', 4), ('products', 19), ('merged_products', 3), ('price_subscriptions', 2), ('raw_products', 15)) t(name, columns),
  (select 'unmatched' as match_method, 0 as store_count, 17 as added, count(*) as products from nation)""")  # fmt: skip
def state_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables created twice around an older table of products, which reads with its later columns."""
    root = _written(spark, "state")
    ad.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("brand")).write.parquet(f"{root}/products")
    made = [*st.ensure_tables(spark, root), *st.ensure_tables(spark, root)]
    width = {name: len(st.read_table(spark, root, name).columns) for name in ["products", *made]}
    products = st.read_table(spark, root, "products").groupBy("match_method", "store_count").agg(F.count("*").alias("products"))
    return products.select(F.explode(F.create_map(*[F.lit(x) for pair in width.items() for x in pair])).alias("name", "columns"), "match_method", "store_count", F.lit(len(st.missing_columns(spark, root, "products"))).alias("added"), "products")


@query("J18_exit_codes", f"""{ad.SQL_OFFERS} select store, case when store in ('s1', 's5') then 0 else count(*) end as n, store not in ('s1', 's5') as passed from o group by store""")
def exit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store whose scraper failed, and one that left no exit code, do not pass."""
    counts = ad.offers(spark, sf_dir).groupBy("store").agg(F.count("*").alias("count"))
    codes = counts.filter("store <> 's5'").select("store", F.when(F.col("store") == "s1", 2).otherwise(0).alias("code"))
    found = ig.sane_stores(counts, counts.select("store", F.col("count").alias("expected")), codes)
    return found.select("store", F.col("count").alias("n"), "passed")


# --- scalar rules, each on texts made for it
@query("N2_greek_left", "select p_partkey, p_partkey % 2 = 1 as left_over from part")
def greek_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    lead = F.when(F.col("p_partkey") % 2 == 1, "Φως ").otherwise("ΑΒΕ μ ")
    return _parts(spark, sf_dir).select("p_partkey", tx.has_greek_left(F.concat(lead, "p_name")).alias("left_over"))


@query("N5_units", "select p_partkey, (p_size * 1024) || 'gb, ' || p_size || '.5in 7gb ' || p_size || '.5l 33ml' as units from part")
def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size").cast("string")
    text = F.concat(n, F.lit(" TB, "), n, F.lit(',5" 007 GB '), n, F.lit(".5 L 33 ml"))
    return _parts(spark, sf_dir).select("p_partkey", tx.normalize_units(text).alias("units"))


@query("N6_N7_phrases", "select p_partkey, 'case ' || p_partkey || ' unclear onliner' as plain from part")
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("case space gray "), _number(), F.lit(" natural titanium | unclear buy now – onliner λευκο"))
    return _parts(spark, sf_dir).select("p_partkey", tx.squeeze(tx.strip_noise(tx.strip_color(text))).alias("plain"))


@query("N9_brand_removal", "select p_partkey, case when p_partkey % 2 = 0 then 'kettle ' else 'galaxy s' end || p_partkey as plain from part")
def brand_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("p_partkey") % 2 == 0
    brand = F.when(even, "De'Longhi").otherwise("Samsung")
    text = F.concat(F.when(even, "de'longhi belonghi | kettle ").otherwise("samsung | samsungelectronics galaxy s"), _number(), F.when(even, " | de longhi").otherwise(""))
    return _parts(spark, sf_dir).select("p_partkey", tx.squeeze(F.replace(tx.remove_brand(text, brand), F.lit("|"), F.lit(" "))).alias("plain"))


@query("N11_ean", """select p_partkey, case p_partkey % 3 when 0 then '5901234' || lpad(p_partkey::varchar, 6, '0') when 1 then '12345678' end as ean from part""")
def eans(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    raw = F.when(k == 0, F.concat(F.lit("5901-234-"), F.lpad(_number(), 6, "0"))).when(k == 1, " 1234 5678x").otherwise("12345")
    return _parts(spark, sf_dir).select("p_partkey", tx.clean_ean(raw).alias("ean"))


@query("N17_N19_suspicious_brand", "select p_partkey, p_partkey % 4 in (0, 2) as suspicious from part")
def suspicious(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    brand = F.when(k == 0, " ").when(k == 1, "APPLE").when(k == 2, "SSJ").otherwise("sencor")
    title = F.when(k < 3, F.concat(F.lit("Sencor "), "p_name")).otherwise(F.concat(F.lit("SENCOR "), "p_name"))
    return _parts(spark, sf_dir).select("p_partkey", tx.suspicious_brand(brand, tx.brand_from_title(title)).alias("suspicious"))


@query("N25_retry_after", "select p_partkey, case p_partkey % 6 when 0 then p_size + 0.5 when 3 then 60.0 end::double as seconds from part")
def retry_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds, no wait, text, a date to come, a date past, none."""
    value = F.expr("CASE p_partkey % 6 WHEN 0 THEN concat(' ', p_size, '.5') WHEN 1 THEN '0' WHEN 2 THEN 'soon' WHEN 3 THEN 'Wed, 21 Oct 2026 07:28:00 GMT' WHEN 4 THEN 'Tue, 06 Oct 2026 07:28:00 GMT' END")
    now = F.timestamp_micros(F.lit(1792567620000000))
    return _parts(spark, sf_dir).select("p_partkey", ex.retry_after(value, now).alias("seconds"))


@query("P26_addresses", """select p_partkey, 'https://shop.example/' || case when p_partkey % 2 = 0 then 'a/' || p_partkey else 'product/' || p_partkey end as url,
  case when p_partkey % 3 = 0 then 'https://img/' || p_partkey else 'https://cdn/' || p_partkey || '-b.jpg' end as image from part""")  # fmt: skip
def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    path = F.when(k % 2 == 0, F.concat(F.lit("a/"), _number())).when(k % 4 == 1, "")
    image = F.when(k % 3 == 0, F.concat(F.lit("https://img/"), _number())).when(k % 3 == 1, "")
    return _parts(spark, sf_dir).select("p_partkey", ex.product_url("https://shop.example", path, _number()).alias("url"), ex.image_or(image, "https://cdn/", _number(), "-b.jpg").alias("image"))


from offerweave.plans import rule_queries  # noqa: E402,F401  registers more queries
