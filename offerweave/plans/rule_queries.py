"""Queries whose rows meet the branches that the offers of the test tables do not: Greek titles, specification codes, odd brands, chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerweave import nightly
from offerweave.functions import extract as ex
from offerweave.functions import text as tx
from offerweave.operators import catalog as ct
from offerweave.operators import reports as rp
from offerweave.operators import tiers as tr
from offerweave.plans import adapter as ad
from offerweave.plans import catalog_queries as cq
from offerweave.plans.scratch import materialize
from offerweave.sources import state as st

_GREEK = "case when p_partkey % 3 = 0 then 'Φούρνος ' || p_name when p_partkey % 3 = 1 then 'Ἀθηνᾶ ' || p_name else p_name end"
_CLUSTER = "case when (p_partkey {div} 4) % 3 = 0 or (p_partkey {div} 4) % 3 = 1 and p_partkey % 2 = 0 then 'Φούρνος ' || p_name else p_name end"
_CODE = """case p_partkey % 12 when 0 then (10 + p_partkey % 80) || 'inch' when 1 then (1 + p_partkey % 9) || 'kg' || (1 + p_partkey % 9) || 'kg' when 2 then p_partkey || 'in1'
  when 3 then (100 + p_partkey % 900) || 'p' when 4 then (10000 + p_partkey % 9) || 'btu' when 5 then '6gb' || p_partkey || 'gb' when 6 then 'gen' || p_partkey when 7 then 'ip' || (10 + p_partkey % 90)
  when 8 then 'watch' || p_partkey when 9 then (100 + p_partkey % 900) || 'nc' when 10 then 'rare' || p_partkey || 'z9' else p_partkey || 'gpu' end"""
_MPN = """case p_partkey % 5 when 0 then 'Brand MX-' || p_partkey || 'A rest' when 1 then 'Thing (OLED) (AB' || p_partkey || '/Z) (2024567) more'
  when 2 then 'Thing lowercase1' when 3 then 'Only' else '  Spaced   A1-B2' || p_partkey end"""
_REASON = "case p_partkey % 4 when 1 then 'cross-category: [a]' when 2 then 'cross-category: [a]; collision: ' || p_partkey when 3 then 'ambiguous_key' end"


def _parts(spark: SparkSession, sf_dir: str, **columns: str) -> DataFrame:
    return ad.table(spark, sf_dir, "part").select("p_partkey", "p_name", *[F.expr(e).alias(c) for c, e in columns.items()])


@cq.query("N22_F11_greek_titles", f"select case when p_partkey % 3 < 2 then 'EL' else 'EN' end as lang, count(*) as n, min(title) as first from (select p_partkey, {_GREEK} as title from part) group by 1")
def greek_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, title=_GREEK).groupBy(tx.language(F.col("title")).alias("lang")).agg(F.count("*").alias("n"), F.min("title").alias("first"))


@cq.query("A33_greek_only_clusters", f"""select p_partkey // 4 as component, count(*) as size, count(distinct p_partkey % 2) as stores
  from (select p_partkey, {_CLUSTER.format(div="//")} as title from part) group by 1 having count(distinct p_partkey % 2) > 1 and bool_and(title like 'Φ%')""")  # fmt: skip
def greek_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.greek_only(_parts(spark, sf_dir, component="p_partkey div 4", store="concat('s', p_partkey % 2)", title=_CLUSTER.format(div="div")))


@cq.query("F5_F6_F7_all_filters", f"select distinct {_CODE} as code, p_partkey % 12 not in (9, 10) as spec, p_partkey % 12 in (3, 9) as suffix, p_partkey % 12 = 10 as eligible from part")
def all_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("code")
    return _parts(spark, sf_dir, code=_CODE).select("code", tx.is_spec_code(code).alias("spec"), tx.is_series_suffix(code).alias("suffix"), tx.is_eligible_code(code).alias("eligible")).distinct()


@cq.query("A37_spec_and_suffix_codes", f"select distinct {_CODE} as code, case when p_partkey % 12 = 9 then 'suffix' else 'spec' end as kind from part where p_partkey % 12 <> 10")
def spec_and_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.blocked_codes(_parts(spark, sf_dir, model_codes=f"array({_CODE})"))


@cq.query("A24_codes_of_parts", "select p_partkey % 4 as codes, count(*) as offers from part group by 1")
def codes_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers with none to three codes, through the code rule."""
    title = "concat('Thing', case when p_partkey % 4 > 0 then ' abcd12' else '' end, case when p_partkey % 4 > 1 then ' wxyz34' else '' end, case when p_partkey % 4 > 2 then ' mnop56' else '' end, ' 64gb')"
    return rp.codes_per_offer(_parts(spark, sf_dir, title=title).select(tx.model_codes(F.col("title")).alias("model_codes")))


@cq.query("A26_small_codes", """select 'm' || (p_partkey // 3) || 'x' as code, count(*) as offers, count(distinct b) as blocks, count(distinct p_partkey % 2) as stores, count(distinct p_partkey % 2) >= 2 as bridge
  from (select *, case when (p_partkey // 3) % 2 = 0 then p_partkey % 3 else 0 end as b from part) group by p_partkey // 3 having count(distinct b) = 1 and count(*) between 2 and 5""")  # fmt: skip
def small_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = "concat('b', case when (p_partkey div 3) % 2 = 0 then p_partkey % 3 else 0 end)"
    return rp.good_codes(_parts(spark, sf_dir, model_codes="array(concat('m', p_partkey div 3, 'x'))", category="'c'", effective_brand=brand, store="concat('s', p_partkey % 2)"))


@cq.query("R1_suspicious_clusters", """with f as (select p_partkey // 3 as component, count(*) as n, count_if(p_partkey % 12 = 0) as lost, count(distinct case p_partkey % 9 when 0 then null when 1 then 'LG' else 'Sony' end) as brands from part group by 1 having count(*) > 1)
  select component, 'unresolved_suspicious_brand' as reason from f where lost > 0 union all select component, 'cross_effective_brand' from f where brands > 1""")  # fmt: skip
def suspicious_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = "case p_partkey % 9 when 0 then '' when 1 then 'LG' else 'Sony' end"
    return tr.review_signals(_parts(spark, sf_dir, component="p_partkey div 3", is_suspicious_brand="p_partkey % 6 = 0", brand_from_title="case when p_partkey % 12 <> 0 then 'Bose' end", effective_brand=brand))


@cq.query("A36_reason_kinds", """select 'cross-category' as reason, count_if(p_partkey % 4 in (1, 2)) as n from part union all select 'collision', count_if(p_partkey % 4 = 2) from part
  union all select 'ambiguous_key', count_if(p_partkey % 4 = 3) from part""")  # fmt: skip
def reason_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.reason_counts(_parts(spark, sf_dir, review_reason=_REASON))


@cq.query("P4_P5_title_part_numbers", f"""select p_partkey, {_MPN} as title, case p_partkey % 5 when 0 then 'MX-' || p_partkey || 'A' when 1 then 'AB' || p_partkey || '/Z' when 4 then 'A1-B2' || p_partkey end as mpn from part""")
def title_part_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, title=_MPN).select("p_partkey", "title", ex.mpn_from_title(F.col("title")).alias("mpn"))


@cq.query("G6_redirect_chains", """select p_partkey as old_id, p_partkey - p_partkey % 10 as new_id from part where p_partkey % 10 <> 0
  union all select -p_partkey, p_partkey - p_partkey % 10 from part""")  # fmt: skip
def redirect_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products merged into the one before, nine in a row within one batch, and older redirects to all of them."""
    parts = _parts(spark, sf_dir)
    pairs = parts.filter("p_partkey % 10 <> 0").select((F.col("p_partkey") - 1).alias("survivor"), F.col("p_partkey").alias("absorbed"))
    return ct.redirects(parts.select((-F.col("p_partkey")).alias("old_id"), F.col("p_partkey").alias("new_id")), pairs)


@cq.query("A30_key_verdict", cq._SQL_KEYS + """ select sum(c)::bigint as clusters, count(*) as keys, count_if(c > 1) as colliding_keys, coalesce(sum(case when c > 1 then c end), 0)::bigint as colliding_clusters,
  case when count_if(c > 1) = 0 then 'GO' else 'REVIEW NEEDED' end as verdict from (select match_key, count(*) as c from keys group by 1)""")  # fmt: skip
def key_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.key_verdict(cq._keys(spark, sf_dir))


@cq.query("K6_cross_brand_clusters", ad.SQL_CLUSTERS + """, z as (select component, count(*) as size, count(distinct store) as stores, count(distinct coalesce(category, '')) as categories, count(distinct coalesce(brand_norm, '')) as brands from cl group by 1 having count(*) > 1),
  r as (select *, row_number() over (order by size desc, component) as nth from z)
  select component, size, stores, categories, brands from r order by case when nth <= 5 then 0 when stores > 1 or categories > 1 or brands > 1 then 1 else 2 end, size desc, component limit 15""")  # fmt: skip
def cross_brand_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.stratified_clusters(rp.cluster_facts(ad.listed(spark, sf_dir)).filter("size > 1"))


cq.on_offers("N8_title_inspection", "select offer_idx, vendor, brand_norm as brand, title, title_norm as normal, coalesce(good_code, '') as models, case when is_suspicious_brand then brand_from_title end as suggested from o order by offer_idx limit 30", rp.title_inspection)


@cq.query("U9_nightly_run", f"""with {ad._sql_versions("v")}, s as (select store, count(*) as n, count(category) as mapped from v group by 1)
  select store, n, store <> 's0' as passed, case when store <> 's0' then mapped else 0 end as inserted, case when store <> 's0' then n - mapped else 0 end as skipped from s""")  # fmt: skip
def nightly_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first night, gate to commit, read back from the committed state; store s0 has fewer rows than expected."""
    seen = materialize(ad.versions(spark, sf_dir), "seen")
    staging = seen.drop("category").withColumn("ordinal", F.lit(0))
    mapping = seen.filter("category is not null").select("store", F.col("product_type").alias("raw_product_type"), "category").distinct()
    expected = staging.select("store").distinct().withColumn("expected", F.when(F.col("store") == "s0", 1_000_000_000).otherwise(2))
    root = cq._written(spark, "nightly")
    done = nightly.run(spark, root, staging, mapping, expected, F.lit("2024-01-01").cast("timestamp"), write=True)
    state = st.read_table(spark, nightly.current(spark, root), "store_products")
    inserted = state.filter("product_id is not null").groupBy("store").agg(F.count("*").alias("inserted"))
    out = done["gate"].join(inserted, "store", "left").join(done["counters"].select("store", "skipped"), "store", "left")
    return out.select("store", F.col("count").alias("n"), "passed", F.coalesce("inserted", F.lit(0)).alias("inserted"), F.coalesce("skipped", F.lit(0)).alias("skipped"))
