"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    from pyspark.sql import SparkSession

    from offerweave.operators import resolve, tiers
    from offerweave.operators.enrich import enrich, number_offers
    from offerweave.plans import adapter, catalog_queries
    from offerweave.plans.scratch import materialize

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "16g").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, run) -> None:
        began = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - began, 3)

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    state: dict = {}

    def enriched():
        state["offers"] = materialize(enrich(number_offers(adapter.versions(spark, sf_dir))), "bench-offers")

    def clustered():
        state["edges"] = materialize(tiers.tier_edges(state["offers"]), "bench-edges")
        state["clusters"] = materialize(tiers.clusters(state["offers"], state["edges"]), "bench-clusters")

    noop(spark.read.parquet(f"{sf_dir}/region.parquet"))
    timed("ingest_upsert", lambda: noop(catalog_queries.QUERIES["U1_U3_J3_upsert"](spark, sf_dir)))
    timed("enrich", enriched)
    timed("cluster", clustered)
    timed("match_keys", lambda: noop(resolve.match_keys(state["clusters"], resolve.contributions(state["clusters"], state["edges"]))))
    timed("products", lambda: noop(resolve.representatives(state["clusters"])))
    timed("coverage", lambda: noop(catalog_queries.rp.coverage(state["offers"])))
    try:
        from offerweave.llm import queries
    except ModuleNotFoundError:
        queries = None
    for name, run in (queries.QUERIES if queries else {}).items():
        timed(name, lambda run=run: noop(run(spark, sf_dir)))
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
