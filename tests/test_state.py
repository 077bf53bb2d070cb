import datetime as dt

import pytest
from pyspark.sql import functions as F

from offerweave.functions import extract as ex
from offerweave.operators import ingest as ig
from offerweave.sources import readers as rd
from offerweave.sources import state as st


@pytest.mark.parametrize(
    ("value", "seconds"),
    [("5", 5.0), (" 2.5 ", 2.5), ("0", None), ("-3", None), ("nan", None), ("soon", None), ("", None), (None, None), ("Wed, 21 Oct 2026 07:28:00 GMT", 60.0), ("Wed, 21 Oct 2026 07:26:00 GMT", None), ("Wed, 99 Oct 2026 07:26:00 GMT", None)],
)
@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_retry_after(spark, value, seconds, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        now = F.timestamp_micros(F.lit(int(dt.datetime(2026, 10, 21, 7, 27, tzinfo=dt.UTC).timestamp()) * 1_000_000))
        assert spark.createDataFrame([(value,)], "v string").select(ex.retry_after(F.col("v"), now)).first()[0] == seconds
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_csv_update_keeps_the_first_backup_and_checks_headers(spark, tmp_path):
    path = str(tmp_path / "map")
    rd.write_csv(spark.createDataFrame([("a", None), ("b", "x")], "k string, v string"), path)
    for value in ("one", "two"):
        rd.update_csv(spark, path, ["k", "v"], lambda df, value=value: df.withColumn("v", F.lit(value)))
    read = lambda p: sorted(tuple(r) for r in spark.read.option("header", True).csv(p).collect())
    assert read(path) == [("a", "two"), ("b", "two")]
    assert sorted(read(f"{path}.bak"), key=lambda r: r[0]) == [("a", None), ("b", "x")]
    with pytest.raises(ValueError, match="expected"):
        rd.update_csv(spark, path, ["v", "k"], lambda df: df)
    with pytest.raises(ValueError, match="new CSV"):
        rd.update_csv(spark, path, ["k", "v"], lambda df: df.drop("v"))
    assert read(path) == [("a", "two"), ("b", "two")]


def test_side_sink(spark):
    held = spark.createDataFrame([("s", "1", "old"), ("s", "2", "old")], "store string, store_product_id string, v string")
    rows = spark.createDataFrame([("s", "1", "late", 2), ("s", "1", "early", 1), ("s", "3", None, 0)], "store string, store_product_id string, v string, ordinal int")
    got = {(r.store_product_id, r.v) for r in rd.side_sink(held, rows, ig.KEY).collect()}
    assert got == {("1", "late"), ("2", "old"), ("3", None)}
    assert rd.side_sink(held, rows.limit(0), ig.KEY).count() == 2


def test_tables_are_made_once(spark, tmp_path):
    root = str(tmp_path / "state")
    assert st.ensure_tables(spark, root, dry_run=True) == list(st.STATE) and not (tmp_path / "state").exists()
    assert st.ensure_tables(spark, root) == list(st.STATE) and st.ensure_tables(spark, root) == []
    assert all(st.read_table(spark, root, name).count() == 0 and st.missing_columns(spark, root, name) == [] for name in st.STATE)


def test_older_tables_read_with_defaults(spark, tmp_path):
    root = str(tmp_path / "state")
    spark.createDataFrame([(1, "x")], "id bigint, brand string").write.parquet(f"{root}/products")
    row = st.read_table(spark, root, "products").first()
    assert (row.brand, row.match_method, row.needs_review, row.store_count, row.match_key) == ("x", "unmatched", False, 0, None)
    assert "store_count" in st.missing_columns(spark, root, "products")


def test_exit_codes(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 9), ("c", 9)], "store string, count bigint")
    expected = spark.createDataFrame([("a", 11), ("b", 10), ("c", 10), ("d", 1)], "store string, expected int")
    codes = spark.createDataFrame([("a", 0), ("b", 1), ("d", 0)], "store string, code int")
    got = {r.store: (r["count"], r.passed) for r in ig.sane_stores(counts, expected, codes).collect()}
    assert got == {"a": (5, True), "b": (0, False), "c": (0, False), "d": (0, True)}
    assert {r.store for r in ig.sane_stores(counts, expected).collect() if r.passed} == {"a", "b", "c", "d"}
