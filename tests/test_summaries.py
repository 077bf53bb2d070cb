"""Resolved products are summed without texts, and title rules pass over texts that hold none of their phrases."""

import os
import re

from offerweave.functions import lexicon as lx
from offerweave.functions import text as tx
from offerweave.operators import resolve as rs
from offerweave.plans import adapter as ad
from offerweave.plans import catalog_queries as cq
from pyspark.sql import functions as F

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["component", "brand", "category", "offer_count", "store_count", "min_price", "max_price"]


def rows(df):
    return sorted(str([str(r[c]) for c in COLUMNS]) for r in df.collect())


def test_summaries_are_those_of_representatives(spark):
    assert rows(rs.summaries(ad.summed(spark, SF))) == rows(rs.representatives(ad.priced(spark, SF)))


def test_resolved_products_read_no_texts(spark, monkeypatch):
    def never(*_):
        raise AssertionError("the texts of parts were joined")

    monkeypatch.setattr(ad, "listed", never)
    monkeypatch.setattr(ad, "priced", never)
    cq.QUERIES[cq.FLAGSHIP](spark, SF).schema  # noqa: B018


def test_phrases_by_first_letter_match_as_before(spark):
    texts = [f"{a} {b}{c} x" for a in (*lx.COLOURS, *lx.NOISE) for b, c in (("space gray", ""), ("red", "dish"), ("blue", " titanium"), ("|", "new"))]
    texts += ["5,5\" tv", "5.5 in 2 L", "12 '' 3,5 ml", "1 tb 7″ l", "9 inn 3 lb", "5ιντσων 2 ίντσες"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for some in (lx.COLOURS, lx.NOISE):
        ordered = sorted(set(some), key=lambda p: (-len(p), p))
        plain = "|".join(rf"\Q{p}\E" for p in ordered)
        whole = [rf"(?U)(?<!\w)(?:{p})(?!\w)" for p in (plain, tx._any_of(ordered))]
        assert len(re.findall(r"\\Q", whole[1])) < 2 * len(ordered)
        assert df.filter(F.regexp_replace("t", whole[0], "_") != F.regexp_replace("t", whole[1], "_")).count() == 0
    got = [r.u for r in df.select(tx.normalize_units(F.col("t")).alias("u")).collect()][-6:]
    assert got == ["5.5in tv", "5.5in 2l", "12in 3.5ml", "1024gb 7in l", "9 inn 3 lb", "5in 2in"]
