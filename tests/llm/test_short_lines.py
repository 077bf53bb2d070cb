"""Line dedup with every non-blank line judged, and its SQL."""

import os

import duckdb

import corpus_pipeline
from offerweave.llm import linededup, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_short_tabbed_and_unspaced_lines_are_judged(spark):
    shared = ["All rights reserved.", "Menu", "a\tb\tc\td\te", "版权所有不得转载", "one two three four"]
    blank = ["", "   ", "\t", "  　"]
    rows = [(i, "\n".join([f"own {i}", *shared, *blank]), "en", f"s{i % 5}", 0) for i in range(6)] + [(9, None, "en", "s0", 0), (10, "Menu", "en", "s1", 0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r.text for r in linededup.dedup_lines(frame, min_words=None).collect()}
    assert got == {0: rows[0][1], **{i: "\n".join([f"own {i}", *blank]) for i in range(1, 6)}, 9: None, 10: ""}
    kept = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, frame, "").collect()}
    assert kept == {i: t for i, t in got.items() if i != 10}


def test_all_lines_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(queries.ORACLES["op7_line_dedup_all_lines"]).fetchall()
    got = [tuple(r) for r in queries.QUERIES["op7_line_dedup_all_lines"](spark, SF).collect()]
    assert sorted(got) == sorted(want)
