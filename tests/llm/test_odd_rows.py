"""Every operator and stage on null and clashing ids, repeats, ties, long texts and clashing columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from offerweave.llm import common, decontam, licenses, linededup, media, neardup, packing, quality, tokencounts, toxicity, warc

RNG = random.Random(41)
WORDS = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(3, 8))) for _ in range(4000)]
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, n_lines string, n_removed string, media string, declared int, b1 string, place int, label string, class_id string, size string"


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def frame(spark, rows):
    """(doc_id, text[, source]) with many clashing columns."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, 1.0, "k", "l", "r", "m", 3, "b", 4, "x", "c", "z") for r in rows], COLUMNS)


LONG = prose(150_000)
ITEM, TOXIC = prose(40), " you utter fool and worthless scum"
BASE = [(1, prose(80)), (2, prose(80)), (3, None), (4, ""), (5, " \n\t"), (6, "one two"), (7, LONG), (None, prose(60)), (None, None)]


def labels(spark, toxic, n=400):
    return spark.createDataFrame([(i, int(i not in toxic), int(i in toxic)) for i in range(n)] + [(None, 1, 1), (1, None, None)], "doc_id bigint, quality int, toxic int")


def rows(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "") for r in df.collect())


def want(pairs):
    return sorted((i is None, i or 0, t is None, t or "") for i, t in pairs)


def test_line_dedup_keeps_what_is_not_shared(spark):
    shared = prose(8)
    own = [f"own {i} " + prose(5) for i in range(9)]
    given = [(10 + i, f"{own[i]}\n{shared}", f"s{i}") for i in range(5)]
    given += [(50, f"x y z w a\n{shared}", "s1"), (50, "UNIQUE FIRST LINE OF B\nUNIQUE SECOND LINE OF B\nc d e f", "s2")]
    given += [(None, f"{own[6]}\n{shared}", "s3"), (None, f"UNIQUE LINE\n{own[7]}\nand more of it", "s4"), (None, None, "s5"), (12, f"{own[2]}\n{shared}", "s2"), (60, "\n".join([shared, *(f"l{i} a b c" for i in range(20_000)), shared]), "s6")]
    got = rows(linededup.without_repeated_lines(frame(spark, given)))
    new = [(i, None if t is None else "\n".join(x for x in t.split("\n") if x != shared or i == 10)) for i, t, _ in given]
    assert got == want(new)
    full = linededup.dedup_lines(frame(spark, given))
    assert full.columns[-2:] == ["n_lines", "n_removed"] and {r.n_removed for r in full.filter("doc_id = 60").collect()} == {2}
    assert linededup.without_repeated_lines(frame(spark, given)).columns == frame(spark, []).columns


def test_ties_of_first_occurrences(spark):
    shared = prose(6)
    given = [(1, f"{shared}\n{i}", f"s{i}") for i in range(6)]  # one id, one place, six texts
    got = linededup.dedup_lines(frame(spark, given)).collect()
    assert sorted(r.n_removed for r in got) == [0, 1, 1, 1, 1, 1]
    assert [r.n_removed for r in linededup.dedup_lines(frame(spark, [(2, shared, f"s{i}") for i in range(6)])).collect()] == [0] * 6


def test_stages_judge_rows_by_text(spark):
    toxic = {i for i in range(400) if i % 8 == 0}
    train = [(i, prose(70) + (TOXIC if i in toxic else "")) for i in range(400)]
    extra = [(1, prose(50) + TOXIC), (None, prose(50) + TOXIC), (None, prose(50)), (3, None), (4, ""), (401, prose(50) + " " + TOXIC), (401, prose(55))]
    got = rows(toxicity.without_toxic(frame(spark, train + extra), labels(spark, toxic)))
    assert {r for r in want(extra)} - set(got) == set(want([extra[0], extra[1], extra[5]]))
    item = spark.createDataFrame([(0, ITEM), (None, prose(30)), (0, prose(30))], "item_id bigint, text string")
    dirty = [(1, f"{prose(20)} {ITEM} {prose(20)}"), (None, f"{prose(9)} {ITEM}"), (9, ITEM), (9, ITEM)]
    clean = [*BASE, (9, prose(40)), (1, BASE[0][1])]
    assert rows(decontam.decontaminate(frame(spark, dirty + clean), item)) == want(clean)
    assert {r.doc_id for r in decontam.contaminated(frame(spark, dirty + clean), item).collect()} == {1, 9}


def test_near_duplicates_with_null_and_clashing_ids(spark):
    text = prose(100)
    near = " ".join(["new", *text.split()[1:]])
    given = [(1, text), (50, near), (50, prose(90)), (None, text), (None, near), (None, prose(80)), (2, text.upper()), (1, text), (None, None), (60, None)]
    kept = [given[i] for i in (0, 2, 5, 7, 8, 9)]
    assert rows(neardup.one_of_each(frame(spark, given))) == want(kept)
    got = {(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(frame(spark, given)).collect()}
    assert got == {(1, 1, True), (50, 1, False), (50, 50, True), (None, None, False), (2, 1, False), (60, 60, True)}
    lone = [(None, text), (None, near), (None, text)]
    assert len(rows(neardup.one_of_each(frame(spark, lone)))) in (1, 2)  # the rows of one class


@pytest.mark.parametrize("bound", [0, 500_000])
def test_large_tables_take_the_other_way(spark, monkeypatch, bound):
    """With nothing to broadcast, joins are salted and places are shuffled; rows are the same."""
    items = spark.createDataFrame([(k, prose(n)) for k, n in enumerate([5, 12, 40, 300])], "item_id bigint, text string").cache()
    known = [r.text for r in items.orderBy("item_id").collect()]
    docs = frame(spark, [(i, f"{prose(30)} {known[i % 4]} {prose(30)}") for i in range(12)] + [(20, prose(90)), (21, f"{known[0]} x {known[0]} {known[2]}")])
    text = {r.doc_id: r.text for r in docs.collect()}
    for m in (decontam, licenses):
        monkeypatch.setattr(m, "BROADCAST_ROWS", bound)
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    assert got == {(i, k) for i, t in text.items() for k, x in enumerate(known) if x in t}
    assert {r.doc_id for r in decontam.decontaminate(docs, items).collect()} == {20}
    noted = frame(spark, [(i, f"{prose(300)} {t} {prose(300)}") for i, t in enumerate(licenses.TEMPLATES.values())])
    found = {(r.doc_id, r.license) for r in licenses.scan_licenses(noted).collect()}
    assert {(i, name) for i, name in enumerate(licenses.TEMPLATES)} <= found


def test_hot_joins_keep_all_rows(spark):
    left = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    right = spark.createDataFrame([(7, "a"), (8, "b")], "k bigint, v string")
    for how, n in (("inner", 336), ("left", 1000), ("left_anti", 664), ("left_semi", 336)):
        assert common.join_hot(left, right, ["k"], ["id"], 0, how).count() == common.join_hot(left, right, ["k"], ["id"], 10, how).count() == n


def test_training_rows_are_bounded(spark):
    toxic = set(range(0, 100, 4))
    docs = frame(spark, [(i, f"text {i}" + TOXIC * (i in toxic)) for i in range(100)] + [(5, "text 5")] * 50 + [(6, "a later text")] * 9 + [(8, "x" * 1000)])
    size = F.length("text")

    def describe(batches):
        for b in batches:
            yield b.select(["doc_id", "label", "text"])

    got = toxicity.training_rows(docs, labels(spark, toxic, 100), "toxic", F.lit(True), 60, size, 2000, describe, "doc_id bigint, label int, text string")
    assert len(got) == len({r.doc_id for r in got}) <= 60 and sum(len(r.text) for r in got) <= 2000 and all(len(r.text) <= 40 for r in got)


def test_classifiers_on_odd_rows(spark):
    given = [*BASE, (1, BASE[0][1]), (1, prose(30)), (None, BASE[0][1])]
    toxic = {i for i in range(300) if i % 5 == 0}
    train = [(i + 100, prose(40) + TOXIC * (i in toxic)) for i in range(300)]
    known = labels(spark, toxic, 300).select(F.col("doc_id") + 100, "quality", "toxic").toDF("doc_id", "quality", "toxic")
    for op in (toxicity.toxicity, quality.quality):
        got = [r for r in op(frame(spark, given + train), known).collect() if r.doc_id is None or r.doc_id < 100]
        assert len(got) == len(given) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
        assert all(not r.held_out for r in got if r.doc_id is None) and len({r.score for r in got if r.doc_id in (3, 4)}) == 1


def test_other_operators_on_odd_rows(spark):
    given = [*BASE, (1, BASE[0][1]), (1, prose(30)), (None, BASE[0][1])]
    docs = frame(spark, given)
    stored = media.sniff_media(media.store_texts(docs)).collect()
    assert len(stored) == len(given) and {r.payload_bytes for r in stored if r.doc_id in (3, 4)} == {64}
    packed = packing.pack(docs).collect()
    assert len({(r.doc_id, r.ids_crc32, r.sequence_id, r.offset) for r in packed}) == len(packed) and sum(1 for r in packed if r.start == 0) == len(given)
    counted = tokencounts.counts_after_edits(docs).collect()
    assert len(counted) == len(given) and {r.n_tokens_before for r in counted if r.doc_id in (3, 4, 5)} == {0}
    noted = frame(spark, [*given, (8, f"{LONG} Released under the MIT License. {LONG}"), (8, "Released under the MIT License."), (8, "Released under the MIT License."), (None, "Released under the MIT License.")])
    assert [(r.doc_id, r.license, r.start_shingle) for r in licenses.scan_licenses(noted).filter("license = 'MIT-line'").collect()] == [(8, "MIT-line", 0)]
    pages = spark.createDataFrame([(None, None, None, 1), (None, "u", "x", 1), (5, "u", "x", 1), (5, "u", "x", 1), (9, "v", LONG, 1)], "page_id bigint, url string, html string, original int")
    got = sorted((r.page_id is None, r.page_id or 0, r.record_type, r.refers_to) for r in warc.archive_pages(pages).collect())
    # a page without an id refers to the response with its payload, if that has one
    assert got == [(False, 5, "response", None), (False, 5, "response", None), (False, 9, "response", None), (True, 0, "response", None), (True, 0, "revisit", 5)]


def test_ties_take_the_earliest(spark):
    item = spark.createDataFrame([(0, ITEM)], "item_id bigint, text string")
    doc = frame(spark, [(1, f"{prose(10)} {ITEM} {prose(10)} {ITEM}"), (2, "Released under the MIT License. " * 3)])
    assert [(r.doc_id, r.start_shingle) for r in decontam.contaminated(doc, item).collect()] == [(1, 10)]
    assert [(r.doc_id, r.start_shingle) for r in licenses.scan_licenses(doc).collect()] == [(2, 0)]


def test_no_rows(spark):
    none = frame(spark, [])
    item, known = spark.createDataFrame([], "item_id bigint, text string"), labels(spark, set(), 0).limit(0)
    for df in (decontam.decontaminate(none, item), toxicity.without_toxic(none, known), neardup.one_of_each(none), linededup.without_repeated_lines(none)):
        assert df.collect() == [] and df.columns == none.columns
    assert tokencounts.edit_trees(tokencounts.found_edits(tokencounts.build_trees(none))).collect() == []


def test_toxicity_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    model = {"ids": np.arange(0, 40, 2), "w0": 0.3, "w": rng.normal(size=20), "v": rng.normal(size=(20, 4))}
    for _ in range(30):
        found = np.unique(rng.integers(0, 45, 12))
        at = [i // 2 for i in found if i % 2 == 0 and i < 40]
        z = model["w0"] + sum(model["w"][i] for i in at) + sum(float(model["v"][i] @ model["v"][j]) for n, i in enumerate(at) for j in at[:n])
        assert np.isclose(toxicity.probability(model, found), 1 / (1 + np.exp(-z)))


def test_quality_score_is_the_sum_over_labellings():
    from itertools import product

    rng = np.random.default_rng(4)
    n = quality.FEATURES
    model = {"w": rng.normal(size=(n, 2)) / 3, "t": rng.normal(size=(2, 2)), "mean": rng.normal(size=n) / 5, "scale": 1 + rng.random(n), "curve": (0.8, -0.2)}
    for text in ("", "one line", "a b c\n| | |\n\nLast line, with words.", "\n\n", "x" * 50 + "\n1 2 3\nend\nmore of it"):
        features, lengths = quality.line_features(text)
        u = ((features - model["mean"]) / model["scale"]) @ model["w"]
        k = len(lengths)
        weight = {y: np.exp(sum(u[i, y[i]] for i in range(k)) + sum(model["t"][y[i], y[i + 1]] for i in range(k - 1))) for y in product((0, 1), repeat=k)}
        total = sum(weight.values())
        good = [sum(w for y, w in weight.items() if y[i]) / total for i in range(k)]
        share = np.clip(np.average(good, weights=lengths if lengths.sum() else None), 1e-3, 1 - 1e-3)
        z = model["curve"][0] * np.log(share / (1 - share)) + model["curve"][1]
        assert np.isclose(quality.probability(model, text), 1 / (1 + np.exp(-z)))


def test_pipeline_on_odd_rows(spark, tmp_path):
    toxic = {i for i in range(400) if i % 8 == 0}
    given = [(i, prose(70) + TOXIC * (i in toxic), f"s{i % 9}") for i in range(400)] + [(None, prose(50), "s"), (None, None, None), (1, prose(60), "s"), (500, " ".join(f"w{i}" for i in range(100_000)), "s")]
    frame(spark, given).write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark, toxic).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, ITEM)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).filter("start = 0").collect()]
    assert sorted(i for i in got if i is not None) == sorted([i for i, _, _ in given if i is not None and i not in toxic]) and got.count(None) == 2
