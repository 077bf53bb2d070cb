"""License notices of fewer than five words inside texts."""

from offerweave.llm import licenses

FILLER = " ".join(f"word{i}" for i in range(40))


def test_short_notices_inside_texts(spark):
    known = [("rights", "All rights reserved."), ("two", "Public domain"), ("one", "Copyleft"), ("four", "Free as in beer"), ("none", "..."), ("long", "Released under the MIT License.")]
    texts = [
        (1, f"{FILLER}\nAll RIGHTS, reserved!\n{FILLER}\nAll rights reserved."), (2, f"{FILLER} all rights are reserved {FILLER}"), (3, "all rights reserved"),
        (4, f"public domain, {FILLER} free as in beer"), (5, "copyleft"), (6, "public"), (7, None), (8, ""), (9, f"{FILLER} Released under the MIT License. All rights reserved."),
    ]
    frame = spark.createDataFrame(texts + texts[:1], "doc_id bigint, text string")
    got = licenses.scan_licenses(frame, spark.createDataFrame(known, "license string, text string")).collect()
    want = {(1, "rights", 1.0, 40), (3, "rights", 1.0, 0), (4, "two", 1.0, 0), (4, "four", 1.0, 42), (5, "one", 1.0, 0), (9, "long", 1.0, 40), (9, "rights", 1.0, 45)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    built_in = {(r.doc_id, r.license) for r in licenses.scan_licenses(frame).collect()}
    assert {i for i, name in built_in if name == "Rights-line"} == {1, 3, 9}
