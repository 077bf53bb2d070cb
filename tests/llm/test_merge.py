"""The external merge of capture runs."""

import random

from offerweave.llm import warc

RNG = random.Random(17)


def rows_of(archive, n):
    rows = [(f"k{RNG.randrange(30):02d}", f"t{RNG.randrange(5)}", RNG.choice([None, *range(9)])) for _ in range(n)]
    rows.sort(key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0))
    return [(archive, i, i, 1, k, t, p, 0, "d", "response", None) for i, (k, t, p) in enumerate(rows)]


def test_one_block_of_each_run_is_held():
    runs = [rows_of(f"a{i}", RNG.choice([0, 1, 3, 40, 200])) for i in range(12)]
    blocks = []
    for rows in runs:
        for at in range(0, len(rows), 7):
            before = warc._key(rows[at - 1]) if at else ()
            blocks.append((before, rows[0][0], at + 7 >= len(rows), warc._packed(rows[at : at + 7])))
    blocks.sort(key=lambda b: b[:2])
    taken, ends = 0, sorted(warc._key(rows[min(at + 6, len(rows) - 1)]) for rows in runs for at in range(0, len(rows), 7))

    def stream():
        nonlocal taken
        for b in blocks:
            taken += 1
            yield b[1:]

    merged = []
    for row in warc.merge_blocks(stream()):
        merged.append(row)
        # a block of each run, those that are done with, and one that waits
        assert taken <= len(runs) + sum(1 for k in ends if k <= warc._key(row)) + 1
    assert merged == sorted((r for rows in runs for r in rows), key=warc._key)


def test_ranges_and_blocks_do_not_change_the_order(spark):
    pages = [(i, f"http://h{i % 7}.example/{i % 11}", f"<p>{i % 50}</p>") for i in range(600)] + [(5, "http://h5.example/5", "<p>5</p>")] * 3 + [(None, "http://h0.example/0", None)] * 2
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    runs = warc.read_runs(warc.write_archives(frame, archive_bytes=2000)).cache()
    want = sorted((tuple(r)[4:7] for r in runs.collect()), key=lambda k: (k[0], k[1], k[2] is not None, k[2] or 0))
    for ranges, block_rows in ((1, 3), (5, 2), (40, 256), (None, 256)):
        got = [tuple(r)[4:7] for r in warc.capture_histories(runs, ranges, block_rows).collect()]
        assert got == want and len(got) == len(pages)


def test_records_read_back():
    raw = warc.record(3, "http://x/\r\ny", b"<p>\r\n\r\n</p>", "ABC", None) + b""
    import gzip

    (at, size, head, http, payload), (_, _, again, short, nothing) = warc.records(gzip.compress(raw) + gzip.compress(warc.record(2, None, b"<p>\r\n\r\n</p>", "ABC", 3)))
    assert (at, payload, head["WARC-Target-URI"], head["WARC-Type"], http["Content-Length"]) == (0, b"<p>\r\n\r\n</p>", "http://x/ y", "response", "11")
    assert (nothing, again["WARC-Type"], again["WARC-Refers-To"], short["Content-Length"], head["Content-Type"]) == (b"", "revisit", "<urn:page:3>", "11", "application/http; msgtype=response")
