"""The training-data operators against brute force, on small tables with odd rows."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from offerweave.llm import decontam, licenses, linededup, media, neardup, packing, quality, queries, tokencounts, toxicity, warc
from offerweave.llm.common import word_shingles

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, component_id int"
RNG = random.Random(11)
WORDS = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 8))) for _ in range(3000)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def docs(spark, texts, source=None):
    rows = [(i, t, "en", source(i) if source else f"s{i % 7}", len(t or ""), "x", 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def rows_of(df, key):
    return {r[key]: r for r in df.collect()}


def edit(text, every, rng):
    return " ".join(rng.choice(WORDS) if rng.random() < every else w for w in text.split())


def odd_texts():
    base, rng = prose(120), random.Random(3)
    texts = [(i, edit(base, e, rng)) for i, e in enumerate([0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.08] * 4)]
    texts += [(100, None), (101, ""), (102, "  \n\t "), (103, "one two"), (104, "ONE Two"), (105, prose(20_000)), (106, base), (107, base.upper()), (106, base), (108, "a " * 50)]
    return texts


def test_near_duplicates_match_brute_force(spark):
    texts = odd_texts()
    sets = {i: set(neardup.shingle_set(t).tolist()) for i, t in texts}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = neardup.near_duplicates(docs(spark, texts)).collect()
    assert len(got) == len(texts)
    assert {(r.doc_id, r.component_id, r.n_shingles, r.kept) for r in got} == {(i, find(i), len(sets[i]), find(i) == i) for i in sets}
    assert neardup.near_duplicates(docs(spark, [])).collect() == []
    kept = neardup.one_of_each(docs(spark, texts))
    assert kept.columns == docs(spark, []).columns and {r.doc_id for r in kept.collect()} == {i for i in sets if find(i) == i}


def test_shingle_sets_by_definition():
    words = prose(40).split()
    plain = {" ".join(words[i : i + 5]) for i in range(36)}
    assert len(neardup.shingle_set(" ".join(words))) == len(plain)
    assert len(neardup.shingle_set("a b c")) == 1 and len(neardup.shingle_set(" \x0b ")) == 0
    assert (neardup.shingle_set("A b\x0cC d e f") == neardup.shingle_set("a B c d E F")).all()
    assert not np.array_equal(neardup.shingle_set("É b c d e"), neardup.shingle_set("é b c d e"))


def test_plan_uses_no_more_sequences_than_best_fit():
    rng = random.Random(1)
    for _ in range(30):
        items = [rng.randint(1, 64) if rng.random() < 0.7 else 64 for _ in range(rng.randint(1, 300))]
        places, free = {}, []
        for n in sorted(items, reverse=True):
            fits = [f for f in free if f >= n]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - n)
            else:
                free.append(64 - n)
        for n, lo, hi, seq, per, base in packing.plan_slots(Counter(items), 64):
            for r in range(lo, hi):
                places.setdefault(seq + (r - lo) // per, []).append((base + (r - lo) % per * n, n))
        assert sum(len(v) for v in places.values()) == len(items) and len(places) == len(free)
        for v in places.values():
            at = 0
            for offset, n in sorted(v):
                assert offset == at
                at += n
            assert at <= 64


def test_packing_is_exact(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    texts = odd_texts() + [(200, "İx. ÀÉ, it's <|endoftext|>x<|ENDOFTEXT|> áb 7.5 ok?!")]
    got = packing.pack(docs(spark, texts)).collect()
    want = Counter()
    for i, t in texts:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 2048):
            want[(i, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= 2048
    assert packing.pack(docs(spark, [])).collect() == []


def brute_leaks(spark, texts, items):
    frame = spark.createDataFrame([(i, t) for i, t in texts], "i bigint, t string").select("i", word_shingles(F.col("t")).alias("s"))
    d = {r.i: r.s for r in frame.collect()}
    frame = spark.createDataFrame(items, "i bigint, t string").select("i", word_shingles(F.col("t")).alias("s"))
    out = set()
    for item, s in ((r.i, r.s) for r in frame.collect()):
        own = Counter(s)
        for i, h in d.items():
            for a in range(max(1, len(h) - len(s) + 1)):
                w = Counter(h[a : a + len(s)])
                low = sum((own & w).values())
                if s and h and low >= 0.75 * (sum((own | w).values())):
                    out.add((i, item))
    return out


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(5)
    items = [(k, prose(n)) for k, n in enumerate([5, 8, 30, 40, 60, 300])] + [(50, None), (51, "..."), (52, "a a a a a a a a a b")]
    texts = [(i, prose(30) + " " + (edit(items[i % 6][1], e, rng)) + ", " + prose(30)) for i, e in enumerate([0, 0, 0, 0, 0, 0, 0.01, 0.01, 0.02, 0.02, 0.02, 0.01] * 2)]
    texts += [(90, None), (91, ""), (92, items[2][1].upper()), (93, "b a a a a a a a a a a b"), (94, prose(5000)), (92, items[2][1].upper())]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(spark, texts), table).collect()}
    assert got == brute_leaks(spark, texts, items) and (5, 5) in got
    assert decontam.contaminated(docs(spark, []), table).collect() == [] == decontam.contaminated(docs(spark, texts), table.limit(0)).collect()
    left = {r.doc_id for r in decontam.decontaminate(docs(spark, texts), table).collect()}
    assert left == {i for i, _ in texts} - {i for i, _ in got}


def test_simhash_by_definition(spark):
    values = [RNG.getrandbits(64) - (1 << 63) for _ in range(37)]
    got = spark.createDataFrame([(values,)], "v array<bigint>").select(decontam.simhash(F.col("v")).alias("h")).first().h
    assert got == sum(1 << b for b in range(63) if 2 * sum((v >> b) & 1 for v in values) > len(values))


def test_license_scan(spark):
    text = prose(200)
    texts = [(i, f"{text}\n{t}\n{text}") for i, t in enumerate(licenses.TEMPLATES.values())]
    texts += [(50, None), (51, ""), (52, prose(500)), (53, "RELEASED under the, MIT license"), (54, "Released under the MIT")]
    got = {(r.doc_id, r.license) for r in licenses.scan_licenses(docs(spark, texts)).collect()}
    assert {(i, name) for i, name in enumerate(licenses.TEMPLATES)} <= got
    assert {x for x in got if x[0] >= 50} == {(53, "MIT-line")}
    assert licenses.scan_licenses(docs(spark, [])).collect() == []


def test_line_dedup_matches_brute_force(spark):
    shared = prose(8)
    texts = [(i, f"{prose(6)}\n{shared}\n\nshort line\n{prose(6)}") for i in range(9)] + [(20, shared), (21, None), (22, ""), (23, f"{shared}\n{shared}"), (23, f"{shared}\n{shared}")]
    frame = docs(spark, texts, source=lambda i: None if i == 8 else f"s{i % 6}")
    sites = {}
    for r in frame.collect():
        for line in (r.text or "").split("\n"):
            if len(line.split(" ")) >= 4 and line.strip():
                sites.setdefault(line, set()).add(r.source or "")
    spread = {x for x, s in sites.items() if len(s) >= 5}
    assert spread == {shared}
    out = linededup.dedup_lines(frame).collect()
    assert len(out) == len(texts)
    for r in out:
        old = dict(texts)[r.doc_id]
        new = None if old is None else "\n".join(x for k, x in enumerate(old.split("\n")) if x not in spread or (r.doc_id, k) == (0, 1))
        assert (r.text, r.n_chars) == (new, len(new or ""))
    kept = linededup.without_repeated_lines(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {*range(9), 21, 22}
    assert linededup.digest(docs(spark, [])).collect() == []


def labelled(spark, texts, label, n):
    rows = [(i, int(label(i)), int(label(i))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_toxicity_learns_terms_and_pairs(spark):
    rng = random.Random(2)
    toxic = {i for i in range(600) if i % 5 == 0}
    texts = [(i, prose(60, rng) + (" you utter fool and worthless scum" if i in toxic else "")) for i in range(600)] + [(700, None), (701, ""), (702, "!!! ###")]
    frame = docs(spark, texts)
    got = toxicity.toxicity(frame, labelled(spark, texts, lambda i: i in toxic, 600)).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    right = [(r.predicted == 1) == (r.doc_id in toxic) for r in got if r.held_out]
    assert sum(right) >= 0.97 * len(right)
    empty = frame.limit(0)
    assert toxicity.toxicity(empty, labelled(spark, texts, lambda i: i in toxic, 0)).collect() == []
    # neither term alone, only both together
    rows, marks = [], []
    for a in (0, 1):
        for b in (0, 1):
            for _ in range(60):
                rows.append(np.array(sorted({10 * a + 1, 10 * b + 2, *rng.sample(range(100, 140), 3)})))
                marks.append(a and b)
    model = toxicity.fit(rows, np.array(marks))
    assert all((toxicity.probability(model, r) >= 0.5) == bool(m) for r, m in zip(rows, marks, strict=True))


def test_quality_field(spark):
    rng = random.Random(4)
    bad = {i for i in range(300) if i % 4 == 0}
    junk = lambda: "\n".join(" | ".join(prose(9, rng).split()) for _ in range(4))
    texts = [(i, junk() if i in bad else "\n".join(prose(15, rng).capitalize() + "." for _ in range(4))) for i in range(300)] + [(400, None), (401, "")]
    got = quality.quality(docs(spark, texts), labelled(spark, texts, lambda i: i not in bad, 300)).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got)
    right = [r.predicted == (r.doc_id not in bad) for r in got if r.held_out and r.doc_id < 300]
    assert all(right) and right
    assert quality.quality(docs(spark, []), labelled(spark, texts, lambda i: 1, 0)).collect() == []


def test_forward_backward_matches_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    u, t = rng.normal(size=(5, 2)), rng.normal(size=(2, 2))
    weights = {y: np.exp(sum(u[i, y[i]] for i in range(5)) + sum(t[y[i], y[i + 1]] for i in range(4))) for y in product((0, 1), repeat=5)}
    total = sum(weights.values())
    m, pair = quality.marginals(u, t)
    assert np.allclose(m[:, 1], [sum(w for y, w in weights.items() if y[i]) / total for i in range(5)])
    want = np.array([[sum(w * sum(y[i] == a and y[i + 1] == b for i in range(4)) for y, w in weights.items()) / total for b in (0, 1)] for a in (0, 1)])
    assert np.allclose(pair, want)


def png():
    import struct

    part = lambda n, d: struct.pack(">I", len(d)) + n + d + struct.pack(">I", zlib.crc32(n + d))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", b"\0" * 13) + part(b"IDAT", zlib.compress(b"x")) + part(b"IEND", b"")


def test_sniffing_confirms_corrects_and_carves():
    import gzip

    image, pack, sound = png(), gzip.compress(b"hello" * 99), media.wav(b"abcd")
    assert media.sniff(image, "image/gif") == {"type": "image/png", "corrected": True, "carved": []}
    assert media.sniff(b"GIF89a but text BM RIFF", "text/plain")["carved"] == []
    blob = b"junk" + image + b"between" + pack + sound + image[:-3]
    assert [(o, n, t) for o, n, t in media.sniff(blob)["carved"]] == [(4, len(image), "image/png"), (4 + len(image) + 7, len(pack), "application/gzip"), (4 + len(image) + 7 + len(pack), len(sound), "audio/wav")]
    assert media.sniff(None) == {"type": media.UNKNOWN, "corrected": False, "carved": []}


def test_media_round_trip(spark):
    texts = [(1, "abc"), (2, None), (3, ""), (4, "é" * 40), (5, "x" * 64), (6, prose(20_000)), (1, "abc"), (7, png().decode("latin-1"))]
    got = media.sniff_media(media.store_texts(docs(spark, texts))).collect()
    assert len(got) == len(texts)
    for r in got:
        raw = (dict(texts)[r.doc_id] or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-64:]) and r.media_type == "audio/wav" and r.corrected
        assert (r.media_bytes, r.media_sha256) == (len(media.wav(payload)), hashlib.sha256(media.wav(payload)).hexdigest())
    assert media.sniff_media(media.store_texts(docs(spark, []))).collect() == []


def test_archives_round_trip(spark):
    pages = [(i, f"http://www.Host{i % 3}.example:80/p/{i}?q=1#f", f"<html>{i // 2}</html>") for i in range(40)] + [(50, None, None), (51, "x", ""), (52, "y", None), (60, "z", "big" * 100_000), (60, "z", "big" * 100_000)]
    frame = spark.createDataFrame([(*p, "extra") for p in pages], "page_id bigint, url string, html string, digest string")
    got = warc.archive_pages(frame).collect()
    assert len(got) == len(pages)
    best = {}
    for i, _, h in pages:
        best[h or ""] = max(best.get(h or "", i), i)
    for r in got:
        body = next(h or "" for i, _, h in pages if i == r.page_id)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body.encode()).digest()).decode() and r.payload_bytes == len(body)
        assert (r.record_type, r.refers_to) == (("response", None) if best[body] == r.page_id else ("revisit", best[body]))
    merged = warc.capture_histories(warc.read_runs(warc.write_archives(frame, archive_bytes=300)), ranges=1).collect()
    order = [(r.url_key, r.captured, r.page_id) for r in merged]
    assert order == sorted(order) and len(order) == len(pages)
    assert warc.archive_pages(frame.limit(0)).collect() == []


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8])
def test_loser_tree(k):
    runs = [sorted(RNG.choices(range(50), k=RNG.randint(0, 20))) for _ in range(k)]
    assert list(warc.loser_tree([iter(r) for r in runs], key=lambda x: x)) == sorted(x for r in runs for x in r)


def test_counts_follow_edits(spark):
    from tokenizers import Tokenizer

    path, rng = tokencounts.vocabulary_path(), random.Random(9)
    tokenizer = Tokenizer.from_file(path)
    count = lambda raw: len(tokenizer.encode(raw.decode(), add_special_tokens=False).ids)
    for _ in range(400):
        raw = "".join(rng.choice("ab  \n.1") for _ in range(rng.randint(0, 25))).encode()
        edits = []
        for _ in range(rng.randint(0, 5)):
            a = rng.randint(0, len(raw))
            edits.append((a, rng.randint(a, min(len(raw), a + 4)), rng.choice([b"", b" ", b"x", b"yy z"])))
        tree = tokencounts.TokenTree(raw, path)
        assert tree.total == count(raw)
        assert count(tree.apply(edits)) == tree.total
    texts = [(1, "mail me@x.org or 12345678 now"), (2, None), (3, ""), (4, prose(3000)), (1, "mail me@x.org or 12345678 now")]
    got = tokencounts.counts_after_edits(docs(spark, texts)).collect()
    assert len(got) == len(texts)
    one = next(r for r in got if r.doc_id == 1)
    assert one.n_edits == 2 and one.n_tokens_after == count(b"mail [address] or [number] now") and one.reencoded_bytes < one.text_bytes


def test_pipeline_on_planted_cases(spark, tmp_path):
    rng = random.Random(8)
    toxic = {i for i in range(400) if i % 8 == 0}
    item = prose(40)
    texts = [(i, prose(70, rng) + (" you utter fool and worthless scum" if i in toxic else "")) for i in range(400)]
    texts += [(500, texts[1][1]), (501, edit(texts[2][1], 0.01, rng)), (502, prose(20) + " " + item + " " + prose(20)), (503, ""), (504, None)]
    docs(spark, texts).drop("score", "component_id").write.parquet(str(tmp_path / "documents.parquet"))
    labelled(spark, texts, lambda i: i in toxic, 400).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    clean = {i for i, _ in texts if i not in toxic} - {500, 501, 502}
    assert kept >= clean - {i for i in clean if i in toxic} and not kept & {500, 501, 502}
    assert len(kept & toxic) <= 0.05 * len(toxic)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert {k.split("_")[0] for k in queries.QUERIES} == {*(f"op{n}" for n in range(1, 11)), "pipeline"}
