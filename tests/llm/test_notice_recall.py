"""License scans and decontamination against all windows, at and around the limit."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from offerweave.llm import decontam, licenses
from offerweave.llm.common import word_shingles

RNG = random.Random(53)
WORDS = [f"w{i}" for i in range(5000)]


def prose(n):
    return [RNG.choice(WORDS) for _ in range(n)]


def shingles(spark, pairs):
    frame = spark.createDataFrame(pairs, "i bigint, t string").select("i", word_shingles(F.col("t")).alias("s"))
    return {r.i: r.s for r in frame.collect()}


def spoilt(text, n):
    words = text.split()
    for i in RNG.sample(range(len(words)), min(n, len(words))):
        words[i] = RNG.choice(WORDS)
    return words


def test_license_scan_matches_all_windows(spark):
    names = list(licenses.TEMPLATES)
    texts = []
    for text in licenses.TEMPLATES.values():
        for n in (0, 1, 2, 3, 4, 6):
            texts.append(" ".join(prose(RNG.randrange(40)) + spoilt(text, n) + prose(RNG.randrange(40))))
    texts += [" ".join(prose(200)) for _ in range(20)]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known, held = shingles(spark, list(enumerate(licenses.TEMPLATES.values()))), shingles(spark, rows)
    want = set()
    for k, own in known.items():
        if len(licenses.TEMPLATES[names[k]].split()) < 5:
            continue
        n, own = len(set(own)), set(own)
        for i, s in held.items():
            last = max(0, len(s) - n)
            for start in {*range(0, last + 1, max(1, n // 4)), last}:
                around = s[max(0, start - n // 2) :][: 2 * n]
                if len(own & set(around)) >= licenses.LIMIT * n:
                    want.add((i, names[k]))
    got = {(r.doc_id, r.license) for r in licenses.scan_licenses(docs).collect()}
    assert {x for x in got if len(licenses.TEMPLATES[x[1]].split()) >= 5} == want
    assert 40 < len(want)


@pytest.mark.parametrize("n", [5, 9, 14, 30, 59, 120, 250, 251, 500])
def test_items_at_the_limit_are_found(spark, n):
    """Shingles of words are replaced until similarity just holds: at least 0.95 of such documents are found, all copies are, no others."""
    items = [(k, " ".join(prose(n))) for k in range(10)]
    rows = []
    for i in range(100):
        words, k = items[i % 10][1].split(), i % 10
        own = Counter(tuple(words[a : a + 5]) for a in range(n - 4))
        order = RNG.sample(range(n), n)
        for at in order if i >= 10 else []:
            new = [*words[:at], "x" + words[at], *words[at + 1 :]]
            low = sum((own & Counter(tuple(new[a : a + 5]) for a in range(n - 4))).values())
            if low / (2 * (n - 4) - low) < decontam.LIMIT:
                continue
            words = new
        rows.append((i, " ".join(prose(30) + words + prose(30))))
    rows += [(1000 + i, " ".join(prose(100) + items[i % 10][1].split()[: max(4, n // 2)] + prose(100))) for i in range(20)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(spark.createDataFrame(rows, "doc_id bigint, text string"), benchmark).collect()}
    want = {(i, i % 10) for i in range(100)}
    assert got <= want and {x for x in want if x[0] < 10} <= got and len(got) >= 95
