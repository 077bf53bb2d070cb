"""Decontamination by items longer than one fingerprint, against all windows."""

import random
from collections import Counter

from pyspark.sql import functions as F

from offerweave.llm import decontam
from offerweave.llm.common import word_shingles

RNG = random.Random(21)


def prose(n):
    return [f"w{RNG.randrange(4000)}" for _ in range(n)]


def best_windows(texts, items):
    out = {}
    for i, h in texts:
        for k, s in items:
            own, found = Counter(s), []
            for a in range(max(1, len(h) - len(s) + 1)):
                w = Counter(h[a : a + len(s)])
                low = sum((own & w).values())
                found.append((low / (sum((own | w).values())), -a, min(len(h), len(s))))
            if max(found)[0] >= decontam.LIMIT:
                out[(i, k)] = max(found)
    return out


def test_long_items_need_the_whole_window(spark):
    one, two, echo = prose(255), prose(604), (prose(20) * 20)[:300]  # 251, 600 and 296 shingles
    spoilt = lambda words, n: [f"x{i}" if i % n == 0 else w for i, w in enumerate(words)]
    texts = [
        prose(300) + one[-5:] + prose(300), prose(300) + two[-105:] + prose(300), prose(100) + two[:450] + prose(300), two[:450],  # clean but for a part
        prose(90) + one + prose(70), prose(90) + two + prose(10) + two, prose(40) + spoilt(two, 60) + prose(40), prose(40) + spoilt(two, 30) + prose(40),
        two[100:] + prose(50), two[:520], prose(30) + echo + prose(30), prose(30) + echo[:150] + prose(200), echo + echo, two[300:] + two[:300] + prose(40),
    ]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)] + [(4, " ".join(texts[4])), (90, None), (91, "")], "doc_id bigint, text string")
    items = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate([one, two, echo])], "item_id bigint, text string")
    hashes = lambda df, key: [(r[0], r[1]) for r in df.filter("text <> ''").select(key, word_shingles(F.col("text"))).distinct().collect()]
    want = best_windows(hashes(docs, "doc_id"), hashes(items, "item_id"))
    assert {(4, 0), (5, 1), (9, 1), (10, 2), (12, 2)} <= want.keys() and not {0, 1, 2, 3, 11} & {i for i, _ in want}
    got = decontam.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id): (r.similarity, -r.start_shingle, r.n_shingles) for r in got} == want and len(got) == len(want)
    assert {r.doc_id for r in decontam.decontaminate(docs, items).collect()} == {*range(14), 90, 91} - {i for i, _ in want}
