"""Token trees that are kept and edited again."""

import random
import time

from tokenizers import Tokenizer

from offerweave.llm import tokencounts

RNG = random.Random(31)
PATH = tokencounts.vocabulary_path()
TOKENIZER = Tokenizer.from_file(PATH)


def count(raw):
    return len(TOKENIZER.encode(raw.decode(), add_special_tokens=False).ids)


def some_edits(n):
    edits = []
    for _ in range(RNG.randint(0, 5)):
        a = RNG.randint(0, n)
        edits.append((a, RNG.randint(a, min(n, a + 4)), RNG.choice([b"", b" ", b"x", b"yy z", b"  q1 "])))
    return edits


def test_rounds_of_edits_on_stored_trees():
    for _ in range(300):
        raw = "".join(RNG.choice("ab  \n.1") for _ in range(RNG.randint(0, 30))).encode()
        tree = tokencounts.TokenTree(raw, PATH)
        for _ in range(4):
            edits, want, last, applied = some_edits(len(raw)), [], 0, 0
            for a, b, new in sorted(edits, key=lambda e: (e[0], e[1])):
                if a >= last or not want:
                    want += [raw[last:a], new]
                    last, applied = b, applied + 1
            want = b"".join([*want, raw[last:]])
            tree = tokencounts.TokenTree(raw, PATH, tree.stored())
            assert tree.apply(edits) == want == tree.raw and tree.applied == applied
            assert tree.total == count(want)
            raw = want


def test_trees_as_a_table(spark):
    texts = [(1, "mail me@x.org or 12345678 now"), (2, None), (3, ""), (None, "call 5551234567"), (1, "other text of one id"), (1, "mail me@x.org or 12345678 now"), (4, "plain " * 2000)]
    docs = spark.createDataFrame([(*t, 7, "x") for t in texts], "doc_id bigint, text string, n_tokens int, leaves string")
    trees = tokencounts.build_trees(docs)
    assert trees.count() == len(texts)
    once = tokencounts.edit_trees(tokencounts.found_edits(trees))
    more = spark.createDataFrame([(4, 0, 5, b"simple words"), (4, 3, 4, b"left out"), (None, 0, 0, b"please "), (3, 0, 0, b"now full")], "doc_id bigint, start bigint, stop bigint, new binary")
    twice = {(r.doc_id, bytes(r.text)): r for r in tokencounts.edit_trees(tokencounts.with_edits(once.select("doc_id", "text", "leaves", "n_tokens"), more)).collect()}
    assert {k: r.n_tokens for k, r in twice.items()} == {k: count(k[1]) for k in twice}
    assert {k[1] for k in twice if k[0] != 4} == {b"mail [address] or [number] now", b"", b"now full", b"please call [number]", b"other text of one id"}
    assert twice[(4, b"simple words " + b"plain " * 1999)].n_edits == 1 and twice[(4, b"simple words " + b"plain " * 1999)].reencoded_bytes < 20


def test_overlapping_redactions_count_once():
    for raw, new in ((b"mail me12345678@x.org", b"mail [address]"), (b"12345678@host 7654321", b"[address] [number]"), (b"a@b@c@d 1@", b"[address]@[address]"), (b"@@ 12345678", b"@@ [number]")):
        tree = tokencounts.TokenTree(raw, PATH)
        edits = tokencounts.redactions(raw)
        assert tree.apply(edits).startswith(new) and tree.applied == len(edits) and tree.total == count(tree.raw)


def test_long_values_take_seconds():
    began = time.time()
    for raw in (b"x" * 1_000_000 + b" a@b", b"a@" * 500_000, b"1" * 1_000_000, b"12345678 " * 100_000, b"word " * 200_000 + b"me@x"):
        tokencounts.redactions(raw)
    tree = tokencounts.TokenTree(b"12345678 " * 50_000, PATH)
    tree.apply(tokencounts.redactions(tree.raw))
    assert tree.applied == 50_000 and time.time() - began < 60
