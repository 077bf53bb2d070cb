"""Token counts that follow edits.

A document's pre-tokens (runs without ASCII white space, which the tokenizer never joins)
are the leaves of a segment tree of token counts.  Trees are kept as a table: the text, and
each leaf's gap, length and count.  An edit re-encodes only the leaves that it touches, with
the text between them, and updates the sums on the paths to the root.  The first touched leaf
then holds the whole new stretch and the others none, so the tree keeps its shape and takes
further edits, in offsets of the text as it is by then.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.llm.common import bound_batches, small_batches, text_or_empty, worker_cache
from offerweave.llm.packing import ChunkIds, vocabulary_path
from offerweave.plans.scratch import materialize

#: What a redaction replaces: addresses with an at sign, and long runs of digits.  An address
#: begins where a run without blanks and at signs does, so each run is read once.
_AT = re.compile(rb"(?<![^\s@])[^\s@]++@[^\s@]++")
_DIGITS = re.compile(rb"[0-9]{7,}+")

TREES = "doc_id bigint, text binary, leaves binary, n_tokens bigint"
EDITS = "array<struct<start:bigint,stop:bigint,new:binary>>"


def _spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens."""
    codes = np.frombuffer(raw, np.uint8)
    solid = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    edge = np.diff(np.concatenate([[0], solid.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _chunks(raw: bytes) -> list[bytes]:
    """The pre-tokens; the tokenizer lower-cases, so doing it first makes more of them equal (special tokens need their case)."""
    return (raw if b"<|" in raw else raw.lower()).split()


class TokenTree:
    """Token counts of one text's leaves, with sums over all subtrees."""

    def __init__(self, raw: bytes, path: str, leaves: bytes | None = None):
        """Encode ``raw``, or take the counts that ``leaves`` (of ``stored``) holds without encoding."""
        self.raw = raw
        self.known = worker_cache(f"ids:{path}", lambda: ChunkIds(path))
        if leaves is None:
            counts = self.known.counts(_chunks(raw))
            self.starts, self.ends = _spans(raw)
        else:
            gaps, sizes, counts = np.frombuffer(zlib.decompress(leaves[1:]), f"<u{leaves[0]}").astype(np.int64).reshape(3, -1)
            self.ends = np.cumsum(gaps + sizes)
            self.starts = self.ends - sizes
        if not len(self.starts):  # a text without pre-tokens has one empty leaf
            self.starts, self.ends, counts = np.zeros(1, np.int64), np.zeros(1, np.int64), [0]
        self.width = 1 << (len(self.starts) - 1).bit_length()
        self.sums = np.zeros(2 * self.width, np.int64)
        self.sums[self.width : self.width + len(self.starts)] = counts
        at = self.width
        while at > 1:
            self.sums[at // 2 : at] = self.sums[at : 2 * at : 2] + self.sums[at + 1 : 2 * at : 2]
            at //= 2
        self.reencoded = self.applied = 0

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def stored(self) -> bytes:
        """Gaps, lengths and counts of the leaves, in as many bytes each as the first byte says; inner sums are additions away."""
        gaps = self.starts - np.concatenate([[0], self.ends[:-1]])
        leaves = np.stack([gaps, self.ends - self.starts, self.sums[self.width : self.width + len(self.starts)]])
        size = 1 if leaves.max() < 1 << 8 else 2 if leaves.max() < 1 << 16 else 4 if leaves.max() < 1 << 32 else 8
        return bytes([size]) + zlib.compress(leaves.astype(f"<u{size}").tobytes(), 1)

    def _set(self, leaf: int, value: int) -> None:
        at = self.width + leaf
        change = value - int(self.sums[at])
        while at and change:
            self.sums[at] += change
            at //= 2

    def apply(self, edits: list[tuple[int, int, bytes]]) -> bytes:
        """Apply edits (start, end, replacement) in byte offsets of the present text; returns the new text.

        Edits are taken in order of their place.  One that starts before the end of an earlier
        one, or does not lie within the text, is left out; ``applied`` counts the others.
        """
        regions: list[list] = []
        last, n = -1, len(self.starts)
        for start, end, new in sorted(edits, key=lambda e: (e[0], e[1])):
            if not 0 <= start <= end <= len(self.raw) or start < last:
                continue
            first = int(np.searchsorted(self.ends, start, "left"))  # leaves that end at or after the start
            after = int(np.searchsorted(self.starts, end, "right"))  # ... and begin at or before the end
            if first >= after:  # between leaves: the next one, or the last, takes the new text
                first = min(first, n - 1)
                after = first + 1
            low, high = min(start, int(self.starts[first])), max(end, int(self.ends[after - 1]))
            if regions and (first < regions[-1][3] or low <= regions[-1][1]):
                region = regions[-1]
                region[1], region[3] = max(region[1], high), max(region[3], after)
            else:
                region = [low, high, first, after, []]
                regions.append(region)
            region[4].append((start, end, new))
            last = end
            self.applied += 1
        parts, done, moved = [], 0, np.zeros(n + 1, np.int64)
        for low, high, first, after, own in regions:
            text, at = [], low
            for start, end, new in own:
                text += [self.raw[at:start], new]
                at = end
            stretch = b"".join([*text, self.raw[at:high]])
            parts += [self.raw[done:low], stretch]
            done = high
            self.reencoded += len(stretch)
            self._set(first, int(self.known.counts(_chunks(stretch)).sum()))
            for leaf in range(first + 1, after):
                self._set(leaf, 0)
            self.starts[first], self.ends[first] = low, low + len(stretch)
            self.starts[first + 1 : after] = self.ends[first + 1 : after] = low + len(stretch)
            moved[after] += len(stretch) - (high - low)
        shift = np.cumsum(moved)[:-1]
        self.starts, self.ends = self.starts + shift, self.ends + shift
        self.raw = b"".join([*parts, self.raw[done:]])
        return self.raw


def redactions(raw: bytes) -> list[tuple[int, int, bytes]]:
    """Edits that replace addresses and, outside these, long numbers; none overlap."""
    found = [(m.start(), m.end(), b"[address]") for m in _AT.finditer(raw)] if b"@" in raw else []
    ends = np.array([e for _, e, _ in found], np.int64)
    starts = np.array([s for s, _, _ in found], np.int64)
    for m in _DIGITS.finditer(raw):
        at = int(np.searchsorted(ends, m.start(), "right"))
        if at == len(ends) or m.end() <= starts[at]:
            found.append((m.start(), m.end(), b"[number]"))
    return found


def build_trees(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, text, leaves, n_tokens)``: the tree of each row of ``docs(doc_id, text, ...)``."""
    bound_batches(docs.sparkSession)
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = worker_cache(f"ids:{path}", lambda: ChunkIds(path))
        for batch in small_batches(batches, "text", 2 << 20):
            raws = [t.encode("utf-8", "replace") for t in batch.column("text").to_pylist()]
            held.learn(set().union(*map(_chunks, raws)))
            trees = [TokenTree(r, path) for r in raws]
            columns = [pa.array(raws, pa.binary()), pa.array([t.stored() for t in trees], pa.binary()), pa.array([t.total for t in trees], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "text", "leaves", "n_tokens"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, TREES)


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """``trees`` with the column ``edits``, gathered from ``edits(doc_id, start, stop, new)``; null ids match null ids.

    Edits of an id go to every tree of that id.
    """
    own = edits.groupBy(F.col("doc_id").alias("__offerweave_doc")).agg(F.collect_list(F.struct("start", "stop", "new")).alias("edits"))
    joined = trees.join(own, trees["doc_id"].eqNullSafe(own["__offerweave_doc"]), "left").drop("__offerweave_doc")
    return joined.withColumn("edits", F.coalesce("edits", F.array().cast(EDITS)))


def found_edits(trees: DataFrame, edits_of: Callable[[bytes], list] = redactions) -> DataFrame:
    """``trees`` with the column ``edits`` of what ``edits_of`` finds in each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("new", pa.binary())]))
        for batch in small_batches(batches, "text"):
            found = [[{"start": a, "stop": b, "new": c} for a, b, c in edits_of(raw)] for raw in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, "edits"])

    return trees.mapInArrow(run, f"{TREES}, edits {EDITS}")


def edit_trees(trees: DataFrame, path: str | None = None) -> DataFrame:
    """Apply each row's ``edits`` to its tree: the new trees, and what it took.

    Adds n_tokens_before, n_edits (those applied), reencoded_bytes and text_bytes (before).
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows = []
            for raw, leaves, before, edits in zip(*(batch.column(c).to_pylist() for c in ("text", "leaves", "n_tokens", "edits")), strict=True):
                if not edits:
                    rows.append((raw, leaves, before, before, 0, 0, len(raw)))
                    continue
                tree = TokenTree(raw, path, leaves)
                new = tree.apply([(e["start"], e["stop"], e["new"] or b"") for e in edits])
                rows.append((new, tree.stored(), tree.total, before, tree.applied, tree.reencoded, len(raw)))
            kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 5]
            names = ["doc_id", "text", "leaves", "n_tokens", "n_tokens_before", "n_edits", "reencoded_bytes", "text_bytes"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=names)

    bound_batches(trees.sparkSession)
    return trees.select("doc_id", "text", "leaves", "n_tokens", "edits").mapInArrow(run, f"{TREES}, n_tokens_before bigint, n_edits bigint, reencoded_bytes bigint, text_bytes bigint")


def counts_after_edits(docs: DataFrame, edits_of: Callable[[bytes], list] = redactions, path: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens_before, n_tokens_after, n_edits, reencoded_bytes, text_bytes)`` per document.

    The trees are written, read again and edited; ``edits_of`` gives a text's edits.  Null and
    empty texts have 0 tokens.  Rows are taken one by one: repeated rows give repeated results,
    null and clashing ids are passed on.  Of overlapping edits the first by place is applied and
    counted.  Extra columns are ignored; no rows give no rows.
    """
    trees = materialize(build_trees(docs, path), "trees", "zstd")
    return edit_trees(found_edits(trees, edits_of), path).select(
        "doc_id", "n_tokens_before", F.col("n_tokens").alias("n_tokens_after"), "n_edits", "reencoded_bytes", "text_bytes"
    )
