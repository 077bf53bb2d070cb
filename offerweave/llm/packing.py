"""Best-fit packing planned on a histogram of lengths.

Tokenised documents are cut into pieces of at most ``capacity`` tokens.  Only the counts
of the lengths (at most ``capacity`` rows) reach the driver, which runs best-fit
decreasing over counts: a group of equal sequences takes as many items of one length as
fit, so the work depends on the number of lengths and not on the number of documents.
The plan is a table of slot runs; a piece finds its slot by joining on its length and its
rank among the pieces of that length.  Ranks are counted within (length, salt) and shifted
by the counts of the earlier salts, so one very common length is shared by many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerweave.llm.common import bound_batches, give_back, small_batches, text_or_empty, worker_cache
from offerweave.plans.scratch import materialize

CAPACITY = 2048
SALTS = 256
BROADCAST_ROWS = 200_000
VOCABULARY = "word_bpe_49k.json"
_MARKS = (b".", b",", b";", b":", b"!", b"?")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the public tokenizer files are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkIds:
    """Ids of chunks of bytes without ASCII white space, as little-endian unsigned 32-bit integers.

    The tokenizer collapses white space and never joins across it, so the ids of a text are
    those of its chunks in order.  It also parts letters from marks, so letters that end in one
    mark are looked up as both.  New chunks of letters are encoded many at once and told apart
    by the word ends among the ids.  Between batches two generations of ``most`` chunks are kept:
    what is still used moves from the old one to the new one, the rest is forgotten with it.
    """

    def __init__(self, path: str, most: int = 250_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.known, self.old = Tokenizer.from_file(path), most, {}, {}
        words = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def counts(self, chunks: list[bytes]) -> np.ndarray:
        """How many ids each chunk has."""
        self.learn(set(chunks))
        return np.fromiter(map(len, map(self.known.__getitem__, chunks)), np.int64, len(chunks)) // 4

    def learn(self, chunks: set[bytes]) -> None:
        """Make sure that all ``chunks`` are known."""
        if len(self.known) > self.most:
            self.known, self.old = {}, self.known
        new = chunks.difference(self.known)
        if not new:
            return
        letters, parted = set(), []
        again = self.old.keys() & new
        self.known.update(zip(again, map(self.old.__getitem__, again), strict=True))
        for chunk in new - again:
            if chunk.isalpha():  # ASCII letters
                letters.add(chunk)
                continue
            core = chunk[:-1] if chunk[-1:] in _MARKS else chunk
            text = "a" if core.isalpha() else core.decode("utf-8", "replace")
            if not (text.isalpha() and text.lower().isalpha()):
                self.known[chunk] = self._ids(chunk.decode("utf-8", "replace")).tobytes()
                continue
            letters.add(core)
            if core is not chunk:
                parted.append(chunk)
        letters = letters.difference(self.known)
        again = self.old.keys() & letters
        self.known.update(zip(again, map(self.old.__getitem__, again), strict=True))
        new = list(letters - again)
        for at in range(0, len(new), 1000):
            part = new[at : at + 1000]
            ids = self._ids(b" ".join(part).decode("utf-8", "replace"))
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            raw = ids.tobytes()
            if len(cuts) == len(part):
                self.known.update(zip(part, (raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)), strict=True))
            else:
                self.known.update((c, self._ids(c.decode("utf-8", "replace")).tobytes()) for c in part)
        for chunk in parted:
            mark = chunk[-1:]
            if mark not in self.known:
                self.known[mark] = self._ids(mark.decode()).tobytes()
            self.known[chunk] = self.known[chunk[:-1]] + self.known[mark]


def encode(texts: list[str], path: str) -> list[bytes]:
    """Each text's ids and the closing id 0, four bytes each.

    The tokenizer lower-cases; doing so first for A-Z makes chunks equal more often.  Texts that
    may hold one of its special tokens, which it looks for before that, are left as they are.
    """
    held = worker_cache(f"ids:{path}", lambda: ChunkIds(path))
    raws = [t.encode("utf-8", "replace") for t in texts]
    chunked = [(r if b"<|" in r else r.lower()).split() for r in raws]
    held.learn(set().union(*chunked))
    return [b"".join(map(held.known.__getitem__, c)) + b"\0\0\0\0" for c in chunked]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document; null text counts as empty."""
    bound_batches(docs.sparkSession)
    path = path or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            out: list[list] = [[], [], [], [], []]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist(), path), strict=True):
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(out, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()

    one = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return one.mapInArrow(cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Returns runs ``(length, first_rank, end_rank, first_sequence, per_sequence, offset)``: the
    item of rank r goes to sequence first_sequence + (r - first_rank) // per_sequence, at
    offset + ((r - first_rank) % per_sequence) * length.
    """
    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by space left: (first sequence, sequences)
    runs, used = [], 0
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit into {capacity}")
        left, rank, space = histogram[length], 0, length
        while left:
            while space <= capacity and not free[space]:
                space += 1
            if space > capacity:
                space = capacity
                count = -(-left // (capacity // length))
                first, used = used, used + count
            else:
                first, count = free[space].pop()
            fit = space // length
            whole = min(count, left // fit)
            for first_here, many, per in ((first, whole, fit), (first + whole, int(whole < count and left - whole * fit > 0), left - whole * fit)):
                if many:
                    runs.append((length, rank, rank + many * per, first_here, per, capacity - space))
                    free[space - per * length].append((first_here, many))
                    rank, left, first, count = rank + many * per, left - many * per, first_here + many, count - many
            if count:
                free[space].append((first, count))
            space = length
    return runs


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> one row per piece with its ``sequence_id`` and ``offset``.

    Null and empty texts are one piece of the closing id.  Repeated rows are packed as often as
    they occur.  Extra columns are ignored; no rows give no rows.
    """
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int")
    cut = materialize(pieces(docs, capacity, path).withColumn("salt", salt), "pieces")
    counts = materialize(cut.groupBy("length", "salt").agg(F.count("*").alias("c")), "counts")
    histogram = {r["length"]: r["c"] for r in counts.groupBy("length").agg(F.sum("c").alias("c")).collect()}
    schema = "length bigint, first_rank bigint, end_rank bigint, first_sequence bigint, per_sequence bigint, base bigint"
    runs = plan_slots(histogram, capacity)
    slots = docs.sparkSession.createDataFrame(runs, schema).withColumnRenamed("length", "slot_length")
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("length", "salt", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("shift"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("rank", F.row_number().over(within)).join(shifts, ["length", "salt"]).withColumn("rank", F.col("rank") - 1 + F.col("shift"))
    at = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank"))
    # runs follow the lengths and not the documents: some for each of at most ``capacity`` lengths
    slots = F.broadcast(slots) if len(runs) <= BROADCAST_ROWS else slots
    placed = ranked.join(slots, (F.col("length") == F.col("slot_length")) & at)
    nth = F.col("rank") - F.col("first_rank")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).alias("sequence_id"),
        (F.col("base") + F.pmod(nth, F.col("per_sequence")) * F.col("length")).alias("offset"),
    )
