"""Near-duplicate documents by circulant MinHash, with exact verification.

Signatures use two permutations only.  The first, sigma, spreads shingles over a
domain of 2**20 places; the second, pi, is read through windows that are shifted by one
place per coordinate: coordinate k of a shingle at place s is pi[(s + k) mod D].  The
coordinates of a shingle are therefore one contiguous slice of pi, and a signature is the
element-wise minimum of such slices.

60 bands of 6 coordinates: two sets at the similarity limit 0.75 share no band with
probability (1 - 0.75**6)**60 = 8e-6; two at 0.3 share one with probability 0.04.

Two low bits of every coordinate are kept as a sketch.  Sets at the limit agree so often
that an estimate below 0.62 has probability 2e-6; such pairs are not verified.

Shape of the plan: equal shingle sets collapse to one class first, so copies cost one
row.  A bucket is never expanded into all its pairs: its members meet its smallest
member, verified links are contracted to components, and only members of a bucket that
are still in different components meet each other.  That join's own condition compares
sketches, then sets of 32-bit hashes (whose collisions can only raise the similarity), so
it puts out little more than the missing links.  Every link is confirmed on the full
sets, from the full texts.

Classes are numbered when they are written, and the graph is one of these numbers.  Ids come
in at the end: a component is named after its smallest doc_id.  So rows without an id, and an
id with several texts, tie nothing together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.llm.common import Bounded, body, bound_batches, join_hot, small_batches, worker_cache
from offerweave.operators.components import connected_components
from offerweave.plans.scratch import materialize

PLACES = 1 << 20
BANDS, ROWS = 60, 6
SKETCH = BANDS * ROWS // 30
#: Sketch places of 360 that may differ: 360 * (1 - 0.62) * 3 / 4.
MAX_DIFFER = 102
BROADCAST_ROWS = 500_000

_SIGS = pa.schema([("doc_id", pa.int64()), ("b1", pa.int64()), ("b2", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's ``size``-word shingles.

    Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased.  Fewer words
    than ``size`` give one shingle of all words; null and blank texts give none.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(w) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    n = len(w) - size + 1
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w[k : k + n])
    return np.unique(h)


def _slices() -> np.ndarray:
    pi = np.random.default_rng(20240229).permutation(PLACES).astype(np.int32)
    width = BANDS * ROWS
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[: width - 1]]), width)


def band_keys(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band values of a set, as 64-bit keys that also hold the band's number, and its sketch."""
    if not len(hashes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    slices = worker_cache("sets:circulant", _slices)
    places = (_mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(44)).astype(np.int64)
    low = None
    for at in range(0, len(places), 512):
        part = slices[places[at : at + 512]].min(axis=0)
        low = part if low is None else np.minimum(low, part)
    rows = low.astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(ROWS):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    two = (low & 3).astype(np.int64).reshape(SKETCH, 30) << np.arange(0, 60, 2)
    return key.view(np.int64), two.sum(axis=1)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    copies = worker_cache("sets:copies", lambda: Bounded(lambda _: None, 4_000))
    for batch in small_batches(batches, "text"):
        sizes, digests, bands, sketches = [], [], [], []
        for text in batch.column("text").to_pylist():
            s = shingle_set(text)
            sizes.append(len(s))
            digest = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
            digests.append(digest)
            known = copies[digest]
            if known is None:
                known = copies[digest] = band_keys(s)
            bands.append(known[0])
            sketches.append(known[1])
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "b1", "b2")), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))], schema=_SIGS)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets = worker_cache("sets:texts", lambda: Bounded(shingle_set, 64))
    for batch in small_batches(batches, "text_a"):
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        ok = []
        for left, right in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True):
            x, y = sets[left], shingle_set(right)
            both = int(np.isin(y, x, assume_unique=True, kind="sort").sum()) if len(x) and len(y) else 0
            ok.append(both > 0 and 100 * both >= 75 * (len(x) + len(y) - both))
        keep = [i for i, good in enumerate(ok) if good]
        yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["src", "dst"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose sets are similar enough, as edges ``(src, dst)``."""
    one = pairs.join(texts.select(F.col("class_id").alias("b"), F.col("text").alias("text_b")), "b")
    two = one.join(texts.select(F.col("class_id").alias("a"), F.col("text").alias("text_a")), "a")
    return materialize(two.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "src bigint, dst bigint"), "links")


def _alike(n: str, m: str):
    """Sets whose sizes differ by more cannot reach the similarity."""
    return (F.col(n) * 100 >= F.col(m) * 75) & (F.col(m) * 100 >= F.col(n) * 75)


def _mixed(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows, without hubs, of those buckets that hold several components beside the hub."""
    labelled = (
        shared.filter("class_id <> hub").join(parts.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
        .select("key", "class_id", "n", F.coalesce("component", "class_id").alias("part"))
    )
    split = labelled.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo <> hi").select("key")
    return materialize(labelled.join(split, "key", "left_semi"), "mixed")


def _short_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        sets = [np.unique((shingle_set(t) >> np.uint64(32)).astype(np.uint32)).view(np.int32) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("class_id"), pa.array(sets, pa.list_(pa.int32()))], names=["class_id", "hashes"])


def _across(mixed: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of a bucket's members, of different components, that may be similar enough."""
    ids = mixed.select("class_id").distinct()
    sets = texts.join(ids, "class_id", "left_semi").mapInArrow(_short_sets, "class_id bigint, hashes array<int>")
    wide = sets.join(classes.select("class_id", "sketch"), "class_id").join(mixed, "class_id")
    full = wide.select("key", "class_id", "n", "part", "hashes", *[F.get("sketch", F.lit(i)).alias(f"s{i}") for i in range(SKETCH)])
    left, right = (full.select("key", *[F.col(c).alias(f"{side}_{c}") for c in full.columns if c != "key"]) for side in "ab")
    differ = F.lit(0)
    for i in range(SKETCH):
        x = F.col(f"a_s{i}").bitwiseXOR(F.col(f"b_s{i}"))
        differ = differ + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x0555555555555555)))
    both = F.size(F.array_intersect("a_hashes", "b_hashes"))
    # a collision inside one set can hide a common shingle: the shortfall of either set counts as common
    hidden = F.col("a_n") - F.size("a_hashes") + F.col("b_n") - F.size("b_hashes")
    near = (
        (left["key"] == right["key"]) & (F.col("a_class_id") < F.col("b_class_id")) & (F.col("a_part") != F.col("b_part"))
        & _alike("a_n", "b_n") & (differ <= MAX_DIFFER) & ((both + hidden) * 175 >= (F.col("a_n") + F.col("b_n")) * 75)
    )
    return left.join(right, near).select(F.col("a_class_id").alias("a"), F.col("b_class_id").alias("b")).distinct()


def _components(docs: DataFrame) -> DataFrame:
    """``(doc_id, b1, b2, n_shingles, component_id, class_id, component)`` of every row, as a written table.

    ``component`` is the number of the component's first class; ``component_id`` its smallest
    doc_id, null if none of its rows has an id.  Rows without shingles have no class.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *body(), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, b1 bigint, b2 bigint, n_shingles bigint, digest binary, bands array<bigint>, sketch array<bigint>"
    signed = materialize(texts.mapInArrow(_sign, schema), "signatures")
    # null ids come last, and one row stands for a class
    least = F.min(F.struct(F.col("doc_id").isNull().alias("noid"), "doc_id", "b1", "b2")).alias("row")
    classes = materialize(
        signed.filter("digest is not null").groupBy("digest").agg(least, *[F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch")])
        .withColumn("class_id", F.monotonically_increasing_id()),
        "classes",
    )
    rows = classes.select(F.explode("bands").alias("key"), "class_id", F.col("n_shingles").alias("n"))
    hubs = (
        rows.groupBy("key").agg(F.min(F.struct("class_id", "n")).alias("hub"), F.count("*").alias("c"))
        .filter("c > 1").select("key", F.col("hub.class_id").alias("hub"), F.col("hub.n").alias("hub_n"))
    )
    shared = materialize(rows.join(hubs, "key"), "buckets")
    needed = classes.join(shared.select("class_id").distinct(), "class_id", "left_semi")
    needed = materialize(needed.select("class_id", "row.noid", F.coalesce("row.doc_id", F.lit(0)).alias("id0"), "row.b1", "row.b2"), "needed")
    # several equal rows may stand for a class; one text of each is enough
    marked = texts.filter("text is not null").select(F.col("doc_id").isNull().alias("noid"), F.coalesce("doc_id", F.lit(0)).alias("id0"), "b1", "b2", "text")
    found = join_hot(marked, needed, ["noid", "id0", "b1", "b2"], ["id0", "b1"], BROADCAST_ROWS)
    wanted = materialize(found.groupBy("class_id").agg(F.first("text").alias("text")), "texts")
    pairs = shared.filter((F.col("class_id") != F.col("hub")) & _alike("n", "hub_n")).select(F.col("hub").alias("a"), F.col("class_id").alias("b")).distinct()
    links = _verified(pairs, wanted)
    parts = materialize(connected_components(links), "parts")
    mixed = _mixed(shared, parts)
    if not mixed.isEmpty():
        links = links.unionByName(_verified(_across(mixed, classes, wanted), wanted))
        parts = materialize(connected_components(links), "parts")
    placed = classes.select("digest", "class_id", "row.doc_id").join(parts.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
    placed = materialize(placed.select("digest", "class_id", "doc_id", F.coalesce("component", "class_id").alias("component")), "placed")
    names = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = materialize(placed.join(names, "component").select("digest", "class_id", "component", "component_id"), "named")
    out = join_hot(signed.select("doc_id", "b1", "b2", "n_shingles", "digest"), of_class, ["digest"], ["doc_id", "b1"], BROADCAST_ROWS, "left")
    return materialize(out.drop("digest"), "components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> ``(doc_id, n_shingles, component_id, kept)``.

    Two documents are linked if 100 * |A and B| >= 75 * |A or B| for their sets of distinct
    5-word shingles.  ``component_id`` is the smallest doc_id that links reach.  Null, empty
    and blank texts have 0 shingles and are their own component; a text of fewer than five
    words is one shingle.  Repeated rows give repeated results.  Rows with a null doc_id link
    others but have a null component and are never kept.  Rows of one doc_id with different texts
    are linked by their own texts only, so each may have its own component.  Extra columns are
    ignored.  No rows give no rows.
    """
    named = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    return _components(docs).select("doc_id", "n_shingles", named).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that are not the first of their component.

    The first is the one with the smallest doc_id.  Rows without an id go if their component has
    a row with one; else those of its first class stay.  Rows that are equal in id and text
    cannot be told apart and stay or go together.  Texts without words stay.  All columns stay.
    """
    all_rows = _components(docs)
    first = F.when(F.col("component_id").isNotNull(), F.col("doc_id").eqNullSafe(F.col("component_id"))).otherwise(F.col("class_id") == F.col("component"))
    key = [F.col("doc_id").isNull().alias("__offerweave_noid"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("__offerweave_id0")]
    names = ["__offerweave_noid", "__offerweave_id0", "__offerweave_b1", "__offerweave_b2"]
    gone = all_rows.filter(F.col("class_id").isNotNull() & ~first).select(*key, F.col("b1").alias(names[2]), F.col("b2").alias(names[3])).distinct()
    marked = docs.withColumns(dict(zip(names, [*key, *body()], strict=True)))
    return join_hot(marked, materialize(gone, "not-first"), names, names[1:3], BROADCAST_ROWS, "left_anti").select(*docs.columns)
