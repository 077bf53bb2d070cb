"""Benchmark decontamination by SimHash of item-sized windows.  Built-in functions only.

Texts become sequences of hashes of their 5-word shingles.  A window has as many shingles
as a benchmark item; its 63-bit SimHash is compared with those of all items through
multi-index blocks: 63 bits in 6 blocks, so fingerprints within 17 bits agree in some block
up to 2 bits, and the index holds every value within 2 bits of each item's block.  All
fingerprints within the radius are found, and each pair is kept at its first block only.
The weighted similarity of the shingles (weight: how often each occurs; sum of minima over
sum of maxima) then verifies candidates exactly.

Not every window needs a fingerprint.  A window similar to an item lacks at most a quarter
of the item's shingles, so it holds at least one of any quarter-and-one of them.  Those
seeds are looked up in all documents first; only windows that hold a seed are signed.

Texts are told apart by their hashes and not by doc_id: equal texts are examined once, and an
id with several texts gets the items of each.

Items longer than ``MAX_WINDOW`` shingles have no fingerprint.  All places of their shingles
are looked up instead, and the similarity of every item-sized window follows from these
places exactly: an occurrence counts for the windows that hold it but not the occurrence
that is as many occurrences earlier as the item has of that shingle, which is a range of
window starts; summing the ranges gives the minima of all windows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerweave.llm.common import body, join_hot, without_texts, word_shingles
from offerweave.plans.scratch import broadcast_if_small, materialize

MAX_WINDOW = 250
RADIUS = 17
LIMIT = 0.75
BROADCAST_ROWS = 500_000
_LANES, _WIDTH = 7, 9
_ONES = sum(1 << (_WIDTH * j) for j in range(_LANES))
_SIZES = (11, 11, 11, 10, 10, 10)
_NEAR = RADIUS // len(_SIZES)


def simhash(shingles: Column) -> Column:
    """63-bit SimHash of an array of at most 255 hashes; a bit is set if most hashes have it.

    Seven counters of nine bits share one long, so nine sums count all bits.
    """
    zero = F.struct(*[F.lit(0).cast("bigint").alias(f"c{k}") for k in range(_WIDTH)])
    sums = F.aggregate(
        shingles, zero,
        lambda s, x: F.struct(*[(s[f"c{k}"] + F.shiftrightunsigned(x, k).bitwiseAND(F.lit(_ONES))).alias(f"c{k}") for k in range(_WIDTH)]),
    )
    raise_by = (F.lit(255) - F.floor(F.size(shingles) / 2)) * F.lit(_ONES)
    return F.transform(F.array(sums), lambda s: _majority(s, raise_by))[0]


def _majority(s: Column, raise_by: Column) -> Column:
    out = F.lit(0).cast("bigint")
    for k in range(_WIDTH):
        over = F.shiftrightunsigned((s[f"c{k}"] + raise_by).bitwiseAND(F.lit(_ONES << (_WIDTH - 1))), _WIDTH - 1)
        out = out.bitwiseOR(F.shiftleft(over, k))
    return out


def _blocks() -> list[tuple[int, int]]:
    at, out = 0, []
    for size in _SIZES:
        out.append((at, size))
        at += size
    return out


def _block(fp: str, b: int) -> Column:
    at, size = _blocks()[b]
    return F.shiftrightunsigned(F.col(fp), at).bitwiseAND(F.lit((1 << size) - 1)).cast("int")


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """``(item_id, shingles, n)`` of the items that have words."""
    items = benchmark.select("item_id", word_shingles(F.col("text")).alias("shingles")).filter(F.size("shingles") > 0)
    return items.withColumn("n", F.size("shingles"))


def _index(items: DataFrame) -> DataFrame:
    """``(block, value, ...)`` for every value within reach of each item's blocks."""
    flips = [(b, sum(1 << i for i in bits)) for b, (_, size) in enumerate(_blocks()) for r in range(_NEAR + 1) for bits in combinations(range(size), r)]
    every = F.explode(F.array(*[F.struct(F.lit(b).alias("block"), F.lit(f).alias("flip")) for b, f in flips]))
    own = F.array(*[_block("item_fp", b) for b in range(len(_SIZES))])
    rows = items.withColumn("item_fp", simhash(F.col("shingles"))).select("item_id", "item_fp", own.alias("own"), every.alias("k"))
    return rows.select("k.block", F.get("own", F.col("k.block")).bitwiseXOR(F.col("k.flip")).alias("value"), "item_id", "item_fp")


def _similarity(a: str, b: str) -> Column:
    """Sum of minima over sum of maxima of how often each shingle occurs."""
    common = F.array_intersect(a, b)
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    times = lambda c, x: F.size(F.filter(F.col(c), lambda y: y == x))
    counted = F.aggregate(common, F.lit(0), lambda s, x: s + F.least(times(a, x), times(b, x)))
    low = F.when(plain, F.size(common)).otherwise(counted)
    return low / (F.size(a) + F.size(b) - low)


def _long_windows(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``(b1, b2, item_id, start, n, similarity)`` of item-sized windows; of each run of equal windows the first.

    ``texts`` are ``(b1, b2, all)``.  Everything is in proportion to the places found.
    """
    known = items.select("item_id", F.col("n").alias("m"), F.explode("shingles").alias("seed")).groupBy("item_id", "m", "seed").agg(F.count("*").cast("int").alias("times"))
    places = texts.select("b1", "b2", F.size("all").alias("size"), F.posexplode("all").alias("pos", "seed"))
    places = join_hot(places, materialize(known, "long-items"), ["seed"], ["b1", "pos"], BROADCAST_ROWS)
    pair = ["b1", "b2", "size", "item_id", "m"]
    lists = places.groupBy(*pair, "seed", "times").agg(F.sort_array(F.collect_set("pos")).alias("p"))
    earlier = lambda i: F.when(i >= F.col("times"), F.get("p", i - F.col("times")) + 1).otherwise(0)
    ranges = F.transform("p", lambda x, i: F.struct(F.greatest(earlier(i), x - F.col("m") + 1).alias("lo"), (x + 1).alias("hi")))
    ends = lists.select(*pair, F.explode(ranges).alias("r")).select(*pair, F.explode(F.array(F.struct(F.col("r.lo").alias("start"), F.lit(1).alias("d")), F.struct(F.col("r.hi").alias("start"), F.lit(-1).alias("d")))).alias("e"))
    steps = ends.select(*pair, "e.start", "e.d").groupBy(*pair, "start").agg(F.sum("d").alias("d"))
    low = F.sum("d").over(Window.partitionBy(*pair).orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
    width = F.least("size", "m")
    swept = steps.withColumn("low", low).filter(F.col("start") <= F.greatest(F.lit(0), F.col("size") - F.col("m")))
    return swept.select("b1", "b2", "item_id", "start", width.alias("n"), (F.col("low") / (width + F.col("m") - F.col("low"))).alias("similarity"))


def _windows(texts: DataFrame, seeds: DataFrame) -> DataFrame:
    """``(b1, b2, n, start, window)`` of the windows of ``texts(b1, b2, all)`` that hold a seed, each once.

    Hits of one stretch of a text are gathered by size and tile; windows that begin in the tile
    are made once.  Where the seeds are too many to broadcast, places alone are shuffled and the
    stretches are cut from the texts afterwards.
    """
    small = seeds.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    tile = F.floor(F.col("pos") / F.col("n")).cast("int")
    region = F.slice("all", F.col("tile") * F.col("n") + 1, F.col("n") * 2 - 1)
    carried = ["b1", "b2", "all"] if small else ["b1", "b2"]
    hits = join_hot(texts.select(*carried, F.size("all").alias("size"), F.posexplode("all").alias("pos", "seed")), seeds, ["seed"], ["b1", "pos"], BROADCAST_ROWS)
    spread = hits.select(*carried, "size", "n", "pos", F.explode(F.array(tile - 1, tile)).alias("tile")).filter((F.col("tile") >= 0) & (F.col("tile") * F.col("n") < F.col("size")))
    rows = spread.select("b1", "b2", "n", "tile", (F.col("pos") - F.col("tile") * F.col("n")).alias("at"), *([region.alias("region")] if small else []))
    tiles = rows.groupBy("b1", "b2", "n", "tile").agg(F.min("at").alias("lo"), F.max("at").alias("hi"), *([F.first("region").alias("region")] if small else []))
    if not small:
        stretch = F.struct("n", "tile", "lo", "hi")
        held = tiles.groupBy("b1", "b2").agg(F.collect_list(stretch).alias("tiles"))
        each = texts.dropDuplicates(["b1", "b2"]).join(held, ["b1", "b2"]).select("b1", "b2", "all", F.explode("tiles").alias("t"))
        tiles = each.select("b1", "b2", "all", "t.*").select("b1", "b2", "n", "tile", "lo", "hi", region.alias("region"))
    begin = F.greatest(F.lit(0), F.col("lo") - F.col("n") + 1)
    end = F.least(F.col("hi"), F.col("n") - 1, F.greatest(F.lit(0), F.size("region") - F.col("n")))
    starts = F.when(begin <= end, F.sequence(begin, end)).otherwise(F.array().cast("array<int>"))
    windows = tiles.select("b1", "b2", "n", (F.col("tile") * F.col("n")).alias("base"), "region", F.explode(starts).alias("off"))
    return windows.select("b1", "b2", "n", (F.col("base") + F.col("off")).alias("start"), F.slice("region", F.col("off") + 1, F.col("n")).alias("window"))


def _held(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(b1, b2, item_id, similarity, start, n)`` of each different text and item that it holds, as a written table."""
    every = materialize(item_shingles(benchmark), "items")
    items, long = every.filter(F.col("n") <= MAX_WINDOW), every.filter(F.col("n") > MAX_WINDOW)
    seeds = items.select("n", F.explode(F.array_distinct(F.filter("shingles", lambda x, i: (i % 4 == 0) | (i == F.size("shingles") - 1)))).alias("seed"))
    # one row for each seed and size: which item it comes from does not matter to the windows
    seeds = materialize(seeds.select("seed", "n").distinct(), "seeds")
    texts = docs.filter("text is not null").select(*body(), word_shingles(F.col("text")).alias("all")).filter(F.size("all") > 0)
    signed = _windows(texts, seeds).withColumn("fp", simhash(F.col("window")))
    keys = F.array(*[F.struct(F.lit(b).alias("block"), _block("fp", b).alias("value")) for b in range(len(_SIZES))])
    probes = signed.select("b1", "b2", "start", "window", "fp", F.explode(keys).alias("k")).select("b1", "b2", "start", "window", "fp", "k.block", "k.value")
    differ = F.col("fp").bitwiseXOR(F.col("item_fp"))
    within = [F.bit_count(differ.bitwiseAND(F.lit(((1 << size) - 1) << at))) <= _NEAR for at, size in _blocks()]
    first = F.lit(False)
    for b in range(len(_SIZES)):
        mine = F.col("block") == b
        for earlier in within[:b]:
            mine = mine & ~earlier
        first = first | mine
    index = broadcast_if_small(materialize(_index(items), "simhash-index"), BROADCAST_ROWS)
    near = probes.join(index, ["block", "value"]).filter((F.bit_count(differ) <= RADIUS) & first).select("b1", "b2", "start", "window", "item_id")
    bodies = broadcast_if_small(items.select("item_id", "shingles"), BROADCAST_ROWS // 10)
    checked = near.join(bodies, "item_id").select("b1", "b2", "item_id", "start", F.size("window").alias("n"), _similarity("window", "shingles").alias("similarity"))
    if not long.isEmpty():
        checked = checked.unionByName(_long_windows(texts, long))
    best = checked.filter(F.col("similarity") >= LIMIT).groupBy("b1", "b2", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n")).alias("x"))
    return materialize(best.select("b1", "b2", "item_id", F.col("x.similarity").alias("similarity"), (-F.col("x.s")).cast("bigint").alias("start"), F.col("x.n").cast("bigint").alias("n")), "held-items")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, similarity, start_shingle, n_shingles)`` for each document and item that it holds.

    The best window counts, the earliest of equals.  Null, empty and blank texts and items
    match nothing; a text shorter than an item is one window; a text of fewer than five words
    is one shingle.  Repeated rows count once; of several texts with one doc_id the best window
    counts; a null doc_id is left out; an item_id with several texts is several items, and a
    null one is none; extra columns are ignored; no rows on either side give no rows.
    """
    rows = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), *body())
    both = join_hot(rows, _held(docs, benchmark), ["b1", "b2"], ["doc_id"], BROADCAST_ROWS)
    best = both.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n")).alias("x"))
    return best.select("doc_id", "item_id", F.col("x.similarity").alias("similarity"), (-F.col("x.s")).alias("start_shingle"), F.col("x.n").alias("n_shingles"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item.

    Only the text decides: rows without an id go as well, rows of one id and different texts are
    judged each by itself, equal rows stay or go together.  Null, empty and blank texts stay.
    All columns stay as they were.
    """
    gone = materialize(_held(docs, benchmark).select("b1", "b2").distinct(), "held-texts")
    return without_texts(docs, gone, BROADCAST_ROWS)
