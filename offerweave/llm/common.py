"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 16


def bound_batches(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Small Arrow batches for this session, so that long texts do not add up in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """One object per Python worker process, kept across tasks.

    ``name`` is ``family:rest``.  A worker keeps one family at a time, so the caches of earlier
    stages do not add up in a worker that Spark uses again.
    """
    held = sys.__dict__.setdefault("_offerweave_cache", {})
    if name not in held:
        family = name.partition(":")[0]
        for other in [x for x in held if x.partition(":")[0] != family]:
            del held[other]
        give_back()
        held[name] = make()
    return held[name]


def give_back() -> None:
    """Return what this process has freed to the system, where the C library can: workers share their executor's memory."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Bounded(dict):
    """A dict that computes missing values and forgets everything beyond ``most`` keys."""

    def __init__(self, make: Callable, most: int = 400_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slice batches so that ``column`` has about ``most`` bytes in each, one row at least."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, int(rows * most / max(1, batch.column(column).nbytes)))
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def body(text: str = "text") -> list[Column]:
    """Two 64-bit hashes that stand for a whole text, ``b1`` and ``b2``.

    Decisions on a text are carried by these and not by doc_id: rows without an id, and rows that
    share an id but not their text, are then told apart.
    """
    return [F.xxhash64(F.col(text)).alias("b1"), F.xxhash64(F.lit("body"), F.col(text)).alias("b2")]


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], by: list[str], max_rows: int, how: str = "inner") -> DataFrame:
    """Join on ``keys`` of which a few may hold most rows of ``left``.

    ``right`` is a written table.  With at most ``max_rows`` rows it is broadcast.  Beyond that
    it is repeated for every salt and ``left`` is dealt over the salts by a hash of ``by``.
    """
    if right.limit(max_rows + 1).count() <= max_rows:
        return left.join(F.broadcast(right), keys, how)
    salted = left.withColumn("__offerweave_salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
    every = right.withColumn("__offerweave_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return salted.join(every, [*keys, "__offerweave_salt"], how).drop("__offerweave_salt")


def without_texts(docs: DataFrame, gone: DataFrame, max_rows: int) -> DataFrame:
    """``docs`` without the rows whose text is one of ``gone(b1, b2)``, a written table; columns as they were."""
    names = {"b1": "__offerweave_b1", "b2": "__offerweave_b2"}
    marked = docs.withColumns({names[c]: x for c, x in zip(names, body(), strict=True)})
    left = join_hot(marked, gone.select("b1", "b2").withColumnsRenamed(names), list(names.values()), ["doc_id"], max_rows, "left_anti")
    return left.select(*docs.columns)


def crc_mod(name: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``: the fold rule of the classifiers."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % mod


def words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased, in order; an empty array if there are none."""
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return once(clean, lambda c: F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, " ")))


def word_count(text: Column) -> Column:
    """How many words ``word_shingles`` sees."""
    return F.size(words(text))


def word_shingles(text: Column, size: int = 5) -> Column:
    """Hashes of all ``size``-word windows, in order; fewer words give one, no words none.

    Built-in functions only.
    """
    return once(words(text), lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(shingles_of(w, size)))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda's argument is not repeated in its body."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingles_of(words: Column, size: int) -> Column:
    """Hashes of the ``size``-word windows of at least one word; fewer words than that give one."""
    places = F.sequence(F.lit(0), F.size(words) - size)
    windows = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.when(F.size(words) >= size, windows).otherwise(F.array(F.xxhash64(F.concat_ws(" ", words))))
