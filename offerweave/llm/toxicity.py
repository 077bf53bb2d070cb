"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)).
The pairwise part learns what two terms mean together (an insult beside a mention of a
group), which additive weights miss.  Terms are lower-cased words without punctuation and
their beginnings of 4 to 6 letters, and once more those beginnings that several words of
the text share, hashed into 2**20 buckets; only buckets that tell the classes apart in the
training sample get a weight.  In each step of the fit some terms are left out at random, so that
no term relies on the others that mostly come with it.  The model is fitted on the driver on a bounded sample (``max_rows``) of
hashed rows, texts stay on the executors; every document is scored on its whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerweave.llm.common import Bounded, bound_batches, crc_mod, small_batches, text_or_empty, worker_cache
from offerweave.plans.scratch import materialize

BUCKETS = 1 << 20
MAX_ROWS = 6000
#: Characters of all training texts together.
MAX_CHARS = 200_000_000
TERMS = 4096
FACTORS = 4
#: The share of terms that a step leaves out.
DROPOUT = 0.3
_STRIP = b"".join(bytes([c]) for c in range(33, 127) if not chr(c).isalnum())


def _buckets(word: bytes) -> tuple[int, ...]:
    word = word.strip(_STRIP)
    if not word:
        return ()
    letters = word.decode("utf-8", "replace")
    starts = ["^" + letters[:n] for n in (4, 5, 6) if len(letters) > n]
    return (zlib.crc32(word) % BUCKETS, *(zlib.crc32(x.encode("utf-8", "replace")) % BUCKETS for x in starts))


def term_buckets(text: str) -> np.ndarray:
    """Sorted distinct buckets of a text's terms."""
    known = worker_cache("terms:buckets", lambda: Bounded(_buckets, 150_000))
    words = set(text.lower().encode("utf-8", "replace").split())
    found, times = np.unique(np.fromiter(chain.from_iterable(map(known.__getitem__, words)), np.int64), return_counts=True)
    again = (found[times > 1] * 2654435761 + 12345) % BUCKETS
    return np.union1d(found, again)


def fit(rows: list[np.ndarray], labels: np.ndarray, terms: int = TERMS, factors: int = FACTORS, epochs: int = 40, seed: int = 7, dropout: float = DROPOUT) -> dict:
    """Fit the machine with Adam on the logistic loss; ``rows`` hold bucket numbers."""
    labels = np.asarray(labels, float)
    prior = (labels.sum() + 0.5) / (len(labels) + 1)
    model = {"ids": np.empty(0, np.int64), "w0": float(np.log(prior / (1 - prior))), "w": np.empty(0), "v": np.empty((0, factors))}
    if not len(labels) or labels.min() == labels.max():
        return model
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids, inverse = np.unique(flat, return_inverse=True)
    pos = np.bincount(inverse, labels[owner], len(ids))
    neg = np.bincount(inverse, 1 - labels[owner], len(ids))
    np1, nn1 = labels.sum(), (1 - labels).sum()
    odds = np.log((pos + 0.5) / (np1 - pos + 0.5)) - np.log((neg + 0.5) / (nn1 - neg + 0.5))
    strength = np.abs(odds) / np.sqrt(1 / (pos + 0.5) + 1 / (np1 - pos + 0.5) + 1 / (neg + 0.5) + 1 / (nn1 - neg + 0.5))
    order = np.lexsort((ids, -strength))[:terms]
    chosen = np.sort(order[(strength[order] > 2.5) & (pos + neg >= 3)[order]])
    if not len(chosen):
        return model
    place = np.full(len(ids), -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[inverse] >= 0
    col, row = place[inverse][keep], owner[keep]
    rng = np.random.default_rng(seed)
    p = {"w0": np.array([model["w0"]]), "w": np.zeros(len(chosen)), "v": rng.normal(0, 0.05, (len(chosen), factors))}
    first = {k: np.zeros_like(x) for k, x in p.items()}
    second = {k: np.zeros_like(x) for k, x in p.items()}
    decay = {"w0": 0.0, "w": 2e-4, "v": 1e-3}
    starts = np.searchsorted(row, np.arange(len(rows) + 1))
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 256)):
            c = np.concatenate([col[starts[i] : starts[i + 1]] for i in batch])
            r = np.repeat(np.arange(len(batch)), starts[batch + 1] - starts[batch])
            seen = rng.random(len(c)) >= dropout
            c, r, x = c[seen], r[seen], 1 / (1 - dropout)
            v = p["v"][c] * x
            total = np.zeros((len(batch), factors))
            np.add.at(total, r, v)
            pairs = 0.5 * (total**2).sum(1) - 0.5 * np.bincount(r, (v**2).sum(1), len(batch))
            z = p["w0"][0] + np.bincount(r, p["w"][c] * x, len(batch)) + pairs
            d = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]
            g = {k: np.zeros_like(x) for k, x in p.items()}
            g["w0"][0] = d.sum()
            np.add.at(g["w"], c, d[r] * x)
            np.add.at(g["v"], c, (d[r] * x)[:, None] * (total[r] - v))
            step += 1
            for k in p:
                grad = g[k] / len(batch) + decay[k] * p[k]
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad**2 - second[k])
                p[k] -= 0.02 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return {"ids": ids[chosen], "w0": float(p["w0"][0]), "w": p["w"], "v": p["v"]}


def probability(model: dict, buckets: np.ndarray) -> float:
    """The machine's score of one row of buckets."""
    z = model["w0"]
    if len(model["ids"]) and len(buckets):
        at = np.searchsorted(model["ids"], buckets)
        at = at[(at < len(model["ids"])) & (model["ids"][np.minimum(at, len(model["ids"]) - 1)] == buckets)]
        v = model["v"][at]
        z += model["w"][at].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum())
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, fold: Column, max_rows: int, size: Column, max_size: int, describe: Callable, schema: str) -> list:
    """What ``describe`` makes of labelled texts: at most ``max_rows``, chosen by a hash of their ids.

    ``fold`` is true for the rows that may be learned from.  Several labels of one id count as
    their maximum, of several texts of one id the first in order counts; ids without text row or
    label are left out.  ``size`` measures a text: texts above a fiftieth of ``max_size`` are left
    out, and then those, in order of the hash, with which the sum exceeds ``max_size``.  Texts
    are taken whole or not at all.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    sample = known.filter(fold).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    chosen = materialize(texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")), "training-texts")
    running = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # max_rows numbers at most
    sizes = chosen.select("doc_id", size.cast("bigint").alias("size")).filter(F.col("size") <= max_size // 50)
    fits = sizes.withColumn("sum", running).filter(F.col("sum") <= max_size).select("doc_id")
    return chosen.join(F.broadcast(fits), "doc_id").mapInArrow(describe, schema).orderBy("doc_id").collect()


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> dict:
    """Fit on the rows of ``labels`` whose fold is not held out."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows = [term_buckets(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary())], names=["doc_id", "label", "terms"])

    got = training_rows(docs, labels, "toxic", crc_mod("doc_id", 4) != 2, max_rows, F.length("text"), MAX_CHARS, describe, "doc_id bigint, label int, terms binary")
    return fit([np.frombuffer(r["terms"], "<u4").astype(np.int64) for r in got], np.array([r["label"] for r in got]))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document.

    Null and empty texts get the score of a text without terms.  Repeated rows give repeated
    results, a null doc_id is never held out, extra columns are ignored, no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            scores = [probability(model, term_buckets(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Train on ``labels`` and score all of ``docs``."""
    return score(docs, train(docs, labels, max_rows))


def without_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` without the rows whose text is predicted toxic.

    Each row is judged by its own text in one pass, whatever its id: rows without an id, equal
    rows and rows of one id with different texts need no rule.  Null and empty texts are judged as
    texts without terms.  All columns stay as they were; no rows give no rows.
    """
    model = train(docs, labels, max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            clean = [probability(model, term_buckets(t or "")) < 0.3 for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
