"""Document quality by a linear-chain conditional random field over lines.

Each line is good or bad.  Its features describe the line itself and its neighbours (what
share of its bytes are letters, digits, symbols, bars ...), transitions tie consecutive
lines.  The field is fitted on the driver on a bounded sample (``max_rows``) of labelled
documents, whose lines at first take the document's label; then lines of bad documents
that look good beyond doubt are relabelled, as a bad document may hold good lines.
Forward-backward gives each line's marginal; their average, weighted by line length, is
mapped to a probability by a logistic curve fitted on the same sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.llm.common import bound_batches, crc_mod, small_batches, text_or_empty
from offerweave.llm.toxicity import training_rows

MAX_ROWS = 4000
#: Lines of all training texts together.
MAX_LINES = 500_000
_OWN = 11
FEATURES = 3 * _OWN + 2


def _classes() -> np.ndarray:
    table = np.zeros((256, 6), np.uint8)  # letters, capitals, digits, spaces, symbols, punctuation
    for c in range(256):
        x = chr(c)
        if c >= 128 or x.isalpha():
            table[c, 0] = 1
            table[c, 1] = x.isascii() and x.isupper()
        elif x.isdigit():
            table[c, 2] = 1
        elif x.isspace():
            table[c, 3] = 1
        elif x in ".,;:!?'\"()-":
            table[c, 5] = 1
        else:
            table[c, 4] = 1
    return table


_TABLE = _classes()


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and byte lengths of a text's lines; a text without lines has one empty line."""
    raw = text.encode("utf-8", "replace")
    lines = raw.split(b"\n")
    n = len(lines)
    lengths = np.fromiter(map(len, lines), np.int64, n)
    own = np.zeros((n, _OWN), np.float32)
    codes = np.frombuffer(raw + b"\n", np.uint8)  # every line ends in a line feed, so none is empty
    at = np.cumsum(lengths + 1) - lengths - 1
    for k in range(6):
        own[:, k] = np.add.reduceat(_TABLE[codes, k], at, dtype=np.int64) - (k == 3)
    own[:, 6] = np.add.reduceat((codes == 124).view(np.uint8), at, dtype=np.int64)
    size = np.maximum(lengths, 1)
    words = own[:, 3] + 1
    own[:, [0, 1, 2, 4, 5, 6]] /= size[:, None]
    own[:, 3] = np.log1p(lengths) / 5
    own[:, 7] = np.minimum(size / words, 40) / 10
    stems = [x.rstrip(b"!?.,;:#$%&*") for x in lines]
    seen: set[bytes] = set()
    for i, x in enumerate(stems):
        own[i, 8] = x in seen and bool(x)
        seen.add(x)
    for i, x in enumerate(lines):
        parts = x.split()
        own[i, 9] = len(set(parts)) / len(parts) if parts else 1
    own[:, 10] = lengths == 0
    out = np.zeros((n, FEATURES), np.float32)
    out[:, :_OWN] = own
    out[1:, _OWN : 2 * _OWN] = own[:-1]
    out[:-1, 2 * _OWN : 3 * _OWN] = own[1:]
    out[0, -2] = 1
    out[:, -1] = 1
    return out, lengths


def marginals(unary: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward for two labels: marginals (n, 2) and summed pair marginals (2, 2)."""
    n = len(unary)
    psi, t = np.exp(unary - unary.max(1, keepdims=True)), np.exp(trans)
    a, b = psi.tolist(), [[1.0, 1.0]] * n
    (t00, t01), (t10, t11) = t.tolist()
    x, y = a[0]
    s = x + y
    f = [(x / s, y / s)]
    for i in range(1, n):
        p, q = f[-1]
        x, y = (p * t00 + q * t10) * a[i][0], (p * t01 + q * t11) * a[i][1]
        s = x + y
        f.append((x / s, y / s))
    x = y = 1.0
    for i in range(n - 1, 0, -1):
        b[i] = (x, y)
        u, v = a[i][0] * x, a[i][1] * y
        x, y = t00 * u + t01 * v, t10 * u + t11 * v
        s = x + y
        x, y = x / s, y / s
    b[0] = (x, y)
    fw, bw = np.array(f), np.array(b)
    m = fw * bw
    m /= m.sum(1, keepdims=True)
    pair = np.zeros((2, 2))
    if n > 1:
        e = fw[:-1, :, None] * t[None] * (psi[1:] * bw[1:])[:, None, :]
        pair = (e / e.sum((1, 2), keepdims=True)).sum(0)
    return m, pair


def fit(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = 60, seed: int = 3) -> dict:
    """Fit by Adam on the conditional log-likelihood; ``docs`` hold (features, lengths)."""
    labels = np.asarray(labels, int)
    prior = (labels.sum() + 0.5) / (len(labels) + 1)
    model = {"w": np.zeros((FEATURES, 2)), "t": np.zeros((2, 2)), "mean": np.zeros(FEATURES), "scale": np.ones(FEATURES), "curve": (0.0, float(np.log(prior / (1 - prior))))}
    if not len(labels) or labels.min() == labels.max():
        return model
    every = np.concatenate([x for x, _ in docs])
    mean, scale = every.mean(0), every.std(0) + 1e-3
    mean[-2:], scale[-2:] = 0, 1
    xs = [(x - mean) / scale for x, _ in docs]
    ys = [np.full(len(x), y) for x, y in zip(xs, labels, strict=True)]
    weight = np.where(labels == 1, 0.5 / prior, 0.5 / (1 - prior))
    rng = np.random.default_rng(seed)
    w, t = np.zeros((FEATURES, 2)), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    step = 0
    for turn in range(2):
        if turn:  # lines of bad documents that look good by themselves; the worst line stays bad
            for i in np.flatnonzero(labels == 0):
                z = xs[i] @ (w[:, 1] - w[:, 0])
                ys[i] = ((z > 2) & (z > z.min())).astype(int)
        for _ in range(steps):
            gw, gt = np.zeros_like(w), np.zeros_like(t)
            batch = rng.choice(len(xs), min(128, len(xs)), replace=False)
            for i in batch:
                x, y = xs[i], ys[i]
                m, pair = marginals(x @ w, t)
                d = m.copy()
                d[np.arange(len(y)), y] -= 1
                c = weight[i] / len(x)
                gw += c * (x.T @ d)
                np.subtract.at(pair, (y[:-1], y[1:]), 1)
                gt += c * pair
            step += 1
            for k, (p, g) in enumerate(((w, gw / len(batch) + 1e-3 * w), (t, gt / len(batch) + 2e-2 * t))):
                moments[2 * k] += 0.1 * (g - moments[2 * k])
                moments[2 * k + 1] += 0.01 * (g**2 - moments[2 * k + 1])
                p -= 0.1 * (moments[2 * k] / (1 - 0.9**step)) / (np.sqrt(moments[2 * k + 1] / (1 - 0.99**step)) + 1e-8)
    model |= {"w": w, "t": t, "mean": mean, "scale": scale}
    z = np.array([_evidence(model, x, n) for x, n in docs])
    a, c = 1.0, 0.0
    for _ in range(400):  # the curve, with both classes as frequent as in the sample
        p = 1 / (1 + np.exp(-(a * z + c)))
        g = np.array([((p - labels) * z).mean() + 1e-3 * (a - 1), (p - labels).mean()])
        a, c = a - 0.5 * g[0], c - 0.5 * g[1]
    return model | {"curve": (float(a), float(c))}


def _evidence(model: dict, features: np.ndarray, lengths: np.ndarray) -> float:
    m, _ = marginals(((features - model["mean"]) / model["scale"]) @ model["w"], model["t"])
    weight = lengths if lengths.sum() else np.ones(len(lengths))
    good = float(np.clip((m[:, 1] * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    return float(np.log(good / (1 - good)))


def probability(model: dict, text: str) -> float:
    a, c = model["curve"]
    return float(1 / (1 + np.exp(-(a * _evidence(model, *line_features(text)) + c))))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> dict:
    """Fit on labelled rows whose fold is not held out."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            both = [line_features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([x.astype("<f4").tobytes() for x, _ in both], pa.binary()), pa.array([n.astype("<i4").tobytes() for _, n in both], pa.binary())],
                names=["doc_id", "label", "features", "lengths"],
            )

    got = training_rows(docs, labels, "quality", crc_mod("doc_id", 5) != 0, max_rows, F.size(F.split("text", "\n")), MAX_LINES, describe, "doc_id bigint, label int, features binary, lengths binary")
    rows = [(np.frombuffer(r["features"], "<f4").reshape(-1, FEATURES), np.frombuffer(r["lengths"], "<i4")) for r in got]
    return fit(rows, np.array([r["label"] for r in got]))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document.

    Null and empty texts are one empty line.  Repeated rows give repeated results, a null
    doc_id is never held out, extra columns are ignored, no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            scores = [probability(model, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Train on ``labels`` and score all of ``docs``."""
    return score(docs, train(docs, labels, max_rows))
