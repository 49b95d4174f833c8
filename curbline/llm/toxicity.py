"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is lower-cased and white space runs become one space; its features are the 4-, 5-, 6- and 8-character
n-grams it holds, each counted once, named by a 32-bit hash. On the training rows the document counts of a
feature in either class give its log-count ratio. The features whose ratio stands out most from chance
are kept, and a logistic regression with an L2 penalty is fitted on the ratios as feature values.

Defined results: null and empty texts have no feature and score as the intercept says; repeated rows
score alike; without labelled rows, or with one class only, every score is the smoothed share of toxic
labels (0 without rows); a label row counts if neither its id nor its label is null, and where ids repeat the
toxic label counts. Other columns of the tables are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .runtime import byte_slices, drawn, drawn_rows, held_out, kept_rows, ship, stored, tidy

SIZES = (4, 5, 6, 8)
#: Code points of a long text that are hashed at a time.
WINDOW = 1 << 18
#: Features of some texts that are folded at a time.
_FOLDED = 600_000
#: Training rows at most; the sample is the same on each run.
TRAIN_ROWS = 8_000
FEATURES = 10_000
THRESHOLD = 0.3
_SPACE = re.compile(r"\s+")


def ngram_hashes(text: str | None) -> Iterator[np.ndarray]:
    """The hash of the n-gram at every position, for each size; a long text in windows that share their ends."""
    known = " " + _SPACE.sub(" ", (text or "").lower()) + " "
    for first in range(0, max(1, len(known) - max(SIZES) + 1), WINDOW):
        code = np.frombuffer(known[first:first + WINDOW + max(SIZES) - 1].encode("utf-32-le", "replace"), dtype=np.uint32)
        for size in SIZES:
            n = len(code) - size + 1
            if n <= 0:
                continue
            h = np.full(n, size, dtype=np.uint32)
            for i in range(size):
                h *= np.uint32(0x9E3779B1)
                h += code[i:i + n]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x85EBCA77)
            h ^= h >> np.uint32(13)
            yield h


def features(text: str | None) -> np.ndarray:
    found = [np.unique(h) for h in ngram_hashes(text)]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint32)


class Lookup:
    """Positions of known feature hashes: one bit per 22-bit prefix first, a search for what passes."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.bits = np.zeros(1 << 22, dtype=bool)
        self.bits[hashes >> np.uint32(10)] = True

    def __call__(self, text: str | None) -> np.ndarray:
        if not len(self.hashes):
            return np.empty(0, np.int64)
        hit = [h[self.bits[h >> np.uint32(10)]] for h in ngram_hashes(text)]
        hit = np.unique(np.concatenate(hit)) if hit else np.empty(0, np.uint32)
        at = np.minimum(np.searchsorted(self.hashes, hit), len(self.hashes) - 1)
        return at[self.hashes[at] == hit]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """text and y of labelled documents outside the held-out fold, ``rows`` at most; rows equal in id and text count once."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    # Rows are chosen by the hash of the text; only the texts chosen are then read, each where it is.
    own = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    chosen = drawn_rows(own.select("doc_id", "tie"), drawn(usable, "doc_id", rows), rows)
    texts = own.join(F.broadcast(chosen), ["doc_id", "tie"]).groupBy("doc_id", "tie")
    return texts.agg(F.first("text").alias("text"), F.first("y").alias("y")).select("text", "y")


def class_counts(rows: DataFrame) -> DataFrame:
    """feature, and in how many toxic and other rows it occurs; summed over some texts before it is shuffled."""
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def folded(own: list[np.ndarray], labels: list[int]):
            names, where = np.unique(np.concatenate(own), return_inverse=True)
            toxic = np.repeat(np.array(labels) == 1, [len(o) for o in own])
            ones = np.bincount(where[toxic], minlength=len(names))
            return pa.RecordBatch.from_arrays(
                [pa.array(names.astype(np.int64)), pa.array(ones), pa.array(np.bincount(where, minlength=len(names)) - ones)],
                names=["feature", "ones", "zeros"])

        own, labels, held = [], [], 0
        for batch in batches:
            for part in byte_slices(batch, 0):
                for text, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own.append(features(text))
                    labels.append(y)
                    held += len(own[-1])
                    if held > _FOLDED:
                        yield folded(own, labels)
                        own, labels, held = [], [], 0
        if own:
            yield folded(own, labels)

    return rows.mapInArrow(tidy(count), "feature bigint, ones bigint, zeros bigint").groupBy("feature").agg(
        F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))


def logistic(indptr: np.ndarray, at: np.ndarray, values: np.ndarray, y: np.ndarray, l2: float = 1.0,
             steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights on sparse rows whose entry at feature j is ``values[j]``, by accelerated gradient steps."""
    n, k = len(y), len(values)
    row = np.repeat(np.arange(n), np.diff(indptr))
    x = values[at]
    # The largest curvature along the gradient bounds the step.
    square = np.bincount(row, weights=x * x, minlength=n)
    scale = 1.0 / (0.25 * max(square.mean() * 4, 1.0) + l2 / n)
    w, b, last_w, last_b = np.zeros(k), float(np.log((y.sum() + 1) / (n - y.sum() + 1))), np.zeros(k), 0.0
    last_b = b

    def loss_grad(w, b):
        z = np.bincount(row, weights=x * w[at], minlength=n) + b
        p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        e = (p - y) / n
        value = np.mean(np.logaddexp(0, z) - y * z) + l2 / (2 * n) * (w @ w)
        return value, np.bincount(at, weights=x * e[row], minlength=k) + l2 / n * w, e.sum()

    best = np.inf
    momentum = 0
    for _ in range(steps):
        beta = momentum / (momentum + 3)
        vw, vb = w + beta * (w - last_w), b + beta * (b - last_b)
        value, gw, gb = loss_grad(vw, vb)
        if value > best * 1.05 + 1e-9:
            scale, momentum, last_w, last_b = scale / 2, 0, w, b
            continue
        best = min(best, value)
        last_w, last_b = w, b
        w, b = vw - scale * gw, vb - scale * gb
        momentum += 1
    return w, b


class Model:
    def __init__(self, hashes: np.ndarray, weights: np.ndarray, intercept: float):
        self.hashes, self.weights, self.intercept = hashes, weights, intercept


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, keep: int = FEATURES, least: int = 4) -> Model:
    """Learn from ``labels`` (doc_id, toxic) outside the held-out fold; what reaches the driver is bounded by ``rows`` and ``keep``."""
    spark = docs.sparkSession
    ship(spark)
    train = stored(training_rows(docs, labels, "toxic", rows), "toxicity-train")
    n1, n = (train.agg(F.sum("y"), F.count("y")).first())
    n1, n0 = n1 or 0, n - (n1 or 0)
    if not n1 or not n0:
        share = 0.0 if not n else (n1 + 0.5) / (n + 1)
        return Model(np.empty(0, np.uint32), np.empty(0), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    ratio = F.log((F.col("ones") + 1) / (n1 + 2)) - F.log((F.col("zeros") + 1) / (n0 + 2))
    spread = F.sqrt(1 / (F.col("ones") + 1) + 1 / (F.col("zeros") + 1))
    best = (class_counts(train).where(F.col("ones") + F.col("zeros") >= least)
            .select("feature", ratio.alias("ratio"), F.abs(ratio / spread).alias("strength"))
            .where("strength >= 3").orderBy(F.desc("strength"), "feature").limit(keep).toPandas())
    best = best.sort_values("feature")
    hashes, ratios = best["feature"].to_numpy().astype(np.uint32), best["ratio"].to_numpy()

    def rows_of(batches: Iterator) -> Iterator:
        import pyarrow as pa
        look = Lookup(hashes)
        for batch in batches:
            for part in byte_slices(batch, 0):
                yield pa.RecordBatch.from_arrays([pa.array([look(t).tolist() for t in part.column(0).to_pylist()], pa.list_(pa.int64())),
                                                  part.column(1)], names=["at", "y"])

    data = train.mapInArrow(tidy(rows_of), "at array<bigint>, y int").toPandas()
    lengths = np.array([len(a) for a in data["at"]], dtype=np.int64)
    at = np.concatenate([np.asarray(a, np.int64) for a in data["at"]]) if lengths.sum() else np.empty(0, np.int64)
    w, b = logistic(np.concatenate([[0], np.cumsum(lengths)]), at, ratios, data["y"].to_numpy(np.float64))
    return Model(hashes, w * ratios, b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.hashes, model.weights, model.intercept))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        hashes, weights, intercept = shared.value
        look = Lookup(hashes)
        for batch in batches:
            for part in byte_slices(batch, 1):
                z = np.array([weights[look(t)].sum() + intercept for t in part.column(1).to_pylist()], dtype=np.float64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))))],
                                                 names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(tidy(run), "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows predicted toxic. Rows are judged where they are read; nothing is joined."""
    model = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((model.hashes, model.weights, model.intercept))
    limit = float(np.log(threshold / (1 - threshold)))
    ready: list[Lookup] = []

    def keep(texts: list[str | None]) -> list[bool]:
        hashes, weights, intercept = shared.value
        if not ready:
            ready.append(Lookup(hashes))
        return [bool(weights[ready[0](t)].sum() + intercept < limit) for t in texts]

    return kept_rows(docs, keep)
