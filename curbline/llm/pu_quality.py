"""Quality by positive-unlabelled learning.

Trusted positives are the rows labelled good; negatives are never shown, only unlabelled web text. A small
network on text statistics minimises the non-negative unbiased risk: with class prior p, positives' risk p R+
plus max(0, Ru- - p R-), where the term in brackets is the risk of the unlabelled text taken as bad, less the
share that its good documents cause. The prior is estimated first: a classifier of positives against
unlabelled text ranks both, and the least ratio of their upper tails bounds the share of good text.

Defined results: null and empty texts score as the statistics of an empty text do; repeated rows score
alike; without trusted positives every score is 0.5; a label row counts if id and label are not null, and
where ids repeat the lowest label counts. Other columns of the tables are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .runtime import byte_slices, drawn, drawn_rows, held_out, kept_rows, ship, stored, tidy

#: Rows at most that a fit reads: trusted positives, and unlabelled texts.
POSITIVE_ROWS = 10_000
UNLABELLED_ROWS = 10_000
THRESHOLD = 0.7
_PUNCTUATION, _SIGN, _BAR = b".,;:?'\"-()", b"#$%&*+/<=>@[\\]^_`{}~", b"|"


def _classes() -> np.ndarray:
    """Class of a byte: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 mark, 7 sign, 8 bar, 9 bang, 10 beyond ASCII."""
    of = np.zeros(256, np.uint8)
    of[ord("a"):ord("z") + 1], of[ord("A"):ord("Z") + 1], of[ord("0"):ord("9") + 1] = 1, 2, 3
    of[[32, 9]], of[[10, 13]] = 4, 5
    of[list(_PUNCTUATION)], of[list(_SIGN)], of[list(_BAR)], of[ord("!")], of[128:] = 6, 7, 8, 9, 10
    return of


_CLASS = _classes()
_END = re.compile(r"[.!?]$")
N_FEATURES = 22


def statistics(text: str | None) -> np.ndarray:
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    words = text.split()
    n, k = max(len(raw), 1), max(len(words), 1)
    share = np.bincount(_CLASS[raw], minlength=11) / n
    repeats = sum(map(str.__eq__, words, words[1:])) / k
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    # Distinct words in blocks of equal size, so that long texts compare with short ones.
    distinct = [len(set(words[i:i + 60])) / len(words[i:i + 60]) for i in range(0, len(words), 60) if len(words[i:i + 60]) > 20]
    lines = [x for x in text.split("\n") if x]
    capitals = share[2] / max(share[1] + share[2] + share[10], 1e-6)
    return np.array([*share, capitals, repeats, np.mean(distinct) if distinct else len(set(words)) / k,
                     np.min(distinct) if distinct else len(set(words)) / k,
                     lengths.mean(), lengths.std(), (lengths <= 1).mean(), np.log1p(len(words)), np.log1p(len(lines)),
                     len(set(lines)) / max(len(lines), 1), text.count(". ") / k])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of every row."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for part in byte_slices(batch, 1):
                x = [statistics(t).tolist() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(tidy(run), "doc_id bigint, x array<double>")


class Network:
    """Two hidden layers of rectified units on standardised inputs, trained with Adam."""

    def __init__(self, x: np.ndarray, hidden: int = 24, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.std = x.mean(0), x.std(0) + 1e-3
        sizes = [x.shape[1], hidden, hidden, 1]
        self.w = [rng.normal(0, np.sqrt(2 / a), (a, b)) for a, b in zip(sizes, sizes[1:])]
        self.b = [np.zeros(b) for b in sizes[1:]]
        self.m = [np.zeros_like(p) for p in [*self.w, *self.b]]
        self.v = [np.zeros_like(p) for p in [*self.w, *self.b]]
        self.t = 0

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        layers = [np.clip((x - self.mean) / self.std, -6, 6)]
        for w, b in zip(self.w[:-1], self.b[:-1]):
            layers.append(np.maximum(layers[-1] @ w + b, 0))
        return (layers[-1] @ self.w[-1] + self.b[-1])[:, 0], layers

    def step(self, layers: list[np.ndarray], dz: np.ndarray, rate: float, decay: float = 1e-4) -> None:
        grad, gw, gb = dz[:, None], [], []
        for i in range(len(self.w) - 1, -1, -1):
            gw.insert(0, layers[i].T @ grad + decay * self.w[i])
            gb.insert(0, grad.sum(0))
            grad = grad @ self.w[i].T * (layers[i] > 0) if i else grad
        self.t += 1
        for p, g, m, v in zip([*self.w, *self.b], [*gw, *gb], self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 11) -> float:
    """Share of good text in the unlabelled rows: the least ratio of upper tails, on rows not trained on.

    Only tails that hold at least half of the positives count, so that small tables don't decide by a few rows.
    """
    ratios = []
    for own, other in ((0, 1), (1, 0)):
        p_fit, p_rest, u_fit, u_rest = positive[own::2], positive[other::2], unlabelled[own::2], unlabelled[other::2]
        if not min(map(len, (p_fit, p_rest, u_fit, u_rest))):
            continue
        net, rng = Network(np.vstack([p_fit, u_fit]), seed=seed), np.random.default_rng(seed)
        for _ in range(400):
            xp, xu = p_fit[rng.integers(0, len(p_fit), 256)], u_fit[rng.integers(0, len(u_fit), 256)]
            z, layers = net.forward(np.vstack([xp, xu]))
            net.step(layers, (sigmoid(z) - np.r_[np.ones(len(xp)), np.zeros(len(xu))]) / len(z), 3e-3)
        zp, zu = net.forward(p_rest)[0], np.sort(net.forward(u_rest)[0])
        kept = np.linspace(0.5, 0.98, 25)
        cut = np.quantile(zp, 1 - kept)
        ratios.append(((1 - np.searchsorted(zu, cut, "left") / len(zu)) / kept).min())
    return float(np.clip(np.mean(ratios), 0.05, 0.98)) if ratios else 0.5


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 2500, seed: int = 5) -> Network:
    """Minimise the non-negative risk with the logistic loss."""
    net, rng = Network(np.vstack([positive, unlabelled]), seed=seed), np.random.default_rng(seed)
    for step in range(steps):
        xp = positive[rng.integers(0, len(positive), 512)]
        xu = unlabelled[rng.integers(0, len(unlabelled), 512)]
        z, layers = net.forward(np.vstack([xp, xu]))
        zp, zu = z[:len(xp)], z[len(xp):]
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        d_negative = np.r_[-prior * sigmoid(zp) / len(xp), sigmoid(zu) / len(xu)]
        if negative >= 0:
            dz = d_negative
            dz[:len(xp)] += prior * (sigmoid(zp) - 1) / len(xp)
        else:  # more was taken off than is there: step back
            dz = -d_negative
        net.step(layers, dz, 3e-3 if step < steps // 2 else 5e-4)
    return net


def fit(stats: DataFrame, labels: DataFrame) -> tuple[Network, float] | None:
    """Learn from rows outside the held-out fold; at most POSITIVE_ROWS and UNLABELLED_ROWS reach the driver.

    Rows equal in id and statistics count once.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    good = usable.groupBy("doc_id").agg(F.min("quality").alias("y")).where("y = 1").select("doc_id")
    ids = stats.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()

    def collected(chosen: DataFrame, limit: int) -> np.ndarray:
        rows = drawn_rows(stats, chosen, limit).orderBy(F.xxhash64("doc_id"), "doc_id", "x").select("x").toPandas()["x"]
        return np.array([np.asarray(r) for r in rows]) if len(rows) else np.empty((0, N_FEATURES))

    positive = collected(drawn(good, "doc_id", POSITIVE_ROWS), POSITIVE_ROWS)
    unlabelled = collected(drawn(ids, "doc_id", UNLABELLED_ROWS), UNLABELLED_ROWS)
    if not len(positive) or not len(unlabelled):
        return None
    prior = class_prior(positive, unlabelled)
    return train(positive, unlabelled, prior), prior


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``. Texts are read once; their statistics are stored."""
    ship(docs.sparkSession)
    stats = stored(measured(docs), "quality-statistics")
    fitted = fit(stats, labels)
    shared = docs.sparkSession.sparkContext.broadcast(fitted and fitted[0])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        net = shared.value
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            z = net.forward(x)[0] if net else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(z))], names=["doc_id", "score"])

    return stats.mapInArrow(tidy(run), "doc_id bigint, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows predicted bad; all rows stay where nothing could be learnt."""
    ship(docs.sparkSession)
    fitted = fit(stored(measured(docs), "quality-statistics"), labels)
    if not fitted:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(fitted[0])

    def keep(texts: list[str | None]) -> list[bool]:
        return (sigmoid(shared.value.forward(np.array([statistics(t) for t in texts]))[0]) >= threshold).tolist() if texts else []

    return kept_rows(docs, keep)
