"""Language identification with a bidirectional gated recurrent network over bytes.

Texts are UTF-8 bytes, cut into windows; two gated recurrent units read each window from either end, every
position gets language probabilities from both states, and a document's probabilities are the means over
all its positions. The network is trained in numpy by backpropagation through time on windows of a bounded
sample of documents; scoring reads whole texts, many windows side by side.

Defined results: null texts and texts without a letter are ``und`` with score 0; without training rows
every text is ``und``; repeated rows are labelled alike, and equal probabilities go to the language
first in order. Only ``doc_id``, ``text`` and, for training, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .runtime import drawn, drawn_rows, held_out, ship

WINDOW = 48
UNITS = 8
#: Documents at most that a fit reads, and windows at most from each of them.
TRAIN_DOCS = 2_000
DOC_WINDOWS = 12
STEPS = 350
BATCH = 192
#: Windows scored side by side.
LANES = 8192
PAD = 256
UNKNOWN = "und"


def windows(raw: bytes) -> np.ndarray:
    """Rows of WINDOW byte values, the last one filled up with PAD."""
    n = -(-len(raw) // WINDOW)
    out = np.full(n * WINDOW, PAD, np.int16)
    out[:len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, WINDOW)


class Network:
    """Parameters by name, in float32. Gate order in the stacked matrices: update, reset, candidate."""

    def __init__(self, classes: int, units: int = UNITS, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.units = units
        self.p: dict[str, np.ndarray] = {}
        for side in "fb":
            self.p["x" + side] = rng.normal(0, 0.3, (257, 3 * units))
            self.p["h" + side] = rng.normal(0, 1 / np.sqrt(units), (units, 2 * units))
            self.p["c" + side] = rng.normal(0, 1 / np.sqrt(units), (units, units))
        self.p["out"] = rng.normal(0, 0.3, (2 * units, classes))
        self.p["bias"] = np.zeros(classes)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def states(self, side: str, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
        """(time, window, units) after each position, read forwards (f) or backwards (b)."""
        u, length = self.units, codes.shape[1]
        x, wh, wc = self.p["x" + side], self.p["h" + side], self.p["c" + side]
        out = np.empty((length, len(codes), u), np.float32)
        h = np.zeros((len(codes), u), np.float32)
        for t in (range(length) if side == "f" else range(length - 1, -1, -1)):
            given = x[codes[:, t]]
            gates = np.tanh(0.5 * (given[:, :2 * u] + h @ wh))  # a sigmoid, up to scale
            gates *= 0.5
            gates += 0.5
            z, r = gates[:, :u], gates[:, u:]
            candidate = np.tanh(given[:, 2 * u:] + (r * h) @ wc)
            if keep is not None:
                keep.append((t, h, z, r, candidate))
            h = h + z * (candidate - h)
            out[t] = h
        return out

    def position_scores(self, codes: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """(time, window, classes) before the softmax."""
        u = self.units
        kept = {s: [] for s in "fb"} if keep is not None else {s: None for s in "fb"}
        f, b = self.states("f", codes, kept["f"]), self.states("b", codes, kept["b"])
        if keep is not None:
            keep.update(kept, f_out=f, b_out=b)
        return f @ self.p["out"][:u] + b @ self.p["out"][u:] + self.p["bias"]

    def window_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Sum over the positions of each window of their probabilities; padding counts for nothing."""
        z = self.position_scores(codes)
        z -= z.max(2, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(2, keepdims=True)
        z *= (codes.T != PAD)[:, :, None]
        return z.sum(0)

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions, and its gradient through time."""
        u, keep = self.units, {}
        z = self.position_scores(codes, keep)
        z -= z.max(2, keepdims=True)
        p = np.exp(z)
        p /= p.sum(2, keepdims=True)
        real = (codes.T != PAD)[:, :, None].astype(np.float32)
        n = max(float(real.sum()), 1.0)
        rows = np.arange(len(labels))
        loss = float(-(np.log(np.maximum(p[:, rows, labels], 1e-9)) * real[:, :, 0]).sum() / n)
        p[:, rows, labels] -= 1
        p *= real / n
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["bias"] = p.sum((0, 1))
        for side, out, part in (("f", keep["f_out"], slice(0, u)), ("b", keep["b_out"], slice(u, 2 * u))):
            g["out"][part] = np.tensordot(out, p, ((0, 1), (0, 1)))
            from_above = p @ self.p["out"][part].T
            wh, wc = self.p["h" + side], self.p["c" + side]
            dh = np.zeros((len(codes), u), np.float32)
            for t, h, zg, r, c in reversed(keep[side]):
                dh = dh + from_above[t]
                dc = dh * zg * (1 - c * c)
                drh = dc @ wc.T
                dgates = np.concatenate([dh * (c - h) * zg * (1 - zg), drh * h * r * (1 - r)], 1)
                g["h" + side] += h.T @ dgates
                g["c" + side] += (r * h).T @ dc
                np.add.at(g["x" + side], codes[:, t], np.concatenate([dgates, dc], 1))
                dh = dh * (1 - zg) + drh * r + dgates @ wh.T
        return loss, g


def train(codes: np.ndarray, labels: np.ndarray, classes: int, steps: int = STEPS, seed: int = 3) -> Network:
    net, rng = Network(classes, seed=seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    # Languages are drawn alike, however many windows they have.
    share = 1 / np.bincount(labels, minlength=classes)[labels]
    share /= share.sum()
    for t in range(1, steps + 1):
        pick = rng.choice(len(codes), min(BATCH, len(codes)), p=share)
        _, grads = net.gradients(codes[pick], labels[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = 0.015 * (1 if t < steps * 0.6 else 0.3)
        for k, g in grads.items():
            g *= min(1.0, 1.0 / (norm + 1e-9))
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g * g - v[k])
            net.p[k] -= (rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-7)).astype(np.float32)
    return net


def fit(docs: DataFrame, rows: int = TRAIN_DOCS) -> tuple[list[str], Network] | None:
    """Languages in order, and the network; from at most ``rows`` rows outside the held-out fold.

    Rows equal in id, language and text count once.
    """
    usable = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    keys = ["doc_id", "lang", "tie"]
    own = usable.select("doc_id", "lang", F.xxhash64("text").alias("tie"), "text")
    ids = drawn(usable.select("doc_id").distinct(), "doc_id", rows)
    chosen = drawn_rows(own.select(*keys), ids, rows)
    texts = own.join(F.broadcast(chosen), keys).groupBy(*keys).agg(F.first("text").alias("text"))
    # Windows are cut where the text is: what reaches the driver is bounded by documents and windows of each.
    ship(docs.sparkSession)

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            langs, out = [], []
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text.encode("utf-8", "replace")
                count = -(-len(raw) // WINDOW)
                for i in sorted({i * count // DOC_WINDOWS for i in range(min(count, DOC_WINDOWS))} if count > DOC_WINDOWS else range(count)):
                    langs.append(lang)
                    out.append(raw[i * WINDOW:(i + 1) * WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], names=["lang", "window"])

    data = (texts.select("text", "lang")
            .mapInArrow(cut, "lang string, window binary").orderBy(F.xxhash64("window"), "window", "lang").toPandas())
    if not len(data):
        return None
    names = sorted(set(data["lang"]))
    codes = np.concatenate([windows(bytes(w)) for w in data["window"]])
    return names, train(codes, data["lang"].map(names.index).to_numpy(), len(names))


def predict(docs: DataFrame, fitted: tuple[list[str], Network] | None) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((fitted[0], fitted[1].p) if fitted else None)

    def pooled(net: Network, texts: list[str]) -> np.ndarray:
        """Summed probabilities of each text; windows of all texts go side by side, LANES at a time."""
        raws = [t.encode("utf-8", "replace") for t in texts]
        owner = np.repeat(np.arange(len(raws)), [-(-len(r) // WINDOW) for r in raws])
        codes = np.concatenate([windows(r) for r in raws])
        sums = np.zeros((len(raws), net.p["bias"].shape[0]))
        for at in range(0, len(codes), LANES):
            np.add.at(sums, owner[at:at + LANES], net.window_probabilities(codes[at:at + LANES]))
        return sums

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        if shared.value:
            names, weights = shared.value
            net = Network(len(names))
            net.p = weights
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                real = [i for i, t in enumerate(texts) if shared.value and t and any(map(str.isalpha, t))]
                if real:
                    sums = pooled(net, [texts[i] for i in real])
                    share = sums / sums.sum(1, keepdims=True)
                    for i, best, s in zip(real, share.argmax(1), share.max(1)):
                        langs[i], scores[i] = names[best], float(min(s, 1.0))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores)],
                                                 names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    return predict(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
