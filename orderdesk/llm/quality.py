"""Quality by attention-based multiple-instance learning.

A text is a bag of passages. Every passage is encoded as a vector (shares of
byte classes and of their pairs, repetition of short strings); a small network
maps it to a hidden passage vector, a gated attention gives each passage of the
text a weight, and the weighted sum is scored. Encoder, gate and classifier are
learned together from document labels only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, fold, text_of
from .learn import sample

PER_CLASS = 3000
PASSAGE = 512
HIDDEN, GATE, EPOCHS, BATCH, RATE = 24, 16, 60, 128, 0.01
_CLASSES = 16


def _byte_classes() -> np.ndarray:
    c = np.full(256, 15)
    for k, chars in enumerate((b"aeiou", b"bcdfghjklmnpqrstvwxyz", bytes(range(65, 91)), b"0123456789", b" ", b"\n\r\t", b".", b",;:",
                               b"!?", b"'\"()", b"$%&#*@^~+=<>", b"|/\\_[]{}", b"-")):
        c[list(chars)] = k
    c[128:192], c[192:] = 13, 14
    return c


CLASS = _byte_classes()


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(passages x features, number of passages of each text) over whole texts; an empty text has one empty passage."""
    raws = [t.encode("utf-8") for t in texts]
    size = np.array([len(r) for r in raws], dtype=np.int64)
    count = np.maximum(1, -(-size // PASSAGE))
    total = int(count.sum())
    first = np.cumsum(count) - count
    x = np.frombuffer(b"".join(raws), dtype=np.uint8)
    at = np.cumsum(size) - size
    place = first.repeat(size) + (np.arange(len(x)) - at.repeat(size)) // PASSAGE
    n = np.maximum(1, np.bincount(place, minlength=total)).astype(np.float64)
    c = CLASS[x]
    one = np.bincount(place * _CLASSES + c, minlength=total * _CLASSES).reshape(total, -1) / n[:, None]
    pair = np.zeros((total, _CLASSES * _CLASSES))
    fresh = np.zeros((total, 3))
    if len(x) > 8:
        p = place[:-1]
        pair = np.bincount((p * _CLASSES + c[:-1]) * _CLASSES + c[1:], minlength=total * _CLASSES ** 2).reshape(total, -1) / n[:, None]
        for k, width in enumerate((4, 8, 16)):
            h = np.zeros(max(0, len(x) - width + 1), dtype=np.uint64)
            for j in range(width):
                h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ (x[j:j + len(h)].astype(np.uint64) + np.uint64(77))
            q = place[:len(h)]
            key = np.sort((h >> np.uint64(24)) ^ (q.astype(np.uint64) << np.uint64(40)))
            # the passage stands in the high bits, so distinct strings are counted per passage
            new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
            fresh[:, k] = np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=total)[:total] / n if len(key) else 0
    feats = np.c_[np.sqrt(one), np.sqrt(pair), fresh, np.log1p(n)[:, None] / 6]
    return feats, count


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Network:
    """tanh encoder, gated attention, logistic output; parameters in one dict of arrays."""

    def __init__(self, params: dict | None, mean=None, scale=None):
        self.p, self.mean, self.scale = params, mean, scale

    def forward(self, x, count):
        p = self.p
        h = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(h @ p["V"] + p["vb"]), _sigmoid(h @ p["U"] + p["ub"])
        e = (v * u) @ p["w"]
        at = np.cumsum(count) - count
        e = np.exp(e - np.maximum.reduceat(e, at).repeat(count))
        a = e / np.add.reduceat(e, at).repeat(count)
        z = np.add.reduceat(a[:, None] * h, at)
        return _sigmoid(z @ p["o"] + p["ob"][0]), (h, v, u, a, z, at)

    def gradient(self, x, count, y):
        p = self.p
        s, (h, v, u, a, z, at) = self.forward(x, count)
        d = (s - y) / len(y)
        dz = (d[:, None] * p["o"]).repeat(count, axis=0)
        da = (dz * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, at).repeat(count))
        dv, du = de[:, None] * p["w"] * u * (1 - v * v), de[:, None] * p["w"] * v * u * (1 - u)
        dh = (a[:, None] * dz + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dv, "vb": dv.sum(0), "U": h.T @ du, "ub": du.sum(0),
                "w": (v * u).T @ de, "o": z.T @ d, "ob": np.array([d.sum()])}

    def score(self, texts: list[str]) -> np.ndarray:
        if self.p is None or not texts:
            return np.zeros(len(texts))
        x, count = encode(texts)
        return self.forward((x - self.mean) / self.scale, count)[0]


def train(rows: list[tuple[str, int]]) -> Network:
    """Adam over shuffled batches of labelled texts; without both classes every score is 0."""
    y = np.array([v for _, v in rows], dtype=np.float64)
    if len(set(y.tolist())) < 2:
        return Network(None)
    bags = [encode([t])[0] for t, _ in rows]
    every = np.concatenate(bags)
    mean, scale = every.mean(0), every.std(0) + 1e-3
    bags = [(b - mean) / scale for b in bags]
    rng = np.random.default_rng(11)
    dim = every.shape[1]
    shapes = {"W": (dim, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "vb": (GATE,), "U": (HIDDEN, GATE), "ub": (GATE,),
              "w": (GATE,), "o": (HIDDEN,), "ob": (1,)}
    net = Network({k: rng.normal(0, s[0] ** -0.5, s) if k in "WVUwo" else np.zeros(s) for k, s in shapes.items()}, mean, scale)
    m, q = ({k: np.zeros(s) for k, s in shapes.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            g = net.gradient(np.concatenate([bags[i] for i in pick]), np.array([len(bags[i]) for i in pick]), y[pick])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, d in g.items():
                d = d + 1e-4 * net.p[k]
                m[k] = 0.9 * m[k] + 0.1 * d
                q[k] = 0.999 * q[k] + 0.001 * d * d
                net.p[k] = net.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(q[k] / (1 - 0.999 ** step)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Network:
    """A network from at most ``per_class`` labelled training texts of each class (label ``quality``)."""
    return train(sample(docs, labels, "quality", (per_class, per_class)))


def score(docs: DataFrame, net: Network, column: str = "quality_score", keep=None) -> DataFrame:
    """``docs`` with the probability that each whole text is good.

    Null texts are read as empty (one empty passage); repeated rows score
    alike; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast((net.p, net.mean, net.scale))

    def build():
        scorer = Network(*shared.value)
        return lambda texts: [scorer.score([t or "" for t in texts.to_pylist()])]

    return add_columns(docs, build, ["text"], [(column, T.DoubleType())], keep)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (contract of the query)."""
    scored = score(docs.select("doc_id", text_of().alias("text")), fit(docs, labels, per_class), "score", keep=["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
