"""Labelled samples and a small logistic fit, shared by the learned operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, text_of


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: tuple[int, int], folds: int = 5):
    """At most ``per_class`` labelled training texts of class 0 and 1, on the driver: [(text, 0 or 1)].

    Only rows whose crc32(doc_id) mod ``folds`` is not 0 are taken, in the
    order of a hash of doc_id (the bound is a parameter; a doc_id counts once,
    with its largest label; null labels and ids are left out). ``docs`` gives
    the whole texts, one for each doc_id (that of the smallest hash), chosen
    before anything is collected: a doc_id that holds a third of all rows
    brings one text to the driver.
    """
    marked = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold("doc_id", folds) != 0))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    taken = None
    for y in (0, 1):
        part = marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class[y])
        taken = part if taken is None else taken.unionByName(part)
    texts = docs.select("doc_id", F.struct(F.xxhash64(text_of()).alias("th"), text_of().alias("text")).alias("one"))
    rows = texts.join(F.broadcast(taken), "doc_id").groupBy("doc_id", "y").agg(F.min("one").alias("one"))
    rows = sorted((r["doc_id"], r["text"], r["y"]) for r in rows.select("doc_id", "one.text", "y").collect())
    order = np.random.default_rng(7).permutation(len(rows))
    return [rows[i][1:] for i in order]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50):
    """Weights (mean, scale, w, b) of a ridge logistic regression, by Newton steps."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w[:-1], w[-1]


def probability(model, x: np.ndarray) -> np.ndarray:
    mean, scale, w, b = model
    return 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ w + b, -30, 30)))
