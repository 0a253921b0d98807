"""Toxicity by compression distance.

Two zstandard dictionaries are trained on bounded samples of labelled texts:
one on the windows of ordinary texts, one of equal size on the windows of toxic
texts. Every window of a text is compressed with both; a window that the toxic
dictionary shortens more speaks for toxicity. A third dictionary, the ordinary
one with the vocabulary that recurs in toxic texts behind it, is a further
feature. The distribution of the differences over the whole text is calibrated
to a probability on labelled texts that no dictionary has seen.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, fold, text_of
from .learn import logistic, probability, sample

PER_CLASS = 3000
WINDOW, STEP = 64, 48
COMMON_BYTES, OWN_BYTES = 8192, 1024
LEVEL = 9
#: Windows a dictionary is trained on at most.
PIECES = 30_000
#: A stem recurs if this share of the toxic sample has it, and is rare elsewhere if so many times as rare.
STEM, RECURS, RARER = 5, 0.02, 8
SHORTER = (1, 2, 3, 4, 5, 6)


def windows(text: str) -> list[bytes]:
    """Overlapping windows over the whole text, lower case; one empty window for an empty text."""
    raw = text.lower().encode("utf-8")
    return [raw[i:i + WINDOW] for i in range(0, max(1, len(raw) - WINDOW + STEP), STEP)]


def _recurring(texts: list[str], others: list[str]) -> list[bytes]:
    """Of each distinct text the words whose stem recurs among ``texts`` and is rare in ``others``."""
    texts, others = list(dict.fromkeys(texts)), list(dict.fromkeys(others))
    df = Counter(w for t in texts for w in {w[:STEM] for w in t.lower().split()})
    plain = Counter(w for t in others for w in {w[:STEM] for w in t.lower().split()})
    own = {w for w, n in df.items()
           if n >= max(2, RECURS * len(texts)) and n / len(texts) >= RARER * (plain[w] + 0.5) / len(others)}
    kept = ([w for w in t.lower().split() if w[:STEM] in own] for t in texts)
    return [f" {' '.join(ws)} ".encode() for ws in kept if ws]


def _dictionary(records: list[bytes], size: int, **params) -> bytes:
    """Content of a trained dictionary; a sample too small to train on is itself the content."""
    try:
        return zstandard.train_dictionary(size + 256, records, **params).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(records)[-size:]


def _learned(texts: list[str]) -> bytes:
    """A dictionary trained on every second window of the texts (at most ``PIECES``)."""
    pieces = [w for t in texts for w in windows(t)[::2]]
    pick = np.random.default_rng(3).permutation(len(pieces))[:PIECES]
    return _dictionary([pieces[i] for i in pick], COMMON_BYTES, k=32, d=6)


class Model:
    """The dictionaries of ordinary and toxic text, the recurring vocabulary and the calibration."""

    def __init__(self, common: bytes, bad: bytes, own: bytes, fit=None):
        self.common, self.bad, self.own, self.fit = common, bad, own, fit

    def open(self):
        def coder(content):
            return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False,
                                            dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        self.plain, self.toxic, self.words = (coder(c).compress for c in (self.common, self.bad, self.common + self.own))
        return self

    def features(self, text: str) -> np.ndarray:
        parts = windows(text)
        plain = np.array([len(self.plain(w)) for w in parts], dtype=float)
        n = len(parts)
        out = []
        for coder in (self.toxic, self.words):
            gain = plain - np.array([len(coder(w)) for w in parts], dtype=float)
            top = np.sort(gain)[::-1][:5]
            out += [top[0], top[:3].mean(), top.mean(), gain.mean()]
            out += [np.log1p((gain >= s).sum()) for s in SHORTER] + [(gain >= s).mean() ** 0.5 for s in SHORTER]
        return np.array(out + [np.log(n)])

    def score(self, texts) -> np.ndarray:
        if self.fit is None or not len(texts):
            return np.zeros(len(texts))
        return probability(self.fit, np.array([self.features(t) for t in texts]))


def train(rows: list[tuple[str, int]]) -> Model:
    """Dictionaries from three fifths of the rows, calibration on the rest; without both classes every score is 0."""
    cut = len(rows) * 3 // 5
    bad = [t for t, y in rows[:cut] if y]
    good = [t for t, y in rows[:cut] if not y]
    rest = rows[cut:]
    if not bad or not good or len({y for _, y in rest}) < 2:
        return Model(b"", b"", b"")
    common, toxic = (_learned(texts) for texts in (good, bad))
    size = min(len(common), len(toxic))  # longer content shortens more, whatever it is
    common, toxic = common[-size:], toxic[-size:]
    own = _dictionary(_recurring(bad, good), OWN_BYTES, k=16, d=6)
    model = Model(common, toxic, own).open()
    x = np.array([model.features(t) for t, _ in rest])
    return Model(common, toxic, own, logistic(x, np.array([y for _, y in rest], dtype=float)))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model from at most ``per_class`` toxic and twice as many ordinary labelled training texts."""
    return train(sample(docs, labels, "toxic", (2 * per_class, per_class)))


def score(docs: DataFrame, model: Model, column: str = "toxicity", keep=None) -> DataFrame:
    """``docs`` with the probability that each whole text is toxic.

    Null texts are read as empty and score like any text without windows of
    either kind; repeated rows score alike; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.common, model.bad, model.own, model.fit))

    def build():
        scorer = Model(*shared.value).open()
        return lambda texts: [scorer.score([t or "" for t in texts.to_pylist()])]

    return add_columns(docs, build, ["text"], [(column, T.DoubleType())], keep)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (contract of the query)."""
    model = fit(docs, labels, per_class)
    scored = score(docs.select("doc_id", text_of().alias("text")), model, "score", keep=["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
