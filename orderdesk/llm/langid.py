"""Language identification by a byte convolutional network.

Bytes are embedded; filters of several widths slide over a window of fixed
length; the largest response of each filter goes to a softmax over the learned
languages. The network is trained in numpy on windows of labelled texts and
applied to every window of every whole text: neighbouring windows overlap by
the widest filter less one byte, so each run of bytes that a filter can see
lies in exactly one window. A text's answer is the mean of its windows' shares,
weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, fold, free_name

#: Bounds of the training sample: distinct texts a language, languages (the most frequent).
PER_LANG, LANGUAGES = 1000, 256
LENGTH, EMBED, WIDTHS, FILTERS = 64, 8, (2, 3, 4), 24
STRIDE = LENGTH - WIDTHS[-1] + 1
#: Training steps, windows a step; windows scored at once.
STEPS, BATCH, CHUNK = 600, 128, 1024
RATE, DECAY = 4e-3, 1e-5
NONE = "und"


class Network:
    """Weights, training and application; ``languages`` in the order of the outputs.

    ``WIDTHS`` are in order and at most 4: applied, the embedding and the
    filters are folded into two tables of byte pairs (same responses).
    """

    def __init__(self, languages: list[str], seed: int = 13):
        rng = np.random.default_rng(seed)
        self.languages = list(languages)
        self.w = {"embed": rng.normal(0, 0.5, (256, EMBED))}
        for n in WIDTHS:
            self.w[f"filter{n}"] = rng.normal(0, np.sqrt(2 / (n * EMBED)), (n * EMBED, FILTERS))
            self.w[f"shift{n}"] = np.zeros(FILTERS)
        self.w["out"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages)))
        self.w["bias"] = np.zeros(len(languages))
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self._tables = None

    def __getstate__(self):
        return {**self.__dict__, "_tables": None}  # each worker folds its own

    def _columns(self, embedded: np.ndarray, n: int) -> np.ndarray:
        """Each run of ``n`` embedded bytes as one row."""
        b = len(embedded)
        flat = np.ascontiguousarray(embedded).reshape(b, LENGTH * EMBED)
        view = np.lib.stride_tricks.as_strided(flat, (b, LENGTH - n + 1, n * EMBED),
                                               (flat.strides[0], EMBED * flat.strides[1], flat.strides[1]))
        return view.reshape(-1, n * EMBED)

    def _pooled(self, windows: np.ndarray):
        """Largest response of every filter, with what the way back needs."""
        embedded, pooled, trace = self.w["embed"][windows], [], []
        for n in WIDTHS:
            cols = self._columns(embedded, n)
            z = (cols @ self.w[f"filter{n}"]).reshape(len(windows), LENGTH - n + 1, FILTERS)
            place = np.ascontiguousarray(z.transpose(0, 2, 1)).argmax(axis=2)
            rows = np.arange(len(windows))[:, None]
            trace.append((cols, place))
            pooled.append(np.maximum(z[rows, place, np.arange(FILTERS)] + self.w[f"shift{n}"], 0))
        return np.concatenate(pooled, axis=1), trace

    def _pairs(self):
        """Responses as sums of two looked-up rows: by the byte pair at a place, and by the pair two bytes on."""
        out = np.zeros((2, 256, 256, len(WIDTHS), FILTERS), dtype=np.float32)
        for i, n in enumerate(WIDTHS):
            for j in range(n):
                one = self.w["embed"] @ self.w[f"filter{n}"][j * EMBED:(j + 1) * EMBED]
                out[j // 2, :, :, i] += one[:, None] if j % 2 == 0 else one[None]
        return out.reshape(2, 65536, len(WIDTHS) * FILTERS)

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        z = pooled @ self.w["out"] + self.w["bias"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def shares(self, windows: np.ndarray) -> np.ndarray:
        """Probability of each language for each window."""
        out = np.empty((len(windows), len(self.languages)), dtype=np.float32)
        if self._tables is None:
            self._tables = tuple(self._pairs())
        near, far = self._tables
        shift = np.concatenate([self.w[f"shift{n}"] for n in WIDTHS])
        for s in range(0, len(windows), CHUNK):
            b = np.ascontiguousarray(windows[s:s + CHUNK].T).astype(np.int64)
            pair = (b[:-1] << 8) + b[1:]
            best = np.full((b.shape[1], near.shape[1]), -np.inf, dtype=np.float32)
            one, two = np.empty_like(best), np.empty_like(best)
            for i in range(LENGTH - 1):
                # the last places hold the narrow filters only
                fit = FILTERS * sum(i + n <= LENGTH for n in WIDTHS)
                np.take(near, pair[i], axis=0, out=one, mode="clip")
                if i + 3 < LENGTH:
                    one += np.take(far, pair[i + 2], axis=0, out=two, mode="clip")
                elif i + 2 < LENGTH:
                    one += np.take(far, b[i + 2] << 8, axis=0, out=two, mode="clip")
                np.maximum(best[:, :fit], one[:, :fit], out=best[:, :fit])
            out[s:s + CHUNK] = self._softmax(np.maximum(best + shift, 0))
        return out

    def gradients(self, windows: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy: only the place where a filter responded most passes it on."""
        pooled, trace = self._pooled(windows)
        rows = np.arange(len(windows))
        off = self._softmax(pooled)
        off[rows, truth] -= 1
        off /= len(windows)
        grad = {"out": pooled.T @ off, "bias": off.sum(axis=0), "embed": np.zeros_like(self.w["embed"])}
        back = (off @ self.w["out"].T) * (pooled > 0)
        for i, n in enumerate(WIDTHS):
            cols, place = trace[i]
            part = back[:, i * FILTERS:(i + 1) * FILTERS]
            seen = cols.reshape(len(windows), LENGTH - n + 1, n * EMBED)[rows[:, None], place]
            grad[f"filter{n}"] = np.einsum("bfk,bf->kf", seen, part)
            grad[f"shift{n}"] = part.sum(axis=0)
            down = (part[:, :, None] * self.w[f"filter{n}"].T[None]).reshape(-1, EMBED)
            at = windows[rows[:, None, None], place[:, :, None] + np.arange(n)].ravel().astype(np.int64)
            slot = at[:, None] * EMBED + np.arange(EMBED)
            grad["embed"] += np.bincount(slot.ravel(), down.ravel(), 256 * EMBED).reshape(256, EMBED)
        return grad

    def train(self, texts: list[tuple[bytes, int]], steps: int = STEPS, batch: int = BATCH, seed: int = 13):
        """Adam steps over windows from uniform places of whole texts, languages alike often."""
        rng, self._tables = np.random.default_rng(seed), None
        of = [[t for t, y in texts if y == k] for k in range(len(self.languages))]
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, steps + 1):
            truth = rng.integers(0, len(of), batch)
            raw = []
            for k in truth:
                text = of[k][rng.integers(len(of[k]))]
                at = int(rng.integers(max(1, len(text) - LENGTH + 1)))
                raw.append(text[at:at + LENGTH].ljust(LENGTH, b"\0"))
            windows = np.frombuffer(b"".join(raw), dtype=np.uint8).reshape(batch, LENGTH)
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in self.gradients(windows, truth).items():
                g = g + DECAY * self.w[k]
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                self.w[k] -= (rate * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return self

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """Mean share of each language over the windows of each text, weighted by bytes."""
        raw = np.frombuffer(b"".join(texts) + bytes(LENGTH), dtype=np.uint8)
        size = np.array([len(t) for t in texts], dtype=np.int64)
        many = np.maximum(1, -(-(size - LENGTH) // STRIDE) + 1)
        doc = np.repeat(np.arange(len(texts)), many)
        inside = (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * STRIDE
        begin, end = (np.cumsum(size) - size)[doc] + inside, np.cumsum(size)[doc]
        total, weight = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for s in range(0, len(doc), CHUNK):
            at = begin[s:s + CHUNK, None] + np.arange(LENGTH)
            known = at < end[s:s + CHUNK, None]
            bytes_ = known.sum(axis=1)
            share = self.shares(np.where(known, raw[np.minimum(at, len(raw) - 1)], 0))
            np.add.at(total, doc[s:s + CHUNK], share * bytes_[:, None])
            np.add.at(weight, doc[s:s + CHUNK], bytes_)
        return total / np.maximum(weight, 1)[:, None]


def sample(docs: DataFrame, per_lang: int = PER_LANG, languages: int = LANGUAGES, folds: int = 5) -> list[tuple[str, bytes]]:
    """At most ``per_lang`` distinct training texts of each of the ``languages`` most frequent languages, on the driver.

    Only rows whose crc32(doc_id) mod ``folds`` is not 0, with a text and a
    language. Texts are taken by a hash of the text; each task passes a text on
    once, so copies never gather.
    """
    rows = docs.where((fold("doc_id", folds) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    if not counts:
        return []
    # about four times as many as needed pass the hash
    share = docs.sparkSession.createDataFrame([(r["lang"], int(min(1.0, 4 * per_lang / r["n"]) * (1 << 40))) for r in counts],
                                              "lang string, upto long")
    near = rows.where(F.col("text").rlike(r"\p{L}")).join(F.broadcast(share), "lang").withColumn("th", F.xxhash64("text"))
    near = near.where(F.pmod(F.xxhash64("th", F.lit(13)), F.lit(1 << 40)) < F.col("upto")).select("lang", "th", "text")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            fresh = []
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if key not in seen:
                    seen.add(key)
                    fresh.append(i)
            if fresh:
                yield batch.take(pa.array(fresh))

    single = near.mapInArrow(once, near.schema).dropDuplicates(["lang", "th"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("th"))
    picked = single.withColumn("_p", place).where(F.col("_p") <= per_lang).select("lang", "th", "text").collect()
    return [(r["lang"], r["text"].encode("utf-8")) for r in sorted(picked, key=lambda r: (r["lang"], r["th"]))]


def fit(docs: DataFrame, per_lang: int = PER_LANG, languages: int = LANGUAGES, steps: int = STEPS) -> Network:
    """A network trained on ``sample`` (no language at all: a network without outputs)."""
    rows = sample(docs, per_lang, languages)
    names = sorted({lang for lang, _ in rows})
    net = Network(names)
    return net.train([(text, names.index(lang)) for lang, text in rows], steps) if names else net


def predict(docs: DataFrame, net: Network, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language of each whole text and its share of the text.

    ``und`` and 0 where the text is null or has no letter, or nothing was
    learned. Ties go to the first language in order. A text takes memory in
    proportion to its bytes; its windows are scored in bounded batches.
    """
    raw, letter = free_name(docs, "_raw"), free_name(docs, "_letter")
    given = docs.withColumns({raw: F.col("text").cast("string").cast("binary"),
                              letter: F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))})

    def build():
        def call(raws, letters):
            texts, letters = raws.to_pylist(), np.asarray(letters.to_pylist(), dtype=bool)
            lang, score = [NONE] * len(texts), np.zeros(len(texts))
            use = np.flatnonzero(letters) if net.languages else []
            if len(use):
                share = net.texts([texts[i] for i in use])
                best = share.argmax(axis=1)
                score[use] = np.clip(share[np.arange(len(use)), best], 0, 1)
                for i, k in zip(use.tolist(), best.tolist()):
                    lang[i] = net.languages[k]
            return [lang, score]
        return call

    kept = [c for c in docs.columns if c not in names]
    return add_columns(given, build, [raw, letter], [(names[0], T.StringType()), (names[1], T.DoubleType())], keep=kept)


def identify(docs: DataFrame, per_lang: int = PER_LANG, languages: int = LANGUAGES, steps: int = STEPS) -> DataFrame:
    """Per document: doc_id, held_out (not in the training folds), lang_pred, score.

    Repeated rows get the same answer; a null doc_id counts as the empty text
    in the fold; empty documents give an empty table.
    """
    net = fit(docs, per_lang, languages, steps)
    out = predict(docs.select("doc_id", "text"), net)
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
