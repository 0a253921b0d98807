"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes with the counts of
what follows, gathered from all training texts. A byte is coded in its longest
known context; if it is new there, the escape estimate (distinct followers over
occurrences plus distinct followers) is paid and the next shorter context is
asked, leaving out the bytes already excluded. As every occurrence of a context
is one of its suffix too, the excluded bytes at an order are the followers of
the context one byte longer, so the code length of a byte depends on its
(ORDER + 1)-gram alone. The trie is therefore kept as gram tables, one per
order, and every distinct gram gets its log probability by joins.

Texts are packed into blocks once. A block asks for its own distinct grams and
words only, so no model is ever sent whole to a task: the tables can grow with
the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, fresh_keys, materialise, text_of

ORDER = 4
#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 16_000_000
#: Largest gram table that is broadcast to the join (16 bytes a row).
SENT_GRAMS = 1_000_000
START, END = 0xFE, 0xFF  # bytes that no UTF-8 text has
PACK = T.StructType([T.StructField("block", T.LongType()), T.StructField("n_bytes", T.LongType()),
                     T.StructField("payload", T.BinaryType())])


def grams(raw: bytes, order: int = ORDER) -> np.ndarray:
    """The (order + 1)-gram that ends at each byte of the text and at its end, as integers."""
    x = np.frombuffer(bytes([START]) * order + raw + bytes([END]), dtype=np.uint8).astype(np.int64)
    n = len(x) - order
    out = np.zeros(n, dtype=np.int64)
    for j in range(order + 1):
        out <<= 8
        out |= x[j:j + n]
    return out


def pack(docs: DataFrame, folds: int = 7, out: int = 2) -> DataFrame:
    """Blocks of whole texts: block, n_bytes, payload (compressed Arrow rows of doc_id, held_out, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", folds) == out).alias("held_out"),
                       text_of().cast("binary").alias("text"), F.spark_partition_id().alias("part"))
    arrow = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number, part = [], 0, 0, 0
        coder = zstandard.ZstdCompressor(level=3)

        def flush():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, arrow) as w:
                for b in held:
                    w.write_batch(b)
            payload = coder.compress(sink.getvalue().to_pybytes())
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | number]), pa.array([size]), pa.array([payload], pa.binary())],
                                              names=["block", "n_bytes", "payload"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(3)[0].as_py()
            batch = batch.select([0, 1, 2])
            lens = np.array(pc.binary_length(batch.column(2)), dtype=np.int64)
            at = 0
            while at < len(lens):
                room = np.searchsorted(np.cumsum(lens[at:]), max(1, BLOCK_BYTES - size), side="right")
                take = max(int(room), 0 if held else 1)
                if take:
                    piece = pa.RecordBatch.from_pydict({n: pa.concat_arrays([batch.column(i).slice(at, take)])
                                                        for i, n in enumerate(arrow.names)}, schema=arrow)
                    held.append(piece)
                    size += int(lens[at:at + take].sum())
                    at += take
                if at < len(lens) or size >= BLOCK_BYTES:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    return rows.mapInArrow(run, PACK)


def unpack(payload: bytes):
    """(doc_id, held_out, text) of each document of a block."""
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(payload)
    for batch in pa.ipc.open_stream(raw):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            yield row


def _counted(parts: list[np.ndarray]):
    g = np.concatenate(parts)
    g.sort()
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    return g[first], np.diff(np.r_[first, len(g)])


def _merged(parts):
    """Sums of (gram, n) parts by gram."""
    g, n = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    order = np.argsort(g, kind="stable")
    g, n = g[order], n[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    return g[first], np.add.reduceat(n, first) if len(g) else n


class _Tally:
    """Distinct grams with counts, gathered a few MB at a time."""

    def __init__(self):
        self.parts, self.wait, self.size = [], [], 0

    def add(self, g: np.ndarray) -> None:
        self.wait.append(g)
        self.size += len(g)
        if self.size > 2_000_000:
            self.flush()

    def flush(self) -> None:
        if self.wait:
            self.parts.append(_counted(self.wait))
            self.wait, self.size = [], 0
            if len(self.parts) > 4:
                self.parts = [_merged(self.parts)]

    def result(self):
        self.flush()
        return _merged(self.parts)


def gather(packs: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """(block, gram, n) and (block, word, n): what each block holds, n counted in training texts (0: held out only)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                known, other, seen, both = _Tally(), _Tally(), Counter(), set()
                for _, held_out, text in unpack(payload):
                    (other if held_out else known).add(grams(text, order))
                    (both if held_out else seen).update(text.lower().split())
                (g, n), (og, _) = known.result(), other.result()
                og = np.setdiff1d(og, g, assume_unique=True)
                g, n = np.r_[g, og], np.r_[n, np.zeros(len(og), np.int64)]
                words = list(seen) + [w for w in both if w not in seen]
                counts = np.array([seen[w] for w in words], dtype=np.int64)
                for at in range(0, len(g), 50_000):
                    m = len(g[at:at + 50_000])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(m, block)), pa.array(g[at:at + m]), pa.nulls(m, pa.binary()),
                                                      pa.array(n[at:at + m])], names=["block", "gram", "word", "n"])
                for at in range(0, len(words), 50_000):
                    m = len(words[at:at + 50_000])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(m, block)), pa.nulls(m, pa.int64()),
                                                      pa.array(words[at:at + m], pa.binary()), pa.array(counts[at:at + m])],
                                                     names=["block", "gram", "word", "n"])

    held = materialise(packs.select("block", "payload").mapInArrow(run, "block long, gram long, word binary, n long"), "held")
    return (held.where("gram is not null").select("block", "gram", "n"),
            held.where("word is not null").select("block", "word", "n"))


class GramTable:
    """Values of distinct grams by open addressing."""

    def __init__(self, g: np.ndarray, value: np.ndarray):
        self.bits = max(4, (4 * len(g)).bit_length())
        self.key = np.full((1 << self.bits) + 1024, -1, dtype=np.int64)
        self.value = np.zeros(len(self.key))
        left, at = np.arange(len(g)), self._slot(g)
        while len(left):
            free = self.key[at] == -1
            _, one = np.unique(at[free], return_index=True)
            put = np.flatnonzero(free)[one]
            self.key[at[put]], self.value[at[put]] = g[left[put]], value[left[put]]
            rest = np.ones(len(left), dtype=bool)
            rest[put] = False
            left, at = left[rest], at[rest] + 1
            if len(at) and at.max() >= len(self.key):
                raise MemoryError("table too full")

    def _slot(self, g):
        return ((g.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def total(self, g: np.ndarray) -> float:
        """Sum of the values of grams that are all in the table."""
        at = self._slot(g)
        miss = np.flatnonzero(self.key[at] != g)
        while len(miss):
            at[miss] += 1
            miss = miss[self.key[at[miss]] != g[miss]]
        return float(self.value[at].sum())


def log_probabilities(grams_: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, logp): log10 probability of the last byte of every distinct gram given the bytes before it.

    ``grams_``: gram, n (training count, 0 if it is only to be scored).
    """
    total = materialise(grams_.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    tables = {}  # order k -> (g: context of k bytes and the follower, n)
    for k in range(order, -1, -1):
        mask = (1 << 8 * (k + 1)) - 1
        source = total.where("n > 0") if k == order else tables[k + 1]
        tables[k] = materialise(source.groupBy(F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.sum("n").alias("n")), "trie")
    # order 0 and below: 256 bytes and the end, uniform over what order 0 has not seen
    for k in range(order + 1):
        here = tables[k].select("gram", F.shiftright("gram", 8).alias("ctx"), "n")
        nodes = here.groupBy("ctx").agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("d"))
        if k < order:
            # what remains of this context once the followers of each longer context are left out
            mask = (1 << 8 * (k + 1)) - 1
            longer = tables[k + 1].select(F.shiftright("gram", 8).alias("long_ctx"), F.col("gram").bitwiseAND(mask).alias("gram"))
            gone = longer.join(here.select("gram", "n"), "gram").groupBy("long_ctx").agg(F.sum("n").alias("gt"), F.count(F.lit(1)).alias("gd"))
            tables[f"left{k}"] = gone.join(nodes, F.expr(f"long_ctx & {(1 << 8 * k) - 1}L") == F.col("ctx")).select(
                "long_ctx", (F.col("t") - F.col("gt")).alias("t"), (F.col("d") - F.col("gd")).alias("d"))
        tables[f"nodes{k}"] = nodes
    wanted = total.select("gram")
    # from the longest context down: cost so far, and whether the byte is still to be coded
    state = wanted.select("gram", F.lit(0.0).alias("cost"), F.lit(True).alias("open"), F.lit(False).alias("entered"))
    for k in range(order, -1, -1):
        mask = (1 << 8 * (k + 1)) - 1
        state = state.withColumns({"g": F.col("gram").bitwiseAND(mask), "ctx": F.shiftright(F.col("gram").bitwiseAND(mask), 8),
                                   "long_ctx": F.shiftright(F.col("gram").bitwiseAND((1 << 8 * (k + 2)) - 1), 8)})
        state = state.join(tables[k].select(F.col("gram").alias("g"), "n"), "g", "left")
        nodes = fresh_keys(tables[f"nodes{k}"].select("ctx", F.col("t").alias("t0"), F.col("d").alias("d0")), "ctx")
        state = state.join(nodes, "ctx", "left")
        if k < order:
            state = state.join(fresh_keys(tables[f"left{k}"].select("long_ctx", "t", "d"), "long_ctx"), "long_ctx", "left")
            t = F.when(F.col("entered"), F.col("t")).otherwise(F.col("t0"))
            d = F.when(F.col("entered"), F.col("d")).otherwise(F.col("d0"))
        else:
            t, d = F.col("t0"), F.col("d0")
        state = state.withColumns({"tt": F.coalesce(t, F.lit(0)), "dd": F.coalesce(d, F.lit(0)), "known": F.col("t0").isNotNull()})
        asked = F.col("open") & F.col("known")
        found = asked & F.col("n").isNotNull()
        cost = (F.when(found, F.log10(F.col("n") / (F.col("tt") + F.col("dd"))))
                .when(asked & (F.col("tt") > 0), F.log10(F.col("dd") / (F.col("tt") + F.col("dd")))).otherwise(F.lit(0.0)))
        state = state.select("gram", (F.col("cost") + cost).alias("cost"), (F.col("open") & ~found).alias("open"),
                             (F.col("entered") | F.col("known")).alias("entered"), *([F.col("d0").alias("seen")] if k == 0 else []))
    rest = F.when(F.col("open"), -F.log10(F.lit(257.0) - F.coalesce("seen", F.lit(0)))).otherwise(F.lit(0.0))
    return state.select("gram", (F.col("cost") + rest).alias("logp"))


def score(docs: DataFrame, order: int = ORDER, folds: int = 7, out: int = 2) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null texts are read as empty (the end alone is coded); repeated rows are
    counted and scored as often as they stand; an empty table gives an empty
    table. Without training texts every byte is coded uniformly.
    """
    packs = materialise(pack(docs, folds, out), "packs")
    held_grams, held_words = gather(packs, order)
    logp = materialise(log_probabilities(held_grams.select("gram", "n"), order), "logp")
    if logp.count() <= SENT_GRAMS:  # a checked size; beyond it the join shuffles
        logp = F.broadcast(logp)
    by_gram = held_grams.select("block", "gram").join(logp, "gram").select(
        "block", "gram", F.lit(None).cast("binary").alias("word"), F.col("logp").alias("value"))
    # one row per block and word: its count everywhere, sent back only where the block cannot know it
    everywhere = Window.partitionBy("word")
    counted = held_words.select("block", "word", "n", F.sum("n").over(everywhere).alias("c"),
                                F.row_number().over(everywhere.orderBy("block")).alias("k"))
    counted = counted.select("block", F.when(F.col("c") != F.col("n"), F.col("word")).alias("word"), "c",
                             ((F.col("k") == 1) & (F.col("c") > 0)).alias("new")).where("word is not null or new")
    counted = materialise(counted, "words")
    distinct = counted.where("new").count()
    tokens = held_words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ends = docs.agg(F.coalesce(F.sum((fold("doc_id", folds) != out).cast("long")), F.lit(0))).first()[0]
    train_tokens, distinct = tokens + ends, distinct + (1 if ends else 0)
    by_word = counted.where("word is not null").select(
        "block", F.lit(None).cast("long").alias("gram"), "word", F.col("c").cast("double").alias("value"))

    result = pa.schema([(f.name, {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[f.dataType.simpleString()])
                        for f in OUT])

    def scored(key, left, right):
        mine = right.filter(pc.is_valid(right.column("gram")))
        table = GramTable(mine.column("gram").to_numpy(), mine.column("value").to_numpy())
        mine = right.filter(pc.is_valid(right.column("word")))
        elsewhere = dict(zip(mine.column("word").to_pylist(), mine.column("value").to_numpy().astype(np.int64).tolist()))
        del right, mine
        whole = np.log10(float(train_tokens) + distinct + 1) if train_tokens else 0.0
        rows = []
        for payload in left.column("payload").to_pylist():
            count = Counter()
            for _, held_out, text in unpack(payload):
                if not held_out:
                    count.update(text.lower().split())
            count = dict(count)
            count.update(elsewhere)
            for doc_id, held_out, text in unpack(payload):
                c = np.array([count.get(w, 0) for w in text.lower().split()] + [ends], dtype=np.float64)
                rows.append((doc_id, held_out, len(c), int((c > 0).sum()), train_tokens,
                             float((np.log10(c + 1) - whole).sum()), table.total(grams(text, order))))
        return pa.Table.from_pylist([dict(zip(OUT.names, r)) for r in rows], schema=result)

    return packs.groupBy("block").cogroup(by_gram.unionByName(by_word).groupBy("block")).applyInArrow(scored, OUT)


OUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                    T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                    T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
                    T.StructField("score", T.DoubleType())])
