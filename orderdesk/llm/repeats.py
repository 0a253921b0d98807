"""Exact removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes matter only through their first ``length`` bytes: equal groups at that
depth are exactly the repeated windows. The passes go from the most significant
digit down and drop what is already settled:

1. The first digit of a window is the smallest-hash ``gram`` bytes inside it
   (its anchor); equal windows have the same anchor at the same offset.
   Consecutive windows with one anchor form one row, so a text has about
   2 / (length - gram) rows per byte. An anchor gram that occurs once settles
   all its windows: none is repeated.
2. The second digit is the whole region that the windows of a row cover. Rows
   equal in it are repeated as a whole. A gram with one region only is settled.
3. Where a gram has several regions, one row of each region is opened into its
   windows, and the last digit, the hash of the whole window, decides: in the
   task that holds the gram, or, for grams with very many regions, by a shuffle
   of the windows themselves.

Every pass counts with partial aggregation, so a passage shared by a third of
all documents is one row per task and pass. Rows are told apart by doc_id and a
hash of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, add_columns, fresh_keys, materialise, text_of

LENGTH, GRAM = 400, 100
#: Window starts handled at once in a task.
CHUNK = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
_rng = np.random.default_rng(400)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int):
    """base ** i and its inverse, modulo 2 ** 64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, CHUNK + LENGTH + 1)
        for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(size, b, dtype=np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"], _POWERS["down"]


class Hashes:
    """Hashes of any stretch of a buffer, from one running sum."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _powers(len(raw) + 1)
        self.sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[:len(raw)], dtype=np.uint64)])

    def of(self, start, end):
        return (self.sum[end] - self.sum[start]) * self.down[start]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def anchor_runs(raw: np.ndarray, doc_end: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Rows (anchor, first start, last start, gram hash, region hash) of a buffer of texts.

    ``doc_end[i]`` is where the text that holds byte i ends; windows lie within one text.
    """
    out = []
    for c in range(0, max(0, len(raw) - length + 1), CHUNK):
        part = raw[c:c + CHUNK + length - 1]
        n = len(part) - length + 1
        starts = np.flatnonzero(np.arange(c, c + n) + length <= doc_end[c:c + n])
        if not len(starts):
            continue
        hashes = Hashes(part)
        at = np.arange(len(part) - gram + 1)
        low = (_mixed(hashes.of(at, at + gram)) & ~_PLACE) | at.astype(np.uint64)
        span, width = length - gram + 1, 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
        anchor = (low[starts] & _PLACE).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(starts) != 1)
                                   | (doc_end[c + starts[1:]] != doc_end[c + starts[:-1]])])
        first, last, a = starts[new], starts[np.r_[new[1:] - 1, len(starts) - 1]], anchor[new]
        out.append((a + c, first + c, last + c, hashes.of(a, a + gram).view(np.int64), hashes.of(first, last + length).view(np.int64)))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 5


ROWS = "doc_id long, th long, pos int, hi int, lo int, gram long, region long"


def anchors(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """A row per anchor: its place, the largest and smallest offset of it in its windows, gram and region hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes)))
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                texts = part.column(2).to_pylist()
                size = np.array([len(t) for t in texts], dtype=np.int64)
                ends = np.cumsum(size)
                raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
                a, first, last, g, r = anchor_runs(raw, np.repeat(ends, size), length, gram)
                doc = np.searchsorted(ends, a, side="right")
                ids, th = part.column(0).take(pa.array(doc)), part.column(1).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays(
                    [ids, th, pa.array((a - (ends - size)[doc]).astype(np.int32)), pa.array((a - first).astype(np.int32)),
                     pa.array((a - last).astype(np.int32)), pa.array(g), pa.array(r)],
                    names=["doc_id", "th", "pos", "hi", "lo", "gram", "region"])

    text = text_of()
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("th"), text.cast("binary").alias("raw")
                       ).where(F.octet_length("raw") >= length).mapInArrow(run, ROWS)


REGIONS = "doc_id long, th long, pos int, hi int, lo int, n long, gram long, members long, bytes binary"
#: Regions of one gram that a task decides by itself; larger groups are opened into windows and shuffled.
GROUP = 20_000


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, th and the text compressed, for the joins that move texts."""
    def build():
        coder = zstandard.ZstdCompressor(level=3)
        return lambda raws: [[coder.compress(r) for r in raws.to_pylist()]]

    text = text_of()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("raw"))
    return add_columns(rows, build, ["raw"], [("packed", T.BinaryType())], keep=["doc_id", "th"])


def _unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _region_bytes(asked: DataFrame, length: int) -> DataFrame:
    """The bytes that the windows of each listed row cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, th, packed, rows in zip(*(batch.column(i) for i in range(4))):
                raw, rows = _unpacked(packed.as_py()), rows.as_py()
                made = [{"doc_id": doc_id.as_py(), "th": th.as_py(), **r, "bytes": raw[r["pos"] - r["hi"]:r["pos"] - r["lo"] + length]}
                        for r in rows]
                yield pa.RecordBatch.from_pylist(made, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("pos", pa.int32()), ("hi", pa.int32()), ("lo", pa.int32()),
                        ("n", pa.int64()), ("gram", pa.int64()), ("members", pa.int64()), ("bytes", pa.binary())])
    return asked.mapInArrow(run, REGIONS)


class _Windows:
    """All windows of a set of regions: row, start in the text, and a key equal for equal windows."""

    def __init__(self, rows: pa.RecordBatch, length: int):
        col = {n: np.asarray(rows.column(rows.schema.get_field_index(n))).astype(np.int64) for n in ("pos", "hi", "lo", "n", "gram", "th")}
        texts = rows.column(rows.schema.get_field_index("bytes")).to_pylist()
        size = np.array([len(t) for t in texts], dtype=np.int64)
        hashes = Hashes(np.frombuffer(b"".join(texts), dtype=np.uint8))
        count = size - length + 1
        self.row = np.repeat(np.arange(len(size)), count)
        inside = np.arange(len(self.row)) - np.repeat(np.cumsum(count) - count, count)
        at = (np.cumsum(size) - size)[self.row] + inside
        self.n = col["n"][self.row]
        self.start = (col["pos"] - col["hi"])[self.row] + inside
        offset = col["hi"][self.row] - inside
        self.window = hashes.of(at, at + length).view(np.int64)
        self.place = _mixed((col["gram"][self.row] ^ (offset << 40)).view(np.uint64)).view(np.int64)


def _settle(regions: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, start, end) of the repeated windows of regions that stand alone, group by group."""
    def found(rows: pa.RecordBatch):
        w = _Windows(rows, length)
        key = _mixed((w.window ^ w.place).view(np.uint64))
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
        total = np.add.reduceat(w.n[order], first)
        twice = np.empty(len(key), dtype=bool)
        twice[order] = np.repeat(total > 1, np.diff(np.r_[first, len(key)]))
        hit = np.flatnonzero(twice & (w.n == 1))
        if not len(hit):
            return None
        new = np.flatnonzero(np.r_[True, (np.diff(hit) != 1) | (np.diff(w.row[hit]) != 0)])
        begin, last = hit[new], hit[np.r_[new[1:] - 1, len(hit) - 1]]
        row = pa.array(w.row[begin])
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(row), rows.column(1).take(row), pa.array(w.start[begin].astype(np.int32)),
             pa.array((w.start[last] + length).astype(np.int32))], names=["doc_id", "th", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            g = np.asarray(held.column(6))
            whole = int(np.flatnonzero(g != g[-1])[-1]) + 1 if len(g) and (g != g[-1]).any() else 0
            if whole:
                out = found(held.slice(0, whole))
                held = held.slice(whole)
                if out is not None:
                    yield out
        if held is not None and held.num_rows:
            out = found(held)
            if out is not None:
                yield out

    return (regions.repartition("gram").sortWithinPartitions("gram")
            .mapInArrow(run, "doc_id long, th long, start int, end int"))


def _open_windows(regions: DataFrame, length: int) -> DataFrame:
    """The windows of the regions: a, b (window hash; gram and offset), n, and where they start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                rows = batch.slice(i, 500)
                w = _Windows(rows, length)
                row = pa.array(w.row)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(row), rows.column(1).take(row), pa.array(w.start.astype(np.int32)), pa.array(w.n),
                     pa.array(w.window), pa.array(w.place)], names=["doc_id", "th", "start", "n", "a", "b"])

    return regions.mapInArrow(run, "doc_id long, th long, start int, n long, a long, b long")


def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(doc_id, th, spans): for each row with repeated strings, stretches [start, end) of bytes they cover."""
    key = ["gram", "region", "hi", "lo"]
    rows = materialise(anchors(docs, length, gram), "anchors")
    twice = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("gram")
    rows = materialise(rows.join(fresh_keys(twice, "gram").hint("merge"), "gram", "left_semi"), "shared")
    regions = materialise(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "pos")).alias("one")), "regions")
    whole = rows.join(regions.where("n > 1").select(*key), key, "left_semi")
    several = regions.groupBy("gram").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    ask = regions.join(fresh_keys(several, "gram"), "gram").select("one.*", "hi", "lo", "n", "gram", "members")
    ask = ask.groupBy("doc_id", "th").agg(F.collect_list(F.struct("pos", "hi", "lo", "n", "gram", "members")).alias("rows"))
    texts = _packed(docs.where(F.octet_length(text_of()) >= length)).withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    asked = texts.join(ask.hint("merge"), texts["_id"].eqNullSafe(ask["doc_id"]) & (texts["_th"] == ask["th"]))
    asked = materialise(_region_bytes(asked.select("doc_id", "th", "packed", "rows"), length), "opened")
    windows = _open_windows(asked.where(F.col("members") > group), length)
    equal = windows.groupBy("a", "b").agg(F.sum("n").alias("n")).where("n > 1").select("a", "b")
    single = windows.where("n = 1").join(fresh_keys(equal, "a", "b").hint("merge"), ["a", "b"], "left_semi")
    spans = whole.select("doc_id", "th", (F.col("pos") - F.col("hi")).alias("start"), (F.col("pos") - F.col("lo") + length).alias("end"))
    spans = spans.unionByName(_settle(asked.where(F.col("members") <= group), length))
    spans = spans.unionByName(single.select("doc_id", "th", "start", (F.col("start") + length).alias("end")))
    return spans.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def cut(raw: bytes, spans) -> tuple[bytes, int, int]:
    """Remaining bytes, removed bytes and maximal removed runs."""
    mark = np.zeros(len(raw) + 1, dtype=np.int64)
    start, end = np.array([(s["start"], s["end"]) for s in spans], dtype=np.int64).reshape(-1, 2).T
    np.add.at(mark, start, 1)
    np.add.at(mark, end, -1)
    gone = np.cumsum(mark[:-1]) > 0
    runs = int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum())
    return np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (binary).

    Null and empty texts and texts under ``length`` bytes lose nothing; repeated
    rows are texts that repeat each other; an empty table gives an empty table.
    """
    found = repeated(docs, length, gram, group).withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    texts = _packed(docs)
    rows = texts.join(found.hint("merge"), texts["doc_id"].eqNullSafe(F.col("_id")) & (texts["th"] == F.col("_th")), "left")

    def build():
        def call(packed, spans):
            raws = [_unpacked(p) for p in packed.to_pylist()]
            made = [(r, 0, 0) if not s else cut(r, s) for r, s in zip(raws, spans.to_pylist())]
            return [[len(r) for r in raws], [m[1] for m in made], [m[2] for m in made], [m[0] for m in made]]
        return call

    return add_columns(rows, build, ["packed", "spans"], [("n_bytes", T.LongType()), ("n_removed", T.LongType()),
                                                       ("n_spans", T.LongType()), ("kept", T.BinaryType())], keep=["doc_id"])
