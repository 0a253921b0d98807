"""Importance resampling of documents toward a target distribution.

Words, or runs of a few words, are hashed to buckets; a bucket's gain is the
log ratio of its smoothed share in the target texts and in all documents. A
document's weight is the sum of its gains; a Gumbel draw keyed by its id is
added, and the highest sums are a sample without replacement.

Buckets come from CRC-32, which is linear over exclusive-or: a byte's share in
the checksum depends only on the byte and its distance from the end. Those
shares are a table (``PositionCrc``); one ``bitwise_xor.reduceat`` over the
bytes of all features of a slice gives every checksum, up to a constant for the
length. Longer features are cut into blocks and folded pairwise.

Counting yields one row per task and bucket, so ``buckets`` rows reach the
driver whatever the corpus holds; documents never move, and the drawn order is
one sort by range of narrow rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, add_columns, free_name, materialise, text_of

BUCKETS, MAX_WORDS, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
# fixed value: the reflected CRC-32 polynomial
POLYNOMIAL = 0xEDB88320
#: Distances in the position table (a block of a long feature); blocks summed at once.
DEPTH, STEP = 64, 1 << 15
# word bytes: 0-9, a-z after lower-casing, and all of other scripts
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class PositionCrc:
    """CRC-32 of many spans of one buffer."""

    def __init__(self, depth: int = DEPTH):
        byte = np.arange(256, dtype=np.uint32)
        one = byte.copy()
        for _ in range(8):
            one = (one >> np.uint32(1)) ^ np.where(one & 1, np.uint32(POLYNOMIAL), np.uint32(0))
        self.depth = depth
        # table[d][b]: what byte b adds when d bytes follow it
        rows = [one]
        while len(rows) < depth:
            rows.append((rows[-1] >> np.uint32(8)) ^ one[rows[-1] & 255])
        self.table = np.concatenate(rows)
        # skips[k]: a register's four bytes after 2 ** k zero bytes
        first = np.stack([byte << np.uint32(8 * q) for q in range(4)])
        self.skips = [(first >> np.uint32(8)) ^ one[first & 255]]

    def _skip(self, k: int, register: np.ndarray) -> np.ndarray:
        while len(self.skips) <= k:
            last = len(self.skips) - 1
            self.skips.append(self._skip(last, self.skips[last]))
        t = self.skips[k]
        return (t[0][register & 255] ^ t[1][register >> np.uint32(8) & 255]
                ^ t[2][register >> np.uint32(16) & 255] ^ t[3][register >> np.uint32(24)])

    def constants(self, length: np.ndarray) -> np.ndarray:
        """CRC-32 of that many zero bytes."""
        sizes, back = np.unique(length, return_inverse=True)
        register = np.full(len(sizes), 0xFFFFFFFF, dtype=np.uint32)
        for k in range(int(sizes[-1]).bit_length() if len(sizes) else 0):
            on = (sizes >> k & 1) == 1
            register[on] = self._skip(k, register[on])
        return (register ^ np.uint32(0xFFFFFFFF))[back]

    def of(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """CRC-32 of raw[start:end] for each span (none empty)."""
        if not len(start):
            return np.zeros(0, dtype=np.uint32)
        many = -(-(end - start) // self.depth)
        span = np.repeat(np.arange(len(start)), many)
        after = np.repeat(np.cumsum(many), many) - 1 - np.arange(len(span))  # blocks that follow in the span
        to = end[span] - after * self.depth
        begin = np.maximum(start[span], to - self.depth)
        value = np.empty(len(span), dtype=np.uint32)
        for s in range(0, len(span), STEP):
            b, e = begin[s:s + STEP], to[s:s + STEP]
            size = e - b
            first = np.cumsum(size) - size
            at = np.arange(int(size.sum())) + np.repeat(b - first, size)
            value[s:s + STEP] = np.bitwise_xor.reduceat(self.table[(np.repeat(e - 1, size) - at) * 256 + raw[at]], first)
        level = self.depth.bit_length() - 1
        while len(value) > len(start):  # two neighbouring blocks become one, counted from the span's end
            left = (after & 1) == 1
            value[left] = self._skip(level, value[left])
            head = np.flatnonzero(left | np.r_[True, span[1:] != span[:-1]])
            value, after, span, level = np.bitwise_xor.reduceat(value, head), after[head] // 2, span[head], level + 1
        return value ^ self.constants(end - start)


def features(crc: PositionCrc, texts: list[bytes], buckets: int, max_words: int):
    """Word count of every text, and text index and bucket of every feature."""
    raw = np.frombuffer(b" ".join(texts).translate(_WORD), dtype=np.uint8)
    size = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    inside = raw != 32
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # one blank after each word
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    doc = np.searchsorted(np.cumsum(size), np.flatnonzero(edge == 1), side="right")
    words = np.bincount(doc, minlength=len(texts))
    flat = raw[keep]
    edge = np.diff(np.r_[False, flat != 32, False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner, bucket = [], []
    for n in range(1, max_words + 1):
        whole = np.flatnonzero(doc[:len(doc) - n + 1] == doc[n - 1:]) if len(doc) >= n else np.zeros(0, dtype=np.int64)
        owner.append(doc[whole])
        bucket.append(crc.of(flat, start[whole], end[whole + n - 1]).astype(np.int64) % buckets)
    return words, np.concatenate(owner), np.concatenate(bucket)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> np.ndarray:
    """How many features of all ``texts`` (column text) fall into each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, total = PositionCrc(), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            step = max(1, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes)))
            for at in range(0, batch.num_rows, step):
                total += np.bincount(features(crc, batch.column(0).slice(at, step).to_pylist(), buckets, max_words)[2],
                                     minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    raw = texts.select(text_of().cast("binary").alias("raw"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in raw.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source."""
    b, s, t = float(len(source)), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((y + 1) * (s + b) / ((x + 1) * (t + b))))
                     for x, y in zip(source.astype(float).tolist(), target.astype(float).tolist())], dtype=np.int64)


def weigh(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> DataFrame:
    """``docs`` with n_words, n_features and weight (sum of the gains of all features, repeats counted)."""
    gain = gains(bucket_counts(docs, buckets, max_words), bucket_counts(target, buckets, max_words))
    raw = free_name(docs, "_raw")

    def build():
        crc = PositionCrc()

        def call(raws):
            words, doc, bucket = features(crc, raws.to_pylist(), buckets, max_words)
            total = np.zeros(len(words), dtype=np.int64)
            np.add.at(total, doc, gain[bucket])
            return [words, np.bincount(doc, minlength=len(words)), total]
        return call

    kept = [c for c in docs.columns if c not in ("n_words", "n_features", "weight")]
    return add_columns(docs.withColumn(raw, text_of().cast("binary")), build, [raw],
                       [(n, T.LongType()) for n in ("n_words", "n_features", "weight")], keep=kept)


def gumbel(doc_id: str, seed: int):
    """floor(1000 x) of a Gumbel draw x fixed by the seed and the id (a null id counts as the empty text)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
         buckets: int = BUCKETS, max_words: int = MAX_WORDS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight, score, rank.

    ``percent`` of the documents with ``least_words`` words or more are drawn
    (rounded down): rank 1, 2, ... by score, ties to the smaller doc_id; all
    others have a null rank. Null and empty texts have no word and weight 0;
    repeated rows are documents of their own (equal ids share their draw and
    are ordered by weight and size); a null id comes after the others of its
    score; an empty target smooths to equal shares; empty documents give an
    empty table. Very long texts take memory in proportion to their length.
    """
    scored = weigh(docs.select("doc_id", "text"), target, buckets, max_words).drop("text")
    scored = materialise(scored.withColumn("score", F.col("weight") + gumbel("doc_id", seed)), "scored")
    able = scored.where(F.col("n_words") >= least_words)
    # position in the sorted write: slice of the range shuffle in the high bits, row in the low 33
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")]
    placed = materialise(able.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", 33)
    # one row per slice of the shuffle: at most spark.sql.shuffle.partitions
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    total = placed.agg(F.floor(F.count(F.lit(1)) * percent / 100).alias("k")).first()["k"]
    ranked = placed.withColumn("_part", part).join(F.broadcast(first.select("_part", "_first")), "_part").withColumn(
        "rank", F.col("_first") + F.col("_at") - F.shiftleft("_part", 33) + 1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= total, F.col("rank")))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    names = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(*names).unionByName(rest.select(*names))


_CRC_TABLE = ("(select list(list_reduce(list_prepend(b, range(8)), lambda c, i: "
              f"case when c & 1 = 1 then xor(c >> 1, {POLYNOMIAL}) else c >> 1 end) order by b) as t from range(256) r(b))")
_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: The contract of op11 in DuckDB SQL (one-word features).
ORACLE = f"""with crc as {_CRC_TABLE},
src as (select row_number() over () as r, doc_id, coalesce({_WORDS}, []) as words from documents),
occ as (select r, unnest(words) as w from src),
tgt as (select unnest({_WORDS}) as w from benchmark),
vocab as (select distinct w from (select w from occ union all select w from tgt)),
hashed as (select w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, cast(length(hex(encode(w))) / 2 as bigint) + 1),
    lambda i: cast(('0x' || substr(hex(encode(w)), cast(2 * i - 1 as bigint), 2)) as bigint))),
  lambda c, b: xor(c >> 8, t[cast(xor(c, b) & 255 as bigint) + 1])), 4294967295) % {BUCKETS} as bucket from vocab, crc),
s as (select bucket, count(*) as n from occ join hashed using (w) group by bucket),
t as (select bucket, count(*) as n from tgt join hashed using (w) group by bucket),
gain as (select b.bucket, cast(floor(1000 * ln((coalesce(t.n, 0) + 1)::double * ((select count(*) from occ) + {BUCKETS})::double
   / ((coalesce(s.n, 0) + 1)::double * ((select count(*) from tgt) + {BUCKETS})::double))) as bigint) as g
  from (select unnest(range({BUCKETS})) as bucket) b left join s using (bucket) left join t using (bucket)),
per as (select r, sum(g) as weight from occ join hashed using (w) join gain using (bucket) group by r),
scored as (select doc_id, cast(len(words) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
  cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast(('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8)) as bigint) + 0.5::double)
   / 4294967296))) as bigint) as score from src left join per using (r)),
ranked as (select *, row_number() over (partition by n_features >= {LEAST_WORDS} order by score desc, doc_id) as p from scored)
select doc_id, n_features, weight, score, cast(case when n_features >= {LEAST_WORDS}
  and p <= (select count(*) from scored where n_features >= {LEAST_WORDS}) * {PERCENT} // 100 then p end as bigint) as rank from ranked"""
