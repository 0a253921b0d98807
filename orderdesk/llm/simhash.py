"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``d`` bits have a middle value within ``d // 2`` bits
of one and ``d - d // 2`` bits of the other. Every fingerprint therefore emits
all its variants within half the radius (rounded up); a variant's *hub* is the
smallest fingerprint within the lower half, and every fingerprint that emits
the variant is paired with the hub, verified bit by bit. That keeps every link
of the components and never pairs the members of a group with each other: a
fingerprint has one row per variant, however large its group is.

Fingerprints without any neighbour emit nothing: a pair within ``d`` bits has
at least four equal blocks of ``d + 4``, so only fingerprints that share four
blocks with another one are expanded (exact, no cap).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, free_name, fresh_keys, materialise, text_of, token_bytes
from .graph import components

CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits over the XXH64 of all word shingles, as a signed 64-bit number; no words: 0."""
    words = token_bytes(text)
    if not words:
        return 0
    buf = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    starts = np.r_[0, ends[:-1]][:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for c in range(0, n, CHUNK):
        h = np.array([digest(buf[a:b], seed) for a, b in zip(starts[c:c + CHUNK], stops[c:c + CHUNK])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, shingle: int = 3, seed: int = 42, keep=None) -> DataFrame:
    """``df`` with ``fp`` long of its ``text`` (null: fingerprint 0)."""

    def build():
        return lambda texts: [[fingerprint(t or "", shingle, seed) for t in texts.to_pylist()]]

    return add_columns(df, build, ["text"], [("fp", T.LongType())], keep)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _literal(value: int) -> str:
    value = _signed(value)
    return f"{value}L" if value > -(1 << 63) else "(-9223372036854775807L - 1L)"


def block_masks(distance: int) -> list[int]:
    """Masks that keep four of ``distance + 4`` blocks of the 64 bits."""
    n = distance + 4
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(blocks, 4)]


def ball(radius: int) -> list[int]:
    """All 64-bit masks with at most ``radius`` bits."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(64), r)]


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b): each distinct ``fp`` with the hubs of its variants, all within ``distance`` bits.

    Any two fingerprints within ``distance`` are joined by these links, directly
    or by a shared hub.
    """
    masks = ", ".join(f"struct({i} as k, fp & {_literal(m)} as v)" for i, m in enumerate(block_masks(distance)))
    keys = fps.select("fp", F.expr(f"inline(array({masks}))"))
    shared = keys.groupBy("k", "v").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select("k", "v")
    suspects = materialise(keys.join(fresh_keys(shared, "k", "v").hint("merge"), ["k", "v"], "left_semi").select("fp").distinct(), "suspects")
    low, high = distance // 2, distance - distance // 2
    spread = suspects.repartition("fp").select(
        "fp", F.explode(F.expr(f"array({', '.join(map(_literal, ball(high)))})")).alias("m"))
    spread = spread.select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("z"), (F.bit_count("m") <= low).alias("near"))
    hubs = spread.where("near").groupBy("z").agg(F.min("fp").alias("hub"))
    # a size estimate does not see the explosion: never broadcast these
    return (spread.hint("merge").join(fresh_keys(hubs, "z").hint("merge"), "z").where("fp <> hub")
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= distance)
            .select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct())


def cluster(df: DataFrame, distance: int = 3) -> DataFrame:
    """``df`` (with ``fp``) plus ``group``: the smallest fingerprint reachable by links of ``distance`` bits."""
    marked = components(links(df.select("fp").distinct(), distance))
    return (df.join(marked.withColumnsRenamed({"node": "fp", "component": "group"}), "fp", "left")
            .withColumn("group", F.coalesce("group", "fp")))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable) for every row.

    Null and empty texts have fingerprint zero and are linked like any other;
    repeated rows each give a row; rows with a null doc_id are linked but never
    name a component unless all its ids are null; an empty table gives an
    empty table.
    """
    prints = fingerprints(docs.select("doc_id", text_of().alias("text")), shingle, keep=["doc_id"])
    prints = materialise(prints, "fingerprints")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    grouped = materialise(cluster(least, distance), "groups")
    names = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    named = grouped.join(names, "group").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one of the smallest doc_id.

    Rows that agree in doc_id and text count once; ties between texts of one
    doc_id go to the smaller text hash; all columns are kept as they are.
    """
    text = text_of()
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("th"))
    prints = materialise(fingerprints(keyed, shingle, keep=["doc_id", "th"]), "fingerprints")
    grouped = cluster(prints.select("fp").distinct(), distance)
    first = prints.join(fresh_keys(grouped, "fp"), "fp").groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("one"))
    own, th = free_name(docs, "_id"), free_name(docs, "_th")
    chosen = first.select(F.col("one.doc_id").alias(own), F.col("one.th").alias(th)).distinct()
    kept = docs.join(chosen, docs["doc_id"].eqNullSafe(F.col(own)) & (F.xxhash64(text) == F.col(th)), "left_semi")
    rest = [c for c in docs.columns if c != "doc_id"]
    one = kept.groupBy("doc_id", F.xxhash64(text).alias("_th")).agg(
        F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_row"))
    return one.select("doc_id", *[F.col("_row")[c].alias(c) for c in rest]).select(*[F.col(f"`{c}`") for c in docs.columns])
