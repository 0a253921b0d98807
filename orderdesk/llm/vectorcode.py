"""Vector code compression: product codes with equal-average nearest-entry search.

Vectors become integers and are cut into equal consecutive parts; each part has
its own codebook, refined by a few rounds of nearest-entry assignment and
componentwise floor means, all in whole numbers, so the result does not depend
on the order of rows or tasks.

The nearest entry is found without trying all: by Cauchy-Schwarz the squared
distance of two parts is at least the squared gap of their component sums over
the dimension. Entries are sorted by sum; from a part's own sum the search goes
outward on both sides and a side ends when that bound strictly exceeds the best
distance so far (strictly, so that equal distances are still seen and the lower
index wins). All vectors of a batch take each step together.

A round sends one row per task, part and entry to the shuffle and one codebook
(parts x entries) to the driver; vectors never move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import fresh_key
from .common import add_columns, free_name, materialise

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: A component of which the integer passes this over the width of a part would not fit the sums of squares in 64 bits.
LARGEST = 1 << 28
BATCH = 8192


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each row (ties to the lower index)."""
    n, dim = parts.shape
    order = np.argsort(entries.sum(axis=1), kind="stable")
    book = entries[order]
    sums = book.sum(axis=1)
    own = parts.sum(axis=1)
    best, where = np.full(n, np.iinfo(np.int64).max), np.full(n, len(entries), dtype=np.int64)
    right = np.searchsorted(sums, own)
    sides = [(np.arange(n), right - 1, -1), (np.arange(n), right, 1)]
    while sides:
        left = []
        for rows, at, way in sides:
            inside = (at >= 0) & (at < len(sums))
            rows, at = rows[inside], at[inside]
            gap = sums[at] - own[rows]
            # gap * gap / dim > best, in whole numbers
            open_ = -(-(gap * gap) // dim) <= best[rows]
            rows, at = rows[open_], at[open_]
            if not len(rows):
                continue
            far = parts[rows] - book[at]
            far = np.einsum("ij,ij->i", far, far)
            index = order[at]
            better = (far < best[rows]) | ((far == best[rows]) & (index < where[rows]))
            best[rows[better]], where[rows[better]] = far[better], index[better]
            left.append((rows, at + way, way))
        sides = left
    return where, best


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry index of each part of each vector, and the squared distances summed over the parts."""
    parts = len(books)
    cut = x.reshape(len(x), parts, -1)
    codes, error = np.zeros((len(x), parts), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    for s in range(0, len(x), BATCH):
        for p in range(parts):
            codes[s:s + BATCH, p], far = nearest(cut[s:s + BATCH, p], books[p])
            error[s:s + BATCH] += far
    return codes, error


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), dim)


def _sums(rows: DataFrame, books: np.ndarray, dim: int) -> DataFrame:
    """Per part and entry: how many parts it is nearest to, and their sum."""
    parts, entries = books.shape[:2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, dim // parts), dtype=np.int64)
        count = np.zeros(parts * entries, dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            slot = assign(x, books)[0] + np.arange(parts) * entries
            np.add.at(total, slot.ravel(), x.reshape(-1, dim // parts))
            count += np.bincount(slot.ravel(), minlength=len(count))
        hit = np.flatnonzero(count)
        at, axis = np.repeat(hit, dim // parts), np.tile(np.arange(dim // parts), len(hit))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(axis), pa.array(count[at]), pa.array(total[at, axis])],
                                         names=["slot", "axis", "n", "total"])

    made = rows.select("ints").mapInArrow(run, "slot long, axis long, n long, total long")
    return made.groupBy("slot", "axis").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def refine(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; entries nearest to nothing stay."""
    parts, entries, width = books.shape
    out = books.reshape(parts * entries, width).copy()
    for r in _sums(rows, books, parts * width).collect():  # parts x entries x width rows at most
        out[r["slot"], r["axis"]] = r["total"] // r["n"]
    return out.reshape(books.shape)


def integers(embedding: str, parts: int, scale: int):
    """floor(scale * x) of every component as an array of long; null where the vector is not usable."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    whole = F.transform(v, lambda e: F.floor(e * F.lit(float(scale))))
    most = F.lit(float(LARGEST) * parts / scale) / F.size(v)
    sound = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < most))
    return F.when((F.size(v) > 0) & F.coalesce(sound, F.lit(False)), whole.cast("array<long>"))


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error, codebooks_sha256.

    Dropped are vectors that are null, hold a null or non-finite component (or
    one beyond ``LARGEST`` over the part's width after scaling), or whose length differs from that of
    the kept vector with the smallest id or is no positive multiple of
    ``parts``. Codebooks start from the ``entries`` smallest ids (null ids
    last; equal ids by components); with fewer vectors they are shorter.
    Repeated rows count as vectors each; null labels are one group; no kept
    vector gives an empty table. A label whose sum passes 64 bits has a null
    label_error. ``entries`` is at most 256 (two hex digits).
    """
    if entries > 256:
        raise ValueError("entries: at most 256")
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"),
                     integers(embedding, parts, scale).alias("ints"))
    rows = rows.where((F.size("ints") > 0) & (F.size("ints") % parts == 0))
    order = [F.asc_nulls_last("vec_id"), "ints"]
    lead = rows.orderBy(*order).limit(1).collect()
    if not lead:
        return df.sparkSession.createDataFrame([], schema)
    dim = len(lead[0]["ints"])
    rows = rows.where(F.size("ints") == dim)
    first = np.array([r["ints"] for r in rows.orderBy(*order).limit(entries).collect()], dtype=np.int64)
    books = np.ascontiguousarray(first.reshape(len(first), parts, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        books = refine(rows, books)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

    def build():
        def call(ints):
            codes, error = assign(_matrix(ints, dim), books)
            text = codes.astype(np.uint8).tobytes().hex()
            return [[text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)], error]
        return call

    coded = materialise(add_columns(rows, build, ["ints"], [("code", T.StringType()), ("error", T.LongType())],
                                    keep=["vec_id", "label"]), "codes")
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    coded = coded.withColumn("_label", key)
    per = coded.groupBy("_label").agg(F.try_sum("error").alias("label_error"))
    out = coded.join(fresh_key(per, "_label"), "_label")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle() -> str:
    """The contract of op12 in DuckDB SQL: every entry tried for every part."""
    far = "list_sum(list_transform(list_zip(x, b), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"near{r} as (select vec_id, p, any_value(x) as x, min(struct_pack(d := {far}, e := e)) as best "
                     f"from part join book{r} using (p) group by vec_id, p)")
        if r < ROUNDS:
            steps.append(f"mean{r} as (select p, e, list(m order by i) as b from (select p, best.e as e, i, "
                         f"cast(floor(sum(x[i])::double / count(*)) as bigint) as m from near{r}, (select unnest(range(1, 1 + (select len(x) from part limit 1))) as i) "
                         f"group by p, best.e, i) group by p, e)")
            steps.append(f"book{r + 1} as (select p, e, coalesce(m.b, o.b) as b from book{r} o left join mean{r} m using (p, e))")
    return f"""with kept as (select vec_id, label, list_transform(embedding, lambda x: cast(floor({SCALE} * x::double) as bigint)) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
part as (select vec_id, label, p, list_slice(v, p * len(v) // {PARTS} + 1, (p + 1) * len(v) // {PARTS}) as x
  from kept, (select unnest(range({PARTS})) as p)),
book0 as (select p, e, x as b from (select p, x, row_number() over (partition by p order by vec_id) - 1 as e from part) where e < {ENTRIES}),
{', '.join(steps)},
coded as (select vec_id, string_agg(printf('%02x', best.e), '' order by p) as code, cast(sum(best.d) as bigint) as error
  from near{ROUNDS} group by vec_id),
digest as (select sha256(string_agg(array_to_string(b, ','), ',' order by p, e)) as h from book{ROUNDS})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, h as codebooks_sha256
from coded join kept using (vec_id), digest"""


ORACLE = _oracle()
