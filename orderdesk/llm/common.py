"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import ensure_checkpoint_dir


#: Input bytes handled at once in a Python worker (one longer text makes a longer slice).
SLICE_BYTES = 2_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation, and
    every later use sees the same rows. The folder is removed when the
    application ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def add_columns(df: DataFrame, fn: Callable[..., Sequence[pa.Array]], inputs: Sequence[str],
                outputs: Sequence[tuple[str, T.DataType]], keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``outputs`` computed batch by batch from the Arrow arrays of ``inputs``.

    ``keep`` names the columns that pass through (all by default); an input
    column named like an output is replaced by it. ``fn`` is built once per
    task and called on slices of about ``SLICE_BYTES`` of each Arrow batch.
    """
    new = [n for n, _ in outputs]
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, t) for n, t in outputs])
    slots = [free_name(df, f"_in{i}") for i in range(len(inputs))]
    narrow = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(s) for c, s in zip(inputs, slots)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = fn()
        for batch in batches:
            step = max(1, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                cols = [part.column(i) for i in range(len(kept))]
                made = call(*[part.column(len(kept) + i) for i in range(len(slots))])
                yield pa.RecordBatch.from_arrays(
                    cols + [m if isinstance(m, pa.Array) else pa.array(m, type=arrow.field(n).type)
                            for m, n in zip(made, new)],
                    names=kept + new)

    return narrow.mapInArrow(run, schema)


def fresh_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The same rows under computed whole-number keys, for the per-key side of a join with rows.

    An aggregate already lies by its key, so such a join would shuffle only the
    rows and could not be split. Under a computed key its few rows are shuffled
    for the join too, and AQE deals a hot key of the other side out to several tasks.
    """
    return df.withColumns({k: F.col(k).bitwiseXOR(F.lit(0)) for k in keys})


def text_of(column: str = "text"):
    """The text, null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(doc_id: str, n: int):
    """crc32(doc_id as text) mod n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def token_bytes(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z in lower case (both are what bytes methods do)."""
    return text.encode("utf-8").lower().split()
