"""A17 at size: a stored table that loads add to, without moving stored rows.

The table is bucketed and sorted by a hash of the whole row, so an incoming load
is shuffled to the buckets and joined there, while stored rows are read where
they lie. Each load carries an id; the ids of finished loads are kept beside
the rows, and a load that is repeated inserts nothing. A load that failed half
way may be repeated too: rows it did store are found like any others.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: As many as Spark shuffles to without sorting in the task that writes (200 at most).
BUCKETS = 192
HASH, LOAD = "_row_hash", "_load_id"


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    name: str
    columns: tuple[str, ...]
    buckets: int = BUCKETS

    @property
    def loads_name(self) -> str:
        return f"{self.name}_loads"


def open_store(spark: SparkSession, name: str, schema: T.StructType, folder: str | None = None, buckets: int = BUCKETS) -> Store:
    """The store called ``name``; made empty where it does not exist yet, in
    ``folder`` (by default beside the checkpoints, which all machines share)."""
    held = Store(spark, name, tuple(schema.names), buckets)
    folder = folder or f"{ensure_checkpoint_dir(spark)}/{name}"
    if not spark.catalog.tableExists(name):
        fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
        empty = spark.createDataFrame([], T.StructType([*fields, T.StructField(LOAD, T.StringType()), T.StructField(HASH, T.LongType())]))
        _writer(held, empty).option("path", f"{folder}/rows").saveAsTable(name)
        spark.createDataFrame([], "load_id string").write.option("path", f"{folder}/loads").saveAsTable(held.loads_name)
        return held
    # a table keeps the buckets it was made with
    made = spark.sql(f"describe extended {name}").where("col_name = 'Num Buckets'").first()
    return replace(held, buckets=int(made["data_type"]))


def _writer(held: Store, df: DataFrame):
    return df.write.format("parquet").bucketBy(held.buckets, HASH).sortBy(HASH)


def rows(held: Store, load_id: bool = False) -> DataFrame:
    """The stored rows (with the id of the load that brought each)."""
    more = [F.col(LOAD).alias("load_id")] if load_id else []
    return held.spark.table(held.name).select(*[F.col(f"`{c}`") for c in held.columns], *more)


def loads(held: Store) -> DataFrame:
    """Ids of the finished loads."""
    return held.spark.table(held.loads_name).select("load_id").distinct()


def absent(held: Store, incoming: DataFrame) -> DataFrame:
    """Incoming rows whose whole value is not stored, once each, with their
    hash. Nulls equal nulls. Rows of equal hash are compared whole."""
    columns = [F.col(f"`{c}`") for c in held.columns]
    # each value with its being null, so that the hash tells nulls from blanks and columns from each other
    row_hash = F.xxhash64(*[F.struct(c.isNull(), c) for c in columns])
    # one shuffle, to the buckets; the hash is made again there, so that it does not travel. Equal rows have one
    # hash and so lie in one bucket, where they are one row before anything is sorted
    new = incoming.select(*columns).repartition(held.buckets, row_hash).withColumn(HASH, row_hash).distinct()
    old = held.spark.table(held.name).select(*[c.alias(f"_o{i}") for i, c in enumerate(columns)], F.col(HASH).alias("_oh"))
    # the hash alone is the join key, as it is the bucket key; the values are compared where it is equal
    equal = F.forall(F.array(*[c.eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(columns)]), lambda x: x)
    return new.join(old.hint("merge"), (F.col(HASH) == F.col("_oh")) & equal, "left_anti")


def insert_absent(held: Store, incoming: DataFrame, load_id: str) -> bool:
    """Insert the rows of one load that are not stored yet; False where the
    load was finished before. Loads into one store run one after the other."""
    if not loads(held).where(F.col("load_id") == load_id).isEmpty():
        return False
    new = absent(held, incoming).withColumn(LOAD, F.lit(load_id))
    new = new.select(*[F.col(f"`{c}`") for c in held.columns], LOAD, HASH)
    # by bucket, so that each adds one file to a load
    _writer(held, new.repartition(held.buckets, HASH)).mode("append").saveAsTable(held.name)
    done = held.spark.createDataFrame([(load_id,)], "load_id string")
    done.write.mode("append").saveAsTable(held.loads_name)
    return True
