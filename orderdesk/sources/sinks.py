"""Sinks (A14-A17, A20): CSV reports, one folder per vendor, table replace,
table triage export. Writers run one distributed write each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.documents import drop_null_columns
from ..operators.windows import SLICE_ROWS
from ..params import TRIAGE_MIN_ROWS
from ..session import pieces


def write_csv(df: DataFrame, path: str, order: list[str] | None = None, drop_empty: bool = False) -> None:
    """CSV report with header (sorted by ``order`` within the output);
    ``drop_empty`` leaves out columns without a value (F20)."""
    if drop_empty:
        df = drop_null_columns(df, keep=order or ())
    out = df.orderBy(*order) if order else df
    out.write.mode("overwrite").option("header", True).csv(path)


def per_vendor_layout(df: DataFrame, vendor: str = "SUPPLR", order: list[str] | None = None,
                      slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Rows as the per-vendor writer lays them out: dealt to many tasks by
    vendor, sorted within each task. AQE, which goes by bytes, would leave the
    folders of millions of short rows to one task, so the tasks are named. A
    vendor of more than ``slice_rows`` rows is cut into slices by a hash of the
    row (several files in its folder); the list of those is short, as each
    stands for ``slice_rows`` rows."""
    hot = df.groupBy(F.col(vendor).alias("_v")).agg(F.floor(F.count(F.lit(1)) / slice_rows).alias("_n")).where("_n > 0")
    out = df.join(F.broadcast(hot), F.col(vendor).eqNullSafe(F.col("_v")), "left")
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    out = out.repartition(pieces(df.sparkSession), vendor, F.when(F.col("_n").isNotNull(), F.pmod(row, F.col("_n") + 1)))
    out = out.select(*[F.col(f"`{c}`") for c in df.columns])
    return out.sortWithinPartitions(vendor, *order) if order else out


def write_per_vendor(df: DataFrame, path: str, vendor: str = "SUPPLR", order: list[str] | None = None) -> None:
    """One output folder per vendor in a single job (``partitionBy``);
    rows sorted within each vendor's files. Only the folders of vendors in
    ``df`` are replaced (dynamic partition overwrite): those that earlier runs
    wrote for other vendors stay, and a failed job leaves all as they were."""
    per_vendor_layout(df, vendor, order).write.mode("overwrite").partitionBy(vendor) \
        .option("partitionOverwriteMode", "dynamic").option("header", True).csv(path)


def vendor_partitions(spark: SparkSession, path: str, vendor: str = "SUPPLR") -> DataFrame:
    """The vendors that a per-vendor output already covers, from the names
    of its partition folders; no file is opened. A folder that does not exist
    yet covers nobody; rows without a vendor cover nobody."""
    schema = f"path string, modificationTime timestamp, length bigint, content binary, `{vendor}` string"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], f"`{vendor}` string")
    found = spark.read.schema(schema).format("binaryFile").option("basePath", path).load(path)
    return found.select(vendor).where(F.col(f"`{vendor}`").isNotNull()).distinct()


def widen(df: DataFrame, column: str, prefix: str = "", missing=None, order: DataFrame | None = None) -> DataFrame:
    """A map column as one column per key that really occurs, for a report's
    sink; the keys (a header line) are the only thing that reaches the driver.
    ``order``: (name, pos) where the keys have an order of their own, else they
    are sorted; ``missing`` stands where a row lacks a key."""
    keys = df.select(F.explode(F.map_keys(column)).alias("name")).distinct()
    keys = keys.orderBy("name") if order is None else keys.join(order, "name").orderBy("pos", "name")
    names = [r["name"] for r in keys.collect()]
    value = {n: F.try_element_at(column, F.lit(n)) for n in names}
    if missing is not None:
        value = {n: F.coalesce(v, F.lit(missing)) for n, v in value.items()}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != column],
                     *[v.alias(f"{prefix}{n}") for n, v in value.items()])


def write_replies(parts: DataFrame, path: str) -> None:
    """C5 sink: a folder per sender; its files hold the parts in order, one line
    for each row with the sender's figures. A sender of many parts is written
    by many tasks, each part whole in one file."""
    ranged = parts.repartitionByRange("email", "part").sortWithinPartitions("email", "part")
    ranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("email").json(path)


def first_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """T4: the first rows shown for a look at a result (a display limit, the
    feature itself; Spark keeps only the top ``n`` per task before merging)."""
    return df.orderBy(*order).limit(n)


def replace_table(df: DataFrame, name: str) -> None:
    """Load and replace a managed table."""
    df.write.mode("overwrite").saveAsTable(name)


def append_rows(df: DataFrame, name: str) -> None:
    """A17 sink: append new rows to a stored table (stored rows untouched)."""
    df.write.mode("append").saveAsTable(name)


def triage_tables(spark: SparkSession, names: list[str], out_dir: str,
                  min_rows: int = TRIAGE_MIN_ROWS) -> list[tuple[str, str]]:
    """Export every table with at least ``min_rows`` rows as CSV, with a
    suffix from the first present of TRANSCTN, PRODCT, INVOICE. Returns
    (table, decision). A driver loop over table names is the feature here:
    each table is its own distributed count and write."""
    done = []
    for name in names:
        df = spark.table(name)
        n = df.limit(min_rows).count()  # stops reading once min_rows are seen
        if n < min_rows:
            done.append((name, "skip"))
            continue
        suffix = next((s for c, s in (("TRANSCTN", "_transctn"), ("PRODCT", "_prod"), ("INVOICE", "_invoice"))
                       if c in df.columns), "")
        df.write.mode("overwrite").option("header", True).csv(f"{out_dir}/{name}{suffix}")
        done.append((name, name + suffix))
    return done
