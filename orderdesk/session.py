"""Spark session helpers.

The library never creates its own cluster settings inside jobs; this module
is for entry points (bench, tests) and for the two settings jobs rely on:
AQE (coalescing, skew-join splitting, runtime broadcast switch) and a shared
checkpoint folder taken from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCALE_CONF = {
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where the next step must then be shuffled again
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "orderdesk", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "16g")
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (set on the
    context or in the session conf) and is used as is. Only when it is unset
    everywhere (local tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = (sc.getCheckpointDir()
               or sc.getConf().get("spark.checkpoint.dir", None)
               or spark.conf.get("spark.checkpoint.dir", None))
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="orderdesk-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # a core setting on some deployments; the context call below suffices
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: every later use
    sees the same rows, and a lost executor costs a reread. The folder goes
    when the application ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def pieces(spark: SparkSession) -> int:
    """Tasks for grouping rows that hardly repeat: twice the session's shuffle
    partitions, named, so that AQE puts none together. It would by their bytes
    as shuffled, and in the hash tables such rows take ten times as much."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_whole_row(df: DataFrame) -> DataFrame:
    """The rows dealt out by all their columns, equal rows together: grouping
    on all columns needs no further shuffle and holds one piece a task."""
    return df.repartition(pieces(df.sparkSession), *[df[f"`{c}`"] for c in df.columns])
