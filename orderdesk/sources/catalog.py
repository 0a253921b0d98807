"""A1-A3: named queries, ad-hoc SQL and database scans.

The named-query catalogue holds SQL texts over registered views. An item
list is either a small Python list (bound as an array parameter, no SQL text
pasting) or a DataFrame of keys, which becomes a ``left_semi`` join so that
lists of any length stay distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import fresh_key

# name -> (SQL text, column that an item list restricts, or None)
NAMED_QUERIES: dict[str, tuple[str, str | None]] = {
    "shipping": ("select * from v_open_po_lines", None),
    "tracking": ("select * from v_open_po_lines", None),
    "tracking_by_id": ("select * from v_open_po_lines", "SUPPLR"),
    "shipping_by_item": ("select * from v_open_po_lines", "PRODCT"),
    "uprice": ("select * from v_catalog_items", None),
    "vendoritems": ("select * from v_catalog_items", "SUPPLR"),
    "getsupplr": ("select SUPPLR, PRODCT from v_catalog_items", "PRODCT"),
    "inventory": ("select * from v_inventory", "Item"),
    "newbyyear": ("select * from v_new_items", None),
    "getsupplrcontacts": ("select * from v_supplier_contacts", None),
    "gtin": ("select PRODCT, SUPPLR, GTIN, TYPE, GTINDESC, TOTSKUQTY from v_item_gtin where TYPE = 4",
             "PRODCT"),
}


def named_query(spark: SparkSession, name: str, items=None) -> DataFrame:
    """Run a catalogued query; unknown names raise ``KeyError``.

    ``items``: None (whole result), a list of keys (bound parameter), or a
    DataFrame whose first column holds the keys (semi join).
    """
    if name not in NAMED_QUERIES:
        raise KeyError(f"unknown named query: {name}")
    sql, key = NAMED_QUERIES[name]
    if items is None or key is None:
        return spark.sql(sql)
    if isinstance(items, DataFrame):
        keys = items.select(F.col(items.columns[0]).alias("_key")).where(F.col("_key").isNotNull()).distinct()
        if dict(keys.dtypes)["_key"] == "string":  # so that AQE can split a hot key
            keys = fresh_key(keys, "_key")
        base = spark.sql(sql)
        return base.join(keys, base[key] == keys["_key"], "left_semi")
    return spark.sql(f"select * from ({sql}) t where array_contains(:items, t.{key})",
                     args={"items": F.array(*[F.lit(i) for i in items])})


def direct_query(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """A2: ad-hoc SQL with named parameters."""
    return spark.sql(sql, args=args) if args else spark.sql(sql)


def jdbc_scan(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 1,
              properties: dict | None = None) -> DataFrame:
    """A3: parallel database scan split on a numeric column.

    Filters and column choices made on the result are pushed into the
    database query by Spark's JDBC source.
    """
    props = dict(properties or {})
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=partitions, properties=props)
