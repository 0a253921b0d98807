"""Order-document templates (C15): one function per customer layout, all
producing the order-line schema ``Product, Qty, Unit Cost, Ext Cost``.

Input is the extracted-table form of a document layout: one DataFrame per
layout with ``doc_id``, ``row_no``, perhaps ``page_no``, and the layout's text columns
(every document of that layout at once). Column choices that depend on content
(B6, numeric columns) and header names from a first row (B5) are made per table
(document and page) by an aggregate that is joined back; nothing runs at plan time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.rules import ne, truthy
from .. import params as P
from .documents import barcodes_ahead, item_of, table_keys
from .windows import fill_sliced, forward_fill, look_ahead, look_ahead_sliced, sliced, unsliced

LINE = ["Product", "Qty", "Unit Cost", "Ext Cost"]
KEYS = ("doc_id", "row_no")
# F8: a capital letter and a digit somewhere, no dot (item-code column test)
ITEM_LIKE = r"^(?=.*[A-Z])(?=.*\d)(?!.*\.).*$"


def _q(c: str):
    return F.col(f"`{c}`")


def _keys(df: DataFrame) -> list[str]:
    return [*table_keys(df), "row_no"]


def rename_by_position(df: DataFrame, names: list[str], keys=KEYS) -> DataFrame:
    """Name the data columns by position (``df.columns = [...]``)."""
    data = [c for c in df.columns if c not in keys]
    if len(data) != len(names):
        raise ValueError(f"expected {len(names)} data columns, found {len(data)}")
    return df.select(*keys, *[_q(c).alias(n) for c, n in zip(data, names)])


def named_by_first_row(df: DataFrame) -> DataFrame:
    """The first row of a table (document and page) holds its column names:
    the rows below it as (keys, CELLS), CELLS mapping name -> filled cell. Each
    table names its own columns, so the schema is the same for all of them
    (``sinks.widen`` makes columns of the names that occur); a column without a
    name keeps its own, of equal names the leftmost filled cell counts."""
    tables, keys = table_keys(df), _keys(df)
    data = [c for c in df.columns if c not in keys]
    out = _first_rows(df, tables, data).where(F.col("row_no") > F.col("_top"))
    cells = F.filter(F.array(*[F.struct(F.coalesce(F.col(f"_h{i}").cast("string"), F.lit(c)).alias("n"), _q(c).cast("string").alias("c"))
                               for i, c in enumerate(data)]), lambda x: x["c"].isNotNull())
    once = F.filter(cells, lambda x, i: ~F.exists(F.slice(cells, 1, i), lambda y: y["n"] == x["n"]))
    return out.select(*keys, F.map_from_entries(once).alias("CELLS"))


def _per_table(df: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """One-row-per-table ``facts`` put beside every row of their table (null-safe keys)."""
    right = facts.withColumnsRenamed({k: f"_t{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_t{i}"))
    return df.join(right, same, "left").drop(*[f"_t{i}" for i in range(len(keys))])


def choose_column(df: DataFrame, tests: dict, keys: list[str], pick: str = "_pick") -> DataFrame:
    """Adds ``pick`` = name of the first column of ``tests`` (column ->
    aggregate condition) that holds in the row's table; null where none does.
    Each table chooses for itself: one aggregate, no action."""
    if not tests:
        return df.withColumn(pick, F.lit(None).cast("string"))
    flags = df.groupBy(*keys).agg(F.coalesce(*[F.when(t, F.lit(c)) for c, t in tests.items()]).alias(pick))
    return _per_table(df, flags, keys)


def picked(cols: list[str], pick: str = "_pick"):
    """Value of the column that ``pick`` names."""
    return F.coalesce(F.lit(None).cast("string"), *[F.when(F.col(pick) == c, _q(c)) for c in cols])


def _any(cond):
    return F.bool_or(truthy(cond))


def fl2658(df: DataFrame) -> DataFrame:
    """Layout FL2658: of each document and page that fills more than three
    columns, names mapped, Product and Unit Cost required, money text to
    numbers (F6). A column the layout lacks is null."""
    tables, keys = table_keys(df), _keys(df)
    data = [c for c in df.columns if c not in keys]
    width = df.groupBy(*tables).agg(sum((F.max(_q(c).isNotNull()).cast("int") for c in data), F.lit(0)).alias("_wide"))
    out = _per_table(df, width, tables).where(F.col("_wide") > 3).withColumnsRenamed(P.LAYOUT_FL2658)
    out = out.withColumns({c: F.lit(None).cast("string") for c in LINE if c not in out.columns})
    out = out.where(F.col("Product").isNotNull() & _q("Unit Cost").isNotNull())
    return out.select(*keys, "Product", *[S.currency_to_number(_q(c)).alias(c) for c in LINE[1:]])


def pa1683(df: DataFrame) -> DataFrame:
    """Layout PA1683: four named columns by position, '$' and commas off,
    numbers coerced, Product and Qty required."""
    keys = _keys(df)
    out = rename_by_position(df.select(*keys, *[_q(c) for c in P.LAYOUT_PA1683]), LINE, keys)
    out = out.withColumns({"Unit Cost": S.currency_to_number(_q("Unit Cost")),
                           "Ext Cost": S.currency_to_number(_q("Ext Cost"))})
    return out.where(F.col("Product").isNotNull() & F.col("Qty").isNotNull())


def az1239(df: DataFrame) -> DataFrame:
    """Layout AZ1239: names mapped, 'EaOnly' and commas stripped. Each table
    takes its item column by name or else by content (B6 + F8) and its numeric
    columns; three numeric columns are quantity and costs by position (B5),
    otherwise they go by name. A table without an item column gives no rows."""
    tables, keys = table_keys(df), _keys(df)
    out = df.withColumnsRenamed(P.LAYOUT_AZ1239)
    data = [c for c in out.columns if c not in keys]
    out = out.select(*keys, *[F.regexp_replace(_q(c), P.AZ1239_NOISE, "").alias(c) for c in data])
    tests = {"Product": _any(_q("Product").isNotNull())} if "Product" in data else {}
    tests |= {c: _any(_q(c).rlike(ITEM_LIKE)) for c in data if c != "Product"}
    out = choose_column(out, tests, tables)
    numbers = out.groupBy(*tables).agg(F.struct(*[
        _any(S.as_number(_q(c)).isNotNull()).alias(f"n{i}") for i, c in enumerate(data)]).alias("_is"))
    out = _per_table(out, numbers, tables)
    kept = {c: F.col("_is")[f"n{i}"] & ne("_pick", F.lit(c)) for i, c in enumerate(data) if c != "Product"}
    by_position = F.filter(F.array(*[F.struct(ok.alias("ok"), S.as_number(_q(c)).alias("v"))
                                     for c, ok in kept.items()]), lambda x: x["ok"])
    out = out.withColumns({"_item": picked(data), "_nums": by_position})
    line = [F.when(F.size("_nums") == 3, F.get("_nums", F.lit(i))["v"])
            .otherwise(F.when(kept[c], S.as_number(_q(c))) if c in kept else F.lit(None).cast("double")).alias(c)
            for i, c in enumerate(LINE[1:])]
    return out.where(F.col("_item").isNotNull()).select(*keys, F.col("_item").alias("Product"), *line)


def nv0356(df: DataFrame) -> DataFrame:
    """Layout NV0356 (MA0603 from page 2 is the same): per table, the UPC
    column is the one whose first row says 'UPC' (B6), the item column is the
    first of its two names that holds a value; forward fill (W1), item-code
    rows (B14), numbers out of text (F5)."""
    tables, keys = table_keys(df), _keys(df)
    data = [c for c in df.columns if c not in keys]
    out = choose_column(df, {c: truthy(F.min_by(_q(c), "row_no").rlike("^UPC$")) for c in data}, tables)
    names = {v: k for k, v in P.LAYOUT_NV0356.items()}
    items = [c for c in ("Product", names["Product"], P.LAYOUT_NV0356_PRODUCT_ALT) if c in data]
    out = choose_column(out, {c: _any(_q(c).isNotNull()) for c in items}, tables, "_item")
    missing = F.lit(None).cast("string")
    source = {c: next((x for x in (names.get(c), c) if x in data), None) for c in P.LAYOUT_NV0356_COLUMNS}
    cols = {c: missing if x is None else _q(x) for c, x in source.items()}
    cols |= {"Product": picked(items, "_item"),
             "UPC": F.when(F.col("_pick").isNull(), cols["UPC"]).otherwise(picked(data))}
    out = out.select(*keys, *[v.alias(c) for c, v in cols.items()])
    out = forward_fill(out, tables, "row_no", list(cols))
    out = out.where(F.col("Product").isNotNull() & truthy(F.col("Product").rlike(P.STYLE_PATTERN)))
    return out.withColumns({c: S.number_in_text(_q(c)) for c in ("Qty", "Unit Cost", "Ext Cost")})


def ma0603_retail(df: DataFrame) -> DataFrame:
    """Layout MA0603 pages after the first (W3): per table, the column holding
    'UNIT RETAIL' gives Retail from two rows further on (null where no column
    holds it); rows with a barcode kept."""
    tables, keys = table_keys(df), _keys(df)
    desc, marker, barcode = (P.LAYOUT_MA0603[k] for k in ("description", "retail_marker", "barcode"))
    data = [c for c in df.columns if c not in keys]
    out = choose_column(df, {c: _any(_q(c).contains(marker)) for c in data}, tables)
    out = out.withColumn("_retail", picked(data)).withColumnsRenamed({c: desc for c in data if desc in c})
    out = look_ahead(out, tables, "row_no", "_retail", 2, prefix="_R").withColumnRenamed("_R2", "Retail")
    return out.where(_q(barcode).isNotNull()).drop("_R1", "_retail", "_pick")


def _first_rows(df: DataFrame, tables: list[str], data: list[str]) -> DataFrame:
    """Adds each table's first row (``_h0``.. = its cells) and that row's number (``_top``)."""
    heads = df.groupBy(*tables).agg(F.min("row_no").alias("_top"), F.min_by(
        F.struct(*[_q(c).alias(f"_h{i}") for i, c in enumerate(data)]), "row_no").alias("_head"))
    heads = heads.select(*tables, "_top", "_head.*")
    return _per_table(df, heads, tables)


def _named(data: list[str], names: list, wanted):
    """Value of the first column whose header (one name per data column) passes ``wanted``."""
    return F.coalesce(F.lit(None).cast("string"),
                      *[F.when(truthy(wanted(n)), _q(c)) for c, n in zip(data, names)])


def fl4494(df: DataFrame) -> DataFrame:
    """Layout FL4494: a table's headers are its column names (digits, dots and
    slashes off) followed by its first row's texts (B5), read per table. The
    first column is the description: its last word is the item, whose barcode
    follows in the next three rows (W2, F16). Rows that end in an item code are
    lines; numbers by F6. A table whose first header lacks 'Description' gives
    no rows."""
    tables, keys = table_keys(df), _keys(df)
    data = [c for c in df.columns if c not in keys]
    out = _first_rows(df, tables, data)
    names = [F.concat_ws(" ", F.regexp_replace(F.lit(c), P.LAYOUT_FL4494_NOISE, ""), F.col(f"_h{i}"))
             for i, c in enumerate(data)]
    out = out.where((F.col("row_no") > F.col("_top")) & names[0].contains(P.LAYOUT_FL4494_TEXT))
    values = {new: _named(data, names, lambda n, old=old: n == old) for old, new in P.LAYOUT_FL4494.items()}
    out = out.select(*keys, _q(data[0]).alias("Description"), *[v.alias(c) for c, v in values.items()])
    out = barcodes_ahead(out.withColumn("Product", item_of(F.col("Description"))), tables)
    return out.select(*keys, "Description", "Unit Retail", "Product", "UPC",
                      *[S.as_number(_q(c)).alias(c) for c in LINE[1:]])


def ma0603(df: DataFrame) -> DataFrame:
    """Layout MA0603, all pages in one pass: on page 1 the first row holds the
    headers (B5), on later pages the columns are named. Every page becomes
    order lines by the rules of NV0356 (forward fill, item-code rows, numbers
    out of text); Retail stands two rows further on in the column that holds
    'UNIT RETAIL' (W3). Pages without an item column keep the rows with a
    barcode, Product null. Rows without ``page_no`` count as page 1."""
    tables, keys = table_keys(df), _keys(df)
    desc, marker, barcode = (P.LAYOUT_MA0603[k] for k in ("description", "retail_marker", "barcode"))
    data = [c for c in df.columns if c not in keys]
    first_page = F.col("_key")["page_no"].eqNullSafe(F.lit(1)) if "page_no" in keys else F.lit(True)
    rows = sliced(df, tables, "row_no")
    # what a table decides, from its slices: first row, and per column the last rows with the marker and with a value
    facts = rows.groupBy("_key", "_sl").agg(
        F.min("row_no").alias("_top"), F.min_by(F.struct(*[_q(c).alias(f"h{i}") for i, c in enumerate(data)]), "row_no").alias("_head"),
        *[F.max(F.when(_q(c).contains(marker), F.col("row_no"))).alias(f"_m{i}") for i, c in enumerate(data)],
        *[F.max(F.when(_q(c).isNotNull(), F.col("row_no"))).alias(f"_v{i}") for i, c in enumerate(data)])
    table = Window.partitionBy("_key").orderBy("_sl").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = [f"_{x}{i}" for x in "mv" for i in range(len(data))]
    facts = facts.select("_key", "_sl", F.first("_top").over(table).alias("_top"), F.first("_head").over(table).alias("_head"),
                         *[F.max(x).over(table).alias(x) for x in last])
    names = [F.when(first_page, F.col("_head")[f"h{i}"]).otherwise(F.lit(c)) for i, c in enumerate(data)]
    below = {x: F.col(x).isNotNull() & (~first_page | (F.col(x) > F.col("_top"))) for x in last}
    renamed = {new: old for old, new in P.LAYOUT_NV0356.items()}
    item_names = ["Product", *([renamed["Product"]] if "Product" in renamed else []), P.LAYOUT_NV0356_PRODUCT_ALT]
    has_item = F.lit(False)
    for i, n in enumerate(names):
        has_item = has_item | (truthy(n.isin(*item_names)) & below[f"_v{i}"])
    wanted = {c: [c, *([renamed[c]] if c in renamed else [])] for c in P.LAYOUT_NV0356_COLUMNS if c != "UPC"}
    wanted["Product"] = item_names
    wanted["UPC"] = ["UPC", barcode]

    # per table, where each column stands (in the order in which a filled cell counts), so that a row only looks it up
    def places(tests):
        return F.filter(F.array(*[F.when(truthy(t), F.lit(i)) for i, t in enumerate(tests)]), lambda i: i.isNotNull())

    at = {c: F.concat(*[places([n == w for n in names]) for w in ws]) for c, ws in wanted.items()}
    at |= {desc: places([n.contains(desc) for n in names]),
           "_retail": F.slice(places([below[f"_m{i}"] for i in range(len(data))]), 1, 1)}
    facts = facts.select("_key", "_sl", F.struct(*[v.alias(c) for c, v in at.items()]).alias("_at"), has_item.alias("_lines"),
                         F.when(first_page, F.col("_top")).alias("_top"))
    out = rows.join(facts, ["_key", "_sl"]).where(F.col("_top").isNull() | (F.col("row_no") > F.col("_top")))
    out = out.withColumn("_cells", F.array(*[_q(c).cast("string") for c in data]))
    value = {c: F.get(F.filter(F.transform(F.col("_at")[c], lambda i: F.get("_cells", i)), lambda x: x.isNotNull()), F.lit(0))
             for c in at}
    out = out.select("_key", "_sl", "row_no", *[v.alias(c) for c, v in value.items()], "_lines")
    out = look_ahead_sliced(out, "row_no", "_retail", 2, prefix="_R")
    out = out.withColumn("_code", F.col("UPC")).withColumnRenamed("_R2", "Retail")
    out = fill_sliced(out, "row_no", list(P.LAYOUT_NV0356_COLUMNS))
    line = F.col("Product").isNotNull() & truthy(F.col("Product").rlike(P.STYLE_PATTERN))
    out = out.where(F.when(F.col("_lines"), line).otherwise(F.col("_code").isNotNull()))
    return unsliced(out.withColumns({c: S.number_in_text(_q(c)) for c in LINE[1:]}),
                    [*keys, *LINE, "Unit retail", "UPC", desc, "Retail"])


#: Layout code -> function from extracted rows to order lines.
LAYOUTS = {"FL2658": fl2658, "FL4494": fl4494, "MA0603": ma0603, "NV0356": nv0356, "AZ1239": az1239, "PA1683": pa1683}
