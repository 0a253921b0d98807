"""Order documents of many layouts -> one order-line schema (C15, C16, A10,
W1-W3, W6, B13, B14, F5-F9, F16, F20).

Documents arrive as long tables: one row per extracted table row with
``doc_id`` and a dense ``row_no``. Row-order rules (forward fill, look-ahead)
use the slice-and-stitch helpers of ``windows`` so that one huge document
is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.rules import truthy
from ..params import (DIGITS_PATTERN, ITEM_CODE_PATTERN, MEMO_STOP_PHRASES, NUMBER_PATTERN,
                      PRODUCT_TAIL_PATTERN, STYLE_PATTERN, UPC_PATTERN)
from .windows import forward_fill, look_ahead


def table_keys(rows: DataFrame) -> list[str]:
    """Extracted rows form one table per document, or per (document, page)
    where they carry ``page_no``."""
    return ["doc_id", "page_no"] if "page_no" in rows.columns else ["doc_id"]


def drop_null_columns(df: DataFrame, keep=()) -> DataFrame:
    """drop columns that are null in every row. Which they are depends on
    the data, so this is a step of the sink (``sinks.write_csv``): one aggregate
    row is read before the write."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first().asDict()
    return df.select(*[c for c in df.columns if counts[c] > 0 or c in keep])


def extracted_scan(rows: DataFrame, product: str = "style", drop_empty: bool = False) -> DataFrame:
    """A10: extracted rows as order rows: Product required, null Product dropped;
    empty columns go at the sink, or here (an action) with ``drop_empty``."""
    out = rows.withColumnRenamed(product, "Product")
    if drop_empty:
        out = drop_null_columns(out, keep=("Product",))
    return out.where(F.col("Product").isNotNull())


def fill_down(rows: DataFrame, cols=("style", "qty_text", "ext_text", "upc_text"),
              doc: str | list[str] | None = None, row_no: str = "row_no") -> DataFrame:
    """Forward fill of the given columns within each table (``doc``; by
    default the document and, where the rows carry one, the page)."""
    return forward_fill(rows, doc or table_keys(rows), row_no, list(cols))


def style_rows(filled: DataFrame, col: str = "style") -> DataFrame:
    """B13 + B14: rows whose style is a bare item code (1-9 capitals/digits)."""
    return filled.where(F.col(col).isNotNull() & truthy(F.col(col).rlike(STYLE_PATTERN)))


def clean_numbers(rows: DataFrame) -> DataFrame:
    """F5 + F6: numbers out of quantity / money / barcode text."""
    return rows.select("doc_id", "row_no",
                       S.number_in_text("qty_text").alias("QTY"),
                       S.currency_to_number("ext_text").alias("EXT"),
                       S.number_in_text("ext_text").alias("EXT_NUM"),
                       F.regexp_extract("upc_text", DIGITS_PATTERN, 1).alias("UPC_DIGITS"))


def order_lines_ffill(rows: DataFrame) -> DataFrame:
    """C15 (layout NV0356): fill down, keep item-code rows, extract numbers."""
    lines = style_rows(fill_down(rows))
    return lines.select("doc_id", "row_no", F.col("style").alias("Product"),
                        S.number_in_text("qty_text", NUMBER_PATTERN).alias("Qty"),
                        S.number_in_text("ext_text", NUMBER_PATTERN).alias("Ext_Cost"),
                        F.col("upc_text").alias("UPC"))


def item_of(text):
    """Last word of a description without '-'."""
    return F.replace(S.last_word(text), F.lit("-"), F.lit(""))


def barcodes_ahead(rows: DataFrame, tables: list[str]) -> DataFrame:
    """UPC1..3 = digits of the next three rows' Product, UPC = the longest of
    them (first wins ties); rows whose Product ends in an item code only."""
    ahead = look_ahead(rows, tables, "row_no", "Product", 3, prefix="_N")
    digits = {f"UPC{k}": F.coalesce(F.regexp_extract(f"_N{k}", DIGITS_PATTERN, 1), F.lit(""))
              for k in (1, 2, 3)}
    out = ahead.withColumns(digits).withColumn("UPC", S.longest(["UPC1", "UPC2", "UPC3"]))
    return out.where(truthy(F.col("Product").rlike(PRODUCT_TAIL_PATTERN))).drop("_N1", "_N2", "_N3")


def lookahead_upc(rows: DataFrame, text: str = "style") -> DataFrame:
    """C15 (layout FL4494), W2 + F3 + F16: Product = last word of the text
    without '-'; UPC1..3 = digits of the next three rows' Product; UPC = the
    longest of them (first wins ties); rows ending in an item code only."""
    base = rows.withColumn("Product", item_of(F.col(text)))
    out = barcodes_ahead(base, table_keys(rows))
    return out.select("doc_id", "row_no", "Product", "UPC1", "UPC2", "UPC3", "UPC")


def longest_upc(rows: DataFrame, text: str = "upc_text") -> DataFrame:
    """F16: first barcode match and longest text over the next three rows."""
    ahead = look_ahead(rows, table_keys(rows), "row_no", text, 3, prefix="_U")
    cols = ["_U1", "_U2", "_U3"]
    return ahead.select("doc_id", "row_no",
                        S.first_match(cols, UPC_PATTERN).alias("FIRST_UPC"),
                        S.longest([F.coalesce(F.col(c), F.lit("")) for c in cols]).alias("LONGEST_UPC"))


def memo_items(lines: DataFrame, memo: str = "memo_id", line_no: str = "line_no",
               text: str = "text", stops=MEMO_STOP_PHRASES) -> DataFrame:
    """C16 (W6 + F7): item codes of each memo's lines before the first stop
    phrase. The first stop line is a per-memo aggregate joined back (no
    window over a whole memo)."""
    is_stop = None
    for ph in stops:
        c = F.col(text).contains(ph)
        is_stop = c if is_stop is None else (is_stop | c)
    stop_at = lines.groupBy(memo).agg(F.min(F.when(truthy(is_stop), F.col(line_no))).alias("_stop"))
    kept = lines.join(stop_at, memo, "left").where(
        F.col("_stop").isNull() | (F.col(line_no) < F.col("_stop")))
    return kept.select(memo, line_no, F.explode(S.item_codes(text, ITEM_CODE_PATTERN)).alias("item"))
