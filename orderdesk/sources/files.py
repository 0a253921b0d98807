"""File sources.

Sheets and order documents arrive as CSV exports or SpreadsheetML. Files are
cut into pieces at line (or row) ends and read by many tasks, however large one
file is; a line's place is the start of its piece (``file_block_start``) and
its position in the read, so rows keep the order of the file. Each row is an
array of cells; every rule after that (header per file, renames, filters)
takes cells by the file's own header, without moving the rows: only headers
and per-piece counts are joined. Nothing loops over files on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.rules import ne, truthy
from ..params import OFFICE_DROP, OFFICE_RENAMES, SHEET_TEMPLATES
from ..operators.templates import LAYOUTS
from .sinks import widen

CONFIRMATION_GLOB = "[oO]rder_[cC]onfirmation_[pP]*"
CONFIRMATION_COLS = ["Product", "Description", "Ordered", "B/O'd", "To Ship", "Price", "Expected Date"]
CONFIRMATION_TYPES = {"Ordered": "int", "B/O'd": "int", "To Ship": "int", "Price": "double"}

ORDER_LINE = ["Product", "Qty", "Unit Cost", "Ext Cost"]
# Confirmation headers that stand for order-line columns.
CONFIRMATION_LINE = {"Ordered": "Qty", "Quantity": "Qty", "Price": "Unit Cost"}

#: One CSV cell: quoted from its first character (doubled quotes, commas and line
#: breaks inside), else up to the next comma; a quote that is never closed or
#: stands inside a cell is plain text. Possessive: no backtracking.
QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
OPEN = r'"[^"]*+(?:""[^"]*+)*+$'
CELL_IN_LINE = rf"({QUOTED}[^,]*+|[^,]*+)(?:,|\z)"
#: A line that ends inside a quoted cell: begun outside of one, and begun inside.
OPENS = rf'^(?:(?:{QUOTED}[^,]*+|(?!")[^,]*+),)*+{OPEN}'
STAYS = rf'^[^"]*+(?:""[^"]*+)*+(?:$|"[^,]*+,(?:(?:{QUOTED}[^,]*+|(?!")[^,]*+),)*+{OPEN})'


def _decoded(c: Column) -> Column:
    """File names in ``_metadata`` are URI-encoded; a literal '+' is kept."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def _pieces(spark: SparkSession, path: str, glob: str | None, deep: bool, end: str) -> DataFrame:
    """(file, file_name, _block, _at, line): text between two ``end`` marks.
    Within a file, order is by piece, then by position in the read; the same
    files are cut in the same way whenever the table is computed."""
    reader = spark.read.option("recursiveFileLookup", str(deep).lower()).option("lineSep", end)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        _decoded(F.col("_metadata.file_path")).alias("file"), _decoded(F.col("_metadata.file_name")).alias("file_name"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("line"))


def _place(df: DataFrame, *more: Column) -> DataFrame:
    """One row per piece of a file: number of the file's lines before it
    (``_first``), position of its first line (``_lo``); ``more``: further
    aggregates. Positions of a piece's lines follow one another."""
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    per = df.groupBy("file", "_block").agg(F.min("_at").alias("_lo"), F.count(F.lit(1)).alias("_n"), *more)
    return per.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def read_lines(spark: SparkSession, path: str, glob: str | None = None, deep: bool = False) -> DataFrame:
    r"""(file, file_name, line_no, line): every record of every file, numbered
    from 0; lines end with \n or \r\n. A line break inside a quoted cell
    belongs to its record. A file without such cells takes no shuffle of its
    lines: their numbers come from the counts of the pieces before."""
    raw = _pieces(spark, path, glob, deep, "\n")
    raw = raw.withColumn("line", F.when(F.startswith("line", F.lit("\ufeff")), F.substr("line", F.lit(2))).otherwise(F.col("line")))
    flat = F.regexp_replace("line", r"\r$", "")
    whole = Window.partitionBy("file")
    pieces = _place(raw, F.bool_or(flat.rlike(OPENS)).alias("_open")).withColumn("_open", F.bool_or("_open").over(whole))
    lines = raw.join(pieces.where(~F.col("_open")).select("file", "_block", "_lo", "_first"), ["file", "_block"])
    plain = lines.select("file", "file_name", (F.col("_first") + F.col("_at") - F.col("_lo")).alias("line_no"), flat.alias("line"))
    broken = raw.join(pieces.where("_open").select("file", "_block"), ["file", "_block"])
    return plain.unionByName(_joined_lines(broken))


def _joined_lines(raw: DataFrame) -> DataFrame:
    """Records of files that hold line breaks in quoted cells.

    Every line maps "inside a quoted cell at its start" to the same at its end;
    the map keeps, flips or fixes that state. Running counts of the flips since
    the last fixing line give the state of each line, within pieces first and
    then across them. A quote that the file never closes is plain text.
    """
    flat = F.regexp_replace("line", r"\r$", "")
    piece = Window.partitionBy("file", "_block").orderBy("_at")
    upto = piece.rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    also = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    out, inside = flat.rlike(OPENS).cast("int"), flat.rlike(STAYS).cast("int")
    d = raw.withColumns({"_o": out, "_i": inside})
    d = d.withColumn("_flips", F.sum(F.when((F.col("_o") == 1) & (F.col("_i") == 0), 1).otherwise(0)).over(upto))
    fixed = F.when(F.col("_o") == F.col("_i"), F.pmod(F.col("_o") + F.col("_flips"), F.lit(2)))
    d = d.withColumn("_fix", F.last(fixed, ignorenulls=True).over(upto))

    # the same composition over whole pieces: the state at the start of each, and at the end of the file
    ends = d.groupBy("file", "_block").agg(F.max_by("_flips", "_at").alias("_pf"), F.max_by("_fix", "_at").alias("_px"))
    ends = ends.withColumn("_run", F.sum("_pf").over(also))
    ends = ends.withColumn("_gx", F.when(F.col("_px").isNotNull(), F.pmod(F.col("_px") + F.col("_pf") + F.col("_run"), F.lit(2))))

    def state(win, run):
        return F.pmod(F.coalesce(F.last("_gx", ignorenulls=True).over(win), F.lit(0)) + run, F.lit(2))

    ends = ends.withColumns({"_in": state(earlier, F.col("_run") - F.col("_pf")), "_end": state(also, F.col("_run"))})
    ends = ends.withColumn("_end", F.last("_end").over(Window.partitionBy("file").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))).select("file", "_block", "_in", "_end")
    d = d.join(ends, ["file", "_block"])
    flips, fix = F.coalesce(F.lag("_flips").over(piece), F.lit(0)), F.lag("_fix").over(piece)
    d = d.withColumn("_start", F.pmod(F.coalesce(fix, F.col("_in")) + flips, F.lit(2)) == 0)
    last = d.where("_start").groupBy("file").agg(F.max(F.struct("_block", "_at")).alias("_last"))
    d = d.join(last, "file").withColumn(
        "_start", F.col("_start") | ((F.col("_end") == 1) & (F.struct("_block", "_at") > F.col("_last"))))
    d = d.withColumn("_run", F.count_if("_start").over(upto))
    before = d.groupBy("file", "_block").agg(F.count_if("_start").alias("_c"))
    before = before.withColumn("_first", F.coalesce(F.sum("_c").over(earlier), F.lit(0))).drop("_c")
    d = d.join(before, ["file", "_block"]).withColumn("line_no", F.col("_first") + F.col("_run") - 1)
    parts = F.array_sort(F.collect_list(F.struct("_block", "_at", "line")))
    got = d.groupBy("file", "file_name", "line_no").agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("line"))
    return got.withColumn("line", F.regexp_replace("line", r"\r$", ""))


def _unquoted(cell: Column) -> Column:
    """A quoted cell without its quotes, doubled quotes single."""
    parts = rf"(?s)^({QUOTED})(.*)$"
    inner = F.regexp_extract(cell, parts, 1)
    text = F.concat(F.replace(F.substr(inner, F.lit(2), F.length(inner) - 2),
                              F.lit('""'), F.lit('"')), F.regexp_extract(cell, parts, 2))
    return F.when(F.startswith(cell, F.lit('"')) & cell.rlike(parts), text).otherwise(cell)


def split_cells(lines: DataFrame) -> DataFrame:
    """(file, file_name, line_no, cells): CSV cells in order (quotes honoured,
    any number of columns)."""
    cells = F.transform(F.regexp_extract_all("line", F.lit(CELL_IN_LINE), F.lit(1)), _unquoted)
    return lines.select("file", "file_name", "line_no", cells.alias("cells"))


def filled(cell: Column) -> Column:
    """A cell's text; blank is null."""
    return F.when(F.trim(cell) != "", cell)


def with_header(rows: DataFrame, header: DataFrame | int, name=None) -> DataFrame:
    """The rows below each file's header line, with ``names``: the trimmed
    header texts by column (``name`` maps each, leaving null those to skip).

    ``header``: the number of the header line, the same in every file, or
    (file, header_no, further columns for ``name``). Headers are one row per
    file; the rows stay where they are unless that table is too large to send.
    """
    if isinstance(header, int):
        header_no = F.lit(header)
    else:
        rows, header_no = rows.join(header, "file"), F.col("header_no")
    titles = F.transform("cells", lambda c: F.trim(c))
    if name is not None:
        titles = F.transform(titles, name)
    heads = rows.where(F.col("line_no") == header_no).select(F.col("file").alias("_file"), titles.alias("names"))
    body = rows.where(F.col("line_no") > header_no)
    return body.join(heads, body["file"] == heads["_file"]).drop("_file")


def cell_of(name: str) -> Column:
    """The row's first filled cell under the header ``name``."""
    hit = F.filter(F.zip_with("names", "cells", lambda n, c: F.when(n == F.lit(name), filled(c))), lambda x: x.isNotNull())
    return F.get(hit, F.lit(0))


def renamed(renames: dict):
    """Header texts by an exact map."""
    return (lambda n: S.replace_values(n, list(renames.items()))) if renames else None


def table_after_header(rows: DataFrame, header: DataFrame | int, names: list[str], name=None) -> DataFrame:
    """Rows below each file's header line with the wanted ``names`` as columns
    (fixed schema, no extra job). Of several headers with one name the leftmost
    filled cell counts; a row without any of the names is left out."""
    wide = with_header(rows, header, name).select(
        "file", "file_name", F.col("line_no").alias("row_no"), *[cell_of(n).alias(n) for n in names])
    return wide.where(F.coalesce(*[F.col(f"`{n}`") for n in names]).isNotNull())


def find_header(rows: DataFrame, marker: str, column: int = 0) -> DataFrame:
    """Per file, the first line whose ``column`` cell contains ``marker``;
    the header is the next line (data start after it)."""
    hit = rows.where(truthy(F.get("cells", F.lit(column)).contains(marker)))
    return hit.groupBy("file").agg((F.min("line_no") + 1).alias("header_no"))


# --- confirmations and customer orders -------------------------------------

def read_confirmations(spark: SparkSession, path: str, glob: str | None = None,
                       extra: list[str] | None = None) -> DataFrame:
    """Order confirmation CSV, columns taken by each file's own header
    (any order; ``extra`` names further ones), numbers cast, rows without
    Product dropped."""
    rows = split_cells(read_lines(spark, path, glob))
    df = table_after_header(rows, 0, CONFIRMATION_COLS + list(extra or []))
    df = df.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in CONFIRMATION_TYPES.items()})
    return df.where(F.col("Product").isNotNull())


def read_customer_csv(spark: SparkSession, path: str) -> DataFrame:
    """Customer order CSV; the four order-line columns, by each file's own
    header (any order). A line without any of the four gives no row."""
    df = table_after_header(split_cells(read_lines(spark, path)), 0, ORDER_LINE)
    return df.select("Product", F.col("Qty").try_cast("int").alias("Qty"),
                     F.col("Unit Cost").try_cast("double").alias("Unit Cost"),
                     F.col("Ext Cost").try_cast("double").alias("Ext Cost"))


def read_xml_rows(spark: SparkSession, path: str, glob: str | None = None, deep: bool = False) -> DataFrame:
    """(file, file_name, line_no, cells): the rows of SpreadsheetML files, first
    worksheet only, an empty Cell null.

    A file is cut behind each ``</Row>`` and read by many tasks; each piece of
    text then holds one row, parsed by ``from_xml``. Rows without any cell tag
    (``<Row/>``) are left out and not counted.
    """
    raw = _pieces(spark, path, glob, deep, "</Row>")
    pieces = _place(raw)
    rows = raw.join(pieces.select("file", "_block", "_lo", "_first"), ["file", "_block"]).withColumn(
        "line_no", F.col("_first") + F.col("_at") - F.col("_lo"))
    # the text before a row may end a worksheet: that row and all after it belong to others
    closed = rows.where(F.contains("line", F.lit("</Worksheet>"))).groupBy("file").agg(F.min("line_no").alias("_until"))
    bare = F.regexp_replace("line", r"<Row(?:\s[^>]*)?/>", "")
    row = F.from_xml(F.concat(F.regexp_extract(bare, r"(?s)(<Row(?:\s[^>]*)?>.*)$", 1), F.lit("</Row>")),
                     F.lit("Cell array<struct<Data: string>>"), {"rowTag": "Row"})
    rows = rows.where(bare.rlike(r"<Row[\s>]")).join(closed, "file", "left").where(
        F.col("_until").isNull() | (F.col("line_no") < F.col("_until")))
    return rows.select("file", "file_name", "line_no", F.transform(row["Cell"], lambda c: c["Data"]).alias("cells"))


def read_spreadsheet_xml(spark: SparkSession, path: str) -> DataFrame:
    """SpreadsheetML confirmation: first Row = headers, an empty Cell is
    null, rows without Product dropped, seven columns."""
    out = table_after_header(read_xml_rows(spark, path), 0, CONFIRMATION_COLS)
    return out.where(F.col("Product").isNotNull()).select("file", *[F.col(f"`{c}`") for c in CONFIRMATION_COLS])


def read_template_sheet(spark: SparkSession, path: str, template: str, names: list[str]) -> DataFrame:
    """A8 + B15 + F9: customer sheet export with the customer's rows to skip
    and header renames; Product required; FL4494 gets the UPC out of its
    description; SALEREP drops completed rows (null Completed kept)."""
    skip, renames = SHEET_TEMPLATES[template]
    out = table_after_header(split_cells(read_lines(spark, path)), skip, names, renamed(renames))
    out = out.where(F.col("Product").isNotNull())
    if template == "FL4494":
        out = out.withColumn("UPC", S.upc_word("Description"))
    if template == "SALEREP":
        out = out.where(ne(F.col("Completed").try_cast("double"), F.lit(1.0)))
    return out


def header_rules(n: Column, year: int) -> Column:
    """Canonical names from header content (item / year price / minimum);
    when several rules match, the minimum wins over the price, the price over
    the item (the order in which the renames are applied)."""
    return (F.when(n.contains("MIN"), "MOQ")
            .when(n.contains(str(year)), "NEW_COST")
            .when(n.contains("Item") | n.contains("ITEM"), "PRODCT").otherwise(n))


def read_quote_sheets(spark: SparkSession, folder: str, year: int = 2025, skip: int = 3,
                      glob: str | None = None) -> DataFrame:
    """A13 + B4: every returned price sheet of a folder at once; the vendor
    code is the fourth word of the file name; headers normalised per file."""
    rows = split_cells(read_lines(spark, folder, glob))
    wide = table_after_header(rows, skip, ["PRODCT", "NEW_COST", "MOQ"], lambda n: header_rules(n, year))
    vendor = F.try_element_at(F.split(F.element_at(F.split("file_name", r"\."), 1), " "), F.lit(4))
    return wide.select(vendor.alias("SUPPLR"), "PRODCT",
                       F.regexp_replace("NEW_COST", r"[$,]", "").try_cast("decimal(18,6)").alias("NEW_COST"),
                       F.col("MOQ").try_cast("int").alias("MOQ"), "row_no").where(F.col("PRODCT").isNotNull())


def office_rows(spark: SparkSession, path: str, marker: str, new_year: int = 2025, old_year: int = 2024) -> DataFrame:
    """C14: office price sheets in a schema of their own, whatever headers the
    files have: SUPPLR, file, file_name, line_no, CHANGE (fraction), names
    (the file's headers) and CELLS (header -> filled cell).

    Header after the marker line (W7), year columns renamed (the first header
    that holds a year is that year's cost, per file), the pack column dropped,
    blank runs in dimensions collapsed with a break before 'CTN'.
    """
    rows = split_cells(read_lines(spark, path))
    body = with_header(rows, find_header(rows, marker))
    for year in (new_year, old_year):
        first = F.get(F.filter("names", lambda n: n.contains(str(year))), F.lit(0))
        at = F.array_position("names", first)
        body = body.withColumn(f"_{year}", at)
    new_c, old_c = f"{new_year} COST", f"{old_year} COST"

    def title(n, i):
        plain = S.replace_values(F.when(n == f"{old_year} PURCH", "PURCH").otherwise(n), list(OFFICE_RENAMES.items()))
        return F.when(i + 1 == F.col(f"_{new_year}"), new_c).when(i + 1 == F.col(f"_{old_year}"), old_c).otherwise(plain)

    body = body.withColumn("names", F.transform("names", title))
    pairs = F.filter(F.zip_with("names", "cells", lambda n, c: F.struct(n.alias("n"), filled(c).alias("c"))),
                     lambda p: p["n"].isNotNull() & p["c"].isNotNull() & (p["n"] != "") & (p["n"] != OFFICE_DROP))
    pairs = F.transform(pairs, lambda p: F.struct(p["n"].alias("n"), F.when(
        p["n"] == "DIMENSIONS (INCHES)", S.break_before(S.collapse_blanks(p["c"]), "CTN")).otherwise(p["c"]).alias("c")))
    # of headers with one name the leftmost filled cell counts
    once = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, 1, i), lambda q: q["n"] == p["n"]))
    vendor = F.element_at(F.split(F.element_at(F.split("file_name", r"\."), 1), " "), -1)
    out = body.select(vendor.alias("SUPPLR"), "file", "file_name", "line_no", "names", F.map_from_entries(once).alias("CELLS"))
    cost = {c: F.try_element_at("CELLS", F.lit(c)).try_cast("double") for c in (new_c, old_c)}
    return out.where(F.size("CELLS") > 0).withColumn("CHANGE", F.try_divide(cost[new_c], cost[old_c]) - 1)


def office_sheet(spark: SparkSession, path: str, marker: str, new_year: int = 2025,
                 old_year: int = 2024) -> DataFrame:
    """C14 as the sheet is written: ``office_rows`` widened at the sink to the
    headers that hold a value anywhere (F20), in the sheet's order: first
    column, photo, three columns, change, the rest."""
    rows = office_rows(spark, path, marker, new_year, old_year)
    order = rows.select("names").distinct().select(F.posexplode("names").alias("pos", "name")).groupBy("name").agg(F.min("pos").alias("pos"))
    lead = ["SUPPLR", "file", "file_name", "line_no"]
    wide = widen(rows.drop("names"), "CELLS", order=order)
    names = [c for c in wide.columns if c not in (*lead, "CHANGE")]
    both = {f"{new_year} COST", f"{old_year} COST"} <= set(names)
    wide = wide.withColumnRenamed("CHANGE", "% Change").withColumn("Photo", F.lit(""))
    sheet = [*names[:1], "Photo", *names[1:4], *(["% Change"] if both else []), *names[4:]]
    return wide.select(*lead, *[F.col(f"`{c}`") for c in sheet])


def landed_report(spark: SparkSession, path: str, catalog_items: DataFrame, skip: int = 1) -> DataFrame:
    """Landed-cost report: PRODCT from its left neighbour when empty,
    first word, header repeats and 'OV0001' dropped, then restricted to the
    catalogue (J12) as (SUPPLR, PRODCT)."""
    body = with_header(split_cells(read_lines(spark, path)), skip)
    at = F.array_position("names", F.lit("PRODCT")).cast("int")
    own, left = F.get("cells", at - 1), F.when(at > 1, F.get("cells", at - 2))
    item = S.first_word(F.coalesce(filled(own), filled(left)))
    items = body.where(at > 0).select(item.alias("Item")).where(
        F.col("Item").isNotNull() & ~truthy(F.col("Item").contains("PRODCT")) & ne("Item", F.lit("OV0001")))
    cat = catalog_items.select("SUPPLR", "PRODCT")
    return cat.join(items.distinct(), cat["PRODCT"] == items["Item"], "left_semi")


# --- routing and lookup ----------------------------------------------------

def route_documents(files: DataFrame, customer_pattern: str = r"po") -> DataFrame:
    """A12 + F28: role and reader of each file from its name and extension;
    unknown roles / extensions are 'reject'. Customer id = parent folder."""
    low = F.lower("path")
    ext = F.lower(F.element_at(F.split("path", r"\."), -1))
    role = (F.when(low.contains("order_confirmation"), "confirmation")
            .when(low.rlike(customer_pattern), "customer_order")
            .when(low.contains("xerox scan"), "memo").otherwise("reject"))
    reader = F.when(ext == "pdf", "extracted").when(ext == "xml", "xml").when(ext == "csv", "csv") \
        .when(ext.isin("xlsx", "xls"), "sheet")
    return files.select("path", S.customer_from_path("path").alias("customer_id"), ext.alias("ext"),
                        F.when(reader.isNull(), "reject").otherwise(role).alias("role"), reader.alias("reader"))


def read_orders(spark: SparkSession, root: str, extracted: dict[str, DataFrame] | None = None,
                customer_pattern: str = r"po") -> tuple[DataFrame, DataFrame]:
    """Every order document under ``root`` as order lines, and the
    rejected files.

    CSV exports and SpreadsheetML files of all folders are read in one pass
    each, routed by their path (``route_documents``) and united before the
    headers are applied: confirmations by their own names, customer sheets by
    the rows to skip and renames of their customer's template. ``extracted``
    holds the rows of documents without a text form, by layout code.
    Returns (lines: source, customer_id, role, row_no, Product, Qty, Unit
    Cost, Ext Cost; rejects: path, customer_id, ext, role, reader). Memos go
    to ``documents.memo_items`` and are neither.
    """
    rows = split_cells(read_lines(spark, root, "*.[cC][sS][vV]", deep=True)).unionByName(
        read_xml_rows(spark, root, "*.[xX][mM][lL]", deep=True))
    every = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(
        _decoded(F.col("path")).alias("path"))
    routed = route_documents(every, customer_pattern)
    skip = F.coalesce(*[F.when((F.col("role") == "customer_order") & (F.col("customer_id") == k), n)
                        for k, (n, _) in SHEET_TEMPLATES.items()], F.lit(0))
    heads = routed.where(F.col("role").isin("confirmation", "customer_order")).select(
        F.col("path").alias("file"), skip.alias("header_no"), F.col("customer_id").alias("_customer"), F.col("role").alias("_role"))

    def title(n):
        """A header text under the names of its document's kind."""
        return F.coalesce(
            *[F.when((F.col("_role") == "confirmation") & (n == old), new) for old, new in CONFIRMATION_LINE.items()],
            *[F.when((F.col("_role") == "customer_order") & (F.col("_customer") == k) & (n == old), new)
              for k, (_, names) in SHEET_TEMPLATES.items() for old, new in names.items()], n)

    wide = with_header(rows, heads, title).select(
        F.col("file").alias("source"), F.col("_customer").alias("customer_id"), F.col("_role").alias("role"),
        F.col("line_no").cast("long").alias("row_no"), *[cell_of(n).alias(n) for n in ORDER_LINE])
    number = {c: S.currency_to_number(F.col(f"`{c}`")) for c in ORDER_LINE[1:]}
    lines = wide.where(F.col("Product").isNotNull()).select(
        "source", "customer_id", "role", "row_no", "Product", *[v.alias(c) for c, v in number.items()])
    for layout, rows in (extracted or {}).items():
        made = LAYOUTS[layout](rows)
        lines = lines.unionByName(made.select(
            F.col("doc_id").cast("string").alias("source"), F.lit(layout).alias("customer_id"),
            F.lit("customer_order").alias("role"), F.col("row_no").cast("long").alias("row_no"), "Product",
            *[F.col(f"`{c}`").cast("double").alias(c) for c in ORDER_LINE[1:]]))
    return lines, routed.where(F.col("role") == "reject")


def missing_files(spark: SparkSession, folder: str, expected: DataFrame,
                  glob: str = CONFIRMATION_GLOB) -> DataFrame:
    """Expected order numbers (column ``po``, e.g. 'P1194944') with no
    matching confirmation file in ``folder`` (case variants of the name)."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
             .select(F.lower(F.regexp_extract(F.element_at(F.split("path", "/"), -1),
                                              r"(?i)order_confirmation_(p[^.]*)", 1)).alias("_po")))
    return expected.join(found, F.lower(expected["po"]) == found["_po"], "left_anti")
