"""Document checks (C15, C16, A10, W1, W2, W6, B14, F5-F9, F16, F1-F4,
F10-F12, B19, C17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import contacts as K
from ..operators import documents as D
from ..operators import templates as T
from ..sources import files
from .registry import check


def _rows(spark):
    return spark.table("v_extracted_rows")


FFILL = """ff as (select doc_id, row_no,
 last_value(style ignore nulls) over w as style, last_value(qty_text ignore nulls) over w as qty_text,
 last_value(ext_text ignore nulls) over w as ext_text, last_value(upc_text ignore nulls) over w as upc_text
 from (select * replace (cast(row_no as integer) as row_no) from v_extracted_rows) x window w as (partition by doc_id order by row_no rows between unbounded preceding and current row))"""


@check("extracted_scan", """select doc_id, row_no, style as Product, qty_text, ext_text, upc_text
from (select * replace (cast(row_no as integer) as row_no) from v_extracted_rows) x where style is not null""")
def extracted_scan(spark):
    return D.extracted_scan(_rows(spark))


@check("forward_fill", f"with {FFILL} select * from ff")
def forward_fill(spark):
    return D.fill_down(_rows(spark))


@check("style_filter", f"with {FFILL} select * from ff where regexp_full_match(style, '[A-Z0-9]{{1,9}}')")
def style_filter(spark):
    return D.style_rows(D.fill_down(_rows(spark)))


@check("number_cleaning", """select doc_id, row_no,
 try_cast(regexp_extract(qty_text, '(\\d+\\.?\\d*)', 1) as double) as QTY,
 try_cast(regexp_replace(ext_text, '[$,]', '', 'g') as double) as EXT,
 try_cast(regexp_extract(ext_text, '(\\d+\\.?\\d*)', 1) as double) as EXT_NUM,
 regexp_extract(upc_text, '(\\d+)', 1) as UPC_DIGITS from (select * replace (cast(row_no as integer) as row_no) from v_extracted_rows) x""")
def number_cleaning(spark):
    return D.clean_numbers(_rows(spark))


@check("order_lines_ffill", f"""with {FFILL}
select doc_id, row_no, style as Product, try_cast(regexp_extract(qty_text, '(\\d+\\.?\\d*)', 1) as double) as Qty,
 try_cast(regexp_extract(ext_text, '(\\d+\\.?\\d*)', 1) as double) as Ext_Cost, upc_text as UPC
from ff where regexp_full_match(style, '[A-Z0-9]{{1,9}}')""")
def order_lines_ffill(spark):
    return D.order_lines_ffill(_rows(spark))


WORDS = "string_split(trim(regexp_replace({x}, '\\s+', ' ', 'g')), ' ')"


@check("lookahead_upc", f"""with p as (select doc_id, row_no,
  replace({WORDS.format(x='style')}[-1], '-', '') as Product from (select * replace (cast(row_no as integer) as row_no) from v_extracted_rows) x),
u as (select *,
  coalesce(regexp_extract(lead(Product, 1) over w, '(\\d+)', 1), '') as UPC1,
  coalesce(regexp_extract(lead(Product, 2) over w, '(\\d+)', 1), '') as UPC2,
  coalesce(regexp_extract(lead(Product, 3) over w, '(\\d+)', 1), '') as UPC3
  from p window w as (partition by doc_id order by row_no))
select doc_id, row_no, Product, UPC1, UPC2, UPC3,
 case when length(UPC3) > length(case when length(UPC2) > length(UPC1) then UPC2 else UPC1 end) then UPC3
  else case when length(UPC2) > length(UPC1) then UPC2 else UPC1 end end as UPC
from u where regexp_matches(Product, '\\b[A-Z][A-Z0-9]+$')""")
def lookahead_upc(spark):
    return D.lookahead_upc(_rows(spark))


@check("longest_upc", """with u as (select doc_id, row_no,
  lead(upc_text, 1) over w as U1, lead(upc_text, 2) over w as U2, lead(upc_text, 3) over w as U3
  from (select * replace (cast(row_no as integer) as row_no) from v_extracted_rows) x window w as (partition by doc_id order by row_no)),
c as (select *, coalesce(U1, '') as C1, coalesce(U2, '') as C2, coalesce(U3, '') as C3 from u)
select doc_id, row_no,
 coalesce(nullif(regexp_extract(U1, '(4\\d{11})', 1), ''), nullif(regexp_extract(U2, '(4\\d{11})', 1), ''),
  nullif(regexp_extract(U3, '(4\\d{11})', 1), '')) as FIRST_UPC,
 case when length(C3) > length(case when length(C2) > length(C1) then C2 else C1 end) then C3
  else case when length(C2) > length(C1) then C2 else C1 end end as LONGEST_UPC
from c""")
def longest_upc(spark):
    return D.longest_upc(_rows(spark))


@check("upc_word", """select PRODCT,
 list_filter(string_split(GTINDESC || ' ' || GTIN, ' '), lambda w: starts_with(w, '4') and length(w) > 10)[1] as UPC
from v_item_gtin""")
def upc_word(spark):
    g = spark.table("v_item_gtin")
    return g.select("PRODCT", S.upc_word(F.concat_ws(" ", "GTINDESC", "GTIN")).alias("UPC"))


@check("memo_items", """with s as (select memo_id, min(line_no) filter (where contains(text, 'NOTE THE FOLLOWING CHANGES')
  or contains(text, 'HAVE BEEN ADDED TO THE LINE') or contains(text, 'AGAIN FOR SALE')) as stop_at
  from v_memo_lines group by memo_id)
select m.memo_id, m.line_no, unnest(regexp_extract_all(m.text, '\\b[A-Z](?:\\w*\\d){3,}\\w*\\b')) as item
from v_memo_lines m join s on m.memo_id = s.memo_id where s.stop_at is null or m.line_no < s.stop_at""")
def memo_items(spark):
    # the memo lines are derived from the part table, one line per part
    return D.memo_items(spark.table("v_memo_lines"))


@check("scalar_strings", f"""select Supplier, Item,
 replace(Longname, ' ', '') as NO_BLANKS, substr(Supplier, 1, 1) as ORIGIN, substr(Supplier, 1, 4) as "PRIMARY",
 {WORDS.format(x='Longname')}[1] as FIRST_WORD, {WORDS.format(x='Longname')}[-1] as LAST_WORD,
 array_to_string({WORDS.format(x='Longname')}[1:3], ' ') as FIRST_THREE,
 nullif(regexp_extract(Longname, '\\(([^)]+)\\)$', 1), '') as CODE,
 lower(Item) as ITEM_LOWER, regexp_replace(Longname, '\\s+', ' ', 'g') as COLLAPSED,
 replace(Longname, 'Co.', chr(10) || 'Co.') as BROKEN,
 split_part(regexp_replace(Longname, '\\s+', ' ', 'g'), 'Trading', 1) as BEFORE_MARKER
from v_new_items""")
def scalar_strings(spark):
    n = spark.table("v_new_items")
    return n.select("Supplier", "Item",
                    S.remove_text("Longname", " ").alias("NO_BLANKS"),
                    S.first_chars("Supplier", 1).alias("ORIGIN"),
                    S.first_chars("Supplier", 4).alias("PRIMARY"),
                    S.first_word("Longname").alias("FIRST_WORD"),
                    S.last_word("Longname").alias("LAST_WORD"),
                    S.first_words("Longname", 3).alias("FIRST_THREE"),
                    S.supplier_in_parens("Longname").alias("CODE"),
                    F.lower("Item").alias("ITEM_LOWER"),
                    S.collapse_blanks("Longname").alias("COLLAPSED"),
                    S.break_before("Longname", "Co.").alias("BROKEN"),
                    S.text_before("Longname", "Trading").alias("BEFORE_MARKER"))


@check("supplier_code", """select Item, Supplier, nullif(regexp_extract(Supplier, '\\(([^)]+)\\)$', 1), '') as SUPPLR
from v_inventory""")
def supplier_code(spark):
    inv = spark.table("v_inventory")
    return inv.select("Item", "Supplier", S.supplier_in_parens("Supplier").alias("SUPPLR"))


@check("valid_supplier_id", """select SUPPLR, coalesce(regexp_full_match(SUPPLR, '[A-Z][A-Z0-9]{0,9}'), false) as VALID
from v_vendor_listing""")
def valid_supplier_id(spark):
    return K.valid_supplier_ids(spark.table("v_vendor_listing"))


@check("contact_audit", """with l as (select SUPPLR, SUPPLRDES, EMAIL as EMAIL_x from v_vendor_listing
  where SUPPLR is not null and coalesce(SUPPLR <> 'T999', true)),
j as (select l.*, c.EMAIL as EMAIL_y from l left join v_supplier_contacts c on l.SUPPLR = c.SUPPLR)
select SUPPLR, SUPPLRDES, EMAIL_x, EMAIL_y,
 case when coalesce(EMAIL_x <> EMAIL_y, true) then 1 else 0 end as DIFFERS,
 case when EMAIL_y in (select EMAIL_x from l where EMAIL_x is not null) then 1 else 0 end as KNOWN
from j""")
def contact_audit(spark):
    return K.contact_audit(spark.table("v_vendor_listing"), spark.table("v_supplier_contacts"))


# --- layouts: extracted rows of the order lines under each layout's headers ---

ROWS = "(select * replace (cast(row_no as integer) as row_no) from v_extracted_rows) x"
QTY = "replace(qty_text, 'EA ', '')"
AMOUNT = "replace(ext_text, '$', '')"


def _laid_out(spark, names: dict, where: str = "true"):
    """v_extracted_rows with data columns named by a layout: header -> SQL text."""
    return _rows(spark).where(where).select("doc_id", "row_no", *[F.expr(e).alias(c) for c, e in names.items()])


@check("order_lines_fl2658", f"""select doc_id, row_no, style as Product, cast({QTY} as double) as Qty,
 cast({AMOUNT} as double) as "Unit Cost", cast('1' || {AMOUNT} as double) as "Ext Cost"
from {ROWS} where style is not null and row_no % 4 <> 0""")
def order_lines_fl2658(spark):
    return T.fl2658(_laid_out(spark, {"ITEM NO.": "style", "QTY": QTY, "Unit Price": "case when row_no % 4 <> 0 then ext_text end",
                                      "SubTotal": "replace(ext_text, '$', '$1,')"}))


@check("order_lines_pa1683", f"""select doc_id, row_no, style as Product, {QTY} as Qty,
 cast({AMOUNT} as double) as "Unit Cost", case when row_no % 7 <> 0 then cast('1' || {AMOUNT} as double) end as "Ext Cost"
from {ROWS} where style is not null and row_no % 5 <> 0""")
def order_lines_pa1683(spark):
    return T.pa1683(_laid_out(spark, {
        "TEXT": "upc_text", "SUPPLIER #": "style", "QTY": f"case when row_no % 5 <> 0 then {QTY} end", "PRICE/UN": "ext_text",
        "AMOUNT": "case when row_no % 7 = 0 then 'n/a' else replace(ext_text, '$', '$1,') end"}))


@check("order_lines_az1239", f"""with d as (select distinct doc_id from {ROWS} where style <> 'Total: n/a')
select doc_id, row_no, style as Product, cast({QTY} as double) as Qty, cast({AMOUNT} as double) as "Unit Cost",
 cast('1' || {AMOUNT} as double) as "Ext Cost"
from {ROWS} where style is not null and doc_id in (select doc_id from d)""")
def order_lines_az1239(spark):
    """The item column stands in another place in every second document."""
    return T.az1239(_laid_out(spark, {
        "c0": "case when doc_id % 2 = 0 then style else 'lights' end", "c1": "case when doc_id % 2 = 0 then 'lights' else style end",
        "c2": f"{QTY} || 'EaOnly'", "c3": "replace(ext_text, '$', '')", "c4": "replace(ext_text, '$', '1,')"}))


FL_TEXT = "case when row_no % 2 = 1 then 'Tree ' || style else upc_text end"


@check("order_lines_fl4494", f"""with p as (select *, regexp_extract({FL_TEXT}, '(\\S+)$', 1) as Product,
  {FL_TEXT} as Description from {ROWS}),
u as (select *, coalesce(regexp_extract(lead(Product, 1) over w, '(\\d+)', 1), '') as U1,
  coalesce(regexp_extract(lead(Product, 2) over w, '(\\d+)', 1), '') as U2,
  coalesce(regexp_extract(lead(Product, 3) over w, '(\\d+)', 1), '') as U3
  from p window w as (partition by doc_id order by row_no)),
v as (select *, case when length(U2) > length(U1) then U2 else U1 end as U12 from u)
select doc_id, row_no, Description, case doc_id % 2 when 0 then {AMOUNT} else '1' || {AMOUNT} end as "Unit Retail", Product,
 case when length(U3) > length(U12) then U3 else U12 end as UPC, cast({QTY} as double) as Qty,
 cast(case doc_id % 2 when 0 then '1' || {AMOUNT} else {AMOUNT} end as double) as "Unit Cost", cast({AMOUNT} as double) as "Ext Cost"
from v where regexp_matches(Product, '\\b[A-Z][A-Z0-9]+$')""")
def order_lines_fl4494(spark):
    """Two of the headers change places from document to document."""
    body = _laid_out(spark, {"SKU": FL_TEXT, "Unit": AMOUNT, "Unit.1": f"'1' || {AMOUNT}", "Ord/": QTY, "Extended": AMOUNT})
    heads = _rows(spark).select("doc_id").distinct().select(
        "doc_id", F.lit(0).alias("row_no"), F.lit("Description").alias("SKU"),
        F.expr("case doc_id % 2 when 0 then 'Retail' else 'Cost' end").alias("Unit"),
        F.expr("case doc_id % 2 when 0 then 'Cost' else 'Retail' end").alias("Unit.1"),
        F.lit("Pcs").alias("Ord/"), F.lit("Cost").alias("Extended"))
    return T.fl4494(heads.unionByName(body))


MA_TEXT = "case when row_no % 4 = 0 then 'UNIT RETAIL' else 'R' || cast(row_no as string) end"
MA_COLUMNS = ("Style description / Vendor style", "Ordered qty", "Unit cost", "Extended cost", "UPC-A/EAN", "DESCRIPTION OF GOODS")


@check("order_lines_ma0603", f"""with p as (select *, case when row_no <= 3 then 1 else 2 end as page_no, {MA_TEXT} as txt from {ROWS}),
f as (select *, last_value(style ignore nulls) over w as item, bool_or(style is not null) over t as has_item,
  bool_or(txt = 'UNIT RETAIL') over t as marked, lead(txt, 2) over (partition by doc_id, page_no order by row_no) as ahead
  from p window t as (partition by doc_id, page_no),
   w as (partition by doc_id, page_no order by row_no rows between unbounded preceding and current row))
select doc_id, page_no, row_no, item as Product, cast({QTY} as double) as Qty, cast({AMOUNT} as double) as "Unit Cost",
 cast('1' || {AMOUNT} as double) as "Ext Cost", cast(null as varchar) as "Unit retail", upc_text as UPC, txt as DESCRIPTION,
 case when marked then ahead end as Retail
from f where case when has_item then regexp_full_match(item, '[A-Z0-9]{{1,9}}') else upc_text is not null end""")
def order_lines_ma0603(spark):
    """Page 1 names its columns in its first row (cost before quantity); page 2 is named."""
    page = "case when row_no <= 3 then 1 else 2 end"
    cells = ["style", "case when row_no <= 3 then ext_text else qty_text end", "case when row_no <= 3 then qty_text else ext_text end",
             "replace(ext_text, '$', '$1')", "upc_text", MA_TEXT]
    body = _rows(spark).select("doc_id", F.expr(page).alias("page_no"), "row_no",
                               *[F.expr(e).alias(c) for c, e in zip(MA_COLUMNS, cells)])
    first = ["Product", "Unit Cost", "Qty", "Ext Cost", "UPC-A/EAN", "DESCRIPTION"]
    heads = _rows(spark).select("doc_id").distinct().select(
        "doc_id", F.lit(1).alias("page_no"), F.lit(0).alias("row_no"), *[F.lit(t).alias(c) for c, t in zip(MA_COLUMNS, first)])
    return T.ma0603(heads.unionByName(body))


PATHS = """select '/so/' || case o_custkey % 3 when 0 then 'FL4494' when 1 then 'NV0356' else 'X' || cast(o_custkey as string) end || '/' ||
 case o_orderkey % 4 when 0 then 'Order_Confirmation_P' when 1 then 'PO_' when 2 then 'Xerox Scan ' else 'misc ' end ||
 cast(o_orderkey as string) || case o_orderkey % 7 when 0 then '.pdf' when 1 then '.xml' when 2 then '.csv' when 3 then '.xlsx'
 when 4 then '.XLS' when 5 then '.txt' else '.CSV' end as path from orders"""


@check("route_roles", f"""with f as ({PATHS}), e as (select path, lower(path) as p, string_split(path, '/')[-2] as customer_id,
  lower(string_split(path, '.')[-1]) as ext from f),
r as (select *, case ext when 'pdf' then 'extracted' when 'xml' then 'xml' when 'csv' then 'csv' when 'xlsx' then 'sheet'
  when 'xls' then 'sheet' end as reader from e)
select path, customer_id, ext, case when reader is null then 'reject' when contains(p, 'order_confirmation') then 'confirmation'
 when contains(p, 'po') then 'customer_order' when contains(p, 'xerox scan') then 'memo' else 'reject' end as role, reader from r""")
def route_roles(spark):
    return files.route_documents(spark.sql(PATHS))
