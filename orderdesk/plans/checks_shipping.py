"""Shipping checks (C1-C5, C19, C20, B7-B9, B18-B20, G1, G11, G12, G14, G15,
J13, J14, A17, A18, F18, A1, A4)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.rules import parse_date, truthy
from ..operators import contacts as K
from ..operators import shipping as SH
from ..params import SEND_DATE, ShippingParams
from ..session import by_whole_row, written
from ..sources import catalog, store
from .registry import check

P = ShippingParams()

# Oracle building blocks (DuckDB). AS_OF 1998-06-15, deadline = month end of
# AS_OF + 10, lateline = AS_OF - 21, missing share 0.1, alarm 150, reset 100.
OPEN = """
base as (
 select PURORD, replace(SUPPLR, ' ', '') as SUPPLR, PRODCT, cast(trunc(ORDQTY) as integer) as ORDQTY,
  cast(OUTQTY as bigint) as OUTQTY, INTQTY, try_cast(CONDAT as date) as CONDAT,
  try_cast(NEWCONDAT as date) as NEWCONDAT, DATEDFF, TYPE,
  cast(OUTQTY as double) / nullif(cast(trunc(ORDQTY) as integer), 0) as PCTSHIP
 from v_open_po_lines),
due as (select * from base where CONDAT <= last_day(date '1998-06-15' + 10)),
kept as (select * from due where not (coalesce(PCTSHIP < 0.1, false) and coalesce(INTQTY = 0, false))),
flagged_kept as (select *, (select coalesce(bool_or(DATEDFF > 150), false) from kept) as ALARM from kept),
corrected as (select *, NEWCONDAT as NEWCONDAT_BEFORE,
  case when ALARM and coalesce(DATEDFF > 100, false) then CONDAT else NEWCONDAT end as NEWCONDAT_AFTER
  from flagged_kept),
open_orders as (select c.PURORD, c.SUPPLR, c.PRODCT, c.ORDQTY, c.OUTQTY, c.CONDAT,
  c.NEWCONDAT_AFTER as NEWCONDAT, c.DATEDFF, c.TYPE, c.PCTSHIP, s.EMAIL
  from corrected c left join (select SUPPLR, EMAIL from v_supplier_contacts) s on c.SUPPLR = s.SUPPLR),
stock_c as (select * from open_orders where coalesce(substr(SUPPLR, 1, 1) = 'C', false) and coalesce(TYPE = 'S', false)),
rest as (select * from open_orders where (coalesce(substr(SUPPLR, 1, 1) <> 'C', true) and coalesce(TYPE = 'S', false)) or coalesce(TYPE = 'C', false))
"""


def flagged_cte(src: str, name: str = "flagged", reset: bool = True) -> str:
    attn = "coalesce(NEWCONDAT < date '1998-06-15' - 21, false)"
    if reset:
        attn += " and not (coalesce(TYPE = 'S', false) and coalesce(PCTSHIP < 0.5, false))"
    return f"""{name} as (select *,
  case when coalesce(NEWCONDAT < date '1998-06-15', false) then 1 else 0 end as LATE,
  case when {attn} then 1 else 0 end as ATTN,
  case when coalesce(TYPE = 'C', false) and coalesce(NEWCONDAT < date '1998-06-15' - 21, false) then 1 end as Z_ITEMS
  from {src})"""


SUMMARY_AGGS = """min(NEWCONDAT) as NEWCONDAT, cast(sum(LATE) as bigint) as LATE, max(ATTN) as ATTN,
  cast(coalesce(bool_or(Z_ITEMS = 1), false) as integer) as Z_ITEMS"""

LINE_COLS = "PURORD, SUPPLR, PRODCT, ORDQTY, OUTQTY, CONDAT, NEWCONDAT, DATEDFF, TYPE, PCTSHIP"


def _lines(spark):
    return spark.table("v_open_po_lines")


def _contacts(spark):
    return spark.table("v_supplier_contacts")


def _open(spark):
    return SH.open_orders_once(_lines(spark), _contacts(spark), P)


def _rest(spark):
    return SH.split_orders(_open(spark))[1]


@check("tracking_summary", f"""with {OPEN}, {flagged_cte('rest')}
select SUPPLR, min(EMAIL) as EMAIL, {SUMMARY_AGGS} from flagged where SUPPLR is not null group by SUPPLR""")
def tracking_summary(spark):
    # one read of the order lines; equal to SH.tracking_summary(_rest(spark), P)
    return SH.tracking_summary_from_lines(_lines(spark), _contacts(spark), P)


@check("open_orders", f"with {OPEN} select * from open_orders")
def open_orders(spark):
    return _open(spark)


@check("missing_items", f"""with {OPEN} select PURORD, SUPPLR, PRODCT, ORDQTY, OUTQTY, CONDAT from due
where coalesce(PCTSHIP < 0.1, false) and coalesce(INTQTY = 0, false)""")
def missing_items(spark):
    return SH.missing_items(_lines(spark), P)


@check("orders_stock_c", f"with {OPEN} select * from stock_c")
def orders_stock_c(spark):
    return SH.split_orders(_open(spark))[0]


@check("orders_rest", f"with {OPEN} select * from rest")
def orders_rest(spark):
    return _rest(spark)


@check("date_correction", f"""with {OPEN}
select PURORD, SUPPLR, PRODCT, DATEDFF, CONDAT, NEWCONDAT_BEFORE, NEWCONDAT_AFTER as NEWCONDAT, ALARM
from corrected where DATEDFF > 100""")
def date_correction(spark):
    return SH.date_correction(_lines(spark), P)


@check("late_orders", f"""with {OPEN}, {flagged_cte('rest')}
select {LINE_COLS}, EMAIL, LATE, ATTN, Z_ITEMS from flagged where LATE = 1""")
def late_orders(spark):
    return SH.late_orders(_rest(spark), P)


@check("late_reminders", f"""with {OPEN}, {flagged_cte('rest')},
att as (select SUPPLR from flagged where SUPPLR is not null group by SUPPLR having max(ATTN) > 0)
select PURORD, SUPPLR, PRODCT, ORDQTY, OUTQTY, CONDAT, NEWCONDAT, TYPE, LATE, EMAIL from flagged
where SUPPLR in (select SUPPLR from att) and NEWCONDAT < date '1998-06-15'""")
def late_reminders(spark):
    return SH.late_reminders(_rest(spark), P)


CONTACT_COLS = """cc as (select EMAIL, count(*) as N_ROWS,
  coalesce(bool_or(coalesce(ORDQTY <> OUTQTY, true)), false) as SHOW_OUTQTY,
  coalesce(bool_or(coalesce(CONDAT <> NEWCONDAT, true)), false) as SHOW_NEWCONDAT
  from rest where EMAIL is not null group by EMAIL)"""


@check("contact_columns", f"with {OPEN}, {CONTACT_COLS} select * from cc")
def contact_columns(spark):
    return SH.contact_columns(_rest(spark))


TYPE_MAP = "case TYPE when 'C' then 'Special' when 'S' then 'Stock' when 'P' then 'P' when 'D' then 'D' end"


@check("contact_reminders", f"""with {OPEN}, {CONTACT_COLS}
select r.EMAIL, r.PURORD as "PO#", r.SUPPLR as "Supplier", r.PRODCT as "Item#", r.ORDQTY as ORDERED,
 case when cc.SHOW_OUTQTY then r.OUTQTY end as OUTQTY, r.CONDAT,
 case when cc.SHOW_NEWCONDAT then r.NEWCONDAT end as NEWCONDAT, {TYPE_MAP} as TYPE,
 coalesce(r.CONDAT <= date '1998-06-15', false) as PAST_DUE
from rest r join cc on r.EMAIL = cc.EMAIL""")
def contact_reminders(spark):
    return SH.contact_reminders(_rest(spark), P)


@check("format_table", f"""with {OPEN}
select PURORD as "PO#", SUPPLR as "Supplier", PRODCT as "Item#", ORDQTY as ORDERED, OUTQTY, CONDAT, NEWCONDAT,
 DATEDFF, {TYPE_MAP} as TYPE, PCTSHIP, EMAIL, coalesce(CONDAT <= date '1998-06-15', false) as PAST_DUE
from open_orders""")
def format_table(spark):
    return SH.format_table(_open(spark), P)


@check("quality_counts", f"""with {OPEN},
j as (select d.*, s.EMAIL, coalesce(d.PCTSHIP < 0.1, false) and coalesce(d.INTQTY = 0, false) as MISS
  from due d left join (select SUPPLR, EMAIL from v_supplier_contacts) s on d.SUPPLR = s.SUPPLR),
c as (select count(*) filter (where not MISS and EMAIL is null) as a, count(*) filter (where MISS) as b,
  count(*) filter (where not MISS and coalesce(DATEDFF > 150, false)) as d from j)
select 'missing_email' as rule, a as n_rows, a > 1 as failed from c
union all select 'missing_item', b, b > 0 from c
union all select 'date_entry', d, d > 0 from c""")
def quality_counts(spark):
    return SH.quality_counts(_lines(spark), _contacts(spark), P)


MSGS = """msgs as (select conv_id, turn, sender,
  lower(case when instr(email, '@') > 0 then email else sender end) as email, receive,
  case when coalesce(contains(attachment, 'FCR'), false) then 1 else 0 end as FCR,
  split_part(regexp_replace(body, '\\s+', ' ', 'g'), 'From:', 1) as body
  from v_messages where receive > date '2024-01-15'),
rep as (select email, max(receive) as receive, cast(sum(FCR) as bigint) as FCR,
  string_agg(body, '-' order by conv_id, turn) as body from msgs group by email)"""


@check("replies", f"with {MSGS} select *, 0 as part from rep")
def replies(spark):
    return SH.replies(spark.table("v_messages"), SEND_DATE)


@check("new_replies", """select conv_id, turn, sender, email, receive, attachment, body
from v_messages where receive > date '2024-01-15'""")
def new_replies(spark):
    m = spark.table("v_messages")
    return m.where(F.col("receive") > F.lit(SEND_DATE))


@check("orders_replied", f"""with {OPEN}, {MSGS}
select r.*, k.email is not null as REPLY from rest r
left join (select distinct email from rep) k on lower(r.EMAIL) = k.email""")
def orders_replied(spark):
    rep = SH.replies(spark.table("v_messages"), SEND_DATE)
    return SH.mark_replied(_rest(spark), rep)


WEB = """web as (select * replace (try_cast(CONDAT as date) as CONDAT, try_cast(NEWCONDAT as date) as NEWCONDAT,
  cast(OUTQTY as bigint) as OUTQTY)
  from v_open_po_lines where try_cast(CONDAT as date) <= last_day(date '1998-06-15'))"""


@check("web_tracking", f"""with {WEB}, {flagged_cte('web', reset=False)}
select SUPPLR, {SUMMARY_AGGS} from flagged where SUPPLR is not null group by SUPPLR""")
def web_tracking(spark):
    return SH.web_tracking(_lines(spark), P)


@check("web_supplier_tracking", f"""with {WEB}, {flagged_cte('web', reset=False)}
select * replace (coalesce(Z_ITEMS, 0) as Z_ITEMS) from flagged""")
def web_supplier_tracking(spark):
    return SH.web_supplier_tracking(_lines(spark), None, P)


SHIP = """ship as (select PURORD as purord, SUPPLR as supplr, PRODCT as item, cast(trunc(ORDQTY) as integer) as ordqty,
  cast(OUTQTY as integer) as outqty, try_cast(CONDAT as date) as condat, try_cast(NEWCONDAT as date) as newdate,
  TYPE as type, case when coalesce(try_cast(NEWCONDAT as date) < date '1998-06-15', false) then 1 else 0 end as late
  from v_open_po_lines)"""


@check("shipping_grouped", f"""with {SHIP}
select supplr, min(condat) as condat, cast(sum(late) as bigint) as late from ship group by supplr""")
def shipping_grouped(spark):
    return SH.shipping_grouped(SH.shipments(_lines(spark), P))


@check("shipments_raw", "select PURORD as purord, SUPPLR as supplr, PRODCT as item from v_open_po_lines")
def shipments_raw(spark):
    return SH.shipments_raw(_lines(spark))


@check("shipment_records", """select cast(to_json(struct_pack(purord := PURORD, supplr := SUPPLR, item := PRODCT)) as varchar) as record
from v_open_po_lines""")
def shipment_records(spark):
    return SH.records(SH.shipments_raw(_lines(spark)))


SHIP_EARLIER = SHIP.replace("ship as (", "ship_earlier as (").replace("date '1998-06-15'", "date '1998-05-15'")


@check("insert_absent", f"""with {SHIP}, {SHIP_EARLIER},
existing as (select distinct * from ship_earlier)
select * from existing union all (select * from ship except select * from existing)""")
def insert_absent(spark):
    """Yesterday's dump is stored (a month earlier: other late flags); today's
    dump is inserted where a row's whole value is new."""
    import dataclasses
    import datetime as dt
    earlier = dataclasses.replace(P, as_of=dt.date(1998, 5, 15))
    existing = by_whole_row(SH.shipments(_lines(spark), earlier)).distinct()
    incoming = SH.shipments(_lines(spark), P)
    return SH.insert_absent(incoming, existing)


@check("insert_stored", f"""with {SHIP}, {SHIP_EARLIER},
existing as (select distinct * from ship_earlier),
new as (select * from ship except select * from existing)
select 'first' as load_id, count(*) as n_rows from existing
union all select 'again', 0 union all select 'second', count(*) from new""")
def insert_stored(spark):
    """A17 at size: the stored table is bucketed by a hash of the row; loads
    insert what is new, a repeated load nothing."""
    import dataclasses
    import datetime as dt
    # three loads read the order lines: they are joined once
    lines = written(_lines(spark).drop("INTQTY", "DATEDFF"), "lines")
    earlier = SH.shipments(lines, dataclasses.replace(P, as_of=dt.date(1998, 5, 15)))
    held = store.open_store(spark, f"shipments_{uuid.uuid4().hex}", earlier.schema)
    store.insert_absent(held, earlier, "first")
    store.insert_absent(held, earlier, "first")
    store.insert_absent(held, earlier.union(earlier), "again")
    store.insert_absent(held, SH.shipments(lines, P), "second")
    counts = store.rows(held, load_id=True).groupBy("load_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return store.loads(held).join(counts, "load_id", "left").select("load_id", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@check("date_scalars", """select PURORD, PRODCT, try_cast(CONDAT as date) as CONDAT,
 cast(year(try_cast(CONDAT as date)) as integer) as CONDAT_YEAR,
 last_day(date '1998-06-15' + 10) as DEADLINE, last_day(date '1998-06-15') as WEB_DEADLINE,
 date '1998-06-15' - 21 as LATELINE,
 coalesce(try_cast(CONDAT as date) <= last_day(date '1998-06-15' + 10), false) as DUE,
 coalesce(try_cast(CONDAT as date) <= date '1998-06-15', false) as PAST_DUE
from v_open_po_lines""")
def date_scalars(spark):
    condat = parse_date("CONDAT")
    return _lines(spark).select(
        "PURORD", "PRODCT", condat.alias("CONDAT"), F.year(condat).alias("CONDAT_YEAR"),
        SH.deadline(P).alias("DEADLINE"), SH.web_deadline(P).alias("WEB_DEADLINE"),
        S.days_before(P.as_of, P.late_days).alias("LATELINE"),
        truthy(condat <= SH.deadline(P)).alias("DUE"),
        truthy(condat <= F.lit(P.as_of)).alias("PAST_DUE"))


@check("tracking_by_id", """select * replace (cast(OUTQTY as bigint) as OUTQTY) from v_open_po_lines
where SUPPLR in (select SUPPLR from v_vendor_listing where regexp_full_match(SUPPLR, '[A-Z][A-Z0-9]{0,9}'))""")
def tracking_by_id(spark):
    ids = K.valid_supplier_ids(spark.table("v_vendor_listing")).where("VALID").select("SUPPLR")
    return catalog.named_query(spark, "tracking_by_id", items=ids)


@check("orders_by_item", """select * replace (cast(OUTQTY as bigint) as OUTQTY) from v_open_po_lines
where PRODCT in (select Product from v_customer_po_lines)""")
def orders_by_item(spark):
    items = spark.table("v_customer_po_lines").select("Product")
    return catalog.named_query(spark, "shipping_by_item", items=items)


@check("gtin_by_item", """select PRODCT, SUPPLR, GTIN, TYPE, GTINDESC, TOTSKUQTY from v_item_gtin
where TYPE = 4 and PRODCT in (select PRODCT from v_open_po_lines)""")
def gtin_by_item(spark):
    items = spark.table("v_open_po_lines").select("PRODCT")
    return catalog.named_query(spark, "gtin", items=items)


@check("named_query", "select * from v_catalog_items")
def named_query(spark):
    return catalog.named_query(spark, "uprice")


@check("contacts_scan", "select SUPPLR, EMAIL from v_supplier_contacts")
def contacts_scan(spark):
    return catalog.named_query(spark, "getsupplrcontacts").select("SUPPLR", "EMAIL")


@check("supplier_listing", """select SUPPLR as supplier, SUPPLR_NAME as supplier_name, EMAIL as email
from v_supplier_contacts""")
def supplier_listing(spark):
    return K.supplier_listing(_contacts(spark))
