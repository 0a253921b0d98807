"""Order checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import orders as O
from ..params import OrderParams
from ..sources import catalog
from .registry import check

P = OrderParams()

MONEY_COLS = "Unit_Cost, Ext_Cost, CasePrice, SplitPrice"
INV_OUT = """Item, Status, NETAVAIL, CaseQty, cast(CasePrice as double) as CasePrice,
  cast(SplitPrice as double) as SplitPrice, Supplier, Product_long"""
LINES_OUT = """PO, Customer, Product, Qty, Ship_Date, cast(Unit_Cost as double) as Unit_Cost,
  cast(Ext_Cost as double) as Ext_Cost"""

PRICED = """
j as (select l.*, i.* from v_customer_po_lines l left join v_inventory i on l.Product = i.Item),
known as (select *, case when CaseQty <> 0 and Qty % CaseQty = 0 then cast(floor(Qty / CaseQty) as bigint) end as NO_CASE
  from j where Status is not null),
priced as (select *, round(case when coalesce(NO_CASE > 0, false)
   then CasePrice * (1 - cast('0.20' as decimal(12,4))) + cast('0.25' as decimal(12,4))
   else SplitPrice + cast('0.25' as decimal(12,4)) end + cast('0.0001' as decimal(12,4)), 2) as PRICE
  from known),
checked as (select * exclude (Item), cast('0.25' as decimal(12,4)) as TICKET,
  case when coalesce(PRICE <> Unit_Cost, true) then '!' else '' end as FLAG from priced)"""

CHECKED_OUT = f"""PO, Customer, Product, Qty, Ship_Date, cast(Unit_Cost as double) as Unit_Cost,
  cast(Ext_Cost as double) as Ext_Cost, Status, NETAVAIL, CaseQty, cast(CasePrice as double) as CasePrice,
  cast(SplitPrice as double) as SplitPrice, Supplier, Product_long, cast(TICKET as double) as TICKET, NO_CASE,
  cast(PRICE as double) as PRICE, FLAG"""


def _lines(spark):
    return spark.table("v_customer_po_lines")


def _inv(spark):
    return spark.table("v_inventory")


def _priced(spark):
    return O.price_lines(_lines(spark), _inv(spark), P)


@check("price_check", f"with {PRICED} select {CHECKED_OUT} from checked")
def price_check(spark):
    return O.outlet(_priced(spark))


@check("order_totals", f"""with {PRICED}
select PO, cast(round(sum(Ext_Cost), 2) as double) as EXT_TOTAL, cast(round(sum(PRICE * Qty), 2) as double) as PRICED_TOTAL,
 count(*) filter (where FLAG = '!') as N_FLAGGED, round(sum(Ext_Cost), 2) = round(sum(PRICE * Qty), 2) as EQUAL
from checked group by PO""")
def order_totals(spark):
    return O.order_totals(_priced(spark))


@check("over_available", f"with {PRICED} select {CHECKED_OUT} from checked where Qty > NETAVAIL")
def over_available(spark):
    return O.outlet(O.over_available(_priced(spark)))


@check("unknown_items", f"""select {LINES_OUT}, {INV_OUT}
from v_customer_po_lines l left join v_inventory i on l.Product = i.Item where i.Status is null""")
def unknown_items(spark):
    return O.outlet(O.unknown_items(_lines(spark), _inv(spark)))


@check("join_left_inventory", f"""select {LINES_OUT}, {INV_OUT}
from v_customer_po_lines l left join v_inventory i on l.Product = i.Item""")
def join_left_inventory(spark):
    return O.outlet(O.join_inventory(_lines(spark), _inv(spark)))


@check("semi_items", f"""select {INV_OUT} from v_inventory
where Item in (select Product from v_customer_po_lines)""")
def semi_items(spark):
    return O.outlet(O.restrict_items(_inv(spark), _lines(spark)))


@check("item_price", """select Item,
 cast(round(CasePrice * (1 - cast('0.20' as decimal(12,4))) + cast('0.25' as decimal(12,4)) + cast('0.0001' as decimal(12,4)), 2) as double) as CASE_PRICE,
 cast(round(SplitPrice + cast('0.25' as decimal(12,4)) + cast('0.0001' as decimal(12,4)), 2) as double) as SPLIT_PRICE
from v_inventory""")
def item_price(spark):
    inv = _inv(spark)
    return inv.select("Item",
                      O.unit_price("CasePrice", "SplitPrice", F.lit(1), P).cast("double").alias("CASE_PRICE"),
                      O.unit_price("CasePrice", "SplitPrice", F.lit(0), P).cast("double").alias("SPLIT_PRICE"))


DIRECT_SQL = ("select Item, cast(CasePrice * (1 - cast({d} as decimal(12,4))) + cast({t} as decimal(12,4)) as double) "
              "as Price from v_inventory")


@check("direct_query", DIRECT_SQL.format(d="'0.20'", t="'0.25'"))
def direct_query(spark):
    return catalog.direct_query(spark, DIRECT_SQL.format(d=":discount", t=":ticket"),
                                args={"discount": P.discount, "ticket": P.ticket})


@check("quote_requests", f"""with {PRICED},
q as (select *, nullif(regexp_extract(Supplier, '\\(([^)]+)\\)$', 1), '') as SUPPLR from checked
  where substr(Product_long, 1, 1) = 'Z')
select s.EMAIL, q.SUPPLR, q.Customer, q.Product, q.Product_long,
 case when not coalesce(q.Qty <= 1, false) then cast(q.Qty as varchar) end as QTY,
 q.Ship_Date, cast(q.Unit_Cost as double) as Unit_Cost
from q left join (select SUPPLR, EMAIL from v_supplier_contacts) s on q.SUPPLR = s.SUPPLR""")
def quote_requests(spark):
    return O.outlet(O.quote_requests(_priced(spark), spark.table("v_supplier_contacts")))


@check("missing_contact", f"""with {PRICED},
q as (select *, nullif(regexp_extract(Supplier, '\\(([^)]+)\\)$', 1), '') as SUPPLR from checked
  where substr(Product_long, 1, 1) = 'Z')
select s.EMAIL, q.SUPPLR, q.Customer, q.Product, q.Product_long,
 case when not coalesce(q.Qty <= 1, false) then cast(q.Qty as varchar) end as QTY,
 q.Ship_Date, cast(q.Unit_Cost as double) as Unit_Cost
from q left join (select SUPPLR, EMAIL from v_supplier_contacts) s on q.SUPPLR = s.SUPPLR
where s.EMAIL is null or trim(s.EMAIL) = ''""")
def missing_contact(spark):
    return O.outlet(O.missing_contact(O.quote_requests(_priced(spark), spark.table("v_supplier_contacts"))))


@check("union_orders", """select * from v_customer_confirmations
union all by name select * from v_dummy_confirmation""")
def union_orders(spark):
    return O.union_orders(spark.table("v_customer_confirmations"), spark.table("v_dummy_confirmation"))


@check("dummy_check", """with c as (select replace(Product, 'YKX', '') as Product, cast(coalesce(sum(Ordered), 0) as bigint) as Ordered
  from v_customer_confirmations where substr(Product, 1, 1) = 'Y' and replace(Product, 'YKX', '') is not null group by 1),
d as (select Product, cast(coalesce(sum(Dummy_Qty), 0) as bigint) as Dummy_Qty from v_dummy_confirmation
  where Product is not null group by Product)
select coalesce(d.Product, c.Product) as Product, d.Dummy_Qty, c.Ordered,
 case when coalesce(c.Ordered <> d.Dummy_Qty, true) then 1 else 0 end as FLAG
from d full join c on d.Product = c.Product""")
def dummy_check(spark):
    return O.dummy_check(spark.table("v_customer_confirmations"), spark.table("v_dummy_confirmation"))


TERMS = """select c_custkey as Customer, cast(0.10 + (c_custkey % 5) * 0.05 as decimal(12,4)) as TICKET,
 cast(case c_custkey % 3 when 0 then 0.10 when 1 then 0.20 else 0.25 end as decimal(12,4)) as DISCOUNT
from customer where c_custkey % 4 <> 0"""

PRICED_TERMS = f"""terms as ({TERMS}),
sets as (select l.*, coalesce(t.TICKET, 0.25) as TICKET, coalesce(t.DISCOUNT, 0.20) as DISCOUNT
  from v_customer_po_lines l left join terms t on l.Customer = t.Customer),
""" + (PRICED.replace("v_customer_po_lines l", "sets l").replace(", cast('0.25' as decimal(12,4)) as TICKET", "")
       .replace("cast('0.25' as decimal(12,4))", "TICKET").replace("cast('0.20' as decimal(12,4))", "DISCOUNT").lstrip())


@check("price_check_terms", f"with {PRICED_TERMS} select {CHECKED_OUT} from checked")
def price_check_terms(spark):
    return O.outlet(O.price_lines(_lines(spark), _inv(spark), P, spark.sql(TERMS)))


CODES = """select c_custkey as Customer, case c_custkey % 2 when 0 then 'KX' else 'QM' end as CODE
from customer where c_custkey % 10 <> 7"""
SET_LINES = """select o_custkey as Customer, l_orderkey as PO,
 case when l_partkey % 8 = 0 then 'N' else 'Y' || case o_custkey % 2 when 0 then 'KX' else 'QM' end end || 'P' || lpad(cast(l_partkey as string), 6, '0') as Product,
 cast(l_quantity as int) as Ordered from lineitem join orders on l_orderkey = o_orderkey"""
SET_DUMMY = """select o_custkey as Customer, l_orderkey as PO, 'P' || lpad(cast(l_partkey as string), 6, '0') as Product,
 cast(l_quantity as int) + case when l_partkey % 10 = 0 then 1 else 0 end as Dummy_Qty
from lineitem join orders on l_orderkey = o_orderkey where l_partkey % 25 <> 3"""


@check("dummy_check_orders", f"""with codes as ({CODES}), cl as ({SET_LINES}), dl as ({SET_DUMMY}),
c as (select x.Customer, PO, case when CODE is null then Product else replace(Product, 'Y' || CODE, '') end as Product,
   cast(sum(Ordered) as bigint) as Ordered
  from cl x left join codes on x.Customer = codes.Customer where Product like 'Y%' group by all),
d as (select Customer, PO, Product, cast(sum(Dummy_Qty) as bigint) as Dummy_Qty from dl group by all)
select coalesce(c.Customer, d.Customer) as Customer, coalesce(c.PO, d.PO) as PO, coalesce(c.Product, d.Product) as Product,
 Dummy_Qty, Ordered, case when coalesce(Ordered <> Dummy_Qty, true) then 1 else 0 end as FLAG
from c full join d on c.Customer = d.Customer and c.PO = d.PO and c.Product = d.Product""")
def dummy_check_orders(spark):
    return O.dummy_check(spark.sql(SET_LINES), spark.sql(SET_DUMMY), codes=spark.sql(CODES), keys=("Customer", "PO"))
