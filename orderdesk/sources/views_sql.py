"""Fixture views over the driver tables (Part A of FIXTURES.md).

Each text is valid in both Spark SQL and DuckDB, so the same input feeds
the Spark jobs and the SQL oracles.
"""

from __future__ import annotations

VIEW_SQL: dict[str, str] = {}

VIEW_SQL["v_open_po_lines"] = """
select PURORD, case when k % 10 = 3 then substr(code,1,1) || ' ' || substr(code,2) else code end as SUPPLR, PRODCT, ORDQTY,
 floor(ORDQTY * (case when k % 8 = 0 then part % 10 when (k - k % 2) % 10 = 6 then 20 else part % 21 end) / 20) as OUTQTY, case when ln % 2 = 0 then 0 else ORDQTY end as INTQTY,
 case when PURORD % 97 = 0 then 'N/A' else cast(due as string) end as CONDAT, case when PURORD % 97 = 0 and (k - k % 2) % 10 = 2 then 'N/A' else cast(due + cast(shift as int) as string) end as NEWCONDAT, shift as DATEDFF,
 case when o_orderstatus = 'O' then 'S' when o_orderstatus = 'F' then case when k % 4 = 0 then 'S' else 'C' end when ln % 2 = 0 then 'P' else 'D' end as TYPE
 from (select l_orderkey as PURORD, l_suppkey as k, l_partkey as part, l_linenumber as ln, case when (l_suppkey - l_suppkey % 2) % 10 = 2 then 0 else (l_linenumber - 1) * 26 end as shift, (case l_suppkey % 3 when 0 then 'C' when 1 then 'H' else 'T' end || lpad(cast(l_suppkey as string),5,'0')) as code, (case l_partkey % 5 when 0 then 'Z' when 1 then 'Y' else 'A' end || 'B' || lpad(cast(l_partkey as string),6,'0')) as PRODCT, l_quantity as ORDQTY, o_orderstatus,
 date '1998-06-15' + cast(l_suppkey * 57 % 110 - 50 + l_orderkey % 15 as int) as due from lineitem join orders on l_orderkey = o_orderkey) t
"""

VIEW_SQL["v_supplier_contacts"] = """
select (case s_suppkey % 3 when 0 then 'C' when 1 then 'H' else 'T' end || lpad(cast(s_suppkey as string),5,'0')) as SUPPLR, s_name as SUPPLR_NAME, case when s_suppkey % 17 = 5 then null else 'v' || cast(s_suppkey - s_suppkey % 2 as string) || '@vendor.test' end as EMAIL,
 case when s_suppkey % 4 = 1 then '1' else '' end as SENT, case when s_suppkey % 23 = 7 then 'x' else '' end as OUT,
 s_suppkey % 3 as REVIEWED, case when s_suppkey % 5 = 0 then 1 else 0 end as PRINTED,
 case s_suppkey % 3 when 0 then 'RMB 7.00' when 1 then 'USD' else 'NT 30.00' end as EXCHANGE_RATE from supplier
"""

VIEW_SQL["v_catalog_items"] = """
select PRODCT, (case sk % 3 when 0 then 'C' when 1 then 'H' else 'T' end || lpad(cast(sk as string),5,'0')) as SUPPLR, 'Vendor ' || cast(sk as string) || ' Ltd.' as Supplier_name, SEASON, SELSTA, STATUS, ITEST, QOH, COST, case sk % 3 when 0 then COST*7 when 1 then COST else COST*30 end as COST_FOR from (
 select (case p_partkey % 5 when 0 then 'Z' when 1 then 'Y' else 'A' end || 'B' || lpad(cast(p_partkey as string),6,'0')) as PRODCT, (p_partkey % (select count(*) from supplier)) as sk, case p_size % 4 when 0 then '23' when 1 then '24' when 2 then '25' else null end as SEASON,
 case when (p_partkey % (select count(*) from supplier)) % 11 = 4 then 'UNQ' else case p_size % 5 when 0 then 'UNQ' when 1 then 'SO-NR' when 2 then null else '' end end as SELSTA,
 case p_partkey % 3 when 0 then 'P' when 1 then 'PP' else 'A' end as STATUS, case when p_size % 7 = 0 then 'R' when p_size % 7 = 1 then null else 'N' end as ITEST,
 p_size - 10 as QOH, cast(p_retailprice as decimal(12,2)) * 0.01 as COST from part) t
"""

VIEW_SQL["v_vendor_quotes"] = """
select PRODCT, (case sk % 3 when 0 then 'C' when 1 then 'H' else 'T' end || lpad(cast(sk as string),5,'0')) as SUPPLR, cast(case when p_partkey % 19 = 0 then null when sk % 13 = 2 then COST_FOR else COST_FOR * (97 + p_partkey % 7) * 0.01 end as decimal(12,2)) as NEW_COST, p_size as MOQ from (
 select p_partkey, p_size, (case p_partkey % 5 when 0 then 'Z' when 1 then 'Y' else 'A' end || 'B' || lpad(cast(p_partkey as string),6,'0')) as PRODCT, (p_partkey % (select count(*) from supplier)) as sk, cast(p_retailprice as decimal(12,2)) * 0.01 * (case (p_partkey % (select count(*) from supplier)) % 3 when 0 then 7 when 1 then 1 else 30 end) as COST_FOR from part) t where p_partkey % 13 <> 0 or sk % 13 = 2
 union all select (case p_partkey % 5 when 0 then 'Z' when 1 then 'Y' else 'A' end || 'B' || lpad(cast(p_partkey as string),6,'0')), (case (p_partkey % (select count(*) from supplier)) % 3 when 0 then 'C' when 1 then 'H' else 'T' end || lpad(cast((p_partkey % (select count(*) from supplier)) as string),5,'0')), cast(cast(p_retailprice as decimal(12,2)) * 0.1 as decimal(12,2)), 0 from part where p_partkey % 29 = 1 and (p_partkey % (select count(*) from supplier)) % 13 <> 2
"""

VIEW_SQL["v_inventory"] = """
select (case p_partkey % 5 when 0 then 'Z' when 1 then 'Y' else 'A' end || 'B' || lpad(cast(p_partkey as string),6,'0')) as Item, case when p_partkey % 31 = 2 then null else 'A' end as Status, p_size * 10 - 40 as NETAVAIL, case when p_partkey % 50 = 3 then 0 else 6 end as CaseQty,
 cast(p_retailprice as decimal(12,2)) * 0.01 as CasePrice, cast(p_retailprice as decimal(12,2)) * 12 * 0.001 as SplitPrice, 'Vendor ' || cast((p_partkey % (select count(*) from supplier)) as string) || ' (' || (case (p_partkey % (select count(*) from supplier)) % 3 when 0 then 'C' when 1 then 'H' else 'T' end || lpad(cast((p_partkey % (select count(*) from supplier)) as string),5,'0')) || ')' as Supplier, (case p_partkey % 5 when 0 then 'Z' when 1 then 'Y' else 'A' end || 'B' || lpad(cast(p_partkey as string),6,'0')) as Product_long from part
"""

VIEW_SQL["v_customer_po_lines"] = """
select PO, Customer, Product, Qty, Ship_Date, Unit_Cost, Qty * Unit_Cost as Ext_Cost from (
 select l_orderkey as PO, o_custkey as Customer, (case l_partkey % 5 when 0 then 'Z' when 1 then 'Y' else 'A' end || 'B' || lpad(cast(l_partkey as string),6,'0')) as Product, cast(l_quantity as int) as Qty, cast(l_shipdate as date) as Ship_Date,
 cast(round(cast(900 + (l_partkey % 1000) * 0.1 as decimal(12,2)) * (case when cast(l_quantity as int) % 6 = 0 then 0.008 else 0.012 end) + 0.25 + 0.0001, 2) + case when l_partkey % 4 = 0 then 0.05 else 0 end as decimal(12,2)) as Unit_Cost
 from lineitem join orders on l_orderkey=o_orderkey) t
"""

VIEW_SQL["v_new_items"] = """
select (case (p_partkey % (select count(*) from supplier)) % 3 when 0 then 'C' when 1 then 'H' else 'T' end || lpad(cast((p_partkey % (select count(*) from supplier)) as string),5,'0')) as Supplier, 'Vendor' || cast((p_partkey % (select count(*) from supplier)) % 7 as string) || ' Trading Co. Ltd. (' || (case (p_partkey % (select count(*) from supplier)) % 3 when 0 then 'C' when 1 then 'H' else 'T' end || lpad(cast((p_partkey % (select count(*) from supplier)) as string),5,'0')) || ')' as Longname, (case p_partkey % 5 when 0 then 'Z' when 1 then 'Y' else 'A' end || 'B' || lpad(cast(p_partkey as string),6,'0')) as Item, cast(date '2018-01-01' + cast(p_partkey * 37 % 2600 as int) as date) as date from part
"""

VIEW_SQL["v_messages"] = """
select conv_id, turn, role as sender, 'V' || cast(conv_id % 40 as string) || '@Vendor.test' as email, cast(date '2024-01-01' + cast(conv_id * 3 % 60 + turn as int) as date) as receive, case when turn % 3 = 0 then 'FCR_' || cast(conv_id as string) || '.pdf' else 'note.txt' end as attachment, text as body from conversations
"""

VIEW_SQL["v_extracted_rows"] = """
select doc_id, row_no, case when row_no % 3 = 0 then null else style end as style, qty_text, ext_text, upc_text from (
 select l_orderkey as doc_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as row_no,
 case when l_partkey % 41 = 1 then 'Total: n/a' else (case l_partkey % 5 when 0 then 'Z' when 1 then 'Y' else 'A' end || 'B' || lpad(cast(l_partkey as string),6,'0')) end as style, 'EA ' || cast(cast(l_quantity as int) as string) as qty_text,
 '$' || cast(cast(l_extendedprice as decimal(12,2)) as string) as ext_text, 'UPC ' || cast(412000000000 + l_partkey as string) as upc_text from lineitem) t
"""

VIEW_SQL["v_memo_lines"] = """
select cast(floor(p_partkey / 20) as bigint) as memo_id, p_partkey % 20 as line_no, case p_partkey % 60 when 15 then 'PLEASE NOTE THE FOLLOWING CHANGES' when 38 then 'ITEMS HAVE BEEN ADDED TO THE LINE'
 when 57 then 'AGAIN FOR SALE' else 'ITEM ' || (case p_partkey % 5 when 0 then 'Z' when 1 then 'Y' else 'A' end || 'B' || lpad(cast(p_partkey as string),6,'0')) || ' AND A' || cast(p_partkey + 1000 as string) || 'X ' || p_name end as text from part
"""

VIEW_SQL["v_cover_sheets"] = """
select (case p_partkey % 5 when 0 then 'Z' when 1 then 'Y' else 'A' end || 'B' || lpad(cast(p_partkey as string),6,'0')) as PRODCT, (case (p_partkey % (select count(*) from supplier)) % 3 when 0 then 'C' when 1 then 'H' else 'T' end || lpad(cast((p_partkey % (select count(*) from supplier)) as string),5,'0')) as SUPPLR, case when p_partkey % 9 = 0 then 'OUT' else cast(cast(cast(p_retailprice as decimal(12,2)) * 0.01 + case when p_partkey % 7 = 0 then 0.10 else 0 end as decimal(12,2)) as string) end as COST_TEXT from part where p_partkey % 17 <> 0
 union all select 'XX' || cast(p_partkey as string), (case (p_partkey % (select count(*) from supplier)) % 3 when 0 then 'C' when 1 then 'H' else 'T' end || lpad(cast((p_partkey % (select count(*) from supplier)) as string),5,'0')), '1.00' from part where p_partkey % 230 = 1
"""

VIEW_SQL["v_customer_confirmations"] = """
select l_orderkey as doc_id, case when l_partkey % 8 = 0 then 'N' else 'YKX' end || 'P' || lpad(cast(l_partkey as string),6,'0') as Product, cast(l_quantity as int) as Ordered from lineitem
"""

VIEW_SQL["v_dummy_confirmation"] = """
select 'P' || lpad(cast(l_partkey as string),6,'0') as Product, cast(sum(cast(l_quantity as int)) + case when l_partkey % 10 = 0 then 1 else 0 end as bigint) as Dummy_Qty from lineitem where l_partkey % 25 <> 3 group by l_partkey
"""

VIEW_SQL["v_item_gtin"] = """
select (case p_partkey % 5 when 0 then 'Z' when 1 then 'Y' else 'A' end || 'B' || lpad(cast(p_partkey as string),6,'0')) as PRODCT, (case (p_partkey % (select count(*) from supplier)) % 3 when 0 then 'C' when 1 then 'H' else 'T' end || lpad(cast((p_partkey % (select count(*) from supplier)) as string),5,'0')) as SUPPLR, cast(412000000000 + p_partkey as string) as GTIN, p_partkey % 6 as TYPE, p_name as GTINDESC, p_size as TOTSKUQTY from part
"""

VIEW_SQL["v_vendor_listing"] = """
select case when s_suppkey % 29 = 3 then null when s_suppkey % 31 = 4 then 'T999' else (case s_suppkey % 3 when 0 then 'C' when 1 then 'H' else 'T' end || lpad(cast(s_suppkey as string),5,'0')) end as SUPPLR, s_name as SUPPLRDES,
 case when s_suppkey % 6 = 0 then 'new' || cast(s_suppkey as string) || '@vendor.test' else 'v' || cast(s_suppkey - s_suppkey % 2 as string) || '@vendor.test' end as EMAIL from supplier
"""
