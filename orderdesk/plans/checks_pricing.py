"""Pricing checks (C6-C10, C18, G2-G5, G9, G10, G13, G16, J1, J4-J7, J10,
J16, B10-B12, U2, U3, W4, W5, F13, F14, F19)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.rules import money_text, ratio, round_ratio
from ..operators import pricing as PR
from ..session import ensure_checkpoint_dir
from ..sources import sinks
from .registry import check

# Oracle building blocks (DuckDB). Season '24', FX table as in params.
PREP = """
prep as (select * replace (coalesce(SELSTA, '') as SELSTA,
  case when coalesce(SELSTA = 'SO-NR', false) and coalesce(QOH <= 0, false) then 'OUT' else STATUS end as STATUS)
  from v_catalog_items where SEASON <= '24'),
inact as (select SUPPLR from prep where SUPPLR is not null group by SUPPLR
  having count(distinct PRODCT) = count(*) filter (where SELSTA = 'UNQ')
  union select SUPPLR from v_supplier_contacts where OUT = 'x'),
active as (select * from prep p where not exists (select 1 from inact i where i.SUPPLR = p.SUPPLR)),
req as (select a.*, s.EMAIL from active a join (select SUPPLR, EMAIL from v_supplier_contacts where SENT = '') s
  on a.SUPPLR = s.SUPPLR),
fx as (select cast(RATE as decimal(18,1)) as RATE, CURR, SYMBOL
  from (values ('1.0', 'USD', '$'), ('7.0', 'RMB', '¥'), ('30.0', 'NT', 'NT$')) t(RATE, CURR, SYMBOL))
"""


def currency_cte(src: str, name: str) -> str:
    return f"""{name}_raw as (select SUPPLR,
  coalesce(bool_or(not (COST is not distinct from COST_FOR)), false) as DIFFERS,
  round(cast(avg(cast(COST_FOR as double) / nullif(cast(COST as double), 0)) as decimal(18,6)), 1) as RATE
  from {src} group by SUPPLR),
{name} as (select c.SUPPLR, c.DIFFERS, cast(c.RATE as double) as RATE,
  case when c.DIFFERS then f.CURR end as CURR, case when c.DIFFERS then f.SYMBOL end as SYMBOL
  from {name}_raw c left join fx f on c.RATE = f.RATE)"""


PHOTO = ("concat_ws('/', 'https://images.example/catalog/product', substr(lower(PRODCT), 1, 1), "
         "substr(lower(PRODCT), 2, 1), lower(PRODCT) || '.jpg')")

REQUESTS = f"""{currency_cte('req', 'cur')},
sizes as (select SUPPLR, count(*) as N_ITEMS from req group by SUPPLR),
requests as (select r.SUPPLR, r.Supplier_name, r.EMAIL, r.PRODCT, r.STATUS, r.ITEST,
  cast(case when c.DIFFERS then r.COST_FOR else r.COST end as double) as COST,
  case when c.DIFFERS then c.CURR else 'USD' end as CURR,
  case when c.DIFFERS then c.SYMBOL else '$' end as SYMBOL,
  case when z.N_ITEMS < 99 then {PHOTO} end as PHOTO, z.N_ITEMS,
  cast(row_number() over (partition by r.SUPPLR order by r.PRODCT) as integer) as ROW_NO
  from req r left join cur c on r.SUPPLR = c.SUPPLR left join sizes z on r.SUPPLR = z.SUPPLR)"""

MONEY = "format('{{:,.2f}}', cast(round({x}, 2) as double))"

COVER = """
reviewed as (select SUPPLR, EXCHANGE_RATE from v_supplier_contacts
  where coalesce(PRINTED <> 1, true) and coalesce(REVIEWED in (1, 2), false)),
covered as (select distinct SUPPLR from v_cover_sheets c where SUPPLR is not null
 and not exists (select 1 from v_catalog_items i where i.PRODCT = c.PRODCT)),
wl as (select * from reviewed r where not exists (select 1 from covered c where c.SUPPLR = r.SUPPLR)),
witems as (select * from v_catalog_items i where exists (select 1 from wl where wl.SUPPLR = i.SUPPLR)),
dups as (select distinct SUPPLR from (select SUPPLR, PRODCT from v_vendor_quotes group by SUPPLR, PRODCT having count(*) > 1) d),
cj as (select i.*, q.NEW_COST, q.MOQ, q.PRODCT is not null as QUOTED, d.SUPPLR is not null as HAS_DUP
  from witems i left join v_vendor_quotes q on i.SUPPLR = q.SUPPLR and i.PRODCT = q.PRODCT
  left join dups d on i.SUPPLR = d.SUPPLR),
cn as (select *, case when coalesce(STATUS in ('P', 'PP'), false) and coalesce(QOH <= 0, false) then 'OUT'
  when NEW_COST is null and coalesce(SELSTA = 'UNQ', false) then 'UNQ'
  when NEW_COST is null and coalesce(QOH > 0, false) and coalesce(STATUS in ('P', 'PP'), false) then 'old'
  when NEW_COST is null then 'nan' else 'new' end as PRICE_NOTE from cj),
cover as (select SUPPLR, PRODCT, ITEST, SELSTA, STATUS, QOH, MOQ,
  cast(coalesce(round(cast((cast(NEW_COST as double) / nullif(cast(COST_FOR as double), 0) - 1) * 100 as decimal(18,6)), 1), 0) as double) as PCT_CHANGE,
  cast(case when PRICE_NOTE = 'new' then NEW_COST when PRICE_NOTE = 'old' then round(COST_FOR, 2) end as double) as PRICE,
  PRICE_NOTE,
  case when PRICE_NOTE in ('OUT', 'UNQ') then PRICE_NOTE
   when PRICE_NOTE = 'old' then format('{:,.2f}', cast(round(COST_FOR, 2) as double))
   when PRICE_NOTE = 'new' then format('{:,.2f}', cast(round(NEW_COST, 2) as double)) end as PRICE_TEXT,
  case when coalesce(SELSTA = 'SO-NR', false) or PRICE_NOTE = 'UNQ' or QUOTED then 'both' else 'left_only' end as ORIGIN,
  case when HAS_DUP then case when coalesce(MOQ = 0, false) then 1 else 0 end end as SORT_KEY
  from cn),
flags as (select SUPPLR, count(*) as N_ROWS,
  coalesce(bool_or(PRICE_NOTE = 'nan'), false) as NAN_ERROR,
  coalesce(bool_or(ORIGIN <> 'both'), false) as SUPPLR_FLAG,
  coalesce(bool_or(SORT_KEY is not null), false) as HAS_DUP,
  sum(cast(PCT_CHANGE as decimal(18,1))) as S
  from cover group by SUPPLR)
"""


def _items(spark):
    return spark.table("v_catalog_items")


def _contacts(spark):
    return spark.table("v_supplier_contacts")


def _quotes(spark):
    return spark.table("v_vendor_quotes")


def _covered(spark):
    """Stand-in for the vendors whose covers exist: a cover row names an item outside the catalogue."""
    return spark.table("v_cover_sheets").join(_items(spark).select("PRODCT"), "PRODCT", "left_anti")


def _cover(spark):
    wl = PR.cover_worklist(_contacts(spark), _covered(spark))
    return PR.cover_sheet(_items(spark), _quotes(spark), wl)


@check("season_filter", "select * from v_catalog_items where SEASON <= '24'")
def season_filter(spark):
    return _items(spark).where(F.col("SEASON") <= F.lit("24"))


@check("reviewed_vendors", """select SUPPLR, EXCHANGE_RATE from v_supplier_contacts
where coalesce(PRINTED <> 1, true) and coalesce(REVIEWED in (1, 2), false)""")
def reviewed_vendors(spark):
    return PR.reviewed_vendors(_contacts(spark))


@check("unsent_vendors", "select SUPPLR, EMAIL from v_supplier_contacts where SENT = ''")
def unsent_vendors(spark):
    return PR.unsent_vendors(_contacts(spark))


@check("cover_reruns", f"""with {COVER},
kept as (select c.SUPPLR from covered c where c.SUPPLR is not null),
due as (select distinct SUPPLR from cover),
todo as (select count(distinct SUPPLR) as n from wl)
select SUPPLR, (select n from todo) as FIRST_TODO, cast(case when SUPPLR in (select SUPPLR from due) then 2 else 1 end as integer) as RUN,
 cast(case when SUPPLR in (select SUPPLR from due) then (select count(*) from cover c where c.SUPPLR = u.SUPPLR) else 1 end as bigint) as N_ROWS
from (select SUPPLR from kept union select SUPPLR from due) u""")
def cover_reruns(spark):
    """A16 + U3: covers of an earlier run are in the per-vendor output; a second
    run writes only the vendors that the output's own folders do not name."""
    path = f"{ensure_checkpoint_dir(spark)}/covers-{uuid.uuid4().hex}"
    earlier = _covered(spark).where(F.col("SUPPLR").isNotNull()).select("SUPPLR").distinct()
    sinks.write_per_vendor(earlier.withColumn("RUN", F.lit(1)), path)
    worklist = PR.cover_worklist(_contacts(spark), sinks.vendor_partitions(spark, path))
    todo = worklist.agg(F.countDistinct("SUPPLR")).first()[0]
    cover = PR.cover_sheet(_items(spark), _quotes(spark), worklist).select("SUPPLR", F.lit(2).alias("RUN"))
    sinks.write_per_vendor(cover, path)
    done = spark.read.schema("RUN int, SUPPLR string").option("header", True).csv(path)
    return done.groupBy("SUPPLR").agg(F.lit(todo).cast("bigint").alias("FIRST_TODO"), F.max("RUN").alias("RUN"),
                                      F.count(F.lit(1)).alias("N_ROWS"))


@check("cover_worklist", f"with {COVER} select * from wl")
def cover_worklist(spark):
    return PR.cover_worklist(_contacts(spark), _covered(spark))


@check("inactive_vendors", f"with {PREP} select distinct SUPPLR from inact")
def inactive_vendors(spark):
    prepared = PR.prepare_items(_items(spark))
    return PR.inactive_vendors(prepared, PR.listed_inactive(_contacts(spark)))


@check("anti_inactive", f"with {PREP} select * from active")
def anti_inactive(spark):
    prepared = PR.prepare_items(_items(spark))
    inactive = PR.inactive_vendors(prepared, PR.listed_inactive(_contacts(spark)))
    return prepared.join(inactive, "SUPPLR", "left_anti")


@check("join_inner_contacts", f"with {PREP} select * from req")
def join_inner_contacts(spark):
    return PR.request_items(_items(spark), _contacts(spark))


@check("season_exceptions", f"with {PREP} select * from req where coalesce(SEASON <> '24', true)")
def season_exceptions(spark):
    return PR.season_exceptions(PR.request_items(_items(spark), _contacts(spark)))


@check("vendor_directory", f"with {PREP} select distinct SUPPLR, Supplier_name, EMAIL from req")
def vendor_directory(spark):
    return PR.vendor_directory(PR.request_items(_items(spark), _contacts(spark)))


@check("fx_inference", f"with {PREP}, {currency_cte('v_catalog_items', 'cur')} select * from cur")
def fx_inference(spark):
    return PR.infer_currency(_items(spark), PR.fx_table(spark))


@check("price_requests", f"with {PREP}, {REQUESTS} select * from requests")
def price_requests(spark):
    return PR.price_requests(_items(spark), _contacts(spark), PR.fx_table(spark))


@check("vendor_row_numbers", f"with {PREP}, {REQUESTS} select SUPPLR, PRODCT, ROW_NO from requests")
def vendor_row_numbers(spark):
    return PR.price_requests(_items(spark), _contacts(spark), PR.fx_table(spark)).select(
        "SUPPLR", "PRODCT", "ROW_NO")


@check("vendor_partitions", f"with {PREP}, {REQUESTS} select * from requests")
def vendor_partitions(spark):
    from ..sources import sinks
    req = PR.price_requests(_items(spark), _contacts(spark), PR.fx_table(spark))
    return sinks.per_vendor_layout(req, "SUPPLR", ["ROW_NO"])


@check("cover_sheet", f"with {COVER} select * from cover")
def cover_sheet(spark):
    return _cover(spark)


@check("cover_flags", f"""with {COVER}
select f.SUPPLR, N_ROWS, NAN_ERROR, SUPPLR_FLAG, HAS_DUP, cast(S as double) as SUM_CHANGE, S = 0 as NO_CHANGE,
 (case when NAN_ERROR then '_nan_error' else '' end) || (case when SUPPLR_FLAG then '_supplr_flag' else '' end) as FILE_FLAG,
 r.EXCHANGE_RATE
from flags f left join reviewed r on f.SUPPLR = r.SUPPLR""")
def cover_flags(spark):
    return PR.cover_flags(_cover(spark), PR.reviewed_vendors(_contacts(spark)))


@check("no_change_vendors", f"""with {COVER}
select SUPPLR, N_ROWS, cast(S as double) as SUM_CHANGE, S = 0 as NO_CHANGE from flags""")
def no_change_vendors(spark):
    return PR.no_change_vendors(_cover(spark))


@check("duplicate_quotes", f"""with {COVER}
select SUPPLR, PRODCT, MOQ, PRICE, PRICE_NOTE, SORT_KEY,
 row_number() over (partition by SUPPLR, PRODCT order by SORT_KEY, MOQ, PRICE) > 1 as IS_DUP
from cover where SORT_KEY is not null""")
def duplicate_quotes(spark):
    return PR.duplicate_quotes(_cover(spark))


REPORT = """rep as (select distinct SUPPLR, PRODCT from v_cover_sheets),
fm as (select coalesce(i.SUPPLR, r.SUPPLR) as SUPPLR, coalesce(i.PRODCT, r.PRODCT) as PRODCT,
  i.Supplier_name, i.SEASON, i.SELSTA, i.STATUS, i.ITEST, i.QOH, i.COST, i.COST_FOR,
  case when i.PRODCT is not null and r.PRODCT is not null then 'both'
   when i.PRODCT is not null then 'left_only' else 'right_only' end as MERGE
  from v_catalog_items i full join rep r on i.SUPPLR = r.SUPPLR and i.PRODCT = r.PRODCT)"""


def _report(spark):
    """Stand-in for the landed-cost report: the cover sheets as they stand."""
    return spark.table("v_cover_sheets").select("SUPPLR", "PRODCT")


@check("join_full_marker", f"with {REPORT} select * from fm")
def join_full_marker(spark):
    return PR.full_marker(_items(spark), _report(spark))


@check("report_check", f"""with {REPORT},
per as (select SUPPLR, count(*) filter (where MERGE <> 'both') as N_ERRORS,
  arg_min_null(SEASON, PRODCT) filter (where MERGE <> 'both') as FIRST_SEASON,
  coalesce(bool_or(MERGE <> 'both' and ITEST = 'R'), false) as HAS_RETURN from fm group by SUPPLR)
select *, case when N_ERRORS = 0 then 'ok' when coalesce(FIRST_SEASON <> '25', true) and not HAS_RETURN then 'ignore'
 else 'error' end as STATUS from per""")
def report_check(spark):
    return PR.report_check(_items(spark), _report(spark))


@check("price_audit", """select c.PRODCT, i.PRODCT as Item, c.SUPPLR, c.COST_TEXT,
 cast(round(i.COST, 2) as double) as FIRST_COST,
 case when coalesce(c.COST_TEXT = 'OUT', false) then 0
  when coalesce(try_cast(replace(c.COST_TEXT, ',', '') as decimal(12,2)) <> round(i.COST, 2), true) then 1 else 0 end as FLAG
from v_cover_sheets c full join v_catalog_items i on c.PRODCT = i.PRODCT""")
def price_audit(spark):
    return PR.price_audit(spark.table("v_cover_sheets"), _items(spark))


WORD = "string_split(trim(regexp_replace({x}, '\\s+', ' ', 'g')), ' ')"
NEWY = """ny as (select Supplier, Longname, Item, cast(year(date) as integer) as YEAR from v_new_items where year(date) >= 2020),
cnt as (select Supplier, YEAR, count(Item) as N_ITEMS from ny group by Supplier, YEAR)"""
YEARS = """'{' || string_agg('"' || YEAR || '":' || N_ITEMS, ',' order by YEAR) || '}' as BY_YEAR"""


@check("new_items_by_year", f"with {NEWY} select * from cnt")
def new_items_by_year(spark):
    return PR.new_items_by_year(spark.table("v_new_items"))


def _years_text(df):
    return df.withColumn("BY_YEAR", F.to_json("BY_YEAR"))


@check("new_items_pivot", f"with {NEWY} select Supplier, {YEARS} from cnt group by Supplier")
def new_items_pivot(spark):
    return _years_text(PR.new_items_pivot(PR.new_items_by_year(spark.table("v_new_items"))))


@check("vendor_new_items", f"""with {NEWY},
supp as (select distinct Supplier, Longname, substr(Supplier, 1, 4) as "primary",
  {WORD.format(x='Longname')}[1] as shortname from ny),
g as (select "primary", shortname, string_agg(Supplier, '' order by Supplier, Longname) as Supplier,
  string_agg(Longname, '' order by Supplier, Longname) as Longname
  from supp where "primary" is not null and shortname is not null group by "primary", shortname),
sums as (select "primary", shortname, YEAR, sum(N_ITEMS) as N_ITEMS from supp join cnt using (Supplier) group by all),
wide as (select "primary", shortname, {YEARS} from sums group by all)
select substr("primary", 1, 1) as ORIGIN, "primary", Supplier,
 array_to_string({WORD.format(x='Longname')}[1:3], ' ') as Longname, BY_YEAR
from g join wide using ("primary", shortname)""")
def vendor_new_items(spark):
    return _years_text(PR.vendor_new_items(spark.table("v_new_items")))


@check("inactive_cover", f"""with {PREP}
select SUPPLR, Supplier_name, PRODCT, ITEST, SELSTA, QOH, STATUS,
 case when coalesce(ITEST <> 'R', true) and coalesce(QOH <= 0, false) then 'OUT'
  when coalesce(SELSTA = 'UNQ', false) then 'UNQ'
  else format('{{:,.2f}}', cast(round(COST, 2) as double)) end as COST_TEXT
from prep where SUPPLR in (select SUPPLR from inact)""")
def inactive_cover(spark):
    return PR.inactive_cover(_items(spark), _contacts(spark))


@check("money_text", """select PRODCT, format('{:,.2f}', cast(round(COST, 2) as double)) as COST_TEXT,
 format('{:,.2f}', cast(round(COST_FOR, 2) as double)) as COST_FOR_TEXT,
 printf('%.2f', cast(round(COST, 2) as double)) as COST_PLAIN from v_catalog_items""")
def money_text_check(spark):
    return _items(spark).select("PRODCT", money_text("COST").alias("COST_TEXT"),
                                money_text("COST_FOR").alias("COST_FOR_TEXT"),
                                money_text("COST", thousands=False).alias("COST_PLAIN"))


@check("pct_change", """select i.SUPPLR, i.PRODCT, q.MOQ,
 cast(q.NEW_COST as double) / nullif(cast(i.COST_FOR as double), 0) - 1 as FRACTION,
 cast(round(cast((cast(q.NEW_COST as double) / nullif(cast(i.COST_FOR as double), 0) - 1) * 100 as decimal(18,6)), 1) as double) as PCT
from v_catalog_items i join v_vendor_quotes q on i.SUPPLR = q.SUPPLR and i.PRODCT = q.PRODCT""")
def pct_change(spark):
    j = _items(spark).join(_quotes(spark), ["SUPPLR", "PRODCT"], "inner")
    frac = ratio("NEW_COST", "COST_FOR") - 1
    return j.select("SUPPLR", "PRODCT", "MOQ", frac.alias("FRACTION"), round_ratio(frac * 100, 1).alias("PCT"))


@check("photo_link", f"select Item, {PHOTO.replace('PRODCT', 'Item')} as PHOTO from v_inventory")
def photo_link(spark):
    return spark.table("v_inventory").select("Item", S.photo_link("Item").alias("PHOTO"))


@check("price_change_form", f"""with {PREP}, {REQUESTS},
best as (select SUPPLR, PRODCT, cast(min(NEW_COST) as double) as NEW_COST from v_vendor_quotes group by all)
select r.*, b.NEW_COST, b.NEW_COST / nullif(r.COST, 0) - 1 as CHANGE
from requests r left join best b on r.SUPPLR = b.SUPPLR and r.PRODCT = b.PRODCT""")
def price_change_form(spark):
    return PR.with_new_costs(PR.price_requests(_items(spark), _contacts(spark), PR.fx_table(spark)), _quotes(spark))


COVER_REPORT = COVER.replace("witems as (select * from v_catalog_items i", "witems as (select * from ri i").replace(
    "as SORT_KEY", "as SORT_KEY, DATA_ISSUE")


@check("cover_report", f"""with {REPORT},
bad as (select SUPPLR, count(*) filter (where MERGE <> 'both') as n,
  arg_min_null(SEASON, PRODCT) filter (where MERGE <> 'both') as first_season,
  coalesce(bool_or(MERGE <> 'both' and ITEST = 'R'), false) as returns from fm group by SUPPLR),
ri as (select fm.* exclude (MERGE), case when MERGE = 'both' then '' else MERGE end as DATA_ISSUE from fm
  where SUPPLR in (select SUPPLR from bad where n = 0 or (coalesce(first_season <> '25', true) and not returns))),
{COVER_REPORT}
select * from cover""")
def cover_report(spark):
    wl = PR.cover_worklist(_contacts(spark), _covered(spark))
    return PR.cover_sheet(PR.reported_items(_items(spark), _report(spark)), _quotes(spark), wl)
