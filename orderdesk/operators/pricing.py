"""Vendor pricing: price requests, currency inference, cover sheets, report
check, system price audit, new items per vendor (C6-C10, C18, G2-G5, G9, G10,
G13, G16, J1, J4-J7, J10, J16, B10-B12, U2, U3, W4, W5).

All vendors are handled in one job: the reference's per-vendor loop becomes
the ``SUPPLR`` key of joins and aggregations. Per-vendor figures (currency,
item count, flags) are ``groupBy`` results joined back on ``SUPPLR`` - never
a window over a whole vendor, so a vendor with a third of all items is still
pre-aggregated in every task and split by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.rules import any_flag, flag, fresh_key, money_text, ne, ratio, truthy
from ..params import (FX_TABLE, LONGNAME_FIXES, PHOTO_ITEM_LIMIT, FIRST_YEAR,
                      REPORT_YEAR, SEASON)
from .windows import row_numbers


# --- sheets ----------------------------------------------------------------

def reviewed_vendors(contacts: DataFrame) -> DataFrame:
    """Vendors reviewed (1 or 2) and not yet printed, with their exchange rate."""
    return contacts.where(ne("PRINTED", F.lit(1)) & truthy(F.col("REVIEWED").isin(1, 2))).select(
        "SUPPLR", "EXCHANGE_RATE")


def unsent_vendors(contacts: DataFrame) -> DataFrame:
    """Vendors not yet sent a request (SENT is blank)."""
    return contacts.where(truthy(F.col("SENT") == "")).select("SUPPLR", "EMAIL")


def listed_inactive(contacts: DataFrame) -> DataFrame:
    """Vendors marked OUT='x' on the sheet."""
    return contacts.where(truthy(F.col("OUT") == "x")).select("SUPPLR")


def cover_worklist(contacts: DataFrame, covered: DataFrame) -> DataFrame:
    """Reviewed vendors that have no cover sheet yet (anti join)."""
    done = covered.select("SUPPLR").where(F.col("SUPPLR").isNotNull()).distinct()
    return reviewed_vendors(contacts).join(done, "SUPPLR", "left_anti")


# --- currency --------------------------------------------------------------

def fx_table(spark: SparkSession, table=FX_TABLE) -> DataFrame:
    """Rate -> currency -> symbol lookup (a parameter of a few rows)."""
    return spark.createDataFrame([(str(r), c, s) for r, c, s in table], "RATE string, CURR string, SYMBOL string") \
        .select(F.col("RATE").cast("decimal(18,1)").alias("RATE"), "CURR", "SYMBOL")


def currency_aggs(cost: str = "COST", cost_for: str = "COST_FOR") -> list:
    """G9 aggregates: does foreign cost differ anywhere (two nulls count as
    equal), and the mean rate rounded to one digit."""
    return [any_flag(~F.col(cost).eqNullSafe(F.col(cost_for))).alias("DIFFERS"),
            F.round(F.avg(ratio(cost_for, cost)).cast("decimal(18,6)"), 1).alias("RATE")]


def name_currency(per: DataFrame, fx: DataFrame) -> DataFrame:
    """Currency and symbol of each rate (null when not in the table or
    when the costs do not differ). ``fx`` holds a handful of parameter rows:
    a size-bounded broadcast."""
    out = per.join(F.broadcast(fx), "RATE", "left")
    return out.withColumns({"RATE": F.col("RATE").cast("double"),
                            "CURR": F.when(F.col("DIFFERS"), F.col("CURR")),
                            "SYMBOL": F.when(F.col("DIFFERS"), F.col("SYMBOL"))})


def infer_currency(items: DataFrame, fx: DataFrame, key: str = "SUPPLR",
                   cost: str = "COST", cost_for: str = "COST_FOR") -> DataFrame:
    """G9 + J16: per vendor, whether foreign cost differs from cost, the mean
    rate and its currency."""
    per = items.groupBy(key).agg(*currency_aggs(cost, cost_for))
    return name_currency(per, fx).select(key, "DIFFERS", "RATE", "CURR", "SYMBOL")


# --- price requests --------------------------------------------------------

def prepare_items(items: DataFrame, season: str = SEASON) -> DataFrame:
    """C6 steps 1-3: blank SELSTA, current season only, STATUS='OUT' for
    SO-NR items without stock."""
    out = items.withColumn("SELSTA", F.coalesce(F.col("SELSTA"), F.lit("")))
    out = out.where(F.col("SEASON") <= F.lit(season))
    out_status = truthy(F.col("SELSTA") == "SO-NR") & truthy(F.col("QOH") <= 0)
    return out.withColumn("STATUS", F.when(out_status, F.lit("OUT")).otherwise(F.col("STATUS")))


def inactive_vendors(items: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """G2 + U2: vendors whose items are all UNQ, united with the sheet list."""
    per = items.where(F.col("SUPPLR").isNotNull()).groupBy("SUPPLR").agg(
        F.countDistinct("PRODCT").alias("_n"), F.count_if(F.col("SELSTA") == "UNQ").alias("_unq"))
    out = per.where(F.col("_n") == F.col("_unq")).select("SUPPLR")
    if listed is not None:
        out = out.union(listed.select("SUPPLR"))
    return out.distinct()


def request_items(items: DataFrame, contacts: DataFrame, season: str = SEASON) -> DataFrame:
    """C6 up to the contact join: active vendors' current items (J10) with
    the e-mail of vendors not yet sent a request (J1, inner)."""
    prepared = prepare_items(items, season)
    inactive = inactive_vendors(prepared, listed_inactive(contacts))
    active = prepared.join(fresh_key(inactive, "SUPPLR"), "SUPPLR", "left_anti")
    return active.join(fresh_key(unsent_vendors(contacts), "SUPPLR"), "SUPPLR", "inner")


def season_exceptions(requested: DataFrame, season: str = SEASON) -> DataFrame:
    """Requested items not of the current season."""
    return requested.where(ne("SEASON", F.lit(season)))


def vendor_directory(requested: DataFrame) -> DataFrame:
    """Distinct vendor, name and e-mail of the request set."""
    return requested.select("SUPPLR", "Supplier_name", "EMAIL").distinct()


def request_rows(items: DataFrame, contacts: DataFrame, fx: DataFrame,
                 season: str = SEASON, photo_limit: int = PHOTO_ITEM_LIMIT) -> DataFrame:
    """One request row per item of every vendor to ask.

    Cost is shown in the vendor's currency when its foreign cost differs;
    photo links only for vendors with fewer than ``photo_limit`` items.

    Every per-vendor figure (all-UNQ test, currency, item count) comes from
    one aggregation of the season's items: the vendor filters (inactive,
    listed OUT, not yet sent) keep or drop whole vendors, so they do not
    change the figures of the vendors kept. The items are then read once
    more for the rows.
    """
    prepared = prepare_items(items, season)
    unsent = unsent_vendors(contacts)
    per = prepared.where(F.col("SUPPLR").isNotNull()).groupBy("SUPPLR").agg(
        F.countDistinct("PRODCT").alias("_n"), F.count_if(F.col("SELSTA") == "UNQ").alias("_unq"),
        *currency_aggs(), F.count(F.lit(1)).alias("_items"))
    per = per.where(F.col("_n") != F.col("_unq")).join(listed_inactive(contacts), "SUPPLR", "left_anti")
    # an item is asked once per contact row of its vendor (as the inner join does)
    per = per.join(unsent.groupBy("SUPPLR").agg(F.count(F.lit(1)).alias("_c")), "SUPPLR", "inner")
    per = name_currency(per, fx).select("SUPPLR", "DIFFERS", "CURR", "SYMBOL",
                                        (F.col("_items") * F.col("_c")).alias("N_ITEMS"))
    out = prepared.join(unsent, "SUPPLR", "inner").join(fresh_key(per, "SUPPLR"), "SUPPLR", "inner")
    return out.select(
        "SUPPLR", "Supplier_name", "EMAIL", "PRODCT", "STATUS", "ITEST",
        F.when(F.col("DIFFERS"), F.col("COST_FOR")).otherwise(F.col("COST")).cast("double").alias("COST"),
        F.when(F.col("DIFFERS"), F.col("CURR")).otherwise(F.lit("USD")).alias("CURR"),
        F.when(F.col("DIFFERS"), F.col("SYMBOL")).otherwise(F.lit("$")).alias("SYMBOL"),
        F.when(F.col("N_ITEMS") < photo_limit, S.photo_link("PRODCT")).alias("PHOTO"),
        "N_ITEMS")


def price_requests(items: DataFrame, contacts: DataFrame, fx: DataFrame,
                   season: str = SEASON, photo_limit: int = PHOTO_ITEM_LIMIT) -> DataFrame:
    """The request rows, ROW_NO numbering each vendor's items by PRODCT."""
    rows = request_rows(items, contacts, fx, season, photo_limit)
    return row_numbers(rows, ["SUPPLR"], ["PRODCT"], "ROW_NO", bounds_of=prepare_items(items, season))


def with_new_costs(requests: DataFrame, quotes: DataFrame) -> DataFrame:
    """The request's new-price column and its change against the price
    shown; both null until the vendor has quoted. Of several quotes of an item
    the lowest counts."""
    new = quotes.groupBy("SUPPLR", "PRODCT").agg(F.min("NEW_COST").cast("double").alias("NEW_COST"))
    out = requests.join(new, ["SUPPLR", "PRODCT"], "left")
    return out.withColumn("CHANGE", ratio("NEW_COST", "COST") - 1)


# --- cover sheets ----------------------------------------------------------

def reported_items(items: DataFrame, report: DataFrame, year: int = REPORT_YEAR) -> DataFrame:
    """C7 with the report (C8): items and report rows of the vendors whose check
    is no error; DATA_ISSUE names the side that an unmatched row came from."""
    passed = report_check(items, report, year).where(F.col("STATUS") != "error").select("SUPPLR")
    j = full_marker(items, report).join(fresh_key(passed, "SUPPLR"), "SUPPLR", "left_semi")
    return j.withColumn("DATA_ISSUE", F.when(F.col("MERGE") == "both", "").otherwise(F.col("MERGE"))).drop("MERGE")


def cover_sheet(items: DataFrame, quotes: DataFrame, worklist: DataFrame | None = None) -> DataFrame:
    """Vendor items left-joined with the returned quotes (J4), percent
    change, price note by the first matching rule, origin marker, duplicate
    sort key.

    PRICE_NOTE: OUT (P/PP without stock) > UNQ (no quote, SELSTA UNQ) > old
    (no quote, in stock, P/PP: old foreign cost) > nan (no quote) > new.
    ``items`` may be ``reported_items``, whose DATA_ISSUE is kept.
    """
    if worklist is not None:
        items = items.join(fresh_key(worklist.select("SUPPLR").distinct(), "SUPPLR"), "SUPPLR", "left_semi")
    q = quotes.select("SUPPLR", "PRODCT", "NEW_COST", "MOQ").withColumn("_quoted", F.lit(True))
    j = items.join(q, ["SUPPLR", "PRODCT"], "left")
    # duplicates count only among the vendor's own items, as after the join
    own = items.select("SUPPLR", "PRODCT").distinct()
    dup_keys = (q.join(own, ["SUPPLR", "PRODCT"], "left_semi").groupBy("SUPPLR", "PRODCT").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                .groupBy("SUPPLR").agg(F.lit(True).alias("HAS_DUP")))
    j = j.join(fresh_key(dup_keys, "SUPPLR"), "SUPPLR", "left").withColumn("HAS_DUP", F.coalesce("HAS_DUP", F.lit(False)))
    pct = F.round(((ratio("NEW_COST", "COST_FOR") - 1) * 100).cast("decimal(18,6)"), 1)
    pp = truthy(F.col("STATUS").isin("P", "PP"))
    no_quote = F.col("NEW_COST").isNull()
    note = (F.when(pp & truthy(F.col("QOH") <= 0), "OUT")
            .when(no_quote & truthy(F.col("SELSTA") == "UNQ"), "UNQ")
            .when(no_quote & truthy(F.col("QOH") > 0) & pp, "old")
            .when(no_quote, "nan")
            .otherwise("new"))
    j = j.withColumn("PRICE_NOTE", note)
    n = F.col("PRICE_NOTE")
    return j.select(
        "SUPPLR", "PRODCT", "ITEST", "SELSTA", "STATUS", "QOH", "MOQ",
        F.coalesce(pct, F.lit(0).cast("decimal(18,1)")).cast("double").alias("PCT_CHANGE"),
        F.when(n == "new", F.col("NEW_COST")).when(n == "old", F.round("COST_FOR", 2))
         .cast("double").alias("PRICE"),
        n.alias("PRICE_NOTE"),
        F.when(n.isin("OUT", "UNQ"), n).when(n == "old", money_text("COST_FOR"))
         .when(n == "new", money_text("NEW_COST")).alias("PRICE_TEXT"),
        F.when(truthy(F.col("SELSTA") == "SO-NR") | (n == "UNQ") | F.col("_quoted").isNotNull(), "both")
         .otherwise("left_only").alias("ORIGIN"),
        F.when(F.col("HAS_DUP"), flag(F.col("MOQ") == 0)).alias("SORT_KEY"),
        *[c for c in ("DATA_ISSUE",) if c in items.columns])


def cover_flags(cover: DataFrame, reviewed: DataFrame | None = None) -> DataFrame:
    """G10 + flags of C7 per vendor: nan error, origin problem, duplicates,
    and 'no price change' when the mean change is zero."""
    per = cover.groupBy("SUPPLR").agg(
        F.count(F.lit(1)).alias("N_ROWS"),
        any_flag(F.col("PRICE_NOTE") == "nan").alias("NAN_ERROR"),
        any_flag(F.col("ORIGIN") != "both").alias("SUPPLR_FLAG"),
        any_flag(F.col("SORT_KEY").isNotNull()).alias("HAS_DUP"),
        F.sum(F.col("PCT_CHANGE").cast("decimal(18,1)")).alias("_sum"))
    per = per.select(
        "SUPPLR", "N_ROWS", "NAN_ERROR", "SUPPLR_FLAG", "HAS_DUP",
        F.col("_sum").cast("double").alias("SUM_CHANGE"),
        (F.col("_sum") == 0).alias("NO_CHANGE"),
        F.concat(F.when(F.col("NAN_ERROR"), "_nan_error").otherwise(""),
                 F.when(F.col("SUPPLR_FLAG"), "_supplr_flag").otherwise("")).alias("FILE_FLAG"))
    if reviewed is not None:
        per = per.join(reviewed.select("SUPPLR", "EXCHANGE_RATE"), "SUPPLR", "left")
    return per


def no_change_vendors(cover: DataFrame) -> DataFrame:
    """Vendors whose mean price change is zero."""
    return cover_flags(cover).select("SUPPLR", "N_ROWS", "SUM_CHANGE", "NO_CHANGE")


def duplicate_quotes(cover: DataFrame) -> DataFrame:
    """Repeated items of a vendor; the first (MOQ=0 last) is kept, the
    others marked; sort key puts MOQ=0 rows last.

    The window is keyed by (vendor, item): a group is the handful of quotes
    of one item, never a whole vendor.
    """
    rep = cover.where(F.col("SORT_KEY").isNotNull())
    w = Window.partitionBy("SUPPLR", "PRODCT").orderBy("SORT_KEY", "MOQ", "PRICE")
    return rep.withColumn("IS_DUP", F.row_number().over(w) > 1).select(
        "SUPPLR", "PRODCT", "MOQ", "PRICE", "PRICE_NOTE", "SORT_KEY", "IS_DUP")


def inactive_cover(items: DataFrame, contacts: DataFrame, season: str = SEASON) -> DataFrame:
    """Cover rows of inactive vendors: cost text, 'UNQ' for UNQ items,
    then 'OUT' (wins) for non-return items without stock."""
    prepared = prepare_items(items, season)
    vendors = inactive_vendors(prepared, listed_inactive(contacts))
    rows = prepared.join(fresh_key(vendors, "SUPPLR"), "SUPPLR", "left_semi")
    text = (F.when(ne("ITEST", F.lit("R")) & truthy(F.col("QOH") <= 0), "OUT")
            .when(truthy(F.col("SELSTA") == "UNQ"), "UNQ")
            .otherwise(money_text("COST")))
    return rows.select("SUPPLR", "Supplier_name", "PRODCT", "ITEST", "SELSTA", "QOH", "STATUS",
                       text.alias("COST_TEXT"))


# --- report check and price audit -----------------------------------------

def full_marker(items: DataFrame, report: DataFrame, keys=("SUPPLR", "PRODCT")) -> DataFrame:
    """Full outer join with an origin marker (both / left_only / right_only)."""
    keys = list(keys)
    left = items.withColumn("_l", F.lit(True))
    right = report.select(*keys).distinct().withColumn("_r", F.lit(True))
    j = left.join(right, keys, "full")
    return j.withColumn("MERGE", F.when(F.col("_l") & F.col("_r"), "both")
                        .when(F.col("_l"), "left_only").otherwise("right_only")).drop("_l", "_r")


def report_check(items: DataFrame, report: DataFrame, year: int = REPORT_YEAR) -> DataFrame:
    """Per vendor, items vs report: ok / ignore (previous-season
    mismatches only, no return items) / error."""
    season = str(year)[-2:]
    j = full_marker(items, report)
    err = F.col("MERGE") != "both"
    per = j.groupBy("SUPPLR").agg(
        F.count_if(err).alias("N_ERRORS"),
        F.min_by("SEASON", F.when(err, F.col("PRODCT"))).alias("FIRST_SEASON"),
        any_flag(err & (F.col("ITEST") == "R")).alias("HAS_RETURN"))
    status = (F.when(F.col("N_ERRORS") == 0, "ok")
              .when(ne("FIRST_SEASON", F.lit(season)) & ~F.col("HAS_RETURN"), "ignore")
              .otherwise("error"))
    return per.withColumn("STATUS", status)


def price_audit(covers: DataFrame, items: DataFrame) -> DataFrame:
    """Completed cover sheets vs system first cost (J6, full outer on
    different key names); compared as DECIMAL, OUT never flagged, a missing
    side always flagged."""
    prices = items.select(F.col("PRODCT").alias("Item"), F.col("COST").alias("_cost"))
    j = covers.join(prices, covers["PRODCT"] == prices["Item"], "full")
    cover_value = F.regexp_replace(F.col("COST_TEXT"), ",", "").try_cast("decimal(12,2)")
    first = F.round(F.col("_cost"), 2)
    flag_col = F.when(truthy(F.col("COST_TEXT") == "OUT"), 0).otherwise(flag(ne(cover_value, first)))
    return j.select("PRODCT", "Item", "SUPPLR", "COST_TEXT", first.cast("double").alias("FIRST_COST"),
                    flag_col.alias("FLAG"))


# --- new items -------------------------------------------------------------

def _new_items_years(new_items: DataFrame, first_year: int, fixes=()) -> DataFrame:
    out = new_items.withColumn("YEAR", F.year("date")).where(F.col("YEAR") >= first_year)
    return out.withColumn("Longname", S.replace_values("Longname", fixes)) if fixes else out


def new_items_by_year(new_items: DataFrame, first_year: int = FIRST_YEAR) -> DataFrame:
    """Number of (non-null) items per supplier and year."""
    return _new_items_years(new_items, first_year).groupBy("Supplier", "YEAR").agg(
        F.count("Item").alias("N_ITEMS"))


def new_items_pivot(counts: DataFrame) -> DataFrame:
    """Per supplier a map year -> number of items, years in order; the
    schema does not depend on the data. ``sinks.widen`` makes the year columns
    of a report, one for each year that occurs."""
    return counts.groupBy("Supplier").agg(_by_year("YEAR", "N_ITEMS"))


def _by_year(year: str, n: str):
    """Map year -> count of a group; a group holds one row per year."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(year, n)))).alias("BY_YEAR")


def vendor_new_items(new_items: DataFrame, first_year: int = FIRST_YEAR, fixes=LONGNAME_FIXES) -> DataFrame:
    """C10 + G5: new items per vendor group and year, for every origin letter
    at once, the years as a map (those that occur in the group).

    Vendors are grouped by (first four letters of the code, first word of the
    long name); year counts are summed, codes and long names concatenated in
    code order, the long name cut to its first three words.
    """
    keys = ["primary", "shortname"]
    supp = _new_items_years(new_items, first_year, fixes).select(
        "Supplier", "Longname", S.first_chars("Supplier", 4).alias("primary"),
        S.first_word("Longname").alias("shortname")).distinct()
    supp = supp.where(F.col("primary").isNotNull() & F.col("shortname").isNotNull())
    ordered = F.array_sort(F.collect_list(F.struct("Supplier", "Longname")))
    names = supp.groupBy(*keys).agg(
        F.array_join(F.transform(ordered, lambda x: x["Supplier"]), "").alias("Supplier"),
        F.array_join(F.transform(ordered, lambda x: x["Longname"]), "").alias("Longname"))
    # a supplier with several long names counts once for each, as in the join of the report
    per_year = supp.select("Supplier", *keys).join(new_items_by_year(new_items, first_year), "Supplier")
    per_year = per_year.groupBy(*keys, "YEAR").agg(F.sum("N_ITEMS").alias("N_ITEMS"))
    years = per_year.groupBy(*keys).agg(_by_year("YEAR", "N_ITEMS"))
    return names.join(years, keys).select(
        S.first_chars("primary", 1).alias("ORIGIN"), "primary", "Supplier",
        S.first_words("Longname", 3).alias("Longname"), "BY_YEAR")
