"""Literal rows for faults that the oracle rows could not see."""

import datetime as dt

from pyspark.sql import functions as F

from orderdesk.functions import scalars as S
from orderdesk.operators import pricing, windows
from orderdesk.sources import sinks


def test_codes_are_no_numbers(spark):
    df = spark.createDataFrame([("12D",), ("5f",), ("$1,200.50",), (" 7 ",), ("1e3",), (None,)], "t string")
    assert [r[0] for r in df.select(S.currency_to_number("t")).collect()] == [None, None, 1200.5, 7.0, 1000.0, None]


def test_upc_word_splits_on_any_white_space(spark):
    df = spark.createDataFrame([("UPC\t412345678901",), ("412345678901\tnext",)], "t string")
    assert [r[0] for r in df.select(S.upc_word("t")).collect()] == ["412345678901"] * 2


def test_row_numbers_keep_rows_without_a_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), (None, 2)], "k string, v int")
    got = windows.row_numbers(df, ["k"], ["v"])
    assert sorted((r.k or "", r.v, r.ROW_NO) for r in got.collect()) == [("", 1, 1), ("", 2, 2), ("a", 1, 1)]


def test_years_are_those_that_occur(spark):
    rows = [("H001", "Some  Vendor & Co Ltd", "i1", dt.date(2026, 1, 1)), ("H001", "Some  Vendor & Co Ltd", "i2", dt.date(9999, 12, 31)),
            ("H001x", "Some  Vendor & Co Ltd", "i3", dt.date(2026, 5, 1)), ("H001x", "Some  Vendor & Co Ltd", None, dt.date(2021, 5, 1)),
            ("H001x", "Some  Vendor & Co Ltd", "i4", dt.date(2019, 5, 1)), (None, "None", "i5", dt.date(2022, 5, 1))]
    items = spark.createDataFrame(rows, "Supplier string, Longname string, Item string, date date")
    pivot = pricing.new_items_pivot(pricing.new_items_by_year(items))
    assert {r.Supplier: r.BY_YEAR for r in pivot.collect()} == {
        "H001": {2026: 1, 9999: 1}, "H001x": {2021: 0, 2026: 1}, None: {2022: 1}}
    got = pricing.vendor_new_items(items, fixes=[("Some  Vendor & Co Ltd", "Some Vendor&Co Ltd")])
    assert [tuple(r) for r in got.collect()] == [("H", "H001", "H001H001x", "Some Vendor&Co LtdSome", {2021: 0, 2026: 2, 9999: 1})]
    wide = sinks.widen(pivot, "BY_YEAR", "y", missing=0)
    assert wide.columns == ["Supplier", "y2021", "y2022", "y2026", "y9999"]
    assert {r.Supplier: tuple(r)[1:] for r in wide.collect()} == {"H001": (0, 0, 1, 1), "H001x": (0, 0, 1, 0), None: (0, 1, 0, 0)}


def test_missing_contact_keeps_null_and_blank_mail(spark):
    from orderdesk.operators import orders as O
    df = spark.createDataFrame([("a@b.c", "A"), (None, "B"), ("", "C"), ("  ", "D")], "EMAIL string, Product string")
    assert sorted(r["Product"] for r in O.missing_contact(df).collect()) == ["B", "C", "D"]


def test_terms_per_order_set(spark):
    from orderdesk.operators import orders as O
    lines = spark.createDataFrame([(1, 7, "A", 6, 1.0), (2, 8, "A", 6, 1.0), (3, 9, "A", 6, 1.0)],
                                  "PO int, Customer int, Product string, Qty int, Unit_Cost double")
    inv = spark.createDataFrame([("A", "A", 100, 6, 10.0, 20.0)],
                                "Item string, Status string, NETAVAIL int, CaseQty int, CasePrice double, SplitPrice double")
    inv = inv.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("CasePrice", "SplitPrice")})
    terms = spark.createDataFrame([(7, 1.0, 0.5), (8, 0.0, None)], "Customer int, TICKET double, DISCOUNT double")
    got = {r["PO"]: float(r["PRICE"]) for r in O.price_lines(lines, inv, terms=terms).collect()}
    assert got == {1: 6.0, 2: 8.0, 3: 8.25}


def test_dummy_check_keeps_orders_and_codes_apart(spark):
    from orderdesk.operators import orders as O
    cust = spark.createDataFrame([(1, 10, "YKXP1", 5), (1, 11, "YKXP1", 6), (2, 12, "YAAP1", 7), (3, 13, "YZZP1", 1)],
                                 "Customer int, PO int, Product string, Ordered int")
    dummy = spark.createDataFrame([(1, 10, "P1", 5), (1, 11, "P1", 7), (2, 12, "P1", 7)],
                                  "Customer int, PO int, Product string, Dummy_Qty int")
    codes = spark.createDataFrame([(1, "KX"), (2, "AA")], "Customer int, CODE string")
    got = {(r["PO"], r["Product"], r["FLAG"]) for r in O.dummy_check(cust, dummy, codes=codes, keys=("Customer", "PO")).collect()}
    assert got == {(10, "P1", 0), (11, "P1", 1), (12, "P1", 0), (13, "YZZP1", 1)}


def test_any_of_several_attachments(spark):
    from orderdesk.operators import shipping as SH
    msgs = spark.createDataFrame([(1, 1, "s", "a@b", dt.date(2024, 2, 1), ["x.txt", "FCR_1.pdf"], "t"),
                                  (1, 2, "s", "a@b", dt.date(2024, 2, 1), ["x.txt", None], "t"),
                                  (1, 3, "s", "a@b", dt.date(2024, 2, 1), None, "t")],
                                 "conv_id int, turn int, sender string, email string, receive date, attachment array<string>, body string")
    got = {r["turn"]: r["FCR"] for r in SH.read_messages(msgs, dt.date(2024, 1, 1)).collect()}
    assert got == {1: 1, 2: 0, 3: 0}
