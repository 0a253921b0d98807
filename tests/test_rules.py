"""Null, rounding and division rules on literal rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from orderdesk.functions import rules as R
from orderdesk.functions import scalars as S


def test_ne_null_is_different(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, None), (1, 2)], "a int, b int")
    got = [r[0] for r in df.select(R.ne("a", "b")).collect()]
    assert got == [False, True, True, True]


def test_truthy_and_any_flag(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("y", True)], "k string, v boolean")
    got = dict(df.groupBy("k").agg(R.any_flag(F.col("v")).alias("a")).collect())
    assert got == {"x": False, "y": True}
    assert df.where(R.truthy(F.col("v"))).count() == 1


def test_money_half_up_in_decimal(spark):
    df = spark.createDataFrame([(Decimal("1.005"),), (Decimal("0.125"),)], "m decimal(12,4)")
    assert [r[0] for r in df.select(R.money("m")).collect()] == [1.01, 0.13]


def test_ratio_zero_divisor_is_null(spark):
    df = spark.createDataFrame([(1, 0), (3, 2)], "a int, b int")
    assert [r[0] for r in df.select(R.ratio("a", "b")).collect()] == [None, 1.5]


def test_money_text(spark):
    df = spark.createDataFrame([(Decimal("1234.5678"),), (None,)], "m decimal(12,4)")
    got = [tuple(r) for r in df.select(R.money_text("m"), R.money_text("m", thousands=False)).collect()]
    assert got == [("1,234.57", "1234.57"), (None, None)]


def test_parse_date_coerces(spark):
    df = spark.createDataFrame([("1998-06-15",), ("N/A",), (None,)], "d string")
    assert [r[0] for r in df.select(R.parse_date("d")).collect()] == [dt.date(1998, 6, 15), None, None]


def test_scalars(spark):
    df = spark.createDataFrame([("Vendor 3 Trading  Co. (H00003)", "AB001234")], "t string, p string")
    r = df.select(S.first_word("t"), S.last_word("t"), S.first_words("t", 3), S.supplier_in_parens("t"),
                  S.photo_link("p", "http://x"), S.number_in_text(F.lit("EA 12.5x")),
                  S.currency_to_number(F.lit("$1,234.50")), S.upc_word(F.lit("tree 412000000001 x")),
                  S.longest([F.lit("12"), F.lit("345"), F.lit("678")]),
                  S.first_match([F.lit("x"), F.lit("UPC 412345678901"), F.lit("499999999999")])).first()
    assert tuple(r) == ("Vendor", "(H00003)", "Vendor 3 Trading", "H00003", "http://x/a/b/ab001234.jpg",
                        12.5, 1234.5, "412000000001", "345", "412345678901")


def test_month_end_helpers(spark):
    r = spark.range(1).select(S.month_end(dt.date(1998, 6, 15), 10), S.month_end(dt.date(1998, 6, 25), 10),
                              S.days_before(dt.date(1998, 6, 15), 21)).first()
    assert tuple(r) == (dt.date(1998, 6, 30), dt.date(1998, 7, 31), dt.date(1998, 5, 25))


# --- more rules of SURVEY 1.4, each on literal rows -------------------------

def test_n3_group_by_drops_null_keys(spark):
    from orderdesk.operators import shipping as SH
    rows = [(None, "a@x", dt.date(1998, 5, 1), "S", 1.0), ("T1", "b@x", dt.date(1998, 5, 1), "C", 1.0)]
    df = spark.createDataFrame(rows, "SUPPLR string, EMAIL string, NEWCONDAT date, TYPE string, PCTSHIP double")
    out = SH.tracking_summary(df)
    assert [r["SUPPLR"] for r in out.collect()] == ["T1"]


def test_n4_sum_of_null_group_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2)], "k string, v int")
    got = dict(df.groupBy("k").agg(R.sum0("v").alias("s")).collect())
    assert got == {"a": 0, "b": 2}


def test_n7_null_keys_do_not_match(spark):
    left = spark.createDataFrame([(None, 1), ("k", 2)], "key string, a int")
    right = spark.createDataFrame([(None, 10), ("k", 20)], "key string, b int")
    got = sorted((r["a"], r["b"]) for r in left.join(right, "key", "left").collect())
    assert got == [(1, None), (2, 20)]


def test_n11_literal_replace_and_n16_ordered_text_sum(spark):
    df = spark.createDataFrame([("g", "B.1", 2), ("g", "A.1", 1)], "k string, t string, o int")
    r = df.select(S.remove_text("t", ".")).collect()
    assert [x[0] for x in r] == ["B1", "A1"]
    cat = df.groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "t"))),
                                                       lambda x: x["t"]), "").alias("s")).first()["s"]
    assert cat == "A.1B.1"


def test_n17_cast_truncates_and_keeps_null(spark):
    df = spark.createDataFrame([(5.9,), (-5.9,), (None,)], "q double")
    assert [r[0] for r in df.select(F.col("q").cast("int")).collect()] == [5, -5, None]


def test_n18_flag_column_always_exists(spark):
    from orderdesk.operators import shipping as SH
    df = spark.createDataFrame([("T1", "S", dt.date(1998, 6, 30), 1.0)],
                               "SUPPLR string, TYPE string, NEWCONDAT date, PCTSHIP double")
    out = SH.flag_lines(df)
    assert "Z_ITEMS" in out.columns and out.first()["Z_ITEMS"] is None


def test_n19_null_text_compare_drops_row(spark):
    from orderdesk.operators import pricing as PR
    df = spark.createDataFrame([("A1", "T1", None, "", "P", 1), ("A2", "T1", "24", "", "P", 1)],
                               "PRODCT string, SUPPLR string, SEASON string, SELSTA string, STATUS string, QOH int")
    assert [r["PRODCT"] for r in PR.prepare_items(df, "24").collect()] == ["A2"]


def test_n20_as_of_is_a_parameter(spark):
    import dataclasses
    from orderdesk.operators import shipping as SH
    from orderdesk.params import ShippingParams
    df = spark.createDataFrame([("T1", "S", dt.date(1998, 6, 1), 1.0)],
                               "SUPPLR string, TYPE string, NEWCONDAT date, PCTSHIP double")
    early = dataclasses.replace(ShippingParams(), as_of=dt.date(1998, 5, 1))
    assert SH.flag_lines(df).first()["LATE"] == 1
    assert SH.flag_lines(df, early).first()["LATE"] == 0
