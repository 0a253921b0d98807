"""End-to-end runs on sf0.001: every report is written and re-reads with the
same row count as the job that produced it."""

import os

from orderdesk.operators import shipping as SH
from orderdesk.plans import runs
from orderdesk.sources import sinks, tables


def _count_csv(spark, path):
    return spark.read.option("header", True).csv(path).count()


def test_shipping_run(spark, small_dir, tmp_path):
    tables.register(spark, small_dir)
    lines, contacts, msgs = (spark.table(v) for v in ("v_open_po_lines", "v_supplier_contacts", "v_messages"))
    out = runs.shipping_run(spark, lines, contacts, msgs, str(tmp_path))
    rest = SH.split_orders(SH.open_orders(lines, contacts))[1]
    assert _count_csv(spark, out["tracking"]) == SH.tracking_summary(rest).count() == 7
    assert _count_csv(spark, out["quality"]) == 3
    assert _count_csv(spark, out["late_orders"]) == SH.late_orders(rest).count()


def test_pricing_and_orders_runs(spark, small_dir, tmp_path):
    tables.register(spark, small_dir)
    items, contacts, quotes = (spark.table(v) for v in ("v_catalog_items", "v_supplier_contacts", "v_vendor_quotes"))
    covered = spark.table("v_cover_sheets").where("SUPPLR like '%7'")
    out = runs.pricing_run(spark, items, contacts, quotes, str(tmp_path / "p"), covered)
    assert _count_csv(spark, out["cover_flags"]) > 0
    out2 = runs.orders_run(spark, spark.table("v_customer_po_lines"), spark.table("v_inventory"), contacts,
                           str(tmp_path / "o"))
    assert _count_csv(spark, out2["totals"]) > 0


def test_second_pricing_run_writes_the_vendors_still_to_do(spark, small_dir, tmp_path):
    tables.register(spark, small_dir)
    items, contacts, quotes = (spark.table(v) for v in ("v_catalog_items", "v_supplier_contacts", "v_vendor_quotes"))
    later = contacts.where("cast(right(SUPPLR, 1) as int) % 2 = 0")
    first = runs.pricing_run(spark, items, contacts.join(later.select("SUPPLR"), "SUPPLR", "left_anti"), quotes, str(tmp_path))
    before = {r.SUPPLR for r in sinks.vendor_partitions(spark, first["covers"]).collect()}
    files = {os.path.join(d, f) for d, _, names in os.walk(first["covers"]) for f in names if f.endswith(".csv")}
    runs.pricing_run(spark, items, contacts, quotes, str(tmp_path))
    after = {r.SUPPLR for r in sinks.vendor_partitions(spark, first["covers"]).collect()}
    assert before and before < after
    assert all(os.path.exists(f) for f in files)  # sheets of the first run are as they were
    flags = {r.SUPPLR for r in sinks.vendor_partitions(spark, first["cover_flags"]).collect()}
    assert flags == after


def test_output_per_vendor_replaces_only_its_own(spark, tmp_path):
    path = str(tmp_path / "covers")
    rows = lambda *v: spark.createDataFrame(list(v), "SUPPLR string, n int")
    assert sinks.vendor_partitions(spark, path).count() == 0
    sinks.write_per_vendor(rows(("VA", 1), ("V/B 0", 1), ("007", 1), (None, 1)), path)
    sinks.write_per_vendor(rows(("VC", 2), ("007", 2), ("007", 3)), path)
    assert {r.SUPPLR for r in sinks.vendor_partitions(spark, path).collect()} == {"VA", "V/B 0", "007", "VC"}
    got = spark.read.schema("n int, SUPPLR string").option("header", True).csv(path).collect()
    assert sorted((r.SUPPLR or "", r.n) for r in got) == [("", 1), ("007", 2), ("007", 3), ("V/B 0", 1), ("VA", 1), ("VC", 2)]
    sinks.write_per_vendor(rows(), path)
    assert sinks.vendor_partitions(spark, path).count() == 4
