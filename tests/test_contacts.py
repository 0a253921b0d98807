"""Contact audit, supplier validation and insert-if-absent on literal rows."""

import datetime as dt

from orderdesk.operators import contacts as K
from orderdesk.operators import shipping as SH


def test_validate_suppliers(spark):
    batch = spark.createDataFrame([
        ("T00001", "Good", "a@b.test"), ("T00002", "Bad mail", "not-an-email"),
        ("T00003", "x" * 101, "c@d.test"), ("T00004", "Dup", "e@f.test"), ("T00004", "Dup 2", "g@h.test"),
        ("T00005", "Stored", "i@j.test"), ("X" * 21, "Long key", "k@l.test")],
        "SUPPLR string, SUPPLR_NAME string, EMAIL string")
    existing = spark.createDataFrame([("T00005",)], "SUPPLR string")
    got = {(r["SUPPLR"], r["SUPPLR_NAME"]): r["REASON"] for r in K.validate_suppliers(batch, existing).collect()}
    assert got[("T00001", "Good")] is None
    assert got[("T00002", "Bad mail")] == "bad EMAIL"
    assert got[("T00003", "x" * 101)] == "SUPPLR_NAME too long"
    assert got[("T00004", "Dup")] == "duplicate key" and got[("T00004", "Dup 2")] == "duplicate key"
    assert got[("T00005", "Stored")] == "key exists"
    assert got[("X" * 21, "Long key")] == "SUPPLR too long"


def test_insert_absent_is_null_safe(spark):
    schema = "purord int, supplr string, item string, ordqty int, outqty int, condat date, newdate date, type string, late int"
    d = dt.date(2024, 1, 1)
    existing = spark.createDataFrame([(1, "T1", "A", 5, 5, d, None, "S", 0), (2, "T1", "B", 5, 1, d, d, "C", 1)], schema)
    incoming = spark.createDataFrame([(1, "T1", "A", 5, 5, d, None, "S", 0), (2, "T1", "B", 5, 0, d, d, "C", 1),
                                      (3, "H2", "C", 1, 1, None, None, "P", 0), (3, "H2", "C", 1, 1, None, None, "P", 0)],
                                     schema)
    out = SH.insert_absent(incoming, existing)
    assert out.count() == 4
    assert out.where("purord = 3").count() == 1


def test_contact_audit_flags(spark):
    listing = spark.createDataFrame([("T1", "One", "a@x"), ("T2", "Two", "b@x"), (None, "Null", "c@x"),
                                     ("T999", "Skip", "d@x"), ("T3", "Three", "e@x")],
                                    "SUPPLR string, SUPPLRDES string, EMAIL string")
    contacts = spark.createDataFrame([("T1", "a@x"), ("T2", "e@x")], "SUPPLR string, EMAIL string")
    got = {r["SUPPLR"]: (r["DIFFERS"], r["KNOWN"]) for r in K.contact_audit(listing, contacts).collect()}
    assert got == {"T1": (0, 1), "T2": (1, 1), "T3": (1, 0)}


def test_rows_to_insert_appended(spark):
    schema = "purord int, supplr string, item string"
    existing = spark.createDataFrame([(1, "T1", None), (2, "T1", "B")], schema)
    incoming = spark.createDataFrame([(1, "T1", None), (3, "H2", "C"), (3, "H2", "C")], schema)
    from orderdesk.sources import sinks
    sinks.replace_table(existing, "shipments_t")
    sinks.append_rows(SH.rows_to_insert(incoming, existing), "shipments_t")
    assert sorted(r[0] for r in spark.table("shipments_t").collect()) == [1, 2, 3]
