"""Whole-row and per-order grouping in pieces that AQE does not put together; a load in one shuffle."""

import uuid

from orderdesk.operators import orders as O
from orderdesk.operators import shipping as SH
from orderdesk.operators import templates as T
from orderdesk.operators.windows import SLICE_ROWS
from orderdesk.plans.checks_documents import MA_COLUMNS
from orderdesk.session import by_whole_row, pieces
from orderdesk.sources import sinks, store


def test_rows_to_insert_are_grouped_in_pieces(spark):
    schema = "po long, item string"
    stored = spark.createDataFrame([(1, "A"), (1, "A"), (None, "B"), (2, None), (7, "z")], schema)
    more = spark.createDataFrame([(1, "A"), (None, "B"), (None, "B"), (2, None), (2, ""), (None, None), (None, None), (3, "A")], schema)
    new = SH.rows_to_insert(more, stored)
    assert new.rdd.getNumPartitions() == pieces(spark)
    assert sorted(map(str, new.collect())) == sorted(map(str, spark.createDataFrame([(2, ""), (None, None), (3, "A")], schema).collect()))
    assert SH.insert_absent(more, stored).count() == 8  # stored rows stay as they are
    held = by_whole_row(stored).distinct()
    assert held.rdd.getNumPartitions() == pieces(spark) and held.count() == 4


def test_dummy_check_per_order_is_summed_in_pieces(spark):
    cust = spark.createDataFrame([("a", 1, "YKXP1", 2), ("a", 1, "YKXP1", 3), ("a", 2, "YKXP1", 1), (None, 1, "YKXP1", 4)],
                                 "Customer string, PO long, Product string, Ordered int")
    dummy = spark.createDataFrame([("a", 1, "P1", 5), ("a", 2, "P1", 2), (None, 1, "P1", 4), ("b", 9, "P2", 1), ("b", 9, None, 1)],
                                  "Customer string, PO long, Product string, Dummy_Qty int")
    out = O.dummy_check(cust, dummy, keys=("Customer", "PO"))
    assert out.rdd.getNumPartitions() == pieces(spark)
    got = sorted((tuple(r) for r in out.select("Customer", "PO", "Product", "Dummy_Qty", "Ordered", "FLAG").collect()), key=str)
    # orders without a customer meet none
    assert got == sorted([("a", 1, "P1", 5, 5, 0), ("a", 2, "P1", 2, 1, 1), (None, 1, "P1", 4, None, 1), (None, 1, "P1", None, 4, 1),
                          ("b", 9, "P2", 1, None, 1)], key=str)


def test_store_load_is_shuffled_once(spark):
    one = spark.range(50).selectExpr("cast(id % 9 as string) as po", "cast(id % 9 as int) as n")
    held = store.open_store(spark, f"store_{uuid.uuid4().hex}", one.schema, buckets=3)
    assert store.insert_absent(held, one, "l1")
    out = store.absent(held, one.union(one).union(spark.createDataFrame([(None, 1), (None, 1), ("1", None)], one.schema)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert sorted(map(str, out.drop(store.HASH).collect())) == ["Row(po='1', n=None)", "Row(po=None, n=1)"]
    again = store.open_store(spark, held.name, one.schema)  # the buckets are those it was made with
    assert again.buckets == 3 and store.insert_absent(again, one, "l2") and store.rows(again).count() == 9


def test_vendor_folders_are_made_by_many_tasks(spark, tmp_path):
    rows = spark.range(4000).selectExpr("case when id % 2 = 0 then 'HOT' when id % 100 > 1 then concat('V', id % 100) end as SUPPLR", "id as n")
    dealt = sinks.per_vendor_layout(rows).select("SUPPLR").rdd.glom().map(set).collect()
    assert sum(len(s) > 0 for s in dealt) > pieces(spark) / 2
    assert sum(map(len, dealt)) == 51  # each vendor whole
    cut = sinks.per_vendor_layout(rows, order=["n"], slice_rows=500).rdd.glom().map(lambda s: [tuple(r) for r in s]).collect()
    assert sum(any(v == "HOT" for v, _ in s) for s in cut) > 1  # a hot vendor lies in several tasks
    assert all([n for v, n in s if v == x] == sorted(n for v, n in s if v == x) for s in cut for x in {v for v, _ in s})
    assert sorted(map(str, (r for s in cut for r in s))) == sorted(str(tuple(r)) for r in rows.collect())
    sinks.write_per_vendor(rows, str(tmp_path / "out"))
    back = spark.read.schema("n long, SUPPLR string").option("header", True).csv(str(tmp_path / "out")).select("SUPPLR", "n")
    assert sorted(str(tuple(r)) for r in back.collect()) == sorted(str(tuple(r)) for r in rows.collect())


def test_ma0603_decides_per_table_across_slices(spark):
    schema = "doc_id long, page_no int, row_no int, " + ", ".join(f"`{c}` string" for c in MA_COLUMNS)

    def rows(shift):
        first = ("Product", "Unit Cost", "Qty", "Ext Cost", "UPC-A/EAN", "DESCRIPTION")
        out = [(d, p, 1 + shift, *first) for d in (1, None) for p in (1,)]
        for d in (1, 2, None):
            for p in (1, 2, None):
                for i in range(2, 9):
                    style = "AB12" if i == 3 and d != 2 else "CD34" if i == 6 and d != 2 else None
                    out.append((d, p, i + shift, style, f"EA {i}", f"${i}.50", f"${i}9.00" if i % 2 else None,
                                f"41{i}" if i % 3 else None, "UNIT RETAIL" if i == 5 and p != 1 else f"R{i}"))
        return spark.createDataFrame(out, schema)

    def got(shift):
        out = T.ma0603(rows(shift))
        return out, sorted(str(tuple(r)) for r in out.withColumn("row_no", out.row_no - shift).collect())

    out, near = got(0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") < 10  # 19 when each step put its facts beside the rows anew
    assert len(near) > 20
    assert near == got(SLICE_ROWS - 5)[1]  # rows 5 and on lie in the next slice
    assert near == got(SLICE_ROWS - 2)[1]
