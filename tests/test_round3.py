"""Row numbers, replies in parts, the bucketed store and order lines read once."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from orderdesk.operators import shipping as SH
from orderdesk.operators import windows
from orderdesk.sources import sinks, store, tables


def _jobs(spark, build):
    """How many jobs run while ``build`` makes its plan, and what it makes."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    made = build()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return n, made


def _final(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_numbers_of_a_hot_group_in_slices(spark):
    rows = [("hot", f"i{i * 7919 % 3000:05d}", i) for i in range(3000)] + [(f"v{i % 50}", f"i{i:05d}", i) for i in range(500)]
    rows += [(None, f"i{i:05d}", i) for i in range(300)] + [("hot", None, -1)]
    df = spark.createDataFrame(rows, "k string, item string, v int").repartition(6)
    n, out = _jobs(spark, lambda: windows.row_numbers(df, ["k"], ["item"], slice_rows=100))
    assert n == 0
    groups = {}
    for k, item, v in rows:
        groups.setdefault(k, []).append((item is not None, item or "", v))
    want = sorted((k or "", v, i + 1) for k, g in groups.items() for i, (_, _, v) in enumerate(sorted(g)))
    assert sorted((r.k or "", r.v, r.ROW_NO) for r in out.collect()) == want
    # the slices: the hot group lies in some thirty of them, in order
    bounds = df.where("k = 'hot'").where(F.pmod(F.xxhash64("k", "item"), F.lit(100)) == 0).count()
    assert bounds > 10
    more = df.union(df.withColumn("item", F.concat("item", F.lit("x")))).where("item is not null")
    other = windows.row_numbers(df, ["k"], ["item"], slice_rows=100, bounds_of=more)
    assert sorted((r.k or "", r.v, r.ROW_NO) for r in other.collect()) == want
    both = windows.row_numbers(df, ["k", "item"], ["v"], slice_rows=2)
    assert {r.ROW_NO for r in both.collect()} == {1}


def test_row_numbers_equal_bounds(spark):
    """Every row a bound, and none."""
    df = spark.range(200).selectExpr("id % 3 as k", "id as v")
    for slice_rows in (1, 10**9):
        got = windows.row_numbers(df, ["k"], ["v"], slice_rows=slice_rows).collect()
        assert all(r.ROW_NO == r.v // 3 + 1 for r in got) and len(got) == 200


MESSAGES = "conv_id bigint, turn int, sender string, email string, receive date, attachment string, body string"


def test_replies_of_a_long_sender_come_in_parts(spark, tmp_path):
    rng = random.Random(2)
    day = dt.date(2024, 2, 1)
    rows = [(c, t, "s", "Hot@v.x" if c % 2 else f"a{c % 5}@v.x", day + dt.timedelta(days=c % 20), "FCR" if t == 0 else "n",
             rng.choice([None, "", "é" * rng.randrange(1, 60), "body %d %d" % (c, t)])) for c in range(120) for t in range(3)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, MESSAGES)
    whole = {r.email: r for r in SH.replies(df, dt.date(2024, 1, 1)).collect()}
    assert {r.part for r in whole.values()} == {0} and len(whole) == 6
    parts = SH.replies(df, dt.date(2024, 1, 1), part_bytes=400, slice_conversations=10)
    got = {}
    for r in sorted(parts.collect(), key=lambda r: (r.email, r.part)):
        got.setdefault(r.email, []).append(r)
    assert len(got["hot@v.x"]) > 5 and set(got) == set(whole)
    # bodies in mailbox order, nulls left out, as one text over the parts
    texts = {}
    for c, t, _, mail, _, _, body in sorted(rows, key=lambda r: r[:2]):
        if body is not None:
            texts.setdefault(mail.lower(), []).append(body)
    for mail, group in got.items():
        assert "-".join(r.body for r in group if r.body is not None) == "-".join(texts[mail])
        assert {(r.receive, r.FCR) for r in group} == {(whole[mail].receive, whole[mail].FCR)}
        assert len(group) == 1 or all(len((r.body or '').encode()) < 400 + 130 for r in group)
    sinks.write_replies(parts, str(tmp_path / "replies"))
    back = spark.read.json(str(tmp_path / "replies")).groupBy("email").count().collect()
    assert {r.email: r["count"] for r in back} == {m: len(g) for m, g in got.items()}


@pytest.fixture
def held(spark):
    schema = spark.createDataFrame([], "po string, n int, d date").schema
    return store.open_store(spark, f"store_{uuid.uuid4().hex}", schema, buckets=4)


def test_store_inserts_what_is_absent(spark, held):
    rows = lambda *v: spark.createDataFrame(list(v), "po string, n int, d date")
    day = dt.date(2024, 1, 1)
    assert store.insert_absent(held, rows(("a", 1, day), ("a", 1, day), ("a", None, None), (None, None, None)), "l1")
    assert not store.insert_absent(held, rows(("zz", 1, day)), "l1")  # the load was finished before
    assert store.insert_absent(held, rows(("a", 1, day), ("a", None, None), (None, None, None), ("", None, None), ("b", 2, day)), "l2")
    assert store.insert_absent(held, rows(), "l3")
    got = sorted((tuple(r) for r in store.rows(held, load_id=True).collect()), key=str)
    assert got == sorted([("a", 1, day, "l1"), ("a", None, None, "l1"), (None, None, None, "l1"), ("", None, None, "l2"),
                          ("b", 2, day, "l2")], key=str)
    assert sorted(r.load_id for r in store.loads(held).collect()) == ["l1", "l2", "l3"]
    again = store.open_store(spark, held.name, rows().schema)
    assert store.rows(again).count() == 5


def test_store_moves_no_stored_row(spark, held):
    one = spark.range(5000).selectExpr("cast(id as string) as po", "cast(id as int) as n", "date'2024-01-01' as d")
    new = spark.range(4990, 5010).selectExpr("cast(id as string) as po", "cast(id as int) as n", "date'2024-01-01' as d")
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) != 3
    held = store.open_store(spark, held.name + "_3", one.schema, buckets=3)
    store.insert_absent(held, one, "l1")
    out = store.absent(held, new.union(new))
    assert out.count() == 10
    final = _final(out).split("Initial Plan")[0].splitlines()
    scan = next(i for i, line in enumerate(final) if "FileScan" in line and held.name in line)
    assert "Bucketed: true" in final[scan]
    join = next(i for i, line in enumerate(final) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in final[:join])  # none above the join
    depth = final[scan].index("FileScan")
    above = [line for i, line in enumerate(final[join + 1:scan], join + 1) if line.rstrip() and not any(
        c in line[:depth] for c in ":|") and "Exchange" in line]
    assert not above  # none between the stored scan and the join


def test_order_lines_are_read_once(spark, small_dir):
    tables.register(spark, small_dir)
    lines, contacts = spark.table("v_open_po_lines"), spark.table("v_supplier_contacts")
    orders = SH.open_orders_once(lines, contacts)
    assert sorted(map(str, orders.collect())) == sorted(map(str, SH.open_orders(lines, contacts).collect()))
    rest = SH.split_orders(orders)[1]
    for job in (orders, SH.late_orders(rest), SH.contact_reminders(rest), SH.late_reminders(rest)):
        assert "lineitem" not in _final(job)
    moved = lines.withColumn("DATEDFF", F.lit(5))  # no alarm: dates stay
    a = SH.open_orders_once(moved, contacts).collect()
    assert sorted(map(str, a)) == sorted(map(str, SH.open_orders(moved, contacts).collect()))
    assert SH.open_orders_once(lines.limit(0), contacts).count() == 0
