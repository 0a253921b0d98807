"""Named-query catalogue, ad-hoc SQL, and 'no per-vendor job' plan checks."""

import pytest
from pyspark.sql import functions as F

from orderdesk.plans import registry
from orderdesk.sources import catalog, tables


def test_named_query_forms(spark, small_dir):
    tables.register(spark, small_dir)
    some = [r[0] for r in spark.table("v_inventory").select("Item").limit(3).collect()]
    by_list = catalog.named_query(spark, "inventory", items=some)
    assert sorted(r["Item"] for r in by_list.collect()) == sorted(some)
    keys = spark.createDataFrame([(some[0],), (None,)], "k string")
    assert [r["Item"] for r in catalog.named_query(spark, "inventory", items=keys).collect()] == [some[0]]
    assert catalog.named_query(spark, "uprice").count() == spark.table("v_catalog_items").count()
    with pytest.raises(KeyError):
        catalog.named_query(spark, "no_such_query")


def test_direct_query_binds_parameters(spark, small_dir):
    tables.register(spark, small_dir)
    df = catalog.direct_query(spark, "select count(*) as n from v_catalog_items where SUPPLR = :s", {"s": "H00001"})
    n = spark.table("v_catalog_items").where(F.col("SUPPLR") == "H00001").count()
    assert df.first()["n"] == n


def _jobs(spark, name, sf_dir, group):
    sc = spark.sparkContext
    registry.run(spark, name, sf_dir)  # registration jobs outside the group
    sc.setJobGroup(group, group)
    registry.run(spark, name, sf_dir).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("", "")
    return len(sc.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("name", ["price_requests", "cover_sheet", "tracking_summary"])
def test_job_count_does_not_grow_with_vendors(spark, name):
    """One job plan for all vendors: 10x the vendors, the same number of jobs."""
    small = _jobs(spark, name, "/root/testdata/sf0.001", f"{name}-small")
    big = _jobs(spark, name, "/root/testdata/sf0.01", f"{name}-big")
    assert big <= small + 2, (small, big)


def test_filters_and_columns_reach_the_parquet_scan(spark, small_dir):
    """The read-time spreading of fact tables does not block pushdown: the
    filter and the two-column projection reach the scan."""
    tables.register(spark, small_dir)
    df = catalog.direct_query(spark, "select l_orderkey, l_quantity from lineitem where l_quantity > :q", {"q": 45.0})
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.split("\n") if "FileScan parquet" in ln][0]
    assert "GreaterThan(l_quantity,45.0)" in scan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in scan
