"""Shape of the plans: what must hold whatever the size of the data."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from fleetday.operators import silver as V
from fleetday.operators.sessions import early_share
from fleetday.plans import fixtures as X
from fleetday.plans.queries import final_daily

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    "name", ["final_daily", "upsert_merge", "delete_emptied", "trip_delays", "marked_trips", "dedup_offers"]
)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry_point.queries()[name](spark, SF_DIR))
    for forbidden in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text


@pytest.mark.parametrize(
    "name", ["silver", "dedup_keep_first", "dedup_latest_by_file", "order_km", "cancel_events"]
)
def test_keys_are_reduced_before_the_shuffle(spark, name):
    text = plan(entry_point.queries()[name](spark, SF_DIR))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_ordered_scans_cut_heavy_riders_only(spark):
    """Ordinary riders: one window, no second pass. Heavy ones: every window has the range in its key."""
    connections = X.connections(spark, SF_DIR)

    def windows(heavy_rows):
        text = plan(early_share(connections, replace(X.CONFIG, heavy_rows=heavy_rows)))
        physical = text[text.index("== Physical Plan =="):]
        return physical, [line for line in physical.splitlines() if "Window [lead(start_dt" in line]

    physical, plain = windows(10**6)
    assert len(plain) == 1 and "_range#" not in physical
    physical, cut = windows(3)
    assert len(cut) == 2 and sum("_range#" in line for line in cut) == 1


def test_the_copies_of_events_are_made_evenly(spark, tmp_path):
    """Events that lie in one row group are dealt out before each is repeated for its exports."""
    X.events(spark, SF_DIR).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    made = X.exported_events(spark, str(tmp_path)).groupBy(F.spark_partition_id().alias("task")).count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = [r["count"] for r in made.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(counts) == 8 and max(counts) < sum(counts) / 4


def test_recent_days_are_cut_at_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    X.daily(spark, SF_DIR).withColumn("_day", F.to_date("datestr")).write.partitionBy("_day").parquet(path)
    recent = V.recent_window(spark.read.parquet(path), X.CONFIG)
    scans = [line for line in plan(recent).splitlines() if "FileScan" in line and "online_hours" in line]
    filters = scans[0].split("PartitionFilters:")[1]
    assert "_day" in filters and "subquery" in filters
    recent.write.format("noop").mode("overwrite").save()


@pytest.mark.parametrize("partitions", ["1", "50"])
def test_the_result_does_not_depend_on_the_partitioning(spark, partitions):
    expected = sorted(map(str, final_daily(spark, SF_DIR).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(map(str, final_daily(spark, SF_DIR).collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
