"""The physical plans are the ones the design promises."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tierwise.operators.keys import dedup_latest
from tierwise.operators.metrics import global_aggregates
from tierwise.operators.scd1 import scd1_merge
from tierwise.operators.scd2 import open_versions, rebuild_history
from workload.relational import AGGREGATES, chain

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def sides(spark, tmp_path):
    for name in ("s", "t"):
        spark.range(100).select(F.col("id").alias("k"), F.lit("v").alias("v")).write.parquet(f"{tmp_path}/{name}")
    return [spark.read.parquet(f"{tmp_path}/{n}") for n in ("s", "t")]


def test_merge_is_one_join_and_two_shuffles(sides, no_broadcast):
    text = plan(scd1_merge(*sides, ["k"]))
    assert text.count("SortMergeJoin") == 1 and text.count("FullOuter") == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_small_source_never_shuffles_the_target(sides, no_broadcast):
    text = plan(scd1_merge(*sides, ["k"], small_source=True))
    assert "SortMergeJoin" not in text
    # only the small source and its matched keys move
    assert text.count("BroadcastHashJoin") == 3 and text.count("LeftOuter, BuildRight") == 1


def test_dedup_keeps_one_row_per_key_before_the_shuffle(sides):
    text = plan(dedup_latest(sides[0], ["k"], ["v"]))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_history_window_sees_days_not_rows(spark):
    raw = spark.range(10).select(
        (F.col("id") % 3).alias("k"),
        F.col("id").alias("v"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 2).cast("int")).alias("effective_from"),
    )
    text = plan(rebuild_history(raw, ["k"], sequence_by=["v"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_all_aggregates_share_one_pass(spark, no_broadcast):
    one = plan(global_aggregates(chain(spark, SF), {"n": AGGREGATES["rows"]}))
    every = plan(global_aggregates(chain(spark, SF), AGGREGATES))
    assert every.count("SortMergeJoin") == one.count("SortMergeJoin")


def test_scans_read_needed_columns_and_push_filters(spark):
    text = plan(global_aggregates(chain(spark, SF), AGGREGATES))
    lines = [s for s in re.findall(r"ReadSchema: (struct<[^\n]*>)", text) if "l_" in s]
    assert lines and all(s.count(":") <= 3 for s in lines)
    assert "EqualTo(o_orderstatus,F)" in plan(contract.queries()["parquet_scan"](spark, SF))
    scan = plan(contract.queries()["parquet_scan"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderstatus)" in scan and "GreaterThan(o_total" in scan
    assert "o_custkey" not in scan


def test_partition_filter_prunes_folders(spark):
    text = plan(contract.queries()["gold_partition_prune"](spark, SF))
    assert "order_year" in text.split("PartitionFilters")[1].split("PushedFilters")[0]


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_no_python_in_any_plan(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    assert not re.search(r"Python|MapInPandas|CartesianProduct|BroadcastNestedLoop", text)


def test_first_versions_are_open(spark):
    first = open_versions(spark.range(2).withColumnRenamed("id", "k"), ["k"], F.lit("2024-01-01")).first()
    assert first.is_current and first.effective_to is None
