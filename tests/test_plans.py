"""Plans: what reaches the scan, and what must not appear at scale."""

import pytest

import __spark_entry__  # noqa: F401

from callweave.queries.registry import REGISTRY
from callweave.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    return REGISTRY[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    text = plan(spark, "p5_half_open_window")
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_only_used_columns_are_read(spark):
    text = plan(spark, "a3_count_positive")
    read = text[text.index("ReadSchema") :].split("\n")[0]
    assert "l_suppkey" in read and "l_extendedprice" not in read


def test_only_used_nested_fields_are_read(spark):
    from pyspark.sql import functions as F

    details = Tables(spark, FOLDER).conversation_details()
    df = details.select("conversationId", F.explode("participants").alias("p")).select("conversationId", "p.purpose")
    text = df._jdf.queryExecution().executedPlan().toString()
    read = text[text.index("ReadSchema") :].split("\n")[0]
    assert "purpose" in read and "sessions" not in read and "attributes" not in read


@pytest.mark.parametrize("name", ["x1_latest_version", "x3_last_segment", "x4_last_coded_segment", "x16_quota", "w15_merge_newest", "d18_process_map"])
def test_first_rows_are_limited_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


@pytest.mark.parametrize("name", ["j5_dense_grid", "j6_point_in_interval", "j12_cascading_name_match", "j15_line_anchor_join", "d17_timeline", "d24_user_kpis", "d27_extract_date_complexity", "d36_kpi_grid", "d40_kpi_values"])
def test_no_pairwise_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_python_in_the_hot_path(spark):
    for name in ("d2_interval_metric_fact", "d27_extract_date_complexity", "d18_process_map", "i8_valid_local_times", "f10_clean_text", "n7_zip_series"):
        text = plan(spark, name)
        assert "Python" not in text and "Pandas" not in text, name


LARGE = ["j5_dense_grid", "j6_point_in_interval", "j8_bucket_join", "j11_normalised_text_join", "j12_cascading_name_match", "d17_timeline", "d18_process_map", "d24_user_kpis", "d36_kpi_grid", "d40_kpi_values"]


@pytest.mark.parametrize("name", LARGE)
def test_no_pairwise_joins_when_nothing_is_small(spark, name):
    """Tables that no size estimate would broadcast: every join must still have a key."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["d17_timeline", "d18_process_map", "d24_user_kpis", "d27_extract_date_complexity", "x8_previous_queue"])
def test_building_a_plan_reads_footers_only(spark, name):
    """Jobs of a second build: one per table read, for its schema, and none over data."""
    REGISTRY[name](spark, FOLDER)
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", "build")
    try:
        REGISTRY[name](spark, FOLDER)
        jobs = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [sc.statusTracker().getStageInfo(s) for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
    assert all(s.numTasks == 1 for s in stages), [(s.name, s.numTasks) for s in stages]
    assert all(s.name.startswith("parquet at") for s in stages), [s.name for s in stages]


def test_large_files_are_split_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = REGISTRY["x7_rank_with_ties"](spark, FOLDER)
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
