"""Stored tables: balanced landing, folders by month and their pruning, changes inside the folders of a batch."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from callweave.operators import joins as jn
from callweave.operators import upserts as up
from callweave.plans import process as pr
from callweave.plans import star
from callweave.queries.registry import REGISTRY
from callweave.sources import writers
from callweave.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_landed_tables_have_a_file_for_each_core(spark):
    t = Tables(spark, FOLDER)
    for df in (t.line_sessions(), t.conversation_details()):
        assert len(df.inputFiles()) >= spark.sparkContext.defaultParallelism


def test_landing_bounds_the_rows_of_a_file(spark, tmp_path):
    writers.land_balanced(spark.range(0, 1000, 1, 1), f"{tmp_path}/few", max_per_file=50)
    got = spark.read.parquet(f"{tmp_path}/few")
    assert got.groupBy(F.input_file_name()).count().agg(F.max("count"), F.count("*")).first()[0] <= 50
    # what comes in enough splits is written without a shuffle
    many = spark.range(0, 1000, 1, 32)
    writers.land_balanced(many, f"{tmp_path}/many")
    assert len(spark.read.parquet(f"{tmp_path}/many").inputFiles()) == 32


def test_landed_again_after_forget(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/lineitem.parquet").limit(5).write.parquet(f"{tmp_path}/lineitem.parquet")
    t = Tables(spark, str(tmp_path))
    assert t.line_sessions().count() == 5
    spark.read.parquet(f"{FOLDER}/lineitem.parquet").limit(9).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    assert Tables(spark, str(tmp_path)).line_sessions().count() == 5
    t.forget()
    assert t.line_sessions().count() == 9


@pytest.mark.parametrize("name,tables", [("d18_process_map", 9), ("d18_recent_process_map", 9), ("d20_recent_handling", 3), ("d21_recent_cost_view", 4), ("d24_user_kpis", 4)])
def test_star_tables_are_pruned_by_month(spark, name, tables):
    text = plan(REGISTRY[name](spark, FOLDER))
    scans = [x for x in text.split("\n") if "FileScan parquet" in x and "startMonth" in x]
    pruned = [x for x in scans if "dynamicpruningexpression(startMonth" in x]
    assert len(pruned) >= tables
    if "recent" in name:
        assert any("PartitionFilters: [isnotnull(startMonth" in x and ">= 200106" in x for x in scans)


def test_wanted_rows_come_from_their_folders(spark):
    t = Tables(spark, FOLDER)
    segments, recent = t.star("segments"), pr.started_since(t.star("conversations"), 20010601)
    got = jn.of_wanted(segments.select("*", "_metadata.file_path"), recent, "startMonth", ["conversationId"])
    want = segments.join(recent.select("conversationId"), "conversationId", "left_semi")
    assert rows(got.select("participantId")) == rows(want.select("participantId"))
    folders = {r[0].split("startMonth=")[1][:6] for r in got.select("file_path").distinct().collect()}
    assert folders and min(folders) >= "200106"


def files(path):
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")) for d in os.listdir(path) if "=" in d}


def test_change_inside_the_folders_of_the_batch(spark, tmp_path):
    path = f"{tmp_path}/table"
    frame = lambda r: spark.createDataFrame(r, "k long, v string, day string")
    merge = lambda old, new: up.merge_all(old, new, ["k", "day"])
    up.change_stored(path, frame([(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2"), (4, "d", "d 3/x")]), ["day"], merge)
    before = files(path)
    assert len(before) == 3
    up.change_stored(path, frame([(2, "new", "d1"), (5, "e", "d1"), (6, "f", "d4")]), ["day"], merge)
    after = files(path)
    assert after["day=d2"] == before["day=d2"] and after["day=d1"] != before["day=d1"]
    read = lambda: rows(spark.read.schema("k long, v string, day string").parquet(path))
    assert read() == [(1, "a", "d1"), (2, "new", "d1"), (3, "c", "d2"), (4, "d", "d 3/x"), (5, "e", "d1"), (6, "f", "d4")]
    # deletes may leave a folder without rows
    up.change_stored(path, frame([(3, None, "d2"), (4, None, "d 3/x"), (5, None, "d1")]), ["day"], lambda old, new: up.merge_delete(old, new, ["k", "day"]))
    assert read() == [(1, "a", "d1"), (2, "new", "d1"), (6, "f", "d4")]
    assert set(files(path)) == {"day=d1", "day=d4"}
    kept = files(path)
    up.change_stored(path, frame([]), ["day"], merge)
    assert files(path) == kept
    # a replay changes nothing
    up.change_stored(path, frame([(6, "f", "d4")]), ["day"], merge)
    assert read() == [(1, "a", "d1"), (2, "new", "d1"), (6, "f", "d4")]
    with pytest.raises(ValueError, match="without"):
        up.change_stored(path, frame([(7, "g", None)]), ["day"], merge)
    with pytest.raises(up.DuplicateKeys):
        up.change_stored(path, frame([(7, "g", "d1"), (7, "h", "d1")]), ["day"], merge)


def test_star_tables_come_from_one_pass_over_the_payloads(spark, tmp_path):
    details = Tables(spark, FOLDER).conversation_details().limit(300).withColumn("recordInsertTime", F.lit(1))
    stale = details.withColumns({"recordInsertTime": F.lit(0), "originatingDirection": F.lit("outbound")})
    got = star.store_all(stale.unionByName(details), str(tmp_path))
    assert sorted(got) == sorted(star.FROM_PAYLOADS)
    newest = star.latest_payloads(details)
    for name, table in got.items():
        assert rows(table) == rows(getattr(star, name)(newest)), name


@pytest.mark.parametrize("name", ["d12_conversations", "d12_participants", "d12_sessions", "d12_segments", "d12_metrics", "d13_flows", "d13_flow_outcomes"])
def test_star_tables_need_no_shuffle_of_their_own(spark, name):
    text = plan(REGISTRY[name](spark, FOLDER))
    assert "Exchange hashpartitioning" not in text and "WindowGroupLimit" not in text
