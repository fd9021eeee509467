"""What is shuffled and stored: tables made as they are read, one shuffle by the key of a report."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from callweave.operators import joins as jn
from callweave.operators import marks
from callweave.operators import upserts as up
from callweave.queries.registry import REGISTRY
from callweave.sources import tables
from callweave.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def few(spark, tmp_path):
    """A folder of some orders and their lines; an order comes twice, one has no lines and some lines have no order."""
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").filter("l_orderkey < 60")
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").filter("o_orderkey between 5 and 70")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders.unionByName(orders.filter("o_orderkey < 10")).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def landed(folder):
    return {k[2] for k in tables._landed if k[1] == folder}


def test_star_tables_are_made_as_they_are_read(spark, few):
    t = Tables(spark, few)
    for name in ("participants", "segments", "metrics", "insights", "menus"):
        assert "startMonth" in t.star(name).columns
    assert landed(few) == {"sessions by month", "orders by month"}
    stored = set(tables._landed[t._key("sessions by month")].columns)
    assert {"l_orderkey", "startMonth"} <= stored and not stored & {"conversationId", "sessionId", "l_extendedprice"}


def test_actions_need_no_sessions(spark, few):
    assert not REGISTRY["d19_raw_actions"](spark, few).isEmpty()
    assert landed(few) == {"orders by month"}


def test_lines_in_many_splits_are_not_landed(spark, few, tmp_path):
    lines = spark.read.parquet(f"{few}/lineitem.parquet")
    lines.repartition(32).write.parquet(f"{tmp_path}/many/lineitem.parquet")
    t = Tables(spark, f"{tmp_path}/many")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert all("/lineitem.parquet/" in f for f in t.line_sessions().inputFiles())
        assert rows(t.line_sessions()) == rows(Tables(spark, few).line_sessions())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_scores_are_shuffled_by_their_evaluation_alone(spark):
    """Scores once, stored rows under other keys once; merging and dropping repeated rows happen in place."""
    for name in ("d6_evaluation_question_scores", "p14_export_question_scores"):
        keys = {x.split("hashpartitioning(")[1].split("#")[0] for x in plan(REGISTRY[name](spark, FOLDER)).split("\n") if "Exchange hashpartitioning(" in x and "sessionId" not in x}
        keys -= {"l_orderkey"}
        assert keys == {"evaluationId"}


def test_sides_spread_by_a_key_are_merged_in_place(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("a", None, "x"), (None, 1, "x"), ("b", 2, "x"), ("b", 2, "y"), (None, None, None)], "k string, n int, v string")
    new = spark.createDataFrame([("a", None, "new"), (None, 1, "new"), ("b", 3, "new"), ("b", 3, "new")], "k string, n int, v string")
    got = up.merge_all(jn.spread_finely(old, "k"), jn.spread_finely(new, "k"), ["k", "n"], check=False, beside=True)
    assert rows(got) == rows(up.merge_all(old, new, ["k", "n"], check=False))
    assert got.columns == old.columns


def test_marks_hold_every_wanted_key(spark):
    table = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("k"), "id").unionByName(spark.createDataFrame([(None, -1)], "k string, id long"))
    wanted = table.filter("id % 40 = 0 or k is null")
    got = marks.possible(table, wanted, "k")
    assert got.join(wanted, "id", "left_semi").count() == wanted.count()
    # false marks are few
    assert got.count() < wanted.count() + 400
    assert marks.possible(table, wanted.limit(0), "k").isEmpty()


@pytest.mark.parametrize("name", ["d18_process_map", "d18_ivr_export", "d19_curated_steps"])
def test_facts_of_a_map_are_shuffled_once_by_conversation(spark, name):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(REGISTRY[name](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    # below the joins of the facts, rows are marked first and never shuffled by the conversation and another column
    assert "getbit" in text
    assert not re.search(r"hashpartitioning\((startMonth#\d+, conversationId#|conversationId#\d+, participantId#)", text)


def test_wanted_rows_agree_in_part_and_key(spark):
    table = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (1, "b", 3), (None, "a", 4), (1, None, 5)], "m int, k string, v int")
    wanted = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (1, None), (2, "b")], "m int, k string")
    assert rows(jn.of_wanted(table, wanted, "m", ["k"]).select("m", "k", "v")) == [(1, "a", 1)]
