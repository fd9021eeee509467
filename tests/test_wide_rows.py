"""Wide payloads are neither stored for one pass nor sorted before they are cut to the fields in use."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from callweave.operators import nested as ns
from callweave.plans import process as pr
from callweave.plans import star
from callweave.plans import surveys as sv
from callweave.queries.registry import REGISTRY
from callweave.sources import star as star_source
from callweave.sources import tables, writers
from callweave.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below_first_shuffle(df):
    """Operators from the scans up to the payloads' shuffle."""
    text = plan(df)
    return text[text.rindex("REPARTITION_BY_COL") :]


def test_few_splits_are_dealt_out_without_sorting_them(spark, tmp_path):
    few = spark.range(0, 1000, 1, 1).withColumn("m", F.create_map("id", "id"))
    text = plan(writers.spread(few))
    assert "hashpartitioning(id" in text and "RoundRobin" not in text
    assert "Exchange" not in plan(writers.spread(spark.range(0, 1000, 1, 64)))
    writers.land_balanced(few, str(tmp_path))
    assert spark.read.parquet(str(tmp_path)).count() == 1000


@pytest.mark.parametrize("name", ["n1_flatten_levels", "n2_first_last_elements", "n8_array_elements", "p15_export_surveys", "d14_survey_fact"])
def test_payloads_are_not_stored_for_one_pass(spark, tmp_path, name):
    spark.read.parquet(f"{FOLDER}/lineitem.parquet").limit(300).write.parquet(f"{tmp_path}/lineitem.parquet")
    REGISTRY[name](spark, str(tmp_path)).collect()
    assert {k[2] for k in tables._landed if k[1] == str(tmp_path)} == {"sessions"}


def delivered_twice(spark):
    details = Tables(spark, FOLDER).payloads().limit(300).withColumn("recordInsertTime", F.lit(2))
    stale = details.withColumns({"recordInsertTime": F.lit(1), "originatingDirection": F.lit("outbound")})
    return details, stale.unionByName(details).unionByName(details)


@pytest.mark.parametrize("name", star.FROM_PAYLOADS)
def test_a_table_of_the_newest_payloads_takes_what_it_uses(spark, name):
    details, every = delivered_twice(spark)
    cut = star.latest_payloads(every, name)
    make = getattr(star, name)
    assert rows(make(cut)) == rows(make(details))
    assert "WindowGroupLimit" not in below_first_shuffle(cut)
    inside = cut.schema["participants"].simpleString()
    assert ("metrics" in inside) == (name == "metrics") and ("segments" in inside) == (name == "segments")


def test_star_tables_are_made_of_rows_by_month(spark, tmp_path):
    for name in ("lineitem", "orders"):
        some = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        some = some.filter(f"{some.columns[0]} < 200")
        # an order that comes twice gives its facts once for each
        some.unionByName(some.filter(f"{some.columns[0]} < 20")).write.parquet(f"{tmp_path}/{name}.parquet")
    t = Tables(spark, str(tmp_path))
    months = star_source.conversations(t.orders).select("conversationId", "startMonth")
    for name, source in [("metrics", t.line_sessions()), ("participants", t.line_sessions()), ("segments", t.line_sessions()), ("menus", t.orders), ("flows", t.orders)]:
        want = getattr(star_source, name)(source).join(months, "conversationId", "left")
        assert rows(t.star(name).select(*want.columns)) == rows(want)
    assert {k[2] for k in tables._landed if k[1] == str(tmp_path)} >= {"sessions by month", "orders by month"}


def test_only_fields(spark):
    a = spark.sql("SELECT array(named_struct('x', 1, 'y', array(named_struct('p', 2, 'q', 3), NULL)), NULL) AS a UNION ALL SELECT NULL")
    got = rows(a.select(ns.only_fields(F.col("a"), {"y": {"q": None}}).alias("a")).select(F.to_json(F.struct("a"))))
    assert got == [('{"a":[{"y":[{"q":3},null]},null]}',), ("{}",)]


def test_contacts_are_cut_before_they_are_shuffled(spark):
    details, every = delivered_twice(spark)
    queues = spark.range(25).select(F.concat(F.lit("queue-"), "id").alias("queueId"), F.lit("UTC").alias("timeZone"))
    customer = {"voice": "ani", "chat": "remote"}
    got = sv.contacts(every, queues, ["code-3"], customer)
    assert rows(got) == rows(sv.contacts(details, queues, ["code-3"], customer)) and not got.isEmpty()
    assert "WindowGroupLimit" not in below_first_shuffle(got)


def test_groups_follow_rows_and_not_conversations(spark):
    steps = spark.range(0, 400, 1, 2).select(
        F.col("id").cast("string").alias("conversationId"), F.lit(20240101).alias("conversationStartDateId"), F.timestamp_seconds("id").alias("startTime"),
        F.timestamp_seconds("id").alias("endTime"), F.lit("Greet").alias("stepName"), F.lit(0.0).alias("sentiment"),
    )
    config = spark.createDataFrame([("Greet", 1, 1.0)], "stepName string, counterStep int, value double")
    got = pr.complexity_by_group(steps, config)
    keys = re.search(r"FlatMapGroupsInPandas \[([^\]]*)\]", plan(got)).group(1)
    assert keys.startswith("part#") and "," not in keys
    assert got.count() == 400 and got.filter("step_count <> 1").isEmpty()


@pytest.mark.parametrize("name", ["d1_agent_sessions", "d2_interval_metric_fact"])
def test_a_batch_that_is_matched_and_written_is_computed_once(spark, name):
    text = plan(REGISTRY[name](spark, FOLDER))
    assert "Generate explode" not in text and "/stage-" in text
