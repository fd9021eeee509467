import pytest
from pyspark.sql import functions as F

from callweave.operators import upserts as up
from callweave.session import scratch_path
from conftest import rows


@pytest.fixture()
def tables(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "id int, v string")
    return target, source


def test_merge_is_idempotent(tables):
    target, source = tables
    once = up.merge_all(target, source, ["id"])
    assert rows(once) == rows(up.merge_all(once, source, ["id"]))
    assert rows(once) == [(1, "a"), (2, "B"), (3, "C"), (None, "N")]


def test_null_keys_always_insert_with_plain_equality(tables):
    target, source = tables
    assert up.merge_all(target, source, ["id"], null_safe=False).filter("id is null").count() == 2


def test_merge_equals_replace_for_unique_keys(tables):
    target, source = (t.filter("id is not null") for t in tables)
    assert rows(up.merge_all(target, source, ["id"])) == rows(up.replace_matching(target, source, ["id"]))


def test_duplicate_source_keys_fail(tables):
    target, source = tables
    with pytest.raises(up.DuplicateKeys):
        up.merge_all(target, source.union(source), ["id"])


def test_insert_only_and_delete(tables):
    target, source = tables
    assert rows(up.merge_new(target, source, ["id"])) == [(1, "a"), (2, "b"), (3, "C"), (None, "n")]
    assert rows(up.merge_delete(target, source, ["id"])) == [(1, "a"), (None, "n")]


def test_partition_replace_touches_only_its_partitions(spark):
    path = scratch_path(spark, "t")
    schema = "v int, p string"
    first = spark.createDataFrame([(1, "x"), (2, "y")], schema)
    up.replace_partitions(first, path, ["p"])
    assert not up.replace_partitions(first.filter("v > 9"), path, ["p"])
    up.replace_partitions(spark.createDataFrame([(3, "y"), (4, "y")], schema), path, ["p"])
    table = spark.read.schema(schema).parquet(path)
    assert rows(table) == [(1, "x"), (3, "y"), (4, "y")]
    up.commit_partitions(table.filter("p = 'y'").withColumn("v", F.col("v") * 10), path, ["p"])
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, "x"), (30, "y"), (40, "y")]


def test_empty_batch_keeps_the_table(spark):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([(1,)], "v int")
    assert up.overwrite_unless_empty(df, path)
    assert not up.overwrite_unless_empty(df.filter("v > 1"), path)
    assert rows(spark.read.parquet(path)) == [(1,)]


def test_interval_guard(spark):
    good = spark.sql("select timestamp'2024-01-01 00:00:00' s, timestamp'2024-01-01 00:15:00' e")
    up.guard_interval(good, "s", "e", 900)
    with pytest.raises(up.BadInterval):
        up.guard_interval(good.withColumn("e", F.col("e") + F.expr("interval 1 second")), "s", "e", 900)
    with pytest.raises(up.BadInterval):
        up.guard_interval(good.withColumn("e", F.lit(None).cast("timestamp")), "s", "e", 900)


def test_rolling_reload(spark):
    schema = "d date, v string"
    old = spark.createDataFrame([("2024-01-01", "old"), ("2024-03-28", "old")], "d string, v string").select(F.to_date("d").alias("d"), "v")
    new = spark.createDataFrame([("2024-03-28", "new"), ("2024-01-01", "new")], "d string, v string").select(F.to_date("d").alias("d"), "v")
    out = up.rolling_reload(old, new, "d", F.to_date(F.lit("2024-03-30")), 5, 12)
    assert [r[1] for r in rows(out)] == ["old", "new"], schema
