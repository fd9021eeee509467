import random

import pytest
from pyspark.sql import functions as F

from callweave.operators import ordered
from conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, a null key, nulls among the values."""
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rnd.randint(0, 200)}")
        data.append((key, i, None if rnd.random() < 0.2 else rnd.randint(-50, 50)))
    rnd.shuffle(data)
    return spark.createDataFrame(data, "key string, at long, v long")


OPS = dict(row_number="no", lag={"prev": "v"}, lead={"next": "v"}, running_max={"peak": "v"}, running_sum={"total": "v"})


def test_hot_keys_are_split_without_changing_results(skewed):
    plain = ordered.with_ordered(skewed, ["key"], ["at"], **OPS)
    split = ordered.with_ordered(skewed, ["key"], ["at"], split=True, **OPS)
    assert rows(plain) == rows(split.select(*plain.columns))
    assert plain.count() == 3000


def test_every_key_split(skewed):
    plain = ordered.with_ordered(skewed, ["key"], ["at"], **OPS)
    split = ordered.with_ordered(skewed, ["key"], ["at"], split=True, **OPS)
    assert rows(plain) == rows(split.select(*plain.columns))


def test_rank_with_ties_on_a_hot_key(spark, skewed):
    tied = skewed.withColumn("score", F.col("at") % 7)
    skewed_rank = ordered.with_rank(tied, ["key"], ["score"], "rnk", split=True)
    tied.createOrReplaceTempView("tied")
    expected = spark.sql("select key, at, v, score, rank() over (partition by key order by score) as rnk from tied")
    assert rows(skewed_rank.select("key", "at", "v", "score", F.col("rnk").cast("int"))) == rows(expected)


def test_number_all_is_dense_and_ordered(spark, skewed):
    out = ordered.number_all(skewed, ["at"], "no", start=11).select("at", "no").orderBy("at").collect()
    assert [r["no"] for r in out] == list(range(11, 3011))


def test_newest_limits_before_the_shuffle(skewed):
    plan = ordered.newest(skewed, ["key"], F.col("at").desc())._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_empty_input(spark):
    empty = spark.createDataFrame([], "key string, at long, v long")
    assert ordered.with_ordered(empty, ["key"], ["at"], **OPS).count() == 0
    assert ordered.number_all(empty, ["at"], "no").count() == 0


@pytest.mark.parametrize("values", [1, 3, 40])
def test_rank_of_ties_over_several_partitions(spark, values):
    """A tie may fill whole partitions; its rows rank alike wherever they are."""
    rnd = random.Random(values)
    data = [("hot" if i % 2 else f"k{i % 7}", rnd.choice([None, *range(values - 1)]), rnd.randrange(2)) for i in range(2000)]
    df = spark.createDataFrame(data, "key string, score long, part long").repartition(4)
    plain = ordered.with_rank(df, ["key"], ["score", "part"], "rnk")
    split = ordered.with_rank(df, ["key"], ["score", "part"], "rnk", split=True)
    assert rows(split) == rows(plain) and split.columns == plain.columns
    assert split.schema["rnk"].dataType == plain.schema["rnk"].dataType


def test_rank_reads_its_input_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 3 as key", "id % 10 as score").write.parquet(f"{tmp_path}/once")
    df = ordered.with_rank(spark.read.parquet(f"{tmp_path}/once"), ["key"], ["score"], "rnk", split=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"{tmp_path}/once" not in plan and "Exchange rangepartitioning" not in plan
