from pyspark.sql import functions as F

from callweave.functions import times as tm
from callweave.operators import joins as jn
from callweave.operators import timeaxis as ta
from conftest import rows


def spans(spark, *pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "id int, s string, e string")
    return df.select("id", F.to_timestamp("s").alias("s"), F.to_timestamp("e").alias("e"))


def test_slices_sum_to_the_interval(spark):
    df = spans(
        spark,
        ("2024-01-01 10:05:00", "2024-01-01 12:31:07"),
        ("2024-01-01 10:00:00", "2024-01-01 10:30:00"),  # ends on a slot edge
        ("2024-01-01 23:59:59", "2024-01-02 00:00:01"),
    )
    for seconds in (900, 1800, 3600, 86400):
        cut = ta.slice_intervals(df, "s", "e", seconds)
        total = {r["id"]: r["t"] for r in cut.groupBy("id").agg(F.sum("timeDiff").alias("t")).collect()}
        assert total == {0: 8767, 1: 1800, 2: 2}
        assert cut.filter(F.col("timeDiff") <= 0).count() == 0
        assert cut.filter(F.col("timeDiff") > seconds).count() == 0


def test_edges_zero_length_and_open_intervals(spark):
    df = spans(spark, ("2024-01-01 10:00:00", "2024-01-01 10:30:00"), ("2024-01-01 10:00:00", "2024-01-01 10:00:00"), ("2024-01-01 10:00:00", None))
    assert [r["id"] for r in ta.slice_intervals(df, "s", "e", 1800).collect()] == [0]


def test_days_end_one_second_before_midnight(spark):
    df = spans(spark, ("2024-01-01 22:00:00", "2024-01-03 01:00:00"))
    got = [(str(r["s"]), str(r["e"])) for r in ta.split_days(df, "s", "e").orderBy("day").collect()]
    assert got == [
        ("2024-01-01 22:00:00", "2024-01-01 23:59:59"),
        ("2024-01-02 00:00:00", "2024-01-02 23:59:59"),
        ("2024-01-03 00:00:00", "2024-01-03 01:00:00"),
    ]


def test_clock_change_gap_and_overlap(spark):
    df = spark.createDataFrame(
        [("2024-03-10 02:30:00", "America/New_York"), ("2024-11-03 01:30:00", "America/New_York"), ("2024-03-31 02:00:00", "Europe/Berlin"), ("2024-03-31 03:00:00", "Europe/Berlin")],
        "t string, z string",
    ).select(F.to_timestamp("t").alias("t"), "z")
    ok = [r[0] for r in df.select(tm.exists_in_zone(F.col("t"), F.col("z"))).collect()]
    assert ok == [False, True, False, True]


def test_dense_axis_has_zeros(spark):
    df = spans(spark, ("2024-01-01 00:20:00", None), ("2024-01-01 00:15:00", None)).withColumn("q", F.lit("q"))
    out = ta.starts_per_slot(df, ["q"], "s", 900, "2024-01-01 00:00:00", "2024-01-01 01:00:00").orderBy("slot")
    assert [r["n"] for r in out.collect()] == [0, 2, 0, 0]


def test_interval_join_matches_brute_force(spark):
    points = spark.range(0, 300).select((F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id") * 97).alias("at"), "id")
    ranges = spark.range(0, 60).select(
        (F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id") * 500).alias("s"), F.timestamp_seconds(F.col("id") * 500 + (F.col("id") % 7) * 400).alias("e"), F.col("id").alias("rid")
    )
    got = rows(jn.interval_join(points, ranges, ["k"], "at", "s", "e", slot_seconds=600).select("id", "rid"))
    p, r = points.collect(), ranges.collect()
    expected = sorted(((a["id"], b["rid"]) for a in p for b in r if a["k"] == b["k"] and b["s"] <= a["at"] <= b["e"]), key=str)
    assert got == expected and len(got) > 50
