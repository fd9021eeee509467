import pytest
from pyspark.sql import functions as F

from callweave.operators import joins as jn
from callweave.plans import conversations as cv
from callweave.plans import process as pr
from callweave.plans import transcripts as tr
from conftest import rows


def steps(spark, *names):
    data = [("c", 20240101, i, i + 2, n, float(i)) for i, n in enumerate(names)]
    df = spark.createDataFrame(data, "conversationId string, conversationStartDateId int, s int, e int, stepName string, sentiment double")
    return df.select("conversationId", "conversationStartDateId", F.timestamp_seconds("s").alias("startTime"), F.timestamp_seconds("e").alias("endTime"), "stepName", "sentiment")


def config(spark):
    return spark.createDataFrame([("Greet", 1, 1.0), ("Close", 2, 2.0), ("Recap", 3, 3.0)], "stepName string, counterStep int, value double")


def test_counts_between_expected_steps_go_to_the_earlier_one(spark):
    df = steps(spark, "Hold", "Greet", "Hold", "Odd", "Odd", "Transfer", "Close", "Hold")
    out = {r["steps"]: r for r in pr.complexity(df, config(spark), close="Close").collect()}
    greet, close, recap = out["Greet"], out["Close"], out["Recap"]
    assert (greet["hold"], greet["transfer"], greet["violation"], greet["distinct_violation_count"]) == (1, 1, 2, 1)
    assert (close["hold"], close["transfer"], close["violation"]) == (0, 0, 0)
    assert (recap["step_count"], recap["step_done"]) == (0, 0)
    assert close["is_last_step"] and not greet["is_last_step"]
    assert greet["is_last_before_close"] and not close["is_last_before_close"]


def test_conversation_without_expected_steps_gets_zero_rows(spark):
    out = pr.complexity(steps(spark, "Hold", "Odd"), config(spark)).collect()
    assert len(out) == 3 and all(r["step_done"] == 0 and r["hold"] == 0 for r in out)


def test_both_ways_agree(spark):
    df = steps(spark, "Greet", "Hold", "Greet", "Odd", "Close", "Transfer", "Greet", "Greet", "Other", "Close")
    columns = ["conversationId", "steps", "step_count", "hold", "transfer", "violation"]
    # a step without a name and one without a time, which comes first
    odd = df.limit(1).withColumn("startTime", F.lit(None).cast(df.schema["startTime"].dataType)).withColumn("stepName", F.lit("Early"))
    unnamed = df.limit(4).withColumn("stepName", F.lit(None).cast("string"))
    df = df.unionByName(odd).unionByName(unnamed)
    one = pr.complexity(df, config(spark), close="Close").select(*columns)
    for size in (1, 3, 50_000):
        assert rows(pr.complexity_by_group(df, config(spark), group_rows=size).select(*columns)) == rows(one)


def test_many_configured_steps(spark):
    wide = spark.range(1500).select(F.format_string("s%d", "id").alias("stepName"), F.col("id").cast("int").alias("counterStep"), F.lit(1).alias("value"))
    out = pr.complexity(steps(spark, "s3", "Hold", "s7"), wide)
    assert out.count() == 1500 and out.filter("step_done = 1").count() == 2


def test_a_wrong_end_line_is_clipped(spark):
    said = spark.createDataFrame([("c", 1, 1.0), ("c", 2, 0.0), ("c", 5, -1.0)], "conversationId string, phraseIndex long, sentiment double")
    st = spark.createDataFrame([("c", "far", 2, 10**9), ("c", "all", -(10**9), 10**9), ("c", "none", 7, 10**9)], "conversationId string, stepName string, startLine long, endLine long")
    out = tr.mean_sentiment(st, said, ["stepName", "startLine", "endLine"]).collect()
    assert {r["stepName"]: r["sentiment"] for r in out} == {"far": -0.5, "all": 0.0}


def test_spans_without_an_end_stay_small(spark):
    spans = spark.createDataFrame(
        [("u", 1, "2024-01-01 00:00:00", "9999-12-31 00:00:00"), ("u", 2, "2024-01-01 00:00:00", "2024-01-03 05:00:00"), ("u", 3, "2024-01-05 00:00:00", "2024-01-04 00:00:00"), ("u", 4, "1970-01-01 00:00:00", "2024-01-02 00:00:00")],
        "k string, span int, s string, e string",
    ).select("k", "span", F.to_timestamp("s").alias("s"), F.to_timestamp("e").alias("e"))
    points = spark.createDataFrame([("u", 1, "2024-01-02 00:00:00"), ("u", 2, "2024-01-03 05:00:01"), ("u", 3, "1999-01-01 00:00:00"), ("v", 4, "2024-01-02 00:00:00")], "k string, p int, at string")
    points = points.withColumn("at", F.to_timestamp("at"))
    for seconds in (60, 3600, 86400):
        out = jn.interval_join(points, spans, ["k"], "at", "s", "e", slot_seconds=seconds)
        assert sorted((r["p"], r["span"]) for r in out.collect()) == [(1, 1), (1, 2), (1, 4), (2, 1), (3, 4)]


def test_days_of_an_end_before_the_start(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert jn.day_spine(df, F.to_date(F.lit("2024-01-02")), F.to_date(F.lit("2024-01-01"))).count() == 0


def test_long_comments_stay_whole(spark):
    from callweave.functions import text as tx

    assert spark.range(1).select(F.length(tx.clean_cell(F.repeat(F.lit("a"), 10_000)))).first()[0] == 10_000


def test_offsets_beyond_an_int(spark):
    from callweave.functions import times as tm

    out = spark.range(1).select(tm.shifted(F.to_timestamp(F.lit("2024-01-01 00:00:00")), F.lit(2**33)).cast("string")).first()[0]
    assert out == "2296-03-15 12:56:32"


def test_formulas_with_comments_are_refused(spark):
    from callweave.operators import kpi

    for text in ("a -- b", "a /* b */"):
        with pytest.raises(kpi.BadFormula):
            kpi.checked(text, ["a", "b"])
    df = spark.createDataFrame([("x", 2.0, 4.0)], "k string, a double, b double")
    assert kpi.ratio_kpis(df, [kpi.Formula("q", "a", "sum", "b", "sum")], ["k"]).first()["value"] == 0.5


def test_last_handled_prefers_a_coded_segment(spark):
    df = spark.createDataFrame(
        [("a", "s1", 1, "code"), ("a", "s2", 9, None), ("b", "s3", 1, None), ("b", "s4", 2, None)], "conversationId string, sessionId string, segmentEnd int, wrapUpCode string"
    )
    assert rows(cv.last_handled(df).select("conversationId", "sessionId")) == [("a", "s1"), ("b", "s4")]


def test_anchors_turn_around_and_miss(spark):
    lines = spark.createDataFrame([("c", 1, 1000, 500), ("c", 2, 5000, 2000)], "conversationId string, line long, startTimeMs long, milliseconds long")
    st = spark.createDataFrame([("c", "back", 2, 1), ("c", "half", 2, 9), ("c", "none", 8, 9)], "conversationId string, stepName string, startLine long, endLine long")
    out = tr.anchored_times(st, lines, ["stepName", "startLine", "endLine"], keep_unanchored=True)
    got = {r["stepName"]: (r["startTime"] and r["startTime"].second, r["endTime"] and r["endTime"].second) for r in out.collect()}
    assert got == {"back": (1, 5), "half": (5, 5), "none": (None, None)}


def test_assembled_text_is_split_into_parts(spark):
    from callweave.operators import aggregates as ag

    df = spark.range(1, 26).select(F.lit("c").alias("conversationId"), F.col("id").alias("line"))
    out = ag.assemble_lines(df, "conversationId", "line", F.col("line").cast("string"), "t", lines_per_part=10).orderBy("part").collect()
    assert [r["part"] for r in out] == [0, 1, 2]
    assert "\n".join(r["t"] for r in out).split("\n") == [str(i) for i in range(1, 26)]


def test_name_with_three_parts_and_ties(spark):
    people = spark.createDataFrame([(1, None, "Ann", "Mary", "Lee"), (2, "LOG", "Bob", "", "Roy")], "pid int, login string, f string, m string, l string")
    people = people.withColumn("variants", jn.name_variants(F.col("f"), F.col("m"), F.col("l")))
    users = spark.createDataFrame(
        [(10, "x", "lee ann mary", False), (11, "y", "Ann Lee", True), (12, "log", "Someone Else", False), (13, "z", "Roy Bob", True)], "id int, login_name string, name string, active boolean"
    )
    out = jn.match_names(people, users, "pid", "login", "variants", "login_name", "name", "active", "id")
    assert rows(out) == [(1, 11, "name"), (2, 12, "login")]
