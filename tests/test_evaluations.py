"""Scores of evaluations are brought together by one shuffle, whatever is delivered twice or in part."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from callweave.plans import dashboards as db
from callweave.plans import evaluations as evp
from callweave.plans import kpi_sets as ks
from callweave.queries.registry import REGISTRY

QUESTION = "struct<questionId:string,answerId:string,comments:string,failedKillQuestion:boolean,score:bigint>"
GROUP = f"struct<questionGroupId:string,markedNA:boolean,totalScore:double,maxTotalScore:double,questionScores:array<{QUESTION}>>"
A, B, FAILED, UNKNOWN = ("q1", "a1", None, False, 1), ("q2", "a2", "note", False, 2), ("q3", "a3", None, True, 0), ("q4", "a4", None, None, None)


def group(name, total, questions, top=50.0):
    return (name, False, total, top, questions)


DELIVERED = [
    # the same payload twice, and once more with another total and other questions
    *[("e1", ([group("g1", 10.0, [A]), group("g2", 20.0, [B, FAILED, FAILED])],))] * 2,
    ("e1", ([group("g1", 11.0, [A, UNKNOWN]), group("g1", 10.0, [B], 40.0)],)),
    # groups whose questions come in another delivery, or never, or without an id
    ("e2", ([group("g1", 5.0, None), group("g2", 6.0, [])],)),
    ("e2", ([group("g1", None, [A, None]), group(None, 7.0, [A]), None],)),
    ("e3", ([],)),
    ("e4", (None,)),
    ("e5", None),
    ("e6", ([group("g1", 9.0, [UNKNOWN])],)),
    ("no evaluation", ([group("g1", 1.0, [A])],)),
    (None, ([group("g1", 1.0, [A])],)),
]
ROWS = [
    *[("e1", "u1", "west", "voice", "f1", "2024-01-01 03:00:00")] * 2,
    ("e1", "u1", "west", "voice", "f2", "2024-01-01 03:00:00"),
    ("e2", "u1", "east", "chat", "f1", "2024-01-01 12:00:00"),
    ("e2", "u2", "nowhere", "voice", "f1", "2024-01-01 12:00:00"),
    *[(f"e{i}", None, "east", "voice", "f1", "2024-01-02 12:00:00") for i in (3, 4, 5, 6)],
    ("e6", "u3", None, "voice", None, None),
    ("no payload", "u1", "east", "voice", "f1", "2024-01-01 12:00:00"),
    (None, "u1", "east", "voice", "f1", "2024-01-01 12:00:00"),
]


@pytest.fixture()
def delivered(spark):
    payloads = spark.createDataFrame(DELIVERED, f"id string, answers struct<questionGroupScores:array<{GROUP}>>")
    evaluations = spark.createDataFrame(ROWS, "evaluationId string, agentId string, queueId string, mediaType string, evaluationFormId string, at string")
    return payloads, evaluations.withColumn("conversationDate", F.col("at").cast("timestamp")).drop("at")


def by_joins(payloads, evaluations, queues):
    """The definition: distinct groups, distinct questions and distinct evaluations joined as tables."""
    counts = evp.question_scores(payloads).groupBy("evaluationId", "questionGroupId").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("failedKillQuestion")).alias("passed")
    )
    r = evp.group_scores(payloads).join(counts, ["evaluationId", "questionGroupId"]).join(evaluations.distinct(), "evaluationId").join(queues, "queueId")
    voice = F.col("mediaType") == "voice"
    reached, reachable = F.sum(F.col("totalScore") * F.col("n")), F.sum(F.col("maxTotalScore") * F.col("n"))
    return r.groupBy(F.col("agentId").alias("userId"), ks.local_date("conversationDate").alias("date")).agg(
        F.sum(F.when(voice, F.col("totalScore") * F.col("passed") * 100).otherwise(0)).alias("score_voice"),
        F.sum(F.when(voice, F.col("maxTotalScore") * F.col("n")).otherwise(0)).alias("max_voice"),
        (reached * 100 / reachable).alias("quality_score"),
    )


def test_lists_hold_the_distinct_scores(delivered):
    payloads, evaluations = delivered
    lists = evp.question_scores(evp.group_scores(evp.gathered(payloads, evaluations), in_place=True), in_place=True)
    both = payloads.join(evaluations, F.col("id") == F.col("evaluationId"), "left_semi")
    for make, column in ((evp.group_scores, "groupScores"), (evp.question_scores, "questionScores")):
        assert rows(lists.select("evaluationId", F.explode(column).alias("x")).select("evaluationId", "x.*")) == rows(make(both))
    known = lists.select("evaluationId", F.explode("evaluations").alias("e")).select("evaluationId", "e.*")
    assert rows(known) == rows(evaluations.distinct().join(payloads.filter("answers.questionGroupScores is not null"), F.col("id") == F.col("evaluationId"), "left_semi"))


def test_quality_and_question_summary(spark, delivered):
    payloads, evaluations = delivered
    queues = spark.createDataFrame([("west", "America/New_York"), ("east", "Asia/Kolkata")], "queueId string, timeZone string")
    scores = evp.question_scores(evp.group_scores(evp.gathered(payloads, evaluations), in_place=True), in_place=True)
    got = rows(ks.quality_kpis(scores, queues))
    assert got == rows(by_joins(payloads, evaluations, queues)) and len(got) == 3
    want = evp.question_scores(payloads).join(evaluations.distinct(), "evaluationId").groupBy("evaluationFormId", "questionId").agg(
        F.count(F.lit(1)), F.count_if("failedKillQuestion"), F.sum("score")
    )
    assert rows(db.question_score_summary(scores)) == rows(want)


@pytest.mark.parametrize(
    "name, shuffles",
    [("d35_quality_kpis", 1), ("d33_question_scores", 1), ("d35_evaluation_form_kpis", 2), ("d33_evaluation_details", 2)],
)
def test_evaluations_are_shuffled_once(spark, name, shuffles):
    """By their id and nothing else: one shuffle for each table, or one for both."""
    text = REGISTRY[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    keys = [k for k in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text) if "evaluationId" in k]
    assert len(keys) == shuffles and all("," not in k for k in keys), keys
