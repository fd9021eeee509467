"""Evaluations and surveys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.operators import joins as jn
from callweave.operators import nested as ns
from callweave.operators.projections import date_id
from callweave.plans.conversations import last_handled


def evaluations(payloads: DataFrame, segments: DataFrame, keep_unmatched: bool = True) -> DataFrame:
    """Evaluations with queue and code of the last handled segment of the same conversation and day."""
    e = payloads.select(
        F.col("id").alias("evaluationId"),
        F.col("evaluator.id").alias("evaluatorId"),
        F.col("agent.id").alias("agentId"),
        F.col("conversation.id").alias("conversationId"),
        F.col("evaluationForm.id").alias("evaluationFormId"),
        "status",
        "releaseDate",
        ns.first_item("mediaType").alias("mediaType"),
        F.col("answers.anyFailedKillQuestions").alias("anyFailedKillQuestions"),
        F.date_format("extractDate", "yyyy-MM-dd").alias("conversationDatePart"),
    ).distinct()
    evaluated = e.select("conversationId").distinct()
    last = last_handled(segments.join(evaluated, "conversationId", "left_semi")).select(
        "conversationId",
        "queueId",
        "wrapUpCode",
        F.date_format("segmentStart", "yyyy-MM-dd").alias("conversationDatePart"),
    )
    return e.join(last, ["conversationId", "conversationDatePart"], "left" if keep_unmatched else "inner")


def total_scores(payloads: DataFrame) -> DataFrame:
    scores = payloads.select(F.col("id").alias("evaluationId"), "answers.totalScore", "answers.totalCriticalScore")
    return jn.distinct_by(scores, "evaluationId")


_GROUP = ["questionGroupId", "totalScore", "maxTotalScore"]
_QUESTION = ["questionId", "answerId", "comments", "failedKillQuestion", "score"]


def gathered(payloads: DataFrame, evaluations: DataFrame) -> DataFrame:
    """What was delivered of an evaluation in one row: ``deliveries`` are the distinct lists of question groups in its payloads,
    ``evaluations`` its distinct rows in the table of that name. Evaluations without either are left out, as by an inner join.

    Payloads are cut to the fields in use; both sides are shuffled and sorted once by the evaluation, and nothing is compared before.
    """
    wanted = {**dict.fromkeys(_GROUP), "questionScores": dict.fromkeys(_QUESTION)}
    groups = ns.only_fields(F.col("answers.questionGroupScores"), wanted)
    row = F.struct(*[c for c in evaluations.columns if c != "evaluationId"])
    both = payloads.select(F.col("id").alias("evaluationId"), groups.alias("groups")).unionByName(
        evaluations.select("evaluationId", row.alias("evaluation")), allowMissingColumns=True
    )
    first = Window.partitionBy("evaluationId").orderBy(F.col("groups").isNull())
    every = first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sets = both.filter("evaluationId is not null and (groups is not null or evaluation is not null)").select(
        "evaluationId",
        F.collect_set("groups").over(every).alias("deliveries"),
        F.collect_set("evaluation").over(every).alias("evaluations"),
        F.row_number().over(first).alias("_row"),
    )
    return sets.filter("_row = 1 and size(deliveries) > 0 and size(evaluations) > 0").drop("_row")


def _delivered_groups() -> Column:
    return F.flatten("deliveries")


def group_scores(payloads: DataFrame, in_place: bool = False) -> DataFrame:
    """Distinct scores of question groups, one row each; ``in_place`` adds them as the list ``groupScores`` to `gathered` payloads,
    whose rows need no comparison with others."""
    if in_place:
        scores = F.transform(_delivered_groups(), lambda g: F.struct(*[g[c].alias(c) for c in _GROUP]))
        return payloads.withColumn("groupScores", F.array_distinct(scores))
    return ns.flatten(
        payloads,
        [F.col("id").alias("evaluationId"), *[F.col(f"g.{c}") for c in _GROUP]],
        ("answers.questionGroupScores", "g"),
    ).distinct()


def question_scores(payloads: DataFrame, in_place: bool = False) -> DataFrame:
    """Distinct scores of questions, one row each, spread finely by their evaluation; ``in_place`` adds them as the list ``questionScores`` to
    `gathered` payloads."""
    if in_place:

        def scores(g: Column) -> Column:
            return F.transform(g["questionScores"], lambda q: F.struct(g["questionGroupId"].alias("questionGroupId"), *[q[c].alias(c) for c in _QUESTION]))

        lists = F.filter(F.transform(_delivered_groups(), scores), lambda x: x.isNotNull())
        return payloads.withColumn("questionScores", F.array_distinct(F.flatten(lists)))
    scores = ns.flatten(
        payloads,
        [F.col("id").alias("evaluationId"), F.col("g.questionGroupId"), *[F.col(f"q.{c}") for c in _QUESTION]],
        ("answers.questionGroupScores", "g"),
        ("g.questionScores", "q"),
    )
    return jn.spread_finely(scores, "evaluationId").distinct()


def conversation_surveys(details: DataFrame) -> DataFrame:
    return ns.flatten(
        details.filter("surveys is not null"),
        [
            "conversationId",
            "conversationStart",
            "originatingDirection",
            F.col("x.userId").alias("agentId"),
            F.col("x.queueId"),
            F.col("x.surveyId"),
            F.col("x.surveyStatus"),
            F.col("x.surveyPromoterScore"),
            F.col("x.oSurveyTotalScore"),
            F.col("x.eventTime").try_cast("date").alias("eventDate"),
        ],
        ("surveys", "x"),
    )


def star_evaluations(payloads: DataFrame) -> DataFrame:
    """Evaluation dimension with the date key of its conversation."""
    return payloads.select(
        F.col("id").alias("evaluationId"),
        F.col("conversation.id").alias("conversationId"),
        F.col("evaluator.id").alias("evaluatorId"),
        F.col("agent.id").alias("agentId"),
        F.col("evaluationForm.id").alias("evaluationFormId"),
        "status",
        date_id(F.col("extractDate")).alias("conversationStartDateId"),
    ).distinct()


def star_evaluation_scores(payloads: DataFrame) -> DataFrame:
    """Scores of finished evaluations."""
    return payloads.filter("status = 'FINISHED'").select(
        F.col("id").alias("evaluationId"),
        F.col("conversation.id").alias("conversationId"),
        "answers.totalScore",
        "answers.totalCriticalScore",
        date_id(F.col("extractDate")).alias("conversationStartDateId"),
    ).distinct()


def star_surveys(details: DataFrame) -> DataFrame:
    s = conversation_surveys(details)
    day = date_id(F.col("conversationStart")).alias("conversationStartDateId")
    return s.select("surveyId", "conversationId", "agentId", "queueId", "surveyStatus", day).distinct()


def star_survey_scores(details: DataFrame) -> DataFrame:
    """Scores of finished surveys."""
    s = conversation_surveys(details).filter("surveyStatus = 'Finished'")
    day = date_id(F.col("conversationStart")).alias("conversationStartDateId")
    return s.select(
        "surveyId", "conversationId", F.col("surveyPromoterScore").alias("npsScore"), F.col("oSurveyTotalScore").alias("totalScore"), day
    ).distinct()
