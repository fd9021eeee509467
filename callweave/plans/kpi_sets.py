"""KPI sets per agent and day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.operators import aggregates as ag
from callweave.operators import joins as jn
from callweave.operators.projections import drop_empty


def local_date(ts: str, zone: str = "timeZone") -> Column:
    return F.to_date(F.from_utc_timestamp(ts, F.trim(F.coalesce(F.col(zone), F.lit("UTC")))))


def _is_chat() -> Column:
    return F.coalesce(F.col("messageType").isin("webmessaging", "open"), F.lit(False)) | (F.col("mediaType") == "chat")


def conversation_kpis(intervals: DataFrame, queues: DataFrame) -> DataFrame:
    """Handling times and counts by media class, per agent and local day."""
    rows = intervals.join(queues.select("queueId", "timeZone"), "queueId")
    voice, chat = F.col("mediaType") == "voice", _is_chat()

    def total(cond, col):
        return F.sum(F.when(cond, F.nullif(F.col(col), F.lit(0).cast("long"))))

    return rows.groupBy("userId", local_date("intervalStart").alias("date")).agg(
        total(voice, "tAcw").alias("tAcw_voice"),
        total(voice, "nAcw").alias("nAcw_voice"),
        total(voice, "tHeldComplete").alias("tHeldComplete_voice"),
        total(voice, "nHandle").alias("nHandle_voice"),
        total(voice, "tTalkComplete").alias("tTalkComplete_voice"),
        total(chat, "tAcw").alias("tAcw_chat"),
        total(chat, "nAcw").alias("nAcw_chat"),
        total(chat, "tTalkComplete").alias("tTalkComplete_chat"),
    )


def survey_kpis(surveys: DataFrame, intervals: DataFrame, queues: DataFrame) -> DataFrame:
    """Survey scores per agent and local day, weighted with the agent's intervals of the sending day.

    The intervals are first counted per (agent, day, zone, media class), so a survey meets a handful of
    weighted classes and not every interval. The conditions keep the OR of the published KPI.
    """
    classes = (
        intervals.join(queues.select("queueId", "timeZone"), "queueId")
        .groupBy("userId", "date", "timeZone", F.col("mediaType").alias("bMedia"), F.coalesce(F.col("messageType").isin("webmessaging", "open"), F.lit(False)).alias("bOpen"))
        .agg(F.count(F.lit(1)).alias("w"), F.sum(F.nullif(F.col("nAcw"), F.lit(0).cast("long"))).alias("acw"))
    )
    rows = surveys.join(classes, (surveys["surveyUser"] == classes["userId"]) & (surveys["surveySentDatePart"] == classes["date"])).drop("date")
    scored = F.coalesce(F.col("csatAchieved") != -1, F.lit(False))
    w = F.col("w")
    chat = scored | F.coalesce(F.col("mediaType") == "chat", F.lit(False)) | F.col("bOpen")
    voice = scored | F.coalesce(F.col("mediaType") == "voice", F.lit(False))
    return rows.groupBy("userId", local_date("surveyCompletionDate").alias("date")).agg(
        F.sum(F.when(chat, F.col("csatAchieved") * w).otherwise(0)).alias("agent_csat_sum_chat"),
        F.sum(F.when(chat, w)).alias("agent_csat_count_chat"),
        F.sum(F.when(voice, F.col("csatAchieved") * w).otherwise(0)).alias("agent_csat_sum_voice"),
        F.sum(F.when(voice, w)).alias("agent_csat_count_voice"),
        F.sum(F.when(F.col("bMedia") == "voice", F.col("acw")).otherwise(0)).alias("sum_tHandleCount_voice"),
        (F.sum(F.when(F.col("status") == "Completed", F.col("fcr") * w)) / F.sum(F.when((F.col("status") == "Completed") & F.col("fcr").isNotNull(), w))).alias("nfcr"),
    )


def quality_kpis(scores: DataFrame, queues: DataFrame) -> DataFrame:
    """Quality score per agent and local day: share of the reachable score over the questions answered.

    ``scores`` has one row per evaluation with the lists ``groupScores``, ``questionScores`` and ``evaluations``, so that groups
    meet their questions and evaluations without a join.
    """

    def counted(g: Column) -> Column:
        n = F.size(F.filter("questionScores", lambda q: q["questionGroupId"] == g["questionGroupId"]))
        passed = F.size(F.filter("questionScores", lambda q: (q["questionGroupId"] == g["questionGroupId"]) & ~q["failedKillQuestion"]))
        return F.struct(g["totalScore"].alias("totalScore"), g["maxTotalScore"].alias("maxTotalScore"), n.alias("n"), passed.alias("passed"))

    # the short list goes along with the long one; it is filtered inside the explode, as Spark would count it twice for a filter before
    rows = (
        scores.select("evaluations", F.transform("groupScores", counted).alias("groups"))
        .select("groups", F.explode("evaluations").alias("e"))
        .select("e.agentId", "e.queueId", "e.mediaType", "e.conversationDate", F.explode(F.filter("groups", lambda g: g["n"] > 0)).alias("g"))
        .select("agentId", "queueId", "mediaType", "conversationDate", "g.*")
        .join(queues.select("queueId", "timeZone"), "queueId")
    )
    return rows.groupBy(F.col("agentId").alias("userId"), local_date("conversationDate").alias("date")).agg(
        F.sum(F.when(F.col("mediaType") == "voice", F.col("totalScore") * F.col("passed") * 100).otherwise(0)).alias("score_voice"),
        F.sum(F.when(F.col("mediaType") == "voice", F.col("maxTotalScore") * F.col("n")).otherwise(0)).alias("max_voice"),
        ag.ratio(F.sum(F.col("totalScore") * F.col("n")) * 100, F.sum(F.col("maxTotalScore") * F.col("n"))).alias("quality_score"),
    )


def adherence_kpis(days: DataFrame, intervals: DataFrame, queues: DataFrame) -> DataFrame:
    """Schedule and exception seconds, weighted with the agent's intervals of that day."""
    weights = (
        intervals.join(queues.select("queueId", "timeZone"), "queueId").groupBy("userId", F.col("date").alias("startDatePart"), "timeZone").agg(F.count(F.lit(1)).alias("w"))
    )
    rows = days.join(weights, ["userId", "startDatePart"])
    return rows.groupBy("userId", local_date("startDate").alias("date")).agg(
        F.sum(F.col("adherenceScheduleSecs") * F.col("w")).alias("adherenceScheduleSecs"),
        F.sum(F.col("exceptionDurationSecs") * F.col("w")).alias("exceptionDurationSecs"),
    )


def form_kpis(total_scores: DataFrame, evaluations: DataFrame, queues: DataFrame, forms: Mapping[str, str]) -> DataFrame:
    """Average total score per form, capped at 100; ``forms`` goes from result column to form."""
    rows = (
        total_scores.filter("totalScore is not null")
        .join(evaluations.filter(F.trim("evaluationFormId").isin(*forms.values())), "evaluationId")
        .join(queues.select("queueId", "timeZone"), "queueId")
    )
    aggs = [ag.capped_avg(F.when(F.trim("evaluationFormId") == form, F.col("totalScore"))).alias(name) for name, form in forms.items()]
    return rows.groupBy(F.col("agentId").alias("userId"), local_date("conversationDate").alias("date")).agg(*aggs)


def sales_kpis(handled: DataFrame, codes: DataFrame, zones: DataFrame) -> DataFrame:
    """Outbound sales, decision-maker contacts and conversion per agent and local day."""
    rows = handled.join(zones.select("userId", "timeZone"), "userId").join(
        codes.select("wrapUpCodeId", "sales", "decisionMakerContact"), F.col("wrapUpCode") == F.col("wrapUpCodeId")
    )
    sold, met = F.count_if(F.col("sales")), F.count_if(F.col("decisionMakerContact"))
    return rows.groupBy("userId", local_date("conversationStart").alias("date")).agg(
        sold.alias("Sales"), met.alias("Contacts"), F.round(F.try_divide(sold, met) * 100).alias("Conversion")
    )


def combined(sets: Sequence[DataFrame]) -> DataFrame:
    """All KPI sets side by side per agent and day."""
    return jn.outer_chain(sets, ["userId", "date"])


def kpi_grid(agents: DataFrame, sets: Sequence[DataFrame], start: str, end: str, measures: Sequence[str]) -> DataFrame:
    """KPIs of the agents on every day that has any measure. Starts from the KPIs, so days without one are never built."""
    days = F.col("date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    sets = [s.filter(days) for s in sets]
    return drop_empty(combined(sets).join(agents.select("userId"), "userId"), measures)


def knowledge_activity(people: DataFrame, sessions: DataFrame, entries: DataFrame, history: DataFrame, zone: str, start: str, end: str) -> DataFrame:
    """Logins, views, ratings, likes, suggestions, articles authored, updated and published per user and day.

    Session entries and history events are counted per user and day before they meet the grid.
    """
    def day(ts):
        return F.to_date(F.from_utc_timestamp(ts, zone)).alias("date")

    visits = sessions.filter("statusType in (1, 2)").select("sessionId", "userId", "startTime", "endTime", day("startTime"))
    logins = visits.groupBy("userId", "date").agg(F.count_if(F.col("endTime") > F.col("startTime")).alias("logins"))
    kind = F.col("entryType")
    seen = entries.join(visits.select("sessionId", "userId", "date"), "sessionId").groupBy("userId", "date").agg(
        F.count_if(kind == 1).alias("ArticlesViewed"),
        F.count_if(kind == 5).alias("ArticlesRated"),
        F.count_if((kind == 5) & (F.col("result") == 1)).alias("NumberOfLikes"),
        F.count_if(kind == 34).alias("SuggestionsMade"),
    )
    done = F.col("operation")
    edited = history.select("userId", "operation", day(F.timestamp_millis("eventMillis"))).groupBy("userId", "date").agg(
        F.count_if(done.isin(1, 6)).alias("Authored"),
        F.count_if(done == 52).alias("Updated"),
        F.count_if(done == 225).alias("SuggestionsApproved"),
    )
    spine = jn.day_spine(people.select("userId").distinct(), F.to_date(F.lit(start)), F.to_date(F.lit(end)), "date")
    out = spine.join(combined([logins, seen, edited]), ["userId", "date"], "left")
    counts = [c for c in out.columns if c not in ("userId", "date")]
    return out.select("userId", "date", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])


def kpi_values(members: DataFrame, outcomes: DataFrame, logins: DataFrame, quizzes: DataFrame, kpi: DataFrame, points: DataFrame) -> DataFrame:
    """KPI value per user, campaign and day, its source chosen by the kind of the outcome.

    ``members`` has userId, campaignId, start_date, end_date. A row counts when it has a value or points, so the days come
    from logins, quizzes, KPI rows and points inside a membership; days without any are never built.
    """
    wanted = members.select("userId", "campaignId", "start_date", "end_date").distinct().join(outcomes, "campaignId")
    entity = F.col("entityName")
    seen = [
        (wanted.filter(entity == "Audit_Log"), logins.select("userId", F.col("date").alias("report_date")), ["userId"]),
        (wanted.filter(entity == "quiz"), quizzes.select("userId", F.col("answeredDate").alias("report_date")), ["userId"]),
        (
            wanted,
            kpi.select("userId", "report_date", F.col("connection_name").alias("entityName"), F.col("attr_dict_key").alias("fieldName")),
            ["userId", "entityName", "fieldName"],
        ),
        (
            wanted,
            points.select("userId", F.col("date").alias("report_date"), "activityId", "entityName", "fieldName"),
            ["userId", "activityId", "entityName", "fieldName"],
        ),
    ]
    columns = [*wanted.columns, "report_date"]
    found = [w.join(s, keys).filter(F.col("report_date").between(F.col("start_date"), F.col("end_date"))).select(*columns) for w, s, keys in seen]
    base = reduce(DataFrame.unionByName, found).distinct().drop("start_date", "end_date")
    rows = (
        base.join(logins.select("userId", F.col("date").alias("report_date"), "loginAttempt"), ["userId", "report_date"], "left")
        .join(quizzes.select("userId", F.col("answeredDate").alias("report_date"), "quizPercentageScore", "noOfCorrectQuestions", "totalQuestions"), ["userId", "report_date"], "left")
        .join(
            kpi.select("userId", "report_date", F.col("connection_name").alias("entityName"), F.col("attr_dict_key").alias("fieldName"), "attr_value", F.col("num").alias("_num"), F.col("denom").alias("_denom")),
            ["userId", "report_date", "entityName", "fieldName"],
            "left",
        )
        .join(
            points.select(
                "userId", F.col("date").alias("report_date"), "activityId", "entityName", "fieldName", "points", "target", "noOfTimesPerformed", F.col("fieldValue").alias("_pointValue")
            ),
            ["userId", "report_date", "activityId", "entityName", "fieldName"],
            "left",
        )
    )
    audit = F.col("entityName") == "Audit_Log"
    score = (F.col("entityName") == "quiz") & (F.col("fieldName") == "percentage_score")
    tried = (F.col("entityName") == "quiz") & (F.col("fieldName") == "attempted_quiz") & (F.col("quizPercentageScore") > 0)
    value = (
        F.when(audit, F.col("loginAttempt").cast("double"))
        .when(score, F.col("quizPercentageScore"))
        .when(tried, F.lit(1.0))
        .otherwise(F.coalesce("attr_value", "_pointValue"))
    )
    out = rows.select(
        "userId",
        "campaignId",
        "report_date",
        "activityId",
        "entityName",
        "kpi_name",
        "fieldName",
        value.alias("fieldValue"),
        F.when(score, F.col("noOfCorrectQuestions") * 100).otherwise(F.col("_num")).alias("num"),
        F.when(score, F.col("totalQuestions")).otherwise(F.col("_denom")).alias("denom"),
        "points",
        "target",
        "noOfTimesPerformed",
    )
    return out.filter("fieldValue is not null or points is not null")
