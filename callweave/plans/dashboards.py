"""Reference dimensions, dashboard extracts in local time and their lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions import times as tm
from callweave.operators import joins as jn
from callweave.operators import nested as ns
from callweave.operators import timeaxis as ta
from callweave.operators.projections import ms_to_seconds, to_percent


def dim_users(raw_users: DataFrame) -> DataFrame:
    """Users with the name of their manager."""
    managers = raw_users.select(F.col("id").alias("managerId"), F.col("name").alias("managerName"))
    u = raw_users.select(F.col("id").alias("userId"), F.col("name").alias("userFullName"), "email", "department", "state", F.col("manager.id").alias("managerId"))
    return u.join(managers, "managerId", "left").distinct()


def dim_user_groups(raw_users: DataFrame, groups: DataFrame) -> DataFrame:
    rows = ns.flatten(raw_users, [F.col("id").alias("userId"), F.col("g.id").alias("groupId")], ("groups", "g"))
    return rows.join(groups.select("groupId", "groupName"), "groupId").distinct()


def user_roles(raw_users: DataFrame) -> DataFrame:
    return ns.flatten(raw_users, [F.col("id").alias("userId"), F.col("r.name").alias("role")], ("authorization.roles", "r")).distinct()


def dim_queues(raw_queues: DataFrame, media: Sequence[str] = ("call", "chat", "email")) -> DataFrame:
    """Queues with service level per media: seconds and percent."""
    cols = []
    for m in media:
        level = f"mediaSettings.{m}.serviceLevel"
        cols += [ms_to_seconds(F.col(f"{level}.durationMs")).alias(f"{m}SlaDuration"), to_percent(F.col(f"{level}.percentage")).alias(f"{m}SlaPercentage")]
    return raw_queues.select(F.col("id").alias("queueId"), F.col("name").alias("queueName"), *cols).distinct()


def dim_codes(raw_codes: DataFrame) -> DataFrame:
    return raw_codes.select(F.col("id").alias("wrapUpId"), F.col("name").alias("wrapUpCode")).distinct()


def dim_forms(raw_forms: DataFrame) -> DataFrame:
    return raw_forms.select(F.col("id").alias("evaluationFormId"), F.col("name").alias("evaluationFormName"), "published").distinct()


def form_questions(raw_forms: DataFrame) -> DataFrame:
    return ns.flatten(
        raw_forms,
        [F.col("id").alias("formId"), F.col("g.id").alias("groupId"), F.col("g.name").alias("groupName"), F.col("q.id").alias("questionId"), F.col("q.isCritical")],
        ("questionGroups", "g"),
        ("g.questions", "q"),
    ).distinct()


def form_options(raw_forms: DataFrame) -> DataFrame:
    return ns.flatten(
        raw_forms,
        [F.col("id").alias("formId"), F.col("q.id").alias("questionId"), F.col("o.id").alias("optionId"), F.col("o.text").alias("optionText"), F.col("o.value").alias("optionValue")],
        ("questionGroups", "g"),
        ("g.questions", "q"),
        ("q.answerOptions", "o"),
    ).distinct()


def realtime_queue_map(queues: DataFrame, regions: DataFrame) -> DataFrame:
    """Queues with region; a queue without configuration falls under 'Other'."""
    keyed = regions.select(F.lower(F.trim("queueName")).alias("_key"), "region").distinct()
    return (
        queues.withColumn("_key", F.lower(F.trim("queueName")))
        .join(keyed, "_key", "left")
        .select("queueId", "queueName", F.coalesce("region", F.lit("Other")).alias("region"))
    )


def daily_summary(intervals: DataFrame, queues: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Interval metrics per user, queue, media and local quarter hour."""
    rows = jn.lookup_local_time(intervals, queues.select("queueId", "timeZone"), ["queueId"], {"_at": "intervalStart"})
    return rows.groupBy(
        F.to_date("_at").alias("emitDate"), F.date_format("_at", "HH:mm:ss").alias("intervalStart"), F.col("userId").alias("userKey"), "mediaType", "messageType", F.col("queueId").alias("queueKey")
    ).agg(*[F.sum(m).alias(m) for m in measures])


def local_presence(presence: DataFrame, zones: DataFrame) -> DataFrame:
    """Presence in the user's local time, cut at midnight."""
    local = jn.lookup_local_time(presence, zones, ["userId"], {"startTime": "startTime", "endTime": "endTime"})
    return ta.split_days(local, "startTime", "endTime")


def global_presence(presence: DataFrame, zones: DataFrame, status: str) -> DataFrame:
    """Seconds of one status per local hour slot; slots are cut in UTC, labels are local."""
    cut = ta.slice_intervals(presence.filter(F.col("systemPresence") == status), "startTime", "endTime", 3600)
    local = jn.lookup_local_time(cut, zones, ["userId"], {"_at": "startTime"})
    return local.select(
        "userId", F.to_date("_at").alias("startDate"), tm.hour_label(F.col("_at")).alias("TimeIntervalStart"), "systemPresence", "timeDiff"
    ).distinct()


def routing_slices(routing: DataFrame, zones: DataFrame) -> DataFrame:
    """Routing status cut to local half hours; slices that begin in a clock-change gap are dropped."""
    local = jn.lookup_local_time(routing, zones, ["userId"], {"startTime": "startTime", "endTime": "endTime"})
    cut = ta.slice_intervals(local, "startTime", "endTime", 1800, "timeSlot")
    return cut.filter(tm.exists_in_zone(F.col("startTime"), F.trim("timeZone")))


def local_spans(rows: DataFrame, zones: DataFrame) -> DataFrame:
    """Workforce rows with start and end in the user's local time; users without a zone are left out."""
    return jn.lookup_local_time(rows, zones, ["userId"], {"startDate": "startDate", "endDate": "endDate"})


def survey_summary(surveys: DataFrame, regions: DataFrame, details: DataFrame) -> DataFrame:
    """Surveys in the local time of their queue (UTC without one) with media type of the conversation."""
    r = regions.select(F.lower(F.trim("queueName")).alias("_key"), "region", "timeZone")
    first = F.get(F.get("participants", F.lit(0))["sessions"], F.lit(0))
    media = details.select("conversationId", first["mediaType"].alias("mediaType"))
    keyed = surveys.withColumn("_key", F.lower(F.trim("callType")))
    out = jn.lookup_local_time(keyed, r, ["_key"], {"surveySentDate": "surveySentDate"}, missing="UTC").join(media, "conversationId")
    return out.select("surveyId", "conversationId", "callType", "surveySentDate", "mediaType", "region", F.to_date("surveySentDate").alias("surveySentDatePart")).distinct()


def evaluation_details(evaluations: DataFrame, scores: DataFrame, queues: DataFrame) -> DataFrame:
    """Evaluations with total score, dated in the local time of their queue."""
    rows = evaluations.join(scores, "evaluationId")
    local = jn.lookup_local_time(rows, queues.select("queueId", "timeZone"), ["queueId"], {"conversationDate": "conversationDate"})
    return local.drop("timeZone")


def question_score_summary(scores: DataFrame) -> DataFrame:
    """Questions asked, failed and scored per form and question. ``scores`` has one row per evaluation with the lists
    ``questionScores`` and ``evaluations``."""
    forms = scores.select("questionScores", F.explode("evaluations.evaluationFormId").alias("evaluationFormId"))
    # outer, as Spark would make the list twice for its filter on empty ones
    rows = forms.select("evaluationFormId", F.explode_outer("questionScores").alias("q")).filter("q is not null").select("evaluationFormId", "q.*")
    return rows.groupBy("evaluationFormId", "questionId").agg(
        F.count(F.lit(1)).alias("asked"), F.count_if("failedKillQuestion").alias("failed"), F.sum("score").alias("score")
    )


def active_user_bill(sessions: DataFrame, users: DataFrame, zone: str, month: str) -> DataFrame:
    """Users to bill for a month: agents with a conversation, plus active leads and managers."""
    start = F.to_timestamp(F.lit(f"{month}-01"))
    at = F.from_utc_timestamp("conversationStart", zone)
    agents = sessions.filter((at >= start) & (at < F.add_months(start, 1).cast("timestamp"))).select(F.col("agentId").alias("userId")).distinct()
    label = F.date_format(start, "MMMM-yyyy").alias("month")
    fields = ["userId", "name", "state", F.coalesce("roleId", F.lit("Agent")).alias("roleId"), label]
    worked = users.join(agents, "userId", "left_semi").select(*fields)
    leads = users.filter("state = 'active' and roleId in ('Team Manager', 'Team Lead')").select(*fields)
    return worked.union(leads).distinct()


def users_info(raw_users: DataFrame, seen: DataFrame) -> DataFrame:
    """Users with department, division and manager; without a hire date the day they were first extracted counts.

    ``seen`` has userId and extractDate, a row per delivery.
    """
    first = seen.groupBy(F.col("userId").alias("id")).agg(F.min("extractDate").alias("_first"))
    return raw_users.join(first, "id", "left").select(
        "department",
        F.col("division.id").alias("divisionId"),
        F.col("division.name").alias("divisionName"),
        F.coalesce("dateHire", "_first").alias("hireDate"),
        "email",
        F.col("id").alias("userId"),
        F.col("manager.id").alias("managerId"),
        "name",
        "state",
    )


def queue_lookup(queues: DataFrame, mapping: DataFrame) -> DataFrame:
    """Queues that have a configured region, by exact name."""
    return queues.select(F.col("queueId").alias("queueKey"), F.col("queueName").alias("name")).join(
        mapping.select(F.col("queueName").alias("name"), "region", "country"), "name"
    )
