"""Campaign report tables out of documents, attendance and logins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.operators import documents as dc
from callweave.operators import joins as jn
from callweave.operators import ordered
from callweave.operators.projections import status_of


def users(docs: DataFrame) -> DataFrame:
    """One row per user and team with the role held there."""
    rows = dc.unwind(docs, "works_for", "w", keep_empty=True)
    return dc.project(
        rows,
        {
            "mongoUserId": "_id",
            "userId": "user_id",
            "name": "name",
            "teamId": "w.team_id",
            "roleId": "w.role_id",
            "status": status_of(F.col("is_deleted"), F.col("is_active")),
            "orgId": F.lower("org_id"),
        },
    )


def campaigns(docs: DataFrame, zone: str) -> DataFrame:
    return dc.project(
        docs,
        {
            "campaignId": "_id",
            "name": "name",
            "start_date": F.to_date(F.from_utc_timestamp("start_date", zone)),
            "endDate": F.to_date(F.from_utc_timestamp("end_date", zone)),
            "isActive": "is_active",
            "orgId": F.lower("org_id"),
        },
    )


def user_campaigns(docs: DataFrame, user_docs: DataFrame) -> DataFrame:
    """Members of a campaign: users of its teams and users named one by one."""
    base = docs.select(F.col("_id").alias("campaignId"), F.lower("org_id").alias("orgId"), "game_design")
    members = dc.unwind(user_docs, "works_for", "w").select(F.col("_id").alias("userId"), F.col("w.team_id").alias("teamId"))
    teams = dc.unwind(base, "game_design.gd_teams", "t").select("campaignId", "orgId", F.col("t.team_id").alias("teamId"))
    teams = dc.lookup(teams, members, {"teamId": "teamId"}, {"userId": "userId"})
    named = dc.unwind(base, "game_design.gd_users", "u").select(
        "campaignId", "orgId", F.col("u.team_id").alias("teamId"), F.col("u.user_id").alias("userId")
    )
    return dc.facet([named, teams])


def campaign_kpis(docs: DataFrame) -> DataFrame:
    rows = dc.unwind(docs, "kpis", "k")
    return dc.project(rows, {"campaignId": "_id", "kpiName": "k.name", "kpiWeight": "k.weight", "orgId": F.lower("org_id")}).distinct()


def campaign_activities(docs: DataFrame) -> DataFrame:
    rows = dc.unwind(dc.unwind(docs, "kpis", "k"), "k.activities", "a")
    return dc.project(
        rows, {"campaignId": "_id", "kpiName": "k.name", "activityId": "a._id", "entityName": "a.entity", "fieldName": "a.field", "orgId": F.lower("org_id")}
    )


def activity_mapping(docs: DataFrame) -> DataFrame:
    """Activity to field, once per org."""
    return campaign_activities(docs).select("activityId", "entityName", "fieldName", "orgId").distinct()


def levels(campaign_docs: DataFrame, user_levels: DataFrame, start: str) -> DataFrame:
    """Levels reached since ``start`` with the point range of the level."""
    rows = dc.unwind(campaign_docs, "levels", "l").select(
        F.col("_id").alias("campaignId"), F.col("name").alias("campaignName"), F.col("l._id").alias("levelId"), F.col("l.start_points").alias("levelStartPoints"),
        F.col("l.end_points").alias("levelEndPoints"), F.lower("org_id").alias("orgId"),
    )
    got = dc.since(user_levels, start, "achieved_date")
    return dc.lookup(
        rows, got, {"campaignId": "campaign_id", "levelId": "level_id"}, {"userId": "user_id", "levelNumber": "level_no", "achievedDate": "achieved_date"}, keep_unmatched=False
    )


def outcome_points(docs: DataFrame, kind: str, start: str, zone: str) -> DataFrame:
    """Points (or badge bonus points) of users per activity and local day."""
    rows = dc.since(docs.filter(F.col("outcome_type") == kind), start, "creation_date", "last_updated")
    return dc.project(
        rows,
        {
            "campaignId": "campaign_id",
            "activityId": "outcome_id",
            "userId": "user_id",
            "points": "outcome_quantity",
            "outcomeType": "outcome_type",
            "fieldName": "field_name",
            "fieldValue": "field_value",
            "date": dc.zone_text(F.col("creation_date"), zone),
            "orgId": F.lower("org_id"),
        },
    )


def badges(docs: DataFrame, zone: str) -> DataFrame:
    rows = docs.filter("outcome_type = 'badge'")
    return dc.project(
        rows, {"campaignId": "campaign_id", "userId": "user_id", "badgeId": "outcome_id", "dateAwarded": dc.zone_text(F.col("creation_date"), zone), "orgId": F.lower("org_id")}
    ).distinct()


def challenges(docs: DataFrame, zone: str) -> DataFrame:
    """Challenges with local dates and a status derived from the dates."""
    done, taken = F.col("completed_at").isNotNull(), F.col("accepted_at").isNotNull()
    return dc.project(
        docs,
        {
            "campaignId": "campaign_id",
            "challengeName": "name",
            "challengerId": "challenger",
            "challengeeId": "challengee",
            "challengeThrownDate": dc.zone_text(F.col("thrown_at"), zone),
            "challengeAcceptanceDate": dc.zone_text(F.col("accepted_at"), zone),
            "challengeCompletionDate": dc.zone_text(F.col("completed_at"), zone),
            "status": F.when(done, "Completed").when(taken, "Accepted").otherwise("Thrown"),
            "noOfDays": F.coalesce("days", F.lit(1)),
            "orgId": F.lower("org_id"),
        },
    )


def quizzes(docs: DataFrame, zone: str) -> DataFrame:
    """Quiz attempts with score; an attempt without answers has none."""
    right = F.size(F.filter("answers", lambda a: a["correct"]))
    total = F.size("answers")
    percent = F.when(total > 0, F.round(right * 100.0 / total, 2))
    return dc.project(
        docs,
        {
            "quizId": "quiz_id",
            "userId": "user_id",
            "answeredDate": dc.zone_text(F.col("answered_at"), zone),
            "noOfCorrectQuestions": right.cast("double"),
            "totalQuestions": total.cast("double"),
            "quizPercentageScore": percent,
            "quizStatus": F.when(total == 0, "Pending").when(percent >= 80, "Passed").otherwise("Failed"),
            "orgId": F.lower("org_id"),
        },
    )


def questions(docs: DataFrame) -> DataFrame:
    """Newest version of every question with its options; text cleaned."""
    rows = dc.unwind(docs, "answers", "a", keep_empty=True).select(
        "quiz_id", F.col("a.question_id").alias("questionId"), F.regexp_replace("a.text", "[\\r\\n\"]+", " ").alias("question"), "answered_at", "user_id", F.lower("org_id").alias("orgId")
    )
    newest = ordered.newest(
        rows.filter("questionId is not null"), ["quiz_id", "questionId", "orgId"], F.col("answered_at").desc(), F.col("user_id").desc(), F.col("question").asc()
    )
    return newest.select(F.col("quiz_id").alias("quizId"), "questionId", "question", "orgId")


def rewards(docs: DataFrame, zone: str) -> DataFrame:
    rows = dc.unwind(docs, "rewards", "r")
    return dc.project(
        rows, {"userId": "user_id", "rewardType": "r.type", "amount": "r.amount", "date": dc.zone_text(F.col("r.given_at"), zone), "orgId": F.lower("org_id")}
    )


def vouchers(docs: DataFrame, zone: str) -> DataFrame:
    """Redeemed vouchers: rewards of kind voucher that have a code."""
    return rewards(docs, zone).filter("rewardType = 'voucher'").withColumn("points", -F.col("amount")).drop("amount", "rewardType")


def announcements(docs: DataFrame, user_docs: DataFrame) -> DataFrame:
    """Announcements with the number of recipients and of readers, and the sender's name."""
    out = dc.project(
        docs,
        {
            "announcementId": "_id",
            "senderId": "sender",
            "recipients": F.size(F.array_distinct(F.concat("to_users", "to_leads"))),
            "readers": F.size(F.array_intersect("read_by", F.concat("to_users", "to_leads"))),
            "readBySender": F.array_contains("read_by", F.col("sender")),
            "orgId": F.lower("org_id"),
        },
    )
    return dc.lookup(out, user_docs, {"senderId": "_id"}, {"senderName": "name"})


def upload_audit(docs: DataFrame, zone: str) -> DataFrame:
    return dc.project(
        docs,
        {"uploadId": "_id", "connectionName": "connection", "rows": "row_count", "failed": F.coalesce("failed_count", F.lit(0)), "uploadedAt": dc.zone_text(F.col("uploaded_at"), zone, "yyyy-MM-dd HH:mm:ss"), "orgId": F.lower("org_id")},
    )


def upload_connections(docs: DataFrame) -> DataFrame:
    """Attributes of a connection as rows."""
    rows = dc.unwind(docs, "attributes", "a")
    return dc.project(rows, {"connectionName": "connection", "dictionaryKey": "a.dictionary_key", "displayName": "a.display_name", "isKpi": "a.is_kpi", "orgId": F.lower("org_id")}).distinct()


def coaching_journeys(docs: DataFrame, user_docs: DataFrame, zone: str, start: str) -> DataFrame:
    """Coaching journeys, one row per survey and feedback entry, with the team lead's name."""
    leads = dc.unwind(user_docs, "works_for", "w").filter("w.role_id = 'Team Lead'").select(F.col("w.team_id").alias("team"), F.col("name").alias("lead"))
    rows = dc.lookup(dc.since(docs, start, "updated_at"), leads, {"team_id": "team"}, {"teamLeadName": "lead"}, keep_unmatched=False)
    rows = dc.unwind(dc.unwind(rows, "discovery.survey", "s", keep_empty=True), "feedback", "f", keep_empty=True)
    return dc.project(
        rows,
        {
            "journeyId": "_id",
            "agentId": "agent_id",
            "teamLeadName": "teamLeadName",
            "state": "state",
            "discoveryStart": dc.zone_text(F.col("discovery.start"), zone, "yyyy-MM-dd HH:mm:ss"),
            "lmsState": "action.lms.state",
            "surveyQuestion": "s.question",
            "surveyAnswer": "s.answer",
            "feedback": "f.text",
            "orgId": F.lower("org_id"),
        },
    )


# fixed values: kinds of coaching actions in documents and in column names, and fields that are copied as they are
ACTIONS = {"lms": "LMS", "article": "Article", "recorded_call": "RecordedCall", "one_on_one": "OneOnOne"}
COPIED = ["kpi_name", "trek_global_state", "action_complete", "feedback_given", "action_start", "discovery_complete", "discovery_start", "action_completed"]


def coaching_documents(texts: DataFrame, leads: DataFrame, zone: str, start: str) -> DataFrame:
    """Coaching journeys out of JSON documents whose fields come, go and change type, one row per survey and feedback entry.

    ``texts`` has ``document``; ``leads`` has ``team`` and ``teamlead_name``, and documents of other teams are left out. Documents not
    updated since ``start`` and texts that are no JSON are left out too. Times are text in ``zone``, measures are numbers, whether
    the document gives them as numbers or as text.
    """
    docs = texts.select(dc.parsed(F.col("document")).alias("d"))
    d = F.col("d")
    docs = docs.filter(dc.time_at(d, "updatedAt") >= F.to_timestamp(F.lit(start)))

    def told(path, doc=d):
        return dc.zone_text(dc.time_at(doc, path), zone, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    columns = {"trek_id": dc.id_at(d, "_id"), **{c: dc.id_at(d, c) for c in ("team_id", "agent_id", "team_leader_id", "kpi_id", "campaign_id")}}
    columns |= {c: dc.at(d, c) for c in COPIED}
    columns |= {"trek_date": told("trek_date"), "discoveryStart": told("discovery.start"), "discoveryEnd": told("discovery.end")}
    for field, label in ACTIONS.items():
        columns |= {f"action{label}Start": told(f"action.{field}.start"), f"action{label}End": told(f"action.{field}.end")}
        columns |= {f"action{label}Link": dc.at(d, f"action.{field}.link"), f"action{label}State": dc.at(d, f"action.{field}.state")}
        columns |= {f"score{label}": dc.at(d, f"score.{field}", "double")}
    columns |= {"actionActionState": dc.at(d, "action.action.state"), "actionState": dc.at(d, "action.state")}
    columns |= {"actionGoalTarget": dc.at(d, "action.goal.goal_target", "double"), "orgId": F.lower(dc.at(d, "organization_id"))}
    rows = docs.select(*[v.alias(k) for k, v in columns.items()], dc.entries_at(d, "discovery.survey").alias("_s"), dc.entries_at(d, "nfeedback").alias("_f"))
    rows = rows.withColumn("_s", F.explode("_s")).withColumn("_f", F.explode("_f"))
    s, f = F.col("_s"), F.col("_f")
    asked = {"Survey_question": dc.at(s, "question"), "Survey_value": dc.at(s, "value"), "Survey_score": dc.at(s, "score", "double"), "Survey_type": dc.at(s, "type")}
    asked |= {"Feedback_question": dc.at(f, "question"), "Feedback_answer": dc.at(f, "answer"), "Feedback_value": dc.at(f, "value", "double")}
    out = rows.select(*columns, *[v.alias(k) for k, v in asked.items()])
    return out.join(leads.select(F.col("team").alias("team_id"), "teamlead_name"), "team_id").select(*columns, *asked, "teamlead_name").distinct()


def raw_kpis(rows: DataFrame, org: Column) -> DataFrame:
    """Delivered KPI values as the raw table, kept in folders by organisation and day; rows without a value are left out."""
    return rows.filter("value is not null").select(
        F.col("campaign_id").alias("campaignId"),
        "kpi",
        F.col("outcome_name").alias("outcomeName"),
        F.col("outcome_id").alias("outcomeId"),
        F.col("user_id").alias("userId"),
        F.col("date").try_cast("date").alias("date"),
        F.col("value").try_cast("float").alias("value"),
        F.lower(org).alias("orgId"),
    ).distinct()


def attendance_from_presence(presence: DataFrame, zones: DataFrame, offline: str = "OFFLINE", min_hours: int = 4) -> DataFrame:
    """Shifts inferred from long offline spans: login is the end of the previous one, logout the start.

    Without a previous span the login is 12 hours before a span longer than 12 hours.
    """
    hours = F.floor((F.unix_timestamp("endTime") - F.unix_timestamp("startTime")) / 3600)
    long_off = presence.filter((F.col("systemPresence") == offline) & (hours > min_hours)).join(zones.select("userId", "timeZone"), "userId")
    out = ordered.with_ordered(long_off, ["userId"], ["startTime", "endTime"], lag={"_prev": "endTime"})

    def local(ts):
        return F.from_utc_timestamp(ts, F.trim("timeZone"))

    guess = F.when(F.col("_prev").isNull() & (hours > 12), local(F.col("startTime") - F.expr("interval 12 hours")))
    return out.select(
        "userId",
        F.lit(True).alias("isPresent"),
        F.coalesce(guess, local(F.col("_prev"))).alias("loginTime"),
        local(F.col("startTime")).alias("logoutTime"),
        F.to_date(local(F.col("startTime"))).alias("reportDate"),
    )


def attendance_from_kpis(kpi: DataFrame) -> DataFrame:
    """Present on a day with any KPI value; an eight-hour shift from midnight."""
    out = kpi.groupBy("userId", "reportDate", "orgId").agg((F.count("attr_value") > 0).alias("isPresent"))
    start = F.col("reportDate").cast("timestamp")
    return out.withColumns({"loginTime": start, "logoutTime": start + F.expr("interval 8 hours")})


def logins_by_shift(logins: DataFrame, shifts: DataFrame) -> DataFrame:
    """Login attempts counted on the day their shift began; outside any shift on their own day."""
    spans = shifts.filter("loginTime is not null").select("userId", "loginTime", "logoutTime")
    hit = jn.interval_join(logins, spans, ["userId"], "loginAt", "loginTime", "logoutTime", slot_seconds=86400)
    first = hit.groupBy("loginId").agg(F.min("loginTime").alias("shiftStart"))
    day = F.to_date(F.coalesce("shiftStart", "loginAt"))
    return logins.join(first, "loginId", "left").groupBy("userId", day.alias("date")).agg(F.sum("loginAttempt").alias("loginAttempt"))
