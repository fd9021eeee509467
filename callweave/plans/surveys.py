"""Survey interactions as one wide row, survey flags and first-contact resolution."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions import text as tx
from callweave.functions import times as tm
from callweave.operators import nested as ns
from callweave.operators import ordered, reshape
from callweave.operators import upserts as up

# fixed values: keys and questions of the survey tool with their column
CUSTOM_KEYS = {"Country": "country", "AgentEmail": "agentEmail", "AgentGroup": "agentGroup", "ContactChannel": "contactChannel", "WrapUpName": "wrapUpName"}
QUESTIONS = {"Comments": "comments", "CSAT": "csat", "Agent CSAT": "agentCsat", "FCR": "fcr", "CC NPS": "nps", "CES": "ces", "US CSAT": "usCsat"}


def wide_interactions(interactions: DataFrame, questions: DataFrame) -> DataFrame:
    """Newest version of every survey with custom values and answers as columns."""
    newest = ordered.newest(interactions, ["id"], F.col("updated_at").desc())
    custom = ns.flatten(newest, ["id", F.col("x.custom_key"), F.col("x.custom_value")], ("interaction_data", "x"))
    custom = reshape.pivot_value(custom, ["id"], "custom_key", "custom_value", CUSTOM_KEYS)
    answers = ns.flatten(
        newest, ["id", F.col("r.question_id"), F.col("r.question_label"), F.col("r.response")], ("responses", "r")
    ).join(questions.select("question_id", "question_label", "max_response"), ["question_id", "question_label"])
    cols = []
    for label, name in QUESTIONS.items():
        mine = F.col("question_label") == label
        cols += [F.max(F.when(mine, F.col("response"))).alias(name), F.max(F.when(mine, F.col("max_response"))).alias(f"{name}Max")]
    answers = answers.groupBy("id").agg(*cols)
    out = newest.drop("interaction_data", "responses").join(custom, "id", "left").join(answers, "id", "left")
    us = F.col("call_type").startswith("US")
    channel = F.lower(F.trim("contactChannel"))
    return out.select(
        F.col("id").alias("surveyId"),
        F.col("agent_id").alias("agentId"),
        F.col("call_type").alias("callType"),
        F.col("external_ref").alias("conversationId"),
        tm.without_sentinel(F.col("completed_at")).alias("surveyCompletionDate"),
        tm.without_sentinel(F.col("scheduled_at")).alias("surveySentDate"),
        F.when(channel == "web", "chat").otherwise(channel).alias("mediaType"),
        F.get(F.split("status", " "), F.lit(0)).alias("status"),
        "country",
        "agentEmail",
        "wrapUpName",
        tx.clean_cell(F.col("comments")).alias("comments"),
        F.when(us, F.col("usCsat")).otherwise(F.col("agentCsat")).alias("csatAchieved"),
        F.when(us, F.col("usCsatMax")).otherwise(F.col("agentCsatMax")).alias("csatMax"),
        "fcr",
        F.col("nps").alias("npsScore"),
        F.lit(None).cast("string").alias("wrapUpCodeKey"),
        F.lit(None).cast("string").alias("userKey"),
        F.to_date(tm.without_sentinel(F.col("scheduled_at"))).alias("surveySentDatePart"),
    )


def with_keys(surveys: DataFrame, codes: DataFrame, users: DataFrame, as_of: str, days: int = 35) -> DataFrame:
    """Fill the missing code and user keys of recent surveys: code by name, user by mail, else by mail part."""
    recent = F.coalesce(F.col("surveySentDatePart") >= F.date_sub(F.to_date(F.lit(as_of)), days), F.lit(False))
    mail = F.split("agentEmail", "@")
    keyed = surveys.withColumn("_part", F.get(F.split(F.get(mail, F.lit(0)), "-"), F.lit(1)))
    by_name = codes.select(F.col("wrapUpCode").alias("wrapUpName"), F.col("wrapUpCodeId").alias("_code"))
    out = up.backfill(keyed, "wrapUpCodeKey", [(by_name, ["wrapUpName"], "_code")], recent)
    by_mail = users.select(F.col("userEmail").alias("agentEmail"), F.col("userId").alias("_uid"))
    by_part = users.select(F.get(F.split("userEmail", "@"), F.lit(0)).alias("_part"), F.col("userId").alias("_uid"))
    rules = [(by_mail, ["agentEmail"], "_uid"), (by_part, ["_part"], "_uid")]
    return up.backfill(out, "userKey", rules, recent).drop("_part")


# fixed values: participant attributes that carry survey answers
NUMBERS = {"csat": "Survey CSAT Agent", "nps": "Survey NPS", "fcr": "Survey Resolution"}
FLAGS = {"survey_completed": "Survey Completed", "survey_initiated": "Survey Initiated"}


def attribute_surveys(participants: DataFrame) -> DataFrame:
    """Survey answers held in participant attributes; participants without any are left out."""
    def value(key):
        return F.try_element_at("attributes", F.lit(key))

    present = [F.map_contains_key("attributes", k) for k in [*NUMBERS.values(), *FLAGS.values()]]
    found = present[0]
    for p in present[1:]:
        found = found | p
    cols = [F.when(value(k).rlike("^\\d+$"), value(k).try_cast("int")).alias(n) for n, k in NUMBERS.items()]
    cols += [F.when(value(k).isNotNull(), value(k) == "Yes").alias(n) for n, k in FLAGS.items()]
    return participants.filter(found).select("conversationId", "agentId", "mediaType", *cols).distinct()


def contacts(details: DataFrame, queues: DataFrame, excluded_codes: list[str], customer_of: Mapping[str, str]) -> DataFrame:
    """Last wrap-up of agent sessions per conversation with the customer's address, in local time.

    ``customer_of`` goes from media type to the session field that identifies the customer.
    """
    # a record is cut to the fields in use, then shuffled and sorted
    fields = ["sessionId", "mediaType", *dict.fromkeys(customer_of.values()), "segments"]
    inner = dict.fromkeys(["queueId", "wrapUpCode", "segmentEnd", "segmentType"])
    wanted = {"purpose": None, "userId": None, "sessions": {**dict.fromkeys(fields), "segments": inner}}
    cut = details.select("conversationId", "conversationStart", "recordInsertTime", ns.only_fields(F.col("participants"), wanted).alias("participants"))
    first = ordered.newest(cut.repartition("conversationId"), ["conversationId"], F.col("recordInsertTime").asc())
    sessions = ns.conversation_sessions(first).filter(F.col("mediaType").isin(*customer_of) & (F.col("purpose") == "agent"))
    who = F.coalesce(*[F.when(F.col("mediaType") == m, F.col(f)) for m, f in customer_of.items()])
    seg = ns.flatten(
        sessions.withColumn("customerId", who),
        ["conversationId", "customerId", "mediaType", "conversationStart", "userId", "sessionId", F.col("g.queueId"), F.col("g.wrapUpCode").alias("wrapupId"), F.col("g.segmentEnd"), F.col("g.segmentType")],
        ("segments", "g"),
    ).filter("segmentType = 'wrapup'")
    last = ordered.newest(seg, ["conversationId"], F.col("segmentEnd").desc(), F.col("sessionId").desc())
    kept = last.filter(F.col("wrapupId").isNotNull() & ~F.col("wrapupId").isin(*excluded_codes))
    zones = queues.select("queueId", "timeZone")
    return kept.join(zones, "queueId").select(
        "customerId",
        "mediaType",
        "conversationId",
        F.from_utc_timestamp("conversationStart", F.trim("timeZone")).alias("conversationStart"),
        "queueId",
        "wrapupId",
        "userId",
    )


def first_contact_resolution(contacts: DataFrame, minutes: int = 7200) -> DataFrame:
    """1 when the customer does not come back for the same reason within ``minutes``."""
    out = ordered.with_ordered(
        contacts, ["customerId", "wrapupId"], ["conversationStart", "conversationId"], lead={"_next": "conversationStart"}
    )
    again = tm.minutes_between(F.col("conversationStart"), F.col("_next")) <= minutes
    return out.withColumn("FCR_Internal", F.when(F.coalesce(again, F.lit(False)), 0).otherwise(1)).drop("_next")
