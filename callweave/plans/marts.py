"""Reporting marts over the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import scores as sc
from callweave.operators import aggregates as ag
from callweave.operators import joins as jn
from callweave.operators import ordered, reshape
from callweave.operators.projections import date_id

KEY, MONTH = "conversationId", "startMonth"
# fixed values: metrics of the handling mart and wordings of satisfaction from worst to best
HANDLING = ["nBlindTransferred", "nConsultTransferred", "nConsult", "nTransferred", "tHandle", "tTalkComplete", "tHeldComplete", "tAcw"]
SATISFACTION = ["lowest", "low", "medium", "high", "highest"]


def _resolved(column: str) -> Column:
    return F.coalesce(F.lower(column).isin("resolved", "partially resolved"), F.lit(False))


def _months_of(conversations: DataFrame, *tables: DataFrame) -> list[DataFrame]:
    return [jn.within_parts(x, conversations, MONTH) for x in tables]


def per_user_metrics(metrics: DataFrame, participants: DataFrame, names: Sequence[str]) -> DataFrame:
    """Summed metrics per conversation and user; the sums come before the join to participants."""
    wanted = metrics.filter(F.col("name").isin(*names))
    wide = reshape.pivot_sum(wanted, [KEY, "participantId"], "name", "value", names)
    users = participants.filter("userId is not null").select(KEY, "participantId", "userId")
    return wide.join(users, [KEY, "participantId"]).groupBy(KEY, "userId").agg(*[F.sum(n).alias(n) for n in names])


def handling_metrics(conversations: DataFrame, metrics: DataFrame, participants: DataFrame, insights: DataFrame) -> DataFrame:
    """Per-conversation handling metrics, split by resolved or not, with a satisfaction score.

    All tables are stored by start month; only the months of the conversations are read.
    """
    metrics, participants, insights = _months_of(conversations, metrics, participants, insights)
    base = per_user_metrics(metrics, participants, HANDLING).join(
        conversations.select(KEY, F.col("initialSessionMediaTypeId").alias("mediaTypeId"), "conversationStartDateId"), KEY
    )
    told = insights.select(KEY, "resolved", "satisfaction").distinct()
    out = base.join(told, KEY, "left")
    yes = _resolved("resolved")
    no = F.coalesce(F.lower("resolved") == "not resolved", F.lit(False))
    return out.select(
        KEY,
        "mediaTypeId",
        "conversationStartDateId",
        "userId",
        *HANDLING[:7],
        F.col("tAcw").alias("tAcwComplete"),
        yes.cast("int").alias("resolved"),
        no.cast("int").alias("notResolved"),
        F.when(yes, F.col("tHandle")).otherwise(0).alias("tHandleResolved"),
        F.when(no, F.col("tHandle")).otherwise(0).alias("tHandleNotResolved"),
        F.coalesce(sc.ordinal_score(F.col("satisfaction"), SATISFACTION), F.lit(0)).alias("satisfaction"),
    ).distinct()


def _lists(segments: DataFrame) -> DataFrame:
    """Distinct queue and code lists of a conversation as sorted text."""
    queues = ag.text_lists(segments, [KEY], "queueId", "queueIds")
    codes = ag.text_lists(segments, [KEY], "wrapUpCodeId", "wrapUpCodeIds")
    return queues.join(codes, KEY, "left").withColumn("wrapUpCodeIds", F.coalesce("wrapUpCodeIds", F.lit("")))


def cost_view(conversations, segments, metrics, insights, reasons) -> DataFrame:
    """Conversations with contact reason, outcome, queue and code lists and handle time; all tables are stored by start month."""
    segments, metrics, insights, reasons = _months_of(conversations, segments, metrics, insights, reasons)
    told = insights.select(KEY, "resolved", "satisfaction")
    why = reasons.select(KEY, "contactReason", "mainInquiry", "rootCause")
    handle = metrics.filter("name = 'tHandle'").groupBy(KEY).agg(F.sum("value").alias("tHandle"))
    return (
        conversations.select(KEY, "conversationStartDateId", "initialSessionMediaTypeId", "location", "originatingDirectionId")
        .join(_lists(segments), KEY)
        .join(told, KEY, "left")
        .join(why, KEY, "left")
        .join(handle, KEY)
        .distinct()
    )


def result_view(conversations, segments, insights, reasons) -> DataFrame:
    """Number of conversations per day, media, region, reason and outcome with the lists of queues seen; all tables are
    stored by start month."""
    segments, insights, reasons = _months_of(conversations, segments, insights, reasons)
    told = insights.select(KEY, "resolved", "satisfaction")
    why = reasons.select(KEY, "contactReason", "mainInquiry", "rootCause")
    keys = ["conversationStartDateId", "initialSessionMediaTypeId", "location", "originatingDirectionId", "contactReason", "mainInquiry", "rootCause", "resolved", "satisfaction"]
    rows = conversations.join(told, KEY, "left").join(why, KEY, "left").join(
        segments.select(KEY, "queueId", "wrapUpCodeId").distinct(), KEY
    )
    once = rows.select(*keys, KEY).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("totalInteractions"))
    queues = rows.select(*keys, "queueId").distinct().groupBy(*keys).agg(
        F.concat_ws(",", F.array_sort(F.collect_list("queueId"))).alias("queueIds")
    )
    on = ordered.same_keys("a", "b", keys)
    return once.alias("a").join(queues.alias("b"), on).select("a.*", "b.queueIds")


def reason_quadrants(metrics, conversations, insights, reasons) -> DataFrame:
    """Contact reasons by business and customer value: Eliminate, Digitize, Simplify or Encourage."""
    handle = metrics.filter("name = 'tHandle'").groupBy(KEY).agg(F.sum("value").cast("double").alias("tHandle"))
    media = conversations.select(KEY, F.col("initialSessionMediaTypeId").alias("mediaTypeId"))
    rows = (
        insights.select(KEY, "additional_service", "resolved")
        .join(reasons.select(KEY, "contactReason", "mainInquiry"), KEY)
        .join(handle, KEY)
        .join(media, KEY)
    )
    # one row per conversation and reason first, so that plain sums replace the distinct counts
    once = rows.groupBy("contactReason", "mainInquiry", "mediaTypeId", KEY).agg(
        F.sum("tHandle").alias("tHandle"),
        F.max((F.lower("additional_service") == "yes").cast("long")).alias("extra"),
        F.max(_resolved("resolved").cast("long")).alias("resolved"),
    )
    n = F.col("totalInteractions")
    out = (
        once.groupBy("contactReason", "mainInquiry", "mediaTypeId")
        .agg(
            F.sum("tHandle").alias("_handle"),
            F.sum("extra").alias("additionalService"),
            F.sum("resolved").alias("resolved"),
            F.count(F.lit(1)).alias("totalInteractions"),
        )
        .withColumn("tHandle", F.col("_handle") / (n * 1000))
        .withColumn("businessValue", (F.col("additionalService") * 100 / n >= 10).cast("int"))
        .withColumn("customerValue", ((F.col("resolved") * 100 / n >= 50) & (F.col("tHandle") < 700)).cast("int"))
        .drop("_handle")
    )
    business, customer = F.col("businessValue") == 1, F.col("customerValue") == 1
    category = (
        F.when(business & customer, "Encourage").when(business, "Simplify").when(customer, "Digitize").otherwise("Eliminate")
    )
    return out.withColumn("category", category)


def final_queue(segments: DataFrame) -> DataFrame:
    """Queue of the last segment that has one."""
    s = segments.filter("queueId is not null")
    return ordered.newest(s, [KEY], F.col("segmentEnd").desc(), F.col("participantId").desc()).select(KEY, "queueId")


def final_code(segments: DataFrame, codes: DataFrame) -> DataFrame:
    """Last wrap-up segment with a known code, with its participant."""
    s = segments.filter("segmentType = 'wrapup' and wrapUpCodeId is not null").join(
        codes.select("wrapUpCodeId").distinct(), "wrapUpCodeId", "left_semi"
    )
    return ordered.newest(s, [KEY], F.col("segmentEnd").desc(), F.col("participantId").desc()).select(
        KEY, F.col("wrapUpCodeId").alias("finalWrapupCode"), "participantId"
    )


def local_conversations(conversations, participants, segments, codes, queues, insights) -> DataFrame:
    """Conversations in the local time of their final queue, with users, final queue and final code."""
    users = ag.text_lists(participants, [KEY], "userId", "userIds")
    places = queues.select("queueId", "region", "timeZone")
    out = (
        conversations.filter("initialSessionMediaTypeId = 1")
        .join(users, KEY)
        .join(final_queue(segments), KEY)
        .join(final_code(segments, codes).drop("participantId"), KEY)
        .join(insights.select(KEY, "resolved", F.col("process_name").alias("scenarioName")), KEY, "left")
        .join(places, "queueId")
    )
    start = F.coalesce(F.from_utc_timestamp("conversationStart", F.col("timeZone")), F.col("conversationStart"))
    end = F.coalesce(F.from_utc_timestamp("conversationEnd", F.col("timeZone")), F.col("conversationEnd"))
    return out.select(
        KEY,
        start.alias("conversationStart"),
        end.alias("conversationEnd"),
        "originatingDirectionId",
        F.col("initialSessionMediaTypeId").alias("mediaTypeId"),
        F.col("region").alias("location"),
        "userIds",
        F.col("queueId").alias("finalQueueId"),
        F.col("finalWrapupCode").alias("finalWrapupCodeId"),
        "scenarioName",
        "resolved",
        date_id(start).alias("conversationStartDateId"),
    ).distinct()


KPI_KEYS = ["conversationStartDateId", "originatingDirectionId", "mediaTypeId", "userId", "queueId", "finalWrapupCode", "resolved", "scenarioName", "location"]


def user_kpis(
    conversations, participants, segments, metrics, insights, surveys, codes, queues, users, detractor_max: int = 8
) -> DataFrame:
    """User KPI facts as (numerator, denominator): sales, AHT, hold, after-call work, CSAT, NPS, conversion.

    Equal rows of different branches collapse. ``detractor_max`` is the highest score of a detractor. The tables of
    conversations are stored by start month, surveys are not.
    """
    zones = users.select("userId", "timeZone")
    places = queues.select("queueId", F.col("region").alias("location"))
    voice = conversations.filter("initialSessionMediaTypeId = 1").select(
        MONTH, KEY, "conversationStart", "originatingDirectionId", F.col("initialSessionMediaTypeId").alias("mediaTypeId")
    )
    local_day = date_id(F.from_utc_timestamp("conversationStart", F.col("timeZone"))).alias("conversationStartDateId")
    # only voice conversations count, so nothing is worked out for the others
    participants, segments, metrics = (jn.of_wanted(x, voice, MONTH, [KEY]) for x in (participants, segments, metrics))
    told = jn.within_parts(insights, voice, MONTH).select(KEY, "resolved", F.col("process_name").alias("scenarioName"))
    voice = voice.drop(MONTH)

    coder = final_code(segments, codes).join(
        participants.select(KEY, "participantId", "userId"), [KEY, "participantId"]
    ).drop("participantId")
    handled = per_user_metrics(metrics, participants, ["tHandle", "tHeldComplete", "tAcw"])
    per_conversation = (
        voice.join(coder, KEY)
        .join(final_queue(segments), KEY)
        .join(handled, [KEY, "userId"])
        .join(places, "queueId")
        .join(zones, "userId")
        .join(told, KEY, "left")
        .select(*[c for c in KPI_KEYS if c != "conversationStartDateId"], local_day, "tHandle", "tHeldComplete", "tAcw")
    )
    base = per_conversation.groupBy(*KPI_KEYS).agg(
        F.sum("tHandle").alias("tHandle"),
        F.sum(F.coalesce("tHeldComplete", F.lit(0))).alias("tHeld"),
        F.sum(F.coalesce("tAcw", F.lit(0))).alias("tAcw"),
        F.count(F.lit(1)).alias("n"),
    )
    outbound = codes.select(F.col("wrapUpCodeId").alias("finalWrapupCode"), "sales", "decisionMakerContact")
    base = base.join(outbound, "finalWrapupCode", "left")
    n, zero, one = F.col("n"), F.lit(0).cast("long"), F.lit(1).cast("long")
    sold = F.coalesce("sales", F.lit(False))
    # every branch of the union reads the same group, so the branches are entries of one array
    branches = [
        ("sales", F.when(sold, n).otherwise(zero), one),
        ("AHT", F.col("tHandle"), n * 1000),
        ("Hold", F.col("tHeld"), n * 1000),
        ("ACW", F.col("tAcw"), n * 1000),
        ("sales conversion", F.when(sold, n * 100).otherwise(zero), F.when(F.coalesce("decisionMakerContact", F.lit(False)), n).otherwise(zero)),
    ]
    entry = F.explode(F.array(*[F.struct(F.lit(k).alias("kpiName"), a.cast("long").alias("num"), d.cast("long").alias("denom")) for k, a, d in branches]))
    handling = base.select(*KPI_KEYS, entry.alias("k")).select(*KPI_KEYS, "k.*")

    answered = (
        surveys.join(voice, KEY).join(zones, "userId").join(places, "queueId").join(told, KEY, "left")
        .select(*[c for c in KPI_KEYS if c != "conversationStartDateId"], local_day, "csatAchieved", "csatMax", "npsScore", "npsMax")
    )
    rated = answered.groupBy(*KPI_KEYS).agg(
        F.sum("csatAchieved").alias("got"),
        F.sum(F.when(F.col("csatAchieved").isNotNull(), F.col("csatMax"))).alias("most"),
        F.count_if(F.col("npsScore") <= detractor_max).alias("against"),
        F.count_if(F.col("npsScore").isin(9, 10)).alias("for"),
        F.count("npsMax").alias("total"),
    )
    opinions = [
        F.when(F.col("got").isNotNull(), F.struct(F.lit("CSAT").alias("kpiName"), (F.col("got") * 100).cast("long").alias("num"), F.col("most").cast("long").alias("denom"))),
        F.struct(F.lit("NPS").alias("kpiName"), ((F.col("for") - F.col("against")) * 100).alias("num"), F.col("total").alias("denom")),
    ]
    asked = rated.select(*KPI_KEYS, F.explode(F.array_compact(F.array(*opinions))).alias("k")).select(*KPI_KEYS, "k.*")
    return handling.unionByName(asked).distinct()


def conformance_scores(answers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Yes answers and number of distinct questions per key."""
    return answers.groupBy(*keys).agg(
        F.count_if(F.col("answer") == "yes").alias("num"), F.countDistinct("question").alias("denom")
    )


def conformance_rollup(answers, conversations, participants, segments, codes, queues, insights) -> DataFrame:
    """Yes answers and questions per day, direction, final code, final queue and outcome."""
    place = queues.select("queueId", F.col("region").alias("queueRegion"), "timeZone")
    rows = (
        conformance_scores(answers, [KEY])
        .join(conversations.drop("location"), KEY)
        .join(final_queue(segments), KEY)
        .join(final_code(segments, codes), KEY)
        .join(participants.select(KEY, "participantId", "userId"), [KEY, "participantId"])
        .join(place, "queueId")
        .join(insights.select(KEY, "resolved", F.col("process_name").alias("scenarioName")), KEY, "left")
    )
    day = date_id(F.from_utc_timestamp("conversationStart", F.col("timeZone")))
    return rows.groupBy(
        "userId",
        day.alias("conversationStartDateId"),
        "originatingDirectionId",
        F.col("initialSessionMediaTypeId").alias("mediaTypeId"),
        F.col("finalWrapupCode").alias("finalWrapupCodeId"),
        F.col("queueId").alias("finalQueueId"),
        "resolved",
        "scenarioName",
        F.col("queueRegion").alias("location"),
    ).agg(F.sum("num").alias("noOfYesAnswer"), F.sum("denom").alias("totalQuestions"))


def flag_for_assessment(conversations, answers, segments, codes, evaluations, success_codes: Sequence[str]) -> DataFrame:
    """Set isManualAssessmentNeeded where a sale has less than full compliance, and hasManuallyEvaluated
    where a flagged conversation already has a finished evaluation."""
    weak = conformance_scores(answers, [KEY]).filter(F.col("num") * 100 / F.col("denom") < 100).select(KEY)
    sold = (
        final_code(segments, codes)
        .join(codes.withColumnRenamed("wrapUpCodeId", "finalWrapupCode"), "finalWrapupCode")
        .filter(F.col("wrapUpCode").isin(*success_codes))
        .select(KEY)
    )
    due = weak.join(sold, KEY, "left_semi").distinct().withColumn("_due", F.lit(True))
    finished = evaluations.filter("status = 'FINISHED'").select(KEY).distinct().withColumn("_done", F.lit(True))
    out = conversations.join(due, KEY, "left").join(finished, KEY, "left")
    needed = F.coalesce("_due", F.lit(False))
    return out.withColumns(
        {"isManualAssessmentNeeded": needed, "hasManuallyEvaluated": needed & F.coalesce("_done", F.lit(False))}
    ).drop("_due", "_done")


def flagged_view(flagged: DataFrame, answers: DataFrame, segments: DataFrame, participants: DataFrame) -> DataFrame:
    """Flagged conversations with compliance score, final queue and users."""
    score = conformance_scores(answers, [KEY]).select(KEY, (F.col("num") * 100 / F.col("denom")).alias("complianceScore"))
    users = ag.text_lists(participants, [KEY], "userId", "userIds")
    return (
        flagged.filter("isManualAssessmentNeeded")
        .select(KEY, "conversationStartDateId", "hasManuallyEvaluated")
        .join(score, KEY)
        .join(final_queue(segments), KEY, "left")
        .join(users, KEY, "left")
    )


def team_membership(members: DataFrame, users: DataFrame, last_seen: str) -> DataFrame:
    """Team rows of a user: roles as text, open end while active, hire date or 2020-01-01 as start."""
    roles = ag.text_lists(users.select("userId", F.explode_outer("roles").alias("role")), ["userId"], "role", "roles")
    return (
        members.join(users.drop("roles"), "userId")
        .join(roles, "userId", "left")
        .select(
            "userId",
            "userName",
            "groupName",
            F.col("groupName").alias("teamName"),
            "roles",
            "region",
            F.coalesce("hireDate", F.to_date(F.lit("2020-01-01"))).alias("startDate"),
            F.when(F.col("active"), F.to_date(F.lit("9999-12-31"))).otherwise(F.col(last_seen)).alias("endDate"),
            F.col("active").alias("isActive"),
        )
    )


def queue_language(config: DataFrame, queues: DataFrame) -> DataFrame:
    """Configured queue languages with the id of the queue of that name, if there is one."""
    ids = queues.select("queueId", F.lower(F.trim("queueName")).alias("_key")).distinct()
    return (
        config.withColumn("_key", F.lower(F.trim("queueName")))
        .join(ids, "_key", "left")
        .select("region", "brand", "queueName", "language", "queueId")
        .distinct()
    )


def queue_regions(config: DataFrame, queues: DataFrame) -> DataFrame:
    """Queue regions; brand and language come from a ``country-brand-language`` cell."""
    cell = F.split("countryBrandLanguage", "-")
    ids = queues.select("queueId", F.lower(F.trim("queueName")).alias("_key")).distinct()
    return (
        config.withColumn("_key", F.lower(F.trim("queueName")))
        .join(ids, "_key")
        .select("queueName", "queueId", "region", "country", F.get(cell, F.lit(1)).alias("brand"), F.get(cell, F.lit(2)).alias("language"), "timeZone")
        .distinct()
    )


def user_regions(config: DataFrame) -> DataFrame:
    """Configured group, region and zone of users; the region stands for the country."""
    return config.select("userId", "groupName", "region", F.col("region").alias("country"), "timeZone", "provider").distinct()


def outbound_codes(config: DataFrame) -> DataFrame:
    """Configured wrap-up codes of outbound calls, taken over as delivered."""
    return config.select("wrapUpCodeId", "wrapUpCode", "sales", "decisionMakerContact")
