"""Reporting marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.plans import marts
from callweave.plans.process import started_since
from callweave.queries.prelude import EVENTS, LINES, MART, USERS, with_
from callweave.queries.process import SINCE
from callweave.queries.registry import REGISTRY, query
from callweave.sources import raw, star


def _sum(name, as_=None):
    return f"sum(CASE WHEN name = '{name}' THEN value END)::BIGINT AS {as_ or name}"


@query(
    "d20_handling_metrics",
    with_(MART)
    + f""", m AS (SELECT met.conversationId, userId, {", ".join(_sum(n) for n in marts.HANDLING)} FROM met JOIN prt USING (conversationId, participantId)
           WHERE userId IS NOT NULL AND name <> 'tHeld' GROUP BY 1, 2),
        j AS (SELECT m.*, mediaTypeId, conversationStartDateId, lower(resolved) AS r, lower(satisfaction) AS s FROM m JOIN oc USING (conversationId) LEFT JOIN ins USING (conversationId))
       SELECT conversationId, mediaTypeId, conversationStartDateId, userId, nBlindTransferred, nConsultTransferred, nConsult, nTransferred, tHandle, tTalkComplete, tHeldComplete, tAcw AS tAcwComplete,
         (CASE WHEN r IN ('resolved', 'partially resolved') THEN 1 ELSE 0 END)::INTEGER AS resolved, (CASE WHEN r = 'not resolved' THEN 1 ELSE 0 END)::INTEGER AS notResolved,
         CASE WHEN r IN ('resolved', 'partially resolved') THEN tHandle ELSE 0 END AS tHandleResolved, CASE WHEN r = 'not resolved' THEN tHandle ELSE 0 END AS tHandleNotResolved,
         (CASE s WHEN 'lowest' THEN 20 WHEN 'low' THEN 40 WHEN 'medium' THEN 60 WHEN 'high' THEN 80 WHEN 'highest' THEN 100 ELSE 0 END)::INTEGER AS satisfaction FROM j""",
)
def handling_metrics(t):
    return marts.handling_metrics(
        t.star("conversations"), t.star("metrics"), t.star("participants"), t.star("insights")
    )


@query("d20_recent_handling", f"SELECT * FROM ({REGISTRY['d20_handling_metrics'].sql}) WHERE conversationStartDateId >= {SINCE}")
def recent_handling(t):
    recent = started_since(t.star("conversations"), SINCE)
    return marts.handling_metrics(recent, t.star("metrics"), t.star("participants"), t.star("insights"))


@query(
    "d21_cost_view",
    with_(MART)
    + """SELECT oc.conversationId, conversationStartDateId, mediaTypeId AS initialSessionMediaTypeId, location, originatingDirectionId, contactReason, mainInquiry, rootCause, resolved, satisfaction,
          queueIds, coalesce(wrapUpCodeIds, '') AS wrapUpCodeIds, tHandle
        FROM oc JOIN (SELECT conversationId, string_agg(DISTINCT queueId, ',' ORDER BY queueId) AS queueIds, string_agg(DISTINCT wrapUpCodeId, ',' ORDER BY wrapUpCodeId) AS wrapUpCodeIds FROM seg GROUP BY 1) USING (conversationId)
        JOIN (SELECT conversationId, sum(value)::BIGINT AS tHandle FROM met WHERE name = 'tHandle' GROUP BY 1) USING (conversationId)
        LEFT JOIN ins USING (conversationId) LEFT JOIN rea USING (conversationId)""",
)
def cost_view(t):
    return marts.cost_view(
        t.star("conversations"), t.star("segments"), t.star("metrics"), t.star("insights"), t.star("contact_reasons")
    )


@query("d21_recent_cost_view", f"SELECT * FROM ({REGISTRY['d21_cost_view'].sql}) WHERE conversationStartDateId >= {SINCE}")
def recent_cost_view(t):
    recent = started_since(t.star("conversations"), SINCE)
    return marts.cost_view(recent, t.star("segments"), t.star("metrics"), t.star("insights"), t.star("contact_reasons"))


@query(
    "d21_result_view",
    with_(MART)
    + """SELECT conversationStartDateId, mediaTypeId AS initialSessionMediaTypeId, location, originatingDirectionId, contactReason, mainInquiry, rootCause, resolved, satisfaction,
          count(DISTINCT oc.conversationId) AS totalInteractions, string_agg(DISTINCT queueId, ',' ORDER BY queueId) AS queueIds
        FROM oc JOIN seg USING (conversationId) LEFT JOIN ins USING (conversationId) LEFT JOIN rea USING (conversationId) GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""",
)
def result_view(t):
    return marts.result_view(
        t.star("conversations"), t.star("segments"), t.star("insights"), t.star("contact_reasons")
    )


@query(
    "d22_reason_quadrants",
    with_(MART)
    + """, a AS (SELECT conversationId, sum(value)::DOUBLE AS h FROM met WHERE name = 'tHandle' GROUP BY 1),
        g AS (SELECT contactReason, mainInquiry, mediaTypeId, sum(h) AS h, count(DISTINCT CASE WHEN lower(additional_service) = 'yes' THEN conversationId END) AS additionalService,
           count(DISTINCT CASE WHEN lower(resolved) IN ('resolved', 'partially resolved') THEN conversationId END) AS resolved, count(DISTINCT conversationId) AS totalInteractions
          FROM ins JOIN rea USING (conversationId) JOIN a USING (conversationId) JOIN oc USING (conversationId) GROUP BY 1, 2, 3),
        v AS (SELECT contactReason, mainInquiry, mediaTypeId, h / (totalInteractions * 1000) AS tHandle, additionalService, resolved, totalInteractions,
           (CASE WHEN additionalService * 100 / totalInteractions >= 10 THEN 1 ELSE 0 END)::INTEGER AS businessValue,
           (CASE WHEN resolved * 100 / totalInteractions >= 50 AND h / (totalInteractions * 1000) < 700 THEN 1 ELSE 0 END)::INTEGER AS customerValue FROM g)
       SELECT *, CASE WHEN businessValue = 0 AND customerValue = 0 THEN 'Eliminate' WHEN businessValue = 0 THEN 'Digitize' WHEN customerValue = 0 THEN 'Simplify' ELSE 'Encourage' END AS category FROM v""",
)
def reason_quadrants(t):
    return marts.reason_quadrants(
        t.star("metrics"), t.star("conversations"), t.star("insights"), t.star("contact_reasons")
    )


@query(
    "d23_local_conversations",
    with_(MART)
    + """, u AS (SELECT conversationId, string_agg(DISTINCT userId, ',' ORDER BY userId) AS userIds FROM prt WHERE userId IS NOT NULL GROUP BY 1)
       SELECT oc.conversationId, ((conversationStart AT TIME ZONE 'UTC') AT TIME ZONE que.timeZone)::VARCHAR AS conversationStart, ((conversationEnd AT TIME ZONE 'UTC') AT TIME ZONE que.timeZone)::VARCHAR AS conversationEnd,
         originatingDirectionId, mediaTypeId, que.region AS location, userIds, queueId AS finalQueueId, finalWrapupCode AS finalWrapupCodeId, process_name AS scenarioName, resolved,
         CAST(strftime((conversationStart AT TIME ZONE 'UTC') AT TIME ZONE que.timeZone, '%Y%m%d') AS INTEGER) AS conversationStartDateId
       FROM oc JOIN u USING (conversationId) JOIN fq USING (conversationId) JOIN fc USING (conversationId) LEFT JOIN ins USING (conversationId) JOIN que USING (queueId) WHERE mediaTypeId = 1""",
)
def local_conversations(t):
    return marts.local_conversations(
        t.star("conversations"), t.star("participants"), t.star("segments"), star.wrap_up_codes(t.part), star.queues(t.part), t.star("insights")
    )


def surveys(t):
    """A survey for every fourth order, answered by the customer about an agent and a queue."""
    key, who = F.col("o_orderkey"), F.col("o_custkey")
    agents = t.supplier.select(F.col("s_suppkey"))
    s = t.orders.filter("o_orderkey % 4 <> 0").select(
        key.cast("string").alias("conversationId"),
        (who % 10).alias("s_suppkey"),
        F.concat(F.lit("queue-"), who % 25).alias("queueId"),
        F.when(who % 5 != 0, F.concat(F.lit("code-"), who % 9)).alias("finalWrapupCode"),
        F.when(key % 3 != 0, (key % 5).cast("long")).alias("csatAchieved"),
        F.lit(5).cast("long").alias("csatMax"),
        (key % 11).alias("npsScore"),
        F.when(key % 2 == 1, F.lit(10)).alias("npsMax"),
    )
    return s.join(agents, "s_suppkey", "left_semi").withColumn("userId", F.concat(F.lit("agent-"), "s_suppkey")).drop("s_suppkey")


@query(
    "d24_user_kpis",
    with_(MART)
    + """, h AS (SELECT conversationId, userId, sum(CASE WHEN name = 'tHandle' THEN value END) AS tHandle, sum(CASE WHEN name = 'tHeldComplete' THEN value END) AS tHeld, sum(CASE WHEN name = 'tAcw' THEN value END) AS tAcw
          FROM met JOIN prt USING (conversationId, participantId) WHERE userId IS NOT NULL AND name IN ('tHandle', 'tHeldComplete', 'tAcw') GROUP BY 1, 2),
        c AS (SELECT CAST(strftime((conversationStart AT TIME ZONE 'UTC') AT TIME ZONE agt.timeZone, '%Y%m%d') AS INTEGER) AS conversationStartDateId, originatingDirectionId, mediaTypeId, prt.userId, queueId, finalWrapupCode,
           resolved, process_name AS scenarioName, que.region AS location, sum(tHandle)::BIGINT AS tHandle, sum(coalesce(tHeld, 0))::BIGINT AS tHeld, sum(coalesce(tAcw, 0))::BIGINT AS tAcw, count(*) AS n
          FROM oc JOIN fc USING (conversationId) JOIN prt ON prt.conversationId = oc.conversationId AND prt.participantId = fc.participantId JOIN fq ON fq.conversationId = oc.conversationId JOIN que USING (queueId)
          JOIN h ON h.conversationId = oc.conversationId AND h.userId = prt.userId JOIN agt ON agt.userId = prt.userId LEFT JOIN ins ON ins.conversationId = oc.conversationId WHERE mediaTypeId = 1 GROUP BY ALL),
        cw AS (SELECT c.*, coalesce(sales, FALSE) AS sales, coalesce(decisionMakerContact, FALSE) AS dmc FROM c LEFT JOIN cod ON cod.wrapUpCodeId = finalWrapupCode),
        sv AS (SELECT CAST(o_orderkey AS VARCHAR) AS conversationId, 'agent-' || (o_custkey % 10) AS userId, 'queue-' || (o_custkey % 25) AS queueId, CASE WHEN o_custkey % 5 <> 0 THEN 'code-' || (o_custkey % 9) END AS finalWrapupCode,
           CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 5 END AS got, o_orderkey % 11 AS nps, CASE WHEN o_orderkey % 2 = 1 THEN 10 END AS npsMax FROM orders WHERE o_orderkey % 4 <> 0),
        sg AS (SELECT CAST(strftime((conversationStart AT TIME ZONE 'UTC') AT TIME ZONE agt.timeZone, '%Y%m%d') AS INTEGER) AS conversationStartDateId, originatingDirectionId, mediaTypeId, sv.userId, sv.queueId, finalWrapupCode, resolved,
           process_name AS scenarioName, que.region AS location, sum(got) AS got, sum(CASE WHEN got IS NOT NULL THEN 5 END) AS most, count(*) FILTER (WHERE nps <= 8) AS det, count(*) FILTER (WHERE nps IN (9, 10)) AS pro, count(npsMax) AS total
          FROM sv JOIN oc USING (conversationId) JOIN agt ON agt.userId = sv.userId JOIN que ON que.queueId = sv.queueId LEFT JOIN ins USING (conversationId) WHERE mediaTypeId = 1 GROUP BY ALL),
        u AS (SELECT * EXCLUDE (tHandle, tHeld, tAcw, n, sales, dmc), 'sales' AS kpiName, (CASE WHEN sales THEN n ELSE 0 END)::BIGINT AS num, 1::BIGINT AS denom FROM cw
          UNION SELECT * EXCLUDE (tHandle, tHeld, tAcw, n, sales, dmc), 'AHT', tHandle, n * 1000 FROM cw UNION SELECT * EXCLUDE (tHandle, tHeld, tAcw, n, sales, dmc), 'Hold', tHeld, n * 1000 FROM cw
          UNION SELECT * EXCLUDE (tHandle, tHeld, tAcw, n, sales, dmc), 'ACW', tAcw, n * 1000 FROM cw
          UNION SELECT * EXCLUDE (tHandle, tHeld, tAcw, n, sales, dmc), 'sales conversion', CASE WHEN sales THEN n * 100 ELSE 0 END, CASE WHEN dmc THEN n ELSE 0 END FROM cw
          UNION SELECT * EXCLUDE (got, most, det, pro, total), 'CSAT', (got * 100)::BIGINT, most::BIGINT FROM sg WHERE got IS NOT NULL
          UNION SELECT * EXCLUDE (got, most, det, pro, total), 'NPS', ((pro - det) * 100)::BIGINT, total::BIGINT FROM sg) SELECT * FROM u""",
)
def user_kpis(t):
    return marts.user_kpis(
        t.star("conversations"),
        t.star("participants"),
        t.star("segments"),
        t.star("metrics"),
        t.star("insights"),
        surveys(t),
        star.wrap_up_codes(t.part),
        star.queues(t.part),
        star.agents(t.supplier, t.nation, t.region),
    )


def check_answers(t):
    """Check answers from labels: a question about quality and one about toxicity per document."""
    yes = F.when(F.col("quality") == 1, "yes").otherwise("no")
    clean = F.when(F.col("toxic") == 0, "yes").otherwise("no")
    entries = F.array(
        F.struct(F.lit("quality").alias("question"), yes.alias("answer")),
        F.struct(F.lit("toxic").alias("question"), clean.alias("answer")),
        F.struct(F.lit("toxic").alias("question"), yes.alias("answer")),
    )
    return t.labels.select(F.col("doc_id").cast("string").alias("conversationId"), F.explode(entries).alias("e")).select("conversationId", "e.*")


ANSWERS = """, an AS (SELECT CAST(doc_id AS VARCHAR) AS conversationId, 'quality' AS question, CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS answer FROM labels
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'toxic', CASE WHEN toxic = 0 THEN 'yes' ELSE 'no' END FROM labels
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'toxic', CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END FROM labels),
  cs AS (SELECT conversationId, count(*) FILTER (WHERE answer = 'yes') AS num, count(DISTINCT question) AS denom FROM an GROUP BY 1)"""


@query(
    "d25_conformance_rollup",
    with_(MART)
    + ANSWERS
    + """ SELECT userId, CAST(strftime((conversationStart AT TIME ZONE 'UTC') AT TIME ZONE que.timeZone, '%Y%m%d') AS INTEGER) AS conversationStartDateId, originatingDirectionId, mediaTypeId, finalWrapupCode AS finalWrapupCodeId,
         queueId AS finalQueueId, resolved, process_name AS scenarioName, que.region AS location, sum(num)::BIGINT AS noOfYesAnswer, sum(denom)::BIGINT AS totalQuestions
       FROM cs JOIN oc USING (conversationId) JOIN fq USING (conversationId) JOIN fc USING (conversationId) JOIN prt ON prt.conversationId = oc.conversationId AND prt.participantId = fc.participantId JOIN que USING (queueId)
       LEFT JOIN ins ON ins.conversationId = oc.conversationId GROUP BY ALL""",
)
def conformance_rollup(t):
    return marts.conformance_rollup(
        check_answers(t),
        t.star("conversations"),
        t.star("participants"),
        t.star("segments"),
        star.wrap_up_codes(t.part),
        star.queues(t.part),
        t.star("insights"),
    )


SUCCESS = ["Code 0", "Code 1", "Code 2", "Code 3", "Code 4"]
FLAGGED = (
    ANSWERS
    + """, due AS (SELECT conversationId FROM cs JOIN fc USING (conversationId) JOIN cod ON wrapUpCodeId = finalWrapupCode WHERE num * 100.0 / denom < 100 AND wrapUpCode IN ('Code 0', 'Code 1', 'Code 2', 'Code 3', 'Code 4')),
  fin AS (SELECT DISTINCT conversationId FROM lines WHERE lineNumber <> 1),
  flg AS (SELECT conversationId, conversationStartDateId, conversationId IN (SELECT conversationId FROM due) AS isManualAssessmentNeeded,
    conversationId IN (SELECT conversationId FROM due) AND conversationId IN (SELECT conversationId FROM fin) AS hasManuallyEvaluated FROM oc)"""
)


def _flagged(t):
    evaluations = raw.evaluation_payloads(t.line_sessions()).select(F.col("conversation.id").alias("conversationId"), "status")
    return marts.flag_for_assessment(
        t.star("conversations"), check_answers(t), t.star("segments"), star.wrap_up_codes(t.part), evaluations, SUCCESS
    )


@query(
    "d26_compliance_flags",
    with_(MART) + FLAGGED + " SELECT conversationId, isManualAssessmentNeeded, hasManuallyEvaluated FROM flg",
)
def compliance_flags(t):
    return _flagged(t).select("conversationId", "isManualAssessmentNeeded", "hasManuallyEvaluated")


@query(
    "d26_flagged_view",
    with_(MART)
    + FLAGGED
    + """ SELECT conversationId, conversationStartDateId, hasManuallyEvaluated, num * 100::DOUBLE / denom AS complianceScore, queueId, userIds FROM flg JOIN cs USING (conversationId) LEFT JOIN fq USING (conversationId)
       LEFT JOIN (SELECT conversationId, string_agg(DISTINCT userId, ',' ORDER BY userId) AS userIds FROM prt WHERE userId IS NOT NULL GROUP BY 1) USING (conversationId) WHERE isManualAssessmentNeeded""",
)
def flagged_view(t):
    return marts.flagged_view(_flagged(t), check_answers(t), t.star("segments"), t.star("participants"))


@query(
    "d28_team_membership",
    with_(USERS)
    + """SELECT userId, userName, groupName, groupName AS teamName, CASE WHEN userNo % 3 = 0 THEN 'admin,agent' ELSE 'agent' END AS roles, region,
          CASE WHEN userNo % 4 = 0 THEN '2019-05-01' ELSE '2020-01-01' END AS startDate, CASE WHEN state = 'active' THEN '9999-12-31' ELSE '2024-01-31' END AS endDate, state = 'active' AS isActive FROM users""",
)
def team_membership(t):
    u = raw.users(t.customer, t.nation, t.region)
    agent, admin = F.lit("agent"), F.lit("admin")
    people = u.select(
        "userId",
        "userName",
        F.when(F.col("userNo") % 3 == 0, F.array(agent, admin, agent)).otherwise(F.array(agent)).alias("roles"),
        F.when(F.col("userNo") % 4 == 0, F.to_date(F.lit("2019-05-01"))).alias("hireDate"),
        F.to_date(F.lit("2024-01-31")).alias("seen"),
        (F.col("state") == "active").alias("active"),
    )
    return marts.team_membership(u.select("userId", "groupName", "region"), people, "seen")


@query(
    "d29_queue_language",
    """WITH c AS (SELECT p_partkey % 30 AS n, p_brand AS brand FROM part) SELECT DISTINCT 'R' || (n % 5) AS region, brand, ' QUEUE ' || n AS queueName, 'L' || (n % 3) AS language, CASE WHEN n < 24 THEN 'queue-' || n END AS queueId FROM c""",
)
def queue_language(t):
    n = F.col("p_partkey") % 30
    config = t.part.select(
        F.concat(F.lit("R"), n % 5).alias("region"), F.col("p_brand").alias("brand"), F.concat(F.lit(" QUEUE "), n).alias("queueName"), F.concat(F.lit("L"), n % 3).alias("language")
    )
    return marts.queue_language(config, star.queues(t.part))


@query(
    "d29_queue_regions",
    """SELECT DISTINCT 'queue ' || (p_partkey % 25) AS queueName, 'queue-' || (p_partkey % 25) AS queueId, 'R1' AS region, 'DE' AS country, p_type AS brand, 'de' AS language, 'Europe/Berlin' AS timeZone
       FROM part WHERE p_partkey % 25 <> 24""",
)
def queue_regions(t):
    config = t.part.select(
        F.concat(F.lit("queue "), F.col("p_partkey") % 25).alias("queueName"),
        F.lit("R1").alias("region"),
        F.lit("DE").alias("country"),
        F.concat(F.lit("DE-"), "p_type", F.lit("-de")).alias("countryBrandLanguage"),
        F.lit("Europe/Berlin").alias("timeZone"),
    )
    return marts.queue_regions(config, star.queues(t.part))


@query(
    "d29_user_regions",
    with_(USERS) + "SELECT DISTINCT userId, groupName, region, region AS country, timeZone, 'provider ' || (userNo % 2) AS provider FROM users",
)
def user_regions(t):
    u = raw.users(t.customer, t.nation, t.region).withColumn("provider", F.concat(F.lit("provider "), F.col("userNo") % 2))
    return marts.user_regions(u.unionByName(u.filter("userNo % 2 = 0")))


@query(
    "d29_outbound_codes",
    """SELECT DISTINCT 'code-' || (p_partkey % 12) AS wrapUpCodeId, 'Code ' || (p_partkey % 12) AS wrapUpCode, p_partkey % 12 < 2 AS sales, p_partkey % 12 < 6 AS decisionMakerContact FROM part""",
)
def outbound_codes(t):
    n = F.col("p_partkey") % 12
    config = t.part.select(
        F.concat(F.lit("code-"), n).alias("wrapUpCodeId"), F.concat(F.lit("Code "), n).alias("wrapUpCode"), (n < 2).alias("sales"), (n < 6).alias("decisionMakerContact"), F.lit("x").alias("note")
    )
    return marts.outbound_codes(config.distinct())
