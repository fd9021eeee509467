"""Transcript facts, timelines, process map and complexity."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from callweave.operators import upserts as up
from callweave.operators.projections import without_listed
from callweave.plans import conversations as cv
from callweave.plans import process as pr
from callweave.plans import transcripts as tr
from callweave.queries.prelude import EVENTS, LINES, MART, TURNS, with_
from callweave.queries.registry import query
from callweave.queries.stored import loaded, loaded_sql
from callweave.sources import raw, star


def _insight_documents(t):
    """Insight documents of every order, delivered twice for even ones; the later delivery counts."""
    base = star.insights(t.orders).join(star.contact_reasons(t.orders), "conversationId", "left")
    inquiry = F.struct(F.col("mainInquiry").alias("main_inquiry"), F.col("rootCause").alias("root_cause"), F.lit("simple").alias("inquiry_type"))
    contact = F.when(
        F.col("contactReason").isNotNull(), F.array(F.struct(F.col("contactReason").alias("contact_reason"), F.array(inquiry).alias("inquiries")))
    )
    number = F.col("conversationId").cast("long")
    insight = F.struct(
        F.lit("neutral").alias("sentiment"), "resolved", "satisfaction", "additional_service", "process_name",
        F.struct((number % 11).alias("nps_score"), (number % 5).alias("knowledge_score")).alias("scoring"), contact.alias("contact"),
    )
    docs = base.select(
        F.col("conversationId").alias("conversation_id"), F.concat(F.lit("summary "), "conversationId").alias("summary"), F.array(insight).alias("insights"), F.lit(2).alias("recordInsertTime")
    )
    stale = docs.filter(F.col("conversation_id").cast("long") % 2 == 0).withColumns(
        {"recordInsertTime": F.lit(1), "summary": F.lit("stale"), "insights": F.slice("insights", 1, 0)}
    )
    return docs.unionByName(stale)


@query(
    "d15_insights",
    with_(MART)
    + "SELECT conversationId, conversationStartDateId, 'neutral' AS sentiment, resolved, satisfaction, additional_service, process_name FROM ins JOIN oc USING (conversationId)",
)
def insights(t):
    return tr.insights(_insight_documents(t), star.conversations(t.orders))


@query(
    "d15_contact_reasons",
    with_(MART)
    + "SELECT conversationId, conversationStartDateId, contactReason, mainInquiry, rootCause, 'simple' AS inquiry_type FROM ins JOIN rea USING (conversationId) JOIN oc USING (conversationId)",
)
def contact_reasons(t):
    return tr.contact_reasons(_insight_documents(t), star.conversations(t.orders))


@query(
    "d15_knowledge_and_survey_scores",
    with_(MART)
    + "SELECT conversationId, conversationStartDateId, o_orderkey % 11 AS npsScore, o_orderkey % 5 AS knowledgeScore FROM ins JOIN oc USING (conversationId)",
)
def knowledge_and_survey_scores(t):
    return tr.knowledge_scores(_insight_documents(t), star.conversations(t.orders))


@query(
    "d15_summaries",
    with_(MART) + "SELECT conversationId, conversationStartDateId, 'summary ' || conversationId AS summary FROM ins JOIN oc USING (conversationId)",
)
def summaries(t):
    return tr.summaries(_insight_documents(t), star.conversations(t.orders))


def _check_documents(t, array):
    entries = F.array(
        F.struct(F.lit(f"{array} a").alias("question"), F.when(F.col("quality") == 1, " Yes").otherwise("no").alias("answer")),
        F.struct(F.lit(f"{array} b").alias("question"), F.when(F.col("toxic") == 0, "YES ").otherwise("no").alias("answer")),
    )
    return t.labels.select(
        F.col("doc_id").cast("string").alias("conversation_id"), entries.alias(array), F.lit(1).alias("recordInsertTime")
    )


def _check_query(array):
    sql = with_(MART) + (
        f"SELECT conversationId, conversationStartDateId, question, answer FROM (SELECT CAST(doc_id AS VARCHAR) AS conversationId, '{array} a' AS question, CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS answer FROM labels "
        f"UNION ALL SELECT CAST(doc_id AS VARCHAR), '{array} b', CASE WHEN toxic = 0 THEN 'yes' ELSE 'no' END FROM labels) JOIN oc USING (conversationId)"
    )

    @query(f"d15_{array}_answers", sql)
    def answers(t):
        return tr.answers(_check_documents(t, array), star.conversations(t.orders), array)


for _array in ("quality", "compliance", "conformance"):
    _check_query(_array)


@query(
    "d15_objections",
    with_(MART, TURNS)
    + """SELECT oc.conversationId, conversationStartDateId, t.participant AS objection, t.line AS startLine, 'offer' AS action, 'stage ' || (t.line % 3) AS stageName
         FROM turns t JOIN oc ON oc.conversationId = CAST(t.conversationId AS VARCHAR)""",
)
def objections(t):
    lines = raw.transcript_lines(t.conversations)
    entry = F.struct(
        F.col("participant").alias("objection"), F.col("line").alias("objection_start_line"), F.lit("offer").alias("action"), F.concat(F.lit("stage "), F.col("line") % 3).alias("stage_name")
    )
    docs = lines.groupBy(F.col("conversationId").cast("string").alias("conversation_id")).agg(F.collect_list(entry).alias("objection"), F.lit(1).alias("recordInsertTime"))
    return tr.objections(docs, star.conversations(t.orders))


@query(
    "d15_apprehensions",
    with_(MART, TURNS)
    + """SELECT oc.conversationId, conversationStartDateId, 'price' AS apprehension, length(t.phrase) % 5 AS severity
         FROM turns t JOIN oc ON oc.conversationId = CAST(t.conversationId AS VARCHAR)""",
)
def apprehensions(t):
    lines = raw.transcript_lines(t.conversations)
    entry = F.struct(F.lit("price").alias("apprehension"), (F.length("phrase") % 5).cast("long").alias("severity"))
    docs = lines.groupBy(F.col("conversationId").cast("string").alias("conversation_id")).agg(F.collect_list(entry).alias("apprehension"), F.lit(1).alias("recordInsertTime"))
    return tr.apprehensions(docs, star.conversations(t.orders))


def phrase_lines(t):
    """One phrase per turn, with time in milliseconds and a sentiment."""
    n = F.length("text")
    phrases = t.conversations.select(
        F.col("conv_id").alias("conversationId"),
        "text",
        F.when(F.col("role") == "assistant", "internal").otherwise("external").alias("participantPurpose"),
        (F.lit(1704067200000) + F.col("conv_id") * 600000 + F.col("turn") * 20000).alias("startTimeMs"),
        (n * 5).cast("long").alias("milliseconds"),
        ((n % 5 - 2).cast("double") / 2).alias("sentiment"),
    )
    return tr.numbered_phrases(phrases)


# steps written as (name, start line, end line); one is turned around, one has a line that is not there
STEPS = [("greet", 1, 2), ("turned", 3, 2), ("cut off", 2, 900), ("nowhere", 800, 900)]


def map_steps(t):
    steps = F.array(
        *[F.struct(F.lit(n).alias("stepName"), F.lit(a).cast("long").alias("startLine"), F.lit(b).cast("long").alias("endLine")) for n, a, b in STEPS]
    )
    first = t.conversations.filter("turn = 0")
    return first.select(F.col("conv_id").alias("conversationId"), F.explode(steps).alias("s")).select("conversationId", "s.*")


ANCHORS = """ln AS (SELECT conv_id AS conversationId, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS line, 1704067200000 + conv_id * 600000 + turn * 20000 AS startTimeMs, CAST(length(text) * 5 AS BIGINT) AS ms,
    (length(text) % 5 - 2) / 2.0::DOUBLE AS sentiment FROM conversations),
  st AS (SELECT conv_id AS conversationId, stepName, CAST(a AS BIGINT) AS startLine, CAST(b AS BIGINT) AS endLine FROM conversations, (VALUES ('greet', 1, 2), ('turned', 3, 2), ('cut off', 2, 900), ('nowhere', 800, 900)) v(stepName, a, b) WHERE turn = 0),
  g AS (SELECT st.*, sentiment, min(CASE WHEN line = startLine THEN make_timestamp(startTimeMs // 1000 * 1000000) END) AS s, max(CASE WHEN line = endLine THEN make_timestamp((startTimeMs + ms) // 1000 * 1000000) END) AS e, count(line) AS hits
    FROM st {join} JOIN ln ON ln.conversationId = st.conversationId AND (line = startLine OR line = endLine) GROUP BY ALL),
  h AS (SELECT * EXCLUDE (s, e), least(coalesce(s, e), coalesce(e, s))::VARCHAR AS startTime, greatest(coalesce(s, e), coalesce(e, s))::VARCHAR AS endTime FROM g)"""


@query(
    "d16_conversation_map",
    with_(ANCHORS.format(join="")) + "SELECT conversationId, stepName, startLine, endLine, sentiment, startTime, endTime FROM h",
)
def conversation_map(t):
    return tr.anchored_times(map_steps(t), phrase_lines(t), ["stepName", "startLine", "endLine"])


@query(
    "d16_value_stream",
    with_(ANCHORS.format(join="LEFT")) + "SELECT conversationId, stepName, startLine, endLine, sentiment, startTime, endTime FROM h",
)
def value_stream(t):
    return tr.anchored_times(map_steps(t), phrase_lines(t), ["stepName", "startLine", "endLine"], keep_unanchored=True)


@query(
    "d16_transcript_actions",
    with_(ANCHORS.format(join=""))
    + """, one AS (SELECT conversationId, stepName, startLine, endLine, min(CASE WHEN line = startLine THEN make_timestamp(startTimeMs // 1000 * 1000000) END) AS s, max(CASE WHEN line = endLine THEN make_timestamp((startTimeMs + ms) // 1000 * 1000000) END) AS e
           FROM st JOIN ln USING (conversationId) WHERE line = startLine OR line = endLine GROUP BY ALL),
         av AS (SELECT st.conversationId, stepName, sum(sentiment) / count(sentiment) AS sentiment FROM st JOIN ln ON ln.conversationId = st.conversationId AND line - 1 BETWEEN startLine AND endLine GROUP BY ALL)
       SELECT one.conversationId, one.stepName, startLine, endLine, least(coalesce(s, e), coalesce(e, s))::VARCHAR AS startTime, greatest(coalesce(s, e), coalesce(e, s))::VARCHAR AS endTime, av.sentiment
       FROM one LEFT JOIN av ON av.conversationId = one.conversationId AND av.stepName = one.stepName WHERE one.conversationId % 5 <> 0""",
)
def transcript_actions(t):
    lines = phrase_lines(t)
    sentiments = lines.select("conversationId", (F.col("line") - 1).alias("phraseIndex"), "sentiment")
    known = map_steps(t).filter("conversationId % 5 = 0").select("conversationId")
    return tr.actions(map_steps(t), lines, sentiments, known)


def spoken(t):
    """Phrases placed one minute apart from the first segment of the order with the same number."""
    first = star.segments(t.line_sessions()).groupBy("conversationId").agg(F.min("segmentStart").alias("_t0"))
    n = F.length("text")
    said = t.conversations.select(F.col("conv_id").cast("string").alias("conversationId"), "turn", "role", "text").join(first, "conversationId")
    return said.select(
        "conversationId",
        F.when(F.col("role") == "assistant", "internal").otherwise("external").alias("participantPurpose"),
        "text",
        (F.unix_millis("_t0") + F.col("turn") * 60000).alias("startTimeMs"),
        n.cast("long").alias("milliseconds"),
        ((n % 5 - 2).cast("double") / 2).alias("sentiment"),
    )


SPOKEN = """, t0 AS (SELECT conversationId, min(segmentStart) AS t0 FROM seg GROUP BY 1),
  sp AS (SELECT t0.conversationId, CASE WHEN role = 'assistant' THEN 'Agent' ELSE 'Customer' END AS participant, text, t0 + to_seconds(turn * 60) AS s, t0 + to_seconds(turn * 60) + to_milliseconds(length(text)) AS e,
    (length(text) % 5 - 2) / 2.0::DOUBLE AS sentiment FROM conversations JOIN t0 ON t0.conversationId = CAST(conv_id AS VARCHAR)),
  lh AS (SELECT conversationId, queueId FROM seg QUALIFY row_number() OVER (PARTITION BY conversationId ORDER BY wrapUpCodeId IS NOT NULL DESC, segmentEnd DESC, participantId DESC) = 1),
  vc AS (SELECT conversationId FROM oc WHERE mediaTypeId IN (1, 5) AND conversationId IN (SELECT conversationId FROM sp))"""


@query(
    "d17_timeline",
    with_(MART)
    + SPOKEN
    + """, al AS (SELECT conversationId, 'Queue' AS participant, queueName AS action, min(segmentStart) AS s, max(segmentEnd) AS e, NULL AS userId, CAST(NULL AS DOUBLE) AS sentiment
          FROM seg JOIN prt USING (conversationId, participantId) JOIN que USING (queueId) WHERE purpose = 'acd' AND conversationId IN (SELECT conversationId FROM vc) GROUP BY conversationId, participantId, queueId, queueName
        UNION ALL SELECT conversationId, CASE WHEN name = 'tHeld' THEN 'Hold' ELSE 'Transfer' END, CASE name WHEN 'tHeld' THEN 'Hold' WHEN 'nBlindTransferred' THEN 'Blind Transferred' ELSE 'Consult Transferred' END,
          CASE WHEN name = 'tHeld' THEN eventTime - to_seconds(value // 1000) ELSE eventTime END, eventTime, userId, NULL FROM met JOIN prt USING (conversationId, participantId)
          WHERE name IN ('tHeld', 'nBlindTransferred', 'nConsultTransferred') AND purpose = 'agent' AND conversationId IN (SELECT conversationId FROM vc) AND conversationId IN (SELECT conversationId FROM lh JOIN que USING (queueId))
        UNION ALL SELECT sp.conversationId, sp.participant, text, s, e, userId, sentiment FROM sp JOIN seg ON seg.conversationId = sp.conversationId AND s BETWEEN segmentStart AND segmentEnd AND segmentType = 'interact'
          JOIN prt ON prt.conversationId = seg.conversationId AND prt.participantId = seg.participantId AND purpose = 'agent' JOIN que USING (queueId))
       SELECT conversationId, participant, action, s::VARCHAR AS startTime, e::VARCHAR AS endTime, userId, sentiment,
         row_number() OVER (PARTITION BY conversationId ORDER BY s NULLS FIRST, e NULLS FIRST, participant NULLS FIRST, action NULLS FIRST, userId NULLS FIRST) AS line FROM al""",
)
def timeline(t):
    segments = star.segments(t.line_sessions())
    last = cv.last_handled(segments.withColumnRenamed("participantId", "sessionId").withColumnRenamed("wrapUpCodeId", "wrapUpCode"))
    return pr.timeline(
        star.conversations(t.orders), star.participants(t.line_sessions()), segments, star.metrics(t.line_sessions()), spoken(t), last.select("conversationId", "queueId"), star.queues(t.part)
    )


def map_inputs(t):
    agents = star.agents(t.supplier, t.nation, t.region)
    return pr.MapInputs(
        conversations=t.star("conversations").filter("originatingDirectionId = 1 and initialSessionMediaTypeId = 1"),
        **{name: t.star(name) for name in ("participants", "segments", "metrics", "ivr_events", "menus", "flows", "actions", "insights", "contact_reasons")},
        users=agents.select("userId", "userName"),
        teams=agents.select("userId", "teamName"),
        queues=star.queues(t.part).select("queueId", "queueName"),
        wrap_up_codes=star.wrap_up_codes(t.part).select("wrapUpCodeId", "wrapUpCode"),
    )


MAP = """, c AS (SELECT * FROM oc WHERE originatingDirectionId = 1 AND mediaTypeId = 1),
  e0 AS (SELECT conversationId, conversationStart AS s, conversationStart + INTERVAL 1 MILLISECOND AS e, 'Start' AS n, 0 AS l, 'caller' AS k FROM c
    UNION SELECT c.conversationId, conversationStart + INTERVAL 2 MILLISECOND, conversationStart + INTERVAL 2 MILLISECOND, 'AuthenticationStatus: ' || o_orderstatus, 2, 'authStatus' FROM c JOIN orders USING (o_orderkey) WHERE c.o_orderkey % 2 = 0
    UNION SELECT conversationId, conversationStart + INTERVAL 10 SECOND, conversationStart + INTERVAL 20 SECOND, 'main', 3, 'menu' FROM c WHERE o_custkey % 3 = 0
    UNION SELECT conversationId, conversationStart + INTERVAL 20 SECOND, NULL, 'billing', 4, 'menu' FROM c WHERE o_custkey % 3 = 0
    UNION SELECT conversationId, min(segmentStart), max(segmentEnd), 'Queue', 100, 'queue' FROM seg JOIN que USING (queueId) JOIN c USING (conversationId) GROUP BY conversationId, queueName
    UNION SELECT conversationId, min(segmentStart), max(segmentEnd), 'Agent', 200, 'agent' FROM seg JOIN prt USING (conversationId, participantId) JOIN c USING (conversationId) WHERE userId IS NOT NULL GROUP BY conversationId, userId
    UNION SELECT conversationId, eventTime, eventTime, CASE name WHEN 'nBlindTransferred' THEN 'Blind Transferred' WHEN 'nConsultTransferred' THEN 'Consult Transferred' WHEN 'nConsult' THEN 'Consult' ELSE 'Hold' END,
      CASE name WHEN 'nBlindTransferred' THEN 250 WHEN 'nConsultTransferred' THEN 300 WHEN 'nConsult' THEN 350 ELSE 400 END, name FROM met JOIN c USING (conversationId) WHERE name IN ('nBlindTransferred', 'nConsultTransferred', 'nConsult', 'tHeld')),
  e1 AS (SELECT conversationId, s, coalesce(e, lead(s) OVER (PARTITION BY conversationId ORDER BY s NULLS FIRST, l, n, e NULLS FIRST), s) AS e, n, l, k FROM e0),
  acd AS (SELECT conversationId FROM oc WHERE o_custkey % 4 = 2),
  rw AS (SELECT e1.conversationId, CASE WHEN k = 'menu' THEN 'Menu: ' || n ELSE n END AS category, '' AS action, s, e,
      CASE WHEN e1.conversationId IN (SELECT conversationId FROM acd) THEN contactReason ELSE 'Ended in IVR' END AS contact_reason,
      CASE WHEN e1.conversationId IN (SELECT conversationId FROM acd) THEN mainInquiry ELSE 'Ended in IVR' END AS main_inquiry,
      CASE WHEN e1.conversationId IN (SELECT conversationId FROM acd) THEN rootCause ELSE 'Ended in IVR' END AS root_cause, '' AS speaker FROM e1 LEFT JOIN rea USING (conversationId)
    UNION SELECT conversationId, 'Talk', 'ask', conversationStart, CASE WHEN o_orderkey % 2 = 0 THEN conversationStart + INTERVAL 60 SECOND END, 'r', 'm', 'c', 'agent' FROM c WHERE o_orderkey % 7 = 1),
  ppl AS (SELECT DISTINCT conversationId, userId FROM prt WHERE userId IS NOT NULL AND conversationId IN (SELECT conversationId FROM seg JOIN que USING (queueId))),
  lq AS (SELECT conversationId, queueId FROM seg QUALIFY row_number() OVER (PARTITION BY conversationId ORDER BY segmentEnd DESC, participantId DESC) = 1),
  lc AS (SELECT conversationId, wrapUpCodeId FROM seg WHERE segmentType = 'wrapup' QUALIFY row_number() OVER (PARTITION BY conversationId ORDER BY segmentEnd DESC, participantId DESC) = 1)"""


PROCESS_MAP = (
    with_(MART)
    + MAP
    + """ SELECT DISTINCT rw.conversationId, category, action, s::VARCHAR AS eventStart, e::VARCHAR AS eventEnd, contact_reason, main_inquiry, root_cause, speaker, c.location, c.originatingDirectionId, c.mediaTypeId, c.conversationStartDateId,
         coalesce(hashold, FALSE) AS hashold, coalesce(hasconsult, FALSE) AS hasconsult, coalesce(hasconsulttransfer, FALSE) AS hasconsulttransfer, coalesce(hasblindtransfer, FALSE) AS hasblindtransfer,
         CASE WHEN c.o_orderkey % 2 = 0 THEN o_orderstatus END AS AuthenticationStatus, coalesce(CASE WHEN c.o_custkey % 4 = 1 THEN 'resolved' END, ins.resolved) AS resolved, userNames, teamNames, que.queueName AS finalQueueName, cod.wrapUpCode AS finalWrapupCode
       FROM rw JOIN c USING (conversationId) JOIN orders ON orders.o_orderkey = c.o_orderkey
       LEFT JOIN (SELECT conversationId, bool_or(name = 'tHeld') AS hashold, bool_or(name = 'nConsult') AS hasconsult, bool_or(name = 'nConsultTransferred') AS hasconsulttransfer, bool_or(name = 'nBlindTransferred') AS hasblindtransfer FROM met GROUP BY 1) f ON f.conversationId = c.conversationId
       LEFT JOIN ins ON ins.conversationId = c.conversationId
       LEFT JOIN (SELECT conversationId, string_agg(DISTINCT userName, ',' ORDER BY userName) AS userNames, string_agg(DISTINCT teamName, ',' ORDER BY teamName) AS teamNames FROM ppl JOIN agt USING (userId) GROUP BY 1) n ON n.conversationId = c.conversationId
       LEFT JOIN lq ON lq.conversationId = c.conversationId LEFT JOIN que ON que.queueId = lq.queueId LEFT JOIN lc ON lc.conversationId = c.conversationId LEFT JOIN cod ON cod.wrapUpCodeId = lc.wrapUpCodeId
       WHERE e IS NOT NULL"""
)


@query("d18_process_map", PROCESS_MAP)
def process_map(t):
    return pr.process_map(map_inputs(t))


IVR_MAP = MAP + """, v0 AS (SELECT conversationId, conversationStart AS s, conversationStart + INTERVAL 1 MILLISECOND AS e, 'Start' AS n, 1 AS l FROM c
    UNION SELECT c.conversationId, conversationStart + INTERVAL 2 MILLISECOND, conversationStart + INTERVAL 2 MILLISECOND, 'AuthenticationStatus: ' || o_orderstatus, 2 FROM c JOIN orders USING (o_orderkey) WHERE c.o_orderkey % 2 = 0
    UNION SELECT conversationId, conversationStart + INTERVAL 40 SECOND - to_milliseconds(o_custkey % 30 * 1000 + 250), conversationStart + INTERVAL 40 SECOND, 'Flow: Flow ' || (o_orderkey % 3), 3 FROM c WHERE o_custkey % 4 <> 0
    UNION SELECT conversationId, conversationStart + INTERVAL 10 SECOND, conversationStart + INTERVAL 20 SECOND, 'Menu: main', 3 FROM c WHERE o_custkey % 3 = 0
    UNION SELECT conversationId, conversationStart + INTERVAL 20 SECOND, NULL, 'Menu: billing', 4 FROM c WHERE o_custkey % 3 = 0
    UNION SELECT conversationId, min(segmentStart), max(segmentEnd), 'Queue: ' || queueName, 100 FROM seg JOIN que USING (queueId) JOIN c USING (conversationId) GROUP BY conversationId, queueName
    UNION SELECT conversationId, s, e, 'Agent ' || row_number() OVER (PARTITION BY conversationId ORDER BY s, userId), 200 FROM (
      SELECT conversationId, userId, min(segmentStart) AS s, max(segmentEnd) AS e FROM seg JOIN prt USING (conversationId, participantId) JOIN c USING (conversationId) WHERE userId IS NOT NULL GROUP BY conversationId, userId)),
  v1 AS (SELECT conversationId, s, coalesce(e, lead(s) OVER (PARTITION BY conversationId ORDER BY s NULLS FIRST, l, n, e NULLS FIRST), s) AS e, n FROM v0)"""


@query(
    "d18_ivr_export",
    with_(MART)
    + IVR_MAP
    + """ SELECT DISTINCT v1.conversationId, n AS category, s::VARCHAR AS eventStart, e::VARCHAR AS eventEnd, location, originatingDirectionId, mediaTypeId, CASE WHEN c.o_orderkey % 2 = 0 THEN o_orderstatus END AS AuthenticationStatus,
         c.o_custkey % 4 = 1 AS isIVRSuccess, c.o_custkey % 4 = 3 AND c.o_orderkey % 2 = 0 AS isIVRAbandon, c.o_custkey % 4 = 3 AND c.o_orderkey % 2 = 1 AS isIVRError, c.o_custkey % 4 = 2 AS hasIVRToQueueTransfer, userNames, teamNames
       FROM v1 JOIN c USING (conversationId) JOIN orders ON orders.o_orderkey = c.o_orderkey
       LEFT JOIN (SELECT conversationId, string_agg(DISTINCT userName, ',' ORDER BY userName) AS userNames, string_agg(DISTINCT teamName, ',' ORDER BY teamName) AS teamNames FROM ppl JOIN agt USING (userId) GROUP BY 1) u ON u.conversationId = c.conversationId
       WHERE e IS NOT NULL AND trim(n) NOT IN ('Start', 'Menu: main')""",
)
def ivr_export(t):
    listed = t.region.select(F.explode(F.array(F.lit("Start "), F.lit(" Menu: main"))).alias("phrase"))
    i = replace(map_inputs(t), flow_metrics=t.star("flow_metrics"))
    return without_listed(pr.ivr_map(i), "category", listed, "phrase")


#: First day of the reports on recent conversations.
SINCE = 20010601


@query("d18_recent_process_map", PROCESS_MAP.replace("FROM oc WHERE", f"FROM oc WHERE conversationStartDateId >= {SINCE} AND", 1))
def recent_process_map(t):
    i = map_inputs(t)
    return pr.process_map(replace(i, conversations=pr.started_since(i.conversations, SINCE)))


@query(
    "d19_labelled_steps",
    with_(ANCHORS.format(join=""))
    + """, lab AS (SELECT DISTINCT 'greet' AS phrase, 'Label ' || (quality + toxic) AS label FROM labels UNION SELECT DISTINCT 'turned', '' FROM labels)
       SELECT conversationId, h.stepName AS summary, label AS stepName, startTime, endTime FROM h JOIN lab ON phrase = h.stepName WHERE label <> ''""",
)
def labelled_steps(t):
    steps = tr.anchored_times(map_steps(t), phrase_lines(t), ["stepName", "startLine", "endLine"]).withColumnRenamed("stepName", "summary")
    known = t.labels.select(
        F.lit("conversation_map").alias("type"),
        F.explode(
            F.array(
                F.struct(F.lit("greet").alias("phrase"), F.concat(F.lit("Label "), F.col("quality") + F.col("toxic")).alias("label")),
                F.struct(F.lit("turned").alias("phrase"), F.lit("").alias("label")),
            )
        ).alias("x"),
    ).select("type", "x.*")
    return pr.labelled_steps(steps, known, "conversation_map", "summary").select("conversationId", "summary", "stepName", "startTime", "endTime")


@query(
    "d19_curated_steps",
    with_(MART)
    + MAP
    + """ SELECT DISTINCT conversationId, category, s::VARCHAR AS eventStart, e::VARCHAR AS eventEnd FROM rw JOIN c USING (conversationId) WHERE e IS NOT NULL AND trim(category) NOT IN ('Start', 'Hold', 'Menu: main')""",
)
def curated_steps(t):
    listed = t.region.select(F.explode(F.array(F.lit("Start "), F.lit("Hold"), F.lit(" Menu: main"))).alias("phrase"))
    rows = pr.process_map(map_inputs(t))
    return without_listed(rows, "category", listed, "phrase").select("conversationId", "category", "eventStart", "eventEnd").distinct()


# fixed values: steps that an agent is expected to take
EXPECTED = [("Greet", 1, 1.0), ("Verify", 2, 2.5), ("Close and Offer Additional Assistance", 3, 0.5), ("Recap", 4, 1.5)]
NAMES = {"view": "Greet", "click": "Hold", "signup": "Verify", "purchase": "Close and Offer Additional Assistance"}


def process_steps(t):
    """Steps of a user's day: event types as step names, errors split by k."""
    e = raw.event_rows(t.events)
    names = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])
    other = F.when(F.col("k") % 3 == 0, "Transfer").otherwise(F.concat(F.lit("Detour "), F.col("k") % 3))
    return e.select(
        F.concat_ws("|", "userId", F.date_format("ts", "yyyyMMdd")).alias("conversationId"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("conversationStartDateId"),
        F.col("ts").alias("startTime"),
        raw.plus_seconds(F.col("ts"), F.col("k")).alias("endTime"),
        F.coalesce(F.try_element_at(names, F.col("eventType")), other).alias("stepName"),
        (F.col("k") % 5).cast("double").alias("sentiment"),
    )


def step_config(t):
    rows = F.array(*[F.struct(F.lit(a).alias("stepName"), F.lit(b).alias("counterStep"), F.lit(c).alias("value")) for a, b, c in EXPECTED])
    return t.region.select(F.explode(rows).alias("x")).select("x.*").distinct()


COMPLEXITY = (
    with_(EVENTS)
    + """, cfg(steps, counter_step, value) AS (VALUES ('Greet', 1, 1.0::DOUBLE), ('Verify', 2, 2.5::DOUBLE), ('Close and Offer Additional Assistance', 3, 0.5::DOUBLE), ('Recap', 4, 1.5::DOUBLE)),
      p AS (SELECT userId || '|' || strftime(ts, '%Y%m%d') AS cid, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS did, ts AS s, k, CASE eventType WHEN 'view' THEN 'Greet' WHEN 'click' THEN 'Hold' WHEN 'signup' THEN 'Verify'
          WHEN 'purchase' THEN 'Close and Offer Additional Assistance' ELSE CASE WHEN k % 3 = 0 THEN 'Transfer' ELSE 'Detour ' || (k % 3) END END AS nm, (k % 5)::DOUBLE AS sen FROM ev),
      q AS (SELECT *, nm IN (SELECT steps FROM cfg) AS x, sum(CASE WHEN nm IN (SELECT steps FROM cfg) THEN 1 ELSE 0 END) OVER (PARTITION BY cid ORDER BY s, nm, k, sen ROWS UNBOUNDED PRECEDING) AS g,
          lead(nm IN (SELECT steps FROM cfg)) OVER (PARTITION BY cid ORDER BY s, nm, k, sen) AS nx FROM p),
      o AS (SELECT cid, g, count(*) FILTER (WHERE nm = 'Hold') AS hold, count(*) FILTER (WHERE nm = 'Transfer') AS transfer, count(*) FILTER (WHERE nm NOT IN ('Hold', 'Transfer')) AS violation,
          count(DISTINCT CASE WHEN nm NOT IN ('Hold', 'Transfer') THEN nm END) AS dvc FROM q WHERE NOT x AND g > 0 GROUP BY 1, 2),
      cl AS (SELECT cid, min(s) AS cls FROM q WHERE nm LIKE 'Close%' GROUP BY 1),
      l AS (SELECT q.cid, max(g) AS mg, arg_max(nm, g) AS lst, arg_max(CASE WHEN s < cls THEN nm END, CASE WHEN s < cls THEN g END) AS bfc FROM q LEFT JOIN cl ON cl.cid = q.cid WHERE x GROUP BY 1),
      a AS (SELECT q.cid, nm, sum(CASE WHEN q.g < mg THEN coalesce(hold, 0) ELSE 0 END)::INTEGER AS hold, sum(CASE WHEN q.g < mg THEN coalesce(transfer, 0) ELSE 0 END)::INTEGER AS transfer, sum(CASE WHEN q.g < mg THEN coalesce(violation, 0) ELSE 0 END)::INTEGER AS violation,
          sum(CASE WHEN q.g < mg THEN coalesce(dvc, 0) ELSE 0 END)::INTEGER AS dvc, (count(*) * (count(*) + 1) / 2)::INTEGER AS sc, avg(CASE WHEN nx THEN 1 ELSE 0 END) AS nse, sum(k)::DOUBLE AS dur, arg_min(sen, q.g) AS sen,
          bool_or(nm = lst) AS il, bool_or(coalesce(nm = bfc, FALSE)) AS ib FROM q JOIN l ON l.cid = q.cid LEFT JOIN o ON o.cid = q.cid AND o.g = q.g WHERE x GROUP BY 1, 2),
      al AS (SELECT DISTINCT cid, did, steps, counter_step, value FROM p, cfg)
      SELECT al.cid AS conversationId, al.steps, coalesce(sc, 0) AS step_count, CASE WHEN sc IS NULL THEN 0 ELSE 1 END AS step_done, coalesce(hold, 0) AS hold, coalesce(transfer, 0) AS transfer, coalesce(violation, 0) AS violation,
        coalesce(dvc, 0) AS distinct_violation_count, coalesce(nse, 0) AS next_step_expected, coalesce(dur, 0) AS duration, max(coalesce(sen, 0)) OVER (PARTITION BY al.cid ORDER BY al.steps ROWS UNBOUNDED PRECEDING) AS sentiment,
        counter_step, value, did AS conversationStartDateId, coalesce(il, FALSE) AS is_last_step, coalesce(ib, FALSE) AS is_last_before_close FROM al LEFT JOIN a ON a.cid = al.cid AND a.nm = al.steps"""
)


EXTRACT_DATE = 20240103


@query(
    "d27_complexity",
    loaded_sql(COMPLEXITY, "conversationStartDateId", "19990101", "conversationId", "'old-' || conversationId", {"step_count": "-1"}, "steps = 'Greet'"),
)
def complexity(t):
    fresh = pr.complexity(process_steps(t), step_config(t))
    keys = ["conversationId", "steps", "conversationStartDateId"]
    return loaded(
        fresh, "conversationStartDateId", 19990101, lambda old, new: up.replace_matching(old, new, keys), "conversationId", F.concat(F.lit("old-"), "conversationId"), {"step_count": -1}, "steps = 'Greet'"
    )


@query("d27_extract_date_complexity", f"SELECT * FROM ({COMPLEXITY}) WHERE conversationStartDateId = {EXTRACT_DATE}")
def extract_date_complexity(t):
    """Effort of the conversations of one day, whose steps alone are read."""
    return pr.complexity(process_steps(t), step_config(t), extract_date=EXTRACT_DATE)


@query(
    "d19_raw_actions",
    with_(MART)
    + """SELECT oc.conversationId, 'Talk' AS category, 'ask' AS action, conversationStart::VARCHAR AS startTime, CASE WHEN o_orderkey % 2 = 0 THEN (conversationStart + INTERVAL 60 SECOND)::VARCHAR END AS endTime, originatingDirectionId, mediaTypeId, location
         FROM oc WHERE o_orderkey % 7 = 1""",
)
def raw_actions(t):
    return pr.action_extract(t.star("actions"), star.conversations(t.orders)).select(
        "conversationId", "category", "action", "startTime", "endTime", "originatingDirectionId", "mediaTypeId", "location"
    )


@query(
    "d19_value_stream",
    with_(MART, ANCHORS.format(join=""))
    + """SELECT oc.conversationId, h.stepName, startTime, endTime, location, oc.mediaTypeId FROM h JOIN oc ON oc.conversationId = CAST(h.conversationId AS VARCHAR) WHERE startTime IS NOT NULL""",
)
def value_stream_extract(t):
    steps = tr.anchored_times(map_steps(t), phrase_lines(t), ["stepName", "startLine", "endLine"], keep_unanchored=True)
    steps = steps.withColumn("conversationId", F.col("conversationId").cast("string")).filter("startTime is not null")
    return pr.action_extract(steps, star.conversations(t.orders)).select("conversationId", "stepName", "startTime", "endTime", "location", "mediaTypeId")


@query(
    "ud5_grouped_map_complexity",
    "SELECT conversationId, steps, step_count, hold, transfer, violation FROM (" + COMPLEXITY + ")",
)
def grouped_map_complexity(t):
    return pr.complexity_by_group(process_steps(t), step_config(t))
