"""Contact-centre inputs derived from the driver tables.

Every builder works row by row: a raw record is made from one driver row, with small nested arrays
of a fixed maximum length, so no shuffle and no unbounded array is needed at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: queue zone and region zone used by the local-time reports
REGION_ZONES = {
    "AFRICA": "Africa/Johannesburg",
    "AMERICA": "America/New_York",
    "ASIA": "Asia/Kolkata",
    "EUROPE": "Europe/Berlin",
    "MIDDLE EAST": "Asia/Dubai",
}


def day_number(ts: Column) -> Column:
    """yyyyMMdd as an integer; arithmetic, which is much cheaper than formatting."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("int"), ts)


#: What a session takes of a line.
LINE_COLUMNS = (
    "l_orderkey l_linenumber l_partkey l_suppkey l_shipdate l_quantity l_returnflag l_linestatus l_discount l_tax l_extendedprice"
).split()


#: What the star tables take of a line.
STAR_LINE_COLUMNS = [c for c in LINE_COLUMNS if c not in ("l_extendedprice", "l_linestatus")]


def line_sessions(lineitem: DataFrame) -> DataFrame:
    """Flat view of a line as an agent session; the order is the conversation. Lines may come without their price and status, whose
    columns are left out then, and with a start month, which goes along."""
    secs = (F.col("l_partkey") * 37 + F.col("l_linenumber") * 613) % 86400
    start = plus_seconds(F.col("l_shipdate"), secs)
    qty = F.col("l_quantity").cast("int")
    known = lineitem.columns
    direction = F.when(F.col("l_linestatus") == "O", "outbound").otherwise("inbound").alias("originatingDirection")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents")
    return lineitem.select(
        F.col("l_orderkey").cast("string").alias("conversationId"),
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day_number(F.col("l_shipdate"))
        ).alias("sessionId"),
        F.concat(F.lit("agent-"), F.col("l_suppkey")).alias("agentId"),
        F.concat(F.lit("queue-"), F.col("l_partkey") % 25).alias("queueId"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("code-"), F.col("l_partkey") % 10)).alias("wrapUpCode"),
        F.when(F.col("l_returnflag") == "A", "voice")
        .when(F.col("l_returnflag") == "R", "chat")
        .otherwise("email")
        .alias("mediaType"),
        *([direction] if "l_linestatus" in known else []),
        start.alias("segmentStart"),
        plus_seconds(start, qty * 10 + 30).alias("segmentEnd"),
        qty.alias("quantity"),
        F.round(F.col("l_discount") * 100).cast("long").alias("discountPct"),
        F.round(F.col("l_tax") * 100).cast("long").alias("taxPct"),
        *([cents] if "l_extendedprice" in known else []),
        F.col("l_linenumber").alias("lineNumber"),
        F.col("l_returnflag").alias("returnFlag"),
        *[c for c in ("startMonth",) if c in known],
    )


def _metric(name: str, value: Column, at: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.cast("long").alias("value"), at.alias("emitDate"))


def _segment(start: Column, end: Column, queue: Column, kind: str, code: Column, note: Column) -> Column:
    return F.struct(
        start.alias("segmentStart"),
        end.alias("segmentEnd"),
        queue.alias("queueId"),
        F.lit(kind).alias("segmentType"),
        code.alias("wrapUpCode"),
        note.alias("wrapUpNote"),
        F.when(F.col("lineNumber") == 7, "error.transfer").alias("errorCode"),
        F.lit("client").alias("disconnectType"),
    )


FLOW = (
    "struct<flowId:string,flowName:string,flowType:string,entryReason:string,exitReason:string,transferType:string,"
    "outcomes:array<struct<flowOutcomeId:string,flowOutcome:string,flowOutcomeValue:string,"
    "flowOutcomeStartTimestamp:timestamp,flowOutcomeEndTimestamp:timestamp>>>"
)


def conversation_details(sessions: DataFrame) -> DataFrame:
    """Nested conversation payloads: participants -> sessions -> segments, metrics, flow.

    A line gives one conversation with a customer (ivr flow), a queue and an agent participant; lines
    with number 4 or more have no queue participant.
    """
    s = sessions.withColumn("talkEnd", F.col("segmentEnd") - F.expr("interval 30 seconds"))
    none = F.lit(None).cast("string")
    start, qty, queue = F.col("segmentStart"), F.col("quantity"), F.col("queueId")
    talk_end = F.col("talkEnd")
    end = F.col("segmentEnd")

    flow = F.when(
        F.col("lineNumber") % 2 == 1,
        F.struct(
            F.concat(F.lit("flow-"), F.col("quantity") % 5).alias("flowId"),
            F.concat(F.lit("Flow "), F.col("quantity") % 5).alias("flowName"),
            F.lit("INBOUNDCALL").alias("flowType"),
            F.lit("DNIS").alias("entryReason"),
            F.when(F.col("returnFlag") == "R", "TRANSFER").otherwise("DISCONNECT").alias("exitReason"),
            F.lit("ACD").alias("transferType"),
            F.array(
                F.struct(
                    F.concat(F.lit("outcome-"), F.col("taxPct")).alias("flowOutcomeId"),
                    F.lit("menu").alias("flowOutcome"),
                    F.when(F.col("taxPct") > 4, "FAILURE").otherwise("SUCCESS").alias("flowOutcomeValue"),
                    start.alias("flowOutcomeStartTimestamp"),
                    talk_end.alias("flowOutcomeEndTimestamp"),
                )
            ).alias("outcomes"),
        ),
    )

    def session(suffix, segments, metrics, with_flow=False):
        return F.struct(
            F.concat("sessionId", F.lit(suffix)).alias("sessionId"),
            F.col("mediaType"),
            none.alias("messageType"),
            F.col("originatingDirection").alias("direction"),
            F.concat(F.lit("tel:"), F.col("cents")).alias("ani"),
            F.concat(F.lit("tel:"), F.col("lineNumber")).alias("dnis"),
            F.lit("line").alias("remote"),
            segments.alias("segments"),
            metrics.alias("metrics"),
            (flow if with_flow else F.lit(None).cast(FLOW)).alias("flow"),
        )

    def participant(suffix, purpose, user, sessions):
        return F.struct(
            F.concat("sessionId", F.lit(suffix)).alias("participantId"),
            F.lit(f"{purpose} party").alias("participantName"),
            F.lit(purpose).alias("purpose"),
            user.alias("userId"),
            F.create_map(
                F.lit("flag"), F.col("returnFlag"), F.lit("line"), F.col("lineNumber").cast("string")
            ).alias("attributes"),
            sessions.alias("sessions"),
        )

    customer = participant(
        "-c",
        "customer",
        none,
        F.array(
            session(
                "-c",
                F.array(_segment(start, talk_end, none, "ivr", none, none)),
                F.array(_metric("nConnected", F.lit(1), start), _metric("tIvr", F.col("taxPct") * 1000, start)),
                with_flow=True,
            )
        ),
    )
    acd = participant(
        "-q",
        "acd",
        none,
        F.array(
            session(
                "-q",
                F.array(_segment(start, plus_seconds(start, F.col("discountPct")), queue, "interact", none, none)),
                F.array(_metric("nOffered", F.lit(1), start), _metric("tAcd", F.col("discountPct") * 1000, start)),
            )
        ),
    )
    note = F.when(F.col("returnFlag") == "R", F.concat(F.lit("note "), F.col("lineNumber")))
    agent = participant(
        "-a",
        "agent",
        F.col("agentId"),
        F.array(
            session(
                "-a",
                F.array(
                    _segment(start, talk_end, queue, "interact", none, none),
                    _segment(talk_end, end, queue, "wrapup", F.col("wrapUpCode"), note),
                ),
                F.array(
                    _metric("nConnected", F.lit(1), start),
                    _metric("tHandle", qty * 10000 + 30000, start),
                    _metric("tTalkComplete", qty * 10000, start),
                    _metric("tHeldComplete", F.col("discountPct") * 1000, start),
                    _metric("tAcw", F.col("taxPct") * 1000, end),
                    _metric("nTransferred", F.when(F.col("returnFlag") == "R", 1), end),
                ),
            )
        ),
    )
    participants = F.when(F.col("lineNumber") < 4, F.array(customer, acd, agent)).otherwise(
        F.array(customer, agent)
    )
    survey = F.when(
        F.col("taxPct") >= 6,
        F.array(
            F.struct(
                F.concat(F.lit("survey-"), F.col("sessionId")).alias("surveyId"),
                F.col("agentId").alias("userId"),
                queue.alias("queueId"),
                end.cast("string").alias("eventTime"),
                F.when(F.col("taxPct") == 8, "Finished").otherwise("Opted").alias("surveyStatus"),
                (qty % 11).alias("surveyPromoterScore"),
                (qty * 2).alias("oSurveyTotalScore"),
            )
        ),
    )
    return s.select(
        F.col("sessionId").alias("conversationId"),
        F.col("conversationId").alias("orderId"),
        F.col("segmentStart").alias("conversationStart"),
        F.col("segmentEnd").alias("conversationEnd"),
        F.col("originatingDirection"),
        participants.alias("participants"),
        survey.alias("surveys"),
        F.to_date("segmentStart").alias("extractDate"),
    )


def props_map(column: str = "props") -> Column:
    return F.from_json(column, "map<string,bigint>")


def event_rows(events: DataFrame) -> DataFrame:
    """Events with typed names: whole-second time, ``k`` of the payload, value in cents."""
    return events.select(
        F.col("event_id").alias("eventId"),
        F.date_trunc("second", "ts").alias("ts"),
        F.concat(F.lit("u"), F.col("user_id")).alias("userId"),
        F.col("user_id").alias("userNo"),
        F.col("event_type").alias("eventType"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        "props",
    )


def status_intervals(events: DataFrame, scale: int = 60) -> DataFrame:
    """One status interval per event: starts at the event, lasts ``k * scale`` seconds (0 is possible)."""
    e = event_rows(events)
    return e.select(
        "eventId",
        "userId",
        F.col("eventType").alias("status"),
        F.col("ts").alias("startTime"),
        plus_seconds(F.col("ts"), F.col("k") * scale).alias("endTime"),
    )


def user_details(events: DataFrame) -> DataFrame:
    """Nested presence payloads: two presence entries per record, the second open when k mod 10 = 0."""
    e = event_rows(events)
    middle = plus_seconds(F.col("ts"), F.col("k") * 60)
    end = F.when(F.col("k") % 10 != 0, plus_seconds(F.col("ts"), F.col("k") * 90))

    def entry(start, stop, presence):
        return F.struct(
            start.alias("startTime"),
            stop.alias("endTime"),
            presence.alias("systemPresence"),
            F.concat(F.lit("org-"), F.col("k") % 4).alias("organizationPresenceId"),
        )

    def routing(start, stop, status):
        return F.struct(start.alias("startTime"), stop.alias("endTime"), status.alias("routingStatus"))

    return e.select(
        "userId",
        F.array(
            entry(F.col("ts"), middle, F.col("eventType")), entry(middle, end, F.lit("available"))
        ).alias("primaryPresence"),
        F.array(
            routing(F.col("ts"), middle, F.lit("INTERACTING")), routing(middle, end, F.lit("IDLE"))
        ).alias("routingStatus"),
        F.to_date("ts").alias("extractDate"),
    )


def metric_events(events: DataFrame) -> DataFrame:
    """Long metric rows: five events form a conversation."""
    e = event_rows(events)
    return e.select(
        F.floor(F.col("eventId") / 5).cast("long").alias("conversationId"),
        "eventId",
        "userId",
        F.concat(F.lit("queue-"), F.col("userNo") % 20).alias("queueId"),
        F.when(F.col("k") % 3 == 0, "voice").when(F.col("k") % 3 == 1, "chat").otherwise("email").alias("mediaType"),
        F.col("eventType").alias("name"),
        F.col("cents").alias("value"),
        F.col("ts").alias("eventTime"),
        F.col("k"),
    )


def speech_transcripts(conversations: DataFrame) -> DataFrame:
    """Nested speech transcripts: one record per turn, one phrase per line of the turn."""
    base = F.lit(1704067200000) + F.col("conv_id") * 60000 + F.col("turn") * 1000
    lines = F.split("text", "\n")
    purpose = F.when(F.col("role") == "user", "external").when(F.col("role") == "assistant", "internal").otherwise("acd")
    phrases = F.transform(
        lines,
        lambda x, i: F.struct(
            x.alias("text"),
            (base + i * 10).alias("startTimeMs"),
            F.struct((F.length(x) * 5).cast("long").alias("milliseconds")).alias("duration"),
            purpose.alias("participantPurpose"),
            i.alias("phraseIndex"),
        ),
    )
    sentiment = F.transform(
        F.filter(phrases, lambda p: F.length(p["text"]) % 3 == 0),
        lambda p: F.struct(
            p["participantPurpose"].alias("participant"),
            F.concat(F.lit("* "), p["text"], F.lit(" *")).alias("phrase"),
            ((F.length(p["text"]) % 5 - 2).cast("double") / 2).alias("sentiment"),
            p["phraseIndex"].alias("phraseIndex"),
            p["startTimeMs"].alias("startTimeMs"),
        ),
    )
    topics = F.transform(
        F.filter(phrases, lambda p: F.length(p["text"]) % 4 == 0),
        lambda p: F.struct(
            p["participantPurpose"].alias("participant"),
            F.concat(F.lit("topic-"), F.length(p["text"]) % 7).alias("topicId"),
            p["text"].alias("transcriptPhrase"),
            (F.length(p["text"]) % 100).alias("confidence"),
        ),
    )
    return conversations.select(
        F.col("conv_id").cast("string").alias("conversationId"),
        F.concat_ws("-", "conv_id", "turn").alias("communicationId"),
        F.when(F.col("turn") % 2 == 0, "call").otherwise("message").alias("mediaType"),
        base.alias("conversationStartTime"),
        F.array(
            F.struct(
                F.concat(F.lit("t-"), F.col("conv_id"), F.lit("-"), F.col("turn")).alias("transcriptId"),
                base.alias("startTime"),
                phrases.alias("phrases"),
                F.struct(sentiment.alias("sentiment"), topics.alias("topics")).alias("analytics"),
            )
        ).alias("transcripts"),
    )


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """Flat transcript: line = turn + 1, one second per line."""
    return conversations.select(
        F.col("conv_id").alias("conversationId"),
        (F.col("turn") + 1).alias("line"),
        F.col("role").alias("participant"),
        F.col("text").alias("phrase"),
        plus_seconds(F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 60), F.col("turn")).alias("startTime"),
        plus_seconds(F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 60), F.col("turn") + 1).alias("endTime"),
    )


def zone_of(region: Column) -> Column:
    """Zone of a region name; unknown regions have none."""
    zones = F.create_map(*[F.lit(x) for pair in REGION_ZONES.items() for x in pair])
    return F.element_at(zones, region)


def users(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Users with group (nation), region and zone. The manager is the first user of the ten-block."""
    n = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return customer.join(n, customer.c_nationkey == n.n_nationkey).select(
        F.concat(F.lit("u"), F.col("c_custkey")).alias("userId"),
        F.col("c_custkey").alias("userNo"),
        F.col("c_name").alias("userName"),
        F.col("c_mktsegment").alias("department"),
        F.col("n_name").alias("groupName"),
        F.col("r_name").alias("region"),
        zone_of(F.col("r_name")).alias("timeZone"),
        F.concat(F.lit("u"), F.floor(F.col("c_custkey") / 10) * 10).alias("managerId"),
        F.when(F.col("c_acctbal") < 0, "inactive").otherwise("active").alias("state"),
        F.round(F.col("c_acctbal") * 100).cast("long").alias("balanceCents"),
    )


def evaluation_payloads(sessions: DataFrame) -> DataFrame:
    """Nested evaluations: one per session, two question groups with one and two questions."""
    s = sessions
    kill = F.col("returnFlag") == "R"

    def question(no, score):
        return F.struct(
            F.lit(f"q{no}").alias("questionId"),
            F.concat(F.lit(f"q{no}-a"), score.cast("string")).alias("answerId"),
            score.cast("long").alias("score"),
            F.lit(False).alias("markedNA"),
            (kill & (score < 3)).alias("failedKillQuestion"),
            F.when(score == 0, "see note").alias("comments"),
        )

    def group(no, total, *questions):
        return F.struct(
            F.lit(f"g{no}").alias("questionGroupId"),
            F.lit(False).alias("markedNA"),
            total.cast("double").alias("totalScore"),
            F.lit(50.0).alias("maxTotalScore"),
            F.array(*questions).alias("questionScores"),
        )

    return s.select(
        F.concat(F.lit("ev-"), F.col("sessionId")).alias("id"),
        F.when(F.col("lineNumber") == 1, "INPROGRESS").otherwise("FINISHED").alias("status"),
        F.struct(F.col("agentId").alias("id")).alias("agent"),
        F.struct(F.concat(F.lit("agent-"), F.col("taxPct")).alias("id")).alias("evaluator"),
        F.struct(F.col("conversationId").alias("id")).alias("conversation"),
        F.struct(F.concat(F.lit("form-"), F.col("discountPct")).alias("id"), F.lit(True).alias("published")).alias("evaluationForm"),
        F.date_format("segmentEnd", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("releaseDate"),
        F.array("mediaType").alias("mediaType"),
        F.struct(
            kill.alias("anyFailedKillQuestions"),
            (F.col("quantity") * 2).cast("double").alias("totalScore"),
            F.col("quantity").cast("double").alias("totalCriticalScore"),
            F.array(
                group(1, F.col("quantity"), question(1, F.col("quantity") % 6)),
                group(2, F.col("quantity") + 1, question(2, F.col("taxPct")), question(3, F.col("discountPct"))),
            ).alias("questionGroupScores"),
        ).alias("answers"),
        F.to_date("segmentStart").alias("extractDate"),
    )


def form_payloads(part: DataFrame) -> DataFrame:
    """Nested evaluation forms: one per part, group = brand, question = type, three answer options."""
    options = F.transform(
        F.sequence(F.lit(0), F.lit(2)),
        lambda i: F.struct(
            F.concat("p_type", F.lit("-"), i.cast("string")).alias("id"),
            F.when(i == 0, "No").when(i == 1, "Partly").otherwise("Yes").alias("text"),
            (i * F.col("p_size")).cast("long").alias("value"),
        ),
    )
    question = F.struct(
        F.col("p_type").alias("id"),
        F.concat(F.lit("Question about "), F.col("p_name")).alias("text"),
        (F.col("p_size") > 25).alias("isCritical"),
        options.alias("answerOptions"),
    )
    group = F.struct(
        F.col("p_brand").alias("id"),
        F.concat(F.lit("Group "), F.col("p_brand")).alias("name"),
        F.col("p_size").cast("double").alias("weight"),
        F.array(question).alias("questions"),
    )
    return part.select(
        F.concat(F.lit("form-"), F.col("p_partkey") % 11).alias("id"),
        F.concat(F.lit("Form "), F.col("p_partkey") % 11).alias("name"),
        (F.col("p_partkey") % 2 == 0).alias("published"),
        F.array(group).alias("questionGroups"),
    )


def journey_texts(events: DataFrame) -> DataFrame:
    """Coaching documents as JSON text. Times are text, numbers or objects, ids plain or objects, scores numbers or text, feedback one
    object, a list or absent, and actions are absent in some documents."""
    e = event_rows(events)
    k, number = F.col("k"), F.col("eventId")

    def text(*parts):
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    def time(seconds):
        at = plus_seconds(F.col("ts"), F.lit(seconds))
        millis = F.unix_millis(at).cast("string")
        plain = text('"', F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), '"')
        return F.when(k % 3 == 0, plain).when(k % 3 == 1, millis).otherwise(text('{"$date":', millis, "}"))

    def ident(value):
        return F.when(k % 2 == 0, text('{"oid":"', value, '"}')).otherwise(text('"', value, '"'))

    kinds = ["lms", "article", "recorded_call", "one_on_one"]
    actions, scores = [], []
    for i, kind in enumerate(kinds):
        end = F.when(k % 2 == 0, text(',"end":', time(100 * i + 50))).otherwise("")
        block = text(f'"{kind}":{{"start":', time(100 * i), end, ',"link":"http://host/', number, f'/{kind}","state":"', F.when(k > 50, "done").otherwise("open"), '"},')
        actions.append(F.when((number + i) % 4 == 0, "").otherwise(block))
        scores.append(text(f'"{kind}":', F.when(k % 2 == 0, (k + i).cast("string")).otherwise(text('"', k + i, '"')), "," if i < 3 else ""))

    def entry(i):
        return text('{"question":"sq', i.cast("string"), '","value":', F.when(i == 1, k.cast("string")).otherwise(text('"v', k, '"')), ',"score":', i.cast("string"), ',"type":"radio"}')

    survey = F.when(k % 3 == 0, "").otherwise(text(',"survey":[', F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(k % 3, F.lit(1))), entry), ","), "]"))
    said = text('{"question":"how","answer":"fb ', k, '","value":', F.when(k > 50, k.cast("string")).otherwise(text('"', k, '"')), "}")
    feedback = F.when(k % 4 == 1, text(',"nfeedback":', said)).when(k % 4 == 3, text(',"nfeedback":[', said, "]")).otherwise("")
    document = text(
        '{"_id":', ident(number), ',"team_id":', ident(text("team-", F.floor(F.col("userNo") / 10))), ',"agent_id":', ident(F.col("userId")), ',"team_leader_id":', ident(text("lead-", k % 7)),
        ',"kpi_id":', ident(text("kpi-", k % 5)), ',"campaign_id":', ident(text("camp-", k % 3)), ',"kpi_name":"KPI ', k % 5, '","trek_global_state":"', F.col("eventType"), '","trek_date":', time(0),
        ',"discovery":{"start":', time(5), ',"end":', time(15), survey, '},"action":{', *actions, '"state":"', F.when(k % 2 == 0, "active").otherwise("closed"), '","goal":{"goal_target":', k, "}}",
        ',"score":{', *scores, '},"action_complete":', F.when(k > 50, "true").otherwise("false"), ',"feedback_given":', k % 2, feedback, ',"updatedAt":', time(20), ',"organization_id":"ORG', F.col("userNo") % 3, '"}',
    )
    return e.select(F.when(k % 40 == 39, F.substring(document, 1, 40)).otherwise(document).alias("document"))
