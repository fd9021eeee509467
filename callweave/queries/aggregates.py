"""Aggregations, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.functions import times as tm
from callweave.operators import aggregates as ag
from callweave.operators import joins as jn
from callweave.operators import kpi, ordered
from callweave.queries.prelude import EVENTS, INTERVALS, LINES, TURNS, USERS, with_
from callweave.queries.registry import query
from callweave.sources import raw, writers


def wide_facts(t):
    """Wide metric rows at session grain."""
    s = t.line_sessions()
    return s.select(
        "conversationId",
        "sessionId",
        "agentId",
        "mediaType",
        "queueId",
        "wrapUpCode",
        tm.quarter_hour(F.col("segmentStart")).alias("emitDateTime"),
        F.col("quantity").cast("long").alias("tHandle"),
        F.col("discountPct").alias("tHeld"),
        F.col("taxPct").alias("tAcw"),
        F.col("cents").alias("tTalk"),
    )


@query(
    "a1_wide_rollup",
    with_(LINES)
    + """SELECT agentId, mediaType, queueId, wrapUpCode, time_bucket(INTERVAL 15 MINUTE, segmentStart)::VARCHAR AS emitDateTime,
          sum(quantity)::BIGINT AS tHandle, sum(discountPct)::BIGINT AS tHeld, sum(taxPct)::BIGINT AS tAcw, sum(cents)::BIGINT AS tTalk
        FROM lines GROUP BY agentId, mediaType, queueId, wrapUpCode, time_bucket(INTERVAL 15 MINUTE, segmentStart)""",
)
def wide_rollup(t):
    keys = ["agentId", "mediaType", "queueId", "wrapUpCode", "emitDateTime"]
    return ag.rollup_sums(wide_facts(t), keys, {c: c for c in ("tHandle", "tHeld", "tAcw", "tTalk")})


@query(
    "a2_conversation_rollup",
    with_(LINES)
    + """SELECT conversationId, o_orderpriority AS attribute, mediaType, sum(quantity)::BIGINT AS tHandle, sum(cents)::BIGINT AS tTalk
        FROM lines LEFT JOIN orders ON CAST(o_orderkey AS VARCHAR) = conversationId GROUP BY ALL""",
)
def conversation_rollup(t):
    attributes = t.orders.select(
        F.col("o_orderkey").cast("string").alias("conversationId"), F.col("o_orderpriority").alias("attribute")
    )
    # the sums come first, so that the join sees one row per conversation and media type
    sums = ag.rollup_sums(wide_facts(t), ["conversationId", "mediaType"], {"tHandle": "tHandle", "tTalk": "tTalk"})
    return sums.join(attributes, "conversationId", "left")


@query(
    "a3_count_positive",
    """SELECT l_suppkey, count(*) FILTER (WHERE coalesce(l_discount, 0) > 0) AS nHeld, count(*) FILTER (WHERE l_tax > 0) AS nAcw
       FROM lineitem GROUP BY 1""",
)
def count_positive(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        ag.count_positive("l_discount").alias("nHeld"), ag.count_positive("l_tax").alias("nAcw")
    )


@query(
    "a4_conditional_sums",
    with_(LINES)
    + """SELECT agentId, sum(CASE WHEN mediaType = 'voice' THEN quantity END)::BIGINT AS voiceHandle,
          sum(CASE WHEN mediaType IN ('chat', 'email') THEN quantity END)::BIGINT AS textHandle,
          count(*) FILTER (WHERE mediaType = 'voice' AND discountPct > 0) AS voiceHolds FROM lines GROUP BY 1""",
)
def conditional_sums(t):
    voice = F.col("mediaType") == "voice"
    return wide_facts(t).groupBy("agentId").agg(
        ag.sum_where(voice, "tHandle").alias("voiceHandle"),
        ag.sum_where(F.col("mediaType").isin("chat", "email"), "tHandle").alias("textHandle"),
        F.count_if(voice & (F.col("tHeld") > 0)).alias("voiceHolds"),
    )


@query(
    "a5_ratio_of_sums",
    with_(LINES)
    + """SELECT agentId, queueId, CAST(sum(quantity) AS DOUBLE) / nullif(sum(taxPct), 0)::DOUBLE AS handlePerAcw FROM lines GROUP BY 1, 2""",
)
def ratio_of_sums(t):
    return wide_facts(t).groupBy("agentId", "queueId").agg(
        ag.ratio(F.sum("tHandle"), F.sum("tAcw")).alias("handlePerAcw")
    )


@query(
    "a6_capped_averages",
    """SELECT l_suppkey, least(avg(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) * 4 END), 100.0::DOUBLE) AS formA,
       least(avg(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) * 2 END), 100.0::DOUBLE) AS formR FROM lineitem GROUP BY 1""",
)
def capped_averages(t):
    q = F.col("l_quantity").cast("long")
    return t.lineitem.groupBy("l_suppkey").agg(
        ag.capped_avg(F.when(F.col("l_returnflag") == "A", q * 4)).alias("formA"),
        ag.capped_avg(F.when(F.col("l_returnflag") == "R", q * 2)).alias("formR"),
    )


@query(
    "a7_count_distinct",
    """SELECT o_orderpriority, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS finishedCustomers,
       count(DISTINCT (o_custkey, o_orderstatus)) AS pairs FROM orders GROUP BY 1""",
)
def count_distinct(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.countDistinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))).alias("finishedCustomers"),
        F.countDistinct("o_custkey", "o_orderstatus").alias("pairs"),
    )


@query(
    "a8_distinct_text_lists",
    "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1",
)
def distinct_text_lists(t):
    return ag.text_lists(t.orders, ["o_custkey"], "o_orderpriority", "priorities")


@query(
    "a9_transcript_text",
    with_(TURNS)
    + """SELECT conversationId, ((line - 1) // 3)::INTEGER AS part, string_agg(line || ' ' || participant || ': ' || phrase, chr(10) ORDER BY line) AS transcript
        FROM turns GROUP BY 1, 2""",
)
def transcript_text(t):
    text = F.concat(F.col("line"), F.lit(" "), "participant", F.lit(": "), "phrase")
    return ag.assemble_lines(raw.transcript_lines(t.conversations), "conversationId", "line", text, "transcript", lines_per_part=3)


@query(
    "a10_group_spans",
    with_(INTERVALS)
    + "SELECT userId, status, min(startTime)::VARCHAR AS firstStart, max(endTime)::VARCHAR AS lastEnd FROM iv GROUP BY userId, status",
)
def group_spans(t):
    return ag.spans(raw.status_intervals(t.events), ["userId", "status"], "startTime", "endTime")


@query(
    "a11_conditional_anchors",
    with_(TURNS)
    + """SELECT conversationId, min(CASE WHEN line = 2 THEN startTime END)::VARCHAR AS secondStart,
          max(CASE WHEN participant = 'assistant' THEN endTime END)::VARCHAR AS lastReplyEnd FROM turns GROUP BY 1""",
)
def conditional_anchors(t):
    return raw.transcript_lines(t.conversations).groupBy("conversationId").agg(
        F.min(F.when(F.col("line") == 2, F.col("startTime"))).alias("secondStart"),
        F.max(F.when(F.col("participant") == "assistant", F.col("endTime"))).alias("lastReplyEnd"),
    )


@query(
    "a12_any_flags",
    with_(EVENTS) + "SELECT userId, bool_or(eventType = 'error') AS hadError, bool_or(k > 98) AS hadPeak FROM ev GROUP BY 1",
)
def any_flags(t):
    return raw.event_rows(t.events).groupBy("userId").agg(
        F.bool_or(F.col("eventType") == "error").alias("hadError"), F.bool_or(F.col("k") > 98).alias("hadPeak")
    )


@query(
    "a13_groups_without_code",
    with_(LINES)
    + "SELECT conversationId, max(segmentEnd)::VARCHAR AS lastEnd FROM lines GROUP BY 1 HAVING count(wrapUpCode) = 0 AND max(segmentEnd) IS NOT NULL",
)
def groups_without_code(t):
    return (
        t.line_sessions()
        .groupBy("conversationId")
        .agg(F.max("segmentEnd").alias("lastEnd"), F.count("wrapUpCode").alias("codes"))
        .filter("codes = 0 and lastEnd is not null")
        .drop("codes")
    )


@query("a14_distinct_projection", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_projection(t):
    return t.customer.select("c_mktsegment", "c_nationkey").distinct()


def kpi_rows(t):
    """Uploaded KPI values: one row per line."""
    return t.lineitem.select(
        F.col("l_suppkey").alias("user_id"),
        F.to_date("l_shipdate").alias("report_date"),
        F.col("l_returnflag").alias("org_id"),
        F.col("l_quantity").cast("long").alias("handled"),
        F.round(F.col("l_discount") * 100).cast("long").alias("held"),
        F.nullif(F.round(F.col("l_tax") * 100).cast("long"), F.lit(0).cast("long")).alias("after"),
        F.col("l_shipdate").alias("creation_date"),
    )


# fixed values: configured formulas
FORMULAS = [
    kpi.Formula("aht", "handled + held", "sum", "handled", "count"),
    kpi.Formula("hold_rate", "held", "sum", "handled", "sum"),
    kpi.Formula("acw_share", "coalesce(after, 0)", "sum", "after", "max"),
]

KPIS = """kr AS (SELECT l_suppkey AS user_id, CAST(l_shipdate AS DATE) AS report_date, l_returnflag AS org_id, CAST(l_quantity AS BIGINT) AS handled,
  CAST(round(l_discount * 100) AS BIGINT) AS held, nullif(CAST(round(l_tax * 100) AS BIGINT), 0) AS after FROM lineitem)"""


@query(
    "a15_formula_kpis",
    with_(KPIS)
    + """, a AS (SELECT user_id, report_date, org_id, 'aht' AS dictionary_key, sum(handled + held)::DOUBLE AS num, count(handled)::DOUBLE AS denom FROM kr GROUP BY ALL
        UNION ALL SELECT user_id, report_date, org_id, 'hold_rate', sum(held)::DOUBLE, sum(handled)::DOUBLE FROM kr GROUP BY ALL
        UNION ALL SELECT user_id, report_date, org_id, 'acw_share', sum(coalesce(after, 0))::DOUBLE, max(after)::DOUBLE FROM kr WHERE after IS NOT NULL GROUP BY ALL)
       SELECT user_id, report_date::VARCHAR AS report_date, org_id, dictionary_key, num, denom, num / nullif(denom, 0) AS value FROM a""",
)
def formula_kpis(t):
    return kpi.ratio_kpis(kpi_rows(t), FORMULAS, ["user_id", "report_date", "org_id"])


@query(
    "a16_own_value_kpis",
    with_(KPIS)
    + """, a AS (SELECT user_id, org_id, 'handled' AS dictionary_key, avg(handled)::DOUBLE AS value FROM kr GROUP BY ALL
        UNION ALL SELECT user_id, org_id, 'held', max(held)::DOUBLE FROM kr GROUP BY ALL
        UNION ALL SELECT user_id, org_id, 'after', sum(after)::DOUBLE FROM kr GROUP BY ALL) SELECT * FROM a WHERE value IS NOT NULL""",
)
def own_value_kpis(t):
    return kpi.own_value_kpis(kpi_rows(t), {"handled": "avg", "held": "max", "after": "sum"}, ["user_id", "org_id"])


@query(
    "a17_high_water_mark",
    """SELECT l_returnflag AS org_id, count(*) AS newer FROM lineitem l JOIN
         (SELECT l_returnflag AS org, max(l_shipdate) AS m FROM lineitem WHERE l_shipdate < '2001-06-01' GROUP BY 1) ON org = l_returnflag
       WHERE l_shipdate > m GROUP BY 1""",
)
def high_water_mark(t):
    rows = kpi_rows(t)
    marks = kpi.high_water_mark(rows.filter("creation_date < '2001-06-01'"), "org_id", "creation_date")
    return kpi.newer_than_mark(rows, marks, "org_id", "creation_date").groupBy("org_id").agg(F.count(F.lit(1)).alias("newer"))


@query(
    "a18_presence_by_activity",
    with_(EVENTS)
    + "SELECT userId, CAST(ts AS DATE)::VARCHAR AS day, count(CASE WHEN eventType IN ('signup', 'purchase') THEN cents END) > 0 AS isPresent FROM ev GROUP BY 1, 2",
)
def presence_by_activity(t):
    active = F.when(F.col("eventType").isin("signup", "purchase"), F.col("cents"))
    e = raw.event_rows(t.events)
    return e.groupBy("userId", F.to_date("ts").alias("day")).agg((F.count(active) > 0).alias("isPresent"))


@query(
    "a19_month_end_absenteeism",
    """SELECT o_custkey AS userId, last_day(o_orderdate)::VARCHAR AS monthEnd,
       (count(*) - count(*) FILTER (WHERE o_orderstatus <> 'P')) * 100.0::DOUBLE / count(*) AS absenteeism FROM orders GROUP BY 1, 2""",
)
def month_end_absenteeism(t):
    n, present = F.count(F.lit(1)), F.count_if(F.col("o_orderstatus") != "P")
    return t.orders.groupBy(F.col("o_custkey").alias("userId"), F.last_day("o_orderdate").alias("monthEnd")).agg(
        ((n - present) * F.lit(100.0) / n).alias("absenteeism")
    )


@query(
    "a20_long_metric_rollup",
    with_(EVENTS)
    + """SELECT CAST(ts AS DATE)::VARCHAR AS day, mediaType, userId, eventType AS name, sum(cents)::BIGINT AS value FROM ev GROUP BY ALL""",
)
def long_metric_rollup(t):
    m = raw.metric_events(t.events)
    return m.groupBy(F.to_date("eventTime").alias("day"), "mediaType", "userId", "name").agg(F.sum("value").alias("value"))


@query(
    "l1_ordered_intervals",
    with_(INTERVALS)
    + "SELECT userId, startTime::VARCHAR AS startTime, endTime::VARCHAR AS endTime, eventId FROM iv ORDER BY userId, startTime, endTime, eventId",
)
def ordered_intervals(t):
    iv = raw.status_intervals(t.events).select("userId", "startTime", "endTime", "eventId")
    return iv.orderBy("userId", "startTime", "endTime", "eventId")


@query("l2_newest_row", "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def newest_row(t):
    return t.events.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(1).select("event_id", "event_type")


@query(
    "l3_shares",
    "SELECT count(*) AS docs, 4::BIGINT AS shares, TRUE AS balanced, 0::BIGINT AS shared FROM documents",
)
def shares(t):
    # keys and their neighbours twice: a key must land in one share however often it comes
    docs = t.documents.select("doc_id").unionByName(t.documents.select("doc_id"))
    docs = docs.select("doc_id", writers.shares(docs, 4, "doc_id").alias("share")).distinct()
    sizes = docs.groupBy("share").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.sum("n").alias("docs"),
        F.count(F.lit(1)).alias("shares"),
        (F.max("n") <= 1.5 * F.avg("n")).alias("balanced"),
        F.count_if(~F.col("share").between(0, 3)).alias("shared"),
    )


@query(
    "l4_latest_per_user",
    with_(EVENTS) + "SELECT userId, arg_max(eventType, eventId) AS status, max(eventId) AS eventId FROM ev GROUP BY 1",
)
def latest_per_user(t):
    at = F.struct("ts", "eventId")
    e = raw.event_rows(t.events)
    return e.groupBy("userId").agg(F.max_by("eventType", at).alias("status"), F.max_by("eventId", at).alias("eventId"))


@query(
    "u1_typed_union",
    with_(INTERVALS)
    + """SELECT userId, 'start' AS kind, startTime::VARCHAR AS at, CAST(NULL AS INTEGER) AS k FROM iv
         UNION ALL SELECT userId, 'end', endTime::VARCHAR, k FROM iv WHERE status <> 'error'""",
)
def typed_union(t):
    iv = raw.status_intervals(t.events)
    starts = iv.select("userId", F.lit("start").alias("kind"), F.col("startTime").alias("at"))
    length = ((F.unix_timestamp("endTime") - F.unix_timestamp("startTime")) / 60).cast("int")
    ends = iv.filter("status <> 'error'").select("userId", F.lit("end").alias("kind"), F.col("endTime").alias("at"), length.alias("k"))
    return starts.unionByName(ends, allowMissingColumns=True)


@query(
    "u2_distinct_union",
    """SELECT DISTINCT * FROM (SELECT l_suppkey AS userId, 'held' AS kpi, CAST(count(*) FILTER (WHERE l_discount > 0) AS BIGINT) AS num FROM lineitem GROUP BY 1
       UNION ALL SELECT l_suppkey, 'held', count(*) FILTER (WHERE l_discount > 0 AND l_quantity > 0) FROM lineitem GROUP BY 1
       UNION ALL SELECT l_suppkey, 'acw', count(*) FILTER (WHERE l_tax > 0) FROM lineitem GROUP BY 1)""",
)
def distinct_union(t):
    def branch(name, condition):
        return t.lineitem.groupBy(F.col("l_suppkey").alias("userId")).agg(F.count_if(condition).alias("num")).select(
            "userId", F.lit(name).alias("kpi"), "num"
        )

    held = F.col("l_discount") > 0
    return (
        branch("held", held).union(branch("held", held & (F.col("l_quantity") > 0))).union(branch("acw", F.col("l_tax") > 0))
    ).distinct()


@query(
    "u3_simple_and_fuzzy",
    """SELECT c_custkey, 'simple' AS how FROM customer WHERE c_custkey % 2 = 0
       UNION ALL SELECT c_custkey, 'fuzzy' FROM customer WHERE c_custkey % 2 = 1""",
)
def simple_and_fuzzy(t):
    names = t.customer.select("c_custkey", F.lower("c_name").alias("nk"))
    written = t.customer.select(
        F.col("c_custkey").alias("no"), F.when(F.col("c_custkey") % 2 == 0, F.lower("c_name")).otherwise(F.concat(F.lit(" "), F.upper("c_name"))).alias("text")
    )
    simple = written.join(names, F.col("text") == F.col("nk")).select("c_custkey", F.lit("simple").alias("how"))
    rest = written.join(names, F.col("text") == F.col("nk"), "left_anti")
    fuzzy = rest.join(names, F.lower(F.trim("text")) == F.col("nk")).select("c_custkey", F.lit("fuzzy").alias("how"))
    return simple.union(fuzzy)


@query(
    "u4_subtract",
    "SELECT o_custkey, o_orderpriority FROM orders EXCEPT SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'",
)
def subtract(t):
    pairs = t.orders.select("o_custkey", "o_orderpriority", "o_orderstatus")
    return pairs.drop("o_orderstatus").subtract(pairs.filter("o_orderstatus = 'F'").drop("o_orderstatus"))


@query(
    "u5_roster_union",
    with_(USERS)
    + "SELECT userId, region FROM users WHERE state = 'active' UNION SELECT m.userId, m.region FROM users u JOIN users m ON m.userId = u.managerId",
)
def roster_union(t):
    u = raw.users(t.customer, t.nation, t.region)
    leads = u.select("userId", "region").join(u.select(F.col("managerId").alias("userId")).distinct(), "userId", "left_semi")
    return u.filter("state = 'active'").select("userId", "region").union(leads).distinct()
