"""Per-key ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.functions import times as tm
from callweave.operators import ordered
from callweave.plans import conversations as cv
from callweave.queries.prelude import EVENTS, INTERVALS, LINES, TURNS, with_
from callweave.queries.registry import query
from callweave.sources import raw


@query(
    "x1_latest_version",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn
       FROM orders) WHERE rn = 1""",
)
def latest_version(t):
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return ordered.newest(o, ["o_custkey"], F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).drop("o_orderdate")


@query(
    "x2_earliest_version",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) rn
       FROM orders) WHERE rn = 1""",
)
def earliest_version(t):
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return ordered.newest(o, ["o_custkey"], F.col("o_orderdate").asc(), F.col("o_orderkey").asc()).drop("o_orderdate")


@query(
    "x3_last_segment",
    with_(LINES)
    + """SELECT conversationId, mediaType, queueId, wrapUpCode, sessionId FROM (SELECT *, row_number() OVER (PARTITION BY conversationId, mediaType
          ORDER BY segmentEnd DESC, sessionId DESC) rn FROM lines) WHERE rn = 1""",
)
def last_segment(t):
    s = t.line_sessions()
    return cv.last_segments(s, ["conversationId", "mediaType"]).select(
        "conversationId", "mediaType", "queueId", "wrapUpCode", "sessionId"
    )


@query(
    "x4_last_coded_segment",
    with_(LINES)
    + """, coded AS (SELECT *, row_number() OVER (PARTITION BY conversationId ORDER BY segmentEnd DESC, sessionId DESC) rn FROM lines WHERE wrapUpCode IS NOT NULL),
         plain AS (SELECT *, row_number() OVER (PARTITION BY conversationId ORDER BY segmentEnd DESC, sessionId DESC) rn FROM lines
           WHERE conversationId NOT IN (SELECT conversationId FROM coded))
        SELECT conversationId, agentId, queueId, wrapUpCode FROM coded WHERE rn = 1 UNION ALL SELECT conversationId, agentId, queueId, wrapUpCode FROM plain WHERE rn = 1""",
)
def last_coded_segment(t):
    return cv.last_handled(t.line_sessions()).select("conversationId", "agentId", "queueId", "wrapUpCode")


@query(
    "x5_line_numbers",
    "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS line FROM conversations",
)
def line_numbers(t):
    return ordered.with_ordered(t.conversations.select("conv_id", "turn"), ["conv_id"], ["turn"], row_number="line")


@query(
    "x6_global_numbers",
    "SELECT doc_id, lang, 1000 + row_number() OVER (ORDER BY lang, doc_id) AS no FROM documents",
)
def global_numbers(t):
    return ordered.number_all(t.documents.select("doc_id", "lang"), ["lang", "doc_id"], "no", start=1001)


@query(
    "x7_rank_with_ties",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS rnk FROM lineitem",
)
def rank_with_ties(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return ordered.with_rank(rows, ["l_suppkey"], ["l_quantity"], "rnk").drop("l_quantity")


def _user_events(t):
    m = raw.metric_events(t.events)
    return m.select("eventId", "userId", "queueId", "mediaType", "name", "eventTime", "k", "value")


@query(
    "x8_previous_queue",
    with_(EVENTS) + "SELECT eventId, mediaType, lag(mediaType) OVER (PARTITION BY userId ORDER BY eventId) AS previous FROM ev",
)
def previous_queue(t):
    out = ordered.with_ordered(_user_events(t), ["userId"], ["eventTime", "eventId"], lag={"previous": "mediaType"})
    return out.select("eventId", "mediaType", "previous")


@query(
    "x9_next_as_end",
    with_(EVENTS)
    + "SELECT eventId, ts::VARCHAR AS startTime, coalesce(lead(ts) OVER (PARTITION BY userId ORDER BY eventId), TIMESTAMP '2024-02-01')::VARCHAR AS endTime FROM ev",
)
def next_as_end(t):
    out = ordered.with_ordered(_user_events(t), ["userId"], ["eventTime", "eventId"], lead={"nextTime": "eventTime"})
    return out.select(
        "eventId", F.col("eventTime").alias("startTime"), F.coalesce("nextTime", F.to_timestamp(F.lit("2024-02-01"))).alias("endTime")
    )


@query(
    "x10_repeat_contact",
    """SELECT o_orderkey, coalesce(date_diff('minute', o_orderdate, nxt) <= 7200, FALSE) AS repeated FROM
       (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt FROM orders)""",
)
def repeat_contact(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    out = ordered.with_ordered(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], lead={"nxt": "o_orderdate"})
    gap = tm.minutes_between(F.col("o_orderdate"), F.col("nxt"))
    return out.select("o_orderkey", F.coalesce(gap <= 7200, F.lit(False)).alias("repeated"))


@query(
    "x11_inferred_start",
    with_(EVENTS)
    + """SELECT eventId, (CASE WHEN prev IS NULL OR ts - prev > INTERVAL 12 HOUR THEN ts - INTERVAL 12 HOUR ELSE prev END)::VARCHAR AS startTime
        FROM (SELECT *, lag(ts) OVER (PARTITION BY userId ORDER BY eventId) AS prev FROM ev)""",
)
def inferred_start(t):
    out = ordered.with_ordered(_user_events(t), ["userId"], ["eventTime", "eventId"], lag={"prev": "eventTime"})
    back = F.col("eventTime") - F.expr("interval 12 hours")
    return out.select(
        "eventId", F.when(F.col("prev").isNull() | (F.col("prev") < back), back).otherwise(F.col("prev")).alias("startTime")
    )


@query(
    "x12_running_max",
    with_(EVENTS) + "SELECT eventId, max(k) OVER (PARTITION BY userId ORDER BY eventId ROWS UNBOUNDED PRECEDING) AS peak FROM ev",
)
def running_max(t):
    out = ordered.with_ordered(_user_events(t), ["userId"], ["eventTime", "eventId"], running_max={"peak": "k"})
    return out.select("eventId", "peak")


@query(
    "x13_fill_end",
    with_(INTERVALS)
    + """SELECT eventId, coalesce(CASE WHEN k % 10 <> 0 THEN endTime END, lead(startTime) OVER (PARTITION BY userId ORDER BY eventId), startTime)::VARCHAR AS endTime FROM iv""",
)
def fill_end(t):
    iv = raw.status_intervals(t.events)
    minutes = (F.unix_timestamp("endTime") - F.unix_timestamp("startTime")) / 60
    open_end = iv.withColumn("endTime", F.when(minutes % 10 != 0, F.col("endTime")))
    return cv.fill_ends(open_end, ["userId"], "startTime", "endTime", "eventId").select("eventId", "endTime")


@query(
    "x14_fill_start",
    with_(INTERVALS)
    + """SELECT eventId, coalesce(CASE WHEN k % 10 <> 0 THEN startTime END, lag(endTime) OVER (PARTITION BY userId ORDER BY eventId) + INTERVAL 1 MILLISECOND)::VARCHAR AS startTime FROM iv""",
)
def fill_start(t):
    iv = raw.status_intervals(t.events)
    minutes = (F.unix_timestamp("endTime") - F.unix_timestamp("startTime")) / 60
    missing = iv.withColumn("startTime", F.when(minutes % 10 != 0, F.col("startTime")))
    return cv.fill_starts(missing, ["userId"], "eventId", "startTime", "endTime").select("eventId", "startTime")


@query(
    "x15_ordinal_of_groups",
    with_(LINES)
    + """SELECT conversationId, queueId, firstStart::VARCHAR AS firstStart, row_number() OVER (PARTITION BY conversationId ORDER BY firstStart, queueId) AS ordinal
        FROM (SELECT conversationId, queueId, min(segmentStart) AS firstStart FROM lines GROUP BY 1, 2)""",
)
def ordinal_of_groups(t):
    s = t.line_sessions().groupBy("conversationId", "queueId").agg(F.min("segmentStart").alias("firstStart"))
    return ordered.with_ordered(s, ["conversationId"], ["firstStart", "queueId"], row_number="ordinal")


@query(
    "x16_quota",
    """WITH done AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < '1996-01-01' GROUP BY 1)
       SELECT o_custkey, o_orderkey FROM (SELECT o.*, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY o.o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders o LEFT JOIN done USING (o_custkey) WHERE o_orderstatus = 'O') WHERE rn <= 5 - n""",
)
def quota(t):
    done = (
        t.orders.filter("o_orderstatus = 'F' and o_orderdate < '1996-01-01'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    )
    open_ = t.orders.filter("o_orderstatus = 'O'").select("o_custkey", "o_orderkey", "o_orderdate")
    return cv.within_quota(open_, done, ["o_custkey"], "n", 5, F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).select(
        "o_custkey", "o_orderkey"
    )


@query(
    "x17_window_and_filter",
    """SELECT o_orderkey, o_custkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1""",
)
def window_and_filter(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    return ordered.newest(o, ["o_custkey", "o_orderpriority"], F.col("o_totalprice").desc(), F.col("o_orderkey").asc()).select(
        "o_orderkey", "o_custkey"
    )


@query(
    "x18_latest_presence",
    with_(EVENTS)
    + """, p AS (SELECT userId, date_trunc('hour', ts) AS startTime, CASE WHEN k % 10 <> 0 THEN ts + to_seconds(k * 60) END AS endTime, eventType, eventId FROM ev)
        SELECT userId, startTime::VARCHAR AS startTime, endTime::VARCHAR AS endTime, eventType AS systemPresence FROM p
        QUALIFY row_number() OVER (PARTITION BY userId, startTime ORDER BY coalesce(endTime, TIMESTAMP '2024-02-01') DESC, eventId DESC) = 1""",
)
def latest_presence(t):
    e = raw.event_rows(t.events)
    p = e.select(
        "userId",
        F.date_trunc("hour", "ts").alias("startTime"),
        F.when(F.col("k") % 10 != 0, raw.plus_seconds(F.col("ts"), F.col("k") * 60)).alias("endTime"),
        F.col("eventType").alias("systemPresence"),
        "eventId",
    )
    return cv.latest_intervals(p, ["userId", "startTime"], "endTime", "2024-02-01", F.col("eventId").desc()).drop("eventId")


@query(
    "x19_first_and_last_queue",
    with_(LINES)
    + """SELECT conversationId, arg_min(queueId, (segmentStart, sessionId)) AS firstQueue, arg_max(queueId, (segmentEnd, sessionId)) AS lastQueue FROM lines GROUP BY 1""",
)
def first_and_last_queue(t):
    s = t.line_sessions()
    return s.groupBy("conversationId").agg(
        F.min_by("queueId", F.struct("segmentStart", "sessionId")).alias("firstQueue"),
        F.max_by("queueId", F.struct("segmentEnd", "sessionId")).alias("lastQueue"),
    )
