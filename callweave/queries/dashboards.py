"""Reference dimensions, dashboards, loads and hand-offs."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.functions import text as tx
from callweave.operators import joins as jn
from callweave.operators import upserts as up
from callweave.plans import conversations as cv
from callweave.plans import dashboards as db
from callweave.plans import evaluations as evp
from callweave.plans import loads as ld
from callweave.plans import workforce as wf
from callweave.queries import joins as join_queries
from callweave.queries import kpis
from callweave.queries.facts import LAST, PRESENCE, UNIT
from callweave.queries.kpis import EVALUATED, INTERVAL_FACT, WIDE
from callweave.queries.prelude import EVENTS, LINES, MART, TURNS, USERS, with_
from callweave.queries.registry import query
from callweave.queries.stored import stored_side, stored_sql
from callweave.queries.timeaxis import sliced
from callweave.session import scratch_path
from callweave.sources import raw, sheets, star


def raw_users(t):
    u = raw.users(t.customer, t.nation, t.region)
    role = F.when(F.col("userNo") % 3 == 0, F.array(F.struct(F.lit("admin").alias("name")), F.struct(F.lit("agent").alias("name")))).otherwise(F.array(F.struct(F.lit("agent").alias("name"))))
    return u.select(
        F.col("userId").alias("id"),
        F.col("userName").alias("name"),
        F.concat("userId", F.lit("@x.com")).alias("email"),
        "department",
        "state",
        F.struct(F.col("managerId").alias("id")).alias("manager"),
        F.array(F.struct(F.concat(F.lit("g-"), "groupName").alias("id")), F.struct(F.concat(F.lit("g-"), "region").alias("id"))).alias("groups"),
        F.struct(role.alias("roles")).alias("authorization"),
    )


@query(
    "d10_users",
    with_(USERS) + "SELECT DISTINCT u.userId, u.userName AS userFullName, u.userId || '@x.com' AS email, u.department, u.state, u.managerId, m.userName AS managerName FROM users u LEFT JOIN users m ON m.userId = u.managerId",
)
def dim_users(t):
    return db.dim_users(raw_users(t))


@query(
    "d10_user_groups",
    with_(USERS) + "SELECT DISTINCT userId, 'g-' || groupName AS groupId, groupName FROM users UNION SELECT userId, 'g-' || region, region FROM users",
)
def dim_user_groups(t):
    names = t.nation.select(F.col("n_name").alias("groupName")).union(t.region.select("r_name"))
    return db.dim_user_groups(raw_users(t), names.withColumn("groupId", F.concat(F.lit("g-"), "groupName")))


def raw_queues(t):
    def level(ms, share):
        return F.struct(F.struct(ms.cast("long").alias("durationMs"), share.cast("double").alias("percentage")).alias("serviceLevel"))

    n = F.col("s_suppkey")
    return t.supplier.select(
        F.concat(F.lit("q"), n).alias("id"),
        F.col("s_name").alias("name"),
        F.struct(level(n * 100, n % 2), level(n * 10, n % 4), level(n, n % 3)).alias("_m"),
    ).select("id", "name", F.struct(F.col("_m.col1").alias("call"), F.col("_m.col2").alias("chat"), F.col("_m.col3").alias("email")).alias("mediaSettings"))


@query(
    "d10_queues",
    """SELECT 'q' || s_suppkey AS queueId, s_name AS queueName, s_suppkey * 100 / 1000.0::DOUBLE AS callSlaDuration, s_suppkey % 2 * 100.0::DOUBLE AS callSlaPercentage, s_suppkey * 10 / 1000.0::DOUBLE AS chatSlaDuration,
       s_suppkey % 4 * 100.0::DOUBLE AS chatSlaPercentage, s_suppkey / 1000.0::DOUBLE AS emailSlaDuration, s_suppkey % 3 * 100.0::DOUBLE AS emailSlaPercentage FROM supplier""",
)
def dim_queues(t):
    return db.dim_queues(raw_queues(t))


@query("d10_wrap_up_codes", "SELECT DISTINCT p_brand AS wrapUpId, p_type AS wrapUpCode FROM part")
def dim_codes(t):
    return db.dim_codes(t.part.select(F.col("p_brand").alias("id"), F.col("p_type").alias("name")))


@query("d10_forms", "SELECT DISTINCT 'form-' || (p_partkey % 11) AS evaluationFormId, 'Form ' || (p_partkey % 11) AS evaluationFormName, p_partkey % 2 = 0 AS published FROM part")
def dim_forms(t):
    return db.dim_forms(raw.form_payloads(t.part))


def zones_of(t):
    return raw.users(t.customer, t.nation, t.region).select("userId", "timeZone")


@query(
    "d33_daily_summary",
    with_(MART)
    + INTERVAL_FACT
    + """, l AS (SELECT *, (intervalStart AT TIME ZONE 'UTC') AT TIME ZONE timeZone AS a FROM ivl)
       SELECT CAST(a AS DATE)::VARCHAR AS emitDate, strftime(a, '%H:%M:%S') AS intervalStart, userId AS userKey, mediaType, messageType, queueId AS queueKey, sum(tHandle)::BIGINT AS tHandle, sum(tAcw)::BIGINT AS tAcw, count(*) AS nHandle FROM l GROUP BY ALL""",
)
def daily_summary(t):
    return db.daily_summary(kpis.intervals(t), star.queues(t.part), ["tHandle", "tAcw", "nHandle"])


@query(
    "d33_presence",
    with_(EVENTS, USERS)
    + PRESENCE
    + """, lo AS (SELECT DISTINCT pp.userId, status, (startTime AT TIME ZONE 'UTC') AT TIME ZONE timeZone AS s, (coalesce(endTime, TIMESTAMP '2024-02-01') AT TIME ZONE 'UTC') AT TIME ZONE timeZone AS e FROM pp JOIN users ON users.userId = pp.userId),
        dd AS (SELECT *, CAST(unnest(range(CAST(s AS DATE), CAST(e AS DATE) + 1, INTERVAL 1 DAY)) AS DATE) AS day FROM lo WHERE s <= e)
       SELECT userId, status AS systemPresence, day::VARCHAR AS day, (CASE WHEN CAST(s AS DATE) < day THEN CAST(day AS TIMESTAMP) ELSE s END)::VARCHAR AS startTime, (CASE WHEN CAST(e AS DATE) > day THEN CAST(day + 1 AS TIMESTAMP) - INTERVAL 1 SECOND ELSE e END)::VARCHAR AS endTime FROM dd""",
)
def presence(t):
    p = wf.primary_presence(raw.user_details(t.events), "2024-02-01")
    return db.local_presence(p, zones_of(t)).select("userId", "systemPresence", "day", "startTime", "endTime")


@query(
    "d33_global_presence",
    with_(EVENTS, USERS, "iv AS (SELECT eventId, userId, eventType AS status, ts AS startTime, ts + to_seconds(k * 60) AS endTime FROM ev WHERE eventType = 'view')")
    + sliced(3600)
    + """, l AS (SELECT cut.userId, (startTime AT TIME ZONE 'UTC') AT TIME ZONE timeZone AS a, status, (epoch(endTime) - epoch(startTime))::BIGINT AS timeDiff FROM cut JOIN users ON users.userId = cut.userId)
       SELECT DISTINCT userId, CAST(a AS DATE)::VARCHAR AS startDate, lpad(hour(a)::VARCHAR, 2, '0') || ':00:00 - ' || lpad((hour(a) + 1)::VARCHAR, 2, '0') || ':00:00' AS TimeIntervalStart, status AS systemPresence, timeDiff FROM l""",
)
def global_presence(t):
    iv = raw.status_intervals(t.events).withColumnRenamed("status", "systemPresence").drop("eventId")
    return db.global_presence(iv, zones_of(t), "view")


@query(
    "d33_routing_slices",
    with_(EVENTS, USERS, "iv AS (SELECT eventId, ev.userId, eventType AS status, (ts AT TIME ZONE 'UTC') AT TIME ZONE timeZone AS startTime, ((ts + to_seconds(k * 60)) AT TIME ZONE 'UTC') AT TIME ZONE timeZone AS endTime, timeZone AS tz FROM ev JOIN users ON users.userId = ev.userId)")
    + sliced(1800)
    + " SELECT eventId, slot::VARCHAR AS timeSlot, startTime::VARCHAR AS startTime, endTime::VARCHAR AS endTime, (epoch(endTime) - epoch(startTime))::BIGINT AS timeDiff FROM cut",
)
def routing_slices(t):
    return db.routing_slices(raw.status_intervals(t.events), zones_of(t)).select("eventId", "timeSlot", "startTime", "endTime", "timeDiff")


@query(
    "d33_wfm_actuals",
    with_(EVENTS, USERS)
    + UNIT
    + """, a AS (SELECT userId, ts AS s, ts + to_seconds(k * 60) AS e, 'OnQueueWork' AS c FROM own UNION ALL SELECT userId, ts + to_seconds(k * 60), ts + to_seconds(k * 60 + 600), 'Break' FROM own)
       SELECT DISTINCT a.userId, c AS actualActivityCategory, ((s AT TIME ZONE 'UTC') AT TIME ZONE timeZone)::VARCHAR AS startDate, ((e AT TIME ZONE 'UTC') AT TIME ZONE timeZone)::VARCHAR AS endDate FROM a JOIN users ON users.userId = a.userId WHERE s <> e""",
)
def local_actuals(t):
    rows = wf.actuals(wf.adherence_payloads(t.events), wf.unit_members(t.customer))
    return db.local_spans(rows, zones_of(t)).select("userId", "actualActivityCategory", "startDate", "endDate")


@query(
    "d33_wfm_day_metrics",
    with_(EVENTS, USERS)
    + UNIT
    + """, d AS (SELECT userId, ts, k * 10 AS len, ts AS s, ts + INTERVAL 1 DAY AS e FROM own UNION ALL SELECT userId, ts, k * 20, ts + INTERVAL 1 DAY, ts + INTERVAL 2 DAY FROM own)
       SELECT DISTINCT d.userId, len::BIGINT AS actualLengthSecs, ((s AT TIME ZONE 'UTC') AT TIME ZONE timeZone)::VARCHAR AS startDate, ((e AT TIME ZONE 'UTC') AT TIME ZONE timeZone)::VARCHAR AS endDate FROM d JOIN users ON users.userId = d.userId""",
)
def local_day_metrics(t):
    rows = wf.day_metrics(wf.adherence_payloads(t.events), wf.unit_members(t.customer))
    return db.local_spans(rows, zones_of(t)).select("userId", "actualLengthSecs", "startDate", "endDate").distinct()


@query(
    "d33_survey_summary",
    with_(EVENTS, "det AS (SELECT DISTINCT 'conv-' || event_id AS conversationId, event_type AS mediaType FROM events)")
    + """SELECT eventId AS surveyId, conversationId, CASE WHEN k % 4 = 0 THEN 'US inbound' ELSE 'DE inbound' END AS callType, (CASE WHEN k % 4 = 0 THEN (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' ELSE ts END)::VARCHAR AS surveySentDate,
          eventType AS mediaType, CASE WHEN k % 4 = 0 THEN 'US' END AS region, CAST(CASE WHEN k % 4 = 0 THEN (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' ELSE ts END AS DATE)::VARCHAR AS surveySentDatePart FROM (SELECT *  EXCLUDE (conversationId), 'conv-' || eventId AS conversationId FROM ev)""",
)
def survey_summary(t):
    from callweave.plans import surveys as sv

    wide = sv.wide_interactions(kpis.interactions(t), kpis.questions(t))
    zones = F.array(
        *[F.struct(F.lit(q).alias("queueName"), F.lit(r).alias("region"), F.lit(z).alias("timeZone")) for q, r, z in [(" us INBOUND", "US", "America/New_York"), ("FR inbound", "FR", "Europe/Paris")]]
    )
    regions = t.region.select(F.explode(zones).alias("z")).select("z.*").distinct()
    session = F.struct(F.col("event_type").alias("mediaType"))
    details = t.events.select(F.concat(F.lit("conv-"), "event_id").alias("conversationId"), F.array(F.struct(F.array(session).alias("sessions"))).alias("participants"))
    return db.survey_summary(wide.drop("mediaType"), regions, details)


@query(
    "d33_evaluation_details",
    with_(MART)
    + EVALUATED
    + " SELECT DISTINCT evaluationId, agentId, queueId, mediaType, form AS evaluationFormId, ((segmentStart AT TIME ZONE 'UTC') AT TIME ZONE timeZone)::VARCHAR AS conversationDate, quantity * 2.0::DOUBLE AS totalScore, quantity::DOUBLE AS totalCriticalScore FROM evl",
)
def evaluation_details(t):
    scores = evp.total_scores(raw.evaluation_payloads(t.line_sessions()))
    return db.evaluation_details(kpis.evaluation_rows(t), scores, star.queues(t.part)).distinct()


@query(
    "d33_question_scores",
    with_(LINES)
    + """, q AS (SELECT DISTINCT sessionId, discountPct AS form, 'q1' AS q, CAST(quantity % 6 AS BIGINT) AS score, returnFlag, queueId, agentId, mediaType, segmentStart FROM lines UNION ALL SELECT DISTINCT sessionId, discountPct, 'q2', taxPct, returnFlag, queueId, agentId, mediaType, segmentStart FROM lines
           UNION ALL SELECT DISTINCT sessionId, discountPct, 'q3', discountPct, returnFlag, queueId, agentId, mediaType, segmentStart FROM lines)
       SELECT 'form-' || form AS evaluationFormId, q AS questionId, count(*) AS asked, count(*) FILTER (WHERE returnFlag = 'R' AND score < 3) AS failed, sum(score)::BIGINT AS score FROM q GROUP BY 1, 2""",
)
def question_scores(t):
    payloads = evp.gathered(raw.evaluation_payloads(t.line_sessions()), kpis.delivered_evaluations(t))
    return db.question_score_summary(evp.question_scores(payloads, in_place=True))


@query(
    "d34_user_roles",
    with_(USERS) + "SELECT userId, 'agent' AS role FROM users UNION SELECT userId, 'admin' FROM users WHERE userNo % 3 = 0",
)
def user_roles(t):
    return db.user_roles(raw_users(t))


@query(
    "d34_form_questions",
    "SELECT DISTINCT 'form-' || (p_partkey % 11) AS formId, p_brand AS groupId, 'Group ' || p_brand AS groupName, p_type AS questionId, p_size > 25 AS isCritical FROM part",
)
def form_questions(t):
    return db.form_questions(raw.form_payloads(t.part))


@query(
    "d34_form_options",
    """SELECT DISTINCT 'form-' || (p_partkey % 11) AS formId, p_type AS questionId, p_type || '-' || i AS optionId, (['No', 'Partly', 'Yes'])[i + 1] AS optionText, CAST(i * p_size AS BIGINT) AS optionValue FROM part, LATERAL (SELECT unnest(range(0, 3)) AS i)""",
)
def form_options(t):
    return db.form_options(raw.form_payloads(t.part))


@query(
    "d34_realtime_queue_map",
    "SELECT s_suppkey AS queueId, s_name AS queueName, CASE WHEN s_nationkey < 10 THEN 'R' || (s_nationkey % 3) ELSE 'Other' END AS region FROM supplier",
)
def realtime_queue_map(t):
    regions = t.supplier.filter("s_nationkey < 10").select(F.concat(F.lit(" "), F.upper("s_name")).alias("queueName"), F.concat(F.lit("R"), F.col("s_nationkey") % 3).alias("region"))
    return db.realtime_queue_map(t.supplier.select(F.col("s_suppkey").alias("queueId"), F.col("s_name").alias("queueName")), regions)


@query(
    "d47_active_user_bill",
    with_(MART)
    + """, l AS (SELECT DISTINCT agentId FROM lines WHERE (segmentStart AT TIME ZONE 'UTC') AT TIME ZONE 'Australia/Melbourne' >= '1998-05-01' AND (segmentStart AT TIME ZONE 'UTC') AT TIME ZONE 'Australia/Melbourne' < '1998-06-01')
       SELECT userId, userName AS name, CASE WHEN active THEN 'active' ELSE 'inactive' END AS state, CASE WHEN userNo % 4 = 0 THEN 'Team Lead' ELSE 'Agent' END AS roleId, 'May-1998' AS month FROM agt WHERE userId IN (SELECT agentId FROM l) OR (active AND userNo % 4 = 0)""",
)
def active_user_bill(t):
    people = star.agents(t.supplier, t.nation, t.region).select(
        "userId", F.col("userName").alias("name"), F.when(F.col("active"), "active").otherwise("inactive").alias("state"), F.when(F.col("userNo") % 4 == 0, "Team Lead").alias("roleId")
    )
    sessions = t.line_sessions().select("agentId", F.col("segmentStart").alias("conversationStart"))
    return db.active_user_bill(sessions, people, "Australia/Melbourne", "1998-05")


@query(
    "d42_attendance_load",
    """WITH a AS (SELECT 'u' || o_custkey AS userId, CAST(o_orderdate AS DATE) AS d, o_orderstatus <> 'P' AS pr, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + to_hours(o_orderkey % 24) END AS li,
         CASE WHEN o_orderkey % 6 <> 0 THEN o_orderdate + to_hours((o_orderkey + 8) % 24) END AS lo FROM orders), b AS (SELECT userId, d, pr, li, CASE WHEN lo < li THEN lo + INTERVAL 1 DAY ELSE lo END AS lo FROM a)
       SELECT userId, d::VARCHAR AS reportDate, pr AS isPresent, li::VARCHAR AS loginTime, lo::VARCHAR AS logoutTime FROM b QUALIFY row_number() OVER (PARTITION BY userId, d ORDER BY pr DESC, li NULLS LAST, lo NULLS LAST) = 1""",
)
def attendance_load(t):
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    text = F.when(key % 3 == 0, F.date_format(d, "dd-MM-yyyy")).when(key % 3 == 1, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "MM/dd/yyyy"))

    def clock(hour):
        return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00"))

    rows = t.orders.select(
        F.concat(F.lit("u"), "o_custkey").alias("userId"),
        text.alias("date"),
        F.when(F.col("o_orderstatus") == "P", "Absent").otherwise(" Present").alias("status"),
        F.when(key % 5 == 0, "-").otherwise(clock(key % 24)).alias("login"),
        F.when(key % 6 == 0, "-").otherwise(clock((key + 8) % 24)).alias("logout"),
    )
    return ld.attendance(rows)


# fixed values: columns of the month-to-date sheet by their header texts
MTD_COLUMNS = {"Name": "Name", "Emp_ID": "Employee ID ", "Sentiment": "Sentiment %", "AHT": "AHT (Comcast)", "Calls": "NCH (Comcast)", "Xfer": "Transfer % (Comcast)", "tNPS": "tNPS"}


def _sheets(t):
    """A delivered sheet for each nation's customers: two lines of title and date, a header with columns in one of two orders, the
    rows by id, a total, and notes below it that look like rows."""
    n = F.col("c_custkey")
    swap = F.col("c_nationkey") % 2 == 1
    names = list(MTD_COLUMNS.values())[:6]
    orders = (names, [names[i] for i in (1, 0, 3, 2, 5, 4)])
    values = [F.concat(F.lit('"'), "c_name", F.lit(', agent"')), n, n % 100 / 100, F.when(n % 7 == 0, "n/a").otherwise((n % 900).cast("string")), n % 50, n % 40 / 100]
    text = lambda order: F.concat_ws(",", *[values[i].cast("string") for i in order])
    line = F.when(swap, text((1, 0, 3, 2, 5, 4))).otherwise(text(range(6)))
    rows = t.customer.select("c_nationkey", (n + 10).alias("at"), line.alias("line"))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey").cast("int")), "dd-MM-yyyy")
    head = F.when(swap, F.lit(",".join(orders[1]))).otherwise(F.lit(",".join(orders[0])))
    total = F.when(swap, "0,Grand Total,1,1,1,1").otherwise("Grand Total,0,1,1,1,1")
    note = F.when(swap, "9,after the total,1,1,1,1").otherwise("after the total,9,1,1,1,1")
    fixed = [(1, F.lit("Report")), (2, day), (3, head), (1 << 40, total), (1 << 41, note), (1 << 42, total)]
    around = t.customer.select("c_nationkey").distinct().select("c_nationkey", F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("at"), x.alias("line")) for i, x in fixed])).alias("x"))
    every = rows.unionByName(around.select("c_nationkey", "x.*"))
    path = scratch_path(t.spark, "sheets")
    every.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "at").select("line", "c_nationkey").write.partitionBy("c_nationkey").text(path)
    return sheets.positioned_lines(t.spark, path)


@query(
    "d42_month_to_date_load",
    """SELECT c_name || ', agent' AS Name, c_custkey::INTEGER AS Emp_ID, (c_custkey % 100 / 100) * 100 AS Sentiment, CASE WHEN c_custkey % 7 <> 0 THEN (c_custkey % 900)::DOUBLE END AS AHT, (c_custkey % 50)::DOUBLE AS Calls,
         (c_custkey % 40 / 100) * 100 AS Xfer, NULL::DOUBLE AS tNPS, (DATE '2024-01-01' + c_nationkey::INTEGER)::VARCHAR AS MTD_DT, 'T1' AS Tier, 'org' AS orgId FROM customer""",
)
def month_to_date_load(t):
    numbers = ["Sentiment", "AHT", "Calls", "Xfer", "tNPS"]
    return ld.month_to_date(_sheets(t), MTD_COLUMNS, numbers, ["Sentiment", "Xfer"], "org")


@query(
    "d42_agent_performance_load",
    """SELECT CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 5 IN (0, 1) THEN c_custkey::VARCHAR ELSE 'sys' || c_custkey END AS userId, c_custkey::VARCHAR AS "Emp ID", c_name || ', agent' AS Name, (c_custkey % 50)::VARCHAR AS Calls FROM customer""",
)
def agent_performance_load(t):
    rows = sheets.table(_sheets(t), {"Emp ID": "Employee ID", "Name": "Name", "Calls": "NCH (Comcast)"}, 3, total="Grand Total", total_in="Name").drop("file", "position")
    n = F.col("c_custkey")
    people = t.customer.filter(n % 3 != 0).select(n.cast("string").alias("empCode"), F.when(n % 5 == 0, "DNA").when(n % 5 == 1, None).otherwise(F.concat(F.lit("sys"), n)).alias("systemId"))
    return ld.agent_performance(rows, people, "Emp ID")


@query(
    "d42_day_wise_load",
    with_(EVENTS) + """SELECT userId, CAST(ts AS DATE)::VARCHAR AS date, sum(CASE WHEN eventType = 'view' THEN cents END)::BIGINT AS "view", sum(CASE WHEN eventType = 'error' THEN cents END)::BIGINT AS error, NULL::BIGINT AS escalation FROM ev GROUP BY 1, 2""",
)
def day_wise_load(t):
    rows = raw.event_rows(t.events).select("userId", F.to_date("ts").alias("date"), F.col("eventType").alias("measure"), F.col("cents").alias("value"))
    return ld.day_wise(rows, ["view", "error", "escalation"])


@query(
    "d42_wide_days_load",
    "SELECT o_custkey, CAST(o_orderdate AS DATE)::VARCHAR AS date, sum(o_orderkey)::BIGINT AS value FROM orders WHERE o_orderdate >= '1998-03-01' AND o_orderdate < '1998-04-01' GROUP BY 1, 2",
)
def wide_days_load(t):
    serials = [str(n) for n in range(35855, 35886)]
    march = t.orders.filter("o_orderdate >= '1998-03-01' and o_orderdate < '1998-04-01'").withColumn(
        "serial", F.datediff(F.to_date("o_orderdate"), F.to_date(F.lit("1899-12-30"))).cast("string")
    )
    sheet = march.groupBy("o_custkey").pivot("serial", serials).agg(F.sum("o_orderkey"))
    return ld.wide_days(sheet, ["o_custkey"], serials, "value")


@query(
    "d42_conformance_load",
    """WITH a AS (SELECT 'e' || o_custkey AS ecn, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS shift, (o_orderkey % 30 * 3600 + 754)::INTEGER AS login_hrs FROM orders)
       SELECT ecn, d::VARCHAR AS date, shift, login_hrs FROM a QUALIFY row_number() OVER (PARTITION BY ecn, d ORDER BY shift NULLS FIRST, login_hrs) = 1""",
)
def conformance_load(t):
    rows = t.orders.select(
        F.concat(F.lit("e"), "o_custkey").alias("ecn"),
        F.to_date("o_orderdate").alias("date"),
        F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.col("o_orderstatus")).alias("shift"),
        F.concat(F.lpad((F.col("o_orderkey") % 30).cast("string"), 2, "0"), F.lit(":12:34")).alias("login_hrs"),
    )
    return ld.conformance(rows, ["login_hrs"])


@query(
    "d42_behaviour_load",
    """SELECT c_custkey::VARCHAR AS userId, 'Jan' AS month, -1.0::DOUBLE AS score FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey::VARCHAR, 'Jan', CASE WHEN c_nationkey % 3 <> 0 THEN c_nationkey::DOUBLE END FROM customer WHERE c_custkey % 2 = 1""",
)
def behaviour_load(t):
    rows = t.customer.select(
        F.concat("c_name", F.lit(" ("), "c_custkey", F.lit(")")).alias("agent"),
        F.lit("Jan").alias("month"),
        F.when(F.col("c_nationkey") % 3 == 0, "n/a").otherwise(F.col("c_nationkey").cast("string")).alias("score"),
    ).union(t.customer.select("c_name", F.lit("Jan"), F.lit("1")))
    known = t.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("userId"), F.lit("Jan").alias("month"), F.lit(-1.0).alias("score"))
    return ld.behaviour_scores(rows, known)


@query(
    "d42_workforce_load",
    """SELECT c_custkey AS personId, c_acctbal AS adhering, CASE WHEN c_custkey % 4 = 0 OR c_custkey % 3 <> 2 THEN c_custkey END AS userId, CASE WHEN c_custkey % 4 = 0 THEN 'login' WHEN c_custkey % 3 <> 2 THEN 'name' END AS matchedBy FROM customer""",
)
def workforce_load(t):
    matches = jn.match_names(
        join_queries._people(t), join_queries._directory(t), "personId", "login", "variants", "login_name", "name", "active", "id"
    )
    return ld.workforce(t.customer.select(F.col("c_custkey").alias("personId"), F.col("c_acctbal").alias("adhering")), matches)


@query(
    "d42_kpi_load",
    stored_sql(
        "",
        """SELECT p_partkey AS id, CAST(DATE '1899-12-30' + CAST(35000 + p_size AS INTEGER) AS DATE)::VARCHAR AS reportDate, CASE WHEN p_size % 4 <> 0 THEN p_retailprice END AS price FROM part""",
        "id", "-id - 1", {"price": "-1.0::DOUBLE"},
    ),
)
def kpi_load(t):
    from callweave.operators.reshape import serial_day

    rows = t.part.select(
        F.col("p_partkey").alias("id"),
        (F.col("p_size") + 35000).cast("string").alias("date"),
        F.when(F.col("p_size") % 4 == 0, "-").otherwise(F.col("p_retailprice").cast("string")).alias("price"),
    )
    fresh = rows.select("id", serial_day(F.col("date")).alias("reportDate"), F.col("price").try_cast("double").alias("price"))
    stored = stored_side(fresh, "id", -F.col("id") - 1, {"price": -1.0})
    return up.merge_all(stored, fresh, ["id", "reportDate"], check=False)


@query(
    "d43_roster_reconcile",
    """WITH r AS (SELECT 'U' || c_custkey AS userId, CASE WHEN c_custkey % 7 = 0 THEN '-@x.com' ELSE c_custkey || '@x.com' END AS email, 'team ' || (c_custkey % 4) AS team, c_custkey FROM customer WHERE c_custkey % 5 <> 0),
         u AS (SELECT 'u' || c_custkey AS userId, c_custkey || '@x.com' AS email, 'team ' || (c_custkey % 8) AS team, c_acctbal >= 0 AS isActive, c_custkey FROM customer WHERE c_custkey % 3 <> 0)
       SELECT coalesce(r.userId, u.userId) AS userId, a AS action, coalesce(r.email, u.email) AS email, coalesce(r.team, u.team) AS team FROM r FULL JOIN u ON r.c_custkey = u.c_custkey,
         LATERAL (SELECT CASE WHEN u.userId IS NULL AND r.email <> '-@x.com' THEN 'create' WHEN r.userId IS NULL AND isActive THEN 'deactivate'
           WHEN r.userId IS NOT NULL AND u.userId IS NOT NULL AND (r.email <> u.email OR r.team <> u.team OR NOT isActive) THEN 'update' END AS a) WHERE a IS NOT NULL""",
)
def roster_reconcile(t):
    no = F.col("c_custkey")
    mail = F.concat(no, F.lit("@x.com"))
    roster = t.customer.filter("c_custkey % 5 <> 0").select(
        F.concat(F.lit("U"), no).alias("userId"), F.when(no % 7 == 0, "-@x.com").otherwise(mail).alias("email"), F.concat(F.lit("team "), no % 4).alias("team")
    )
    users = t.customer.filter("c_custkey % 3 <> 0").select(
        F.concat(F.lit("u"), no).alias("userId"), mail.alias("email"), F.concat(F.lit("team "), no % 8).alias("team"), (F.col("c_acctbal") >= 0).alias("isActive")
    )
    return ld.reconcile(roster, users)


KNOWN = """kn AS (SELECT DISTINCT 'p_type' AS type, p_type AS phrase FROM part WHERE p_type <> 'SMALL' UNION SELECT DISTINCT 'p_name', p_name FROM part WHERE p_partkey % 3 = 0),
  al AS (SELECT 'p_name' AS type, p_name AS phrase FROM part UNION SELECT 'p_type', p_type FROM part UNION SELECT 'p_brand', p_brand FROM part),
  nw AS (SELECT * FROM al WHERE NOT EXISTS (SELECT 1 FROM kn WHERE kn.type = al.type AND kn.phrase = al.phrase))"""


def _labels(t):
    types = t.part.filter("p_type <> 'SMALL'").select(F.lit("p_type").alias("type"), F.col("p_type").alias("phrase"))
    names = t.part.filter("p_partkey % 3 = 0").select(F.lit("p_name").alias("type"), F.col("p_name").alias("phrase"))
    return types.union(names).distinct().withColumn("label", F.concat(F.lit("known "), "type"))


@query(
    "d44_phrases_to_label",
    with_(KNOWN)
    + """SELECT type, phrase, CAST(NULL AS VARCHAR) AS label, CAST(ceil(row_number() OVER (ORDER BY type, phrase) / 10.0) AS INTEGER) AS batch, (['east', 'west'])[(row_number() OVER (ORDER BY type, phrase) - 1) % 2 + 1] AS worker FROM nw""",
)
def phrases_to_label(t):
    fresh = ld.new_phrases(t.part, ["p_partkey"], ["p_name", "p_type", "p_brand"], _labels(t))
    return ld.phrase_batches(fresh, 10, ["east", "west"])


@query(
    "d44_import_labels",
    with_(KNOWN)
    + """SELECT type, phrase, 'known ' || type AS label FROM kn WHERE NOT (type = 'p_type') UNION ALL SELECT 'p_type', p_type, min('label ' || p_brand) FROM part GROUP BY p_type""",
)
def import_labels(t):
    answers = t.part.select(F.lit("p_type").alias("type"), F.col("p_type").alias("phrase"), F.concat(F.lit("label "), "p_brand").alias("label"))
    return ld.import_labels(_labels(t), answers)


@query(
    "d44_classification_scores",
    """SELECT 'document' AS type, doc_id::VARCHAR AS phrase, CASE WHEN quality = 1 AND toxic = 1 THEN 'bad' WHEN toxic = 1 THEN 'bad' WHEN quality = 1 THEN 'good' ELSE 'bad' END AS category, (CASE WHEN toxic = 1 THEN 90 WHEN quality = 1 THEN 80 ELSE 10 END)::INTEGER AS confidence FROM labels""",
)
def classification_scores(t):
    good = F.struct(F.lit("good").alias("category"), F.when(F.col("quality") == 1, 80).otherwise(10).alias("confidence"))
    bad = F.struct(F.lit("bad").alias("category"), F.when(F.col("toxic") == 1, 90).otherwise(10).alias("confidence"))
    docs = t.labels.select(F.lit("document").alias("type"), F.col("doc_id").cast("string").alias("raw_phrases"), F.array(good, bad).alias("classification"))
    return ld.classification_scores(docs)


@query(
    "d45_transcript_handoff",
    with_(TURNS)
    + """, a AS (SELECT conversationId, ((line - 1) // 2)::INTEGER AS part, string_agg(line || ' ' || participant || ': ' || phrase, chr(10) ORDER BY line) AS transcript FROM turns WHERE conversationId % 4 <> 0 GROUP BY 1, 2)
       SELECT *, conversationId % 3 = 0 AS needsInsights, conversationId % 2 = 0 AS needsMap, CAST(ceil(row_number() OVER (ORDER BY conversationId, part) / 5.0) AS INTEGER) AS batch, (['a', 'b', 'c'])[(row_number() OVER (ORDER BY conversationId, part) - 1) % 3 + 1] AS worker FROM a""",
)
def transcript_handoff(t):
    lines = raw.transcript_lines(t.conversations)
    first = lines.filter("line = 1").select("conversationId")
    tasks = first.filter("conversationId % 3 = 0").withColumn("task", F.lit("insights")).union(first.filter("conversationId % 2 = 0").withColumn("task", F.lit("map")))
    return ld.transcripts_to_analyse(lines, first.filter("conversationId % 4 = 0"), tasks, 5, ["a", "b", "c"], lines_per_part=2)


CANDIDATES = """, tk AS (SELECT conversationId FROM lines GROUP BY 1 HAVING sum(quantity) > 60), sn AS (SELECT CAST(o_orderkey AS VARCHAR) AS conversationId FROM orders WHERE o_orderkey % 4 = 0),
  bs AS (SELECT last.*, cod.wrapUpCode AS codeName FROM last JOIN que ON que.queueId = last.queueId AND language = 'English' JOIN cod ON cod.wrapUpCodeId = last.wrapUpCode WHERE mediaType IN ('voice', 'callback') AND conversationId IN (SELECT conversationId FROM tk)),
  fl AS (SELECT *, row_number() OVER (PARTITION BY agentId ORDER BY segmentStart DESC, conversationId DESC) AS rn FROM bs WHERE codeName = 'Code 4' AND conversationId NOT IN (SELECT conversationId FROM sn)),
  dn AS (SELECT agentId, count(*) AS n FROM bs WHERE codeName = 'Code 4' AND conversationId IN (SELECT conversationId FROM sn) GROUP BY 1)"""


@query(
    "d46_transcript_candidates",
    with_(MART)
    + LAST
    + CANDIDATES
    + """ SELECT conversationId, agentId AS userId, 'sale' AS reason FROM bs WHERE codeName IN ('Code 0', 'Code 1') AND conversationId NOT IN (SELECT conversationId FROM sn)
       UNION ALL SELECT conversationId, fl.agentId, 'failure' FROM fl LEFT JOIN dn ON dn.agentId = fl.agentId WHERE rn <= 5 AND rn <= 5 - coalesce(n, 0)""",
)
def transcript_candidates(t):
    s = t.line_sessions()
    handled = cv.last_handled(s).select("conversationId", F.col("agentId").alias("userId"), "queueId", "wrapUpCode", "mediaType", F.col("segmentStart").alias("conversationStart"))
    talk = s.select("conversationId", F.col("quantity").alias("tTalkComplete"))
    analysed = t.orders.filter("o_orderkey % 4 = 0").select(F.col("o_orderkey").cast("string").alias("conversationId"))
    return ld.transcript_candidates(handled, talk, star.queues(t.part), star.wrap_up_codes(t.part), analysed, ["Code 0", "Code 1"], "Code 4")


@query(
    "d50_customer_sessions",
    with_(LINES) + "SELECT DISTINCT sessionId AS conversationId, sessionId || '-c' AS communicationId FROM lines WHERE taxPct >= 6 AND quantity % 2 = 0",
)
def customer_sessions(t):
    details = t.payloads()
    scored = evp.conversation_surveys(details).filter("oSurveyTotalScore % 4 = 0")
    return ld.customer_sessions(details, scored)


@query(
    "d45_handoff_audit",
    with_(TURNS, MART)
    + """, a AS (SELECT CAST(conversationId AS VARCHAR) AS conversationId, ((line - 1) // 2)::INTEGER AS part FROM turns WHERE conversationId % 4 <> 0 GROUP BY 1, 2, conversationId),
         b AS (SELECT conversationId, (['a', 'b', 'c'])[(row_number() OVER (ORDER BY CAST(conversationId AS BIGINT), part) - 1) % 3 + 1] AS region FROM a)
       SELECT DISTINCT b.conversationId, region, conversationStartDateId, TRUE AS isExported, '2024-02-01 06:00:00' AS exportedTimestamp FROM b JOIN oc ON oc.conversationId = b.conversationId""",
)
def handoff_audit(t):
    handed = transcript_handoff(t).withColumn("conversationId", F.col("conversationId").cast("string"))
    return ld.handoff_audit(handed, star.conversations(t.orders), "2024-02-01 06:00:00")


@query(
    "d50_not_analysed",
    """SELECT CAST(o_orderkey AS VARCHAR) AS conversationId FROM orders WHERE o_orderdate >= '1997-01-01' AND o_orderdate < '1998-01-01'
         AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def not_analysed(t):
    seen = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").cast("string").alias("conversationId"))
    orders = t.orders.select(F.col("o_orderkey").cast("string").alias("conversationId"), F.to_timestamp("o_orderdate").alias("extractedAt"))
    # every conversation was extracted twice
    return ld.not_analysed(orders.unionByName(orders), seen, "1997-01-01", "1998-01-01")


@query(
    "d34_users_info",
    with_(USERS)
    + """SELECT department, 'div-' || region AS divisionId, region AS divisionName, CASE WHEN userNo % 3 = 0 THEN '2020-05-01' ELSE coalesce(f, NULL) END AS hireDate, userId || '@x.com' AS email, userId, managerId, userName AS name, state
       FROM users LEFT JOIN (SELECT o_custkey, min(o_orderdate)::DATE::VARCHAR AS f FROM orders GROUP BY 1) ON o_custkey = userNo""",
)
def users_info(t):
    u = raw.users(t.customer, t.nation, t.region)
    division = F.struct(F.concat(F.lit("div-"), "region").alias("id"), F.col("region").alias("name"))
    hired = F.when(F.col("userNo") % 3 == 0, F.to_date(F.lit("2020-05-01")))
    email = F.concat("userId", F.lit("@x.com"))
    people = u.select(
        F.col("userId").alias("id"), F.col("userName").alias("name"), "department", "state", email.alias("email"), division.alias("division"),
        F.struct(F.col("managerId").alias("id")).alias("manager"), hired.alias("dateHire"),
    )
    seen = t.orders.select(F.concat(F.lit("u"), "o_custkey").alias("userId"), F.to_date("o_orderdate").alias("extractDate"))
    return db.users_info(people, seen)


@query(
    "d34_queue_lookup",
    "SELECT DISTINCT 'queue-' || n AS queueKey, 'Queue ' || n AS name, 'R' || (n % 4) AS region, 'C' || (n % 6) AS country FROM (SELECT p_partkey % 25 AS n FROM part WHERE p_partkey % 25 < 20)",
)
def queue_lookup(t):
    n = F.col("p_partkey") % 25
    mapping = t.part.filter(n < 20).select(F.concat(F.lit("Queue "), n).alias("queueName"), F.concat(F.lit("R"), n % 4).alias("region"), F.concat(F.lit("C"), n % 6).alias("country"))
    return db.queue_lookup(star.queues(t.part), mapping.distinct())
