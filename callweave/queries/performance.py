"""Document operators and campaign report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.operators import documents as dc
from callweave.operators import upserts as up
from callweave.plans import performance as pf
from callweave.queries.prelude import EVENTS, INTERVALS, LINES, USERS, with_
from callweave.queries.registry import query
from callweave.queries.stored import stored_side, stored_sql
from callweave.session import scratch_path
from callweave.sources import raw, star

ZONE = "Asia/Manila"


def campaign_docs(t):
    """Campaign documents: an order is a campaign with levels, teams, named users, KPIs and activities."""
    key, who = F.col("o_orderkey"), F.col("o_custkey")

    def level(n):
        return F.struct(F.lit(f"L{n}").alias("_id"), F.lit(n * 100).alias("start_points"), (F.lit(n * 100) + key % 50).alias("end_points"))

    def activity(n):
        return F.struct(
            F.concat(F.lit(f"act{n}-"), key % 7).alias("_id"), F.when(key % 2 == 0, "quiz").otherwise("conn").alias("entity"), F.lit(f"field{n}").alias("field")
        )

    kpi = F.struct(F.concat(F.lit("kpi "), who % 5).alias("name"), (key % 10).cast("double").alias("weight"), F.array(activity(1), activity(2)).alias("activities"))
    return t.orders.select(
        key.alias("_id"),
        F.concat(F.lit("Campaign "), key).alias("name"),
        F.concat(F.lit("ORG"), who % 3).alias("org_id"),
        F.col("o_orderdate").alias("start_date"),
        (F.col("o_orderdate") + F.expr("interval 20 hours")).alias("end_date"),
        (F.col("o_orderstatus") == "O").alias("is_active"),
        F.when(key % 3 != 0, F.array(level(1), level(2), level(3))).alias("levels"),
        F.array(kpi).alias("kpis"),
        F.struct(
            F.when(key % 2 == 0, F.array(F.struct(F.concat(F.lit("team-"), who).alias("team_id")))).alias("gd_teams"),
            F.array(F.struct(F.concat(F.lit("team-"), who % 9).alias("team_id"), (who + 1).alias("user_id"))).alias("gd_users"),
        ).alias("game_design"),
    )


def user_docs(t):
    """User documents: every user is in a team of its own, every third also leads the block team."""
    no = F.col("c_custkey")

    def job(team, role):
        return F.struct(F.concat(F.lit("team-"), team).alias("team_id"), F.lit(role).alias("role_id"))

    return t.customer.select(
        no.alias("_id"),
        F.concat(F.lit("u"), no).alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("ORG"), no % 3).alias("org_id"),
        F.when(no % 5 == 4, F.array(job(no, "Agent")).cast("array<struct<team_id:string,role_id:string>>"))
        .when(no % 5 == 3, F.lit(None).cast("array<struct<team_id:string,role_id:string>>"))
        .otherwise(F.array(job(no, "Agent"), job(F.floor(no / 10), "Team Lead")))
        .alias("works_for"),
        (F.col("c_acctbal") < 0).alias("is_deleted"),
        (F.col("c_nationkey") % 2 == 0).alias("is_active"),
    )


def outcome_docs(t):
    s = t.line_sessions()
    return s.select(
        F.col("conversationId").cast("long").alias("campaign_id"),
        F.col("agentId").alias("user_id"),
        F.concat(F.lit("act"), F.col("lineNumber")).alias("outcome_id"),
        F.when(F.col("returnFlag") == "R", "badge").otherwise("points").alias("outcome_type"),
        F.col("quantity").alias("outcome_quantity"),
        F.col("mediaType").alias("field_name"),
        F.col("discountPct").cast("double").alias("field_value"),
        F.col("segmentStart").alias("creation_date"),
        F.when(F.col("taxPct") > 5, F.col("segmentEnd") + F.expr("interval 3 years")).alias("last_updated"),
        F.concat(F.lit("ORG"), F.col("lineNumber") % 3).alias("org_id"),
        F.concat(F.lit("L"), F.col("lineNumber") % 4).alias("level_id"),
        (F.col("lineNumber") % 4).alias("level_no"),
        F.col("segmentEnd").alias("achieved_date"),
    )


def local(ts, fmt="%Y-%m-%d", zone=ZONE):
    return f"strftime(({ts} AT TIME ZONE 'UTC') AT TIME ZONE '{zone}', '{fmt}')"


@query("g1_match", "SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR o_orderpriority IN ('1-URGENT', '2-HIGH')) AND o_orderdate >= '1998-01-01' AND o_orderdate < '1999-01-01'")
def match(t):
    hit = (F.col("o_orderstatus") == "F") | F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return dc.since(t.orders.filter(hit), "1998-01-01", "o_orderdate").filter("o_orderdate < '1999-01-01'").select("o_orderkey")


@query(
    "g2_project_paths",
    "SELECT o_orderkey AS campaignId, 'kpi ' || (o_custkey % 5) AS firstKpi, 'team-' || (o_custkey % 9) AS firstTeam FROM orders",
)
def project_paths(t):
    return dc.project(
        campaign_docs(t), {"campaignId": "_id", "firstKpi": F.get("kpis.name", F.lit(0)), "firstTeam": F.get("game_design.gd_users.team_id", F.lit(0))}
    )


@query(
    "g3_unwind",
    """SELECT o_orderkey AS campaignId, 'L' || n AS levelId, 'dropped' AS kind FROM orders, (VALUES (1), (2), (3)) v(n) WHERE o_orderkey % 3 <> 0
       UNION ALL SELECT o_orderkey, 'L' || n, 'kept' FROM orders, (VALUES (1), (2), (3)) v(n) WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, NULL, 'kept' FROM orders WHERE o_orderkey % 3 = 0""",
)
def unwind(t):
    docs = campaign_docs(t).select("_id", "levels")

    def rows(kind, keep):
        return dc.unwind(docs, "levels", "l", keep_empty=keep).select(F.col("_id").alias("campaignId"), F.col("l._id").alias("levelId"), F.lit(kind).alias("kind"))

    return rows("dropped", False).unionByName(rows("kept", True))


@query(
    "g4_lookup",
    """SELECT o_orderkey, l_partkey, n FROM orders LEFT JOIN (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_quantity > 30) l ON l_orderkey = o_orderkey
       LEFT JOIN (SELECT l_orderkey AS k, count(*) AS c FROM lineitem WHERE l_quantity > 30 GROUP BY 1) ON k = o_orderkey, LATERAL (SELECT coalesce(c, 0) AS n)""",
)
def lookup(t):
    big = t.lineitem.filter("l_quantity > 30").select("l_orderkey", "l_partkey")
    sized = dc.lookup_size(t.orders.select("o_orderkey"), big, {"o_orderkey": "l_orderkey"}, "n")
    return dc.lookup(sized, big, {"o_orderkey": "l_orderkey"}, {"l_partkey": "l_partkey"})


@query(
    "g5_dates_in_zone",
    f"""SELECT event_id, {local("ts")} AS localDay, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS parsed, date_trunc('millisecond', ts)::VARCHAR AS fromMillis FROM events""",
)
def dates_in_zone(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        dc.zone_text(ts, ZONE).alias("localDay"),
        F.date_format(dc.text_time(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.000'Z'")), "yyyy-MM-dd HH:mm:ss").alias("parsed"),
        dc.millis_time(F.unix_millis(ts)).alias("fromMillis"),
    )


@query(
    "g6_conditions",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Accepted' ELSE 'Thrown' END AS status, CASE WHEN o_totalprice > 200000 THEN o_orderpriority ELSE 'none' END AS shown FROM orders",
)
def conditions(t):
    s = F.col("o_orderstatus")
    shown = F.when(F.col("o_totalprice") > 200000, F.col("o_orderpriority"))
    return t.orders.select(
        "o_orderkey", F.when(s == "F", "Completed").when(s == "O", "Accepted").otherwise("Thrown").alias("status"), F.coalesce(shown, F.lit("none")).alias("shown")
    )


@query(
    "g7_array_operations",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN 2 ELSE 0 END::INTEGER AS high, CASE WHEN o_orderkey % 3 <> 0 THEN 'L1,L2,L3,X' ELSE 'X' END AS ids, o_orderkey % 3 <> 0 AS hasL2 FROM orders""",
)
def array_operations(t):
    empty = F.array().cast("array<struct<_id:string,start_points:int,end_points:bigint>>")
    lv = F.coalesce("levels", empty)
    return campaign_docs(t).select(
        F.col("_id").alias("o_orderkey"),
        F.size(F.filter(lv, lambda x: x["start_points"] >= 200)).alias("high"),
        F.concat_ws(",", F.concat(F.transform(lv, lambda x: x["_id"]), F.array(F.lit("X")))).alias("ids"),
        F.array_contains(F.transform(lv, lambda x: x["_id"]), "L2").alias("hasL2"),
    )


@query("g8_object_entries", with_(EVENTS) + "SELECT eventId, 'k' AS k, CAST(k AS BIGINT) AS v FROM ev UNION ALL SELECT eventId, 'cents', cents FROM ev")
def object_entries(t):
    e = raw.event_rows(t.events)
    return dc.entries(e.withColumn("o", F.map_concat(raw.props_map(), F.create_map(F.lit("cents"), "cents"))), ["eventId"], "o")


MEMBERS = """mem AS (SELECT o_orderkey AS campaignId, 'org' || (o_custkey % 3) AS orgId, 'team-' || (o_custkey % 9) AS teamId, o_custkey + 1 AS userId FROM orders
  UNION ALL SELECT o_orderkey, 'org' || (o_custkey % 3), 'team-' || o_custkey, w.userId FROM orders LEFT JOIN (
    SELECT c_custkey AS userId, 'team-' || c_custkey AS team FROM customer WHERE c_custkey % 5 <> 3 UNION ALL SELECT c_custkey, 'team-' || (c_custkey // 10) FROM customer WHERE c_custkey % 5 < 3) w ON w.team = 'team-' || o_custkey
  WHERE o_orderkey % 2 = 0)"""


@query("g9_facet", with_(MEMBERS) + "SELECT * FROM mem")
def facet(t):
    return pf.user_campaigns(campaign_docs(t), user_docs(t))


@query("g10_millis_arithmetic", with_(EVENTS) + "SELECT eventId, (ts + INTERVAL 8 HOUR)::VARCHAR AS localTime FROM ev")
def millis_arithmetic(t):
    e = raw.event_rows(t.events)
    return e.select("eventId", dc.millis_time(F.unix_millis("ts"), 8 * 3600 * 1000).alias("localTime"))


@query(
    "d38_users",
    """WITH w AS (SELECT c_custkey, 'team-' || c_custkey AS teamId, 'Agent' AS roleId FROM customer WHERE c_custkey % 5 <> 3 UNION ALL SELECT c_custkey, 'team-' || (c_custkey // 10), 'Team Lead' FROM customer WHERE c_custkey % 5 < 3
         UNION ALL SELECT c_custkey, NULL, NULL FROM customer WHERE c_custkey % 5 = 3)
       SELECT c.c_custkey AS mongoUserId, 'u' || c.c_custkey AS userId, c_name AS name, teamId, roleId, CASE WHEN c_acctbal < 0 THEN 'Deleted' WHEN c_nationkey % 2 = 0 THEN 'Active' ELSE 'Inactive' END AS status, 'org' || (c.c_custkey % 3) AS orgId
       FROM customer c JOIN w ON w.c_custkey = c.c_custkey""",
)
def users(t):
    return pf.users(user_docs(t))


@query(
    "d38_campaigns",
    f"""SELECT o_orderkey AS campaignId, 'Campaign ' || o_orderkey AS name, {local("o_orderdate")} AS start_date, {local("(o_orderdate + INTERVAL 20 HOUR)")} AS endDate, o_orderstatus = 'O' AS isActive, 'org' || (o_custkey % 3) AS orgId FROM orders""",
)
def campaigns(t):
    return pf.campaigns(campaign_docs(t), ZONE)


@query("d38_user_campaigns", stored_sql(with_(MEMBERS), "SELECT * FROM mem", "orgId", "'old-' || orgId", {"userId": "-1"}))
def user_campaigns(t):
    fresh = pf.user_campaigns(campaign_docs(t), user_docs(t))
    stored = stored_side(fresh, "orgId", F.concat(F.lit("old-"), "orgId"), {"userId": -1})
    return up.replace_matching(stored, fresh, ["orgId"])


@query("d38_campaign_kpis", "SELECT o_orderkey AS campaignId, 'kpi ' || (o_custkey % 5) AS kpiName, CAST(o_orderkey % 10 AS DOUBLE) AS kpiWeight, 'org' || (o_custkey % 3) AS orgId FROM orders")
def campaign_kpis(t):
    return pf.campaign_kpis(campaign_docs(t))


ACTIVITIES = """act AS (SELECT o_orderkey AS campaignId, 'kpi ' || (o_custkey % 5) AS kpiName, 'act' || n || '-' || (o_orderkey % 7) AS activityId, CASE WHEN o_orderkey % 2 = 0 THEN 'quiz' ELSE 'conn' END AS entityName, 'field' || n AS fieldName, 'org' || (o_custkey % 3) AS orgId
  FROM orders, (VALUES (1), (2)) v(n))"""


@query("d38_campaign_activities", with_(ACTIVITIES) + "SELECT * FROM act")
def campaign_activities(t):
    return pf.campaign_activities(campaign_docs(t))


@query("d38_activity_mapping", with_(ACTIVITIES) + "SELECT DISTINCT activityId, entityName, fieldName, orgId FROM act")
def activity_mapping(t):
    return pf.activity_mapping(campaign_docs(t))


LEVELS = """lv AS (SELECT o_orderkey AS campaignId, 'Campaign ' || o_orderkey AS campaignName, 'L' || n AS levelId, (n * 100)::INTEGER AS levelStartPoints, CAST(n * 100 + o_orderkey % 50 AS BIGINT) AS levelEndPoints, 'org' || (o_custkey % 3) AS orgId,
   agentId AS userId, (lineNumber % 4)::INTEGER AS levelNumber, segmentEnd::VARCHAR AS achievedDate
  FROM orders CROSS JOIN (VALUES (1), (2), (3)) v(n) JOIN lines ON lines.conversationId = CAST(o_orderkey AS VARCHAR) AND lineNumber % 4 = n WHERE o_orderkey % 3 <> 0 AND segmentEnd >= '1998-01-01')"""


@query("d38_levels", with_(LINES, LEVELS) + "SELECT * FROM lv")
def levels(t):
    return pf.levels(campaign_docs(t), outcome_docs(t), "1998-01-01")


def _points_sql(kind):
    flag = "= 'R'" if kind == "badge" else "<> 'R'"
    return with_(LINES) + f"""SELECT CAST(conversationId AS BIGINT) AS campaignId, 'act' || lineNumber AS activityId, agentId AS userId, quantity AS points, '{kind}' AS outcomeType, mediaType AS fieldName, discountPct::DOUBLE AS fieldValue,
      {local("segmentStart")} AS date, 'org' || (lineNumber % 3) AS orgId FROM lines WHERE returnFlag {flag} AND (segmentStart >= '2000-06-01' OR (taxPct > 5 AND segmentEnd + INTERVAL 3 YEAR >= '2000-06-01'))"""


@query("d38_points", _points_sql("points"))
def points(t):
    return pf.outcome_points(outcome_docs(t), "points", "2000-06-01", ZONE)


@query(
    "d38_badges",
    with_(LINES) + f"SELECT DISTINCT CAST(conversationId AS BIGINT) AS campaignId, agentId AS userId, 'act' || lineNumber AS badgeId, {local('segmentStart')} AS dateAwarded, 'org' || (lineNumber % 3) AS orgId FROM lines WHERE returnFlag = 'R'",
)
def badges(t):
    return pf.badges(outcome_docs(t), ZONE)


@query(
    "d38_challenges",
    f"""SELECT o_orderkey AS campaignId, 'challenge ' || (o_custkey % 4) AS challengeName, o_custkey AS challengerId, o_custkey + 1 AS challengeeId, {local("o_orderdate")} AS challengeThrownDate,
        CASE WHEN o_orderstatus <> 'P' THEN {local("(o_orderdate + INTERVAL 17 HOUR)")} END AS challengeAcceptanceDate, CASE WHEN o_orderstatus = 'F' THEN {local("(o_orderdate + INTERVAL 40 HOUR)")} END AS challengeCompletionDate,
        CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Accepted' ELSE 'Thrown' END AS status, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 9 ELSE 1 END AS noOfDays, 'org' || (o_custkey % 3) AS orgId FROM orders""",
)
def challenges(t):
    d, s = F.col("o_orderdate"), F.col("o_orderstatus")
    docs = t.orders.select(
        F.col("o_orderkey").alias("campaign_id"),
        F.concat(F.lit("challenge "), F.col("o_custkey") % 4).alias("name"),
        F.col("o_custkey").alias("challenger"),
        (F.col("o_custkey") + 1).alias("challengee"),
        d.alias("thrown_at"),
        F.when(s != "P", d + F.expr("interval 17 hours")).alias("accepted_at"),
        F.when(s == "F", d + F.expr("interval 40 hours")).alias("completed_at"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 9).alias("days"),
        F.concat(F.lit("ORG"), F.col("o_custkey") % 3).alias("org_id"),
    )
    return pf.challenges(docs, ZONE)


def quiz_docs(t):
    """Quiz attempts from events: k mod 4 answers, an answer is right when its number divides k."""
    e = raw.event_rows(t.events)
    k = F.col("k")
    one = F.transform(
        F.sequence(F.lit(1), F.lit(3)),
        lambda i: F.struct(F.concat(F.lit("q"), i.cast("string")).alias("question_id"), F.concat(F.lit('say "'), i.cast("string"), F.lit('"\n'), F.col("eventType")).alias("text"), (k % i == 0).alias("correct")),
    )
    return e.select(
        F.concat(F.lit("quiz"), k % 8).alias("quiz_id"), F.col("userId").alias("user_id"), F.col("ts").alias("answered_at"), F.slice(one, F.lit(1), k % 4).alias("answers"), F.concat(F.lit("ORG"), F.col("userNo") % 3).alias("org_id")
    )


@query(
    "d38_quizzes",
    with_(EVENTS)
    + f""", a AS (SELECT *, k % 4 AS n, (CASE WHEN k % 4 >= 1 THEN 1 ELSE 0 END) + (CASE WHEN k % 4 >= 2 AND k % 2 = 0 THEN 1 ELSE 0 END) + (CASE WHEN k % 4 >= 3 AND k % 3 = 0 THEN 1 ELSE 0 END) AS ok FROM ev),
        b AS (SELECT *, CASE WHEN n > 0 THEN round(ok * 100.0::DOUBLE / n, 2) END AS pct FROM a)
       SELECT 'quiz' || (k % 8) AS quizId, userId, {local("ts")} AS answeredDate, ok::DOUBLE AS noOfCorrectQuestions, n::DOUBLE AS totalQuestions, pct AS quizPercentageScore,
         CASE WHEN n = 0 THEN 'Pending' WHEN pct >= 80 THEN 'Passed' ELSE 'Failed' END AS quizStatus, 'org' || (userNo % 3) AS orgId FROM b""",
)
def quizzes(t):
    return pf.quizzes(quiz_docs(t), ZONE)


@query(
    "d38_questions",
    with_(EVENTS)
    + """, a AS (SELECT *, i FROM ev, LATERAL (SELECT unnest(range(1, k % 4 + 1)) AS i))
       SELECT 'quiz' || (k % 8) AS quizId, 'q' || i AS questionId, 'say ' || ' ' || i || ' ' || eventType AS question, 'org' || (userNo % 3) AS orgId FROM a
       QUALIFY row_number() OVER (PARTITION BY k % 8, i, userNo % 3 ORDER BY ts DESC, userId DESC, eventType) = 1""",
)
def questions(t):
    return pf.questions(quiz_docs(t))


def reward_docs(t):
    s = t.line_sessions()

    def reward(kind, amount):
        return F.struct(F.lit(kind).alias("type"), amount.alias("amount"), F.col("segmentEnd").alias("given_at"))

    return s.select(
        F.col("agentId").alias("user_id"), F.array(reward("points", F.col("quantity")), reward("voucher", F.col("quantity") * 2)).alias("rewards"), F.concat(F.lit("ORG"), F.col("lineNumber") % 3).alias("org_id")
    )


@query(
    "d38_rewards",
    with_(LINES) + f"SELECT agentId AS userId, CASE n WHEN 1 THEN 'points' ELSE 'voucher' END AS rewardType, quantity * n AS amount, {local('segmentEnd')} AS date, 'org' || (lineNumber % 3) AS orgId FROM lines, (VALUES (1), (2)) v(n)",
)
def rewards(t):
    return pf.rewards(reward_docs(t), ZONE)


@query("d38_vouchers", with_(LINES) + f"SELECT agentId AS userId, -(quantity * 2) AS points, {local('segmentEnd')} AS date, 'org' || (lineNumber % 3) AS orgId FROM lines")
def vouchers(t):
    return pf.vouchers(reward_docs(t), ZONE)


@query(
    "d38_announcements",
    """SELECT o_orderkey AS announcementId, o_custkey AS senderId, CASE WHEN o_custkey % 2 = 0 THEN 2 ELSE 3 END::INTEGER AS recipients, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END::INTEGER AS readers, o_orderkey % 2 = 1 AS readBySender,
        'org' || (o_custkey % 3) AS orgId, c_name AS senderName FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def announcements(t):
    who = F.col("o_custkey")
    docs = t.orders.select(
        F.col("o_orderkey").alias("_id"),
        who.alias("sender"),
        F.array(who + 1, who + 2).alias("to_users"),
        F.when(who % 2 == 0, F.array(who + 1)).otherwise(F.array(who + 3)).alias("to_leads"),
        F.when(F.col("o_orderkey") % 2 == 0, F.array(who + 1, who + 99)).otherwise(F.array(who)).alias("read_by"),
        F.concat(F.lit("ORG"), who % 3).alias("org_id"),
    )
    return pf.announcements(docs, user_docs(t))


def upload_docs(t):
    e = raw.event_rows(t.events)
    attributes = F.array(
        F.struct(F.lit("aht").alias("dictionary_key"), F.lit("AHT").alias("display_name"), F.lit(True).alias("is_kpi")),
        F.struct(F.col("eventType").alias("dictionary_key"), F.upper("eventType").alias("display_name"), F.lit(False).alias("is_kpi")),
    )
    return e.select(
        F.col("eventId").alias("_id"), F.concat(F.lit("conn "), F.col("k") % 5).alias("connection"), F.col("cents").alias("row_count"), F.when(F.col("k") % 2 == 0, F.col("k")).alias("failed_count"),
        F.col("ts").alias("uploaded_at"), attributes.alias("attributes"), F.concat(F.lit("ORG"), F.col("userNo") % 3).alias("org_id"),
    )


@query(
    "d38_upload_audit",
    with_(EVENTS) + f"SELECT eventId AS uploadId, 'conn ' || (k % 5) AS connectionName, cents AS rows, CASE WHEN k % 2 = 0 THEN k ELSE 0 END AS failed, {local('ts', '%Y-%m-%d %H:%M:%S')} AS uploadedAt, 'org' || (userNo % 3) AS orgId FROM ev",
)
def upload_audit(t):
    return pf.upload_audit(upload_docs(t), ZONE)


@query(
    "d38_upload_connections",
    with_(EVENTS)
    + """SELECT DISTINCT 'conn ' || (k % 5) AS connectionName, 'aht' AS dictionaryKey, 'AHT' AS displayName, TRUE AS isKpi, 'org' || (userNo % 3) AS orgId FROM ev
         UNION SELECT DISTINCT 'conn ' || (k % 5), eventType, upper(eventType), FALSE, 'org' || (userNo % 3) FROM ev""",
)
def upload_connections(t):
    return pf.upload_connections(upload_docs(t))


@query(
    "d39_coaching_journeys",
    with_(EVENTS)
    + f""", ld AS (SELECT 'team-' || (c_custkey // 10) AS team, c_name FROM customer WHERE c_custkey % 5 < 3),
       sq AS (SELECT eventId, i FROM ev, LATERAL (SELECT unnest(CASE WHEN k % 3 = 0 THEN [NULL] ELSE range(1, k % 3 + 1) END) AS i)),
       fb AS (SELECT eventId, i AS j FROM ev, LATERAL (SELECT unnest(CASE WHEN k % 2 = 0 THEN [NULL] ELSE [1] END) AS i))
      SELECT ev.eventId AS journeyId, userId AS agentId, c_name AS teamLeadName, eventType AS state, {local("ts", "%Y-%m-%d %H:%M:%S")} AS discoveryStart, CASE WHEN k > 50 THEN 'done' ELSE 'open' END AS lmsState, 'sq' || i AS surveyQuestion,
        'sa' || (i * k) AS surveyAnswer, CASE WHEN j IS NOT NULL THEN 'fb ' || k END AS feedback, 'org' || (userNo % 3) AS orgId
      FROM ev JOIN ld ON team = 'team-' || (userNo // 10) JOIN sq ON sq.eventId = ev.eventId JOIN fb ON fb.eventId = ev.eventId WHERE ts >= '2024-01-05'""",
)
def coaching_journeys(t):
    e = raw.event_rows(t.events)
    k = F.col("k")
    survey = F.transform(F.sequence(F.lit(1), F.lit(2)), lambda i: F.struct(F.concat(F.lit("sq"), i.cast("string")).alias("question"), F.concat(F.lit("sa"), (i * k).cast("string")).alias("answer")))
    docs = e.select(
        F.col("eventId").alias("_id"),
        F.col("userId").alias("agent_id"),
        F.concat(F.lit("team-"), F.floor(F.col("userNo") / 10)).alias("team_id"),
        F.col("eventType").alias("state"),
        F.struct(F.col("ts").alias("start"), F.slice(survey, F.lit(1), k % 3).alias("survey")).alias("discovery"),
        F.struct(F.struct(F.when(k > 50, "done").otherwise("open").alias("state")).alias("lms")).alias("action"),
        F.when(k % 2 == 1, F.array(F.struct(F.concat(F.lit("fb "), k).alias("text")))).alias("feedback"),
        F.col("ts").alias("updated_at"),
        F.concat(F.lit("ORG"), F.col("userNo") % 3).alias("org_id"),
    )
    return pf.coaching_journeys(docs, user_docs(t), ZONE, "2024-01-05")


def _journey_sql():
    def told(seconds):
        return f"strftime(((ts + INTERVAL {seconds} SECOND) AT TIME ZONE 'UTC') AT TIME ZONE '{ZONE}', '%Y-%m-%dT%H:%M:%SZ')"

    acts = []
    for i, (kind, label) in enumerate(pf.ACTIONS.items()):
        there = f"(ev.eventId + {i}) % 4 <> 0"
        acts += [f"CASE WHEN {there} THEN {told(100 * i)} END AS action{label}Start", f"CASE WHEN {there} AND k % 2 = 0 THEN {told(100 * i + 50)} END AS action{label}End"]
        acts += [f"CASE WHEN {there} THEN 'http://host/' || ev.eventId || '/{kind}' END AS action{label}Link", f"CASE WHEN {there} THEN CASE WHEN k > 50 THEN 'done' ELSE 'open' END END AS action{label}State"]
        acts += [f"(k + {i})::DOUBLE AS score{label}"]
    return f"""SELECT DISTINCT ev.eventId::VARCHAR AS trek_id, team AS team_id, userId AS agent_id, 'lead-' || (k % 7) AS team_leader_id, 'kpi-' || (k % 5) AS kpi_id, 'camp-' || (k % 3) AS campaign_id, 'KPI ' || (k % 5) AS kpi_name,
        eventType AS trek_global_state, CASE WHEN k > 50 THEN 'true' ELSE 'false' END AS action_complete, (k % 2)::VARCHAR AS feedback_given, NULL::VARCHAR AS action_start, NULL::VARCHAR AS discovery_complete, NULL::VARCHAR AS discovery_start,
        NULL::VARCHAR AS action_completed, {told(0)} AS trek_date, {told(5)} AS discoveryStart, {told(15)} AS discoveryEnd, {", ".join(acts)}, NULL::VARCHAR AS actionActionState,
        CASE WHEN k % 2 = 0 THEN 'active' ELSE 'closed' END AS actionState, k::DOUBLE AS actionGoalTarget, 'org' || (userNo % 3) AS orgId,
        'sq' || i AS Survey_question, CASE WHEN i = 1 THEN k::VARCHAR WHEN i > 1 THEN 'v' || k END AS Survey_value, i::DOUBLE AS Survey_score, CASE WHEN i IS NOT NULL THEN 'radio' END AS Survey_type,
        CASE WHEN k % 2 = 1 THEN 'how' END AS Feedback_question, CASE WHEN k % 2 = 1 THEN 'fb ' || k END AS Feedback_answer, CASE WHEN k % 2 = 1 THEN k::DOUBLE END AS Feedback_value, c_name AS teamlead_name
      FROM ev JOIN ld ON team = 'team-' || (userNo // 10) JOIN sq ON sq.eventId = ev.eventId WHERE ts + INTERVAL 20 SECOND >= '2024-01-05' AND k % 40 <> 39"""


@query(
    "d39_coaching_documents",
    with_(EVENTS)
    + """, ld AS (SELECT 'team-' || (c_custkey // 10) AS team, c_name FROM customer WHERE c_custkey % 5 < 3),
       sq AS (SELECT eventId, i FROM ev, LATERAL (SELECT unnest(CASE WHEN k % 3 = 0 THEN [NULL] ELSE range(1, k % 3 + 1) END) AS i)) """
    + _journey_sql(),
)
def coaching_documents(t):
    leads = user_docs(t).select(F.explode("works_for").alias("w"), "name").filter("w.role_id = 'Team Lead'").select(F.col("w.team_id").alias("team"), F.col("name").alias("teamlead_name"))
    return pf.coaching_documents(raw.journey_texts(t.events), leads, ZONE, "2024-01-05")


SHIFTS = """, p AS (SELECT userId, startTime AS s, startTime + to_seconds(k * 600) AS e, k * 600 // 3600 AS h FROM iv WHERE status IN ('error', 'click') AND k * 600 // 3600 > 4),
  z AS (SELECT p.*, timeZone, lag(e) OVER (PARTITION BY p.userId ORDER BY s, e) AS pe FROM p JOIN users ON users.userId = p.userId),
  sh AS (SELECT userId, coalesce(CASE WHEN pe IS NULL AND h > 12 THEN ((s - INTERVAL 12 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE timeZone END, (pe AT TIME ZONE 'UTC') AT TIME ZONE timeZone) AS loginTime, (s AT TIME ZONE 'UTC') AT TIME ZONE timeZone AS logoutTime FROM z)"""


def _shifts(t):
    zones = raw.users(t.customer, t.nation, t.region)
    offline = raw.status_intervals(t.events, 600).filter("status in ('error', 'click')")
    presence = offline.select("userId", "startTime", "endTime", F.lit("OFFLINE").alias("systemPresence"))
    return pf.attendance_from_presence(presence, zones)


@query(
    "d41_attendance_from_presence",
    stored_sql(
        with_(INTERVALS, USERS) + SHIFTS,
        "SELECT userId, TRUE AS isPresent, loginTime::VARCHAR AS loginTime, logoutTime::VARCHAR AS logoutTime, CAST(logoutTime AS DATE)::VARCHAR AS reportDate FROM sh",
        "userId", "'old-' || userId", {"isPresent": "FALSE"},
    ),
)
def attendance_from_presence(t):
    fresh = _shifts(t)
    stored = stored_side(fresh, "userId", F.concat(F.lit("old-"), "userId"), {"isPresent": False})
    return up.merge_all(stored, fresh, ["userId", "loginTime", "logoutTime"], check=False)


@query(
    "d41_attendance_from_kpis",
    with_(EVENTS)
    + """SELECT userId, CAST(ts AS DATE)::VARCHAR AS reportDate, 'org' || (userNo % 3) AS orgId, count(CASE WHEN k > 50 THEN 1 END) > 0 AS isPresent, CAST(CAST(ts AS DATE) AS TIMESTAMP)::VARCHAR AS loginTime, (CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 8 HOUR)::VARCHAR AS logoutTime
         FROM ev GROUP BY userId, CAST(ts AS DATE), userNo""",
)
def attendance_from_kpis(t):
    e = raw.event_rows(t.events)
    return pf.attendance_from_kpis(
        e.select("userId", F.to_date("ts").alias("reportDate"), F.concat(F.lit("org"), F.col("userNo") % 3).alias("orgId"), F.when(F.col("k") > 50, F.col("cents")).alias("attr_value"))
    )


@query(
    "d41_logins_by_shift",
    with_(INTERVALS, USERS)
    + SHIFTS
    + """, l AS (SELECT eventId, userId, ts, k FROM ev WHERE eventType = 'signup'),
        m AS (SELECT eventId, min(loginTime) AS st FROM l JOIN sh ON sh.userId = l.userId AND l.ts BETWEEN loginTime AND logoutTime GROUP BY 1)
       SELECT userId, CAST(coalesce(st, ts) AS DATE)::VARCHAR AS date, sum(k)::BIGINT AS loginAttempt FROM l LEFT JOIN m ON m.eventId = l.eventId GROUP BY 1, 2""",
)
def logins_by_shift(t):
    logins = raw.event_rows(t.events).filter("eventType = 'signup'").select(
        F.col("eventId").alias("loginId"), "userId", F.col("ts").alias("loginAt"), F.col("k").alias("loginAttempt")
    )
    return pf.logins_by_shift(logins, _shifts(t))


@query("d48_points_as_badges", _points_sql("badge"))
def points_as_badges(t):
    return pf.outcome_points(outcome_docs(t), "badge", "2000-06-01", ZONE)


@query(
    "d48_levels_highest",
    with_(LINES, LEVELS) + "SELECT campaignId, userId, max(levelNumber) AS levelNumber, arg_max(levelStartPoints, levelNumber) AS levelStartPoints FROM lv GROUP BY 1, 2",
)
def levels_highest(t):
    rows = pf.levels(campaign_docs(t), outcome_docs(t), "1998-01-01")
    return rows.groupBy("campaignId", "userId").agg(
        F.max("levelNumber").alias("levelNumber"), F.max_by("levelStartPoints", "levelNumber").alias("levelStartPoints")
    )


@query(
    "d48_raw_kpis",
    with_(EVENTS)
    + """, d AS (SELECT 'camp-' || (k % 3) AS campaignId, eventType AS kpi, 'Outcome ' || (k % 4) AS outcomeName, (k % 4)::VARCHAR AS outcomeId, userId, CAST(ts AS DATE)::VARCHAR AS date, k::FLOAT AS value, 'org' || (userNo % 3) AS orgId FROM ev WHERE k % 10 <> 0)
       SELECT DISTINCT * FROM d WHERE date >= '2024-01-10' UNION ALL (SELECT DISTINCT * REPLACE (-1::FLOAT AS value) FROM d WHERE date < '2024-01-10')""",
)
def raw_kpis(t):
    e = raw.event_rows(t.events)
    path = scratch_path(t.spark, "raw-kpis")
    rows = e.select(
        F.concat(F.lit("camp-"), F.col("k") % 3).alias("campaign_id"), F.col("eventType").alias("kpi"), F.concat(F.lit("Outcome "), F.col("k") % 4).alias("outcome_name"), (F.col("k") % 4).cast("string").alias("outcome_id"),
        F.col("userId").alias("user_id"), F.date_format("ts", "yyyy-MM-dd").alias("date"), F.when(F.col("k") % 10 != 0, F.col("k").cast("string")).alias("value"), F.concat(F.lit("ORG"), F.col("userNo") % 3).alias("org"),
    )
    every = pf.raw_kpis(rows, F.col("org"))
    # stored: a first delivery of all days; the next one replaces the days it holds
    up.replace_partitions(every.withColumn("value", F.lit(-1).cast("float")).distinct(), path, ["orgId", "date"])
    up.replace_partitions(every.filter("date >= '2024-01-10'"), path, ["orgId", "date"])
    return t.spark.read.schema(every.schema).parquet(path)
