"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.functions import text as tx
from callweave.operators import joins as jn
from callweave.operators import ordered
from callweave.queries.prelude import EVENTS, INTERVALS, TURNS, USERS, with_
from callweave.queries.registry import query
from callweave.sources import raw


@query(
    "j1_inner_join",
    "SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'",
)
def inner_join(t):
    o = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(o, "l_orderkey")


@query(
    "j2_left_lookup",
    """SELECT c_custkey, n_name AS groupName FROM customer LEFT JOIN
         (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey""",
)
def left_lookup(t):
    n = t.nation.filter("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("groupName"))
    return t.customer.select("c_custkey", "c_nationkey").join(n, "c_nationkey", "left").select("c_custkey", "groupName")


@query(
    "j3_self_join_manager",
    with_(USERS)
    + "SELECT u.userId, u.userName, m.userName AS managerName FROM users u LEFT JOIN users m ON u.managerId = m.userId",
)
def self_join_manager(t):
    u = raw.users(t.customer, t.nation, t.region)
    m = u.select(F.col("userId").alias("managerId"), F.col("userName").alias("managerName"))
    return u.select("userId", "userName", "managerId").join(m, "managerId", "left").select("userId", "userName", "managerName")


@query(
    "j3_managers",
    with_(USERS) + "SELECT DISTINCT m.userId, m.userName FROM users u JOIN users m ON u.managerId = m.userId",
)
def managers(t):
    u = raw.users(t.customer, t.nation, t.region)
    ids = u.select(F.col("managerId").alias("userId")).distinct()
    return u.select("userId", "userName").join(ids, "userId", "left_semi")


CHAIN = """, v AS (SELECT userId, CAST(ts AS DATE) AS day, count(*) AS views FROM ev WHERE eventType = 'view' GROUP BY 1, 2),
  p AS (SELECT userId, CAST(ts AS DATE) AS day, sum(cents)::BIGINT AS sales FROM ev WHERE eventType = 'purchase' GROUP BY 1, 2),
  e AS (SELECT userId, CAST(ts AS DATE) AS day, max(k) AS worst FROM ev WHERE eventType = 'error' GROUP BY 1, 2)"""


@query(
    "j4_full_outer_chain",
    with_(EVENTS)
    + CHAIN
    + """ SELECT coalesce(v.userId, p.userId, e.userId) AS userId, coalesce(v.day, p.day, e.day)::VARCHAR AS day, views, sales, worst
        FROM v FULL JOIN p ON v.userId = p.userId AND v.day = p.day
        FULL JOIN e ON coalesce(v.userId, p.userId) = e.userId AND coalesce(v.day, p.day) = e.day""",
)
def full_outer_chain(t):
    e = raw.event_rows(t.events).withColumn("day", F.to_date("ts"))

    def part(kind, agg):
        return e.filter(F.col("eventType") == kind).groupBy("userId", "day").agg(agg)

    return jn.outer_chain(
        [
            part("view", F.count(F.lit(1)).alias("views")),
            part("purchase", F.sum("cents").alias("sales")),
            part("error", F.max("k").alias("worst")),
        ],
        ["userId", "day"],
    )


@query(
    "j5_dense_grid",
    with_(EVENTS)
    + """, grid AS (SELECT userId, CAST(unnest(range(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day
           FROM (SELECT DISTINCT userId FROM ev)),
         f AS (SELECT userId, CAST(ts AS DATE) AS day, count(*) AS n, sum(cents)::BIGINT AS cents FROM ev GROUP BY 1, 2)
       SELECT grid.userId, grid.day::VARCHAR AS day, coalesce(n, 0) AS n, cents FROM grid LEFT JOIN f ON f.userId = grid.userId AND f.day = grid.day""",
)
def dense_grid(t):
    e = raw.event_rows(t.events)
    facts = e.groupBy("userId", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")
    )
    grid = jn.day_spine(
        e.select("userId").distinct(), F.to_date(F.lit("2024-01-01")), F.to_date(F.lit("2024-01-30"))
    )
    return grid.join(facts, ["userId", "day"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


@query(
    "j6_point_in_interval",
    with_(INTERVALS)
    + """SELECT a.eventId, b.eventId AS spanId, b.status FROM iv a JOIN iv b ON a.userId = b.userId
         AND a.startTime BETWEEN b.startTime AND b.endTime WHERE b.status = 'purchase'""",
)
def point_in_interval(t):
    iv = raw.status_intervals(t.events)
    points = iv.select("eventId", "userId", F.col("startTime").alias("at"))
    spans = iv.filter("status = 'purchase'").select(F.col("eventId").alias("spanId"), "userId", "status", "startTime", "endTime")
    return jn.interval_join(points, spans, ["userId"], "at", "startTime", "endTime").select("eventId", "spanId", "status")


@query(
    "j7_span_days",
    with_(EVENTS)
    + """SELECT eventId, CAST(unnest(range(CAST(ts AS DATE), CAST(ts + to_seconds(k * 3600) AS DATE) + 1, INTERVAL 1 DAY)) AS DATE)::VARCHAR AS day FROM ev""",
)
def span_days(t):
    return jn.span_days(raw.status_intervals(t.events, 3600), "startTime", "endTime").select("eventId", "day")


@query(
    "j8_bucket_join",
    with_(EVENTS)
    + """, nw AS (SELECT conversationId, arg_max(queueId, (ts, eventId)) AS queueId, max_by(ts, (ts, eventId)) AS ts FROM ev WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1),
         fc AS (SELECT queueId, time_bucket(INTERVAL 1 HOUR, ts) AS slot, count(*) AS n FROM ev GROUP BY ALL)
       SELECT conversationId, nw.queueId, slot::VARCHAR AS slot, n FROM nw JOIN fc ON fc.queueId = nw.queueId AND fc.slot = time_bucket(INTERVAL 1 HOUR, nw.ts)""",
)
def bucket_join(t):
    m = raw.metric_events(t.events)
    # the newest record of each conversation in ten days, against what its queue did in the same hour
    days = F.col("eventTime").between(F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-19 23:59:59.999999").cast("timestamp"))
    newest = ordered.newest(m.filter(days), ["conversationId"], F.col("eventTime").desc(), F.col("eventId").desc())
    hour = F.date_trunc("hour", "eventTime").alias("slot")
    counts = m.filter(days).groupBy("queueId", hour).agg(F.count(F.lit(1)).alias("n"))
    return newest.select("conversationId", "queueId", hour).join(counts, ["queueId", "slot"]).select("conversationId", "queueId", "slot", "n")


@query(
    "j9_semi_join",
    "SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_quantity > 40)",
)
def semi_join(t):
    hits = t.lineitem.filter("l_returnflag = 'R' and l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(hits, "o_orderkey", "left_semi")


@query(
    "j10_anti_join",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= '2001-01-01')",
)
def anti_join(t):
    late = t.orders.filter("o_orderdate >= '2001-01-01'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(late, "c_custkey", "left_anti")


@query(
    "j11_normalised_text_join",
    """WITH a AS (SELECT doc_id, lang, regexp_replace(lower(trim(text)), '[^a-z0-9]', '', 'g') AS nk FROM documents)
       SELECT a.doc_id, b.copies, b.firstDoc FROM a JOIN (SELECT nk, count(*) AS copies, min(doc_id) AS firstDoc FROM a GROUP BY nk) b ON a.nk = b.nk""",
)
def normalised_text_join(t):
    # 128 bits stand for the text, which stays where it is
    keyed = t.documents.select("doc_id", F.unhex(F.md5(tx.normalised(F.col("text")))).alias("nk"))
    groups = keyed.groupBy("nk").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("firstDoc"))
    return keyed.join(groups, "nk").select("doc_id", "copies", "firstDoc")


def _people(t):
    """Customers as people with a three-part name; some are written in another order."""
    no = F.col("c_custkey")
    first, middle, last = F.concat(F.lit("Fn"), no % 40), F.concat(F.lit("M"), no % 3), F.concat(F.lit("Ln"), no)
    return t.customer.select(
        F.col("c_custkey").alias("personId"),
        F.when(no % 4 == 0, F.concat(F.lit("LOGIN"), no)).alias("login"),
        jn.name_variants(first, middle, last).alias("variants"),
    )


def _directory(t):
    no = F.col("c_custkey")
    first, middle, last = F.concat(F.lit("Fn"), no % 40), F.concat(F.lit("M"), no % 3), F.concat(F.lit("Ln"), no)
    name = F.when(no % 3 == 0, F.concat_ws(" ", first, last)).when(no % 3 == 1, F.concat_ws(" ", last, first, middle)).otherwise(
        F.concat_ws(" ", F.lit("Nobody"), last)
    )
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("login"), no).alias("login_name"), name.alias("name"), (F.col("c_acctbal") > 0).alias("active")
    )


@query(
    "j12_cascading_name_match",
    """SELECT c_custkey AS personId, c_custkey AS userId, CASE WHEN c_custkey % 4 = 0 THEN 'login' ELSE 'name' END AS matchedBy
       FROM customer WHERE c_custkey % 4 = 0 OR c_custkey % 3 <> 2""",
)
def cascading_name_match(t):
    return jn.match_names(_people(t), _directory(t), "personId", "login", "variants", "login_name", "name", "active", "id")


@query(
    "j13_email_part_join",
    "SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON c_custkey = s_suppkey * 2",
)
def email_part_join(t):
    mail = F.concat(F.lit("ext-a"), F.col("s_suppkey") * 2, F.lit("@example.com"))
    left = t.supplier.select("s_suppkey", jn.email_key(mail).alias("login"))
    right = t.customer.select("c_custkey", F.concat(F.lit("a"), "c_custkey").alias("login"))
    return left.join(right, "login").select("s_suppkey", "c_custkey")


@query(
    "j14_scalar_fallback",
    """SELECT c_custkey, coalesce(CASE WHEN c_acctbal > 5000 THEN DATE '1994-01-01' END,
         (SELECT CAST(min(o_orderdate) AS DATE) FROM orders WHERE o_custkey = c_custkey))::VARCHAR AS startDate FROM customer""",
)
def scalar_fallback(t):
    first = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.to_date(F.min("o_orderdate")).alias("firstDate"))
    own = F.when(F.col("c_acctbal") > 5000, F.to_date(F.lit("1994-01-01")))
    return (
        t.customer.select("c_custkey", "c_acctbal")
        .join(first, "c_custkey", "left")
        .select("c_custkey", F.coalesce(own, "firstDate").alias("startDate"))
    )


@query(
    "j15_line_anchor_join",
    with_(TURNS)
    + """, steps AS (SELECT conversationId, line AS startLine, line + 2 AS endLine FROM turns WHERE line % 2 = 1)
      SELECT s.conversationId, s.startLine, s.endLine, t.line, t.participant FROM steps s JOIN turns t
      ON t.conversationId = s.conversationId AND (t.line = s.startLine OR t.line = s.endLine)""",
)
def line_anchor_join(t):
    lines = raw.transcript_lines(t.conversations)
    steps = lines.filter("line % 2 = 1").select("conversationId", F.col("line").alias("startLine"), (F.col("line") + 2).alias("endLine"))
    out = jn.anchor_lines(steps, lines.select("conversationId", "line", "participant"), ["conversationId"], "startLine", "endLine", "line")
    return out.select("conversationId", "startLine", "endLine", "line", "participant")


@query(
    "j16_small_side_broadcast",
    """SELECT n_name, l_returnflag, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""",
)
def small_side_broadcast(t):
    sites = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return (
        t.lineitem.select("l_suppkey", "l_returnflag")
        .join(sites, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("n_name", "l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"))
    )


LOCAL = """, loc AS (SELECT eventId, iv.userId, ((startTime AT TIME ZONE 'UTC') AT TIME ZONE u.timeZone) AS localStart, timeZone
   FROM iv JOIN users u ON u.userId = iv.userId)"""


@query(
    "j17_local_time_lookup",
    with_(INTERVALS, USERS) + LOCAL + " SELECT eventId, timeZone, localStart::VARCHAR AS localStart FROM loc",
)
def local_time_lookup(t):
    zones = raw.users(t.customer, t.nation, t.region).select("userId", "timeZone")
    out = jn.lookup_local_time(raw.status_intervals(t.events), zones, ["userId"], {"localStart": "startTime"})
    return out.select("eventId", "timeZone", "localStart")


@query(
    "j18_one_region_per_user",
    """WITH groups AS (SELECT c_custkey AS userId, lower(n_name) AS g FROM customer JOIN nation ON n_nationkey = c_nationkey
         UNION ALL SELECT c_custkey, lower(n_name) FROM customer JOIN nation ON n_nationkey = c_custkey % 25),
       m AS (SELECT userId, r_name, n_name FROM groups JOIN nation ON lower(n_name) = g JOIN region ON n_regionkey = r_regionkey)
       SELECT userId, arg_min(r_name, n_name) AS region, min(n_name) AS groupName FROM m GROUP BY userId""",
)
def one_region_per_user(t):
    member = F.explode(F.array_distinct(F.array("c_nationkey", (F.col("c_custkey") % 25).cast("int"))))
    groups = t.customer.select(F.col("c_custkey").alias("userId"), member.alias("n_nationkey")).join(
        t.nation.select("n_nationkey", F.lower("n_name").alias("groupKey")), "n_nationkey"
    )
    mapping = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lower("n_name").alias("groupKey"), F.col("n_name").alias("groupName"), F.col("r_name").alias("region")
    )
    hits = groups.join(mapping, "groupKey").select("userId", "region", "groupName")
    return ordered.newest(hits, ["userId"], F.col("groupName").asc())
