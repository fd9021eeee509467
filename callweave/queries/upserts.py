"""Upserts over the given tables: old rows against a later batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.operators import upserts as up
from callweave.queries.prelude import EVENTS, INTERVALS, LINES, with_
from callweave.queries.registry import query
from callweave.session import scratch_path
from callweave.sources import raw

# the older table holds all orders but every third; the batch re-delivers the even ones at half price
OLD_NEW = """old AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate FROM orders WHERE o_orderkey % 3 <> 0),
  new AS (SELECT o_orderkey, o_custkey + 1 AS o_custkey, o_orderpriority, o_orderdate FROM orders WHERE o_orderkey % 2 = 0)"""
COLS = "o_orderkey, o_custkey, o_orderpriority, o_orderdate::VARCHAR AS o_orderdate"


def _old_new(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    return o.filter("o_orderkey % 3 <> 0"), o.filter("o_orderkey % 2 = 0").withColumn(
        "o_custkey", F.col("o_custkey") + 1
    )


@query(
    "w1_merge_all",
    with_(OLD_NEW)
    + f"SELECT {COLS} FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new) UNION ALL SELECT {COLS} FROM new",
)
def merge_all(t):
    old, new = _old_new(t)
    return up.merge_all(old, new, ["o_orderkey"])


@query(
    "w2_merge_new",
    """SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS label FROM labels
       UNION ALL SELECT doc_id, 'none' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def merge_new(t):
    known = t.labels.select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("label"))
    return up.merge_new(known, t.documents.select("doc_id", F.lit("none").alias("label")), ["doc_id"])


@query(
    "w3_merge_delete",
    """SELECT conv_id, turn FROM conversations WHERE conv_id NOT IN
         (SELECT conv_id FROM conversations WHERE role = 'system')""",
)
def merge_delete(t):
    c = t.conversations.select("conv_id", "turn")
    return up.merge_delete(c, t.conversations.filter("role = 'system'").select("conv_id"), ["conv_id"])


@query(
    "w4_null_safe_merge",
    with_(EVENTS)
    + """, agg AS (SELECT userId, CASE WHEN k % 10 <> 0 THEN k % 10 END AS bucket, sum(cents)::BIGINT AS cents,
           bool_or(eventId % 2 = 0) AS fresh FROM ev GROUP BY 1, 2)
         SELECT userId, bucket, CASE WHEN fresh THEN -cents ELSE cents END AS cents FROM agg""",
)
def null_safe_merge(t):
    e = raw.event_rows(t.events).withColumn("bucket", F.when(F.col("k") % 10 != 0, F.col("k") % 10))
    target = e.groupBy("userId", "bucket").agg(F.sum("cents").alias("cents"))
    fresh = e.groupBy("userId", "bucket").agg(
        (-F.sum("cents")).alias("cents"), F.bool_or(F.col("eventId") % 2 == 0).alias("fresh")
    )
    return up.merge_all(target, fresh.filter("fresh").drop("fresh"), ["userId", "bucket"])


@query(
    "w5_replace_where_exists",
    with_(OLD_NEW)
    + f"""SELECT {COLS} FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.o_orderpriority = old.o_orderpriority
         AND new.o_orderdate = old.o_orderdate) UNION ALL SELECT {COLS} FROM new""",
)
def replace_where_exists(t):
    old, new = _old_new(t)
    return up.replace_matching(old, new, ["o_orderpriority", "o_orderdate"])


@query(
    "w6_replace_distinct",
    """SELECT l_orderkey, l_returnflag, l_linestatus FROM lineitem WHERE l_orderkey NOT IN
         (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)
       UNION ALL SELECT DISTINCT l_orderkey, l_returnflag, 'X' FROM lineitem WHERE l_quantity > 45""",
)
def replace_distinct(t):
    old = t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus")
    new = t.lineitem.filter("l_quantity > 45").select(
        "l_orderkey", "l_returnflag", F.lit("X").alias("l_linestatus")
    )
    return up.replace_matching(old, new, ["l_orderkey"], distinct=True)


@query(
    "w7_rolling_reload",
    with_(OLD_NEW)
    + f""", cut AS (SELECT *, DATE '2000-01-01' - INTERVAL 30 DAY AS d FROM (SELECT 1))
        SELECT {COLS} FROM (SELECT * FROM old WHERE o_orderdate < (SELECT d FROM cut)
          UNION ALL SELECT * FROM new WHERE o_orderdate >= (SELECT d FROM cut))
        WHERE o_orderdate >= DATE '2000-01-01' - INTERVAL 12 MONTH""",
)
def rolling_reload(t):
    old, new = _old_new(t)
    return up.rolling_reload(old, new, "o_orderdate", F.to_date(F.lit("2000-01-01")), 30, 12)


@query(
    "w8_replace_partitions",
    """WITH p AS (SELECT l_orderkey, l_partkey, l_quantity, strftime(l_shipdate, '%Y-%m') AS ship_month FROM lineitem)
       SELECT l_orderkey, l_partkey, l_quantity, ship_month FROM p WHERE ship_month < '1998-01' OR ship_month > '1998-06'
       UNION ALL SELECT l_orderkey, l_partkey, -l_quantity, ship_month FROM p
         WHERE ship_month BETWEEN '1998-01' AND '1998-06' AND l_quantity > 10""",
)
def replace_partitions(t):
    path = scratch_path(t.spark, "partitions")
    rows = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_quantity", F.date_format("l_shipdate", "yyyy-MM").alias("ship_month")
    )
    up.replace_partitions(rows, path, ["ship_month"])
    table = t.spark.read.schema(rows.schema).parquet(path)
    batch = table.filter("ship_month between '1998-01' and '1998-06' and l_quantity > 10")
    up.commit_partitions(batch.withColumn("l_quantity", -F.col("l_quantity")), path, ["ship_month"])
    up.replace_partitions(rows.filter("l_quantity < 0"), path, ["ship_month"])
    return t.spark.read.schema(rows.schema).parquet(path)


@query("w9_overwrite_unless_empty", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0")
def overwrite_unless_empty(t):
    path = scratch_path(t.spark, "dim")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    up.overwrite_unless_empty(rows, path)
    up.overwrite_unless_empty(rows.filter("c_acctbal >= 0"), path)
    up.overwrite_unless_empty(rows.filter("c_custkey < 0"), path)
    return t.spark.read.parquet(path).select("c_custkey", "c_name")


@query(
    "w10_conditional_backfill",
    """WITH c AS (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS nk FROM customer),
         by_name AS (SELECT s_nationkey AS g, min(s_suppkey) AS v FROM supplier WHERE s_acctbal > 5000 GROUP BY 1),
         by_region AS (SELECT n_nationkey AS g, min(n_regionkey) AS v FROM nation GROUP BY 1)
       SELECT c_custkey, CASE WHEN nk IS NULL AND c_acctbal > 0
         THEN coalesce(a.v, b.v) ELSE CAST(nk AS BIGINT) END AS agentKey
       FROM c LEFT JOIN by_name a ON a.g = c.c_nationkey LEFT JOIN by_region b ON b.g = c.c_nationkey""",
)
def conditional_backfill(t):
    target = t.customer.withColumn("agentKey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey")).cast("long"))
    first = t.supplier.filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey"), "s_suppkey")
    second = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").cast("long"))
    rules = [(first, ["c_nationkey"], "s_suppkey"), (second, ["c_nationkey"], "n_regionkey")]
    return up.backfill(target, "agentKey", rules, F.col("c_acctbal") > 0).select("c_custkey", "agentKey")


@query(
    "w11_flag_where_exists",
    """SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS flagged
       FROM orders""",
)
def flag_where_exists(t):
    target = t.orders.select("o_orderkey", F.lit(False).alias("flagged"))
    hits = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return up.flag_where_exists(target, hits, ["o_orderkey"], "flagged")


@query(
    "w12_update_from_first",
    """WITH f AS (SELECT user_id, arg_min(event_type, event_id) AS v FROM events
         WHERE event_type <> 'error' GROUP BY 1)
       SELECT c_custkey, coalesce(f.v, c_mktsegment) AS firstType FROM customer LEFT JOIN f ON f.user_id = c_custkey""",
)
def update_from_first(t):
    target = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("firstType"))
    source = t.events.withColumn("v", F.when(F.col("event_type") != "error", F.col("event_type")))
    out = up.update_from_first(target, source, ["user_id"], "firstType", "v", F.col("event_id"))
    return out.withColumnRenamed("user_id", "c_custkey")


@query(
    "w13_validity_ranges",
    """SELECT o_custkey AS userId, o_orderpriority AS team, min(o_orderdate)::DATE::VARCHAR AS startDate,
         CASE WHEN bool_or(o_orderdate >= '2001-06-01') THEN '9999-12-31'
           ELSE max(o_orderdate)::DATE::VARCHAR END AS endDate FROM orders GROUP BY 1, 2""",
)
def validity_ranges(t):
    seen = t.orders.select(
        F.col("o_custkey").alias("userId"),
        F.col("o_orderpriority").alias("team"),
        F.to_date("o_orderdate").alias("day"),
        (F.col("o_orderdate") >= "2001-06-01").alias("active"),
    )
    return up.validity_ranges(seen, ["userId", "team"], "day", "day", "active", "1990-01-01")


@query(
    "w14_guarded_upsert",
    with_(EVENTS)
    + """SELECT userId, time_bucket(INTERVAL 15 MINUTE, ts)::VARCHAR AS slotStart,
          (time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE)::VARCHAR AS slotEnd, count(*) AS n
        FROM ev GROUP BY userId, time_bucket(INTERVAL 15 MINUTE, ts)
        UNION ALL SELECT DISTINCT userId, (time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 1000 DAY)::VARCHAR,
          (time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 1000 DAY + INTERVAL 15 MINUTE)::VARCHAR, -2 FROM ev""",
)
def guarded_upsert(t):
    slot = F.window("ts", "15 minutes")
    rows = (
        raw.event_rows(t.events)
        .groupBy("userId", slot.alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("userId", F.col("w.start").alias("slotStart"), F.col("w.end").alias("slotEnd"), "n")
    )
    good = up.guard_interval(rows, "slotStart", "slotEnd", 900)
    # stored: every second slot with an old count, which must go, and slots the batch does not hold, which must stay
    old = rows.filter("n % 2 = 1").withColumn("n", F.lit(-1).cast("long"))
    long_ago = {c: F.col(c) - F.expr("interval 1000 days") for c in ("slotStart", "slotEnd")}
    stored = old.unionByName(rows.withColumns(long_ago).withColumn("n", F.lit(-2).cast("long")))
    return up.replace_matching(stored, good, ["userId", "slotStart"])


@query(
    "w15_merge_newest",
    with_(EVENTS)
    + """, latest AS (SELECT userId, arg_max(eventType, eventId) AS eventType, arg_max(cents, eventId) AS cents FROM ev GROUP BY 1),
         base AS (SELECT 'u' || c_custkey AS userId, 'none' AS eventType, CAST(0 AS BIGINT) AS cents FROM customer)
       SELECT * FROM base WHERE userId NOT IN (SELECT userId FROM latest) UNION ALL SELECT * FROM latest""",
)
def merge_newest(t):
    base = t.customer.select(
        F.concat(F.lit("u"), "c_custkey").alias("userId"),
        F.lit("none").alias("eventType"),
        F.lit(0).cast("long").alias("cents"),
    )
    versions = raw.event_rows(t.events).select("userId", "eventType", "cents", "eventId")
    merged = up.merge_newest(
        base.withColumn("eventId", F.lit(None).cast("long")), versions, ["userId"], F.col("eventId").desc()
    )
    return merged.drop("eventId")


@query(
    "w16_register_members",
    """SELECT 'view' AS id, 'view' AS name UNION ALL
       SELECT DISTINCT event_type || '_' || (event_id % 4), event_type || ' ' || (event_id % 4) FROM events
       UNION ALL SELECT DISTINCT event_type, event_type FROM events WHERE event_type <> 'view'""",
)
def register_members(t):
    dim = t.events.filter("event_type = 'view'").select(
        F.col("event_type").alias("id"), F.col("event_type").alias("name")
    ).distinct()
    both = F.array("event_type", F.concat_ws("_", "event_type", F.col("event_id") % 4))
    facts = t.events.select(F.explode(both).alias("finding"))
    return up.register_members(dim, facts, "finding", "id", "name")
