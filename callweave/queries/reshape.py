"""Pivots and unpivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.operators import reshape as rs
from callweave.queries.prelude import EVENTS, LINES, with_
from callweave.queries.registry import query
from callweave.sources import raw

# fixed values
KINDS = ["view", "click", "signup", "purchase", "error"]


@query(
    "v1_metric_pivot",
    with_(EVENTS)
    + "SELECT conversationId, mediaType, "
    + ", ".join(f"sum(CASE WHEN eventType = '{n}' THEN cents END)::BIGINT AS \"{n}\"" for n in KINDS)
    + " FROM ev GROUP BY 1, 2",
)
def metric_pivot(t):
    return rs.pivot_sum(raw.metric_events(t.events), ["conversationId", "mediaType"], "name", "value", KINDS)


@query(
    "v2_stats_pivot",
    with_(EVENTS)
    + "SELECT queueId, "
    + ", ".join(
        f"CASE WHEN count(*) FILTER (WHERE eventType = '{n}') > 0 THEN count(*) FILTER (WHERE eventType = '{n}') END AS {n}_count, "
        f"sum(CASE WHEN eventType = '{n}' THEN cents END)::BIGINT AS {n}_sum, max(CASE WHEN eventType = '{n}' THEN cents END) AS {n}_max, "
        f"min(CASE WHEN eventType = '{n}' THEN cents END) AS {n}_min"
        for n in KINDS
    )
    + " FROM ev GROUP BY 1",
)
def stats_pivot(t):
    return rs.pivot_stats(
        raw.metric_events(t.events),
        ["queueId"],
        "name",
        KINDS,
        count=F.count("value"),
        sum=F.sum("value"),
        max=F.max("value"),
        min=F.min("value"),
    )


@query(
    "v3_key_value_pivot",
    with_(EVENTS)
    + """SELECT conversationId, max(CASE WHEN k % 5 = 0 THEN userId END) AS agent, max(CASE WHEN k % 5 = 1 THEN userId END) AS team,
          max(CASE WHEN k % 5 = 2 THEN userId END) AS site FROM ev GROUP BY 1""",
)
def key_value_pivot(t):
    rows = raw.metric_events(t.events).withColumn("custom_key", (F.col("k") % 5).cast("string"))
    return rs.pivot_value(rows, ["conversationId"], "custom_key", "userId", {"0": "agent", "1": "team", "2": "site"})


@query(
    "v4_question_pivot",
    with_(EVENTS)
    + "SELECT conversationId, "
    + ", ".join(
        f"max(CASE WHEN k % 3 = {i} THEN eventType END) AS q{i}_response, max(CASE WHEN k % 3 = {i} THEN cents END) AS q{i}_score" for i in range(3)
    )
    + " FROM ev GROUP BY 1",
)
def question_pivot(t):
    rows = raw.metric_events(t.events).withColumn("question", (F.col("k") % 3).cast("string"))
    wide = rs.pivot_stats(rows, ["conversationId"], "question", ["0", "1", "2"], response=F.max("name"), score=F.max("value"))
    return wide.select("conversationId", *[F.col(f"`{i}_{c}`").alias(f"q{i}_{c}") for i in range(3) for c in ("response", "score")])


@query(
    "v5_group_score_pivot",
    """SELECT o_custkey, sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) END)::BIGINT AS A,
       sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) END)::BIGINT AS N, sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) END)::BIGINT AS R
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def group_score_pivot(t):
    scores = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", "l_returnflag", F.col("l_quantity").cast("long").alias("score")
    )
    return rs.pivot_sum(scores, ["o_custkey"], "l_returnflag", "score", ["A", "N", "R"])


@query(
    "v6_unpivot_phrases",
    "SELECT p_partkey, 'p_name' AS type, p_name AS phrase FROM part UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part UNION ALL SELECT p_partkey, 'p_type', p_type FROM part",
)
def unpivot_phrases(t):
    return rs.unpivot(t.part, ["p_partkey"], ["p_name", "p_brand", "p_type"], "type", "phrase")


@query(
    "v7_day_columns",
    """SELECT o_custkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day, count(*) AS n FROM orders
       WHERE o_orderdate >= '1998-03-01' AND o_orderdate < '1998-03-08' GROUP BY 1, 2""",
)
def day_columns(t):
    # serial numbers of 1998-03-01 to 1998-03-07
    serials = [str(n) for n in range(35855, 35862)]
    march = t.orders.filter("o_orderdate >= '1998-03-01' and o_orderdate < '1998-03-08'")
    serial = F.datediff(F.to_date("o_orderdate"), F.to_date(F.lit("1899-12-30"))).cast("string")
    sheet = march.withColumn("serial", serial).groupBy("o_custkey").pivot("serial", serials).agg(F.count(F.lit(1)))
    rows = rs.unpivot(sheet, ["o_custkey"], serials, "serial", "n").filter("n is not null")
    return rows.select("o_custkey", rs.serial_day(F.col("serial")).alias("day"), "n")


@query(
    "v8_measures_to_wide",
    with_(EVENTS)
    + """SELECT userId, CAST(ts AS DATE)::VARCHAR AS day, sum(CASE WHEN eventType = 'view' THEN cents END)::BIGINT AS "view",
          sum(CASE WHEN eventType = 'purchase' THEN cents END)::BIGINT AS purchase, CAST(NULL AS BIGINT) AS refund FROM ev GROUP BY 1, 2""",
)
def measures_to_wide(t):
    e = raw.event_rows(t.events).withColumn("day", F.to_date("ts"))
    return rs.pivot_sum(e, ["userId", "day"], "eventType", "cents", ["view", "purchase", "refund"])


@query(
    "v9_attribute_rows",
    with_(EVENTS)
    + """SELECT eventId, 'k' AS attr_dict_key, CAST(k AS BIGINT) AS attr_value, CAST(NULL AS BIGINT) AS num, CAST(NULL AS BIGINT) AS denom FROM ev
       UNION ALL SELECT eventId, 'aht', cents, CAST(k AS BIGINT), CAST(CASE WHEN k % 2 = 0 THEN userNo END AS BIGINT) FROM ev""",
)
def attribute_rows(t):
    e = raw.event_rows(t.events)
    extra = F.create_map(F.lit("aht"), F.col("cents"), F.lit("aht_num"), F.col("k").cast("long"))
    more = F.when(F.col("k") % 2 == 0, F.create_map(F.lit("aht_denom"), F.col("userNo"))).otherwise(
        F.create_map().cast("map<string,bigint>")
    )
    return rs.attribute_rows(e.withColumn("attributes", F.map_concat(raw.props_map(), extra, more)), ["eventId"], "attributes")
