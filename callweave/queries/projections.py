"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.functions import text as tx
from callweave.operators import projections as pj
from callweave.queries.prelude import EVENTS, INTERVALS, LINES, USERS, with_
from callweave.queries.registry import query
from callweave.session import scratch_path
from callweave.sources import raw, writers


@query(
    "p1_typed_projection",
    """SELECT CAST(s_suppkey AS VARCHAR) AS agentId, s_name AS agentName, CAST(s_nationkey AS INTEGER) AS teamId,
       CAST(s_acctbal AS DOUBLE) AS balance, s_acctbal > 0 AS isActive FROM supplier""",
)
def typed_projection(t):
    landed = t.supplier.select([F.col(c).cast("string") for c in t.supplier.columns])
    target = T.StructType.fromDDL("agentId string, agentName string, teamId int, balance double, isActive boolean")
    source = {
        "agentId": "s_suppkey",
        "agentName": "s_name",
        "teamId": "s_nationkey",
        "balance": "s_acctbal",
        "isActive": F.col("s_acctbal").cast("double") > 0,
    }
    path = scratch_path(t.spark, "agents")
    pj.typed(landed, target, source).write.parquet(path)
    return t.spark.read.parquet(path)


@query(
    "p2_typed_append",
    """SELECT CAST(s_suppkey AS BIGINT) AS agentId, CAST(s_nationkey AS INTEGER) AS teamId, 1 AS load FROM supplier
       UNION ALL SELECT s_suppkey, s_nationkey, 2 FROM supplier WHERE s_acctbal > 0""",
)
def typed_append(t):
    target = T.StructType.fromDDL("agentId bigint, teamId int, load int")
    path = scratch_path(t.spark, "agents-append")
    for load, rows in ((1, t.supplier), (2, t.supplier.filter("s_acctbal > 0"))):
        names = {"agentId": "s_suppkey", "teamId": "s_nationkey", "load": F.lit(load)}
        pj.typed(rows, target, names).write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


@query(
    "p3_struct_paths_and_units",
    """SELECT p_partkey AS id, p_size / 1000.0::DOUBLE AS callSlaSeconds, p_size * 100.0::DOUBLE AS callSlaPercent,
       (p_size + 1) / 1000.0::DOUBLE AS emailSlaSeconds FROM part""",
)
def struct_paths_and_units(t):
    def level(ms):
        return F.struct(
            F.struct(ms.cast("long").alias("durationMs"), F.col("p_size").cast("double").alias("percentage")).alias(
                "serviceLevel"
            )
        )

    queues = t.part.select(
        F.col("p_partkey").alias("id"),
        F.struct(level(F.col("p_size")).alias("call"), level(F.col("p_size") + 1).alias("email")).alias("mediaSettings"),
    )
    return queues.select(
        "id",
        pj.ms_to_seconds(F.col("mediaSettings.call.serviceLevel.durationMs")).alias("callSlaSeconds"),
        pj.to_percent(F.col("mediaSettings.call.serviceLevel.percentage")).alias("callSlaPercent"),
        pj.ms_to_seconds(F.col("mediaSettings.email.serviceLevel.durationMs")).alias("emailSlaSeconds"),
    )


@query(
    "p4_extract_window",
    "SELECT event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10' AND date_trunc('hour', ts) = TIMESTAMP '2024-01-10 05:00:00'",
)
def extract_window(t):
    stamped = t.events.select(
        "event_id",
        F.to_date("ts").alias("extractDate"),
        F.date_trunc("hour", "ts").alias("extractIntervalStartTime"),
        (F.date_trunc("hour", "ts") + F.expr("interval 1 hour")).alias("extractIntervalEndTime"),
    )
    return pj.extract_window(stamped, "2024-01-10", "2024-01-10 05:00:00", "2024-01-10 06:00:00").select("event_id")


@query(
    "p5_half_open_window",
    "SELECT event_id, event_type FROM events WHERE ts >= '2024-01-05' AND ts < '2024-01-06 12:00:00'",
)
def half_open_window(t):
    return pj.half_open(t.events, "ts", "2024-01-05 00:00:00", "2024-01-06 12:00:00").select("event_id", "event_type")


@query(
    "p6_key_lists",
    "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')",
)
def key_lists(t):
    return t.orders.filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P")
    ).select("o_orderkey")


@query(
    "p7_exclusion_list",
    """SELECT doc_id, unnest_line AS step FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS unnest_line FROM documents)
       WHERE trim(unnest_line) NOT IN (SELECT trim(line) FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark))""",
)
def exclusion_list(t):
    steps = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("step"))
    excluded = t.benchmark.select(F.explode(F.split("text", "\n")).alias("phrase"))
    return pj.without_listed(steps, "step", excluded, "phrase")


@query(
    "p8_drop_empty_measures",
    """SELECT l_orderkey, l_partkey, l_discount, l_tax FROM lineitem
       WHERE NOT (coalesce(l_discount, 0) = 0 AND coalesce(l_tax, 0) = 0)""",
)
def drop_empty_measures(t):
    return pj.drop_empty(t.lineitem.select("l_orderkey", "l_partkey", "l_discount", "l_tax"), ["l_discount", "l_tax"])


@query(
    "p9_drop_zero_length",
    with_(INTERVALS) + "SELECT eventId, startTime::VARCHAR AS startTime, endTime::VARCHAR AS endTime FROM iv WHERE startTime <> endTime",
)
def drop_zero_length(t):
    return pj.drop_zero_length(raw.status_intervals(t.events), "startTime", "endTime").select(
        "eventId", "startTime", "endTime"
    )


@query(
    "p10_token_shape",
    r"""SELECT doc_id, pos, token FROM (
          SELECT doc_id, i - 1 AS pos, parts[i] AS token FROM (SELECT doc_id, regexp_split_to_array(text, '\s+') AS parts FROM documents),
            LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i))
        WHERE regexp_matches(token, '^[A-Z][a-z]{2,5}$')""",
)
def token_shape(t):
    tokens = t.documents.select("doc_id", F.posexplode(F.split("text", r"\s+")).alias("pos", "token"))
    return tokens.filter(tx.has_shape(F.col("token"), "^[A-Z][a-z]{2,5}$")).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "token"
    )


@query(
    "p11_status_from_flags",
    """SELECT c_custkey, CASE WHEN c_acctbal < -500 THEN 'Deleted' WHEN c_nationkey % 2 = 0 THEN 'Inactive' ELSE 'Active' END AS status
       FROM customer""",
)
def status_from_flags(t):
    return t.customer.select(
        "c_custkey",
        pj.status_of(F.col("c_acctbal") < -500, F.col("c_nationkey") % 2 == 1).alias("status"),
    )


@query(
    "p12_region_slice",
    """SELECT n_nationkey, n_name, 'west' AS slice FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('AMERICA', 'EUROPE')
       UNION ALL SELECT n_nationkey, n_name, 'east' FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA')""",
)
def region_slice(t):
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return pj.region_slices(rows, "r_name", {"west": ["AMERICA", "EUROPE"], "east": ["ASIA"]}, "slice").select(
        "n_nationkey", "n_name", "slice"
    )


@query(
    "p13_date_and_time_ints",
    with_(EVENTS)
    + """SELECT eventId, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS dateId, CAST(strftime(ts, '%H%M%S') AS INTEGER) AS timeId FROM ev""",
)
def date_and_time_ints(t):
    return raw.event_rows(t.events).select(
        "eventId", pj.date_id(F.col("ts")).alias("dateId"), pj.time_id(F.col("ts")).alias("timeId")
    )


@query("p14_rename_export", "SELECT n_nationkey AS groupId, n_name AS groupName, n_regionkey AS parentId FROM nation")
def rename_export(t):
    return pj.renamed(t.nation, {"n_nationkey": "groupId", "n_name": "groupName", "n_regionkey": "parentId"})


@query(
    "p15_flattened_window_export",
    with_(LINES)
    + """SELECT sessionId, agentId, queueId, CAST(quantity AS VARCHAR) AS handleUnits FROM lines
         WHERE segmentStart >= '1998-03-01' AND segmentStart < '1998-04-01'""",
)
def flattened_window_export(t):
    path = scratch_path(t.spark, "facts-csv")
    facts = t.line_sessions().select(
        "sessionId", "agentId", "queueId", F.col("quantity").alias("handleUnits"), "segmentStart"
    )
    writers.write_window_export(facts, path, "segmentStart", "1998-03-01", "1998-04-01")
    return t.spark.read.option("header", True).csv(path).drop("segmentStart")


@query(
    "p16_tenant_slice",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '2-HIGH'",
)
def tenant_slice(t):
    path = scratch_path(t.spark, "tenants")
    shared = t.orders.select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("orgId"))
    shared.write.partitionBy("orgId").parquet(path)
    return pj.tenant_rows(t.spark.read.parquet(path), "orgId", "2-HIGH")
