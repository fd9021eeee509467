"""Structured Streaming jobs over landed event files; each runs until all files are processed."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.queries.prelude import EVENTS, with_
from callweave.queries.registry import query
from callweave.session import scratch_path
from callweave.sources import raw
from callweave.streaming import boards, states

EVENT = T.StructType(
    [
        T.StructField("eventId", T.LongType()),
        T.StructField("userId", T.StringType()),
        T.StructField("queueId", T.StringType()),
        T.StructField("mediaType", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("eventTime", T.TimestampType()),
        T.StructField("k", T.IntegerType()),
    ]
)
METRICS = ["view", "click", "signup", "purchase", "error"]
# a week is landed after the other, so rows are out of order by less than this
LATENESS = "8 days"


def _landed(t, copies=1):
    """Events landed as JSON files in four deliveries, in time order."""
    path = scratch_path(t.spark, "landed-events")
    rows = raw.metric_events(t.events).select(*EVENT.fieldNames())
    for first, last in ((1, 8), (9, 16), (17, 24), (25, 31)):
        part = rows.filter(F.dayofmonth("eventTime").between(first, last))
        for _ in range(copies):
            part.write.mode("append").json(f"{path}/delivery={first}")
    return path


def _stream(t, copies=1):
    return boards.read_files(t.spark, _landed(t, copies), EVENT, files_per_trigger=8)


@query(
    "st1_device_event_stream",
    with_(EVENTS) + "SELECT eventId, userId, queueId, k FROM ev",
)
def device_event_stream(t):
    out = scratch_path(t.spark, "device-events")
    stream = boards.device_events(_stream(t, copies=2), "eventTime", ["eventId"], LATENESS)
    boards.run_available(stream.select("eventId", "userId", "queueId", "k"), scratch_path(t.spark, "ck"), boards.append_once(out))
    return t.spark.read.parquet(out).drop("batchId")


@query(
    "st2_interval_board",
    with_(EVENTS)
    + "SELECT time_bucket(INTERVAL 15 MINUTE, ts)::VARCHAR AS intervalStart, (time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE)::VARCHAR AS intervalEnd, mediaType, queueId, 'code-' || (k % 12) AS wrapUpCode, "
    + ", ".join(f"coalesce(sum(CASE WHEN eventType = '{m}' THEN cents END), 0)::BIGINT AS \"{m}\", count(CASE WHEN eventType = '{m}' THEN cents END) AS \"{m}Count\"" for m in METRICS)
    + " FROM ev GROUP BY time_bucket(INTERVAL 15 MINUTE, ts), mediaType, queueId, k % 12",
)
def interval_board(t):
    out = scratch_path(t.spark, "interval-board")
    keys = ["mediaType", "queueId", "wrapUpCode"]
    coded = _stream(t).withColumn("wrapUpCode", F.concat(F.lit("code-"), F.col("k") % 12))
    board = boards.interval_metrics(coded, "eventTime", keys, "name", "value", METRICS, LATENESS)
    board = board.withColumn("day", F.to_date("intervalStart"))
    sink = boards.extract_windows(out, ["intervalStart", *keys], ["day"])
    boards.run_available(board, scratch_path(t.spark, "ck"), sink, mode="update")
    return t.spark.read.parquet(out).drop("day")


def _zones(t):
    """Time zones of the queues."""
    names = F.array(*[F.lit(z) for z in ("Australia/Sydney", "Europe/Berlin", "America/New_York")])
    return t.supplier.select(F.concat(F.lit("queue-"), "s_suppkey").alias("queueId"), F.get(names, (F.col("s_suppkey") % 3).cast("int")).alias("timeZone"))


@query(
    "st2_latest_local_day",
    with_(EVENTS)
    + """, z AS (SELECT 'queue-' || s_suppkey AS queueId, (['Australia/Sydney', 'Europe/Berlin', 'America/New_York'])[s_suppkey % 3 + 1] AS timeZone FROM supplier),
        b AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS s, mediaType, queueId, sum(cents)::BIGINT AS total FROM ev GROUP BY time_bucket(INTERVAL 15 MINUTE, ts), mediaType, queueId),
        l AS (SELECT b.*, timeZone, CAST((s AT TIME ZONE 'UTC') AT TIME ZONE timeZone AS DATE) AS d FROM b JOIN z ON z.queueId = b.queueId)
       SELECT s::VARCHAR AS intervalStart, mediaType, queueId, total, timeZone FROM l QUALIFY d = max(d) OVER (PARTITION BY timeZone)""",
)
def latest_local_day(t):
    out = scratch_path(t.spark, "newest-days")
    rows = _stream(t).select("queueId", "mediaType", "eventTime", "value")
    with states.rocks_state(t.spark):
        windows = states.newest_day_windows(rows, "eventTime", _zones(t), "queueId", ["mediaType"], "value")
        boards.run_available(windows, scratch_path(t.spark, "ck"), states.newest_day_board(out, "queueId", ["mediaType"]), mode="update")
    return states.newest_days(t.spark.read.schema(windows.schema).parquet(out)).drop("day")


@query(
    "st3_latest_status",
    with_(EVENTS) + "SELECT userId, arg_max(eventType, (ts, eventId)) AS status, arg_max(eventId, (ts, eventId)) AS eventId, max(ts)::VARCHAR AS since FROM ev GROUP BY 1",
)
def latest_status(t):
    out = scratch_path(t.spark, "latest-status")
    rows = _stream(t).select("userId", F.col("name").alias("status"), "eventId", F.col("eventTime").alias("since"))
    boards.run_available(rows, scratch_path(t.spark, "ck"), boards.upsert_newest(out, ["userId"], F.struct("since", "eventId").desc()))
    return t.spark.read.parquet(out).drop("bucket")


# fixed values: routing statuses and presences that the queue board counts
ROUTING = {"click": "INTERACTING", "error": "NOT_RESPONDING", "purchase": "OFF_QUEUE", "view": "IDLE"}
PRESENCES = ["AVAILABLE", "BREAK", "BUSY", "MEAL", "OFFLINE", "ON_QUEUE", "AWAY", "TRAINING"]
HANDLING = {"waiting": "view", "interacting": "click"}


def _agent_rows(t, rows):
    """Events as what an agent does: routing status by the event's name, presence by its number."""
    routing = F.create_map(*[F.lit(x) for pair in ROUTING.items() for x in pair])
    return rows.select(
        "userId", F.unix_micros("eventTime").alias("at"), "eventId", "queueId", "mediaType", "name",
        routing[F.col("name")].alias("routing"), F.element_at(F.array(*map(F.lit, PRESENCES)), F.col("k") % 8 + 1).alias("presence"),
    )


def board_cells():
    cells = {f"routing_{r.lower()}": F.col("routing") == r for r in ROUTING.values()}
    cells |= {f"presence_{p.lower()}": F.col("presence") == p for p in PRESENCES}
    return cells | {f"{c}_{m}": (F.col("name") == n) & (F.col("mediaType") == m) for c, n in HANDLING.items() for m in ("voice", "chat", "email")}


@query(
    "st4_queue_board",
    with_(EVENTS)
    + ", now AS (SELECT userId, arg_max(queueId, (ts, eventId)) AS queueId, arg_max(eventType, (ts, eventId)) AS eventType, arg_max(mediaType, (ts, eventId)) AS mediaType, arg_max(k, (ts, eventId)) AS k FROM ev GROUP BY 1)"
    + "SELECT 'queue-' || s_suppkey AS queueId, "
    + ", ".join(
        [f"count(*) FILTER (WHERE eventType = '{n}') AS routing_{r.lower()}" for n, r in ROUTING.items()]
        + [f"count(*) FILTER (WHERE k % 8 = {i}) AS presence_{p.lower()}" for i, p in enumerate(PRESENCES)]
        + [f"count(*) FILTER (WHERE eventType = '{n}' AND mediaType = '{m}') AS {c}_{m}" for c, n in HANDLING.items() for m in ("voice", "chat", "email")]
    )
    + " FROM supplier LEFT JOIN now ON now.queueId = 'queue-' || s_suppkey GROUP BY 1",
)
def queue_board(t):
    out, cells = scratch_path(t.spark, "queue-board"), board_cells()
    queues = t.supplier.select(F.concat(F.lit("queue-"), "s_suppkey").alias("queueId"))
    with states.rocks_state(t.spark):
        changes = states.changes_of_state(_agent_rows(t, _stream(t)), "userId", ["at", "eventId"], ["queueId", "mediaType", "name", "routing", "presence"])
        boards.run_available(changes, scratch_path(t.spark, "ck"), states.counted_board(out, "queueId", cells), mode="update")
    return boards.full_board(queues, "queueId", list(cells))(boards.newest_board(t.spark, out))


@query(
    "st5_extract_window_upsert",
    with_(EVENTS) + "SELECT eventId, userId, CAST(ts AS DATE)::VARCHAR AS extractDate, date_trunc('day', ts)::TIMESTAMP::VARCHAR AS extractIntervalStartTime FROM ev",
)
def extract_window_upsert(t):
    out = scratch_path(t.spark, "extract-windows")
    # every day is delivered twice, so each row arrives again in a later micro-batch
    stream = _stream(t, copies=2).select(
        "eventId", "userId", F.to_date("eventTime").alias("extractDate"), F.date_trunc("day", "eventTime").alias("extractIntervalStartTime")
    )
    boards.run_available(stream, scratch_path(t.spark, "ck"), boards.extract_windows(out, ["eventId"]))
    return t.spark.read.schema("eventId long, userId string, extractDate date, extractIntervalStartTime timestamp").parquet(out)
