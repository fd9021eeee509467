"""Intervals on a time axis."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.functions import times as tm
from callweave.operators import joins as jn
from callweave.operators import timeaxis as ta
from callweave.plans import workforce as wf
from callweave.queries.nested import SERIES
from callweave.queries.prelude import EVENTS, INTERVALS, USERS, with_
from callweave.queries.registry import query
from callweave.sources import raw


def sliced(seconds):
    return f""", sl AS (SELECT eventId, userId, status, startTime, endTime, unnest(range(
        epoch(startTime)::BIGINT // {seconds} * {seconds}, epoch(endTime)::BIGINT, {seconds})) AS e FROM iv WHERE startTime < endTime),
      cut AS (SELECT eventId, userId, status, make_timestamp(e * 1000000) AS slot, greatest(startTime, make_timestamp(e * 1000000)) AS startTime,
        least(endTime, make_timestamp((e + {seconds}) * 1000000)) AS endTime FROM sl)"""


@query(
    "i1_half_hour_slices",
    with_(INTERVALS)
    + sliced(1800)
    + """ SELECT eventId, slot::VARCHAR AS slot, startTime::VARCHAR AS startTime, endTime::VARCHAR AS endTime,
          (epoch(endTime) - epoch(startTime))::BIGINT AS timeDiff FROM cut""",
)
def half_hour_slices(t):
    iv = raw.status_intervals(t.events).drop("userId", "status")
    return ta.slice_intervals(iv, "startTime", "endTime", 1800)


@query(
    "i2_hour_slices",
    with_(INTERVALS)
    + sliced(3600)
    + """ SELECT eventId, lpad(CAST(hour(slot) AS VARCHAR), 2, '0') || ':00:00 - ' || lpad(CAST(hour(slot) + 1 AS VARCHAR), 2, '0') || ':00:00' AS TimeIntervalStart,
          (epoch(endTime) - epoch(startTime))::BIGINT AS timeDiff FROM cut""",
)
def hour_slices(t):
    cut = ta.slice_intervals(raw.status_intervals(t.events), "startTime", "endTime", 3600)
    return cut.select("eventId", tm.hour_label(F.col("slot")).alias("TimeIntervalStart"), "timeDiff")


LOCAL_DAYS = """, lo AS (SELECT ev.eventId, ((ts AT TIME ZONE 'UTC') AT TIME ZONE timeZone) AS s,
    (((ts + to_seconds(k * 900)) AT TIME ZONE 'UTC') AT TIME ZONE timeZone) AS e FROM ev JOIN users ON users.userId = ev.userId),
  dd AS (SELECT eventId, s, e, CAST(unnest(range(CAST(s AS DATE), CAST(e AS DATE) + 1, INTERVAL 1 DAY)) AS DATE) AS day FROM lo)"""


@query(
    "i3_local_midnight_split",
    with_(EVENTS, USERS)
    + LOCAL_DAYS
    + """ SELECT eventId, day::VARCHAR AS day, (CASE WHEN CAST(s AS DATE) < day THEN CAST(day AS TIMESTAMP) ELSE s END)::VARCHAR AS startTime,
          (CASE WHEN CAST(e AS DATE) > day THEN CAST(day + 1 AS TIMESTAMP) - INTERVAL 1 SECOND ELSE e END)::VARCHAR AS endTime FROM dd""",
)
def local_midnight_split(t):
    zones = raw.users(t.customer, t.nation, t.region).select("userId", "timeZone")
    local = jn.lookup_local_time(
        raw.status_intervals(t.events, 900), zones, ["userId"], {"startTime": "startTime", "endTime": "endTime"}
    )
    return ta.split_days(local, "startTime", "endTime").select("eventId", "day", "startTime", "endTime")


@query(
    "i4_starts_per_slot",
    with_(EVENTS)
    + """, grid AS (SELECT queueId, unnest(range((SELECT date_trunc('day', min(ts)) FROM ev), (SELECT date_trunc('day', max(ts)) + INTERVAL 1 DAY FROM ev), INTERVAL 15 MINUTE)) AS slot FROM (SELECT DISTINCT queueId FROM ev)),
         c AS (SELECT queueId, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, count(*) AS n FROM ev GROUP BY queueId, time_bucket(INTERVAL 15 MINUTE, ts))
       SELECT grid.queueId, grid.slot::VARCHAR AS slot, coalesce(n, 0) AS n FROM grid LEFT JOIN c ON c.queueId = grid.queueId AND c.slot = grid.slot""",
)
def starts_per_slot(t):
    m = raw.metric_events(t.events)
    return ta.starts_per_slot(m, ["queueId"], "eventTime", 900)


@query(
    "i5_covered_hours",
    with_(EVENTS)
    + """, h AS (SELECT eventId, date_trunc('hour', ts) AS f, (epoch(date_trunc('hour', ts + to_seconds(k * 300))) - epoch(date_trunc('hour', ts)))::BIGINT // 3600 AS n FROM ev),
         x AS (SELECT *, unnest(range(0, n + 1)) AS i FROM h), y AS (SELECT *, CASE WHEN i = 0 OR i = n THEN i ELSE i + 1 END AS hr FROM x)
       SELECT eventId, i::INTEGER AS hourNo, strftime(f + to_hours(hr), '%H:%M:%S') || ' - ' || strftime(f + to_hours(hr + 1), '%H:%M:%S') AS TimeIntervalStart FROM y""",
)
def covered_hours(t):
    return ta.covered_hours(raw.status_intervals(t.events, 300), "startTime", "endTime").select(
        "eventId", "hourNo", "TimeIntervalStart"
    )


@query(
    "i6_offsets_to_times",
    with_(EVENTS) + "SELECT eventId, (ts + to_seconds(k))::VARCHAR AS startTime, (ts + to_seconds(k * 60))::VARCHAR AS endTime FROM ev",
)
def offsets_to_times(t):
    e = raw.event_rows(t.events)
    start, end = ta.offset_interval(F.col("ts"), F.col("k"), F.col("k") * 60)
    return e.select("eventId", start.alias("startTime"), end.alias("endTime"))


@query(
    "i7_forecast_axis",
    with_(EVENTS)
    + SERIES
    + """ SELECT eventId AS forecastId, 'Group ' || (eventId % 7) AS planningGroup, (date_trunc('hour', ts) + to_minutes(15 * i))::VARCHAR AS intervalStart,
          CAST(k + i AS DOUBLE) AS offered, CAST(cents * (i + 1) AS DOUBLE) AS averageHandleTimeSeconds, userId AS buName FROM series JOIN
          (SELECT eventId AS id, userId FROM ev) ON id = eventId""",
)
def forecast_axis(t):
    data, meta, groups, units = wf.forecast_inputs(t.events)
    return wf.forecast(data, meta, groups, units).select(
        "forecastId", "planningGroup", "intervalStart", "offered", "averageHandleTimeSeconds", "buName"
    )


@query(
    "i8_valid_local_times",
    """WITH l AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate + to_seconds((l_partkey * 37 + l_linenumber * 613) % 14400) AS loc FROM lineitem)
       SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, loc::VARCHAR AS loc FROM l
       WHERE (loc AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'Europe/Berlin' = loc""",
)
def valid_local_times(t):
    secs = (F.col("l_partkey") * 37 + F.col("l_linenumber") * 613) % 14400
    loc = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", raw.plus_seconds(F.col("l_shipdate"), secs).alias("loc")
    )
    return loc.filter(tm.exists_in_zone(F.col("loc"), "Europe/Berlin"))


@query(
    "i9_close_open_intervals",
    with_(EVENTS)
    + "SELECT eventId, coalesce(CASE WHEN k % 10 <> 0 THEN ts + to_seconds(k * 90) END, TIMESTAMP '2024-02-01')::VARCHAR AS endTime FROM ev",
)
def close_open_intervals(t):
    e = raw.event_rows(t.events)
    end = F.when(F.col("k") % 10 != 0, raw.plus_seconds(F.col("ts"), F.col("k") * 90))
    return e.select("eventId", ta.close_open(end, "2024-02-01").alias("endTime"))
