"""Conversation dimensions and facts out of the nested payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import times as tm
from callweave.operators import nested as ns
from callweave.operators import ordered, reshape
from callweave.operators import upserts as up
from callweave.operators.aggregates import count_positive
from callweave.session import cut_lineage

# fixed values: metric names of the interval fact
COUNTED = ["tAbandon", "tAcd", "tAcw", "tAnswered", "tHandle", "tHeldComplete", "tShortAbandon", "tTalkComplete"]
SUMMED = [
    "nBlindTransferred", "nConnected", "nConsult", "nConsultTransferred", "nError", "nOffered", "nOutbound",
    "nOutboundAbandoned", "nOutboundAttempted", "nOutboundConnected", "nOverSla", "nTransferred",
]
TIMED = [
    "tAbandon", "tAcd", "tAcw", "tAgentResponseTime", "tAnswered", "tContacting", "tDialing", "tHandle", "tHeldComplete",
    "tIvr", "tNotResponding", "tShortAbandon", "tTalkComplete", "tVoicemail", "tWait",
]


def last_segments(segments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last segment per key by end time."""
    return ordered.newest(segments, keys, F.col("segmentEnd").desc(), F.col("sessionId").desc())


def last_handled(segments: DataFrame) -> DataFrame:
    """Last segment with a wrap-up code, or the last segment of a conversation without any code."""
    return ordered.newest(
        segments,
        ["conversationId"],
        F.col("wrapUpCode").isNotNull().desc(),
        F.col("segmentEnd").desc(),
        F.col("sessionId").desc(),
    )


def fill_ends(df: DataFrame, keys: Sequence[str], start: str, end: str, tie: str) -> DataFrame:
    """Missing end = start of the next row, else the own start."""
    out = ordered.with_ordered(df, keys, [start, tie], lead={"_next": start})
    return out.withColumn(end, F.coalesce(end, "_next", start)).drop("_next")


def fill_starts(df: DataFrame, keys: Sequence[str], position: str, start: str, end: str) -> DataFrame:
    """Missing start = end of the previous row plus one millisecond."""
    out = ordered.with_ordered(df, keys, [position], lag={"_prev": end})
    return out.withColumn(start, F.coalesce(F.col(start), F.col("_prev") + F.expr("interval 1 millisecond"))).drop("_prev")


def within_quota(
    df: DataFrame, done: DataFrame, keys: Sequence[str], count: str, quota: int, *order: Column
) -> DataFrame:
    """Newest rows per key, as many as the quota leaves after those already done."""
    first = ordered.top_n(df, keys, quota, *order, name="_no")
    out = first.join(done, list(keys), "left")
    return out.filter(F.col("_no") <= quota - F.coalesce(F.col(count), F.lit(0))).drop("_no", count)


def latest_intervals(df: DataFrame, keys: Sequence[str], end: str, open_end: str, *tie: Column) -> DataFrame:
    """Interval with the latest end per key; an open one counts as ending at ``open_end``."""
    return ordered.newest(df, keys, F.coalesce(F.col(end), F.to_timestamp(F.lit(open_end))).desc(), *tie)


def agent_sessions(details: DataFrame) -> DataFrame:
    """One row per agent session with first and last segment fields."""
    s = ns.conversation_sessions(details).filter("purpose = 'agent'")
    return s.select(
        "conversationId",
        "conversationStart",
        "conversationEnd",
        "originatingDirection",
        ns.first_of("segments", "segmentStart").alias("sessionStart"),
        ns.last_of("segments", "segmentEnd").alias("sessionEnd"),
        ns.first_of("segments", "queueId").alias("queueId"),
        "mediaType",
        "messageType",
        F.col("userId").alias("agentId"),
        ns.last_of("segments", "wrapUpCode").alias("wrapUpCode"),
        ns.last_of("segments", "wrapUpNote").alias("wrapUpNote"),
        F.to_date("conversationStart").alias("conversationStartDate"),
        "dnis",
    ).distinct()


def interval_metrics(details: DataFrame) -> DataFrame:
    """Interval metric fact: counts and seconds per agent, media, queue, code and quarter hour.

    A metric counts when its sum over one session set and emit time is positive, so metrics are first
    summed per (session attributes, emit time) and then rolled up to the quarter hour. Where ``details`` has a
    ``recordInsertTime`` a conversation may be delivered several times (each time once) and the newest delivery counts:
    the facts carry the time and are dropped when a later one exists, which spares a shuffle of the payloads.
    """
    stamp = [c for c in ("recordInsertTime",) if c in details.columns]
    keys = ["conversationId", "agentId", "mediaType", "messageType", "originatingDirection", *stamp]
    held = ns.flatten(
        details,
        [
            "conversationId",
            F.col("p.userId").alias("agentId"),
            F.col("s.mediaType"),
            F.col("s.messageType"),
            "originatingDirection",
            *stamp,
            F.col("p.purpose"),
            F.col("s.segments"),
            F.col("s.metrics"),
        ],
        ("participants", "p"),
        ("p.sessions", "s"),
    ).select(
        *keys,
        "purpose",
        # segment lists tell sessions apart; their hash is enough for that and much narrower
        F.xxhash64("segments").alias("_segments"),
        ns.first_of("segments", "queueId").alias("queueId"),
        ns.last_of("segments", "wrapUpCode").alias("wrapUpCode"),
        ns.last_of("segments", "wrapUpNote").alias("wrapUpNote"),
        "metrics",
    )
    # sessions are shuffled once, before their metrics are exploded; both roll-ups keep that partitioning
    fields = [*keys, "purpose", "_segments", "queueId", "wrapUpCode", "wrapUpNote"]
    rows = held.repartition("conversationId").select(*fields, F.explode("metrics").alias("m")).select(
        *fields, F.col("m.emitDate"), F.col("m.name"), F.coalesce("m.value", F.lit(0).cast("long")).alias("value")
    )
    names = sorted({*COUNTED, *SUMMED, *TIMED})
    sessions = reshape.pivot_sum(rows, [*fields, "emitDate"], "name", "value", names)
    aggs = [F.max("wrapUpNote").alias("wrapUpNote")]
    aggs += [count_positive(m).alias("n" + m[1:]) for m in COUNTED]
    aggs += [F.sum(F.coalesce(m, F.lit(0))).alias(m) for m in SUMMED]
    aggs += [(F.sum(F.coalesce(m, F.lit(0))) / 1000.0).alias(m) for m in TIMED]
    out = sessions.groupBy(
        *keys, "queueId", "wrapUpCode", tm.quarter_hour(F.col("emitDate")).alias("emitDateTime")
    ).agg(*aggs)
    out = out.withColumnRenamed("tAgentResponseTime", "tAgentResponse").withColumn("emitDate", F.to_date("emitDateTime"))
    if stamp:
        newest = details.groupBy("conversationId").agg(F.max("recordInsertTime").alias("recordInsertTime"))
        out = out.join(newest, ["conversationId", "recordInsertTime"], "left_semi").drop("recordInsertTime")
    return out


def load_interval_metrics(stored: DataFrame, details: DataFrame, extract_date: str, start: str, end: str) -> DataFrame:
    """The stored fact after one extract window: its conversations are replaced, all others stay.

    ``details`` has extractDate, extractIntervalStartTime and extractIntervalEndTime; loaded rows carry the window as
    ``sourcePartition``.
    """
    window = (
        (F.col("extractDate") == F.lit(extract_date))
        & (F.col("extractIntervalStartTime") == F.lit(start))
        & (F.col("extractIntervalEndTime") == F.lit(end))
    )
    # matched and inserted: two reads of one computed batch
    fresh = cut_lineage(interval_metrics(details.filter(window))).withColumn("sourcePartition", F.lit(f"{extract_date}|{start}|{end}"))
    return up.replace_matching(stored, fresh, ["conversationId"])


def aggregated_intervals(payloads: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pre-aggregated intervals: ``<metric>_count/_sum/_max/_min`` per group and interval."""
    m = ns.flatten(
        payloads,
        ["group.*", F.col("d.interval"), F.col("x.metric"), F.col("x.stats")],
        ("data", "d"),
        ("d.metrics", "x"),
    )
    keys = [c for c in m.columns if c not in ("interval", "metric", "stats")]
    bounds = F.split("interval", "/")
    rows = m.select(
        *keys,
        F.get(bounds, F.lit(0)).cast("timestamp").alias("intervalStart"),
        F.get(bounds, F.lit(1)).cast("timestamp").alias("intervalEnd"),
        "metric",
        "stats.*",
    )
    wide = reshape.pivot_stats(
        rows,
        [*keys, "intervalStart", "intervalEnd"],
        "metric",
        names,
        count=F.sum("count"),
        sum=F.sum("sum"),
        max=F.max("max"),
        min=F.min("min"),
    )
    return wide.withColumn("date", F.to_date("intervalStart"))
