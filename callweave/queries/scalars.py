"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.functions import scores as sc
from callweave.functions import text as tx
from callweave.functions import times as tm
from callweave.operators import joins as jn
from callweave.queries.prelude import EVENTS, PHRASES, TURNS, USERS, with_
from callweave.queries.registry import query
from callweave.sources import raw


@query(
    "f1_quarter_hour_floor",
    "SELECT event_id, time_bucket(INTERVAL 15 MINUTE, ts)::VARCHAR AS slot FROM events",
)
def quarter_hour_floor(t):
    return t.events.select("event_id", tm.quarter_hour(F.col("ts")).alias("slot"))


@query(
    "f2_zone_conversion",
    """SELECT o_orderkey, ((o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'Australia/Sydney')::VARCHAR AS sydney,
       ((o_orderdate AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC')::VARCHAR AS utc,
       ((o_orderdate AT TIME ZONE 'America/New_York') AT TIME ZONE 'Europe/Berlin')::VARCHAR AS chained FROM orders""",
)
def zone_conversion(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        tm.to_local(d, "Australia/Sydney").alias("sydney"),
        F.to_utc_timestamp(d, "America/New_York").alias("utc"),
        tm.between_zones(d, "America/New_York", "Europe/Berlin").alias("chained"),
    )


@query(
    "f3_epoch_conversions",
    with_(PHRASES)
    + "SELECT communicationId, phraseIndex, epoch_ms(base + phraseIndex * 10)::VARCHAR AS at, (base + phraseIndex * 10) // 1000 AS seconds FROM phrases",
)
def epoch_conversions(t):
    rows = raw.speech_transcripts(t.conversations).select(
        "communicationId", F.explode(F.col("transcripts")[0]["phrases"]).alias("p")
    )
    at = tm.from_millis(F.col("p.startTimeMs"))
    return rows.select("communicationId", F.col("p.phraseIndex").cast("long").alias("phraseIndex"), at.alias("at"), F.unix_timestamp(at).alias("seconds"))


@query(
    "f4_backdated_events",
    with_(EVENTS) + "SELECT eventId, (ts - to_milliseconds(cents))::VARCHAR AS startTime FROM ev",
)
def backdated_events(t):
    return raw.event_rows(t.events).select("eventId", tm.backdated(F.col("ts"), F.col("cents")).alias("startTime"))


@query(
    "f5_calendar",
    """SELECT o_orderkey, (CAST(o_orderdate AS DATE) - 5)::VARCHAR AS back5, CAST(o_orderdate - INTERVAL 12 MONTH AS DATE)::VARCHAR AS backYear,
       last_day(o_orderdate)::VARCHAR AS monthEnd, date_diff('minute', o_orderdate, TIMESTAMP '2002-01-01') AS minutes,
       (o_orderdate + INTERVAL 90 MINUTE)::VARCHAR AS later, date_trunc('month', o_orderdate)::TIMESTAMP::VARCHAR AS monthStart FROM orders""",
)
def calendar(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.date_sub(d, 5).alias("back5"),
        F.add_months(d, -12).alias("backYear"),
        F.last_day(d).alias("monthEnd"),
        tm.minutes_between(d, F.to_timestamp(F.lit("2002-01-01"))).alias("minutes"),
        F.timestamp_add("MINUTE", F.lit(90), d).alias("later"),
        F.date_trunc("month", d).alias("monthStart"),
    )


@query(
    "f6_sequences",
    with_(EVENTS)
    + "SELECT eventId, unnest(range(ts, ts + to_seconds(k * 60) + INTERVAL 1 SECOND, INTERVAL 15 MINUTE))::VARCHAR AS tick FROM ev",
)
def sequences(t):
    iv = raw.status_intervals(t.events)
    ticks = F.sequence("startTime", "endTime", F.expr("interval 15 minutes"))
    return iv.select("eventId", F.explode(ticks).alias("tick"))


@query(
    "f7_multi_format_dates",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN CAST(o_orderdate AS DATE)::VARCHAR END AS day FROM orders",
)
def multi_format_dates(t):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    text = (
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k == 1, F.date_format(d, "dd/MM/yyyy"))
        .when(k == 2, F.date_format(d, "MMM d, yyyy"))
        .otherwise("unknown")
    )
    parsed = tm.parse_any(text, ["yyyy-MM-dd", "dd/MM/yyyy", "MMM d, yyyy"])
    return t.orders.select("o_orderkey", F.to_date(parsed).alias("day"))


@query(
    "f8_zulu_offset",
    with_(EVENTS) + "SELECT eventId, (ts + to_seconds(k * 60))::VARCHAR AS startTime FROM ev",
)
def zulu_offset(t):
    e = raw.event_rows(t.events)
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return e.select("eventId", tm.zulu(text, F.col("k") * 60).alias("startTime"))


@query(
    "f9_sentinel_dates",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::VARCHAR END AS completedAt FROM orders",
)
def sentinel_dates(t):
    text = F.when(F.col("o_orderstatus") == "P", tm.NO_DATE).otherwise(F.col("o_orderdate").cast("string"))
    return t.orders.select("o_orderkey", tm.without_sentinel(text).alias("completedAt"))


@query(
    "f10_clean_text",
    r"""SELECT doc_id, regexp_replace(regexp_replace(text, '[\r\n]+', ' ', 'g'), '["'']', '', 'g') AS cell,
       regexp_replace(text, '[^\p{L}\p{N}]', ' ', 'g') AS plain FROM documents""",
)
def clean_text(t):
    return t.documents.select(
        "doc_id", tx.clean_cell(F.col("text")).alias("cell"), tx.letters_and_digits(F.col("text")).alias("plain")
    )


@query(
    "f11_token_times",
    with_(EVENTS)
    + """SELECT eventId, CASE WHEN k % 3 <> 0 THEN ts::VARCHAR END AS at, eventType AS name FROM ev""",
)
def token_times(t):
    e = raw.event_rows(t.events)
    token = F.when(F.col("k") % 3 == 0, F.col("eventType")).otherwise(
        F.concat_ws("_", F.date_format("ts", "yyyyMMddHHmmss"), "eventType")
    )
    return e.select("eventId", tm.token_time(token).alias("at"), tm.token_name(token).alias("name"))


# fixed values: wordings from worst to best
RANKS = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@query(
    "f12_ordinal_scores",
    """SELECT o_orderkey, CAST((6 - CAST(substring(o_orderpriority, 1, 1) AS INTEGER)) * 20 AS INTEGER) AS score,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS resolved FROM orders""",
)
def ordinal_scores(t):
    answer = F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("no")
    return t.orders.select(
        "o_orderkey", sc.ordinal_score(F.col("o_orderpriority"), RANKS).alias("score"), sc.yes_flag(answer).alias("resolved")
    )


@query(
    "f13_null_handling",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(nullif(l_discount, 0), -1.0::DOUBLE) AS disc, try_cast(l_returnflag AS INTEGER) AS num,
       l_quantity / nullif(l_tax, 0) AS ratio, least(l_quantity, 25.0::DOUBLE) AS capped FROM lineitem""",
)
def null_handling(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.coalesce(F.nullif("l_discount", F.lit(0.0)), F.lit(-1.0)).alias("disc"),
        F.col("l_returnflag").try_cast("int").alias("num"),
        F.try_divide("l_quantity", "l_tax").alias("ratio"),
        F.least("l_quantity", F.lit(25.0)).alias("capped"),
    )


@query(
    "f14_name_parsing",
    """SELECT c_custkey, 'Ann' AS firstName, 'O-' || c_custkey AS lastName, 'Customer' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS plain,
       CAST(c_custkey AS VARCHAR) AS id FROM customer""",
)
def name_parsing(t):
    full = F.concat(F.lit(" Ann Mary O-"), F.col("c_custkey").cast("string"))
    tagged = F.concat("c_name", F.lit(" (team) ("), F.col("c_custkey").cast("string"), F.lit(")"))
    return t.customer.select(
        "c_custkey",
        tx.first_name(full).alias("firstName"),
        tx.last_name(full).alias("lastName"),
        F.regexp_replace("c_name", "[^A-Za-z0-9 ]", "").alias("plain"),
        tx.bracketed_id(tagged).alias("id"),
    )


@query(
    "f15_durations",
    with_(EVENTS)
    + """SELECT eventId, CAST(k * 3600 + 61 AS INTEGER) AS seconds,
         (CASE WHEN k >= 50 THEN ts + INTERVAL 1 DAY - to_seconds(60 * k) ELSE ts + to_seconds(60 * k) END)::VARCHAR AS logout FROM ev""",
)
def durations(t):
    e = raw.event_rows(t.events)
    text = F.concat(F.lpad(F.col("k").cast("string"), 2, "0"), F.lit(":01:01"))
    logout = raw.plus_seconds(F.col("ts"), F.when(F.col("k") >= 50, -60 * F.col("k")).otherwise(60 * F.col("k")))
    return e.select("eventId", tm.clock_seconds(text).alias("seconds"), tm.overnight(F.col("ts"), logout).alias("logout"))


@query(
    "f16_hour_labels",
    with_(EVENTS)
    + "SELECT eventId, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00:00 - ' || lpad(CAST(hour(ts) + 1 AS VARCHAR), 2, '0') || ':00:00' AS slotLabel FROM ev",
)
def hour_labels(t):
    return raw.event_rows(t.events).select("eventId", tm.hour_label(F.col("ts")).alias("slotLabel"))


@query(
    "ud1_text_cleaner",
    r"SELECT conv_id, turn, trim(regexp_replace(text, '[^\p{L}\p{N}]', ' ', 'g')) AS cleaned FROM conversations",
)
def text_cleaner(t):
    return t.conversations.select("conv_id", "turn", F.trim(tx.letters_and_digits(F.col("text"))).alias("cleaned"))


@query(
    "ud2_clock_change_gap",
    """WITH l AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, date_trunc('day', l_shipdate) + to_seconds((l_partkey * 37 + l_linenumber * 613) % 14400) AS loc FROM lineitem)
       SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, loc::VARCHAR AS loc FROM l
       WHERE (loc AT TIME ZONE 'America/New_York') AT TIME ZONE 'America/New_York' <> loc
          OR extract(hour FROM loc) = 3""",
)
def clock_change_gap(t):
    secs = (F.col("l_partkey") * 37 + F.col("l_linenumber") * 613) % 14400
    loc = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", raw.plus_seconds(F.col("l_shipdate"), secs).alias("loc")
    )
    return loc.filter(~tm.exists_in_zone(F.col("loc"), "America/New_York") | (F.hour("loc") == 3))


@query(
    "ud4_line_of_business_lookup",
    with_(USERS)
    + "SELECT userId, CASE department WHEN 'MACHINERY' THEN 'Campaign M' WHEN 'BUILDING' THEN 'Campaign B' END AS campaign FROM users",
)
def line_of_business_lookup(t):
    u = raw.users(t.customer, t.nation, t.region).select("userId", "department")
    lookup = t.spark.createDataFrame(
        [("MACHINERY", "Campaign M"), ("BUILDING", "Campaign B")], "department string, campaign string"
    )
    return u.join(lookup, "department", "left").select("userId", "campaign")


@query(
    "ud3_zip_series",
    with_(EVENTS)
    + """SELECT eventId, (ts + to_seconds(i * 900))::VARCHAR AS at, k + i AS offered, cents * (i + 1) AS handled FROM ev, LATERAL (SELECT unnest(range(0, 3)) AS i)""",
)
def zip_series(t):
    from callweave.operators import nested as ns

    axis = F.sequence(F.lit(0), F.lit(2))
    e = raw.event_rows(t.events).withColumns(
        {
            "offered": F.transform(axis, lambda i: F.col("k").cast("long") + i),
            "handled": F.transform(axis, lambda i: F.col("cents") * (i + 1)),
        }
    )
    return ns.series_rows(e, ["eventId"], "ts", 900, ["offered", "handled"], at="at")
