"""Star-schema inputs derived from the driver tables; an order is a conversation, a line a participant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.sources import raw


#: What the star tables take of an order.
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


def start_month(at: Column) -> Column:
    """yyyyMM as an integer: the folder of the stored star tables."""
    return F.year(at) * 100 + F.month(at)


def _month(df: DataFrame) -> list[str]:
    """The start month goes along where the rows have it."""
    return [c for c in ("startMonth",) if c in df.columns]


def conversations(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return orders.select(
        key.cast("string").alias("conversationId"),
        F.col("o_orderdate").alias("conversationStart"),
        (F.col("o_orderdate") + F.expr("interval 1 hour")).alias("conversationEnd"),
        raw.day_number(F.col("o_orderdate")).alias("conversationStartDateId"),
        start_month(F.col("o_orderdate")).alias("startMonth"),
        F.when(F.col("o_orderstatus") == "O", 2).otherwise(1).alias("originatingDirectionId"),
        F.when(key % 3 == 0, 5).when(key % 3 == 1, 1).otherwise(2).alias("initialSessionMediaTypeId"),
        F.concat(F.lit("site "), F.col("o_custkey") % 4).alias("location"),
    )


def participants(sessions: DataFrame) -> DataFrame:
    s = sessions
    is_agent = F.col("lineNumber") % 2 == 1
    return s.select(
        "conversationId",
        F.col("sessionId").alias("participantId"),
        F.when(is_agent, "agent").otherwise("acd").alias("purpose"),
        F.when(is_agent, F.col("agentId")).alias("userId"),
        *_month(s),
    )


def segments(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "conversationId",
        F.col("sessionId").alias("participantId"),
        "queueId",
        "segmentStart",
        "segmentEnd",
        F.when(F.col("wrapUpCode").isNotNull(), "wrapup").otherwise("interact").alias("segmentType"),
        F.col("wrapUpCode").alias("wrapUpCodeId"),
        *_month(sessions),
    )


def metrics(sessions: DataFrame) -> DataFrame:
    """Long metrics; a metric that a line lacks gives no row."""
    def m(name, value):
        return F.struct(F.lit(name).alias("name"), value.cast("long").alias("value"))

    flag, tax = F.col("returnFlag"), F.col("taxPct")
    every = F.array(
        m("tHandle", F.col("quantity") * 1000),
        m("tTalkComplete", F.col("quantity") * 700),
        m("tHeldComplete", F.when(F.col("discountPct") > 0, F.col("discountPct") * 1000)),
        m("tHeld", F.when(F.col("discountPct") > 0, F.col("discountPct") * 1000)),
        m("tAcw", F.when(tax > 0, tax * 1000)),
        m("nBlindTransferred", F.when((flag == "R") & (tax > 4), F.lit(1))),
        m("nConsultTransferred", F.when((flag == "A") & (tax > 6), F.lit(1))),
        m("nConsult", F.when((flag == "A") & (tax > 3), F.lit(1))),
    )
    rows = sessions.select(
        "conversationId", F.col("sessionId").alias("participantId"), F.col("segmentEnd").alias("eventTime"), F.explode(every).alias("m"), *_month(sessions)
    )
    return rows.select("conversationId", "participantId", "eventTime", "m.name", "m.value", *_month(rows)).filter("value is not null")


def insights(orders: DataFrame) -> DataFrame:
    status, rank = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    return orders.filter("o_orderkey % 6 <> 0").select(
        F.col("o_orderkey").cast("string").alias("conversationId"),
        F.when(status == "F", "Resolved").when(status == "P", "Partially Resolved").otherwise("not resolved").alias("resolved"),
        F.when(rank == "5", "lowest").when(rank == "4", "low").when(rank == "3", "medium").when(rank == "2", "High").otherwise("highest").alias("satisfaction"),
        F.when(F.col("o_orderkey") % 4 == 0, "Yes").otherwise("no").alias("additional_service"),
        F.concat(F.lit("process "), F.col("o_custkey") % 6).alias("process_name"),
        *_month(orders),
    )


def contact_reasons(orders: DataFrame) -> DataFrame:
    who = F.col("o_custkey")
    return orders.filter("o_orderkey % 5 <> 0").select(
        F.col("o_orderkey").cast("string").alias("conversationId"),
        F.concat(F.lit("reason "), who % 5).alias("contactReason"),
        F.concat(F.lit("inquiry "), who % 7).alias("mainInquiry"),
        F.concat(F.lit("cause "), who % 3).alias("rootCause"),
        *_month(orders),
    )


def queues(part: DataFrame) -> DataFrame:
    """Queues 0..24 without the last, with language, region and zone."""
    n = F.col("p_partkey") % 25
    zones = list(raw.REGION_ZONES.items())
    region = F.element_at(F.array(*[F.lit(r) for r, _ in zones]), (n % 5 + 1).cast("int"))
    zone = F.element_at(F.array(*[F.lit(z) for _, z in zones]), (n % 5 + 1).cast("int"))
    return (
        part.select(
            F.concat(F.lit("queue-"), n).alias("queueId"),
            F.concat(F.lit("Queue "), n).alias("queueName"),
            F.when(n % 2 == 0, "English").otherwise("German").alias("language"),
            region.alias("region"),
            zone.alias("timeZone"),
        )
        .filter("queueId <> 'queue-24'")
        .distinct()
    )


def wrap_up_codes(part: DataFrame) -> DataFrame:
    """Codes 0..8 with sales and decision-maker flags."""
    n = F.col("p_partkey") % 10
    return (
        part.filter(n != 9)
        .select(
            F.concat(F.lit("code-"), n).alias("wrapUpCodeId"),
            F.concat(F.lit("Code "), n).alias("wrapUpCode"),
            (n < 3).alias("sales"),
            (n < 6).alias("decisionMakerContact"),
        )
        .distinct()
    )


def agents(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    n = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return supplier.join(n, supplier.s_nationkey == n.n_nationkey).select(
        F.concat(F.lit("agent-"), "s_suppkey").alias("userId"),
        F.col("s_name").alias("userName"),
        F.col("n_name").alias("teamName"),
        F.col("r_name").alias("region"),
        raw.zone_of(F.col("r_name")).alias("timeZone"),
        (F.col("s_acctbal") > 0).alias("active"),
        F.col("s_suppkey").alias("userNo"),
    )


def ivr_events(orders: DataFrame) -> DataFrame:
    return orders.filter("o_orderkey % 2 = 0").select(
        F.col("o_orderkey").cast("string").alias("conversationId"),
        F.lit("AuthenticationStatus").alias("eventName"),
        F.col("o_orderstatus").alias("eventValue"),
        *_month(orders),
    )


def menus(orders: DataFrame) -> DataFrame:
    start = F.col("o_orderdate")
    menu = F.array(
        F.struct(F.lit(0).alias("index"), F.lit("main").alias("menuId"), raw.plus_seconds(start, F.lit(10)).alias("menuEntryTime"), raw.plus_seconds(start, F.lit(20)).alias("menuExitTime")),
        F.struct(F.lit(1).alias("index"), F.lit("billing").alias("menuId"), raw.plus_seconds(start, F.lit(20)).alias("menuEntryTime"), F.lit(None).cast("timestamp").alias("menuExitTime")),
    )
    key = F.col("o_orderkey").cast("string").alias("conversationId")
    return orders.filter("o_custkey % 3 = 0").select(key, F.explode(menu).alias("m"), *_month(orders)).select("conversationId", "m.*", *_month(orders))


def flows(orders: DataFrame) -> DataFrame:
    who, key = F.col("o_custkey") % 4, F.col("o_orderkey")
    left = F.when(who == 1, "FLOW_DISCONNECT").when(who == 2, "TRANSFER").when(key % 2 == 0, "DISCONNECTED").otherwise("FLOW_ERROR_DISCONNECT")
    return orders.filter(who != 0).select(
        key.cast("string").alias("conversationId"),
        F.concat(key, F.lit("-f")).alias("sessionId"),
        F.concat(F.lit("Flow "), key % 3).alias("flowName"),
        left.alias("exitReason"),
        F.when(who == 2, "ACD").otherwise("NONE").alias("transferType"),
        *_month(orders),
    )


def flow_metrics(orders: DataFrame) -> DataFrame:
    """Time spent in a flow, recorded when it ends."""
    return orders.filter("o_custkey % 4 <> 0").select(
        F.col("o_orderkey").cast("string").alias("conversationId"),
        F.concat("o_orderkey", F.lit("-f")).alias("sessionId"),
        raw.plus_seconds(F.col("o_orderdate"), F.lit(40)).alias("eventTime"),
        F.lit("tFlow").alias("name"),
        (F.col("o_custkey") % 30 * 1000 + 250).cast("long").alias("value"),
        *_month(orders),
    )


def actions(orders: DataFrame) -> DataFrame:
    """Steps told by transcripts; some have no end."""
    key, start = F.col("o_orderkey"), F.col("o_orderdate")
    return orders.filter("o_orderkey % 7 = 1").select(
        key.cast("string").alias("conversationId"),
        F.lit("Talk").alias("category"),
        F.lit("ask").alias("action"),
        start.alias("startTime"),
        F.when(key % 2 == 0, raw.plus_seconds(start, F.lit(60))).alias("endTime"),
        F.lit("r").alias("contact_reason"),
        F.lit("m").alias("main_inquiry"),
        F.lit("c").alias("root_cause"),
        F.lit("agent").alias("speaker"),
        *_month(orders),
    )
