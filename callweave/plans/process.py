"""Conversation timeline, process map and conversation complexity."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.operators import aggregates as ag
from callweave.operators import joins as jn
from callweave.operators import ordered
from callweave.plans import conversations as cv

MEDIA = (1, 5)


def timeline(
    conversations: DataFrame,
    participants: DataFrame,
    segments: DataFrame,
    metrics: DataFrame,
    phrases: DataFrame,
    last_handled: DataFrame,
    queues: DataFrame,
) -> DataFrame:
    """Numbered timeline of queue waits, holds, transfers and utterances of transcribed conversations."""
    with_text = phrases.select("conversationId").distinct()
    voice = conversations.filter(F.col("initialSessionMediaTypeId").isin(*MEDIA)).select("conversationId")
    voice = voice.join(with_text, "conversationId", "left_semi")
    names = queues.select("queueId", "queueName")

    acd = participants.filter("purpose = 'acd'").select("conversationId", "participantId")
    queue_waits = (
        segments.join(voice, "conversationId", "left_semi")
        .join(acd, ["conversationId", "participantId"], "left_semi")
        .groupBy("conversationId", "participantId", "queueId")
        .agg(F.min("segmentStart").alias("startTime"), F.max("segmentEnd").alias("endTime"))
        .join(names, "queueId")
        .select(
            "conversationId",
            F.lit("Queue").alias("participant"),
            F.col("queueName").alias("action"),
            "startTime",
            "endTime",
            F.lit(None).cast("string").alias("userId"),
            F.lit(None).cast("double").alias("sentiment"),
        )
    )
    agents = participants.filter("purpose = 'agent'").select("conversationId", "participantId", "userId")
    known_queue = last_handled.join(names, "queueId", "left_semi").select("conversationId")
    name = F.col("name")
    handling = (
        metrics.filter(name.isin("tHeld", "nBlindTransferred", "nConsultTransferred"))
        .join(voice, "conversationId", "left_semi")
        .join(known_queue, "conversationId", "left_semi")
        .join(agents, ["conversationId", "participantId"])
        .select(
            "conversationId",
            F.when(name == "tHeld", "Hold").otherwise("Transfer").alias("participant"),
            F.when(name == "tHeld", "Hold")
            .when(name == "nBlindTransferred", "Blind Transferred")
            .otherwise("Consult Transferred")
            .alias("action"),
            # a hold is recorded when it ends
            F.when(name == "tHeld", F.timestamp_seconds(F.floor(F.unix_timestamp("eventTime") - F.col("value") / 1000)))
            .otherwise(F.col("eventTime"))
            .alias("startTime"),
            F.col("eventTime").alias("endTime"),
            "userId",
            F.lit(None).cast("double").alias("sentiment"),
        )
    )
    talk = (
        segments.filter("segmentType = 'interact'")
        .join(agents, ["conversationId", "participantId"])
        .join(names, "queueId", "left_semi")
        .select("conversationId", "userId", "segmentStart", "segmentEnd")
    )
    spoken = phrases.join(conversations.select("conversationId"), "conversationId", "left_semi").withColumn(
        "_at", F.timestamp_millis("startTimeMs")
    )
    said = jn.interval_join(spoken, talk, ["conversationId"], "_at", "segmentStart", "segmentEnd").select(
        "conversationId",
        F.when(F.col("participantPurpose") == "internal", "Agent").otherwise("Customer").alias("participant"),
        F.col("text").alias("action"),
        F.col("_at").alias("startTime"),
        F.timestamp_millis(F.col("startTimeMs") + F.col("milliseconds")).alias("endTime"),
        "userId",
        "sentiment",
    )
    every = queue_waits.unionByName(handling).unionByName(said)
    return ordered.with_ordered(
        every, ["conversationId"], ["startTime", "endTime", "participant", "action", "userId"], row_number="line"
    )


@dataclass(frozen=True)
class MapInputs:
    """Tables the process map is built from, those of conversations with their start month; conversations are already limited
    to the wanted ones."""

    conversations: DataFrame
    participants: DataFrame
    segments: DataFrame
    metrics: DataFrame
    ivr_events: DataFrame
    menus: DataFrame
    flows: DataFrame
    actions: DataFrame
    insights: DataFrame
    contact_reasons: DataFrame
    users: DataFrame
    teams: DataFrame
    queues: DataFrame
    wrap_up_codes: DataFrame
    flow_metrics: DataFrame | None = None


# fixed values: metric events of the map with their step and level
METRIC_STEPS = [
    ("nBlindTransferred", "Blind Transferred", 250),
    ("nConsultTransferred", "Consult Transferred", 300),
    ("nConsult", "Consult", 350),
    ("tHeld", "Hold", 400),
]
KEY, MONTH = "conversationId", "startMonth"
FACTS = ["participants", "segments", "metrics", "ivr_events", "menus", "flows", "actions", "insights", "contact_reasons", "flow_metrics"]


def started_since(conversations: DataFrame, date_id: int) -> DataFrame:
    """Conversations that started on the day ``date_id`` (yyyyMMdd) or later, read from the folders of these months."""
    return conversations.filter((F.col(MONTH) >= date_id // 100) & (F.col("conversationStartDateId") >= date_id))


def limited(i: MapInputs) -> MapInputs:
    """All facts limited to the wanted conversations, and all tables spread by them; each stored table is read in the folders of
    their months only."""
    wanted = i.conversations.select(MONTH, KEY)
    facts = [t for t in FACTS if getattr(i, t) is not None]
    i = replace(i, conversations=i.conversations.repartition(KEY))
    return replace(i, **{t: jn.of_wanted(getattr(i, t), wanted, MONTH, [KEY]).drop(MONTH) for t in facts})


def _step(df: DataFrame, start: Column, end: Column, name: Column, level: Column, kind: str) -> DataFrame:
    return df.select(
        KEY, start.alias("eventStart"), end.alias("eventEnd"), name.alias("eventName"), level.cast("int").alias("level"), F.lit(kind).alias("eventType")
    )


def _ivr_steps(i: MapInputs, start_level: int) -> DataFrame:
    """Start of the call, authentication and menus."""
    none, start = F.lit(None).cast("timestamp"), F.col("conversationStart")
    caller = _step(i.conversations, start, start + F.expr("interval 1 millisecond"), F.lit("Start"), F.lit(start_level), "caller")
    asked = i.ivr_events.filter("eventName = 'AuthenticationStatus'")
    auth = _step(asked, none, none, F.concat("eventName", F.lit(": "), "eventValue"), F.lit(2), "authStatus")
    menu = _step(i.menus, F.col("menuEntryTime"), F.col("menuExitTime"), F.col("menuId"), 3 + F.col("index"), "menu")
    return caller.unionByName(auth).unionByName(menu)


def map_events(i: MapInputs) -> DataFrame:
    """Steps of a conversation from all sources, with missing times filled; the facts are limited to the conversations."""
    lo, hi = F.min("segmentStart").alias("s"), F.max("segmentEnd").alias("e")
    inside = i.participants.filter(~F.col("purpose").isin("customer", "external")).select(KEY, "participantId")
    queue = (
        i.segments.join(inside, [KEY, "participantId"], "left_semi").join(i.queues.select("queueId", "queueName"), "queueId").groupBy(KEY, "queueName").agg(lo, hi)
    )
    agent = (
        i.segments.join(i.participants.filter("userId is not null").select(KEY, "participantId", "userId"), [KEY, "participantId"]).groupBy(KEY, "userId").agg(lo, hi)
    )
    # one scan of the metrics for all four kinds
    names = F.create_map(*[F.lit(x) for m, label, _ in METRIC_STEPS for x in (m, label)])
    levels = F.create_map(*[F.lit(x) for m, _, level in METRIC_STEPS for x in (m, level)])
    handled = (
        i.metrics.filter(F.col("name").isin(*[m for m, _, _ in METRIC_STEPS]))
        .select(
            KEY,
            F.col("eventTime").alias("eventStart"),
            F.col("eventTime").alias("eventEnd"),
            names[F.col("name")].alias("eventName"),
            levels[F.col("name")].cast("int").alias("level"),
            F.col("name").alias("eventType"),
        )
    )
    every = (
        _ivr_steps(i, 0)
        .unionByName(_step(queue, F.col("s"), F.col("e"), F.lit("Queue"), F.lit(100), "queue"))
        .unionByName(_step(agent, F.col("s"), F.col("e"), F.lit("Agent"), F.lit(200), "agent"))
        .unionByName(handled)
        .distinct()
    )
    return _filled(every)


def _filled(every: DataFrame) -> DataFrame:
    """Times of authentication from the step before it, missing ends from the start of the next step."""
    after = ordered.with_ordered(every, [KEY], ["level", "eventName", "eventStart", "eventEnd"], lag={"_prev": "eventEnd"})
    filled = F.col("_prev") + F.expr("interval 1 millisecond")
    is_auth = F.col("eventType") == "authStatus"
    timed = after.withColumns(
        {
            "eventStart": F.when(is_auth, F.coalesce("eventStart", filled)).otherwise(F.col("eventStart")),
            "eventEnd": F.when(is_auth, F.coalesce("eventEnd", filled)).otherwise(F.col("eventEnd")),
        }
    ).drop("_prev")
    ended = ordered.with_ordered(
        timed, [KEY], ["eventStart", "level", "eventName", "eventEnd"], lead={"_next": "eventStart"}
    )
    return ended.withColumn("eventEnd", F.coalesce("eventEnd", "_next", "eventStart")).drop("_next")


def _people(i: MapInputs) -> tuple[DataFrame, DataFrame]:
    """Names of the users and of their teams, as sorted text."""
    members = i.participants.filter("userId is not null").select(KEY, "userId").distinct()
    # people are named only for conversations that went through a known queue
    queued = i.segments.join(i.queues.select("queueId"), "queueId", "left_semi").select(KEY).distinct()
    members = members.join(queued, KEY, "left_semi")
    users = ag.text_lists(members.join(i.users.select("userId", "userName"), "userId"), [KEY], "userName", "userNames")
    teams = ag.text_lists(members.join(i.teams.select("userId", "teamName"), "userId"), [KEY], "teamName", "teamNames")
    return users, teams


def ivr_map(i: MapInputs) -> DataFrame:
    """Export of calls through the IVR: start, authentication, flows, menus, queues and agents, numbered by their first segment,
    with how the flow ended and who took part. Steps without any time are left out, and so are repeated rows."""
    i = limited(i)
    lo, hi = F.min("segmentStart").alias("s"), F.max("segmentEnd").alias("e")
    spent = i.flow_metrics.filter("name = 'tFlow'").select(KEY, "sessionId", "eventTime", "value")
    flow = i.flows.select(KEY, "sessionId", "flowName").join(spent, [KEY, "sessionId"])
    begun = F.timestamp_millis(F.unix_millis("eventTime") - F.col("value"))
    inside = i.participants.filter("purpose <> 'customer'").select(KEY, "participantId")
    queue = i.segments.join(inside, [KEY, "participantId"], "left_semi").join(i.queues.select("queueId", "queueName"), "queueId").groupBy(KEY, "queueName").agg(lo, hi)
    handlers = i.participants.filter("userId is not null").select(KEY, "participantId", "userId")
    agent = i.segments.join(handlers, [KEY, "participantId"]).groupBy(KEY, "userId").agg(lo, hi)
    agent = ordered.with_ordered(agent, [KEY], ["s", "userId"], row_number="no")
    every = (
        _ivr_steps(i, 1)
        .unionByName(_step(flow, begun, F.col("eventTime"), F.concat(F.lit("Flow: "), "flowName"), F.lit(3), "flow"))
        .unionByName(_step(queue, F.col("s"), F.col("e"), F.concat(F.lit("Queue: "), "queueName"), F.lit(100), "queue"))
        .unionByName(_step(agent, F.col("s"), F.col("e"), F.concat(F.lit("Agent "), "no"), F.lit(200), "agent"))
        .distinct()
    )
    menu = F.concat(F.lit("Menu: "), F.regexp_replace("eventName", "_", " "))
    steps = _filled(every).select(KEY, F.when(F.col("eventType") == "menu", menu).otherwise(F.col("eventName")).alias("category"), "eventStart", "eventEnd")
    facts = i.conversations.select(KEY, "location", "originatingDirectionId", F.col("initialSessionMediaTypeId").alias("mediaTypeId"))
    auth = i.ivr_events.filter("eventName = 'AuthenticationStatus'").groupBy(KEY).agg(F.max("eventValue").alias("AuthenticationStatus"))
    ended = {
        "isIVRSuccess": F.col("exitReason") == "FLOW_DISCONNECT",
        "isIVRAbandon": F.col("exitReason") == "DISCONNECTED",
        "isIVRError": F.col("exitReason") == "FLOW_ERROR_DISCONNECT",
        "hasIVRToQueueTransfer": (F.col("exitReason") == "TRANSFER") & F.col("transferType").isin("ACD", "ACD_VOICEMAIL"),
    }
    ways = i.flows.groupBy(KEY).agg(*[F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in ended.items()])
    out = steps.filter("eventEnd is not null").join(facts, KEY)
    for extra in (auth, ways, *_people(i)):
        out = out.join(extra, KEY, "left")
    return out.withColumns({n: F.coalesce(n, F.lit(False)) for n in ended}).distinct()


def process_map(i: MapInputs) -> DataFrame:
    """Process map rows: every step with the facts of its conversation.

    All facts are limited to the wanted conversations and brought to one row each first, so the joins do not multiply
    steps, apart from conversations with several contact reasons, which repeat their steps per reason.
    """
    i = limited(i)
    facts = ["location", "originatingDirectionId", "initialSessionMediaTypeId", "conversationStartDateId"]
    c = i.conversations.select(KEY, *facts)
    to_agent = (
        i.flows.filter("exitReason = 'TRANSFER' and transferType in ('ACD', 'ACD_VOICEMAIL')").select(KEY).distinct().withColumn("_acd", F.lit(True))
    )
    blank = F.lit("")
    ivr_only = F.col("_acd").isNull()

    def reason(column):
        return F.when(ivr_only, "Ended in IVR").otherwise(F.col(column))

    steps = (
        map_events(i)
        .join(to_agent, KEY, "left")
        .join(i.contact_reasons.select(KEY, "contactReason", "mainInquiry", "rootCause"), KEY, "left")
        .select(
            KEY,
            F.when(F.col("eventType") == "menu", F.concat(F.lit("Menu: "), "eventName")).otherwise(F.col("eventName")).alias("category"),
            blank.alias("action"),
            "eventStart",
            "eventEnd",
            reason("contactReason").alias("contact_reason"),
            reason("mainInquiry").alias("main_inquiry"),
            reason("rootCause").alias("root_cause"),
            blank.alias("speaker"),
        )
    )
    spoken = i.actions.select(
        KEY, "category", "action", F.col("startTime").alias("eventStart"), F.col("endTime").alias("eventEnd"),
        "contact_reason", "main_inquiry", "root_cause", "speaker",
    )
    rows = steps.unionByName(spoken).filter("eventEnd is not null").join(c, KEY)

    name = F.col("name")
    flags = i.metrics.groupBy(KEY).agg(
        F.bool_or(name == "tHeld").alias("hashold"),
        F.bool_or(name == "nConsult").alias("hasconsult"),
        F.bool_or(name == "nConsultTransferred").alias("hasconsulttransfer"),
        F.bool_or(name == "nBlindTransferred").alias("hasblindtransfer"),
    )
    flag_names = ["hashold", "hasconsult", "hasconsulttransfer", "hasblindtransfer"]
    auth = i.ivr_events.filter("eventName = 'AuthenticationStatus'").groupBy(KEY).agg(F.max("eventValue").alias("AuthenticationStatus"))
    left = i.flows.select(KEY, F.when(F.col("exitReason") == "FLOW_DISCONNECT", "resolved").alias("_flow")).groupBy(KEY).agg(F.max("_flow").alias("_flow"))
    told = i.insights.groupBy(KEY).agg(F.max("resolved").alias("_told"))
    users, teams = _people(i)
    last_queue = cv.last_segments(i.segments.withColumnRenamed("participantId", "sessionId"), [KEY]).join(i.queues, "queueId").select(
        KEY, F.col("queueName").alias("finalQueueName")
    )
    coded = i.segments.filter("segmentType = 'wrapup'").withColumnRenamed("participantId", "sessionId")
    last_code = cv.last_segments(coded, [KEY]).join(i.wrap_up_codes, "wrapUpCodeId").select(KEY, F.col("wrapUpCode").alias("finalWrapupCode"))
    out = rows
    for extra in (flags, auth, left, told, users, teams, last_queue, last_code):
        out = out.join(extra, KEY, "left")
    # the rows are spread by conversation by now, so dropping repeated rows needs no further shuffle
    return (
        out.withColumn("resolved", F.coalesce("_flow", "_told"))
        .drop("_flow", "_told")
        .withColumns({f: F.coalesce(f, F.lit(False)) for f in flag_names})
        .withColumnRenamed("initialSessionMediaTypeId", "mediaTypeId")
        .distinct()
    )


def labelled_steps(steps: DataFrame, labels: DataFrame, kind: str, text: str) -> DataFrame:
    """Steps with the label registered for their text; steps without one are left out."""
    known = labels.filter((F.col("type") == kind) & F.col("label").isNotNull() & (F.col("label") != ""))
    known = known.select(F.col("phrase").alias(text), F.col("label").alias("stepName")).distinct()
    return steps.join(known, text)


CLOSE = "Close and Offer Additional Assistance"


def numbered_steps(steps: DataFrame, config: DataFrame) -> DataFrame:
    """``steps`` with ``_exp`` (1 for a configured step), ``_no`` (configured steps so far, which numbers the stretches
    between them) and ``_nextExp``. Null times and names come first; a null name is no step."""
    known = config.select("stepName").distinct().withColumn("_known", F.lit(1).cast("long"))
    rows = steps.join(known, "stepName", "left").withColumn("_exp", F.coalesce("_known", F.lit(0).cast("long"))).drop("_known")
    return ordered.with_ordered(
        rows, ["conversationId"], ["startTime", "stepName", "endTime", "sentiment"], running_sum={"_no": "_exp"}, lead={"_nextExp": "_exp"}
    )


def complexity(steps: DataFrame, config: DataFrame, close: str = CLOSE, extract_date: int | None = None) -> DataFrame:
    """Effort per conversation and expected step, of the conversations that started on ``extract_date`` or of all.

    ``steps`` has conversationId, conversationStartDateId, startTime, endTime, stepName, sentiment;
    ``config`` has stepName, counterStep, value. Holds, transfers and other steps between two expected
    steps count for the earlier one. What comes before the first or after the last expected step does
    not count. Expected steps that a conversation lacks come out with zeros.
    """
    key = "conversationId"
    if extract_date is not None:
        steps = steps.filter(F.col("conversationStartDateId") == extract_date)
    rows = numbered_steps(steps, config)
    own = rows.filter("_exp = 1")
    other = ~F.col("stepName").isin("Hold", "Transfer")
    between = (
        rows.filter("_exp = 0 and _no > 0")
        .groupBy(key, "_no")
        .agg(
            F.count_if(F.col("stepName") == "Hold").alias("hold"),
            F.count_if(F.col("stepName") == "Transfer").alias("transfer"),
            F.count_if(other).alias("violation"),
            F.countDistinct(F.when(other, F.col("stepName"))).alias("distinct_violation_count"),
        )
    )
    at = F.struct("_no")
    first_close = own.filter(F.col("stepName") == close).groupBy(key).agg(F.min("startTime").alias("_close"))
    per_conversation = (
        own.join(first_close, key, "left")
        .groupBy(key)
        .agg(
            F.max("_no").alias("_last"),
            F.max_by("stepName", at).alias("_lastStep"),
            F.max_by(F.when(F.col("startTime") < F.col("_close"), F.col("stepName")), F.when(F.col("startTime") < F.col("_close"), F.col("_no"))).alias("_beforeClose"),
        )
    )
    counted = own.join(per_conversation, key).join(between, [key, "_no"], "left")
    measures = ["hold", "transfer", "violation", "distinct_violation_count"]
    kept = F.col("_no") < F.col("_last")
    n = F.count(F.lit(1))
    done = counted.groupBy(key, "stepName").agg(
        *[F.sum(F.when(kept, F.coalesce(m, F.lit(0))).otherwise(0)).cast("int").alias(m) for m in measures],
        (n * (n + 1) / 2).cast("int").alias("step_count"),
        F.avg(F.coalesce("_nextExp", F.lit(0))).alias("next_step_expected"),
        F.sum(F.unix_timestamp("endTime") - F.unix_timestamp("startTime")).cast("double").alias("duration"),
        F.min_by("sentiment", at).alias("sentiment"),
        F.bool_or(F.col("stepName") == F.col("_lastStep")).alias("is_last_step"),
        F.bool_or(F.coalesce(F.col("stepName") == F.col("_beforeClose"), F.lit(False))).alias("is_last_before_close"),
    )
    everyone = steps.groupBy(key).agg(F.min("conversationStartDateId").alias("conversationStartDateId"))
    # every configured step is wanted of every conversation: the list is one value of the query
    wanted = config.agg(F.collect_list(F.struct("stepName", "counterStep", "value"))).scalar()
    grid = everyone.withColumn("_w", F.explode(wanted)).select(key, "conversationStartDateId", "_w.*")
    out = grid.join(done, [key, "stepName"], "left").select(
        key,
        F.col("stepName").alias("steps"),
        *[F.coalesce(m, F.lit(0)).alias(m) for m in ["step_count", *measures]],
        F.when(F.col("step_count").isNull(), 0).otherwise(1).alias("step_done"),
        F.coalesce("next_step_expected", F.lit(0.0)).alias("next_step_expected"),
        F.coalesce("duration", F.lit(0.0)).alias("duration"),
        F.coalesce("sentiment", F.lit(0.0)).alias("_own"),
        F.col("counterStep").alias("counter_step"),
        "value",
        "conversationStartDateId",
        F.coalesce("is_last_step", F.lit(False)).alias("is_last_step"),
        F.coalesce("is_last_before_close", F.lit(False)).alias("is_last_before_close"),
    )
    # one row per configured step
    return ordered.with_ordered(out, [key], ["steps"], running_max={"sentiment": "_own"}).drop("_own")


def action_extract(steps: DataFrame, conversations: DataFrame) -> DataFrame:
    """Stored steps with direction, media type and location of their conversation."""
    c = conversations.select(KEY, "originatingDirectionId", F.col("initialSessionMediaTypeId").alias("mediaTypeId"), "location")
    return steps.join(c, KEY)


def complexity_by_group(steps: DataFrame, config: DataFrame, group_rows: int = 50_000) -> DataFrame:
    """The counts of ``complexity`` by a function over groups of rows.

    A group is a stretch of at most ``group_rows`` rows, of whatever conversations; its counts are partial ones, which add up to
    the same result however rows are cut. So the number of calls follows from the rows and not from the conversations.
    """
    import pandas as pd

    rows = numbered_steps(steps, config)
    owners = rows.filter("_exp = 1").select(KEY, "_no", F.col("stepName").alias("owner"))
    last = owners.groupBy(KEY).agg(F.max("_no").alias("_last"))
    own = owners.select(KEY, "owner", F.lit(None).cast("string").alias("label"), F.lit(True).alias("own"), "_no")
    inside = rows.filter("_exp = 0 and _no > 0").join(last, KEY).filter("_no < _last")
    inside = inside.join(owners, [KEY, "_no"]).select(KEY, "owner", F.col("stepName").alias("label"), F.lit(False).alias("own"), "_no")
    cut = own.unionByName(inside)
    cut = cut.withColumn("part", F.floor(F.monotonically_increasing_id() / group_rows))

    def count(group: pd.DataFrame) -> pd.DataFrame:
        label = group["label"]
        kinds = pd.DataFrame(
            {
                KEY: group[KEY],
                "steps": group["owner"],
                "n": group["own"],
                "hold": label == "Hold",
                "transfer": label == "Transfer",
                "violation": label.notna() & ~label.isin(["Hold", "Transfer"]),
            }
        )
        # a null conversation or step is one like others
        out = kinds.groupby([KEY, "steps"], as_index=False, dropna=False).sum()
        return out.astype({c: "int64" for c in ("n", "hold", "transfer", "violation")})

    counts = ["n", "hold", "transfer", "violation"]
    schema = f"{KEY} string, steps string, n long, hold long, transfer long, violation long"
    partial = cut.groupBy("part").applyInPandas(count, schema).groupBy(KEY, "steps").agg(*[F.sum(c).alias(c) for c in counts])
    wanted = config.agg(F.collect_set("stepName")).scalar()
    grid = steps.select(KEY).distinct().withColumn("steps", F.explode(wanted))
    n = F.coalesce("n", F.lit(0))
    return grid.join(partial, [KEY, "steps"], "left").select(
        KEY, "steps", (n * (n + 1) / 2).cast("int").alias("step_count"), *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in counts[1:]]
    )
