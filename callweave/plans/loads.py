"""Table loads from delivered files, roster reconciliation, labels and transcript hand-off."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions import text as tx
from callweave.functions import times as tm
from callweave.operators import aggregates as ag
from callweave.operators import nested as ns
from callweave.operators import ordered, reshape
from callweave.operators import upserts as up
from callweave.sources import sheets


def attendance(rows: DataFrame) -> DataFrame:
    """Attendance sheet: date in any of the known formats, clock times to timestamps, overnight logout."""
    day = F.to_date(tm.parse_any(F.col("date"), ["dd-MM-yyyy", "yyyy-MM-dd", "MM/dd/yyyy"]))

    def at(column):
        return F.try_to_timestamp(F.concat_ws(" ", day.cast("string"), F.nullif(F.col(column), F.lit("-"))), F.lit("yyyy-MM-dd HH:mm:ss"))

    present = F.lower(F.trim("status")).isin("present", "p", "half day")
    login, logout = at("login"), at("logout")
    out = rows.select("userId", day.alias("reportDate"), present.alias("isPresent"), login.alias("loginTime"), tm.overnight(login, logout).alias("logoutTime"))
    return ordered.newest(out, ["userId", "reportDate"], F.col("isPresent").desc(), F.col("loginTime").asc_nulls_last(), F.col("logoutTime").asc_nulls_last())


def day_wise(rows: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Long (id, date, measure, value) rows to one wide row; measures absent from the file stay empty."""
    return reshape.pivot_sum(rows, ["userId", "date"], "measure", "value", measures)


def wide_days(sheet: DataFrame, ids: Sequence[str], days: Sequence[str], value: str) -> DataFrame:
    """Day columns headed by spreadsheet serial numbers to (id, date, value) rows."""
    rows = reshape.unpivot(sheet, ids, days, "_serial", value).filter(F.col(value).isNotNull())
    return rows.select(*ids, reshape.serial_day(F.col("_serial")).alias("date"), value)


def conformance(rows: DataFrame, durations: Sequence[str]) -> DataFrame:
    """Conformance sheet: duration texts to seconds, '-' to empty, one row per (id, date)."""
    names = [c for c in rows.columns if c not in durations]
    out = rows.select(*[F.nullif(F.col(c), F.lit("-")).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes if c in names], *[tm.clock_seconds(F.col(d)).alias(d) for d in durations])
    return ordered.newest(out, ["ecn", "date"], *[F.col(c).asc() for c in out.columns if c not in ("ecn", "date")])


def month_to_date(lines: DataFrame, columns: Mapping[str, str], numbers: Sequence[str], percents: Sequence[str], org: str, date_at: int = 2, header_at: int = 3) -> DataFrame:
    """Month-to-date sheets, one row an employee: the date stands in the first cell of line ``date_at``, the header in line
    ``header_at``, and the line named Grand Total ends the table.

    ``columns`` are new names to header texts, with ``Name`` and ``Emp_ID`` among them; ``numbers`` become numbers and ``percents``
    also 100 times as great, null where the sheet has something else. Rows without a name are left out, repeated ones count once.
    """
    rows = sheets.table(lines, columns, header_at, total="Grand Total", total_in="Name").filter("Name is not null")
    first = F.get(sheets.cells(F.col("line"), 2), F.lit(0))
    days = lines.filter(F.col("position") == date_at).select("file", F.to_date(F.try_to_timestamp(first, F.lit("dd-MM-yyyy"))).alias("MTD_DT"))
    values = {"Emp_ID": F.col("Emp_ID").try_cast("int")}
    values |= {c: F.col(c).try_cast("double") * (100 if c in percents else 1) for c in numbers}
    kept = [values[c].alias(c) if c in values else F.col(c) for c in columns]
    return rows.join(days, "file", "left").select(*kept, "MTD_DT", F.lit("T1").alias("Tier"), F.lit(org).alias("orgId")).distinct()


def agent_performance(rows: DataFrame, people: DataFrame, code: str, missing: str = "DNA") -> DataFrame:
    """Rows of a performance sheet with the user they are about: the person's system id or, where that is unknown or ``missing``, the
    code itself. ``people`` has ``empCode`` and ``systemId``; rows of unknown people have no user."""
    known = people.select(F.col("empCode").alias("_code"), "systemId")
    user = F.when(F.col("systemId").isNull() | (F.col("systemId") == missing), F.col("_code")).otherwise(F.col("systemId"))
    return rows.join(known, F.col(code) == F.col("_code"), "left").select(user.alias("userId"), *[F.col(f"`{c}`") for c in rows.columns])


def behaviour_scores(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Behaviour scores keyed by the id in brackets after the name; only new (id, month) pairs are added."""
    fresh = rows.select(tx.bracketed_id(F.col("agent")).alias("userId"), "month", F.col("score").try_cast("double").alias("score")).filter("userId is not null")
    return up.merge_new(known, fresh.distinct(), ["userId", "month"])


def workforce(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Workforce export with the matched user; unmatched people keep no user."""
    return rows.join(matches.select("personId", "userId", "matchedBy"), "personId", "left")


def reconcile(roster: DataFrame, users: DataFrame) -> DataFrame:
    """Delivered roster against stored users: who to create, update or deactivate.

    Ids are compared without case. Rows without a usable mail address are not created. Active users
    missing from the roster are deactivated.
    """
    r = roster.select(F.lower("userId").alias("_k"), F.col("userId"), "email", "team")
    u = users.select(F.lower("userId").alias("_k"), F.col("userId").alias("_id"), F.col("email").alias("_mail"), F.col("team").alias("_team"), "isActive")
    both = r.join(u, "_k", "full")
    changed = ~F.col("email").eqNullSafe(F.col("_mail")) | ~F.col("team").eqNullSafe(F.col("_team")) | ~F.col("isActive")
    usable = F.coalesce(F.trim("email").rlike("^[^@\\s-][^@\\s]*@[^@\\s]+$"), F.lit(False))
    action = (
        F.when(F.col("_id").isNull() & usable, "create")
        .when(F.col("userId").isNull() & F.col("isActive"), "deactivate")
        .when(F.col("userId").isNotNull() & F.col("_id").isNotNull() & changed, "update")
    )
    return both.select(F.coalesce("userId", "_id").alias("userId"), action.alias("action"), F.coalesce("email", "_mail").alias("email"), F.coalesce("team", "_team").alias("team")).filter("action is not null")


def new_phrases(rows: DataFrame, ids: Sequence[str], columns: Sequence[str], labels: DataFrame) -> DataFrame:
    """Distinct (type, phrase) pairs that have no label entry yet, with an empty label."""
    found = reshape.unpivot(rows, ids, columns, "type", "phrase").filter("phrase is not null and phrase <> ''").select("type", "phrase").distinct()
    return up.without(found, labels, ["type", "phrase"], null_safe=False).withColumn("label", F.lit(None).cast("string"))


def phrase_batches(phrases: DataFrame, size: int, workers: Sequence[str]) -> DataFrame:
    """Phrases in numbered batches, dealt to the workers in turn."""
    numbered = ordered.number_all(phrases, ["type", "phrase"], "_row")
    slot = F.element_at(F.array(*[F.lit(w) for w in workers]), ((F.col("_row") - 1) % len(workers) + 1).cast("int"))
    return numbered.withColumns({"batch": F.ceil(F.col("_row") / size).cast("int"), "worker": slot}).drop("_row")


def import_labels(labels: DataFrame, answers: DataFrame) -> DataFrame:
    """Returned labels over the registry; of several answers for a phrase the smallest label counts."""
    one = answers.groupBy("type", "phrase").agg(F.min("label").alias("label"))
    return up.merge_all(labels, one, ["type", "phrase"], check=False)


def classification_scores(documents: DataFrame) -> DataFrame:
    """Best category per phrase by confidence, then name."""
    rows = ns.flatten(
        documents, ["type", F.col("raw_phrases").alias("phrase"), F.col("c.category"), F.col("c.confidence")], ("classification", "c")
    )
    return ordered.newest(rows, ["type", "phrase"], F.col("confidence").desc(), F.col("category").asc())


def transcripts_to_analyse(
    lines: DataFrame, analysed: DataFrame, tasks: DataFrame, batch_size: int, workers: Sequence[str], lines_per_part: int
) -> DataFrame:
    """Assembled transcripts of conversations not analysed yet, with task flags, batch and worker."""
    fresh = lines.join(analysed.select("conversationId").distinct(), "conversationId", "left_anti")
    text = F.concat(F.col("line"), F.lit(" "), "participant", F.lit(": "), "phrase")
    parts = ag.assemble_lines(fresh, "conversationId", "line", text, "transcript", lines_per_part)
    flags = tasks.groupBy("conversationId").agg(
        F.bool_or(F.col("task") == "insights").alias("needsInsights"), F.bool_or(F.col("task") == "map").alias("needsMap")
    )
    flagged = parts.join(flags, "conversationId", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("needsInsights", "needsMap")})
    numbered = ordered.number_all(flagged.select("conversationId", "part", "transcript", "needsInsights", "needsMap"), ["conversationId", "part"], "_row")
    slot = F.element_at(F.array(*[F.lit(w) for w in workers]), ((F.col("_row") - 1) % len(workers) + 1).cast("int"))
    return numbered.withColumns({"batch": F.ceil(F.col("_row") / batch_size).cast("int"), "worker": slot}).drop("_row")


def transcript_candidates(
    handled: DataFrame, talk: DataFrame, queues: DataFrame, codes: DataFrame, analysed: DataFrame, success: Sequence[str], failure: str, quota: int = 5, min_talk: int = 60
) -> DataFrame:
    """Conversations whose transcript is wanted: all sales, and the newest failures up to a quota per agent.

    The quota counts the failures of the agent that were analysed already.
    """
    long_talk = talk.groupBy("conversationId").agg(F.sum("tTalkComplete").alias("_talk")).filter(F.col("_talk") > min_talk).select("conversationId")
    base = (
        handled.filter("mediaType in ('voice', 'callback')")
        .join(queues.filter("language = 'English'").select("queueId"), "queueId", "left_semi")
        .join(codes.select(F.col("wrapUpCodeId").alias("wrapUpCode"), F.col("wrapUpCode").alias("codeName")), "wrapUpCode")
        .join(long_talk, "conversationId", "left_semi")
    )
    seen = analysed.select("conversationId").distinct()
    sales = base.filter(F.col("codeName").isin(*success)).join(seen, "conversationId", "left_anti").select("conversationId", "userId", F.lit("sale").alias("reason"))
    failed = base.filter(F.col("codeName") == failure)
    done = failed.join(seen, "conversationId", "left_semi").groupBy("userId").agg(F.count(F.lit(1)).alias("_done"))
    open_ = failed.join(seen, "conversationId", "left_anti")
    newest = ordered.top_n(open_, ["userId"], quota, F.col("conversationStart").desc(), F.col("conversationId").desc(), name="_no")
    kept = newest.join(done, "userId", "left").filter(F.col("_no") <= quota - F.coalesce("_done", F.lit(0)))
    return sales.unionByName(kept.select("conversationId", "userId", F.lit("failure").alias("reason")))


def customer_sessions(details: DataFrame, scored: DataFrame) -> DataFrame:
    """Customer sessions of scored conversations."""
    s = ns.conversation_sessions(details).filter("purpose in ('customer', 'external')")
    return s.join(scored.select("conversationId").distinct(), "conversationId", "left_semi").select(
        "conversationId", F.col("sessionId").alias("communicationId")
    ).distinct()


def handoff_audit(handed: DataFrame, conversations: DataFrame, exported_at: str) -> DataFrame:
    """Audit rows of a hand-off: one per conversation and worker, for conversations that are known."""
    dates = conversations.select("conversationId", "conversationStartDateId")
    once = handed.select("conversationId", F.col("worker").alias("region")).distinct()
    return once.join(dates, "conversationId").withColumns(
        {"isExported": F.lit(True), "exportedTimestamp": F.to_timestamp(F.lit(exported_at))}
    )


def not_analysed(conversations: DataFrame, analysed: DataFrame, start: str, end: str) -> DataFrame:
    """Ids of the conversations extracted in [start, end) that have no analysis yet."""
    at = F.col("extractedAt")
    inside = conversations.filter((at >= F.to_timestamp(F.lit(start))) & (at < F.to_timestamp(F.lit(end))))
    return inside.select("conversationId").distinct().join(analysed.select("conversationId"), "conversationId", "left_anti")
