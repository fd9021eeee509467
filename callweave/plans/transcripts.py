"""Facts out of transcript result documents, and steps anchored to transcript lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.operators import nested as ns
from callweave.operators import ordered


def latest_result(results: DataFrame) -> DataFrame:
    """Newest document per conversation; of several at one time the one whose content has the smallest hash."""
    content = F.md5(F.to_json(F.struct(*results.columns)))
    return ordered.newest(results, ["conversation_id"], F.col("recordInsertTime").desc(), content.asc()).withColumnRenamed(
        "conversation_id", "conversationId"
    )


def result_rows(
    results: DataFrame, conversations: DataFrame, array: str, fields: dict[str, str], *deeper: tuple[str, str]
) -> DataFrame:
    """Rows of a result array with the date key of their conversation.

    ``fields`` goes from result column to path below the element ``x`` (or a deeper element).
    """
    dates = conversations.select("conversationId", "conversationStartDateId")
    rows = ns.flatten(
        latest_result(results),
        ["conversationId", *[F.col(path).alias(name) for name, path in fields.items()]],
        (array, "x"),
        *deeper,
    )
    return rows.join(dates, "conversationId")


def insights(results: DataFrame, conversations: DataFrame) -> DataFrame:
    fields = {c: f"x.{c}" for c in ("sentiment", "resolved", "satisfaction", "additional_service", "process_name")}
    return result_rows(results, conversations, "insights", fields)


def contact_reasons(results: DataFrame, conversations: DataFrame) -> DataFrame:
    fields = {
        "contactReason": "c.contact_reason",
        "mainInquiry": "q.main_inquiry",
        "rootCause": "q.root_cause",
        "inquiry_type": "q.inquiry_type",
    }
    return result_rows(results, conversations, "insights", fields, ("x.contact", "c"), ("c.inquiries", "q"))


def knowledge_scores(results: DataFrame, conversations: DataFrame) -> DataFrame:
    fields = {"npsScore": "x.scoring.nps_score", "knowledgeScore": "x.scoring.knowledge_score"}
    return result_rows(results, conversations, "insights", fields)


def answers(results: DataFrame, conversations: DataFrame, array: str) -> DataFrame:
    """Question and answer rows of quality, compliance and conformance checks."""
    fields = {"question": "x.question", "answer": "x.answer"}
    return result_rows(results, conversations, array, fields).withColumn("answer", F.lower(F.trim("answer")))


def objections(results: DataFrame, conversations: DataFrame) -> DataFrame:
    fields = {
        "objection": "x.objection",
        "startLine": "x.objection_start_line",
        "action": "x.action",
        "stageName": "x.stage_name",
    }
    return result_rows(results, conversations, "objection", fields)


def apprehensions(results: DataFrame, conversations: DataFrame) -> DataFrame:
    fields = {"apprehension": "x.apprehension", "severity": "x.severity"}
    return result_rows(results, conversations, "apprehension", fields)


def summaries(results: DataFrame, conversations: DataFrame) -> DataFrame:
    dates = conversations.select("conversationId", "conversationStartDateId")
    return latest_result(results).select("conversationId", "summary").join(dates, "conversationId")


def numbered_phrases(phrases: DataFrame) -> DataFrame:
    """Phrases of a conversation numbered along their start time."""
    return ordered.with_ordered(phrases, ["conversationId"], ["startTimeMs"], row_number="line")


def anchored_times(steps: DataFrame, lines: DataFrame, step_columns: Sequence[str], keep_unanchored: bool = False) -> DataFrame:
    """Start and end time of steps from their first and last line.

    The start is that of the line ``startLine``, the end that of ``endLine`` plus its duration. A step
    with one anchor takes it for both; a step that ends before it starts is turned around. Steps whose
    lines do not exist are left out, or kept without times.
    """
    mood = ["sentiment"] if "sentiment" in lines.columns else []
    ends = F.array_compact(F.array_distinct(F.array("startLine", "endLine")))
    wanted = steps.select("conversationId", *step_columns, F.explode(ends).alias("line"))
    at = lines.select("conversationId", "line", "startTimeMs", "milliseconds", *mood)
    start = F.timestamp_seconds(F.floor(F.col("startTimeMs") / 1000))
    end = F.timestamp_seconds(F.floor((F.col("startTimeMs") + F.coalesce("milliseconds", F.lit(0))) / 1000))
    keys = ["conversationId", *step_columns]
    times = (
        wanted.join(at, ["conversationId", "line"])
        .groupBy(*keys, *mood)
        .agg(
            F.min(F.when(F.col("line") == F.col("startLine"), start)).alias("_s"),
            F.max(F.when(F.col("line") == F.col("endLine"), end)).alias("_e"),
        )
    )
    s, e = F.coalesce("_s", "_e"), F.coalesce("_e", "_s")
    out = times.withColumns({"startTime": F.least(s, e), "endTime": F.greatest(s, e)}).drop("_s", "_e")
    if not keep_unanchored:
        return out
    on = ordered.same_keys("a", "b", keys)
    lost = steps.select(*keys).distinct().alias("a").join(out.alias("b"), on, "left_anti")
    return out.unionByName(lost, allowMissingColumns=True)


def mean_sentiment(steps: DataFrame, sentiments: DataFrame, step_columns: Sequence[str]) -> DataFrame:
    """Average sentiment of the phrases from the start to the end line of a step.

    Lines that the conversation does not have are left out before a step is spread over its lines.
    """
    bounds = sentiments.groupBy("conversationId").agg(F.min("phraseIndex").alias("_first"), F.max("phraseIndex").alias("_last"))
    known = steps.join(bounds, "conversationId").withColumns({"_from": F.greatest("startLine", "_first"), "_to": F.least("endLine", "_last")})
    spread = known.filter("startLine <= endLine and _from <= _to").select(
        "conversationId", *step_columns, F.explode(F.sequence("_from", "_to")).alias("phraseIndex")
    )
    scores = sentiments.groupBy("conversationId", "phraseIndex").agg(
        F.sum("sentiment").alias("_sum"), F.count("sentiment").alias("_n")
    )
    return (
        spread.join(scores, ["conversationId", "phraseIndex"])
        .groupBy("conversationId", *step_columns)
        .agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias("sentiment"))
    )


def actions(steps: DataFrame, lines: DataFrame, sentiments: DataFrame, known: DataFrame) -> DataFrame:
    """Action steps with times and mean sentiment, for conversations not stored yet."""
    columns = [c for c in steps.columns if c != "conversationId"]
    fresh = steps.join(known.select("conversationId").distinct(), "conversationId", "left_anti")
    timed = anchored_times(fresh, lines.drop("sentiment"), columns)
    mood = mean_sentiment(fresh.distinct(), sentiments, columns)
    on = ordered.same_keys("a", "b", ["conversationId", *columns])
    return timed.alias("a").join(mood.alias("b"), on, "left").select("a.*", "b.sentiment")
