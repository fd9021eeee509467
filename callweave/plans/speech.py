"""Speech analytics: phrases, sentiments, topics and conversation scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions import text as tx
from callweave.operators import nested as ns


def sentiments(transcripts: DataFrame) -> DataFrame:
    return ns.flatten(
        transcripts,
        [
            "conversationId",
            "communicationId",
            F.col("s.participant"),
            F.col("s.phrase"),
            F.col("s.sentiment"),
            F.col("s.phraseIndex"),
            F.col("s.startTimeMs"),
        ],
        ("transcripts", "t"),
        ("t.analytics.sentiment", "s"),
    ).distinct()


def topics(transcripts: DataFrame) -> DataFrame:
    return ns.flatten(
        transcripts,
        [
            "conversationId",
            "communicationId",
            "mediaType",
            F.col("x.participant"),
            F.col("x.topicId"),
            F.col("x.transcriptPhrase"),
            F.col("x.confidence"),
        ],
        ("transcripts", "t"),
        ("t.analytics.topics", "x"),
    ).distinct()


def phrases(transcripts: DataFrame, found: DataFrame) -> DataFrame:
    """Phrases with their sentiment, matched on conversation, participant and normalised text."""
    p = ns.flatten(
        transcripts,
        [
            "conversationId",
            "communicationId",
            F.col("t.transcriptId"),
            F.col("p.text"),
            F.col("p.startTimeMs"),
            F.col("p.duration.milliseconds"),
            F.col("p.participantPurpose"),
            F.to_date(F.timestamp_millis("conversationStartTime")).alias("conversationStartDate"),
        ],
        ("transcripts", "t"),
        ("t.phrases", "p"),
    ).withColumn("_key", tx.normalised(F.col("text")))
    s = found.select(
        "conversationId",
        F.col("participant").alias("participantPurpose"),
        tx.normalised(F.col("phrase")).alias("_key"),
        "sentiment",
    )
    return p.join(s, ["conversationId", "participantPurpose", "_key"], "left").drop("_key")


def conversation_scores(payloads: DataFrame) -> DataFrame:
    return payloads.select(
        F.col("conversation.id").alias("conversationId"), "sentimentScore", "sentimentTrend", "participantMetrics.*"
    ).distinct()
