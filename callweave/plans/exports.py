"""Exports declared as data: which columns of a table go out, under which names, and what limits a window."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from callweave.operators.projections import half_open, renamed
from callweave.sources import writers


@dataclass(frozen=True)
class Export:
    """New names by the table's column names, and the column that a window is cut by (none for whole dimensions)."""

    names: Mapping[str, str]
    time: str | None = None


def _same(*columns: str, **changed: str) -> dict[str, str]:
    return {**{c: c for c in columns}, **changed}


# fixed values: exports of flattened facts, cut by a window of time
FACTS = {
    "metrics": Export(_same("conversationId", "sessionId", "eventTime", "mediaTypeId", name="metric", value="metricValue"), "eventTime"),
    "evaluations": Export(_same("evaluationId", "evaluatorId", "agentId", "conversationId", "status", "mediaType", "queueId", evaluationFormId="formId", wrapUpCode="wrapUpCodeId"), "conversationDatePart"),
    "presence": Export(_same("userId", "startTime", "endTime", systemPresence="presence"), "startTime"),
    "routing": Export(_same("userId", "startTime", "endTime", routingStatus="status"), "startTime"),
    "surveys": Export(_same("surveyId", "conversationId", "agentId", "queueId", "surveyStatus", surveyPromoterScore="npsScore", oSurveyTotalScore="totalScore"), "conversationStart"),
    "attributes": Export(_same("conversationId", "attribute", "eventTime", eventName="value"), "eventTime"),
    "topics": Export(_same("conversationId", "communicationId", "topicId", "confidence", participant="speaker", transcriptPhrase="phrase"), "conversationStartDate"),
    "sentiments": Export(_same("conversationId", "communicationId", "phraseIndex", "sentiment", participant="speaker"), "conversationStartDate"),
}

# fixed values: exports of dimensions under the warehouse's names
DIMENSIONS = {
    "forms": Export(_same("evaluationFormId", "evaluationFormName", published="isPublished")),
    "users": Export(_same("userId", "userFullName", "department", "state", "managerId", email="userEmail", managerName="managerFullName")),
    "user_groups": Export(_same("userId", "groupId", "groupName")),
    "queues": Export(_same("queueId", "queueName", callSlaDuration="callSLDuration", callSlaPercentage="callSLPercentage", chatSlaDuration="chatSLDuration", chatSlaPercentage="chatSLPercentage", emailSlaDuration="emailSLDuration", emailSlaPercentage="emailSLPercentage")),
    "codes": Export(_same("wrapUpCode", wrapUpId="wrapupId")),
    "question_scores": Export(_same("evaluationId", "questionGroupId", "questionId", answerId="answerOptionId", score="questionScore")),
    "group_scores": Export(_same("evaluationId", "questionGroupId", totalScore="score", maxTotalScore="maxScore")),
    "total_scores": Export(_same("evaluationId", "totalScore", totalCriticalScore="criticalScore")),
    "presence_labels": Export(_same(presenceDefinitionName="presenceName", presenceDefinitionSystemPresence="systemPresence", presenceDefinitionLabel="label")),
    "unit_mapping": Export(_same("userId", "managementUnitId")),
    "issues": Export(_same("issueId", "projectKey", "priority", "status", "market", "brand", issueKey="key", assigneeName="assignee")),
    "languages": Export(_same("queueId", "language", queueName="queue")),
}


def export_window(facts: DataFrame, export: Export, path: str, start: str, end: str) -> DataFrame:
    """Rows of ``[start, end)`` under the export's names, written as CSV files below ``path`` and read back in their types."""
    out = renamed(half_open(facts, export.time, start, end), export.names)
    writers.write_csv_snapshot(out, path)
    return facts.sparkSession.read.schema(out.schema).options(**writers.CSV_OPTIONS).csv(path)


def export_dimension(dimension: DataFrame, export: Export) -> DataFrame:
    """Distinct rows under the warehouse's names."""
    return renamed(dimension, export.names).distinct()
