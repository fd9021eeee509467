"""Targets of the second telephony connector, declared as data: columns by name, types by rule, how a load meets the table.

All of them are filled by one projection (``operators.projections.typed``) from delivered rows whose values are text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.operators.projections import typed

#: The extract a row came with.
WINDOW = "extractDate extractIntervalStartTime extractIntervalEndTime"

# fixed values: measures of performance facts, shared by teams and agents
PERFORMANCE = """agentOffered inboundHandled inboundTime inboundTalkTime inboundAvgTalkTime outboundHandled outboundTime outboundTalkTime outboundAvgTalkTime
totalHandled totalTalkTime totalAvgTalkTime totalAvgHandleTime consultTime availableTime unavailableTime acwTime refused percentRefused loginTime workingRate occupancy"""
# fixed values: measures of contact facts, open and completed ones
CONTACT = """contactId agentId skillId teamId campaignId primaryDispositionId secondaryDispositionId abandonSeconds acwSeconds agentSeconds callbackTime
conferenceSeconds holdSeconds inQueueSeconds postQueueSeconds preQueueSeconds releaseSeconds totalDurationSeconds serviceLevelFlag isOutbound isRefused
isShortAbandon abandoned holdCount highProficiency lowProficiency"""
# fixed values: descriptive columns of contacts, open and completed ones
CONTACT_TEXT = """contactId masterContactId contactStartDate endReason fromAddress toAddress mediaTypeId mediaTypeName mediaSubTypeId mediaSubTypeName
pointOfContactId pointOfContactName refuseReason routingAttribute transferIndicatorId transferIndicatorName isTakeover isLogged isAnalyticsProcessed"""

# fixed values: columns of the targets that each load replaces
REPLACED = {
    "agents_skills": "skillId useDisposition useSecondaryDispositions requireDisposition useACW outboundStrategy extractDate",
    "contacts": f"{CONTACT_TEXT} agentStartDate digitalContactStateId digitalContactStateName contactStateCategory fileName stateId stateName targetAgentId isWarehoused",
    "dispositions": f"dispositionId dispositionName notes lastUpdated classificationId systemOutcome isActive isPreviewDisposition {WINDOW}",
    "dispositions_skills": f"dispositionId dispositionName isActive skills {WINDOW}",
    "skills": "skillId skillName mediaTypeId mediaTypeName isActive campaignId campaignName notes isOutbound outboundStrategy isRunning scriptId scriptName serviceLevelThreshold serviceLevelGoal",
    "teams": "teamId teamName isActive description notes lastUpdateTime inViewEnabled wfoEnabled maxConcurrentChats agentCount analyticsEnabled teamLeadId totalContactCount",
    "interaction_history": f"contactId masterContactId contactStartDate targetAgentId fileName lastUpdateTime mediaTypeId mediaTypeName agentId firstName lastName teamId teamName skillId skillName isOutbound fromAddr toAddr {WINDOW}",
    "agent_skill_facts": f"agentId skillId campaignId agentProficiencyValue agentProficiencyName isSkillActive isDialer lastUpdateTime lastPollTime {WINDOW}",
    "contact_facts": f"{CONTACT} {WINDOW}",
    "media_playback": f"contactId acdcontactId brandEmbassyConfig elevatedInteraction interactions {WINDOW}",
    "sla_summary": f"skillId contactsWithinSLA contactsOutOfSLA totalContacts serviceLevel {WINDOW}",
    "skill_summary": f"skillId mediaTypeId campaignId contactsOffered contactsHandled abandonCount averageHandleTime abandonRate {WINDOW}",
    "team_performance": f"teamId {PERFORMANCE} {WINDOW}",
}
# fixed values: columns of the targets that each load adds to
APPENDED = {
    "agents": "agentId userName firstName lastName userId emailAddress isActive teamId teamName reportToId isSupervisor lastUpdated location timeZone hireDate hourlyCost",
    "contacts_completed": f"{CONTACT_TEXT} lastUpdateTime extractDate",
    "contact_facts_completed": f"{CONTACT} {WINDOW}",
    "contact_custom_data": f"contactId name value {WINDOW}",
    "agent_performance": f"agentId teamId {PERFORMANCE} {WINDOW}",
}

_WHOLE = ("Id", "Count", "Contacts", "Handled", "Offered", "SLA", "Chats", "refused", "abandoned", "Flag")
_DECIMAL = ("Seconds", "Rate", "Cost", "Value", "Proficiency", "occupancy", "serviceLevel", "Threshold", "Goal", "percentRefused")
_SPANS = ("TalkTime", "HandleTime", "inboundTime", "outboundTime", "consultTime", "availableTime", "unavailableTime", "acwTime", "loginTime", "callbackTime")
_FLAGS = ("Enabled", "Disposition", "Dispositions", "useACW", "elevatedInteraction")
_TIMES = ("Time", "Date", "lastUpdated")


def kind(column: str) -> T.DataType:
    """Type of a target column, by its name."""
    if column.startswith("is") or column.endswith(_FLAGS) and not column.endswith("Id"):
        return T.BooleanType()
    if column.endswith((*_DECIMAL, *_SPANS)):
        return T.DoubleType()
    if column.endswith(_WHOLE):
        return T.LongType()
    return T.TimestampType() if column.endswith(_TIMES) else T.StringType()


@dataclass(frozen=True)
class Target:
    """Schema of a target and whether a load replaces it or adds to it."""

    schema: T.StructType
    replaces: bool


def target(name: str) -> Target:
    names = (REPLACED if name in REPLACED else APPENDED)[name].split()
    return Target(T.StructType([T.StructField(n, kind(n)) for n in names]), name in REPLACED)


def load(delivered: DataFrame, name: str, path: str) -> None:
    """Project delivered text to the target's columns and types; distinct rows replace the table at ``path`` or are added to it.

    Columns that a delivery lacks are null, columns that the target lacks are left out."""
    t = target(name)
    source = {f.name: f.name if f.name in delivered.columns else F.lit(None) for f in t.schema}
    typed(delivered, t.schema, source).distinct().write.mode("overwrite" if t.replaces else "append").parquet(path)
