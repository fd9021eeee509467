"""Declared exports over registered tables: windows of facts as CSV files, dimensions under the warehouse's names."""

from __future__ import annotations

from callweave.plans import exports
from callweave.queries import dashboards, facts, marts, sources  # noqa: F401  (their tables are exported)
from callweave.queries.registry import REGISTRY, query
from callweave.session import scratch_path

#: Table and window of each fact's export, and table of each dimension's.
FACTS = {
    "metrics": ("d12_metrics", "1998-03-01", "1998-04-01"),
    "evaluations": ("d5_evaluations", "1998-03-01", "1998-04-01"),
    "presence": ("d7_primary_presence", "2024-01-08", "2024-01-15"),
    "routing": ("d7_routing_status", "2024-01-08", "2024-01-15"),
    "surveys": ("d11_conversation_surveys", "1998-03-01", "1999-03-01"),
    "attributes": ("d13_ivr_events", "2024-01-08", "2024-01-15"),
    "topics": ("d9_topics", "2024-01-01", "2024-01-02"),
    "sentiments": ("d9_sentiments", "2024-01-01", "2024-01-02"),
}
DIMENSIONS = {
    "forms": "d10_forms",
    "users": "d10_users",
    "user_groups": "d10_user_groups",
    "queues": "d10_queues",
    "codes": "d10_wrap_up_codes",
    "question_scores": "d6_evaluation_question_scores",
    "group_scores": "d6_evaluation_group_scores",
    "total_scores": "d6_evaluation_total_scores",
    "presence_labels": "d7_detailed_presence",
    "unit_mapping": "d8_wfm_actuals",
    "issues": "s9_flatten_issue",
    "languages": "d29_queue_language",
}


def _names(export):
    return ", ".join(f'{old} AS "{new}"' for old, new in export.names.items())


def _table(t, name):
    """Speech tables carry the day of their conversation by its phrases."""
    rows = REGISTRY[name].build(t)
    if name in ("d9_topics", "d9_sentiments"):
        days = REGISTRY["d9_phrases"].build(t).select("communicationId", "conversationStartDate").distinct()
        rows = rows.join(days, "communicationId")
    return rows


def _table_sql(name):
    sql = REGISTRY[name].sql
    if name in ("d9_topics", "d9_sentiments"):
        return f"SELECT x.*, conversationStartDate FROM ({sql}) x JOIN (SELECT DISTINCT communicationId, conversationStartDate FROM ({REGISTRY['d9_phrases'].sql})) USING (communicationId)"
    return sql


def _register_fact(name, table, start, end):
    export = exports.FACTS[name]
    at = f"CAST({export.time} AS TIMESTAMP)"

    @query(f"p15_export_{name}", f"SELECT {_names(export)} FROM ({_table_sql(table)}) WHERE {at} >= '{start}' AND {at} < '{end}'")
    def fact_export(t):
        return exports.export_window(_table(t, table), export, scratch_path(t.spark, f"export-{name}"), start, end)


def _register_dimension(name, table):
    export = exports.DIMENSIONS[name]

    @query(f"p14_export_{name}", f"SELECT DISTINCT {_names(export)} FROM ({REGISTRY[table].sql})")
    def dimension_export(t):
        return exports.export_dimension(REGISTRY[table].build(t), export)


for _name, _source in FACTS.items():
    _register_fact(_name, *_source)
for _name, _source in DIMENSIONS.items():
    _register_dimension(_name, _source)
