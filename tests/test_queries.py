"""Registered queries against their SQL. All of them with CALLWEAVE_ALL=1, else one of each kind."""

import os

import pytest

import __spark_entry__ as entry_module
from callweave.queries.registry import REGISTRY
from harness import compare, duck

FOLDER = "/root/testdata/sf0.001"
USUAL = """s1_read_json_strict s7_delimited_dump s18_numbered_batches w1_merge_all w4_null_safe_merge w8_replace_partitions p7_exclusion_list p12_region_slice
n1_flatten_levels n12_array_membership_join j4_full_outer_chain j5_dense_grid j6_point_in_interval j12_cascading_name_match a7_count_distinct a9_transcript_text
a15_formula_kpis x3_last_segment x7_rank_with_ties x16_quota l3_shares u2_distinct_union v2_stats_pivot v9_attribute_rows f2_zone_conversion f10_clean_text
i1_half_hour_slices i3_local_midnight_split i5_covered_hours d2_interval_metric_fact d3_aggregated_interval_fact d8_wfm_day_metrics d9_phrases d12_conversations
d16_value_stream d17_timeline d18_process_map d24_user_kpis d27_complexity d30_survey_wide_row d35_survey_kpis d40_kpi_values d41_logins_by_shift d43_roster_reconcile
d46_transcript_candidates g9_facet st2_interval_board st2_latest_local_day st4_queue_board p1_contacts p2_agent_performance p14_export_queues p15_export_metrics
d7_routing_status d18_recent_process_map d18_ivr_export d39_coaching_documents d42_month_to_date_load d42_agent_performance_load""".split()
NAMES = list(REGISTRY) if os.environ.get("CALLWEAVE_ALL") else USUAL


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    problems, n = compare(spark, con, FOLDER, REGISTRY[name])
    assert not problems, "\n".join(problems)
    assert n > 0


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
