"""Registered queries against their DuckDB oracles (subset; the full run is
``python tests/run_oracles.py``) and the driver smoke entry."""

import pytest

import __spark_entry__ as se
from kindred.plans import load_registry
from conftest import SF01
from oracle_util import compare, duck

FAST = ["user_features_wide", "pivot_country", "top_day_of_month", "share_tier1", "session_time_stats",
        "scan_pageviews", "anti_null_aware", "latest_content", "sample_visitors", "class_mix_all",
        "compare_top_k", "weighted_f1", "probability_histogram", "stratified_holdout", "fn_word_count",
        "profile_nulls", "sink_append_roundtrip", "dedupe_visitor_class", "flag_subscriber",
        "training_features", "align_features", "join_labels_using", "top_tier1_keep_inf", "profile_schema",
        "shadow_feature_selection", "training_report", "score_visitors", "score_to_compare", "stored_training_set", "stored_compare"]


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_registry_complete():
    q, o = load_registry()
    assert set(o) == set(q) and len(q) >= 120
    assert set(q) <= set(se.queries()) and set(o) <= set(se.oracle_sql())


@pytest.mark.parametrize("name", FAST)
def test_oracle(spark, con, name):
    problems, _, _ = compare(se.queries()[name](spark, SF01), con, se.oracle_sql()[name])
    assert problems == []


def test_entry(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns[0] == "visitor_id"
