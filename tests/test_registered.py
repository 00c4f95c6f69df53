"""Registered batch queries against their SQL on the smallest tables."""

import pytest

from catalog.batch import QUERIES as BATCH
from compare import compare, connect, load_entry

SF = "/root/testdata/sf0.001"
ENTRY = load_entry()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# Queries of the corpus operators that SQL cannot express; their own tests hold them against brute force.
CORPUS = {q for q in ENTRY.CORPUS if q not in ENTRY.CORPUS_ORACLES}


def test_every_query_with_a_fixed_answer_has_sql():
    weaker = set(ENTRY.queries()) - set(ENTRY.oracle_sql())
    assert weaker == {"sample_fraction", "train_compare", "imbalance_compare", "ablation", "random_search", "importance", "score_batch"} | CORPUS
    assert set(ENTRY.oracle_sql()) <= set(ENTRY.queries())


# Those whose operators have no closer test elsewhere; all of them are compared by tests/compare.py.
CHOSEN = [
    "card_history_custom_windows", "order_velocity", "time_split_summary", "card_fraud_profile", "fraud_span_spread",
    "describe_by_label", "log_histogram", "dq_profile", "feed_checks", "violation_counts", "mask_alerts",
    "evaluate_by_category", "split_metrics", "final_summary", "cost_optimal_by_split", "latency_summary", "busiest_card",
    "rate_by_category", "rate_by_hour", "distinct_cards", "state_recent", "drift_categorical",
]


@pytest.mark.parametrize("name", CHOSEN)
def test_batch_query(spark, con, name):
    _, _, problems = compare(spark, con, BATCH[name], ENTRY.oracle_sql()[name], SF)
    assert not problems, problems[:3]


def test_entry(spark):
    assert ENTRY.entry(spark).count() > 0
