"""Registered queries against their SQL on the smallest tables; ALL_QUERIES=1 runs every one."""

import os

import oracle
import pytest

import __spark_entry__ as entry
from oracle import SMALL

HEADLINE = (
    "a6_filtered_scan", "a15_insert_if_absent", "b1_validate", "b14_raw_categories", "c2_latest_interactions", "c5_upsert",
    "d1_item_features", "d2_user_sequences", "e2_point_in_time", "f5_leave_one_out", "f13_fit_vocab", "g4_top_n",
    "h1_catalog_ranks", "h6_popularity_baseline", "h10_champion_ranks", "i2_top_k_similar", "i7_homepage",
    "j2_categorical_drift", "k2_recent_items_stream", "k5_latency_p95",
)
NAMES = sorted(entry.queries()) if os.environ.get("ALL_QUERIES") else HEADLINE


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    fn, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert fn(spark, SMALL).count() > 0
    else:
        assert oracle.compare(spark, oracle.connect(SMALL), fn, sql, SMALL) is None


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
