"""Registered queries beside their SQL twins.  A spread over all families by default, everything with SIFTLINE_ALL=1."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
SOME = ["funnel_routes_by_source", "txt4_namespaced_keys", "txt18_page_excerpt", "txt30_delivered_keys", "flt12_row_reasons", "rul3_signals_with_bio", "rul17_decision", "jn2_admission_verdicts",
        "jn14_coverage", "jn20_contact_roles", "h1_greedy_claims", "h2_final_claims", "h3_bounded_sample", "agg10_receipts", "agg18_company_records", "win3_global_positions", "win9_consecutive_switch",
        "src9_envelope_items", "snk5_backup_manifest", "ml2_stratified_split", "str1_incremental_admission", "str6_cached_results"]
NAMES = list(entry.queries()) if os.environ.get("SIFTLINE_ALL") else SOME


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    rows, problem = compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert not problem


def test_every_sql_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["source", "route", "records", "score_total", "rank_milli_total"]


def test_model_queries_train_with_the_package_size(monkeypatch):
    from siftline.catalog import storage

    class Rows:
        filter = drop = lambda self, *a: self

    seen = {}
    monkeypatch.setattr(storage, "_labelled", lambda t: Rows())
    monkeypatch.setattr(storage, "durable", lambda df, name: df)
    monkeypatch.setattr(storage.training, "split", lambda rows: rows)
    monkeypatch.setattr(storage.training, "train", lambda rows, size=storage.training.FEATURES: seen.update(size=size))
    storage._trained(None)
    assert seen == {"size": 30_000}
