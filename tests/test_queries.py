"""Every registered query against its oracle, at the smallest scale."""

import pytest

import __spark_entry__ as contract
from beaconry.queries.registry import ORACLES, QUERIES
from tests.oracle import DATA, differences, oracle, shifted_copy, skewed_copy

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["app_dwid", "server_dwid", "metric_index_dwid", "metric_threshold_dwid", "hour_dwid",
                          "avg_value", "rag", "creation_date"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    assert differences(spark, con, name, FOLDER) == []


# one of each kind of operator: scans, merges, versions, joins, windows, states, streams
ON_SKEWED_FOLDERS = """
    waves_dedup merge_latest_server merge_latest_narrow scd2_from_history scd2_apply scd2_match_changes
    join_server_shuffled fact_metric_shuffled sum_metric_avg sliding_states alert_state lookup_by_id
    agg_nest_thresholds stream_dedup stream_metric_states stream_alert_states
""".split()


# events 40 days later and orders after 2002: nothing may hang on the days of the given tables
SHIFTED = """
    fact_metric fact_metric_shuffled sum_metric_avg join_star join_threshold join_server_at_day_start wide_metric_avg
    wide_metric_avg_compat build_day scd2_apply scd2_apply_rerun scd2_apply_composite compact_partitions
""".split()


@pytest.fixture(scope="module")
def shifted(tmp_path_factory):
    folder = shifted_copy(FOLDER, str(tmp_path_factory.mktemp("shifted")))
    return folder, oracle(folder)


@pytest.mark.parametrize("name", SHIFTED)
def test_matches_oracle_on_other_days(spark, shifted, name):
    folder, con = shifted
    assert differences(spark, con, name, folder) == []


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = skewed_copy(FOLDER, str(tmp_path_factory.mktemp("skewed")))
    return folder, oracle(folder)


@pytest.mark.parametrize("name", ON_SKEWED_FOLDERS)
def test_matches_oracle_on_skewed_folders(shuffled, skewed, name):
    folder, con = skewed
    assert differences(shuffled, con, name, folder) == []
