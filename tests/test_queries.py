"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tvtrail.operators import hotkeys
from workbench import catalog, compare, registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_contract(spark):
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con: duckdb.DuckDBPyConnection, name):
    ok, note = compare.compare(spark, con, SF, name)
    assert ok, note


USES_HOT_KEYS = (
    "session_pairing", "session_inferred_end", "session_day_clamp", "live_neighbours", "live_facts",
    "timeshift_facts", "lookback_facts", "vod_facts", "pageview_facts", "topic_visits", "error_facts",
    "order_facts", "favourite_facts", "path_trigrams", "path_counts", "path_in_out", "order_last_page",
    "flow_in_out",
)


@pytest.mark.parametrize("name", USES_HOT_KEYS)
def test_query_with_hot_users(spark, con, name, monkeypatch):
    """The same SQL results when ordinary users are treated as hot ones."""
    seen = []

    def forced(df, key, ts):
        seen.append(hotkeys.find_hot_keys(df, key, ts, slice_rows=3))
        return seen[-1]

    monkeypatch.setattr(registry, "find_hot_keys", forced)
    ok, note = compare.compare(spark, con, SF, name)
    assert ok, note
    assert seen and all(hot and not hot.slices.where("size(_starts) > 1").isEmpty() for hot in seen)
