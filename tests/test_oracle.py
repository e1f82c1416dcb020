"""Every registered query against DuckDB, and the plans of what the loads write."""

from importlib import import_module

import pytest

import __spark_entry__ as driver
from histkit.sources import tables
from tests.oracle import difference, duck
from tests.test_plans import assert_no_slow_path, plan
from workloads import ALL

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

#: Queries whose rows depend on what happens to arrive late, so that they need more keys.
INCREMENTAL = ("cdc_history", "json_history", "load_consistent", "load_incremental", "load_workday_companies", "history_hot")


@pytest.fixture(scope="module")
def con():
    return {sf: duck(sf) for sf in (SMALL, LARGER)}


@pytest.fixture
def staged(monkeypatch):
    """Plans of everything that is staged while a query runs."""
    texts, stage = [], tables.stage

    def recorded(df):
        texts.append(plan(df))
        return stage(df)

    for name in ("sources.tables", "operators.skew", "plans.cdc", "plans.snapshots", "plans.attributes", "plans.load"):
        monkeypatch.setattr(import_module(f"histkit.{name}"), "stage", recorded)
    return texts


def test_every_query_has_sql():
    assert set(ALL) <= set(driver.queries())
    assert set(ALL) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, con, name, staged):
    assert difference(driver.queries()[name](spark, SMALL), con[SMALL], driver.oracle_sql()[name]) is None
    if name.startswith("load_"):
        assert staged
        for text in staged:
            assert_no_slow_path(text)


@pytest.mark.parametrize("name", sorted(n for n in ALL if n.startswith(INCREMENTAL)))
def test_query_on_more_keys(spark, con, name):
    assert difference(driver.queries()[name](spark, LARGER), con[LARGER], driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
