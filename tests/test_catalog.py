"""Every registered query against its SQL twin on the smallest given tables."""

import inspect

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_module
from catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


# At this size these have no rows to show: every hour is incomplete or every key is stored.
MAY_BE_EMPTY = {"insert_if_absent", "candle_gaps", "latest_view"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    if name not in SQL:
        assert df.count() > 0
        return
    problems = compare(df, duck, SQL[name])
    if name in MAY_BE_EMPTY:
        problems = [p for p in problems if p != "empty on both sides"]
    assert problems == []


def test_entry_is_lazy_and_stable(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["symbol", "price", "percent_change", "volume", "market_cap", "timestamp"]
    assert df.count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_queries_take_session_and_folder():
    for fn in QUERIES.values():
        assert len(inspect.signature(fn).parameters) == 2
