"""What the optimizer must make of the operators at scale."""

import pytest

from catalog import QUERIES
from tickloom.operators.book import replay_book, top_levels
from tickloom.operators.features import feature_table
from tickloom.operators.rollup import rollup_ohlc
from tickloom.session import shared_dir
from tickloom.sources import tables as tb
from tickloom.sources import testdata as td


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def candles(spark, sf_dir):
    return td.tick_candles(td.ticks(spark, sf_dir))


def test_scans_push_filters_and_prune(spark, tmp_path, candles):
    path = str(tmp_path / "c")
    tb.write_candles(rollup_ohlc(candles, "1h", "seq"), path)
    scan = tb.scan_candles(tb.read_candles(spark, path), ["click", "view"], "1h", 5, 9).select("close")
    text = plan(scan)
    assert "PartitionFilters: [isnotnull(interval" in text
    assert "GreaterThanOrEqual(openTime,5)" in text and "LessThan(openTime" in text
    assert "ReadSchema: struct<symbol:string,openTime:bigint,close:double>" in text


def test_rollups_are_hash_aggregates_with_partials(candles):
    text = plan(rollup_ohlc(candles, "1h", "seq"))
    assert "partial_min_by" in text and "SortAggregate" not in text and text.count("Exchange hashpartitioning") == 1


def test_latest_k_is_cut_before_the_shuffle(candles):
    text = plan(tb.latest_k_per_symbol(candles, 40, order=["openTime", "seq"]))
    assert text.count("WindowGroupLimit") == 2 and ", Partial" in text


def test_top_n_needs_no_global_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_gainers"](spark, sf_dir))


def test_book_aggregates_before_the_shuffle(spark, sf_dir):
    from catalog.books import shifted_updates

    book = replay_book(shifted_updates(spark, sf_dir))
    assert "partial_max_by" in plan(book) and "SortAggregate" not in plan(book)
    assert "WindowGroupLimit" in plan(top_levels(book, 100))


def test_features_of_uncut_series_sort_once(candles):
    df = feature_table(candles, order=["openTime", "seq"])
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    # The halo branches are empty at run time; what is left is one sorted series.
    assert final.count("Sort [symbol") == 1


def test_no_python_in_the_batch_operators(spark, sf_dir):
    for name in ("macd", "feature_table", "replay_book", "top_gainers", "forecast_all_ticks", "counter_rate"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text, name


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("name", ["window_close", "window_gain", "top_gainers", "rollup_1d_by_supplier", "replay_mixed_book"])
def test_hash_aggregates_only(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "HashAggregate" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["feature_table", "tick_change_pct", "counter_rate"])
def test_series_without_heavy_symbols_are_plain_windows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert text.count("Scan parquet") == 1 and "Join" not in text


def metric(df, name):
    """Sum of a metric over the nodes of an executed plan that have it."""
    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get(name)
        children = node.children()
        return (own.get().value() if own.isDefined() else 0) + sum(walk(children.apply(i)) for i in range(children.size()))

    df._jdf.queryExecution().executedPlan().executeCollect()
    return walk(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("name", ["window_close", "window_gain"])
def test_window_prices_combine_before_the_shuffle(spark, name):
    from pyspark.sql import functions as F

    from tickloom.operators import rollup

    # 40,000 rows of unique times, two symbols, ten windows, four tasks.
    rows = spark.range(0, 40_000, 1, 4).select(
        F.concat(F.lit("S"), F.col("id") % 2).alias("symbol"), (F.col("id") * 15).alias("openTime"), (F.col("id") * 15).alias("time"),
        F.rand(1).alias("close"), F.rand(2).alias("price"), F.rand(3).alias("quoteVolume"),
    )
    df = getattr(rollup, name)(rows)
    text = plan(df)
    assert text.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in text
    assert df.count() == 20
    assert 20 <= metric(df, "shuffleRecordsWritten") <= 4 * 20


@pytest.mark.parametrize("now,rows", [(10**9, 2 * 40), (29_700_000, 2 * 11)])
def test_recent_candles_scan_once(spark, tmp_path, now, rows):
    path = str(tmp_path / "candles")
    spark.range(200).selectExpr("concat('S', id % 2) AS symbol", "id div 2 * 300000 AS openTime", "1.0D AS close").write.parquet(path)
    found = tb.recent_or_latest_k(spark.read.parquet(path), now, 10)
    assert plan(found).split("== Initial Plan ==")[0].count("FileScan") == 1 and found.count() == rows
