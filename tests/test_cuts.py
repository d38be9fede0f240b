"""Cuts of many slices: a row looks at its own slice's entries only, and long chains are walked in chunks."""

import pytest
from pyspark.sql import functions as F

from tickloom.operators import stepwise as sw
from tickloom.operators.book import limit_rate
from tickloom.operators.series import QUANTILES, decided, sliced

T0 = 1_700_006_400_000


def rows(spark, times):
    return spark.createDataFrame([("A", t, i) for i, t in enumerate(times)] + [("B", T0, 0)], "symbol string, openTime long, seq long")


def test_even_rows_need_no_table_of_slices(spark):
    df = rows(spark, [T0 + 1000 * i for i in range(6000)])
    cuts = decided(df, ["symbol"], "openTime", 86_400_000, 10, "seq")
    assert cuts.levels == [] and cuts.ties is None and cuts.even.count() == 1
    sizes = sliced(df, cuts, ["symbol"], "openTime", 86_400_000).where("symbol = 'A'").groupBy("_slice").count()
    assert sizes.count() >= 600 and sizes.agg(F.max("count")).first()[0] <= 10


@pytest.mark.parametrize("span", [1, 40_000])
def test_a_slice_has_a_bounded_number_of_entries(spark, span):
    """However many slices a burst makes, none is looked up among more than a few hundred."""
    df = rows(spark, [T0 + 80_000_000] + [T0 + i * span // 4000 for i in range(4000)])
    cuts = decided(df, ["symbol"], "openTime", 86_400_000, 2, "seq")
    tables = [t for t in [*cuts.levels, cuts.ties] if t is not None]
    assert tables and all(t.agg(F.max(F.size("_at"))).first()[0] <= 2 * QUANTILES for t in tables)


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1500])
def test_chains_longer_than_a_chunk(spark, n):
    """Each item adds its number; every entry has the sum before it."""
    items = F.transform(F.sequence(F.lit(1), F.lit(max(n, 1))), lambda i: i.cast("bigint"))
    entry = lambda i, x: F.struct(i.alias("i"), x.alias("x"))
    told = sw.followed(F.slice(items, 1, n), F.lit(7).cast("bigint"), entry, lambda i: sw.pieces(sw.piece(sw.TOP, True, i)))
    got = spark.range(1).select(told.alias("e")).first().e
    assert [(r.i, r.x) for r in got] == [(i, 7 + i * (i - 1) // 2) for i in range(1, n + 1)]
    assert spark.range(1).select(F.size(sw.chunks(F.slice(items, 1, n)))).first()[0] == max(1, -(-n // sw.CHUNK))


def test_rate_limit_decides_its_cut_once(spark):
    """Two functions a slice and one walk; the second clock does not run the first one again for its own cut."""
    df = spark.createDataFrame([("A", t * 7, t) for t in range(300)], "symbol string, time long, seq long")
    plan = limit_rate(df, 10, 30, min_rows=50, width=500)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") <= 4
