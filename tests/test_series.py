"""Cut series must equal whole series, whatever the cut, the partitioning and the row order."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import tickloom.operators.recurrence as rec
from tickloom.operators.features import feature_table
from tickloom.operators.series import MAX_PARTS, cut_table, map_series, with_slices
from tickloom.schemas import DAY_MS, FEATURES, HOUR_MS, MINUTE_MS

ORDER = ["openTime", "seq"]


def skewed(seed=7, n=1500):
    """One symbol holds most rows, with bursts, long gaps and equal times; others are tiny."""
    rng = random.Random(seed)
    rows, t = [], 1_700_000_000_000
    for i in range(n):
        symbol = rng.choices(["HOT", "MID", "ONE"], [90, 10, 0])[0]
        t += rng.choice([0, 1, 500, MINUTE_MS, HOUR_MS, 3 * DAY_MS if rng.random() < 0.02 else 5])
        rows.append((symbol, t, i, round(rng.uniform(1, 100), 2), float(rng.randint(0, 9))))
    rows.append(("ONE", t, n, 5.0, 1.0))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        skewed(), "symbol string, openTime long, seq long, close double, volume double"
    ).cache()


def bounded(rows, w):
    return rows.withColumns(
        {
            "back3": F.lag("close", 3).over(w),
            "next": F.lead("close").over(w),
            "mean20": F.round(F.avg("close").over(w.rowsBetween(-19, 0)), 6),
            "held": F.count("close").over(w.rowsBetween(-19, 0)),
        }
    )


@pytest.mark.parametrize("min_rows", [1, 3, 40, 300])
@pytest.mark.parametrize("width", [HOUR_MS, DAY_MS])
def test_cut_windows_equal_whole_windows(frame, min_rows, width):
    whole = bounded(frame, Window.partitionBy("symbol").orderBy(*ORDER))
    cut = map_series(frame, bounded, before=19, after=1, order=ORDER, width=width, min_rows=min_rows)
    assert cut.columns == whole.columns
    assert sorted(cut.collect()) == sorted(whole.collect())


def test_without_cutting(frame):
    whole = map_series(frame, bounded, before=19, after=1, order=ORDER, cut=False)
    cut = map_series(frame, bounded, before=19, after=1, order=ORDER, min_rows=50)
    assert sorted(cut.collect()) == sorted(whole.collect())
    a = rec.macd(frame, "close", order=ORDER, cut=False).toPandas().sort_values("seq")
    b = rec.macd(frame, "close", order=ORDER, min_rows=50).toPandas().sort_values("seq")
    assert np.allclose(a.macd_signal, b.macd_signal, atol=1e-9)


def test_partitioning_does_not_change_results(frame):
    one = map_series(frame.coalesce(1), bounded, before=19, after=1, order=ORDER, min_rows=10)
    many = map_series(frame.repartition(13), bounded, before=19, after=1, order=ORDER, min_rows=10)
    assert sorted(one.collect()) == sorted(many.collect())


def test_only_heavy_symbols_are_cut(frame):
    cuts = {r.symbol: r["_parts"] for r in cut_table(frame, ["symbol"], "openTime", DAY_MS, 300).collect()}
    assert set(cuts) == {"HOT"}
    assert cut_table(frame, ["symbol"], "openTime", DAY_MS).count() == 0
    assert len(cuts) <= MAX_PARTS


def test_slices_are_bounded_and_ordered(frame):
    sliced = with_slices(frame, ["symbol"], "openTime", DAY_MS, 50)
    sizes = sliced.filter("symbol = 'HOT'").groupBy("_slice").count()
    assert sizes.count() > 5
    spans = (
        sliced.groupBy("symbol", "_slice").agg(F.min("openTime").alias("lo"), F.max("openTime").alias("hi"))
        .orderBy("symbol", "_slice").collect()
    )
    for a, b in zip(spans, spans[1:]):
        assert a.symbol != b.symbol or a.hi < b.lo


def test_features_equal_on_cut_series(frame):
    candles = frame.select("*", *[F.col("close").alias(c) for c in ("open", "high", "low")])
    shown = ["symbol", "seq", "target", *FEATURES]

    def rounded(df):
        cols = [F.round(c, 6).alias(c) if c not in ("symbol", "seq") else F.col(c) for c in shown]
        return sorted(map(str, df.select(*cols).collect()))

    whole = rounded(feature_table(candles, order=ORDER))
    assert rounded(feature_table(candles, order=ORDER, min_rows=5, width=HOUR_MS)) == whole


def by_symbol(frame, fn):
    pdf = frame.toPandas().sort_values(["symbol", *ORDER]).reset_index(drop=True)
    pdf["want"] = pdf.groupby("symbol")["close"].transform(fn)
    return pdf[["seq", "want"]]


def mean_seeded(n):
    def fn(s):
        v = s.to_numpy()
        out = np.full(len(v), np.nan)
        if len(v) >= n:
            e = out[n - 1] = v[:n].mean()
            for i in range(n, len(v)):
                e = out[i] = (v[i] - e) * 2 / (n + 1) + e
        return pd.Series(out, s.index)

    return fn


@pytest.mark.parametrize("min_rows,block", [(1_000_000, 512), (25, 512), (25, 7), (1, 3)])
def test_ema_equals_sequential(frame, min_rows, block, monkeypatch):
    monkeypatch.setattr(rec, "BLOCK", block)
    first = rec.ema(frame, "close", {"e": 12, "one": 1}, order=ORDER, min_rows=min_rows).toPandas()
    got = first.merge(by_symbol(frame, lambda s: s.ewm(span=12, adjust=False).mean()), on="seq")
    assert np.allclose(got.e, got.want, atol=1e-9)
    assert np.allclose(got.one, got.close)
    seeded = rec.ema(frame, "close", {"e": 50}, seed="sma", order=ORDER, min_rows=min_rows).toPandas()
    got = seeded.merge(by_symbol(frame, mean_seeded(50)), on="seq")
    assert np.allclose(got.e, got.want, atol=1e-9, equal_nan=True)
    assert seeded[seeded.symbol == "ONE"].e.isna().all()


@pytest.mark.parametrize("min_rows,block", [(1_000_000, 512), (20, 5)])
def test_macd_equals_sequential(frame, min_rows, block, monkeypatch):
    monkeypatch.setattr(rec, "BLOCK", block)
    got = rec.macd(frame, "close", order=ORDER, min_rows=min_rows).toPandas()

    def signal(s):
        line = s.ewm(span=12, adjust=False).mean() - s.ewm(span=26, adjust=False).mean()
        return line.ewm(span=9, adjust=False).mean()

    got = got.merge(by_symbol(frame, signal), on="seq")
    assert np.allclose(got.macd_signal, got.want, atol=1e-9)
    assert np.allclose(got.macd, got.ema_12 - got.ema_26, atol=1e-9)


def test_macd_with_equal_spans(frame):
    got = rec.macd(frame, "close", 9, 9, 9, order=ORDER, min_rows=20).toPandas()
    assert np.allclose(got.macd, 0) and np.allclose(got.macd_signal, 0)


@pytest.mark.parametrize("min_rows,cut", [(1_000_000, True), (10, True), (10, False)])
def test_running_max_sees_earlier_orders_only(frame, min_rows, cut):
    got = rec.running_max_before(
        frame, "close", "top", keys=["symbol"], order="openTime", width=HOUR_MS, min_rows=min_rows, cut=cut
    ).toPandas()
    for _, group in got.groupby("symbol"):
        for row in group.itertuples():
            earlier = group[group.openTime < row.openTime].close
            assert (np.isnan(row.top) and earlier.empty) or row.top == earlier.max()


def test_a_burst_is_cut_too(spark):
    """Nine tenths of a symbol's rows lie in one second."""
    rng = random.Random(3)
    t0 = 1_700_000_000_000
    times = [t0 + rng.randrange(DAY_MS) for _ in range(4000)] + [t0 + 5 * HOUR_MS + rng.randrange(1000) for _ in range(36_000)]
    df = spark.createDataFrame([("A", t, i) for i, t in enumerate(times)], "symbol string, openTime long, seq long")
    limit = 700
    slices = with_slices(df, ["symbol"], "openTime", min_rows=limit).groupBy("_slice").agg(
        F.count("*").alias("n"), F.min("openTime").alias("a"), F.max("openTime").alias("b")
    ).orderBy("a").collect()
    assert max(r.n for r in slices) <= 2 * limit and sum(r.n for r in slices) == 40_000
    assert all(x.b < y.a and x["_slice"] < y["_slice"] for x, y in zip(slices, slices[1:]))
    add = lambda f, w: f.withColumn("back", F.lag("seq", 7).over(w)).withColumn("n", F.count("seq").over(w.rowsBetween(-30, 0)))
    whole = map_series(df, add, before=30, order=ORDER, cut=False)
    cut = map_series(df, add, before=30, order=ORDER, min_rows=limit)
    assert sorted(cut.collect()) == sorted(whole.collect())


@pytest.mark.parametrize("span,ties", [(20_000, 0), (3, 0), (400, 9000)])
def test_bursts_of_any_density_are_cut(spark, span, ties):
    """Slices stay near the limit however many rows a few milliseconds hold."""
    limit, t0 = 200, 1_700_000_000_000
    rng = random.Random(span)
    times = [t0 + rng.randrange(DAY_MS) for _ in range(2000)] + [t0 + HOUR_MS + rng.randrange(span) for _ in range(38_000 - ties)]
    times += [t0 + HOUR_MS + 17] * ties
    df = spark.createDataFrame([("A", t, i) for i, t in enumerate(times)] + [("B", t0, 1)], "symbol string, openTime long, seq long")
    cut = with_slices(df, ["symbol"], "openTime", min_rows=limit, sub="seq")
    first, last = F.min(F.struct("openTime", "seq")).alias("a"), F.max(F.struct("openTime", "seq")).alias("b")
    slices = cut.where("symbol = 'A'").groupBy("_slice").agg(F.count("*").alias("n"), first, last).orderBy("a").collect()
    assert max(r.n for r in slices) <= 2 * limit and sum(r.n for r in slices) == 40_000
    assert all(tuple(x.b) < tuple(y.a) and x["_slice"] < y["_slice"] for x, y in zip(slices, slices[1:]))
    add = lambda f, w: f.withColumn("back", F.lag("seq", 7).over(w)).withColumn("n", F.sum("seq").over(w.rowsBetween(-30, 0)))
    whole = map_series(df, add, before=30, order=ORDER, cut=False)
    assert sorted(map_series(df, add, before=30, order=ORDER, min_rows=limit).collect()) == sorted(whole.collect())
