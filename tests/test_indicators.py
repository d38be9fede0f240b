import math

import pytest
from pyspark.sql import functions as F

from tickloom.operators import indicators as ind
from tickloom.operators.features import drop_null_features, feature_table


def series(spark, values, symbol="A"):
    rows = [(symbol, i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, openTime long, close double")


def column(df, name):
    return [r[0] for r in df.orderBy("openTime").select(name).collect()]


def test_sma_partial_and_full(spark):
    df = series(spark, [1, 2, 3, 4])
    assert column(ind.sma(df, "close", {"m": 3}), "m") == [1, 1.5, 2, 3]
    assert column(ind.sma(df, "close", {"m": 3}, partial=False), "m") == [None, None, 2, 3]


def test_rsi_price(spark):
    up = column(ind.rsi_price(series(spark, range(1, 17)), "close"), "rsi_14")
    assert up[:13] == [None] * 13 and up[13:] == [100.0] * 3
    assert column(ind.rsi_price(series(spark, [5] * 16), "close"), "rsi_14") == [None] * 16
    mixed = column(ind.rsi_price(series(spark, [1, 3, 2, 4]), "close", 3), "rsi_3")
    # Rows 1..3: gains 2, losses 1; rows 2..4: gains 4, losses 1.
    assert mixed[2] == pytest.approx(100 - 100 / 3) and mixed[3] == pytest.approx(80)


def test_bollinger(spark):
    df = series(spark, [1, 2, 3])
    sample = ind.bollinger(df, "close", 3, 2).orderBy("openTime").collect()[-1]
    assert sample.bollinger_upper_3 == pytest.approx(4) and sample.bollinger_lower_3 == pytest.approx(0)
    pop = ind.bollinger(df, "close", 3, 2, ddof=0, middle=True).orderBy("openTime").collect()
    assert pop[-1].bollinger_upper_3 == pytest.approx(2 + 2 * math.sqrt(2 / 3))
    assert pop[-1].bollinger_middle_3 == 2 and pop[0].bollinger_upper_3 is None


def test_ema_rejects_unknown_seed(spark):
    with pytest.raises(ValueError):
        ind.ema(series(spark, [1]), "close", {"e": 3}, seed="last")


def candles(spark, closes, volumes):
    df = series(spark, closes).join(
        spark.createDataFrame(list(enumerate(map(float, volumes))), "openTime long, volume double"), "openTime"
    )
    return df.select("*", *[F.col("close").alias(c) for c in ("open", "high", "low")])


def test_feature_edge_rows(spark):
    rows = feature_table(candles(spark, [10, 10, 10], [0, 0, 4])).orderBy("openTime").collect()
    first, second, last = rows
    assert first.volatility_5 is None and first.return_1 == 0.0 and first.rsi == 50.0
    assert first.volume_ratio == 1.0 and second.volume_ratio == 1.0 and last.volume_ratio == 3.0
    assert second.rsi == 50.0 and last.target is None and second.target == 0.0
    rising = feature_table(candles(spark, [1, 2, 3], [1, 1, 1])).orderBy("openTime").collect()
    assert rising[-1].rsi == 100.0 and rising[1].return_1 == 100.0 and rising[0].target == 100.0


def test_zero_price_gives_null_not_an_error(spark):
    rows = feature_table(candles(spark, [0, 5, 6], [1, 1, 1])).orderBy("openTime").collect()
    assert rows[1].return_1 is None and rows[0].target is None and rows[0].price_to_ma5 == 0.0


def test_drop_null_features(spark):
    table = feature_table(candles(spark, [1, 2, 3, 4], [1, 1, 1, 1]))
    assert drop_null_features(table).count() == 3
    assert drop_null_features(table, with_target=True).count() == 2
    assert "target" not in feature_table(candles(spark, [1, 2], [1, 1]), with_target=False).columns
