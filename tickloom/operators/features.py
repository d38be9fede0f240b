"""Model features. One window specification, hence one shuffle and one sort for all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import change_pct, geometry
from tickloom.operators.series import map_series
from tickloom.schemas import FEATURES


def feature_table(df: DataFrame, with_target: bool = True, **series) -> DataFrame:
    """Add candle geometry, lags, returns, means, volatility, volume ratio, RSI and the target.

    Returns are 0 where there is no earlier candle; windows may be partial; volatility is null on
    a symbol's first row and the target (change to the next close, %) on its last.
    """
    def add(rows, w):
        close = F.col("close")
        m5, m10, m14, m20 = (w.rowsBetween(1 - n, 0) for n in (5, 10, 14, 20))
        rows = rows.withColumns(
            {
                **geometry(),
                **{f"close_lag{k}": F.lag("close", k).over(w) for k in (1, 2, 3)},
                "ma5": F.avg("close").over(m5),
                "ma10": F.avg("close").over(m10),
                "ma20": F.avg("close").over(m20),
                "volatility_5": F.stddev_samp("close").over(m5),
                "volatility_10": F.stddev_samp("close").over(m10),
                "volume_ma5": F.avg("volume").over(m5),
            }
        )
        if with_target:
            rows = rows.withColumn("next_close", F.lead("close").over(w))
            rows = rows.withColumn("target", change_pct("next_close", close))

        def ret(k):
            lag = F.col(f"close_lag{k}")
            return F.when(lag.isNotNull(), change_pct(close, lag)).otherwise(0.0)

        def against(mean):
            return F.when(F.col(mean) > 0, change_pct(close, mean)).otherwise(0.0)

        rows = rows.withColumns(
            {
                "return_1": ret(1),
                "return_2": ret(2),
                "volume_ratio": F.when(
                    F.col("volume_ma5") > 0, F.try_divide("volume", "volume_ma5")
                ).otherwise(1.0),
                "price_to_ma5": against("ma5"),
                "price_to_ma20": against("ma20"),
            }
        )
        r = F.col("return_1")
        rows = rows.withColumns(
            {
                "_up": F.when(r > 0, r).otherwise(0.0),
                "_down": F.when(r < 0, -r).otherwise(0.0),
            }
        )
        rows = rows.withColumns(
            {"avg_gain": F.avg("_up").over(m14), "avg_loss": F.avg("_down").over(m14)}
        )
        gain, loss = F.col("avg_gain"), F.col("avg_loss")
        rsi = F.when(loss > 0, 100 - 100 / (1 + F.try_divide(gain, loss)))
        return rows.withColumn("rsi", rsi.when(gain > 0, 100.0).otherwise(50.0)).drop("_up", "_down")

    # The deepest look-back is ma20 (19 rows); RSI needs 13 rows of one-row returns.
    return map_series(df, add, before=19, after=1 if with_target else 0, **series)


def drop_null_features(df: DataFrame, with_target: bool = False) -> DataFrame:
    return df.dropna(subset=FEATURES + (["target"] if with_target else []))
