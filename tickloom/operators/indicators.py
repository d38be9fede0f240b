"""Technical indicators over ordered series; each adds columns and keeps every row.

Extra keyword arguments (keys, order, width, min_rows) go to ``series.map_series``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.recurrence import ema, macd
from tickloom.operators.series import map_series


def _full(w, n: int, value: Column, counted: str) -> Column:
    """``value`` once the frame holds n rows, null before."""
    return F.when(F.count(counted).over(w) == n, value)


def sma(df: DataFrame, value: str, periods: dict[str, int], partial: bool = True, **series) -> DataFrame:
    """Rolling means (column name -> rows). With ``partial=False`` null until the window is full."""
    def add(rows, w):
        out = {}
        for name, n in periods.items():
            frame = w.rowsBetween(-(n - 1), 0)
            mean = F.avg(value).over(frame)
            out[name] = mean if partial else _full(frame, n, mean, value)
        return rows.withColumns(out)

    return map_series(df, add, before=max(periods.values()) - 1, **series)


def bollinger(
    df: DataFrame, value: str, n: int = 20, k: float = 2.0, ddof: int = 1, middle: bool = False, **series
) -> DataFrame:
    """Rolling mean plus and minus k deviations: sample (ddof=1) or population (ddof=0)."""
    deviation = F.stddev_samp if ddof == 1 else F.stddev_pop

    def add(rows, w):
        frame = w.rowsBetween(-(n - 1), 0)
        mean, spread = F.avg(value).over(frame), deviation(value).over(frame) * k
        out = {
            f"bollinger_upper_{n}": _full(frame, n, mean + spread, value),
            f"bollinger_lower_{n}": _full(frame, n, mean - spread, value),
        }
        if middle:
            out[f"bollinger_middle_{n}"] = _full(frame, n, mean, value)
        return rows.withColumns(out)

    return map_series(df, add, before=n - 1, **series)


def rsi_price(df: DataFrame, value: str, n: int = 14, **series) -> DataFrame:
    """RSI over price differences with plain rolling means.

    The first difference counts as zero, so values begin at row n. No losses gives 100; a window
    without any movement has no defined value and is null.
    """
    def add(rows, w):
        frame = w.rowsBetween(-(n - 1), 0)
        step = F.col(value) - F.lag(value).over(w)
        rows = rows.withColumns(
            {
                "_gain": F.when(step > 0, step).otherwise(0.0),
                "_loss": F.when(step < 0, -step).otherwise(0.0),
            }
        )
        gain, loss = F.avg("_gain").over(frame), F.avg("_loss").over(frame)
        rsi = F.when(loss > 0, 100 - 100 / (1 + F.try_divide(gain, loss))).when(gain > 0, 100.0)
        return rows.withColumn(f"rsi_{n}", _full(frame, n, rsi, value)).drop("_gain", "_loss")

    return map_series(df, add, before=n, **series)


def lags(df: DataFrame, value: str = "close", depth: int = 3, **series) -> DataFrame:
    def add(rows, w):
        return rows.withColumns({f"{value}_lag{k}": F.lag(value, k).over(w) for k in range(1, depth + 1)})

    return map_series(df, add, before=depth, **series)


def indicator_table(df: DataFrame, value: str = "close", **series) -> DataFrame:
    """The indicator set of the history job: SMA 14, EMA 12, RSI 14, Bollinger 20/2, MACD 12/26/9.

    The bounded-frame indicators share one shuffle; the averages share one chain.
    """
    def add(rows, w):
        sma14, bb = w.rowsBetween(-13, 0), w.rowsBetween(-19, 0)
        step = F.col(value) - F.lag(value).over(w)
        mean, spread = F.avg(value).over(bb), F.stddev_samp(value).over(bb) * 2
        rows = rows.withColumns(
            {
                "sma_14": F.avg(value).over(sma14),
                "bollinger_upper_20": _full(bb, 20, mean + spread, value),
                "bollinger_lower_20": _full(bb, 20, mean - spread, value),
                "_gain": F.when(step > 0, step).otherwise(0.0),
                "_loss": F.when(step < 0, -step).otherwise(0.0),
            }
        )
        gain, loss = F.avg("_gain").over(sma14), F.avg("_loss").over(sma14)
        rsi = F.when(loss > 0, 100 - 100 / (1 + F.try_divide(gain, loss))).when(gain > 0, 100.0)
        return rows.withColumn("rsi_14", _full(sma14, 14, rsi, value)).drop("_gain", "_loss")

    bounded = map_series(df, add, before=19, **series)
    return macd(bounded, value, 12, 26, 9, like=df, **series)


__all__ = ["bollinger", "ema", "indicator_table", "lags", "macd", "rsi_price", "sma"]
