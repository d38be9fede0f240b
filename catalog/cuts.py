"""Long-series operators with every symbol cut into slices, beside the SQL of their uncut form.

The given tables have no symbol above the size from which one is cut, so these set a low one.
"""

from catalog.base import SQL, register, rounded
from catalog.indicators import ORDER, SHOWN, _closes
from tickloom.operators import indicators as ind
from tickloom.operators.book import tick_change_pct as tick_change
from tickloom.operators.features import feature_table
from tickloom.sources import testdata as td

MIN_ROWS = 150


@register("ema_first_seed_cut", SQL["ema_first_seed"])
def ema_first_seed_cut(spark, d):
    return rounded(ind.ema(_closes(spark, d), "close", {"ema_12": 12}, order=ORDER, min_rows=MIN_ROWS), "ema_12")


@register("ema_mean_seed_cut", SQL["ema_mean_seed"])
def ema_mean_seed_cut(spark, d):
    # Every user is cut, most of them far shorter than a slice of the other queries.
    spans = {"ema_12": 12, "ema_26": 26, "ema_50": 50}
    out = ind.ema(_closes(spark, d, "user_id"), "close", spans, seed="sma", order=ORDER, min_rows=3)
    return rounded(out, *spans)


@register("macd_cut", SQL["macd"])
def macd_cut(spark, d):
    out = ind.macd(_closes(spark, d), "close", order=ORDER, min_rows=MIN_ROWS)
    return rounded(out, "ema_12", "ema_26", "macd", "macd_signal")


@register("feature_table_cut", SQL["feature_table"])
def feature_table_cut(spark, d):
    out = feature_table(td.tick_candles(td.ticks(spark, d)), order=ORDER, min_rows=MIN_ROWS)
    return rounded(out.select("symbol", "openTime", "seq", "close", *SHOWN), *SHOWN)


@register("tick_change_pct_cut", SQL["tick_change_pct"])
def tick_change_pct_cut(spark, d):
    t = td.ticks(spark, d).select("symbol", "time", "tradeId", "price")
    return rounded(tick_change(t, min_rows=MIN_ROWS), "change_pct")
