"""Column expressions shared by the operators. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schemas import INTERVAL_MS


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def bucket_start(time_ms: Column | str, width_ms: int | Column) -> Column:
    """Start of the epoch-aligned bucket; integer arithmetic, correct for negative times too."""
    t = _c(time_ms)
    return t - F.pmod(t, F.lit(width_ms).cast("long"))


def ms_to_ts(time_ms: Column | str) -> Column:
    return F.timestamp_millis(_c(time_ms))


def utc_millis(wall_clock: Column | str) -> Column:
    """Epoch milliseconds of a zone-less timestamp in UTC, whatever the session time zone."""
    t = _c(wall_clock)
    minutes = (F.unix_date(t.cast("date")).cast("long") * 24 + F.hour(t)) * 60 + F.minute(t)
    return minutes * 60_000 + F.floor(F.extract(F.lit("SECOND"), t) * 1000).cast("long")


def _utc_wall_clock(time_ms: Column | str) -> Column:
    seconds = (_c(time_ms) / F.lit(1000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def utc_text(time_ms: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC whatever the session time zone."""
    return F.date_format(_utc_wall_clock(time_ms), "yyyy-MM-dd HH:mm:ss")


def utc_iso(time_ms: Column | str) -> Column:
    """ISO-8601 with offset; the six-digit fraction appears only when it is not zero."""
    fraction = F.pmod(_c(time_ms), F.lit(1000))
    return F.concat(
        F.date_format(_utc_wall_clock(time_ms), "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == 0, F.lit("")).otherwise(
            F.concat(F.lit("."), F.lpad(fraction.cast("string"), 3, "0"), F.lit("000"))
        ),
        F.lit("+00:00"),
    )


def total_order(x: Column | str) -> Column:
    """A long that orders doubles exactly: the IEEE bits of the magnitude, with the sign.

    Negative and positive zero are equal, NaN comes last, null stays null. The exponent is estimated by
    a logarithm and corrected by one; scaling by powers of two is exact, for subnormal numbers too.
    """
    v = _c(x).cast("double")
    size = F.abs(v)
    guess = F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023))
    scaled = size / F.pow(F.lit(2.0), guess)
    up, down = scaled >= 2, (scaled < 1) & (guess > -1022)
    exponent = guess + F.when(up, 1).when(down, -1).otherwise(0)
    fraction = F.when(up, scaled / 2).when(down, scaled * 2).otherwise(scaled)
    bits = (exponent + 1022) * (1 << 52) + (fraction * float(1 << 52)).cast("long")
    infinite = 2047 << 52
    magnitude = F.when(F.isnan(v), F.lit(infinite + 1)).when(size == float("inf"), F.lit(infinite)).when(size == 0, F.lit(0)).otherwise(bits)
    return F.when(v < 0, -magnitude).when(v.isNotNull(), magnitude).cast("long")


def turn(position: Column | str, x: Column | str) -> Column:
    """One number that orders rows by ``position`` and, at one position, by the double ``x``.

    Aggregates ordered by a decimal are hash aggregates, which combine rows before the shuffle; a struct
    makes them sort every row. 38 digits hold any double beside any position below 2**62, which in
    milliseconds is more than a timestamp can reach. Null where ``x`` is null.
    """
    place = _c(position).cast("decimal(19,0)") * F.lit(Decimal(2**64))
    return place.cast("decimal(38,0)") + total_order(x).cast("decimal(19,0)")


def change_pct(now: Column | str, before: Column | str) -> Column:
    """Percentage change; null where the earlier value is null or zero."""
    b = _c(before)
    return F.try_divide(_c(now) - b, b) * 100


def trade_side(is_buyer_maker: Column | str = "isBuyerMaker") -> Column:
    return F.when(_c(is_buyer_maker), "SELL").otherwise("BUY")


def candle_change_pct(open_: Column | str = "open", close: Column | str = "close") -> Column:
    o = _c(open_)
    return F.when(o > 0, change_pct(close, o)).otherwise(0.0)


def candle_up(open_: Column | str = "open", close: Column | str = "close") -> Column:
    return _c(close) >= _c(open_)


def event_type(closed: Column | str = "x") -> Column:
    """'realtime' once the candle is closed, 'update' while it forms."""
    return F.when(F.coalesce(_c(closed), F.lit(False)), "realtime").otherwise("update")


def geometry() -> dict[str, Column]:
    """Range, body and shadows of a candle."""
    o, h, l, c = (F.col(n) for n in ("open", "high", "low", "close"))
    return {
        "price_range": h - l,
        "body_size": c - o,
        "upper_shadow": h - F.greatest(o, c),
        "lower_shadow": F.least(o, c) - l,
    }


def base_asset(symbol: Column | str = "symbol") -> Column:
    return F.regexp_replace(_c(symbol), "USDT$", "")


def pair_label(symbol: Column | str = "symbol") -> Column:
    return F.regexp_replace(_c(symbol), "USDT$", "/USDT")


def _lookup(key: Column, table: dict, default=None) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out.otherwise(F.lit(default))


# Chart range to candle interval.
RANGE_INTERVAL = {
    "realtime": "1m",
    "7day": "5m",
    "30day": "1h",
    "6month": "4h",
    "1year": "1d",
}

# Table name to candle interval.
COLLECTION_INTERVAL = {
    "5m_kline": "5m",
    "1h_kline": "1h",
    "4h_kline": "4h",
    "1d_kline": "1d",
}


def range_to_interval(mode: Column | str) -> Column:
    return _lookup(_c(mode), RANGE_INTERVAL)


def collection_to_interval(name: Column | str) -> Column:
    return _lookup(_c(name), COLLECTION_INTERVAL, "5m")


def interval_ms(interval: Column | str) -> Column:
    return _lookup(_c(interval), INTERVAL_MS)
