"""Metric roll-ups over samples (metric, labels map<string,string>, ts in ms, value).

Rates are plain increases per second, without extrapolation to the window's edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import bucket_start
from tickloom.operators.series import map_series
from tickloom.schemas import HOUR_MS, MINUTE_MS


def label(name: str) -> Column:
    """Label value; an absent label equals the empty text."""
    return F.coalesce(F.try_element_at("labels", F.lit(name)), F.lit(""))


def match(
    samples: DataFrame,
    metric: str | None = None,
    equal: dict[str, str] | None = None,
    not_equal: dict[str, str] | None = None,
    regex: dict[str, str] | None = None,
) -> DataFrame:
    """Label matchers; a regular expression must match the whole value."""
    if metric is not None:
        samples = samples.filter(F.col("metric") == metric)
    for k, v in (equal or {}).items():
        samples = samples.filter(label(k) == v)
    for k, v in (not_equal or {}).items():
        samples = samples.filter(label(k) != v)
    for k, v in (regex or {}).items():
        samples = samples.filter(label(k).rlike(f"^(?:{v})$"))
    return samples


def _series_key() -> Column:
    """Text that is equal for equal label sets, so that a map can be a key."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries("labels"))))


def increments(samples: DataFrame, order: Sequence[str] = ("ts",), **series) -> DataFrame:
    """Per sample the increase since the series' previous one; after a reset, the new value."""
    keyed = samples.withColumn("_series", _series_key())

    def add(rows, w):
        prev = F.lag("value").over(w)
        step = F.when(F.col("value") >= prev, F.col("value") - prev).otherwise(F.col("value"))
        return rows.withColumn("increase", F.when(prev.isNotNull(), step))

    return map_series(keyed, add, before=1, keys=["metric", "_series"], order=order, **series).drop("_series")


def _by(labels: Sequence[str]) -> list[Column]:
    return [label(name).alias(name) for name in labels]


def counter_increase(
    samples: DataFrame, window_ms: int = HOUR_MS, by: Sequence[str] = (), order: Sequence[str] = ("ts",), **series
) -> DataFrame:
    """Increase per window and label group."""
    return (
        increments(samples, order, **series)
        .filter(F.col("increase").isNotNull())
        .groupBy(*_by(by), bucket_start("ts", window_ms).alias("window_start"))
        .agg(F.sum("increase").alias("increase"))
    )


def counter_rate(
    samples: DataFrame, window_ms: int = 5 * MINUTE_MS, by: Sequence[str] = (), order: Sequence[str] = ("ts",), **series
) -> DataFrame:
    """Increase per second, per window and label group."""
    grown = counter_increase(samples, window_ms, by, order, **series)
    return grown.withColumn("rate", F.col("increase") / (window_ms / 1000)).drop("increase")


def gauge_by(samples: DataFrame, by: Sequence[str] = (), order: Sequence[str] = ("ts",)) -> DataFrame:
    """Sum, mean and number of the series' latest samples per label group."""
    w = Window.partitionBy("metric", "_series").orderBy(*[F.col(c).desc() for c in order])
    latest = (
        samples.withColumn("_series", _series_key())
        .withColumn("_rk", F.row_number().over(w))
        .filter(F.col("_rk") == 1)
    )
    return latest.groupBy(*_by(by)).agg(
        F.sum("value").alias("sum"), F.avg("value").alias("avg"), F.count("value").alias("count")
    )


def topk(df: DataFrame, k: int = 10, value: str = "rate", at: str = "window_start", tie: Sequence[str] = ()) -> DataFrame:
    """The k largest values per evaluation time."""
    w = Window.partitionBy(at).orderBy(F.col(value).desc(), *tie)
    return df.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k)


def ratio_percent(part: DataFrame, whole: DataFrame, on: Sequence[str], value: str = "value") -> DataFrame:
    """100 x part / whole for equal labels; null where the whole is zero."""
    left = part.withColumnRenamed(value, "_part")
    right = whole.withColumnRenamed(value, "_whole")
    return left.join(right, list(on)).select(
        *on, (F.try_divide("_part", "_whole") * 100).alias("percent")
    )


def used_percent(free: DataFrame, size: DataFrame, on: Sequence[str], value: str = "value") -> DataFrame:
    """100 x (1 - free / size)."""
    return ratio_percent(free, size, on, value).withColumn("percent", 100 - F.col("percent"))


def hit_ratio(hits: DataFrame, misses: DataFrame, on: Sequence[str], value: str = "rate") -> DataFrame:
    """hits / (hits + misses)."""
    h = hits.withColumnRenamed(value, "_h")
    m = misses.withColumnRenamed(value, "_m")
    return h.join(m, list(on)).select(*on, F.try_divide("_h", F.col("_h") + F.col("_m")).alias("ratio"))


def mean_latency(sums: DataFrame, counts: DataFrame, on: Sequence[str], value: str = "rate") -> DataFrame:
    """Rate of the total duration over the rate of the count."""
    s = sums.withColumnRenamed(value, "_s")
    c = counts.withColumnRenamed(value, "_c")
    return s.join(c, list(on)).select(*on, F.try_divide("_s", "_c").alias("mean"))


def label_join(samples: DataFrame, info: DataFrame, on: Sequence[str], bring: Sequence[str]) -> DataFrame:
    """Many-to-one enrichment: each sample times the info series of its labels, plus labels of it.

    The side sizes are left to adaptive execution, which broadcasts the smaller one only if its
    measured size allows.
    """
    side = info.select(*on, *bring, F.col("value").alias("_info"))
    return (
        samples.join(side, list(on))
        .withColumn("value", F.col("value") * F.col("_info"))
        .drop("_info")
    )


def histogram_quantile(
    buckets: DataFrame, q: float, by: Sequence[str] = (), value: str = "rate", le: str = "le"
) -> DataFrame:
    """Quantile from cumulative buckets with upper bounds ``le`` (text, '+Inf' for the last).

    Linear inside the bucket that contains the quantile, from 0 below the first bound; in the last
    bucket the highest finite bound. Groups without observations give null.
    """
    keys = list(by)
    w = Window.partitionBy(*keys).orderBy("_le")
    every = Window.partitionBy(*keys)
    bound = F.when(F.col(le) == "+Inf", F.lit(float("inf"))).otherwise(F.col(le).try_cast("double"))
    inf = F.lit(float("inf"))
    ranked = (
        buckets.withColumn("_le", bound)
        .groupBy(*keys, "_le")
        .agg(F.sum(value).alias("_c"))
        .withColumns(
            {
                "_total": F.max(F.when(F.col("_le") == inf, F.col("_c"))).over(every),
                "_lower": F.coalesce(F.lag("_le").over(w), F.lit(0.0)),
                "_below": F.coalesce(F.lag("_c").over(w), F.lit(0.0)),
            }
        )
        .withColumn("_want", F.col("_total") * q)
    )
    inside = F.col("_lower") + (F.col("_le") - F.col("_lower")) * F.try_divide(
        F.col("_want") - F.col("_below"), F.col("_c") - F.col("_below")
    )
    estimate = F.when(F.col("_le") == inf, F.col("_lower")).when(
        F.col("_le") <= 0, F.col("_le")
    ).otherwise(inside)
    hit = (F.col("_c") >= F.col("_want")) & (F.col("_total") > 0)
    return ranked.groupBy(*keys).agg(
        F.min_by(F.when(hit, estimate), F.when(hit, F.col("_le"))).alias("quantile")
    )
