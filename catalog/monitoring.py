"""Metric roll-ups. Samples come from events: one counter series per (user, event type)."""

from pyspark.sql import functions as F

from catalog.base import r, register, rounded
from tickloom.functions.scalars import utc_millis
from tickloom.operators import metrics as mt
from tickloom.schemas import DAY_MS
from tickloom.sources import testdata as td

SAMPLES = """
samples AS (
  SELECT 'requests_total' AS metric, 'u' || user_id AS pod, event_type AS container,
         'ns-' || (length(event_type)) AS namespace, epoch_us(ts) // 1000 AS ts, event_id AS seq,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events)"""
STEPS = f"""{SAMPLES}, lagged AS (
  SELECT *, lag(value) OVER (PARTITION BY pod, container ORDER BY ts, seq) AS prev FROM samples),
steps AS (SELECT *, CASE WHEN value >= prev THEN value - prev ELSE value END AS inc FROM lagged
  WHERE prev IS NOT NULL)"""
ORDER = ["ts", "seq"]


def samples(spark, d):
    e = td.events(spark, d)
    pod, kind = F.concat(F.lit("u"), "user_id"), F.col("event_type")
    return e.select(
        F.lit("requests_total").alias("metric"),
        F.create_map(
            F.lit("pod"), pod, F.lit("container"), kind,
            F.lit("namespace"), F.concat(F.lit("ns-"), F.length(kind).cast("string")),
        ).alias("labels"),
        utc_millis("ts").alias("ts"),
        F.col("event_id").alias("seq"),
        F.from_json("props", "k BIGINT")["k"].cast("double").alias("value"),
    )


@register(
    "counter_rate",
    f"""WITH {STEPS} SELECT pod, ts - ts % {DAY_MS} AS window_start, sum(inc) / 86400 AS rate
    FROM steps GROUP BY 1, 2""",
)
def counter_rate(spark, d):
    return mt.counter_rate(samples(spark, d), DAY_MS, ["pod"], ORDER)


@register(
    "counter_increase",
    f"""WITH {STEPS} SELECT container, namespace, ts - ts % 3600000 AS window_start,
    sum(inc) AS increase FROM steps GROUP BY 1, 2, 3""",
)
def counter_increase(spark, d):
    return mt.counter_increase(samples(spark, d), by=["container", "namespace"], order=ORDER)


GAUGES = f"""{SAMPLES}, latest AS (SELECT * FROM samples QUALIFY row_number() OVER (
  PARTITION BY pod, container ORDER BY ts DESC, seq DESC) = 1)"""


@register(
    "gauge_by_namespace",
    f"""WITH {GAUGES} SELECT namespace, sum(value) AS sum, avg(value) AS avg, count(*) AS count
    FROM latest GROUP BY 1""",
)
def gauge_by_namespace(spark, d):
    return mt.gauge_by(samples(spark, d), ["namespace"], ORDER)


@register(
    "top_pods_by_rate",
    f"""WITH {STEPS}, g AS (SELECT pod, ts - ts % {DAY_MS} AS window_start, sum(inc) / 86400 AS rate
      FROM steps GROUP BY 1, 2),
    t AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY rate DESC, pod) AS position FROM g)
    SELECT pod, window_start, rate, position FROM t WHERE position <= 10""",
)
def top_pods_by_rate(spark, d):
    rates = mt.counter_rate(samples(spark, d), DAY_MS, ["pod"], ORDER)
    out = mt.topk(rates, 10, tie=["pod"])
    return out.withColumn("position", F.col("position").cast("bigint"))


@register(
    "matched_samples",
    f"""WITH {SAMPLES} SELECT pod, container, ts, seq, value FROM samples
    WHERE container <> 'error' AND namespace = 'ns-4' AND regexp_full_match(pod, 'u1.*')""",
)
def matched_samples(spark, d):
    out = mt.match(
        samples(spark, d), "requests_total", equal={"namespace": "ns-4"},
        not_equal={"container": "error"}, regex={"pod": "u1.*"},
    )
    return out.select(mt.label("pod").alias("pod"), mt.label("container").alias("container"), "ts", "seq", "value")


@register(
    "memory_ratio",
    f"""WITH {GAUGES}, p AS (SELECT pod, sum(value) AS used FROM latest WHERE container <> 'error' GROUP BY 1),
    w AS (SELECT pod, sum(value) AS all_ FROM latest GROUP BY 1)
    SELECT pod, {r('CASE WHEN all_ <> 0 THEN used / all_ * 100 END', 'percent')} FROM p JOIN w USING (pod)""",
)
def memory_ratio(spark, d):
    s = samples(spark, d)
    part = mt.gauge_by(mt.match(s, not_equal={"container": "error"}), ["pod"], ORDER)
    whole = mt.gauge_by(s, ["pod"], ORDER)
    return rounded(mt.ratio_percent(part.select("pod", "sum"), whole.select("pod", "sum"), ["pod"], "sum"), "percent")


@register(
    "disk_used",
    f"""WITH {GAUGES}, p AS (SELECT pod, sum(value) AS f FROM latest WHERE container <> 'error' GROUP BY 1),
    w AS (SELECT pod, sum(value) AS s FROM latest GROUP BY 1)
    SELECT pod, {r('CASE WHEN s <> 0 THEN 100 - f / s * 100 END', 'percent')} FROM p JOIN w USING (pod)""",
)
def disk_used(spark, d):
    s = samples(spark, d)
    free = mt.gauge_by(mt.match(s, not_equal={"container": "error"}), ["pod"], ORDER).select("pod", "sum")
    size = mt.gauge_by(s, ["pod"], ORDER).select("pod", "sum")
    return rounded(mt.used_percent(free, size, ["pod"], "sum"), "percent")


def _pair_sql(a: str, b: str, expr: str, name: str) -> str:
    return f"""WITH {STEPS}, x AS (SELECT ts - ts % {DAY_MS} AS window_start,
      sum(inc) FILTER (container = '{a}') / 86400 AS a, sum(inc) FILTER (container = '{b}') / 86400 AS b
      FROM steps GROUP BY 1)
    SELECT window_start, {r(expr, name)} FROM x WHERE a IS NOT NULL AND b IS NOT NULL"""


def _rate_of(spark, d, container):
    return mt.counter_rate(mt.match(samples(spark, d), equal={"container": container}), DAY_MS, order=ORDER)


@register("cache_hit_ratio", _pair_sql("click", "view", "CASE WHEN a + b <> 0 THEN a / (a + b) END", "ratio"))
def cache_hit_ratio(spark, d):
    out = mt.hit_ratio(_rate_of(spark, d, "click"), _rate_of(spark, d, "view"), ["window_start"])
    return rounded(out, "ratio")


@register("mean_latency", _pair_sql("purchase", "signup", "CASE WHEN b <> 0 THEN a / b END", "mean"))
def mean_latency(spark, d):
    out = mt.mean_latency(_rate_of(spark, d, "purchase"), _rate_of(spark, d, "signup"), ["window_start"])
    return rounded(out, "mean")


@register(
    "rate_with_namespace",
    f"""WITH {STEPS}, g AS (SELECT container, ts - ts % {DAY_MS} AS window_start, sum(inc) / 86400 AS v
      FROM steps GROUP BY 1, 2),
    info AS (SELECT DISTINCT container, namespace FROM samples)
    SELECT container, window_start, namespace, v AS value FROM g JOIN info USING (container)""",
)
def rate_with_namespace(spark, d):
    s = samples(spark, d)
    rates = mt.counter_rate(s, DAY_MS, ["container"], ORDER).withColumnRenamed("rate", "value")
    info = s.select(
        mt.label("container").alias("container"), mt.label("namespace").alias("namespace"), F.lit(1.0).alias("value")
    ).distinct()
    return mt.label_join(rates, info, ["container"], ["namespace"])


_BOUNDS = [1, 5, 10, 25, 50, 100, 250]
_SQL_BOUNDS = "[1, 5, 10, 25, 50, 100, 250, 'inf'::DOUBLE]"


@register(
    "latency_quantile",
    f"""WITH b AS (SELECT event_type AS endpoint, unnest({_SQL_BOUNDS}) AS le, value FROM events),
    c AS (SELECT endpoint, le, count(*) FILTER (value <= le) AS c FROM b GROUP BY 1, 2),
    x AS (SELECT *, lag(le, 1, 0.0) OVER w AS lower, lag(c, 1, 0) OVER w AS below,
      max(c) OVER (PARTITION BY endpoint) * 0.95 AS want FROM c WINDOW w AS (PARTITION BY endpoint ORDER BY le))
    SELECT endpoint, {r('''arg_min(CASE WHEN isinf(le) THEN lower
        ELSE lower + (le - lower) * (want - below) / (c - below) END, le)''', 'quantile')}
    FROM x WHERE c >= want GROUP BY 1""",
)
def latency_quantile(spark, d):
    e = td.events(spark, d)
    # Cumulative buckets: one row per event and bound it falls under, counted before the shuffle.
    bounds = F.array(*[F.lit(float(b)) for b in _BOUNDS], F.lit(float("inf")))
    hits = e.select(
        F.col("event_type").alias("endpoint"), F.explode(F.filter(bounds, lambda b: F.col("value") <= b)).alias("b")
    )
    text = F.when(F.col("b") == float("inf"), "+Inf").otherwise(F.col("b").cast("string"))
    buckets = hits.groupBy("endpoint", text.alias("le")).agg(F.count(F.lit(1)).cast("double").alias("rate"))
    return rounded(mt.histogram_quantile(buckets, 0.95, ["endpoint"]), "quantile")
