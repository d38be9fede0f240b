import pytest
from pyspark.sql import functions as F

from tickloom.operators import metrics as mt


def samples(spark, rows, metric="m"):
    data = [(metric, labels, ts, float(v)) for labels, ts, v in rows]
    return spark.createDataFrame(data, "metric string, labels map<string,string>, ts long, value double")


def test_increase_counts_resets(spark):
    a = {"pod": "a", "x": "1"}
    s = samples(spark, [(a, 0, 10), (a, 60_000, 15), (a, 120_000, 3), (a, 180_000, 7)])
    # Steps 5, then 3 after the reset, then 4.
    assert mt.counter_increase(s, by=["pod"]).first().increase == 12.0
    assert mt.counter_rate(s, 300_000, ["pod"]).first().rate == pytest.approx(12 / 300)
    assert mt.counter_increase(s, by=["pod"], min_rows=1, width=60_000).first().increase == 12.0


def test_label_order_does_not_split_series(spark):
    s = samples(spark, [({"a": "1", "b": "2"}, 0, 1), ({"b": "2", "a": "1"}, 1, 5)])
    assert mt.counter_increase(s).first().increase == 4.0


def test_match(spark):
    s = samples(spark, [({"ns": "app-1", "c": "x"}, 0, 1), ({"ns": "my-app-1", "c": "x"}, 0, 1), ({"c": "POD"}, 0, 1)])
    assert mt.match(s, regex={"ns": "app-.*"}).count() == 1
    assert mt.match(s, not_equal={"c": "POD"}).count() == 2
    assert mt.match(s, equal={"ns": ""}).count() == 1
    assert mt.match(s, "other").count() == 0


def test_gauge_uses_latest_sample(spark):
    s = samples(spark, [({"p": "a", "n": "x"}, 0, 1), ({"p": "a", "n": "x"}, 9, 5), ({"p": "b", "n": "x"}, 3, 7)])
    row = mt.gauge_by(s, ["n"]).first()
    assert (row["sum"], row["avg"], row["count"]) == (12.0, 6.0, 2)


def test_topk(spark):
    df = spark.createDataFrame([(0, "a", 1.0), (0, "b", 3.0), (0, "c", 2.0), (1, "a", 9.0)], "window_start long, p string, rate double")
    assert sorted((r.window_start, r.p) for r in mt.topk(df, 2, tie=["p"]).collect()) == [(0, "b"), (0, "c"), (1, "a")]


def test_ratios(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 1.0)], "p string, value double")
    b = spark.createDataFrame([("x", 4.0), ("y", 0.0)], "p string, value double")
    assert {r.p: r.percent for r in mt.ratio_percent(a, b, ["p"]).collect()} == {"x": 25.0, "y": None}
    assert {r.p: r.percent for r in mt.used_percent(a, b, ["p"]).collect()} == {"x": 75.0, "y": None}
    assert {r.p: r.ratio for r in mt.hit_ratio(a, b, ["p"], "value").collect()} == {"x": 0.2, "y": 1.0}
    assert {r.p: r["mean"] for r in mt.mean_latency(a, b, ["p"], "value").collect()} == {"x": 0.25, "y": None}
    info = b.withColumn("ns", F.lit("n"))
    assert {r.p: (r.value, r.ns) for r in mt.label_join(a, info, ["p"], ["ns"]).collect()} == {"x": (4.0, "n"), "y": (0.0, "n")}


@pytest.mark.parametrize("q,want", [(0.5, 15.0), (0.05, 1.0), (1.0, 20.0), (0.0, 0.0)])
def test_quantile(spark, q, want):
    rows = [("e", "10", 5.0), ("e", "20", 10.0), ("e", "+Inf", 10.0)] if q else [("e", "10", 5.0), ("e", "+Inf", 5.0)]
    df = spark.createDataFrame(rows, "e string, le string, rate double")
    got = mt.histogram_quantile(df, 0.75 if q == 0.5 else q, ["e"]).first().quantile
    assert got == pytest.approx(want if q != 0.05 else 1.0)


def test_quantile_in_the_last_bucket_and_empty(spark):
    df = spark.createDataFrame(
        [("a", "10", 1.0), ("a", "+Inf", 9.0), ("b", "10", 0.0), ("b", "+Inf", 0.0)], "e string, le string, rate double"
    )
    assert {r.e: r.quantile for r in mt.histogram_quantile(df, 0.9, ["e"]).collect()} == {"a": 10.0, "b": None}
