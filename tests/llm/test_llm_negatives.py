"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import hard_negatives as hn


def plain(rows, k=5, low=80, high=100):
    good = [r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    q = [[math.floor(256 * x) for x in r[1]] for r in good]
    good = [(r[0], v, r[2]) for r, v in zip(good, q, strict=True) if sum(x * x for x in v) < 2**62]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a in {(i, tuple(v), lab) for i, v, lab in good if i % 100 == 0}:
        scores = [(dot(a[1], v), i, lab) for i, v, lab in good]
        near = sorted(((-s, i) for s, i, lab in scores if lab == a[2] and i != a[0]))[:k]
        for s, p in near:
            hard = sorted((-n, i) for n, i, lab in scores if lab != a[2] and low * -s <= 100 * n <= high * -s)[:k]
            out += [(a[0], p, r + 1, i, -s, -n) for r, (n, i) in enumerate(hard)]
    return sorted(out)


def mined(spark, rows, **named):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score int, RANK int")
    found = hn.mine(df, F.col("vec_id") % 100 == 0, **named)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def clustered(rng, n, dim, labels, spread):
    centres = rng.normal(0, 1, (labels, dim))
    label = rng.integers(0, labels, n)
    return centres[label % max(1, labels // 2)] + rng.normal(0, spread, (n, dim)), label


@pytest.mark.parametrize("spread,scale", [(0.05, 1.0), (0.5, 1.0), (0.3, 3e5)])
@pytest.mark.parametrize("window,anchors", [(8, 4), (256, 2048)])
def test_against_all_pairs(spark, monkeypatch, spread, scale, window, anchors):
    monkeypatch.setattr(hn, "WINDOW", window)
    monkeypatch.setattr(hn, "ANCHORS", anchors)
    vectors, label = clustered(np.random.default_rng(int(spread * 100)), 900, 6, 6, spread)
    rows = [(i, (v * scale).tolist(), int(x), 1, 1) for i, (v, x) in enumerate(zip(vectors, label, strict=True))]
    got = mined(spark, rows)
    assert got == plain(rows) and len(got) > 50


def test_awkward_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, np.round(rng.normal(0, 1, 4), 1).tolist(), i % 3, 1, 1) for i in range(1, 60)]
    rows += [(100, [0.5, 0.5, 0.5, 0.5], 1, 1, 1)] * 2 + [(200, [0.0] * 4, 1, 1, 1), (300, [1.0, 1.0], 2, 1, 1), (400, [], 0, 1, 1)]
    rows += [(500, None, 1, 1, 1), (600, [1.0, None, 0.0, 0.0], 1, 1, 1), (700, [1.0, float("nan")], 1, 1, 1), (800, [float("inf")], 1, 1, 1)]
    rows += [(900, [1.0, 1.0, 1.0, 1.0], None, 1, 1), (None, [1.0, 1.0, 1.0, 1.0], 1, 1, 1), (1000, [1e30, 0.0, 0.0, 0.0], 2, 1, 1)]
    rows += [(60 + i, [0.5, 0.5, 0.5, 0.45], 2, 1, 1) for i in range(30)] + [(7, [0.5, 0.5, 0.5, 0.45], 0, 1, 1)] * 3
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows, positives=2, negatives=1, low=50, high=90) == [r for r in plain(rows, 5, 50, 90) if r[:2] in {x[:2] for x in plain(rows, 2, 50, 90)} and r[2] == 1]


def test_few_and_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1, 1, 1), (2, [1.0], 2, 1, 1)]) == []
    assert mined(spark, [(100, [1.0], 1, 1, 1), (2, [1.0], 2, 1, 1)]) == []
    assert mined(spark, [(100, [1.0], 1, 1, 1), (1, [1.0], 1, 1, 1), (2, [1.0], 2, 1, 1)]) == [(100, 1, 1, 2, 65536, 65536)]


def test_windows_are_passed_over():
    """In clustered data most windows cannot meet the scores that are wanted, and bounds always hold."""
    rng = np.random.default_rng(1)
    vectors, _ = clustered(rng, 4000, 16, 40, 0.05)
    q = hn.scaled(vectors)
    norm = hn.norms_of(q)
    directions = hn.choose_directions(q[:1000])
    angles = hn.angles_to(q, norm, directions)
    order = np.lexsort((angles.min(axis=1), angles.argmin(axis=1)))
    block = hn.Block(np.arange(40), np.zeros(40, np.int64), q[:40].astype(np.int32), norm[:40], angles[:40])
    met = 0
    for at in range(0, len(order), 64):
        own = order[at : at + 64]
        w = hn.RowWindow(own, np.zeros(len(own), np.int64), q[own].astype(np.int32), angles[own].min(axis=0), angles[own].max(axis=0), norm[own].min(), norm[own].max())
        least, most = block.bounds(w)
        score = block.scores(np.arange(40), w)
        assert (score >= least[:, None]).all() and (score <= most[:, None]).all()
        met += int((most >= 0.8 * norm[:40] ** 2).sum())
    assert met < 0.5 * 40 * -(-len(order) // 64)
