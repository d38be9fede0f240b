"""Book messages and rate limits decided in parallel against one decision after the other."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import book as bk
from tickloom.operators import stepwise as sw

LEVELS = "symbol string, side string, pos int, price double, qty double, u long, seq long, kind string"


def next_last(last, u, baseline):
    """Whether a message is applied, and the last id after it."""
    u = None if u is None else max(u, 0)
    if not baseline and u is not None and last > 0 and u <= last and last <= 100 * u:
        return False, last
    return True, (u if u is not None else last + 1 if last else 0)


def fold(rows, snapshot=(), wait=False):
    messages, books, last = {}, {}, {}
    for symbol, side, price, qty, u in snapshot:
        books.setdefault(symbol, {})[(side, price)] = qty
        last[symbol] = u
    for r in sorted(rows, key=lambda r: (r[6], r[2])):
        messages.setdefault(r[0], {}).setdefault(r[6], []).append(r)
    for symbol, by_seq in messages.items():
        order = list(by_seq.values())
        if wait:
            at = next((i for i, m in enumerate(order) if m[0][7] == "baseline"), None)
            if at is None:
                continue
            newer = [m for m in order[:at] if m[0][5] is None or m[0][5] > (order[at][0][5] or 0)]
            order = [order[at], *newer, *order[at + 1 :]]
        for m in order:
            kind, u = m[0][7], m[0][5]
            ok, last[symbol] = next_last(last.get(symbol, 0), u, kind == "baseline")
            if ok and kind == "baseline":
                books[symbol] = {}
            if ok and kind in ("diff", "baseline"):
                for _, side, _, price, qty, *_ in m:
                    books.setdefault(symbol, {})[(side, price)] = qty
    return sorted((s, side, p, q) for s, b in books.items() for (side, p), q in b.items() if q), last


def random_messages(seed, n=500):
    rng = random.Random(seed)
    rows, scale = [], 1
    for seq in range(n):
        symbol = rng.choice(["HOT", "HOT", "HOT", "B", "C"])
        if rng.random() < 0.02:
            scale = rng.choice([1, 1, 300, 90_000])
        u = None if rng.random() < 0.1 else max(0, seq + rng.randint(-15, 15)) * scale
        kind = rng.choices(["diff", "snapshot", "baseline"], [30, 4, 0 if symbol == "C" else 1])[0]
        for pos in range(rng.randint(1, 3)):
            rows.append((symbol, rng.choice(["bid", "ask"]), pos, float(rng.randint(1, 12)), float(rng.choice([0, 1, 2, 5])), u, seq, kind))
    return rows


def collected(df):
    return sorted(tuple(r) for r in df.select("symbol", "side", "price", "qty").collect())


@pytest.mark.parametrize("block,run,min_rows,wait", [(512, 256, None, False), (7, 3, None, True), (7, 3, 20, False)])
def test_books_with_every_rule(spark, monkeypatch, block, run, min_rows, wait):
    monkeypatch.setattr(sw, "BLOCK", block)
    monkeypatch.setattr(sw, "RUN", run)
    monkeypatch.setattr(bk, "SEQ_WIDTH", 64)
    for seed in (1, 2):
        rows = random_messages(seed)
        df = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), LEVELS).repartition(5)
        want, last = fold(rows, wait=wait)
        assert collected(bk.replay_book(df, min_rows=min_rows, wait=wait)) == want
        if min_rows is None:
            assert {r.symbol: r.lastUpdateId for r in bk.last_update_id(df, wait=wait).collect()} == last


def test_books_on_a_snapshot(spark):
    rows = random_messages(5, 200)
    snapshot = [("HOT", "bid", float(p), 3.0, 70) for p in range(1, 30)] + [("Z", "ask", 4.0, 1.0, 10)]
    snap = spark.createDataFrame(snapshot, "symbol string, side string, price double, qty double, u long")
    df = spark.createDataFrame(rows, LEVELS)
    want, last = fold(rows, snapshot)
    assert collected(bk.replay_book(df, snap, resumed=True)) == want
    assert {r.symbol: r.lastUpdateId for r in bk.last_update_id(df, snap).collect()} == last


def test_plain_ids_take_the_running_maximum(spark):
    rows = [("A", "bid", 0, 1.0, 1.0, 50 + i, i, "diff") for i in range(20)]
    plain = spark.createDataFrame(rows, LEVELS)
    jump = [("A", "bid", 0, 1.0, 1.0, 9_000_000, 300, "diff")]
    assert bk._plain_ids(plain) and bk._plain_ids(spark.createDataFrame([*rows, *jump], LEVELS))
    assert not bk._plain_ids(spark.createDataFrame([*rows, *jump, ("A", "bid", 0, 1.0, 1.0, 80_000, 400, "diff")], LEVELS))
    assert not bk._plain_ids(spark.createDataFrame([*rows, ("A", "bid", 0, 1.0, 1.0, None, 30, "diff")], LEVELS))
    assert bk._plain_ids(plain.limit(0))
    assert collected(bk.replay_book(plain.limit(0))) == []


def random_function(rng):
    cuts = sorted(rng.sample(range(-20, 20), rng.randint(0, 4)))
    return [(hi, rng.random() < 0.5, rng.randint(-20, 20)) for hi in [*cuts, sw.TOP]]


def value(f, x):
    hi, keep, v = next(p for p in f if p[0] >= x)
    return x + v if keep else v


def test_composed_functions(spark):
    rng = random.Random(2)
    rows = [(i, random_function(rng), random_function(rng)) for i in range(150)]
    df = spark.createDataFrame(rows, f"i int, f {sw.PIECES}, g {sw.PIECES}")
    for r in df.select("i", sw.composed(F.col("f"), F.col("g")).alias("h")).collect():
        _, f, g = rows[r.i]
        h = [tuple(p) for p in r.h]
        assert [value(h, x) for x in range(-45, 45)] == [value(g, value(f, x)) for x in range(-45, 45)]
        assert all(a[1:] != b[1:] for a, b in zip(h, h[1:], strict=False))


def published(rows, every, force):
    out = []
    for symbol in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == symbol), key=lambda r: (r[1], r[2]))
        pushed, forced = None, own[0][1]
        for r in own:
            if pushed is None or r[1] - pushed >= every:
                pushed = r[1]
            elif force is not None and r[1] - forced >= force:
                forced = r[1]
            else:
                continue
            out.append(r)
    return sorted(out)


@pytest.mark.parametrize("every,force", [(100, 1000), (100, 130), (1000, None)])
@pytest.mark.parametrize("min_rows", [None, 50])
def test_rate_limit_is_the_greedy_one(spark, every, force, min_rows):
    rng = random.Random(every)
    rows, t = [], 0
    for seq in range(900):
        t += rng.choice([0, 0, 1, 7, 30, 90, 400 if rng.random() < 0.1 else 3])
        rows.append((rng.choice(["HOT", "HOT", "B"]), t, seq, "x"))
    df = spark.createDataFrame(rows, "symbol string, time long, seq long, note string").repartition(4)
    extra = {} if min_rows is None else {"min_rows": min_rows, "width": 5000}
    got = bk.limit_rate(df, every, force, **extra)
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == published(rows, every, force)
    assert bk.limit_rate(df.limit(0), every, force).count() == 0
