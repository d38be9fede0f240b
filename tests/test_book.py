import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import book as bk

LEVELS = "symbol string, side string, pos int, price double, qty double, u long, seq long"


def random_updates(seed, n=400, levels=2):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        symbol = rng.choice(["HOT", "HOT", "HOT", "B"])
        u = seq + rng.randint(0, 12)
        for pos in range(rng.randint(1, levels)):
            side = rng.choice(["bid", "ask"])
            rows.append((symbol, side, pos, float(rng.randint(1, 15)), float(rng.choice([0, 0, 1, 2, 5])), u, seq))
    return rows


def fold(rows, snapshot=()):
    """The sequential rule, one message after the other."""
    books, last = {}, {}
    for symbol, side, price, qty, u in snapshot:
        if qty:
            books.setdefault(symbol, {})[(side, price)] = qty
        last[symbol] = u
    done = {}
    for symbol, side, pos, price, qty, u, seq in sorted(rows, key=lambda r: (r[6], r[2])):
        if done.get(symbol, (None, None))[0] != seq:
            done[symbol] = (seq, u > last.get(symbol, -1))
            if u > last.get(symbol, -1):
                last[symbol] = u
        if done[symbol][1]:
            book = books.setdefault(symbol, {})
            if qty == 0:
                book.pop((side, price), None)
            else:
                book[(side, price)] = qty
    return sorted((s, side, p, q) for s, b in books.items() for (side, p), q in b.items())


def collected(df):
    return sorted(tuple(r) for r in df.select("symbol", "side", "price", "qty").collect())


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("min_rows", [None, 3])
def test_replay_equals_fold(spark, seed, min_rows, monkeypatch):
    monkeypatch.setattr(bk, "SEQ_WIDTH", 32)
    rows = random_updates(seed)
    df = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), LEVELS).repartition(5)
    assert collected(bk.replay_book(df, min_rows=min_rows)) == fold(rows)


def test_replay_on_snapshot(spark):
    rows = random_updates(3)
    snapshot = [("HOT", "bid", float(p), 3.0, 60) for p in range(1, 30)] + [("B", "ask", 4.0, 0.0, 10)]
    base = spark.createDataFrame(snapshot, "symbol string, side string, price double, qty double, u long")
    got = bk.replay_book(spark.createDataFrame(rows, LEVELS), base)
    assert collected(got) == fold(rows, snapshot)


def test_full_books_move_the_id_only(spark):
    rows = [
        ("A", "bid", 0, 5.0, 1.0, 10, 0, "diff"), ("A", "bid", 0, 7.0, 1.0, 20, 1, "snapshot"),
        ("A", "ask", 0, 8.0, 1.0, 20, 1, "snapshot"), ("A", "ask", 0, 9.0, 1.0, 15, 2, "diff"),
        ("A", "ask", 0, None, 1.0, 30, 3, "diff"), ("A", "ask", 1, 6.0, None, 30, 3, "diff"),
    ]
    df = spark.createDataFrame(rows, LEVELS + ", kind string")
    assert collected(bk.replay_book(df)) == [("A", "bid", 5.0, 1.0)]


def test_arrival_numbers_have_no_limit(spark):
    rows = [
        ("A", "bid", 70_000, 1.0, 3.0, 1, 1), ("A", "bid", 0, 1.0, 4.0, 2, 2),
        ("B", "bid", 0, 1.0, 5.0, 1, 2**62 - 1), ("B", "bid", 0, 1.0, 6.0, 2, 2**62 + 5),
    ]
    assert collected(bk.replay_book(spark.createDataFrame(rows, LEVELS))) == [("A", "bid", 1.0, 4.0), ("B", "bid", 1.0, 6.0)]


def test_deleting_a_missing_level(spark):
    df = spark.createDataFrame([("A", "bid", 0, 1.0, 0.0, 1, 0)], LEVELS)
    assert bk.replay_book(df).count() == 0


@pytest.fixture(scope="module")
def book(spark):
    rows = [("A", "bid", float(p), 1.0) for p in range(1, 31)] + [("A", "ask", float(p), 2.0) for p in range(40, 45)]
    rows.append(("ONE", "ask", 7.0, 1.0))
    return spark.createDataFrame(rows, "symbol string, side string, price double, qty double")


def test_depth(book):
    rows = [r for r in bk.depth_cumulative(book, 3).collect() if r.symbol == "A"]
    bids = sorted((r.level, r.price, r.total) for r in rows if r.side == "bid")
    asks = sorted((r.level, r.price, r.total) for r in rows if r.side == "ask")
    assert bids == [(1, 30.0, 30.0), (2, 29.0, 59.0), (3, 28.0, 87.0)]
    assert asks == [(1, 40.0, 80.0), (2, 41.0, 162.0), (3, 42.0, 246.0)]
    share = {(r.side, r.level): r.share for r in bk.depth_share(bk.depth_cumulative(book, 3)).collect() if r.symbol == "A"}
    assert share[("ask", 3)] == 100.0 and share[("bid", 1)] == pytest.approx(3000 / 246)
    with pytest.raises(ValueError):
        bk.depth_cumulative(book, 101)


def test_top_levels_and_mid(book):
    assert bk.top_levels(book, 10).filter("side = 'bid' and symbol = 'A'").agg(F.min("price")).first()[0] == 21.0
    mid = {r.symbol: r.mid_price for r in bk.mid_price(book).collect()}
    assert mid == {"A": 35.0, "ONE": 7.0}


def test_payload(spark, book):
    ids = spark.createDataFrame([("A", 9), ("ONE", 3)], "symbol string, lastUpdateId long")
    rows = {r.symbol: r for r in bk.book_payload(book, ids, 2).collect()}
    assert [tuple(l) for l in rows["A"].bids] == [(30.0, 1.0), (29.0, 1.0)]
    assert [tuple(l) for l in rows["A"].asks] == [(40.0, 2.0), (41.0, 2.0)]
    assert rows["ONE"].bids == [] and rows["ONE"].lastUpdateId == 3


def test_throttle_and_changed_only(spark):
    rows = [("A", 0, 1, 5), ("A", 40, 2, 5), ("A", 90, 3, 6), ("A", 100, 4, None), ("A", 120, 5, 6), ("A", 130, 6, 7)]
    df = spark.createDataFrame(rows, "symbol string, time long, seq long, lastUpdateId long")
    assert sorted(r.seq for r in bk.throttle(df).collect()) == [3, 6]
    assert sorted(r.seq for r in bk.changed_only(df).collect()) == [1, 3, 6]
    assert sorted(r.seq for r in bk.changed_only(df, min_rows=1).collect()) == [1, 3, 6]


def test_tick_change(spark):
    rows = [("A", 1, 1, 0.0), ("A", 2, 2, 4.0), ("A", 3, 3, 5.0)]
    df = spark.createDataFrame(rows, "symbol string, time long, tradeId long, price double")
    assert [r.change_pct for r in bk.tick_change_pct(df).orderBy("time").collect()] == [None, None, 25.0]
