"""Order books replayed from the events table."""

from pyspark.sql import functions as F

from catalog.base import TICKS, r, register, rounded
from tickloom.operators import book as bk
from tickloom.session import kept
from tickloom.sources import messages as ms
from tickloom.sources import testdata as td

# Update ids are shuffled against arrival order so that stale messages occur.
UPDATES = f"""{TICKS}, updates AS (
  SELECT upper(symbol) AS symbol, CASE WHEN "isBuyerMaker" THEN 'bid' ELSE 'ask' END AS side,
         floor(price) AS price, CAST(CAST(quantity AS BIGINT) % 10 AS DOUBLE) AS qty,
         "tradeId" AS seq, "tradeId" + CAST(quantity AS BIGINT) AS u, "time" FROM ticks)"""
REPLAY = f"""{UPDATES}, seen AS (
  SELECT *, max(u) OVER (PARTITION BY symbol ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM updates),
kept AS (SELECT * FROM seen WHERE top IS NULL OR u > top),
book AS (SELECT symbol, side, price, arg_max(qty, seq) AS qty FROM kept GROUP BY 1, 2, 3
  HAVING arg_max(qty, seq) <> 0)"""
BEST = "CASE WHEN side = 'bid' THEN -price ELSE price END"
LEVELS = f"""{REPLAY}, levels AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, side ORDER BY {BEST}) AS level FROM book)"""
DEPTH = f"""{LEVELS}, depth AS (
  SELECT symbol, side, level, price, qty AS quantity, sum(qty * price) OVER (
    PARTITION BY symbol, side ORDER BY level) AS total FROM levels WHERE level <= 20)"""


def shifted_updates(spark, d):
    t = td.ticks(spark, d)
    qty = F.pmod(F.col("quantity").cast("bigint"), F.lit(10)).cast("double")
    return t.select(
        F.upper("symbol").alias("symbol"),
        F.when(F.col("isBuyerMaker"), "bid").otherwise("ask").alias("side"),
        F.lit(0).alias("pos"),
        F.floor("price").cast("double").alias("price"),
        qty.alias("qty"),
        (F.col("tradeId") + F.col("quantity").cast("bigint")).alias("u"),
        F.col("tradeId").alias("seq"),
        "time",
    )


def book(spark, d):
    return bk.replay_book(shifted_updates(spark, d))


@register("replay_book", f"WITH {REPLAY} SELECT symbol, side, price, qty FROM book")
def replay_book(spark, d):
    return book(spark, d)


_PARSED = REPLAY.replace('"tradeId" + CAST(quantity AS BIGINT) AS u', '"tradeId" AS u')


@register("replay_book_from_messages", f"WITH {_PARSED} SELECT symbol, side, price, qty FROM book")
def replay_book_from_messages(spark, d):
    """JSON depth messages to levels to the final book."""
    return bk.replay_book(ms.parse_depth(td.depth_messages(td.ticks(spark, d)), keep=["seq"]))


# Messages of several levels, some of them full books, which move the id but no level.
MIXED = f"""{TICKS}, messages AS (
  SELECT upper(symbol) AS symbol, "tradeId" AS seq, "time", CAST(quantity AS BIGINT) AS k,
         "tradeId" + CAST(quantity AS BIGINT) AS u, "tradeId" % 7 = 0 AS full_book, floor(price) AS p,
         CASE WHEN "isBuyerMaker" THEN 'bid' ELSE 'ask' END AS own,
         CASE WHEN "isBuyerMaker" THEN 'ask' ELSE 'bid' END AS other FROM ticks),
ids AS (SELECT *, max(u) OVER (PARTITION BY symbol ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM messages),
applied AS (SELECT * FROM ids WHERE top IS NULL OR u > top),
levels AS (
  SELECT symbol, seq, own AS side, 0 AS pos, p AS price, CAST(k % 10 AS DOUBLE) AS qty FROM applied WHERE NOT full_book
  UNION ALL SELECT symbol, seq, own, 1, p + 1, CAST((k + 3) % 10 AS DOUBLE) FROM applied WHERE NOT full_book
  UNION ALL SELECT symbol, seq, other, 0, p + 5, CAST((k + 1) % 10 AS DOUBLE) FROM applied WHERE NOT full_book),
mixed_book AS (SELECT symbol, side, price, arg_max(qty, ROW(seq, pos)) AS qty FROM levels GROUP BY 1, 2, 3
  HAVING arg_max(qty, ROW(seq, pos)) <> 0)"""


def mixed_updates(ticks):
    return ms.parse_depth(td.mixed_depth_messages(ticks), keep=["seq"])


def _spread(spark, d):
    """The trades in as many tasks as the session shuffles into, however few parts their file has."""
    return td.ticks_of(td.events(spark, d).repartition("event_id"))


def _kept(updates):
    """Levels are read by each step that decides on them; messages are parsed once."""
    return kept(updates.select(*bk.UPDATE), "updates")


@register("replay_mixed_book", f"WITH {MIXED} SELECT symbol, side, price, qty FROM mixed_book")
def replay_mixed_book(spark, d):
    """Diffs of several levels between full-book messages and deletions."""
    return bk.replay_book(_kept(mixed_updates(_spread(spark, d))))


@register("replay_mixed_book_cut", f"WITH {MIXED} SELECT symbol, side, price, qty FROM mixed_book")
def replay_mixed_book_cut(spark, d):
    """The same with every symbol cut into slices of a few hundred messages."""
    return bk.replay_book(_kept(mixed_updates(_spread(spark, d))), min_rows=200)


# Messages by every rule: some without an id, stretches of ids on another scale, a baseline now and then.
RULED = f"""{TICKS}, messages AS MATERIALIZED (
  SELECT upper(symbol) AS symbol, "tradeId" AS seq, CAST(quantity AS BIGINT) AS k, floor(price) AS p,
         CASE WHEN "tradeId" % 11 = 0 THEN NULL WHEN "tradeId" // 300 % 4 = 3 THEN ("tradeId" + 300) // 300
              ELSE "tradeId" + 1000 + CAST(quantity AS BIGINT) END AS u,
         CASE WHEN "tradeId" % 397 = 0 THEN 'baseline' WHEN "tradeId" % 7 = 0 THEN 'snapshot' ELSE 'diff' END AS kind,
         CASE WHEN "isBuyerMaker" THEN 'bid' ELSE 'ask' END AS own,
         CASE WHEN "isBuyerMaker" THEN 'ask' ELSE 'bid' END AS other,
         row_number() OVER (PARTITION BY symbol ORDER BY "tradeId") AS rn FROM ticks),
decided AS (
  SELECT symbol, rn, seq, true AS applied, coalesce(u, 0) AS last FROM messages WHERE rn = 1
  UNION ALL
  SELECT m.symbol, m.rn, m.seq, m.kind = 'baseline' OR m.u IS NULL OR NOT (d.last > 0 AND m.u <= d.last AND d.last <= 100 * m.u),
         CASE WHEN m.u IS NULL THEN CASE WHEN d.last = 0 THEN 0 ELSE d.last + 1 END
              WHEN m.kind <> 'baseline' AND d.last > 0 AND m.u <= d.last AND d.last <= 100 * m.u THEN d.last ELSE m.u END
  FROM decided d JOIN messages m ON m.symbol = d.symbol AND m.rn = d.rn + 1),
kept AS (
  SELECT m.* FROM messages m JOIN decided d ON m.symbol = d.symbol AND m.rn = d.rn
  LEFT JOIN (SELECT symbol, max(seq) AS b FROM messages WHERE kind = 'baseline' GROUP BY 1) c ON c.symbol = m.symbol
  WHERE d.applied AND m.kind <> 'snapshot' AND m.seq >= coalesce(c.b, 0)),
levels AS (
  SELECT symbol, seq, own AS side, 0 AS pos, p AS price, CAST(k % 10 AS DOUBLE) AS qty FROM kept
  UNION ALL SELECT symbol, seq, own, 1, p + 1, CAST((k + 3) % 10 AS DOUBLE) FROM kept
  UNION ALL SELECT symbol, seq, other, 0, p + 5, CAST((k + 1) % 10 AS DOUBLE) FROM kept),
ruled_book AS (SELECT symbol, side, price, arg_max(qty, ROW(seq, pos)) AS qty FROM levels GROUP BY 1, 2, 3
  HAVING arg_max(qty, ROW(seq, pos)) <> 0)"""


def ruled_updates(t):
    k, seq = F.col("quantity").cast("bigint"), F.col("tradeId")
    own, other = (F.when(F.col("isBuyerMaker"), a).otherwise(b) for a, b in (("bid", "ask"), ("ask", "bid")))
    level = lambda side, pos, add, plus: F.struct(
        side.alias("side"), F.lit(pos).alias("pos"), (F.floor("price") + add).cast("double").alias("price"),
        F.pmod(k + plus, F.lit(10)).cast("double").alias("qty"),
    )
    hundreds = F.floor(seq / 300)
    return t.select(
        F.upper("symbol").alias("symbol"), seq.alias("seq"), "time",
        F.when(seq % 11 == 0, None).when(hundreds % 4 == 3, hundreds + 1).otherwise(seq + 1000 + k).alias("u"),
        F.when(seq % 397 == 0, "baseline").when(seq % 7 == 0, "snapshot").otherwise("diff").alias("kind"),
        F.explode(F.array(level(own, 0, 0, 0), level(own, 1, 1, 3), level(other, 0, 5, 1))).alias("l"),
    ).select("symbol", "seq", "time", "u", "kind", "l.*")


@register("replay_ruled_book", f"WITH RECURSIVE {RULED} SELECT symbol, side, price, qty FROM ruled_book")
def replay_ruled_book(spark, d):
    """Books of messages whose ids are missing, on another scale or reset by a baseline."""
    return bk.replay_book(_kept(ruled_updates(_spread(spark, d))))


@register("replay_ruled_book_cut", f"WITH RECURSIVE {RULED} SELECT symbol, side, price, qty FROM ruled_book")
def replay_ruled_book_cut(spark, d):
    """The same with every symbol cut into slices of a few hundred levels."""
    return bk.replay_book(_kept(ruled_updates(_spread(spark, d))), min_rows=200)


@register(
    "decided_messages",
    f"""WITH RECURSIVE {RULED} SELECT symbol, count(*) AS messages, count(*) FILTER (applied) AS applied,
    arg_max(last, rn) AS "lastUpdateId", CAST(sum(last) AS BIGINT) AS "sumOfIds" FROM decided GROUP BY 1""",
)
def decided_messages(spark, d):
    """How many messages of each symbol are applied, and the last id after each of them."""
    told = bk.decided_messages(ruled_updates(td.ticks(spark, d)))
    return told.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if("applied").alias("applied"), F.max_by("last", "at").alias("lastUpdateId"),
        F.sum("last").alias("sumOfIds"),
    )


# The given trades lie minutes apart; a clock 20,000 times as slow makes the real widths matter.
def _limited(every: int, force: str) -> str:
    return f"""WITH RECURSIVE {UPDATES}, moments AS MATERIALIZED (
      SELECT symbol, "time" // 20000 AS "time", seq, u, row_number() OVER (PARTITION BY symbol ORDER BY "time" // 20000, seq) AS rn
      FROM updates),
    walk AS (
      SELECT symbol, rn, "time" AS pushed, "time" AS forced, true AS due FROM moments WHERE rn = 1
      UNION ALL
      SELECT m.symbol, m.rn, CASE WHEN m."time" - w.pushed >= {every} THEN m."time" ELSE w.pushed END,
             CASE WHEN m."time" - w.pushed < {every} AND m."time" - w.forced >= {force} THEN m."time" ELSE w.forced END,
             m."time" - w.pushed >= {every} OR m."time" - w.forced >= {force}
      FROM walk w JOIN moments m ON m.symbol = w.symbol AND m.rn = w.rn + 1)
    SELECT m.symbol, m."time", m.seq, m.u FROM walk w JOIN moments m ON m.symbol = w.symbol AND m.rn = w.rn WHERE due"""


def _slow_updates(spark, d):
    updates = shifted_updates(spark, d)
    return updates.select("symbol", F.floor(F.col("time") / 20_000).alias("time"), "seq", "u")


@register("rate_limited_books", _limited(100, "1000"))
def rate_limited_books(spark, d):
    """At most one book per 100 ms since the last, and one more a second."""
    return bk.limit_rate(_slow_updates(spark, d), 100, 1000)


@register("rate_limited_books_cut", _limited(100, "1000"))
def rate_limited_books_cut(spark, d):
    """The same with every symbol cut into slices of about two hundred rows."""
    return bk.limit_rate(_slow_updates(spark, d), 100, 1000, min_rows=200, width=20_000)


@register("rate_limited_books_1s", _limited(1000, "CAST('infinity' AS DOUBLE)"))
def rate_limited_books_1s(spark, d):
    """One clock of a second alone."""
    return bk.limit_rate(_slow_updates(spark, d), 1000, None)


# Snapshot: five units bid at every price level, at an id that makes the first updates stale.
_SNAP = f"""{UPDATES}, ids AS (SELECT symbol, min(u) + 100 AS u0 FROM updates GROUP BY 1),
snap AS (SELECT u.symbol, 'bid' AS side, u.price, 5.0::DOUBLE AS qty, ids.u0 AS u FROM updates u
  JOIN ids USING (symbol) GROUP BY ALL),
flow AS (SELECT symbol, side, price, qty, u, seq FROM updates
  UNION ALL SELECT symbol, side, price, qty, u, -1 FROM snap),
seen AS (SELECT *, max(u) OVER (PARTITION BY symbol ORDER BY seq
  RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM flow),
kept AS (SELECT * FROM seen WHERE top IS NULL OR u > top)
SELECT symbol, side, price, arg_max(qty, seq) AS qty FROM kept GROUP BY 1, 2, 3
HAVING arg_max(qty, seq) <> 0"""


@register("replay_book_on_snapshot", f"WITH {_SNAP}")
def replay_book_on_snapshot(spark, d):
    u = shifted_updates(spark, d)
    ids = u.groupBy("symbol").agg((F.min("u") + 100).alias("u"))
    snap = (
        u.select("symbol", "price").distinct().join(ids, "symbol")
        .select("symbol", F.lit("bid").alias("side"), "price", F.lit(5.0).alias("qty"), "u")
    )
    return bk.replay_book(u, snap)


@register(
    "last_update_ids",
    f'WITH {UPDATES} SELECT symbol, max(u) AS "lastUpdateId" FROM updates GROUP BY 1',
)
def last_update_ids(spark, d):
    return bk.last_update_id(shifted_updates(spark, d))


@register("top_levels", f"WITH {LEVELS} SELECT symbol, side, price, qty FROM levels WHERE level <= 10")
def top_levels(spark, d):
    return bk.top_levels(book(spark, d), 10)


@register("depth_cumulative", f"WITH {DEPTH} SELECT * FROM depth")
def depth_cumulative(spark, d):
    out = bk.depth_cumulative(book(spark, d), 20)
    return out.withColumn("level", F.col("level").cast("bigint"))


@register(
    "depth_share",
    f"""WITH {DEPTH} SELECT *, {r('total / max(total) OVER (PARTITION BY symbol) * 100', 'share')}
    FROM depth""",
)
def depth_share(spark, d):
    out = bk.depth_share(bk.depth_cumulative(book(spark, d), 20))
    return rounded(out.withColumn("level", F.col("level").cast("bigint")), "share")


@register(
    "mid_price",
    f"""WITH {REPLAY}, q AS (SELECT symbol, max(price) FILTER (side = 'bid') AS best_bid,
      min(price) FILTER (side = 'ask') AS best_ask FROM book GROUP BY 1)
    SELECT *, coalesce((best_bid + best_ask) / 2, best_bid, best_ask) AS mid_price FROM q""",
)
def mid_price(spark, d):
    return bk.mid_price(book(spark, d))


@register(
    "book_payload",
    f"""WITH {LEVELS}, ids AS (SELECT symbol, max(u) AS "lastUpdateId" FROM updates GROUP BY 1)
    SELECT symbol, any_value("lastUpdateId") AS "lastUpdateId",
      count(*) FILTER (side = 'bid') AS bids, count(*) FILTER (side = 'ask') AS asks,
      arg_min(price, level) FILTER (side = 'bid') AS best_bid,
      arg_min(price, level) FILTER (side = 'ask') AS best_ask,
      arg_max(qty, level) FILTER (side = 'ask') AS last_ask_qty
    FROM levels JOIN ids USING (symbol) WHERE level <= 100 GROUP BY 1""",
)
def book_payload(spark, d):
    u = shifted_updates(spark, d)
    p = bk.book_payload(bk.replay_book(u), bk.last_update_id(u), 100)
    return p.select(
        "symbol", "lastUpdateId", F.size("bids").cast("bigint").alias("bids"), F.size("asks").cast("bigint").alias("asks"),
        F.get("bids", F.lit(0))["price"].alias("best_bid"), F.get("asks", F.lit(0))["price"].alias("best_ask"),
        F.try_element_at("asks", F.lit(-1))["qty"].alias("last_ask_qty"),
    )


@register(
    "throttled_books",
    f"""WITH {UPDATES}, s AS (SELECT *, "time" - "time" % 3600000 AS slot FROM updates)
    SELECT symbol, slot, max(seq) AS seq, arg_max(u, seq) AS u FROM s GROUP BY 1, 2""",
)
def throttled_books(spark, d):
    return bk.throttle(shifted_updates(spark, d), 3_600_000).select("symbol", "slot", "seq", "u")


@register(
    "changed_only",
    f"""WITH {TICKS}, e AS (SELECT symbol, "time", "tradeId" AS seq, floor(price) AS id FROM ticks
      WHERE floor(price) <> 0),
    l AS (SELECT *, lag(id) OVER (PARTITION BY symbol ORDER BY "time", seq) AS prev FROM e)
    SELECT symbol, "time", seq, CAST(id AS BIGINT) AS "lastUpdateId" FROM l
    WHERE prev IS NULL OR prev <> id""",
)
def changed_only(spark, d):
    t = td.ticks(spark, d).select(
        "symbol", "time", F.col("tradeId").alias("seq"), F.floor("price").cast("bigint").alias("lastUpdateId")
    )
    return bk.changed_only(t)
