"""Whole market days over vendor-shaped files made from the derived feed: replay and validation of both markets, each with its SQL.

The feed's thirty days are laid over one trading day from 09:15 to 15:00. Shenzhen's growth stocks (300...) have
no upper limit, and every ninth of their buy orders rests far outside the closing band.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave import market_day
from bookweave.functions.scalars import market_ts, weighted_price_q
from bookweave.operators import integrity, ledger, snapshots, validation
from bookweave.operators.book import deltas
from bookweave.plans import core
from bookweave.plans.core import DAY, ORIGIN_MS
from bookweave.plans.feed import FEED_CTE, ms, pair_feed
from bookweave.schema import BOOK
from bookweave.shared import new_path, written
from bookweave.sources import sinks, vendor

TRADING_DAY = 20260828
MIDNIGHT = 1_787_846_400_000  # of that day at UTC+8
STEP = 300_000


def midnight(day):
    """Of a day, or a column of days, of TRADING_DAY's month."""
    return (day - TRADING_DAY) * DAY + MIDNIGHT


HEADS = {"SZ": ["000", "159", "300", "002"], "SH": ["600", "510", "688", "601"]}
#: Vendor events in one SQL text for both engines; {ms} is the epoch millisecond of ts, {heads} the symbols' first digits.
_VENDOR = """,
placed AS (
  SELECT feed.*, CASE CAST(sym % 4 AS INTEGER) WHEN 0 THEN '{h0}' WHEN 1 THEN '{h1}' WHEN 2 THEN '{h2}' ELSE '{h3}' END AS head, 33300000 + CAST((({ms} - 1704067200000) * 23 - MOD(({ms} - 1704067200000) * 23, 2880)) / 2880 AS BIGINT) AS tod FROM feed),
number AS (SELECT sym AS s, COALESCE(bid_id, ask_id) AS id, {number} AS no FROM placed WHERE kind = 'A'),
vendor AS (
  SELECT '{market}' AS market, {day} AS trading_day, CONCAT(head, LPAD(CAST(sym AS VARCHAR(10)), 3, '0')) AS symbol, CAST(1 + sym % 4 AS INTEGER) AS channel, seq * 20 + sym + 1 AS seq, kind, side,
         b.no AS bid_no, a.no AS ask_no, CASE WHEN kind = 'A' AND head = '300' AND bid_id % 9 = 0 THEN price - 50000 ELSE price END AS price, qty, {midnight} + tod AS quote_ms
  FROM placed LEFT JOIN number b ON b.s = sym AND b.id = bid_id LEFT JOIN number a ON a.s = sym AND a.id = ask_id)"""


def _vendor_sql(market: str, ms: str) -> str:
    heads = {f"h{i}": h for i, h in enumerate(HEADS[market])}
    number = "seq * 20 + sym + 1" if market == "SZ" else "COALESCE(bid_id, ask_id) + 1"
    return _VENDOR.format(ms=ms, market=market, day=TRADING_DAY, midnight=MIDNIGHT, number=number, **heads)


def vendor_events(spark: SparkSession, sf_dir: str, market: str) -> DataFrame:
    """The rows of `vendor`. An order's number is that of its add in Shenzhen, and of its own in Shanghai; both are among the events of its (sym, rn)."""
    feed = pair_feed(spark, sf_dir)
    seq, sym = F.col("seq") * 20 + F.col("sym") + 1, F.col("sym")
    if market == "SZ":
        add = lambda side: F.max(F.when((F.col("kind") == "A") & (F.col("side") == side), seq)).over(W.partitionBy("rn", "sym"))
        feed = feed.withColumns({"b_add": add("B"), "s_add": add("S")})
        number = {c: F.when(F.col(f"{c}_id").isNotNull() & sym.isNotNull(), F.col(a)) for c, a in (("bid", "b_add"), ("ask", "s_add"))}
    else:
        number = {c: F.when(sym.isNotNull(), F.col(f"{c}_id") + 1) for c in ("bid", "ask")}
    last, since = HEADS[market][3], (ms("ts") - 1_704_067_200_000) * 23
    head = F.when(sym % 4 == 0, HEADS[market][0]).when(sym % 4 == 1, HEADS[market][1]).when(sym % 4 == 2, HEADS[market][2]).otherwise(last)
    far = (F.col("kind") == "A") & (F.col("head") == "300") & (F.col("bid_id") % 9 == 0)
    return feed.withColumn("head", head).select(
        F.lit(market).alias("market"), F.lit(TRADING_DAY).alias("trading_day"), F.concat("head", F.lpad(sym.cast("string"), 3, "0")).alias("symbol"), (F.lit(1) + sym % 4).cast("int").alias("channel"), seq.alias("seq"), "kind", "side",
        number["bid"].alias("bid_no"), number["ask"].alias("ask_no"), F.when(far, F.col("price") - 50_000).otherwise(F.col("price")).alias("price"), "qty",
        (F.lit(MIDNIGHT) + 33_300_000 + F.call_function("div", since, F.lit(2880))).alias("quote_ms"), F.when(F.col("kind") == "A", "limit").alias("ord_type"),
    )


def _clock(ms) -> F.Column:
    """HH:MM:SS.mmm of an epoch millisecond at UTC+8."""
    t = F.pmod(ms + 28_800_000, F.lit(DAY))
    div = lambda a, b: F.call_function("div", a, F.lit(b))
    two = lambda c, n=2: F.lpad(c.cast("string"), n, "0")
    return F.concat(two(div(t, 3_600_000)), F.lit(":"), two(div(t, 60_000) % 60), F.lit(":"), two(div(t, 1000) % 60), F.lit("."), two(t % 1000, 3))


def _put(rows: DataFrame, root: str, day: int, feed: str, contract: str) -> None:
    """Rows of a day in a feed's own types and columns."""
    rows.select(*(F.col(n).cast(t.replace(";", ",")).alias(n) for n, t in vendor._columns(contract))).write.parquet(vendor.feed_path(root, day, feed))


def _money(c, scale: int):
    return (c.cast("decimal(30,0)") * F.lit("0.0001").cast("decimal(4,4)")).cast(f"decimal(38,{scale})")


def write_ticks(events: DataFrame, root: str, market: str, day: int = TRADING_DAY) -> None:
    """Canonical events of a day as the vendor's feeds of a market, in the order of source_row, or else of seq."""
    common = {"SecurityID": F.col("symbol"), "LocalTime": _clock(F.col("quote_ms")), "source_row_no": F.col("source_row" if "source_row" in events.columns else "seq")}
    no = lambda c: F.coalesce(c, F.lit(0))
    if market == "SH":
        last = events.groupBy("symbol", "channel").agg(F.max("seq").alias("last"))
        status = last.select("symbol", "channel", (F.col("last") + 20).alias("seq"), F.lit("S").alias("kind"), F.lit("CLOSE").alias("side"), F.lit(0).cast("bigint").alias("qty"), F.lit(midnight(day) + 54_000_000).alias("quote_ms"))
        e = events.unionByName(status, allowMissingColumns=True)
        rows = e.withColumns({
            **common, "LocalTime": _clock(F.col("quote_ms")), "BizIndex": F.col("seq"), "Channel": F.col("channel"), "TickTime": _clock(F.col("quote_ms")), "Type": F.when(F.col("kind") == "C", "D").otherwise(F.col("kind")),
            "BuyOrderNO": no("bid_no"), "SellOrderNO": no("ask_no"), "Price": no(_money(F.col("price"), 3)), "Qty": F.col("qty"), "TickBSFlag": F.col("side"),
        })
        _put(rows, root, day, *vendor.FEEDS["sh_ticks"])
        return
    adds = events.filter("kind = 'A'").withColumns({**common, "ChannelNo": F.col("channel"), "ApplSeqNum": F.col("seq"), "Price": _money(F.col("price"), 4), "OrderQty": F.col("qty"), "Side": F.when(F.col("side") == "B", 49).otherwise(50), "TransactTime": _clock(F.col("quote_ms")), "OrdType": F.when(F.col("ord_type") == "market", 49).when(F.col("ord_type") == "same_side_best", 85).otherwise(50)})
    _put(adds, root, day, *vendor.FEEDS["sz_orders"])
    done = events.filter("kind <> 'A'").withColumns({**common, "ChannelNo": F.col("channel"), "ApplSeqNum": F.col("seq"), "BidApplSeqNum": no("bid_no"), "OfferApplSeqNum": no("ask_no"), "LastPx": no(_money(F.col("price"), 4)), "LastQty": F.col("qty"), "ExecType": F.when(F.col("kind") == "T", 70).otherwise(52), "TransactTime": _clock(F.col("quote_ms"))})
    _put(done, root, day, *vendor.FEEDS["sz_executions"])


def write_frames(frames: DataFrame, root: str, market: str, day: int = TRADING_DAY) -> None:
    """Snapshots with status and source_row as the vendor's published frames of a market, in order; every 13th Shanghai frame lacks its reception number, and some of these their reception time."""
    gap, row = F.lit(market == "SH") & (F.col("source_row") % 13 == 0), F.col("source_row")
    c = vendor._REFERENCE[market]
    q = F.col("market").isNotNull()
    scaled = lambda f: F.col(f) if c[f][1] is None else F.when(q, F.col(f)).cast("decimal(30,0)").cast(f"decimal(38,{c[f][1]})")
    out = {
        "SecurityID": F.col("symbol"), "UpdateTime": _clock(F.col("quote_ms")), "source_row_no": F.col("source_row").cast("decimal(20,0)"), c["status"]: F.col("status"),
        "LocalTime": F.when(gap & (row % 2 == 0), " ").when(~(gap & (row % 3 == 0)), _clock(F.col("quote_ms"))), "SeqNo": F.when(~gap, row).cast("bigint"),
        **{c[f][0]: F.coalesce(_money(F.col(f), c[f][1]), F.lit(0).cast(f"decimal(38,{c[f][1]})")) for f in ("last_price", "high_price", "low_price", "bid_vwap", "ask_vwap")},
        "Turnover": _money(F.col("turnover"), c["turnover"][1]), c["trades"]: F.col("trades").cast("bigint"), **{c[f][0]: scaled(f) for f in ("volume", "bid_total", "ask_total")},
    }
    for column, word, count in (("asks", "Ask", "NumOrdersS"), ("bids", "Bid", "NumOrdersB")):
        for i in range(10):
            x = F.get(column, i)
            out |= {f"{word}Price{i + 1}": _money(x["price"], c["level"]), f"{word}Volume{i + 1}": x["quantity"].cast("decimal(38,3)") if market == "SH" else x["quantity"], f"{count}{i + 1}": x["order_count"]}
    if market == "SZ":
        free = F.col("symbol").startswith("300")
        out |= {"PreCloPrice": F.lit(10).cast("decimal(38,4)"), "HighLimitPrice": _money(F.when(free, F.lit(9_999_999_999_999)).otherwise(F.lit(110_000)), 6), "LowLimitPrice": _money(F.when(free, F.lit(100)).otherwise(F.lit(90_000)), 6)}
    frames.orderBy("symbol", "source_row").select(*(e.alias(n) for n, e in out.items())).write.parquet(vendor.feed_path(root, day, vendor.SNAPSHOT_FEEDS[market]))


def _files(spark: SparkSession, sf_dir: str, market: str) -> tuple[str, DataFrame]:
    root = new_path(spark, "vendor")
    events = written(vendor_events(spark, sf_dir, market), "events")
    write_ticks(events, root, market)
    return root, events


_STATUS = {"SZ": ("O0", "B0", "T0", "C0", "E0"), "SH": ("OCALL", "TRADE", "TRADE", "CCALL", "CLOSE")}


def _publish(root: str, events: DataFrame, market: str, days: tuple[int, ...] = (TRADING_DAY,)) -> None:
    """Frames every five minutes and at the close of each day, as the exchange would publish them, some spoilt by their number. All days are one job but for their files."""
    at = midnight(F.col("trading_day").cast("bigint"))
    changes = written(deltas(ledger.ledger(events)), "changes")
    grid = snapshots.grid_snapshots(events, changes, STEP).withColumns({"source_row": F.col("k"), "quote_ms": F.col("boundary_ms")})
    n = sum(snapshots.boundary_count(STEP))
    opening, first, running, call, end = _STATUS[market]
    status = F.when(F.col("k") == 1, opening).when(F.col("k") == 2, first).when(F.col("k") == n, call).otherwise(running)
    # at the close, orders far from the last price don't count where there is no upper limit
    near = changes.filter("NOT (symbol LIKE '300%' AND price < 60000)")
    cut = events.groupBy(*BOOK).agg(F.max("seq").alias("cut_seq")).withColumn("boundary_ms", at + 54_000_000)
    last = snapshots.close_snapshots(events, near, cut=cut).withColumns({"source_row": F.lit(n + 1), "quote_ms": at + (54_003_000 if market == "SH" else 54_000_000), "status": F.lit(end)})
    vwap = validation.closing_vwap(events, validation.price_quantum()).select(*BOOK, "close_price")
    fund = F.col("symbol").startswith("159")
    last = last.join(vwap, BOOK, "left").withColumn("last_price", F.when(fund, F.coalesce("close_price", "last_price")).otherwise(F.col("last_price"))).drop("close_price")
    q = validation.price_quantum()
    k = F.col("source_row")
    frames = grid.withColumn("status", status).drop("k").unionByName(last)
    frames = frames.withColumns({c: weighted_price_q(F.col(f"{s}_amount"), F.col(f"{s}_total"), q) for c, s in (("bid_vwap", "bid"), ("ask_vwap", "ask"))})
    frames = frames.withColumns({
        "volume": F.when(k % 5 == 0, F.col("volume") + 100).otherwise(F.col("volume")), "trades": F.when(k % 9 == 0, F.col("trades") + 1).otherwise(F.col("trades")),
        "bid_vwap": F.when(k % 3 == 0, F.col("bid_vwap") + 10).otherwise(F.col("bid_vwap")), "ask_vwap": F.when(k % 7 == 0, F.col("ask_vwap") + 20).otherwise(F.col("ask_vwap")),
        "bids": F.when(k % 11 == 0, F.slice("bids", 1, 0)).otherwise(F.col("bids")),
    })
    frames = written(frames, "frames")
    for day in days:
        write_frames(frames.filter(F.col("trading_day") == day), root, market, day)


def _replayed(spark, sf_dir, market):
    """What the sink wrote: every book at every boundary and at the close."""
    root, _ = _files(spark, sf_dir, market)
    out = new_path(spark, "out")
    sinks.write_snapshots(market_day.replay_day(spark, root, market, step_ms=STEP, check_files=False).snapshots, out)
    back = spark.read.parquet(out)
    units = lambda c: (F.col(c) * 10_000).cast("bigint").alias(c)
    return back.select(
        "symbol", "channel", "snapshot_kind", F.unix_millis("boundary_time").alias("boundary_ms"), F.unix_millis("last_quote_time").alias("last_quote_ms"), F.unix_millis("last_local_time").alias("last_local_ms"),
        *(units(c) for c in ("last_price", "high_price", "low_price", "turnover", "bid_vwap", "ask_vwap")), "volume", "trades", "bid_total", "ask_total",
        units("bid_price_1"), "bid_qty_1", "bid_orders_1", units("ask_price_1"), units("ask_price_10"), "ask_qty_10",
    )


def replay_sz(spark, sf_dir):
    return _replayed(spark, sf_dir, "SZ")


def replay_sh(spark, sf_dir):
    return _replayed(spark, sf_dir, "SH")


def replay_counters(spark, sf_dir):
    """Counters of a Shanghai day of stocks alone, and of the rules that its rows break (none)."""
    root, _ = _files(spark, sf_dir, "SH")
    day = market_day.replay_day(spark, root, "SH", universe="stocks", step_ms=STEP, check_files=False)
    broken = day.violations.agg(F.count("*").alias("violations"))
    return day.counters.drop("market", "trading_day", "repairs", "after_close_by_symbol").join(F.broadcast(broken))


def _validated(spark, sf_dir, market, **options):
    root, events = _files(spark, sf_dir, market)
    _publish(root, events, market)
    return market_day.validate_day(spark, root, market, check_files=False, **options)


def _records(v):
    return v.records.select("symbol", "class", "anchor", "quote_ms", "outcome", "reason", F.array_join("fields", ",").alias("fields"), "tag", "excluded_bid")


def validate_sz(spark, sf_dir):
    return _records(_validated(spark, sf_dir, "SZ"))


def validate_sh(spark, sf_dir):
    return _records(_validated(spark, sf_dir, "SH"))


def validate_preopen(spark, sf_dir):
    """Only the frames before the opening, and only what came before them."""
    return _records(_validated(spark, sf_dir, "SZ", pre_open_only=True))


def validation_summary(spark, sf_dir):
    return _validated(spark, sf_dir, "SH", symbols=["600000", "510001", "601003", "688999"]).summary.drop("market", "trading_day")


def vendor_faults(spark, sf_dir):
    """Rules that damaged rows of all three feeds break: every 20th has no quantity, every 30th no time, every 50th no symbol, every 70th an unknown code."""
    out = []
    for market in ("SH", "SZ"):
        root = new_path(spark, "vendor")
        e, n = vendor_events(spark, sf_dir, market), F.floor((F.col("seq") - 1) / 20)
        bad = e.withColumns({"qty": F.when(n % 20 == 0, 0).otherwise(F.col("qty")).cast("bigint"), "symbol": F.when(n % 50 == 0, " ").otherwise(F.col("symbol")), "kind": F.when((n % 70 == 0) & (F.lit(market) == "SH"), F.lit("X")).otherwise(F.col("kind")), "quote_ms": F.when(n % 30 == 0, None).otherwise(F.col("quote_ms"))})
        write_ticks(bad.withColumn("side", F.coalesce("side", F.lit("N"))), root, market)
        rows = vendor.read_sh_ticks(spark, root) if market == "SH" else vendor.read_sz(spark, root)
        out.append(vendor.violations(rows.filter("NOT (kind <=> 'S')")).groupBy("market", "stream", "code").agg(F.count("*").alias("rows")))
    return out[0].unionByName(out[1])


def sh_faults(spark, sf_dir):
    """What breaks the Shanghai rules: every 40th row's flag names the other side, and every 30th trade no passive order."""
    root = new_path(spark, "vendor")
    n = F.floor((F.col("seq") - 1) / 20)
    e = vendor_events(spark, sf_dir, "SH")
    other = F.when(F.col("side") == "B", "S").when(F.col("side") == "S", "B")
    e = e.withColumns({"side": F.when((F.col("kind") == "A") & (n % 40 == 0), other).otherwise(F.col("side")), "ask_no": F.when((F.col("kind") == "T") & (n % 30 == 0), None).otherwise(F.col("ask_no"))})
    write_ticks(e, root, "SH")
    return market_day.rebuild(spark, root, "SH").violations.filter("code IN ('add_side', 'unknown_trade')").groupBy("symbol", "code").agg(F.count("*").alias("rows"))


def vendor_amounts(spark, sf_dir):
    """Published Shanghai frames as read: amounts, prices, quantities and levels, summed by symbol. Closing frames, which hold what stands after all events, are those of validate_sh."""
    root, events = _files(spark, sf_dir, "SH")
    _publish(root, events, "SH")
    f = vendor.read_reference(spark, root, "SH").filter("status <> 'CLOSE'")
    return f.groupBy("symbol").agg(
        F.count("*").alias("frames"), F.sum("turnover").cast("bigint").alias("turnover"), F.sum("volume").alias("volume"), F.max("last_price").alias("last_price"), F.count_if("missing_reception").alias("missing"),
        F.count_if(F.size("load_error") > 0).alias("errors"), F.sum(F.aggregate("asks", F.lit(0).cast("bigint"), lambda a, x: a + x["quantity"])).alias("ask_quantity"), F.min(market_ts(F.col("trading_day"), F.lit("09:25:00.000"))).alias("open_ms"),
    )


def explicit_universe(spark, sf_dir):
    """Rows by class where two symbols are asked for by name."""
    e = vendor_events(spark, sf_dir, "SZ")
    wanted = F.col("symbol").isin(integrity.checked_symbols(["159001", "000004"]))
    return e.groupBy(F.when(wanted, "selected").when(integrity.in_universe("both"), "unselected").otherwise("unsupported").alias("row_class")).agg(F.count("*").alias("rows"))


def queries():
    names = [replay_sz, replay_sh, replay_counters, validate_sz, validate_sh, validate_preopen, validation_summary, vendor_faults, sh_faults, vendor_amounts, explicit_universe]
    return {f.__name__: f for f in names}


# ------------------------------------------------------------------ SQL


def _cte(market: str) -> str:
    return f"WITH {FEED_CTE}{_vendor_sql(market, '(epoch_us(ts) // 1000)')}, f AS (SELECT * FROM vendor)"


#: Boundaries of the grid, and the close with all that came before it.
_POINTS = f""",
b AS (SELECT symbol, k, 'scheduled' AS snapshot_kind, CASE WHEN k <= 27 THEN {MIDNIGHT} + 33300000 + k * {STEP} ELSE {MIDNIGHT} + 46800000 + (k - 27) * {STEP} END AS boundary_ms, CASE WHEN k <= 27 THEN {MIDNIGHT} + 33300000 + k * {STEP} ELSE {MIDNIGHT} + 46800000 + (k - 27) * {STEP} END AS upto
  FROM (SELECT DISTINCT symbol FROM f), (SELECT unnest(range(1, 52)) AS k)
  UNION ALL SELECT DISTINCT symbol, 52, 'market_close', {MIDNIGHT} + 54000000, {MIDNIGHT} + 54000001 FROM f)"""
_AT = """,
s AS (SELECT b.symbol, b.k, arg_max(price, seq) AS last_price, max(price) AS high_price, min(price) AS low_price, sum(qty) AS volume, sum(price * qty) AS turnover, count(*) AS trades
  FROM b JOIN f ON f.symbol = b.symbol AND f.kind = 'T' AND f.quote_ms < b.upto GROUP BY 1, 2),
lq AS (SELECT b.symbol, b.k, arg_max(quote_ms, seq) AS last_quote_ms FROM b JOIN f ON f.symbol = b.symbol AND f.quote_ms < b.upto GROUP BY 1, 2),
d AS (SELECT b.symbol, b.k, order_side, price, CAST(sum(dq) AS BIGINT) AS q, CAST(sum(dc) AS BIGINT) AS c FROM b JOIN g ON g.symbol = b.symbol AND g.quote_ms < b.upto GROUP BY ALL HAVING sum(dc) > 0),
n AS (SELECT *, row_number() OVER (PARTITION BY symbol, k, order_side ORDER BY CASE WHEN order_side = 'B' THEN -price ELSE price END) AS r FROM d),
v AS (SELECT symbol, k, sum(q) FILTER (order_side = 'B') AS bq, sum(q) FILTER (order_side = 'S') AS sq, sum(q * price) FILTER (order_side = 'B') AS bm, sum(q * price) FILTER (order_side = 'S') AS sm,
  max(price) FILTER (order_side = 'B' AND r = 1) AS b1, max(q) FILTER (order_side = 'B' AND r = 1) AS bq1, max(c) FILTER (order_side = 'B' AND r = 1) AS bc1, max(price) FILTER (order_side = 'S' AND r = 1) AS a1,
  max(price) FILTER (order_side = 'S' AND r = 10) AS a10, max(q) FILTER (order_side = 'S' AND r = 10) AS aq10 FROM n GROUP BY 1, 2)"""


def _replay_sql(market: str) -> str:
    return f"""{_cte(market)}{core._TOUCH}{core._SIGNED}{_POINTS}{_AT}
SELECT b.symbol, CAST(1 + CAST(substr(b.symbol, 4) AS INTEGER) % 4 AS INTEGER) AS channel, snapshot_kind, boundary_ms, last_quote_ms, last_quote_ms AS last_local_ms, last_price, high_price, low_price, CAST(coalesce(turnover, 0) AS BIGINT) AS turnover,
  CASE WHEN bq > 0 THEN CAST((bm + bq // 2) // bq AS BIGINT) END AS bid_vwap, CASE WHEN sq > 0 THEN CAST((sm + sq // 2) // sq AS BIGINT) END AS ask_vwap, CAST(coalesce(volume, 0) AS BIGINT) AS volume, coalesce(trades, 0) AS trades,
  CAST(coalesce(bq, 0) AS BIGINT) AS bid_total, CAST(coalesce(sq, 0) AS BIGINT) AS ask_total, b1 AS bid_price_1, bq1 AS bid_qty_1, bc1 AS bid_orders_1, a1 AS ask_price_1, a10 AS ask_price_10, aq10 AS ask_qty_10
FROM b LEFT JOIN s USING (symbol, k) LEFT JOIN lq USING (symbol, k) LEFT JOIN v USING (symbol, k)"""


def _validate_sql(market: str, where: str, summary: bool = False, upto: int = 54_000_001) -> str:
    """What each frame must come to, by what was spoilt in it; of closing prices, by the closing rule; without events before `upto`, that there is no source."""
    end = 54_003_000 if market == "SH" else 54_000_000
    start = 2 if market == "SH" else 2
    quantum = "CASE WHEN symbol LIKE '159%' THEN 10 ELSE 100 END" if market == "SZ" else "10"
    return f"""{_cte(market)}{core._TOUCH}{core._SIGNED}{_POINTS},
tl AS (SELECT *, max(quote_ms) OVER (PARTITION BY symbol) AS last_ms FROM f WHERE kind = 'T'),
cp AS (SELECT symbol, arg_max(price, seq) AS lp, max(CASE WHEN quote_ms >= {MIDNIGHT} + 53820000 THEN 1 ELSE 0 END) = 1 AS auction,
  (sum(price * qty) FILTER (quote_ms >= last_ms - 60000) + sum(qty) FILTER (quote_ms >= last_ms - 60000) * ({quantum}) // 2) // (sum(qty) FILTER (quote_ms >= last_ms - 60000) * ({quantum})) * ({quantum}) AS cp FROM tl GROUP BY symbol),
live AS (SELECT b.symbol, b.k, order_side, price, sum(dq) AS q FROM b JOIN g ON g.symbol = b.symbol AND g.quote_ms < b.upto GROUP BY ALL HAVING sum(dc) > 0),
sides AS (SELECT symbol, k, count(*) FILTER (order_side = 'B') AS nb, count(*) FILTER (order_side = 'S') AS ns, coalesce(sum(q) FILTER (order_side = 'B' AND symbol LIKE '300%' AND price < 60000), 0) AS far FROM live GROUP BY 1, 2),
w AS (
  SELECT b.symbol, CASE WHEN b.symbol LIKE '159%' OR b.symbol LIKE '510%' THEN 'etf' ELSE 'stock' END AS class, CASE WHEN b.k = 2 THEN 'pre_open' WHEN b.k = 52 THEN 'market_close' ELSE 'continuous' END AS anchor,
    CASE WHEN b.k = 52 THEN {MIDNIGHT} + {end} ELSE boundary_ms END AS quote_ms, b.k, CASE WHEN b.k = 52 THEN coalesce(far, 0) END AS far,
    EXISTS (SELECT 1 FROM f WHERE f.symbol = b.symbol AND quote_ms < {MIDNIGHT} + {upto}) AS seen, b.k = 52 AND b.symbol LIKE '159%' AND cp IS NOT NULL AND cp <> lp AS price_off, auction,
    coalesce(nb, 0) > 0 AND b.k % 11 = 0 AS f_bids, coalesce(ns, 0) > 0 AND b.k % 7 = 0 AS f_ask_vwap, b.k % 9 = 0 AS f_trades, b.k % 5 = 0 AS f_volume
  FROM b LEFT JOIN cp USING (symbol) LEFT JOIN sides USING (symbol, k) WHERE b.k >= {start} AND b.k <> 51),
x AS (SELECT *, CASE WHEN NOT seen THEN '' ELSE array_to_string(list_filter([CASE WHEN f_ask_vwap THEN 'ask_vwap' END, CASE WHEN f_bids THEN 'bids' END, CASE WHEN price_off AND auction THEN 'last_price' END, CASE WHEN f_trades THEN 'trades' END, CASE WHEN f_volume THEN 'volume' END], lambda y: y IS NOT NULL), ',') END AS fields FROM w),
records AS (SELECT symbol, class, anchor, quote_ms, CASE WHEN NOT seen THEN 'missing_source' WHEN fields = '' THEN 'matched' ELSE 'mismatched' END AS outcome, CASE WHEN NOT seen THEN 'symbol_unseen' END AS reason, fields, CASE WHEN price_off AND NOT auction THEN 'etf_close_vwap' END AS tag, CAST({'far' if market == 'SZ' else 'CASE WHEN k = 52 THEN 0 END'} AS BIGINT) AS excluded_bid FROM x WHERE {where})
SELECT {'*' if not summary else "CAST(0 AS BIGINT) AS after_close, count(*) AS total, count(*) AS comparable, count(*) FILTER (outcome = 'matched') AS matched, count(*) FILTER (outcome = 'mismatched') AS mismatched, CAST(0 AS BIGINT) AS data_error, CAST(0 AS BIGINT) AS missing_source, count(*) FILTER (outcome = 'matched') / count(*) AS match_rate, CASE WHEN count(*) = 0 THEN 'no_eligible' WHEN count(*) FILTER (outcome = 'mismatched') > 0 THEN 'failed' ELSE 'passed' END AS outcome, count(*) > 0 AND count(*) FILTER (outcome = 'mismatched') = 0 AS accepted"} FROM records"""


def _fault_sql(market: str) -> str:
    n = "(seq - 1) // 20"
    x = "n % 70 = 0" if market == "SH" else "false"
    stream = "'ticks'" if market == "SH" else "CASE WHEN kind = 'A' THEN 'orders' ELSE 'executions' END"
    codes = ["CASE WHEN n % 20 = 0 THEN 'quantity' END", "CASE WHEN n % 30 = 0 THEN 'time' END", "CASE WHEN n % 30 = 0 THEN 'local_time' END", "CASE WHEN n % 50 = 0 THEN 'symbol' END", f"CASE WHEN {x} THEN 'kind' END"]
    return f"SELECT '{market}' AS market, {stream} AS stream, unnest(list_filter([{', '.join(codes)}], lambda y: y IS NOT NULL)) AS code FROM (SELECT *, {n} AS n FROM f_{market})"


def oracle_sql():
    feeds = f"WITH {FEED_CTE}"
    sh = _cte("SH")
    both = f"""SELECT * FROM ({_cte('SH')}, f_SH AS (SELECT * FROM f) {_fault_sql('SH')}) UNION ALL SELECT * FROM ({_cte('SZ')}, f_SZ AS (SELECT * FROM f) {_fault_sql('SZ')})"""
    stocks = "symbol NOT LIKE '510%'"
    return {
        "replay_sz": _replay_sql("SZ"),
        "replay_sh": _replay_sql("SH"),
        "replay_counters": f"""{sh}, c AS (SELECT count(*) + count(DISTINCT symbol) AS input_rows, count(*) FILTER ({stocks}) AS applied, count(DISTINCT symbol) FILTER ({stocks}) AS symbols, count(DISTINCT channel) FILTER ({stocks}) AS channels, count(*) FILTER (NOT {stocks}) + count(DISTINCT symbol) FILTER (NOT {stocks}) AS unselected FROM f)
SELECT input_rows, CAST(0 AS BIGINT) AS repaired_streams, applied + symbols AS selected, CAST(0 AS BIGINT) AS unsupported, unselected, CAST(0 AS BIGINT) AS after_cutoff, channels, symbols, applied, symbols AS status_rows, CAST(0 AS BIGINT) AS same_second_regressions, CAST(0 AS BIGINT) AS direct_rest_limits, CAST(0 AS BIGINT) AS after_close_events,
  symbols * 51 AS scheduled, symbols AS market_close, symbols * 52 AS output_rows, CAST(0 AS BIGINT) AS pending_groups, CAST(0 AS BIGINT) AS inferred_remainders, CAST(0 AS BIGINT) AS empty_same_side_cancels, CAST(0 AS BIGINT) AS violations FROM c""",
        "validate_sz": _validate_sql("SZ", "true"),
        "validate_sh": _validate_sql("SH", "true"),
        "validate_preopen": _validate_sql("SZ", "anchor = 'pre_open'", upto=33_901_000),
        "validation_summary": _validate_sql("SH", "symbol IN ('600000', '510001', '601003', '688999')", summary=True),
        "vendor_faults": f"SELECT market, stream, code, count(*) AS rows FROM ({both}) GROUP BY ALL",
        "sh_faults": f"{sh} SELECT symbol, CASE kind WHEN 'A' THEN 'add_side' ELSE 'unknown_trade' END AS code, count(*) AS rows FROM f WHERE (kind = 'A' AND (seq - 1) // 20 % 40 = 0) OR (kind = 'T' AND (seq - 1) // 20 % 30 = 0) GROUP BY ALL",
        "vendor_amounts": f"""{sh}{core._TOUCH}{core._SIGNED}{_POINTS}{_AT},
aq AS (SELECT symbol, k, sum(q) AS q FROM n WHERE order_side = 'S' AND r <= 10 GROUP BY 1, 2)
SELECT b.symbol, count(*) AS frames, CAST(sum(coalesce(turnover, 0)) AS BIGINT) AS turnover, CAST(sum(coalesce(volume, 0) + CASE WHEN b.k % 5 = 0 THEN 100 ELSE 0 END) AS BIGINT) AS volume, max(last_price) AS last_price, count(*) FILTER (b.k % 13 = 0 AND (b.k % 2 = 0 OR b.k % 3 = 0)) AS missing, CAST(0 AS BIGINT) AS errors, CAST(sum(coalesce(aq.q, 0)) AS BIGINT) AS ask_quantity, CAST({MIDNIGHT} + 33900000 AS BIGINT) AS open_ms
FROM b LEFT JOIN s USING (symbol, k) LEFT JOIN aq USING (symbol, k) WHERE b.k BETWEEN 1 AND 51 GROUP BY b.symbol""",
        "explicit_universe": f"{_cte('SZ')} SELECT CASE WHEN symbol IN ('159001', '000004') THEN 'selected' ELSE 'unselected' END AS row_class, count(*) AS rows FROM f GROUP BY 1".replace("WITH " + FEED_CTE, feeds),
    }
