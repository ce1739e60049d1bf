"""Rebuilt states against published frames: candidates in a time window, comparison, choice, and outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.functions.scalars import close_band, in_class, quantum, symbol_class, time_of_day, turnover_compat, weighted_match, weighted_price_q
from bookweave.operators.book import depth, of_trades, trade_values, turnover, zero_totals
from bookweave.operators.slices import TIMES, Running, running
from bookweave.operators.snapshots import LEVELS_TYPE, best_states, level_arrays
from bookweave.schema import BOOK
from bookweave.shared import written

EXACT = ["last_price", "high_price", "low_price", "volume", "turnover", "trades", "bid_total", "ask_total"]
WEIGHTED = ["bid_vwap", "ask_vwap"]
BOOKS = ["bids", "asks"]
FIELDS = [*EXACT, *WEIGHTED, *BOOKS]
CLOSE_AUCTION = (53_820_000, 54_000_000)  # 14:57 and 15:00


def look_back() -> Column:
    """Milliseconds before a frame's time at which its window opens."""
    return F.when(F.col("market") == "SH", 1000).otherwise(0)


def look_ahead() -> Column:
    m, s = F.col("market"), F.col("symbol")
    return F.when((m == "SZ") & in_class(m, s, "etf"), 1100).when((m == "SZ") & in_class(m, s, "chinext"), 3000).otherwise(1000)


#: How far a window may be set to look back and ahead.
LIMITS_MS = (1000, 3000)


def with_window(frames: DataFrame, back_ms: int | None = None, ahead_ms: int | None = None, limit_ms: tuple[int, int] = LIMITS_MS) -> DataFrame:
    """frames with win_from, win_to (exclusive) and whether a default was overridden (a diagnostic run). Pre-open windows are one second from the frame on."""
    if back_ms is not None and not 0 <= back_ms <= limit_ms[0] or ahead_ms is not None and not 1 <= ahead_ms <= limit_ms[1]:
        raise ValueError(f"a window looks back at most {limit_ms[0]} and ahead 1 to {limit_ms[1]} milliseconds")
    back, ahead = look_back() if back_ms is None else F.lit(back_ms), look_ahead() if ahead_ms is None else F.lit(ahead_ms)
    pre = F.col("anchor") == "pre_open" if "anchor" in frames.columns else F.lit(False)
    return frames.withColumns({
        "win_from": F.col("quote_ms") - F.when(pre, 0).otherwise(back), "win_to": F.col("quote_ms") + F.when(pre, 1000).otherwise(ahead),
        "diagnostic": F.lit(back_ms is not None or ahead_ms is not None),
    })


def price_quantum() -> Column:
    """The quantum of a row's market and symbol."""
    return quantum(F.col("market"), symbol_class(F.col("market"), F.col("symbol")))


def states(events: DataFrame, changes: DataFrame) -> DataFrame:
    """The ten scalar fields of a book after each of its events (seq), with quote_ms, the latest time before (high_ms), the event before (prev_seq) and apply_seq.

    changes: visible ones, as deltas or placed_deltas give them. Sides' averages are rounded once, to the
    quantum at which the exchange publishes them.
    """
    side = lambda s, c: F.sum(F.when(F.col("order_side") == s, c).otherwise(0))
    money = F.col("price").cast("decimal(19,0)") * F.col("dqty").cast("decimal(19,0)")
    moved = changes.groupBy(*BOOK, "seq").agg(side("B", F.col("dqty")).alias("bq"), side("S", F.col("dqty")).alias("sq"), side("B", money).alias("bm"), side("S", money).alias("sm"))
    rows = of_trades(events.filter("kind <> 'S'")).select(*BOOK, "seq", "quote_ms", "t_price", "t_qty").join(moved, [*BOOK, "seq"], "left")
    sums = {n: Running("sum", F.coalesce(F.col(c), F.lit(0))) for c, n in (("bq", "bid_total"), ("sq", "ask_total"), ("bm", "__bm"), ("sm", "__sm"))}
    out = running(written(rows, "moved"), BOOK, "seq", {"high_ms": Running("max", F.col("quote_ms"), before=True), "prev_seq": Running("last", F.col("seq"), before=True), "apply_seq": Running("count", F.lit(1)), **trade_values(), **sums})
    out = zero_totals(out).withColumn("apply_seq", F.col("apply_seq").cast("int"))
    q = F.col("__q")
    out = out.withColumn("__q", price_quantum())
    return out.withColumns({"bid_vwap": weighted_price_q(F.col("__bm"), F.col("bid_total"), q), "ask_vwap": weighted_price_q(F.col("__sm"), F.col("ask_total"), q)}).drop("__bm", "__sm", "__q", "t_price", "t_qty", "bq", "sq", "bm", "sm")


def candidates(frames: DataFrame, points: DataFrame, width_ms: int = 1000) -> DataFrame:
    """(frame_id, seq, at_ms): the states each frame may be compared with; seq null is the empty book before any event.

    frames: frame_id, book, win_from, win_to. points: states. A state counts if it is the one on entering
    the window or follows an event inside it, up to the first event at or after the window's end; then the
    state before that event is looked at once more, as of a millisecond before the end. Equal states keep
    their earliest time. An equi-join on the book and cells of `width_ms`, then the exact range. Points that lack prev_seq are numbered here.
    """
    p = points.select(*BOOK, "seq", "quote_ms", "high_ms", *(["prev_seq"] if "prev_seq" in points.columns else []))
    if "prev_seq" not in points.columns:
        p = running(p, BOOK, "seq", {"prev_seq": Running("last", F.col("seq"), before=True)})
    cell = lambda c: F.floor(c / width_ms)
    f = frames.select("frame_id", *BOOK, "win_from", "win_to", F.explode(F.sequence(cell(F.col("win_from")), cell(F.col("win_to") - 1))).alias("cell"))
    inside = f.join(p.withColumn("cell", cell(F.col("quote_ms"))), [*BOOK, "cell"]).filter(
        (F.col("quote_ms") >= F.col("win_from")) & (F.col("quote_ms") < F.col("win_to")) & (F.coalesce(F.col("high_ms"), F.col("win_to") - 1) < F.col("win_to")))
    both = inside.select("frame_id", F.explode(F.array(F.struct(F.col("prev_seq").alias("seq"), F.lit(0).alias("o")), F.struct("seq", F.lit(1).alias("o")))).alias("x"), F.col("quote_ms").alias("at_ms"))
    # the exit: the last state whose running latest time is below the window's end, found by order, not by range
    marks = points.select(*BOOK, F.greatest("quote_ms", "high_ms").alias("t"), F.lit(0).alias("is_frame"), F.lit(None).cast(frames.schema["frame_id"].dataType).alias("frame_id"), "seq")
    ends = frames.select(*BOOK, (F.col("win_to") - 1).alias("t"), F.lit(1).alias("is_frame"), "frame_id", F.lit(None).cast("bigint").alias("seq"))
    order = running(marks.unionByName(ends), BOOK, "t", {"upto": Running("max", F.col("seq"))}, ["is_frame", "seq"], TIMES)
    exits = order.filter("is_frame = 1").select("frame_id", F.col("upto").alias("seq"), F.col("t").alias("at_ms"))
    all_ = both.select("frame_id", "x.seq", "at_ms").unionByName(exits)
    return all_.groupBy("frame_id", "seq").agg(F.min("at_ms").alias("at_ms"))


def differing(pairs: DataFrame, fields: list[str] = FIELDS) -> Column:
    """Array of (field, expected, actual) of the fields in which e_<field> and <field> differ.

    Averages may be ten units apart. Where a frame's reception fields are missing (e_missing_reception),
    a turnover may be published with twelve digits.
    """
    missing = F.coalesce("e_missing_reception", F.lit(False)) if "e_missing_reception" in pairs.columns else F.lit(False)

    def same(f: str) -> Column:
        if f == "turnover":
            return F.coalesce(turnover_compat(missing, F.col(f"e_{f}"), F.col(f)), F.lit(False))
        return weighted_match(F.col(f"e_{f}"), F.col(f)) if f in WEIGHTED else F.col(f"e_{f}").eqNullSafe(F.col(f))

    shown = lambda c, f: F.to_json(F.col(c)) if f in BOOKS else F.col(c).cast("string")
    return F.filter(F.array(*(F.when(~same(f), F.struct(F.lit(f).alias("field"), shown(f"e_{f}", f).alias("expected"), shown(f, f).alias("actual"))) for f in fields)), lambda x: x.isNotNull())


def depth_at(changes: DataFrame, points: DataFrame, n: int = 10) -> DataFrame:
    """points (book, seq) with the n best levels of each side as bids and asks, after all changes up to seq. Both are read more than once.

    Changes and points are put in one order per book and each change is numbered by the first point that
    sees it; from there on points are those of a grid, taken in runs. There is no range join.
    """
    wanted = points.select(*BOOK, "seq").filter("seq IS NOT NULL").distinct()
    columns = [*BOOK, "seq", "order_side", "price", "dqty", "dcount"]
    mixed = changes.select(*columns, F.lit(0).alias("is_point")).unionByName(wanted.select(*BOOK, "seq", F.lit(1).alias("is_point")), allowMissingColumns=True)
    numbered = running(mixed, BOOK, "seq", {"k": Running("sum", F.col("is_point"), before=True)}, ["is_point"]).withColumn("k", F.coalesce("k", F.lit(0)) + 1)
    last = wanted.groupBy(*BOOK).agg(F.count("*").alias("last_k"))
    best = best_states(numbered.filter("is_point = 0").join(last, BOOK).filter("k <= last_k"), F.col("last_k"), n)
    none = F.array().cast(LEVELS_TYPE)
    at = numbered.filter("is_point = 1").select(*BOOK, "seq", "k").join(level_arrays(best, [*BOOK, "k"]), [*BOOK, "k"], "left")
    return at.select(*BOOK, "seq", F.coalesce("bids", none).alias("bids"), F.coalesce("asks", none).alias("asks"))


def _expected(frames: DataFrame) -> DataFrame:
    return frames.select("frame_id", *BOOK, *(F.col(f).alias(f"e_{f}") for f in [*FIELDS, "missing_reception"] if f in frames.columns))


SCALARS = [*EXACT, *WEIGHTED]
#: Scalars that a book without events or trades has; the others are null.
ZERO = ["volume", "turnover", "trades", "bid_total", "ask_total"]


def best_match(frames: DataFrame, found: DataFrame, points: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """Each frame with its outcome: the first state that matches in all fields, else the one with fewest differing fields, the earliest of those.

    frames: frame_id, book and the fields; found: candidates; points: states. With changes, depth is
    compared too, but only for states whose scalars differ no more than the frame's best.
    """
    pairs = _expected(frames).join(found, "frame_id").join(points.select(*BOOK, "seq", "apply_seq", *SCALARS), [*BOOK, "seq"], "left")
    pairs = pairs.withColumns({f: F.coalesce(F.col(f), F.lit(0)) for f in ZERO})
    pairs = pairs.withColumn("fields", differing(pairs, SCALARS)).withColumn("n", F.size("fields"))
    if changes is not None:
        least = F.min("n").over(W.partitionBy("frame_id"))
        pairs = written(pairs.withColumn("__least", least).filter("n <= __least + 2"), "pairs")
        none = F.array().cast(LEVELS_TYPE)
        pairs = pairs.join(depth_at(changes, pairs), [*BOOK, "seq"], "left").withColumns({f: F.coalesce(f, none) for f in BOOKS})
        pairs = pairs.withColumn("fields", F.concat("fields", differing(pairs, BOOKS))).withColumn("n", F.size("fields"))
    order = W.partitionBy("frame_id").orderBy((F.col("n") > 0), F.when(F.col("n") > 0, F.col("n")), "at_ms", "seq")
    return pairs.withColumn("nth", F.row_number().over(order)).filter("nth = 1").select("frame_id", *BOOK, "seq", "apply_seq", "at_ms", (F.col("n") == 0).alias("matched"), "fields")


def closing_match(frames: DataFrame, cut: DataFrame, points: DataFrame, changes: DataFrame, events: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """Each market_close frame against its book's closing state alone, with the exchange's closing rules.

    cut: close_cut. Of Shenzhen stocks without an upper limit (limits: day_limits) only levels in the band
    round the last trade before 14:57 count, with totals and averages of their own; excluded tells what
    was left out. A last price that alone differs may be explained by the closing average or the previous
    close (tag). error: `limits` (none, in conflict or invalid) or `no_range_base`.
    """
    sz_stock = (F.col("market") == "SZ") & in_class(F.col("market"), F.col("symbol"), "stock")
    base = closing_auction(events).join(closing_vwap(events, price_quantum()).select(*BOOK, "close_price"), BOOK, "left")
    books = cut.select(*BOOK, "cut_seq", "boundary_ms").join(base, BOOK, "left")
    if limits is not None:
        books = books.join(limits.select(*BOOK, F.col("kind").alias("limit_kind"), F.col("error").alias("limit_error")), BOOK, "left")
    else:
        books = books.withColumns({"limit_kind": F.lit(None).cast("string"), "limit_error": F.lit(None).cast("string")})
    unlimited = sz_stock & (F.col("limit_kind") == "unlimited")
    band = F.when(unlimited, close_band(F.col("base_price")))
    wrong = F.when(sz_stock & (F.col("limit_kind").isNull() | F.col("limit_error").isNotNull()), "limits").when(unlimited & band.isNull(), "no_range_base")
    books = books.withColumns({"band": band, "error": wrong})

    live = changes.join(books.select(*BOOK, "cut_seq", "band"), BOOK).filter("seq <= cut_seq").groupBy(*BOOK, "order_side", "price").agg(F.sum("dqty").alias("quantity"), F.sum("dcount").alias("order_count"), F.first("band").alias("band")).filter("order_count > 0")
    inside = F.col("band").isNull() | F.col("price").between(F.col("band.low"), F.col("band.high"))
    money = F.col("price").cast("decimal(19,0)") * F.col("quantity").cast("decimal(19,0)")
    of = lambda s, c, i=inside: F.coalesce(F.sum(F.when(i & (F.col("order_side") == s), c)), F.lit(0))
    sides = live.groupBy(*BOOK).agg(of("B", F.col("quantity")).alias("bid_total"), of("S", F.col("quantity")).alias("ask_total"), of("B", money).alias("bm"), of("S", money).alias("sm"), of("B", F.col("quantity"), ~inside).alias("excluded_bid"), of("S", F.col("quantity"), ~inside).alias("excluded_ask"))
    depths = level_arrays(depth(live.filter(inside), 10), BOOK)
    trades = [f for f in SCALARS if f not in ("bid_total", "ask_total", *WEIGHTED)]
    # the closing state's own row has the trade statistics
    stats = books.join(points.select(*BOOK, F.col("seq").alias("cut_seq"), "apply_seq", *trades), [*BOOK, "cut_seq"], "left")
    none = F.array().cast(LEVELS_TYPE)
    actual = stats.join(sides, BOOK, "left").join(depths, BOOK, "left").withColumns({**{f: F.coalesce(F.col(f), F.lit(0)) for f in ZERO}, **{f: F.coalesce(f, none) for f in BOOKS}})
    actual = actual.withColumns({"bid_vwap": weighted_price_q(F.col("bm"), F.col("bid_total"), price_quantum()), "ask_vwap": weighted_price_q(F.col("sm"), F.col("ask_total"), price_quantum())})
    previous = F.col("previous_close") if "previous_close" in frames.columns else F.lit(None).cast("bigint")
    pairs = _expected(frames).join(frames.select("frame_id", previous.alias("__previous")), "frame_id").join(actual, BOOK, "left")
    pairs = pairs.withColumn("fields", differing(pairs))
    only_last = (F.size("fields") == 1) & (F.get("fields", 0)["field"] == "last_price") & (F.col("market") == "SZ")
    tag = reconciled(only_last, symbol_class(F.col("market"), F.col("symbol")), F.coalesce("auction_trade", F.lit(False)), F.col("trades"), F.col("e_last_price"), F.col("close_price"), F.col("__previous"))
    pairs = pairs.withColumn("tag", tag).withColumn("fields", F.when(F.col("tag").isNotNull(), F.array().cast(pairs.schema["fields"].dataType)).otherwise(F.col("fields")))
    return pairs.select("frame_id", *BOOK, F.col("cut_seq").alias("seq"), "apply_seq", F.col("boundary_ms").alias("at_ms"), (F.size("fields") == 0).alias("matched"), "fields", "tag", "error", F.coalesce("excluded_bid", F.lit(0)).alias("excluded_bid"), F.coalesce("excluded_ask", F.lit(0)).alias("excluded_ask"))


def closing_vwap(events: DataFrame, q: Column, window_ms: int = 60_000) -> DataFrame:
    """Average price, rounded once to the quantum, of each book's trades in the minute up to and with its last one (both ends count)."""
    trades = events.filter("kind = 'T'")
    last = trades.groupBy(*BOOK).agg(F.max("quote_ms").alias("__last"))
    t = trades.join(last, BOOK).filter(F.col("quote_ms") >= F.col("__last") - window_ms)
    sums = t.groupBy(*BOOK).agg(turnover().alias("amount"), F.sum("qty").alias("quantity"))
    return sums.select(*BOOK, weighted_price_q(F.col("amount"), F.col("quantity"), q).alias("close_price"), "quantity")


def closing_auction(events: DataFrame) -> DataFrame:
    """Per book: whether it traded in the closing auction, and the last trade before it, the base of the closing range."""
    tod = time_of_day(F.col("quote_ms"))
    before = F.when(tod < CLOSE_AUCTION[0], F.col("seq"))
    return events.filter("kind = 'T'").groupBy(*BOOK).agg(
        F.coalesce(F.bool_or(tod.between(*CLOSE_AUCTION)), F.lit(False)).alias("auction_trade"), F.max_by("price", before).alias("base_price"), F.max_by("quote_ms", before).alias("base_ms"), F.max(before).alias("base_seq"),
    )


def reconciled(only_last: Column, kind: Column, auction: Column, trades: Column, expected: Column, vwap: Column, previous: Column) -> Column:
    """Tag of a closing frame that differs in its last price alone but is explained by the closing rule; null if it isn't."""
    stock = kind.isin("stock", "chinext")
    name = lambda what: F.when(stock, f"stock_{what}").otherwise(f"etf_{what}")
    by_vwap = F.when(F.coalesce(expected == vwap, F.lit(False)), name("close_vwap"))
    by_previous = F.when(F.coalesce(expected == previous, F.lit(False)), name("previous_close"))
    return F.when(only_last & ~auction, F.when(trades > 0, by_vwap).otherwise(by_previous))


def banded(levels: DataFrame, band: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Levels inside each book's closing band (low, high), and what was left out: quantity by side."""
    joined = levels.join(band, BOOK)
    inside = F.col("price").between(F.col("low"), F.col("high"))
    excluded = joined.filter(~inside).groupBy(*BOOK, "order_side").agg(F.sum("quantity").alias("excluded"))
    return joined.filter(inside).drop("low", "high"), excluded


def outcome(after_close: Column, load_error: Column, seen: Column, compare_error: Column, matched: Column) -> Column:
    """The first that applies: data_error, data_error, missing_source, data_error, matched, mismatched."""
    return F.when(after_close | load_error, "data_error").when(~seen, "missing_source").when(compare_error, "data_error").when(matched, "matched").otherwise("mismatched")


def failure_reason(after_close: Column, load_error: Column, seen: Column, compare_error: Column) -> Column:
    return F.when(after_close, "events_after_close").when(load_error, "load_error").when(~seen, "symbol_unseen").when(compare_error, "comparison_error")
