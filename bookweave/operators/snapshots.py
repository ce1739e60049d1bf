"""State at points of time: snapshot grids, as-of sampling without a range join, depth and closing snapshots.

A change at time q first shows at the first boundary after q, whose number is arithmetic. Changes are
summed per level and boundary, and each level's running total holds until its next change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.functions.scalars import day_epoch_ms, weighted_price
from bookweave.operators.book import best_order, depth
from bookweave.schema import BOOK, LEVEL
from bookweave.shared import written

#: Milliseconds since midnight of the exchange's two sessions; a grid starts after each one's start.
SESSIONS = ((33_300_000, 41_400_000), (46_800_000, 54_000_000))


def session_start(day: Column, session: int) -> Column:
    return day_epoch_ms(day) - 28_800_000 + SESSIONS[session][0]


def boundary_count(step_ms: int, sessions=SESSIONS) -> list[int]:
    return [(e - s) // step_ms for s, e in sessions]


def boundary_time(k: Column, origin: Column, step_ms: int, sessions=SESSIONS) -> Column:
    """Time of boundary k (from 1) of a grid; origin: the day's midnight in epoch milliseconds."""
    counts, c, before = boundary_count(step_ms, sessions), None, 0
    for (start, _), n in zip(sessions, counts, strict=True):
        t = origin + start + (k - before) * step_ms
        c = F.when((k > before) & (k <= before + n), t) if c is None else c.when((k > before) & (k <= before + n), t)
        before += n
    return c


def first_boundary(ms: Column, origin: Column, step_ms: int, sessions=SESSIONS) -> Column:
    """Number of the first boundary strictly after a time; null after the last."""
    counts, q, before, c = boundary_count(step_ms, sessions), ms - origin, 0, None
    for (start, _), n in zip(sessions, counts, strict=True):
        k = F.when(q < start, 1).otherwise(F.floor((q - start) / step_ms) + 1)
        here = (q < start + n * step_ms)
        c = F.when(here, k + before) if c is None else c.when(here, k + before)
        before += n
    return c.cast("bigint")


def held_levels(changes: DataFrame, last_k: Column) -> DataFrame:
    """(book, order_side, price, k, to_k, quantity, order_count): a live level's totals from point k to point to_k.

    changes: deltas with k, the number of the point at which each first shows; last_k: the book's last point.
    """
    at = changes.filter("k IS NOT NULL").groupBy(*LEVEL, "k").agg(F.sum("dqty").alias("dqty"), F.sum("dcount").alias("dcount"), F.max(last_k).alias("last_k"))
    w = W.partitionBy(*LEVEL).orderBy("k")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    held = at.select(*LEVEL, "k", F.sum("dqty").over(upto).alias("quantity"), F.sum("dcount").over(upto).alias("order_count"), (F.coalesce(F.lead("k").over(w), F.col("last_k") + 1) - 1).alias("to_k"))
    return held.filter("order_count > 0 AND to_k >= k")


def best_states(changes: DataFrame, last_k: Column, n: int, run: int = 64) -> DataFrame:
    """(book, order_side, k, price, quantity, order_count, level) of the n best levels of a side at every point.

    Points are taken in runs. A level that n others beat all through a run is never among the best in it,
    so only the few others are laid out point by point.
    """
    part = F.floor(F.col("k") / run)
    held = held_levels(changes, last_k).withColumn("run", F.explode(F.sequence(part, F.floor(F.col("to_k") / run))))
    first, last = F.greatest(F.col("k"), F.col("run") * run), F.least(F.col("to_k"), F.col("run") * run + run - 1)
    of = held.select(*LEVEL, "run", F.struct(first.alias("k"), last.alias("to_k"), "quantity", "order_count").alias("x"))
    rows = of.groupBy(*LEVEL, "run").agg(F.sum(F.col("x.to_k") - F.col("x.k") + 1).alias("points"), F.collect_list("x").alias("held"))
    # a level's first and last run may be cut short by the grid's ends; it then only counts as not there all through
    better = W.partitionBy(*BOOK, "order_side", "run").orderBy(best_order(F.col("order_side"), F.col("price"))).rowsBetween(W.unboundedPreceding, -1)
    near = rows.withColumn("beaten", F.coalesce(F.count_if(F.col("points") == run).over(better), F.lit(0))).filter(F.col("beaten") < n)
    each = near.select(*LEVEL, F.explode("held").alias("x")).select(*LEVEL, F.explode(F.sequence("x.k", "x.to_k")).alias("k"), "x.quantity", "x.order_count")
    return depth(each, n, [*BOOK, "k"])


def grid_points(symbols: DataFrame, n: int) -> DataFrame:
    """(book, k) for every book and boundary; a book needs only one row of any kind to be there."""
    return symbols.select(*BOOK).distinct().withColumn("k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(n).cast("bigint"))))


def _zero(c) -> Column:
    return F.coalesce(c, F.lit(0))


def point_stats(events: DataFrame, changes: DataFrame, points: DataFrame, k: Column) -> DataFrame:
    """For each point: trade statistics, both sides' totals and averages, and times of the last event before it.

    k: number of the point at which an event first shows (over quote_ms, or seq for close snapshots).
    Everything is a running sum of what each point adds; no level is looked at.
    """
    shown = events.filter("kind <> 'S'").withColumn("k", k).filter("k IS NOT NULL")
    trade = F.col("kind") == "T"
    price, qty = F.when(trade, F.col("price")), F.when(trade, F.col("qty"))
    local = F.col("local_ms") if "local_ms" in events.columns else F.lit(None).cast("bigint")
    t = shown.groupBy(*BOOK, "k").agg(
        F.max_by(price, F.when(trade, F.col("seq"))).alias("p"), F.max(price).alias("h"), F.min(price).alias("l"), F.sum(qty).alias("q"),
        F.sum(price.cast("decimal(19,0)") * qty.cast("decimal(19,0)")).alias("m"), F.count(qty).alias("c"),
        F.max_by("quote_ms", "seq").alias("qt"), F.max_by(local, "seq").alias("lt"),
    )
    of = lambda s, c: F.sum(F.when(F.col("order_side") == s, c))
    money = F.col("price").cast("decimal(19,0)") * F.col("dqty").cast("decimal(19,0)")
    d = changes.withColumn("k", k).filter("k IS NOT NULL").groupBy(*BOOK, "k").agg(of("B", F.col("dqty")).alias("bq"), of("S", F.col("dqty")).alias("sq"), of("B", money).alias("bm"), of("S", money).alias("sm"))
    upto = W.partitionBy(*BOOK).orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    run = lambda c: _zero(F.sum(c).over(upto))
    big = lambda c: run(c).cast("decimal(38,0)")
    out = points.join(t, [*BOOK, "k"], "left").join(d, [*BOOK, "k"], "left").select(
        *points.columns, F.last("p", True).over(upto).alias("last_price"), F.max("h").over(upto).alias("high_price"), F.min("l").over(upto).alias("low_price"),
        run("q").alias("volume"), big("m").alias("turnover"), run("c").alias("trades"), run("bq").alias("bid_total"), run("sq").alias("ask_total"), big("bm").alias("bid_amount"), big("sm").alias("ask_amount"),
        F.last("qt", True).over(upto).alias("last_quote_ms"), F.last("lt", True).over(upto).alias("last_local_ms"),
    )
    return out.withColumns({"bid_vwap": weighted_price(F.col("bid_amount"), F.col("bid_total")), "ask_vwap": weighted_price(F.col("ask_amount"), F.col("ask_total"))})


LEVELS_TYPE = "array<struct<price:bigint,quantity:bigint,order_count:bigint>>"


def level_arrays(best: DataFrame, keys: list[str]) -> DataFrame:
    """keys with bids and asks, the levels of each side in order, from rows with order_side, level, price, quantity, order_count."""
    row = F.struct("level", "price", "quantity", "order_count")
    of = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("order_side") == s, row))), lambda x: F.struct(x["price"].alias("price"), x["quantity"].alias("quantity"), x["order_count"].alias("order_count")))
    return best.groupBy(*keys).agg(of("B").alias("bids"), of("S").alias("asks"))


def scheduled(events: DataFrame, changes: DataFrame, points: DataFrame, k: Column, last_k: Column, n: int = 10) -> DataFrame:
    """Snapshots: point_stats, and the n best levels of both sides as arrays. changes: visible ones, as deltas or placed_deltas give them."""
    books = level_arrays(best_states(changes.withColumn("k", k), last_k, n), [*BOOK, "k"])
    none = F.array().cast(LEVELS_TYPE)
    return point_stats(events, changes, points, k).join(books, [*BOOK, "k"], "left").withColumns({c: F.coalesce(c, none) for c in ("bids", "asks")})


def close_cut(events: DataFrame) -> DataFrame:
    """(book, cut_seq, boundary_ms), cut_seq being the last event that counts: SH closes at its first CLOSE row, by native order; SZ after all input, at 15:00 or its last quote if later."""
    is_close = (F.col("kind") == "S") & (F.col("status") == "CLOSE")
    sz_end = F.greatest(day_epoch_ms(F.col("trading_day")) - 28_800_000 + 54_000_000, F.max(F.when(F.col("kind") != "S", F.col("quote_ms"))))
    close = events.filter(is_close).groupBy(*BOOK).agg(F.min("seq").alias("__close"), F.min_by("quote_ms", "seq").alias("close_ms"))
    cut = events.join(close, BOOK, "left").groupBy(*BOOK).agg(
        F.min("__close").alias("close_seq"), F.min("close_ms").alias("close_ms"),
        F.max(F.when((F.col("kind") != "S") & (F.col("seq") < F.col("__close")), F.col("seq"))).alias("before_seq"), F.max("seq").alias("last_seq"), sz_end.alias("end_ms"),
    )
    sh = F.col("market") == "SH"
    return cut.select(*BOOK, F.when(sh, F.coalesce("before_seq", F.col("close_seq") - 1)).otherwise(F.col("last_seq")).alias("cut_seq"), F.when(sh, F.col("close_ms")).otherwise(F.col("end_ms")).alias("boundary_ms")).filter("cut_seq IS NOT NULL")


def close_snapshots(events: DataFrame, changes: DataFrame, n: int = 10, cut: DataFrame | None = None) -> DataFrame:
    """One closing snapshot per book that closes."""
    cut = written(close_cut(events), "cut") if cut is None else cut
    before = lambda df: df.join(cut.select(*BOOK, "cut_seq"), BOOK).filter("seq <= cut_seq")
    points = cut.select(*BOOK, F.lit(1).cast("bigint").alias("k"), "boundary_ms")
    one = F.lit(1).cast("bigint")
    k = F.when(F.col("seq").isNotNull(), one)  # not a plain literal: Spark 4.1 loses columns of windows ordered by one
    return scheduled(before(events), before(changes), points, k, one, n).drop("k")


def _grid(events: DataFrame, step_ms: int, sessions, origin: Column | None) -> tuple[DataFrame, Column, int]:
    origin = day_epoch_ms(F.col("trading_day")) - 28_800_000 if origin is None else origin
    last = sum(boundary_count(step_ms, sessions))
    points = grid_points(events, last).withColumn("boundary_ms", boundary_time(F.col("k"), origin, step_ms, sessions))
    return points, first_boundary(F.col("quote_ms"), origin, step_ms, sessions), last


def grid_stats(events: DataFrame, changes: DataFrame, step_ms: int, sessions=SESSIONS, origin: Column | None = None) -> DataFrame:
    """point_stats of every book at every boundary of the grid, with boundary_ms."""
    points, k, _ = _grid(events, step_ms, sessions, origin)
    return point_stats(events, changes, points, k)


def grid_depth(events: DataFrame, changes: DataFrame, step_ms: int, n: int = 10, sessions=SESSIONS, origin: Column | None = None) -> DataFrame:
    """(book, boundary_ms, k, order_side, level, price, quantity, order_count) of the n best levels at every boundary of the grid."""
    points, k, last = _grid(events, step_ms, sessions, origin)
    origin = day_epoch_ms(F.col("trading_day")) - 28_800_000 if origin is None else origin
    return best_states(changes.withColumn("k", k), F.lit(last).cast("bigint"), n).withColumn("boundary_ms", boundary_time(F.col("k"), origin, step_ms, sessions))


def grid_snapshots(events: DataFrame, changes: DataFrame, step_ms: int, n: int = 10, sessions=SESSIONS, origin: Column | None = None) -> DataFrame:
    """Snapshots of every book at every boundary of the grid, with boundary_ms; states are those strictly before it."""
    points, k, last = _grid(events, step_ms, sessions, origin)
    return scheduled(events, changes, points, k, F.lit(last).cast("bigint"), n)
