"""The book as a sum of signed changes: levels, sides, statistics, best prices, depth and queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.operators.slices import Running, running
from bookweave.schema import BOOK, LEVEL


def deltas(led: DataFrame, hidden: DataFrame | None = None) -> DataFrame:
    """Visible changes (book, order_side, price, order_no, seq, sub_seq, quote_ms, dqty, dcount) of a ledger.

    hidden: orders (book, order_side, order_no) that never show; they simply make no changes.
    """
    add = F.col("ref_status") == "add"
    out = led.filter(F.col("ref_status").isin("add", "active")).select(
        *BOOK, "order_side", F.col("order_price").alias("price"), "order_no", "seq", "sub_seq", "quote_ms",
        (F.col("remaining_after") - F.when(add, 0).otherwise(F.col("remaining_before"))).cast("bigint").alias("dqty"),
        F.when(add, 1).when(F.col("remaining_after") == 0, -1).otherwise(0).cast("bigint").alias("dcount"),
    )
    return out if hidden is None else out.join(hidden, [*BOOK, "order_side", "order_no"], "left_anti")


def level_totals(changes: DataFrame) -> DataFrame:
    """Quantity and orders of each live level after all changes."""
    return changes.groupBy(*LEVEL).agg(F.sum("dqty").alias("quantity"), F.sum("dcount").alias("order_count")).filter("order_count > 0")


def side_totals(changes: DataFrame) -> DataFrame:
    """Quantity, orders and sum of price times quantity of each side after all changes."""
    money = F.sum(F.col("price").cast("decimal(19,0)") * F.col("dqty").cast("decimal(19,0)"))
    return changes.groupBy(*BOOK, "order_side").agg(F.sum("dqty").alias("quantity"), F.sum("dcount").alias("order_count"), money.alias("amount"))


def best_order(side: Column, price: Column) -> Column:
    """Sorts bids from the highest, asks from the lowest."""
    return F.when(side == "B", -price).otherwise(price)


def best_levels(levels: DataFrame, keys: list[str] = BOOK) -> DataFrame:
    """Best bid and ask of each book."""
    of = lambda s, f: f(F.when(F.col("order_side") == s, F.col("price")))
    return levels.groupBy(*keys).agg(of("B", F.max).alias("best_bid"), of("S", F.min).alias("best_ask"))


def depth(levels: DataFrame, n: int = 10, keys: list[str] = BOOK) -> DataFrame:
    """The n best levels of each side, numbered from 1."""
    best = W.partitionBy(*keys, "order_side").orderBy(best_order(F.col("order_side"), F.col("price")))
    return levels.withColumn("level", F.row_number().over(best)).filter(F.col("level") <= n)


def fifo_queue(active: DataFrame) -> DataFrame:
    """Place of each active order in its level's queue, and the quantity ahead of it. One that came to rest later than it was entered stands where it came; hidden ones are in no queue."""
    if "visible" in active.columns:
        active = active.filter("visible")
    queue = W.partitionBy(*LEVEL).orderBy("attach_seq", "attach_sub", "order_no")
    ahead = F.coalesce(F.sum("remaining").over(queue.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return active.withColumn("position", F.row_number().over(queue)).withColumn("quantity_ahead", ahead)


def turnover() -> Column:
    return F.sum(F.col("price").cast("decimal(19,0)") * F.col("qty").cast("decimal(19,0)"))


def trade_stats(events: DataFrame, keys: list[str] = BOOK) -> DataFrame:
    """Last, high and low price, volume, turnover and number of trades. Trades count whether or not their orders are known."""
    return events.filter("kind = 'T'").groupBy(*keys).agg(
        F.max_by("price", "seq").alias("last_price"), F.max("price").alias("high_price"), F.min("price").alias("low_price"),
        F.sum("qty").alias("volume"), turnover().alias("turnover"), F.count("*").alias("trades"),
    )


def trade_values() -> dict[str, Running]:
    """Running trade statistics, from price and qty of trades alone (t_price and t_qty)."""
    price, qty = F.col("t_price"), F.col("t_qty")
    money = price.cast("decimal(19,0)") * qty.cast("decimal(19,0)")
    return {
        "last_price": Running("last", price), "high_price": Running("max", price), "low_price": Running("min", price),
        "volume": Running("sum", qty), "turnover": Running("sum", money), "trades": Running("count", qty),
    }


def of_trades(events: DataFrame) -> DataFrame:
    """events with t_price and t_qty, null but for trades."""
    return events.withColumns({f"t_{c}": F.when(F.col("kind") == "T", F.col(c)) for c in ("price", "qty")})


def zero_totals(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"volume": F.coalesce("volume", F.lit(0)), "turnover": F.coalesce("turnover", F.lit(0).cast("decimal(38,0)"))})


def running_stats(events: DataFrame) -> DataFrame:
    """Trade statistics of a book after each of its business events; before its first trade prices are null and totals zero. Read twice."""
    rows = of_trades(events.filter("kind <> 'S'")).select(*BOOK, "seq", "quote_ms", "t_price", "t_qty")
    return zero_totals(running(rows, BOOK, "seq", trade_values())).drop("t_price", "t_qty")


def apply_sequence(events: DataFrame) -> DataFrame:
    """events that are applied, numbered 1..n in each book. Read twice."""
    out = running(events.filter("kind <> 'S'"), BOOK, "seq", {"apply_seq": Running("count", F.lit(1))})
    return out.withColumn("apply_seq", F.col("apply_seq").cast("int"))


def book_summary(events: DataFrame, led: DataFrame) -> DataFrame:
    """One row per book: last sequence and time, events applied, best prices, active orders and trade statistics."""
    last = events.filter("kind <> 'S'").groupBy(*BOOK).agg(F.max("seq").alias("last_seq"), F.count("*").alias("applied"), F.max_by("quote_ms", "seq").alias("last_quote_ms"))
    active = active_counts(led)
    return (
        last.join(active, BOOK, "left").join(best_levels(level_totals(deltas(led))), BOOK, "left").join(trade_stats(events), BOOK, "left")
        .fillna(0, ["active_orders", "volume", "trades"])
    )


def active_counts(led: DataFrame) -> DataFrame:
    """Active orders of each book: adds less those filled or cancelled."""
    end = (F.col("ref_status") == "active") & (F.col("remaining_after") == 0)
    return led.groupBy(*BOOK).agg(F.sum(F.when(F.col("ref_status") == "add", 1).when(end, -1).otherwise(0)).alias("active_orders"))


def invariant_breaks(orders: DataFrame, levels: DataFrame, sides: DataFrame) -> DataFrame:
    """Rows (book, order_side, price, rule) where the book disagrees with itself; none if all is well.

    Rules: remaining (an active order's remainder is in (0, size]), level (a level's totals are those of
    its orders), side (a side's totals are those of its levels). orders: active ones.
    """
    wrong = orders.filter("remaining <= 0 OR remaining > order_qty").select(*LEVEL, F.lit("remaining").alias("rule"))
    mine = orders.groupBy(*LEVEL).agg(F.sum("remaining").alias("q"), F.count("*").alias("n"))
    level = levels.join(mine, LEVEL, "full").filter("NOT (quantity <=> q AND order_count <=> n)").select(*LEVEL, F.lit("level").alias("rule"))
    total = levels.groupBy(*BOOK, "order_side").agg(F.sum("quantity").alias("q"), F.sum("order_count").alias("n"))
    side = sides.join(total, [*BOOK, "order_side"], "full").filter("NOT (quantity <=> coalesce(q, 0) AND order_count <=> coalesce(n, 0))").select(*BOOK, "order_side", F.lit(None).cast("bigint").alias("price"), F.lit("side").alias("rule"))
    return wrong.unionByName(level).unionByName(side)
