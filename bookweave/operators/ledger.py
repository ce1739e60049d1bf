"""Order ledger: executions and cancels joined with the orders they name, and what each order has left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.schema import BOOK, ORDER


def references(events: DataFrame) -> DataFrame:
    """One row per event and order it names: order_side, order_no, sub_seq (bid before ask). A number of 0 or null names none."""
    bid = F.col("sub_seq") == 0
    rows = events.filter(F.col("kind") != "S").select(*BOOK, "channel", "seq", "kind", "ord_type", "side", "price", "qty", "quote_ms", "bid_no", "ask_no", F.explode(F.array(F.lit(0), F.lit(1))).alias("sub_seq"))
    named = rows.withColumns({"order_side": F.when(bid, "B").otherwise("S"), "order_no": F.when(bid, F.col("bid_no")).otherwise(F.col("ask_no"))})
    return named.filter(F.coalesce("order_no", F.lit(0)) != 0).drop("bid_no", "ask_no")


def ledger(events: DataFrame) -> DataFrame:
    """references with the order's own price and size, what was left before and after, and how the reference resolves.

    ref_status: `add`; `active`; `inactive` (filled or cancelled before), `unknown` (no earlier add), or
    `duplicate` (an add of a key already seen). A cancel removes the whole remainder. All windows are over
    one order, so one shuffle serves them, and a busy symbol is many tasks' work.
    """
    seen = W.partitionBy(*reversed(ORDER)).orderBy("seq", "sub_seq")  # the number first: it alone tells most rows apart when they are sorted
    earlier, upto = seen.rowsBetween(W.unboundedPreceding, -1), seen.rowsBetween(W.unboundedPreceding, 0)
    add = F.col("kind") == "A"
    of_add = lambda c: F.first(F.when(add, F.col(c)), ignorenulls=True).over(upto)
    known = F.col("nth_add") > 0
    # columns of one window together, so that each is one pass
    rows = references(events).withColumns({"nth_add": F.count_if(add).over(upto), "order_price": of_add("price"), "order_qty": of_add("qty"), "add_seq": of_add("seq")}).withColumns({
        "traded": F.coalesce(F.sum(F.when((F.col("kind") == "T") & known, F.col("qty"))).over(earlier), F.lit(0)),
        "cancelled": F.coalesce(F.max(F.when((F.col("kind") == "C") & known, 1)).over(earlier), F.lit(0)) == 1,
    })
    before = F.when(F.col("cancelled") | add, 0).otherwise(F.greatest(F.col("order_qty") - F.col("traded"), F.lit(0)))
    status = (
        F.when(add & (F.col("nth_add") > 1), "duplicate").when(add, "add").when(F.col("nth_add") == 0, "unknown")
        .when(F.col("remaining_before") > 0, "active").otherwise("inactive")
    )
    after = F.when(F.col("ref_status") == "add", F.col("qty")).when(F.col("ref_status") != "active", F.col("remaining_before")).when(F.col("kind") == "C", 0).otherwise(F.greatest(F.col("remaining_before") - F.col("qty"), F.lit(0)))
    return (
        rows.withColumn("remaining_before", F.coalesce(before, F.lit(0)).cast("bigint"))
        .withColumn("ref_status", status).withColumn("remaining_after", after.cast("bigint"))
        .select(*BOOK, "channel", "seq", "sub_seq", "kind", "ord_type", "side", "order_side", "order_no", "price", "qty", "quote_ms", "order_price", "order_qty", "add_seq", "remaining_before", "remaining_after", "ref_status")
    )


def order_state(led: DataFrame) -> DataFrame:
    """Each order's price, size, remainder and last event after all rows of a ledger."""
    own = led.filter(F.col("ref_status").isin("add", "active"))
    return own.groupBy(*ORDER).agg(
        F.min("order_price").alias("price"), F.min("order_qty").alias("order_qty"), F.min("add_seq").alias("add_seq"),
        F.max_by("remaining_after", "seq").alias("remaining"), F.max("seq").alias("last_seq"),
    )


def active_orders(led: DataFrame, placed: DataFrame | None = None) -> DataFrame:
    """Orders with something left: price, size, remainder, and the event with which each took its place (attach_seq, attach_sub).

    With placed (placements of the same events), an order without a price of its own is visible and has a
    price once it rests, and takes its place then.
    """
    live = order_state(led).filter("remaining > 0")
    if placed is None:
        return live.withColumns({"attach_seq": F.col("add_seq"), "attach_sub": F.lit(0)})
    at = placed.filter("what = 'placement'").select(*ORDER, "rest_seq", F.col("sub_seq").alias("rest_sub"), F.col("price").alias("rest_price"))
    own = led.filter("kind = 'A' AND ref_status = 'add'").select(*ORDER, F.coalesce("ord_type", F.lit("limit")).alias("ord_type"))
    limit = F.col("ord_type") == "limit"
    out = live.join(own, ORDER, "left").join(at, ORDER, "left").withColumns({
        "visible": limit | F.col("rest_seq").isNotNull(), "price": F.when(limit, F.col("price")).otherwise(F.col("rest_price")),
        "attach_seq": F.when(limit, F.col("add_seq")).otherwise(F.col("rest_seq")), "attach_sub": F.coalesce("rest_sub", F.lit(0)),
    })
    return out.drop("rest_seq", "rest_sub", "rest_price")


def _lenient(market_policy: dict[str, str] | None) -> Column:
    policy = market_policy or {"SH": "update_known_and_statistics", "SZ": "reject"}
    return F.col("market").isin(*[m for m, p in policy.items() if p == "update_known_and_statistics"])


def broken_references(led: DataFrame, market_policy: dict[str, str] | None = None) -> DataFrame:
    """Rows (book, channel, seq, code) of a ledger's references that break their market's rules; an event that names no order has none. Codes: see reference_violations."""
    gone = F.col("ref_status").isin("unknown", "inactive")
    aggressor = F.coalesce(F.col("side") == F.col("order_side"), F.lit(False))
    trade, cancel = F.col("kind") == "T", F.col("kind") == "C"
    code = (
        F.when(F.col("ref_status") == "duplicate", "duplicate_add")
        .when(cancel & gone, "unknown_cancel")
        .when(cancel & (F.col("market") == "SZ") & (F.col("qty") != F.col("remaining_before")), "cancel_quantity")
        .when(trade & gone & ~(_lenient(market_policy) & aggressor), "unknown_trade")
        .when(trade & (F.col("ref_status") == "active") & (F.col("qty") > F.col("remaining_before")), "overfill")
    )
    return led.withColumn("code", code).filter("code IS NOT NULL").select(*BOOK, "channel", "seq", "code")


def reference_violations(events: DataFrame, led: DataFrame, market_policy: dict[str, str] | None = None) -> DataFrame:
    """Rows (book, channel, seq, code) where a reference, or an event by what it names, breaks its market's rules.

    Codes: duplicate_add, unknown_cancel, cancel_quantity (SZ: must equal the remainder), cancel_sides (not
    exactly one order named), overfill, unknown_trade, add_side (SH: flag and side differ). A market whose
    policy is `update_known_and_statistics` (SH) lets a trade name an unknown order on the aggressor's
    side, or none there; `reject` (SZ) lets none be unknown.
    """
    no = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
    passive_missing = (no("bid_no") & (F.coalesce(F.col("side"), F.lit("N")) != "B")) | (no("ask_no") & (F.coalesce(F.col("side"), F.lit("N")) != "S"))
    own = (
        F.when((F.col("kind") == "C") & (no("bid_no") == no("ask_no")), "cancel_sides")
        .when((F.col("kind") == "T") & _lenient(market_policy) & passive_missing, "unknown_trade")
        .when((F.col("kind") == "A") & (F.col("market") == "SH") & F.col("flag").isNotNull() & (F.col("flag") != F.col("side")), "add_side")
    )
    by_event = events.withColumn("code", own).filter("code IS NOT NULL").select(*BOOK, "channel", "seq", "code")
    return broken_references(led, market_policy).unionByName(by_event)


def first_violations(violations: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The first violation by (channel, seq) of each book, or of other keys (none: of the run)."""
    first = F.min(F.struct("channel", "seq", "code")).alias("v")
    return violations.groupBy(*(BOOK if keys is None else keys)).agg(first).select(*(BOOK if keys is None else keys), "v.*")
