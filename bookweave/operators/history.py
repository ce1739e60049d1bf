"""State at any event: an order's place in its queue, and when a book first breaks a rule of its own.

Neither replays a book. A place is a count of what came before in the queue and still stood at that event, which is summed
over a tree of runs of places; rules are held against running sums after every event. Both run on slice by slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookweave.operators.slices import Running, running
from bookweave.schema import BOOK, LEVEL, ORDER
from bookweave.shared import written


def _runs(rows: DataFrame, wanted: Column) -> DataFrame:
    """rows (with place, and bits, those of the last place of their level) once for each depth of the tree at which wanted, over depth, names a run, and at depth -1 for their place itself."""
    each = rows.withColumn("depth", F.explode(F.sequence(F.lit(-1), F.col("bits") - 1)))
    return each.withColumn("run", F.when(F.col("depth") < 0, F.col("place")).otherwise(wanted)).filter("run IS NOT NULL")


def queue_at(changes: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (market, trading_day, symbol, order_side, order_no, at_seq) with the order's price, what it has left, its position in the queue and the quantity ahead, after all changes up to at_seq.

    changes: visible ones, as deltas or placed_deltas give them, written. Orders that do not stand in a level then are left out.

    Orders of a level are numbered as they came, and those before number n had all come when n did: they came with one running
    sum, and only what has gone of them by an event depends on it. They are one run for each bit of n, at most, of the runs of
    two, four, eight and so on; what goes counts in the runs its order is in, and a running sum of each run gives what had
    gone of it at any event. So work grows with what goes and what is asked times the logarithm of the longest queue, and no
    task has a whole level.
    """
    came = written(changes.filter("dcount = 1").select(*LEVEL, "order_no", "seq", "sub_seq", "dqty"), "came")
    # a level is a number from here on, by which runs are dealt and sorted
    levels = came.groupBy(*LEVEL).agg(F.count("*").alias("orders")).select(F.monotonically_increasing_id().alias("level"), *LEVEL, F.when(F.col("orders") > 1, F.length(F.bin(F.col("orders") - 1))).otherwise(0).alias("bits"))
    levels = written(levels, "levels")
    numbered = running(came.join(levels, LEVEL), ["level"], "seq", {"nth": Running("count", F.lit(1)), "size_before": Running("sum", F.col("dqty"), before=True)}, ["sub_seq", "order_no"])
    places = numbered.select("level", *ORDER, "bits", F.col("seq").alias("came_seq"), F.col("dqty").alias("size"), F.coalesce("size_before", F.lit(0)).alias("size_before"), (F.col("nth") - 1).alias("place"))
    places = written(places, "places")

    number = ["level", "place", "seq"]
    moved = changes.filter("dcount <> 1").join(levels.drop("bits"), LEVEL).select("level", "order_no", "seq", "dqty", "dcount").join(places.select("level", "order_no", "place", "bits"), ["level", "order_no"])
    wanted = asked.select(*ORDER, F.col("at_seq").alias("seq")).distinct().join(places, ORDER).filter("came_seq <= seq")
    wanted = written(wanted.select(*number, "order_no", "size", "size_before", "bits"), "wanted")
    # a run is asked for only if it is the left one of two
    run, zero = F.call_function("shiftright", F.col("place"), F.col("depth")), F.lit(0).cast("bigint")
    counted = _runs(moved.select(*number, "bits", "dqty", "dcount"), F.when(run % 2 == 0, run)).withColumn("place", F.lit(None).cast("bigint"))
    before = _runs(wanted.select(*number, "bits", zero.alias("dqty"), zero.alias("dcount")), F.when(run % 2 == 1, run - 1))
    both = written(counted.unionByName(before).drop("bits"), "runs")
    gone = running(both, ["level", "depth", "run"], "seq", {"quantity": Running("sum", F.col("dqty")), "count": Running("sum", F.col("dcount"))}, ["place"])

    mine = F.col("depth") < 0
    of = lambda c, where: F.coalesce(F.sum(F.when(where, F.col(c))), F.lit(0))
    left = gone.filter("place IS NOT NULL").groupBy(*number).agg(of("quantity", mine).alias("own"), of("quantity", ~mine).alias("quantity_gone"), of("count", ~mine).alias("orders_gone"))
    out = wanted.join(left, number).withColumn("remaining", F.col("size") + F.col("own")).filter("remaining > 0").join(levels, "level")
    return out.select(*ORDER, "price", F.col("seq").alias("at_seq"), "remaining", (F.col("place") + F.col("orders_gone") + 1).alias("position"), (F.col("size_before") + F.col("quantity_gone")).alias("quantity_ahead"))


def _first(rows: DataFrame, keys: list[str], wrong: Column, rule: str) -> DataFrame:
    price = F.col("price") if "price" in keys else F.lit(None).cast("bigint")
    found = rows.filter(wrong).groupBy(*keys).agg(F.min("seq").alias("first_seq"))
    return found.select(*BOOK, "order_side", price.alias("price"), F.lit(rule).alias("rule"), "first_seq")


def first_breaks(led: DataFrame, orders: DataFrame, levels: DataFrame, sides: DataFrame) -> DataFrame:
    """(book, order_side, price, rule, first_seq): the first event after which a level or side breaks a rule; none in a good book.

    led: a ledger; orders, levels and sides: the changes (as deltas) of the book's orders, of what its levels were told and
    of what its sides were told, written. In a good book the three are the same. Rules after every event: remaining (an order
    that stands has left more than nothing and no more than its size), empty (a level has orders exactly if it has a
    quantity), level (its totals are those of its orders), side (its totals and amount are those of its levels).
    """
    after = led.filter(F.col("ref_status").isin("add", "active"))
    size = (F.col("remaining_after") < 0) | (F.col("remaining_after") > F.col("order_qty"))
    remaining = _first(after.withColumn("price", F.col("order_price")), LEVEL, size, "remaining")

    # what an event does to a level or side counts as one, so that nothing is looked at half way
    at = lambda df, keys, sign: df.select(*keys, "seq", (F.col("dqty") * sign).alias("dq"), (F.col("dcount") * sign).alias("dc"), (F.col("price").cast("decimal(19,0)") * F.col("dqty") * sign).cast("decimal(38,0)").alias("dm"))

    def off(one: DataFrame, other: DataFrame | None, keys: list[str]) -> DataFrame:
        rows = at(one, keys, 1) if other is None else at(one, keys, 1).unionByName(at(other, keys, -1))
        each = written(rows.groupBy(*keys, "seq").agg(F.sum("dq").alias("dq"), F.sum("dc").alias("dc"), F.sum("dm").alias("dm")), "moved")
        return running(each, keys, "seq", {c[1]: Running("sum", F.col(c)) for c in ("dq", "dc", "dm")})

    empty = _first(off(levels, None, LEVEL), LEVEL, (F.col("q") < 0) | (F.col("c") < 0) | ((F.col("q") == 0) != (F.col("c") == 0)), "empty")
    level = _first(off(levels, orders, LEVEL), LEVEL, (F.col("q") != 0) | (F.col("c") != 0), "level")
    side_keys = [*BOOK, "order_side"]
    side = _first(off(sides, levels, side_keys), side_keys, (F.col("q") != 0) | (F.col("m") != 0), "side")
    return remaining.unionByName(empty).unionByName(level).unionByName(side)
