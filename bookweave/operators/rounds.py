"""Placements without a fold: guessed for all orders at once, looked up against the books that they give, until none moves.

Whether and where an order without a price of its own rests depends on the best prices of earlier events alone. So in each
round one more of a chain of orders that depend on one another is right for good, a guess that gives itself is the fold's
result, and the rounds are as many as the longest such chain, not as the orders. Every step is relational, so a book that
holds a third of all events is many tasks' work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.operators import ledger
from bookweave.operators.book import best_order, deltas
from bookweave.operators.placement import GROUP_LIMIT, POLICIES
from bookweave.operators.slices import Running, running
from bookweave.schema import BOOK, LEVEL, ORDER
from bookweave.shared import written

_TOLD = ["what", "order_side", "order_no", "rest_seq", "sub_seq", "price", "remaining", "code"]
#: Steps within an event, in the order in which they count: what it takes, then who comes to rest, bids first.
_STEPS = 4


#: Points that are taken together when the best prices are looked up.
_RUN = 64


def _of_side(side: str) -> Column:
    """An order's own or the other side's best price at a point."""
    mine = (F.col("order_side") == "B") == (side == "own")
    return F.when(mine, F.col("bid")).otherwise(F.col("ask"))


def _best_prices(moves: DataFrame, last: DataFrame) -> DataFrame:
    """(book, k, bid, ask): the best prices at each point k at which there are any.

    moves: LEVEL, k (the first point that sees it) and dcount; last: last_k of each book. A level counts by the stretches in
    which it has orders, whatever their number; in a run of points, one that a better level outlasts is not laid out.
    """
    at = moves.groupBy(*LEVEL, "k").agg(F.sum("dcount").alias("d")).filter("d <> 0")
    w = W.partitionBy(*LEVEL).orderBy("k")
    turns = at.withColumn("c", F.sum("d").over(w.rowsBetween(W.unboundedPreceding, 0))).filter("(c > 0) <> (c - d > 0)")
    live = turns.withColumn("next_k", F.lead("k").over(w)).filter("c > 0").join(last, BOOK).withColumn("to_k", F.coalesce(F.col("next_k") - 1, "last_k")).filter("to_k >= k")
    live = live.withColumn("run", F.explode(F.sequence(F.floor(F.col("k") / _RUN), F.floor(F.col("to_k") / _RUN))))
    first, end = F.greatest(F.col("k"), F.col("run") * _RUN), F.least(F.col("to_k"), F.col("run") * _RUN + _RUN - 1)
    order = best_order(F.col("order_side"), F.col("price"))
    each = live.select(*LEVEL, "run", first.alias("k"), end.alias("to_k"), order.alias("o"))
    outlasts = F.min(F.when(F.col("to_k") - F.col("k") == _RUN - 1, F.col("o"))).over(W.partitionBy(*BOOK, "order_side", "run"))
    near = each.withColumn("m", outlasts).filter("m IS NULL OR o <= m").select(*LEVEL, F.explode(F.sequence("k", "to_k")).alias("k"))
    of = lambda s, f: f(F.when(F.col("order_side") == s, F.col("price")))
    return near.groupBy(*BOOK, "k").agg(of("B", F.max).alias("bid"), of("S", F.min).alias("ask"))


def _groups(orders: DataFrame, touches: DataFrame, ranked: DataFrame, policy: str) -> DataFrame:
    """What the events that follow each order at once tell of it: rows like the fold's, and `rests`, whether what is left is taken to rest at the other side's best.

    orders: ORDER, came, rank (of the event in its book), came_ms, qty, ord_type, theirs (the other side's best before). They
    are islands: events that are next in the book, next in number, and of the same time, for as long as something is left.
    """
    by = W.partitionBy(*ORDER).orderBy("seq")
    t = touches.join(orders, ORDER).filter("seq > came").withColumn("rn", F.row_number().over(by))
    legal = (F.col("ord_type") == "market") & F.col("theirs").isNotNull()
    trade = F.col("kind") == "T"
    named = (F.col("seq_rank") == F.col("rank") + F.col("rn")) & (F.col("rn") <= GROUP_LIMIT) & (F.col("remaining_before") > 0)
    next_, same = F.col("seq") == F.col("came") + F.col("rn"), F.col("quote_ms") == F.col("came_ms")
    exact = F.col("other_no").isNull() & (F.col("touch_qty") == F.col("remaining_before"))
    why = (
        F.when(~named, F.lit(None).cast("string")).when(~next_, "non_adjacent").when(~same, "quote_time_boundary").when(trade & ~legal, "illegal_trade")
        .when(~trade & ~exact, "inexact_cancel").when(~trade, "cancelled")
    )
    t = t.withColumns({"why": why, "goes_on": named & next_ & same & trade & legal})
    first = F.min(F.when(~F.col("goes_on"), F.col("rn")))
    end = t.groupBy(*ORDER).agg(F.coalesce(first, F.count("*") + 1).alias("b"), F.min_by("why", F.when(~F.col("goes_on"), F.col("rn"))).alias("why"))
    taken = t.join(end.select(*ORDER, "b"), ORDER).filter("rn < b").groupBy(*ORDER).agg(F.min("remaining_after").alias("rest_qty"), F.count_if(F.col("price") != F.col("theirs")).alias("off"))
    all_ = orders.join(end, ORDER, "left").join(taken, ORDER, "left").withColumns({"size": F.coalesce("b", F.lit(1)) - 1, "left": F.coalesce("rest_qty", "qty")})
    done, gone = F.col("left") == 0, F.col("why") == "cancelled"
    size = F.col("size") + F.when(~done & F.coalesce(gone, F.lit(False)), 1).otherwise(0)
    all_ = all_.withColumns({"size": size, "done": done | F.coalesce(gone, F.lit(False))}).withColumn("end_seq", F.col("came") + F.col("size"))
    if policy == "assume_contiguous":
        follows = ranked.select(*BOOK, (F.col("seq") - 1).alias("end_seq"), F.lit(True).alias("follows"))
        all_ = all_.join(follows, [*BOOK, "end_seq"], "left")
        rests = (F.col("ord_type") == "market") & ~F.col("done") & F.col("why").isNull() & (F.col("size") > 0) & (F.col("off") == 0) & F.coalesce("follows", F.lit(False))
    else:
        rests = F.lit(False)
    all_ = all_.withColumn("rests", F.coalesce(rests, F.lit(False)))
    code = F.when(F.col("rests"), "inferred").when(F.col("done"), F.coalesce("why", F.lit("completed"))).otherwise(F.coalesce("why", F.lit("no_completion_evidence")))
    return all_.select(
        *BOOK, F.when(F.col("rests") | F.col("done"), "group").otherwise("violation").alias("what"), "order_side", "order_no", F.col("end_seq").alias("rest_seq"), F.col("size").cast("int").alias("sub_seq"),
        F.when(F.col("rests"), F.col("theirs")).alias("price"), F.when(F.col("done"), F.lit(0)).otherwise(F.col("left")).cast("bigint").alias("remaining"), code.alias("code"), "rests",
    )


def placements_in_rounds(events: DataFrame, policy: str = "rest_at_last_trade", led: DataFrame | None = None) -> DataFrame:
    """The rows of placement.placements, found in rounds. events and led (their ledger) are written ones."""
    if policy not in POLICIES:
        raise ValueError(f"policy {policy}")
    kind = F.coalesce("ord_type", F.lit("limit"))
    number = F.when(F.col("side") == "B", F.col("bid_no")).otherwise(F.col("ask_no"))
    some = written(events.filter((F.col("kind") == "A") & (kind != "limit")).select(*BOOK).distinct(), "books")
    applied = written(events.filter("kind <> 'S'").join(some, BOOK, "left_semi"), "applied")
    ranked = written(running(applied.select(*BOOK, "seq", "kind", "ord_type", "side", "bid_no", "ask_no", "price", "qty", "quote_ms"), BOOK, "seq", {"rank": Running("count", F.lit(1))}), "ranked")
    led = written(ledger.ledger(applied) if led is None else led.join(some, BOOK, "left_semi"), "ledger")
    orders = written(ranked.filter((F.col("kind") == "A") & (kind != "limit")).select(*BOOK, F.col("side").alias("order_side"), number.alias("order_no"), F.col("seq").alias("came"), "rank", F.col("quote_ms").alias("came_ms"), "ord_type", F.col("price").alias("own_price"), "qty"), "orders")
    at = ranked.select(*BOOK, "seq", F.col("rank").alias("seq_rank"), "bid_no", "ask_no")
    touches = led.filter("kind IN ('T', 'C')").join(orders.select(*ORDER), ORDER, "left_semi").join(at, [*BOOK, "seq"])
    other = F.nullif(F.when(F.col("order_side") == "B", F.col("ask_no")).otherwise(F.col("bid_no")), F.lit(0))
    touches = written(touches.select(*ORDER, "seq", "seq_rank", "sub_seq", "kind", "price", F.col("qty").alias("touch_qty"), "quote_ms", "remaining_before", "remaining_after", "ref_status", other.alias("other_no")), "touches")
    # best prices are those of levels that have orders, whatever their quantity
    fixed = written(deltas(led, orders.select(*ORDER)).filter("dcount <> 0").select(*LEVEL, (F.col("seq") * _STEPS).alias("seq"), "dcount"), "fixed")

    # when an order may come to rest: as it enters, or at each trade that leaves something of it
    enters = orders.filter(F.col("ord_type").isin("same_side_best", "opposite_best", "hide_if_crossing")).select(*ORDER, "ord_type", F.col("came").alias("rest_seq"), F.lit(0).alias("sub_seq"), F.col("own_price").alias("price"), F.col("qty").alias("remaining"), (F.col("came") * _STEPS - 1).alias("seq"))
    # orders that broke a rule as they entered still stand for what they are
    hidden = ["hide_if_crossing", "opposite_best", "unpriced", *(["market"] if policy == "rest_at_last_trade" else [])]
    trades = touches.filter("kind = 'T' AND ref_status = 'active' AND remaining_after > 0").withColumnRenamed("price", "trade_price").join(orders.filter(F.col("ord_type").isin(*hidden)).select(*ORDER, "ord_type", "own_price"), ORDER)
    price = F.when(F.col("ord_type") == "market", F.col("trade_price")).otherwise(F.col("own_price"))
    trades = trades.select(*ORDER, F.lit("priced").alias("ord_type"), F.col("seq").alias("rest_seq"), "sub_seq", price.alias("price"), F.col("remaining_after").alias("remaining"), (F.col("seq") * _STEPS + F.col("sub_seq")).alias("seq"))
    chances = written(enters.unionByName(trades), "chances")
    orders = orders.withColumn("seq", F.col("came") * _STEPS - 1)

    # places at which books are looked at are points, and all that may change a book is numbered by the first point that sees it: once, since only prices are guessed
    points = chances.select(*BOOK, "seq").unionByName(orders.select(*BOOK, "seq")).distinct()
    shown_at = F.col("rest_seq") * _STEPS + 1 + F.col("sub_seq")
    ends = touches.filter("ref_status = 'active' AND remaining_after = 0").select(*ORDER, F.col("seq").alias("end_seq"), (F.col("seq") * _STEPS).alias("seq"))
    marks = [fixed.select(*BOOK, "seq"), ends.select(*BOOK, "seq"), chances.select(*BOOK, shown_at.alias("seq"))]
    if policy == "assume_contiguous":
        marks += [touches.select(*BOOK, (F.col("seq") * _STEPS + 1 + i).alias("seq")) for i in (0, 1)]
    mark = marks[0]
    for m in marks[1:]:
        mark = mark.unionByName(m)
    both = written(mark.distinct().withColumn("is_point", F.lit(0)).unionByName(points.withColumn("is_point", F.lit(1))), "marks")
    numbered = written(running(both, BOOK, "seq", {"n": Running("sum", F.col("is_point"), before=True)}, ["is_point"]).select(*BOOK, "seq", "is_point", (F.coalesce("n", F.lit(0)) + 1).alias("k")), "numbered")
    point, mark = (numbered.filter(F.col("is_point") == i).drop("is_point") for i in (1, 0))
    last = written(point.groupBy(*BOOK).agg(F.max("k").alias("last_k")), "last")
    shown_k = mark.select(*BOOK, F.col("seq").alias("shown_seq"), F.col("k").alias("shown_k"))
    fixed = written(fixed.join(mark, [*BOOK, "seq"]).groupBy(*LEVEL, "k").agg(F.sum("dcount").alias("dcount")), "fixed")
    ends = written(ends.join(mark, [*BOOK, "seq"]).select(*ORDER, "end_seq", "k"), "ends")
    chances = written(chances.join(point, [*BOOK, "seq"]).withColumn("shown_seq", shown_at).join(shown_k, [*BOOK, "shown_seq"]).drop("seq", "shown_seq"), "chances")
    orders = written(orders.join(point, [*BOOK, "seq"]).drop("seq"), "orders")

    columns = [*ORDER, "rest_seq", "sub_seq", "price", "remaining", "shown_k"]
    guess = written(chances.filter(F.lit(False)).select(*columns), "guess")
    while True:
        shown = guess.select(*LEVEL, F.col("shown_k").alias("k"), F.lit(1).cast("bigint").alias("dcount"))
        after = ends.join(guess.select(*ORDER, "price", "rest_seq"), ORDER).filter("end_seq > rest_seq").select(*LEVEL, "k", F.lit(-1).cast("bigint").alias("dcount"))
        best = written(_best_prices(fixed.unionByName(shown).unionByName(after), last), "best")
        c = chances.join(best, [*BOOK, "k"], "left").withColumns({"own": _of_side("own"), "theirs": _of_side("other")})
        inside = F.col("theirs").isNull() | F.when(F.col("order_side") == "B", F.col("price") < F.col("theirs")).otherwise(F.col("price") > F.col("theirs"))
        can = F.when(F.col("ord_type") == "same_side_best", F.col("own").isNotNull()).when(F.col("ord_type") == "opposite_best", F.col("theirs").isNotNull()).otherwise(inside)
        where = F.when(F.col("ord_type") == "same_side_best", F.col("own")).when(F.col("ord_type") == "opposite_best", F.col("theirs")).otherwise(F.col("price"))
        new = c.filter(can).groupBy(*ORDER).agg(F.min(F.struct("rest_seq", "sub_seq", where.alias("price"), "remaining", "shown_k")).alias("x")).select(*ORDER, "x.*")
        met = orders.join(best, [*BOOK, "k"], "left").withColumns({"own": _of_side("own"), "theirs": _of_side("other")})
        waits = (F.col("ord_type") == "same_side_best") & F.col("own").isNull() | (F.lit(policy != "rest_at_last_trade") & (F.col("ord_type") == "market"))
        groups = _groups(met.filter(waits).select(*ORDER, "came", "rank", "came_ms", "qty", "ord_type", "theirs"), touches, ranked, policy)
        if policy == "assume_contiguous":
            groups = written(groups, "groups")
            inferred = groups.filter("rests").select(*ORDER, "rest_seq", F.when(F.col("order_side") == "B", 0).otherwise(1).alias("sub_seq"), "price", "remaining")
            new = new.unionByName(inferred.withColumn("shown_seq", shown_at).join(shown_k, [*BOOK, "shown_seq"]).drop("shown_seq"))
        new = written(new, "guess")
        if new.withColumn("n", F.lit(1)).unionByName(guess.withColumn("n", F.lit(-1))).groupBy(*columns).agg(F.sum("n").alias("n")).filter("n <> 0").isEmpty():
            break
        guess = new
    groups = written(groups, "groups")
    none = F.lit(None)
    placed = guess.select(*BOOK, F.lit("placement").alias("what"), "order_side", "order_no", "rest_seq", "sub_seq", "price", "remaining", none.cast("string").alias("code"))
    bad = met.filter((F.col("ord_type") == "unpriced") | ((F.col("ord_type") == "opposite_best") & F.col("theirs").isNull()))
    code = F.when(F.col("ord_type") == "unpriced", "unpriced_visible").otherwise("missing_reference_price")
    wrong = bad.select(*BOOK, F.lit("violation").alias("what"), "order_side", "order_no", F.col("came").alias("rest_seq"), F.lit(0).alias("sub_seq"), none.cast("bigint").alias("price"), F.col("qty").alias("remaining"), code.alias("code"))
    return placed.unionByName(groups.drop("rests")).unionByName(wrong).select(*BOOK, *_TOLD)
