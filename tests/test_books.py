"""Golden book states, market-order cases, and the relational plan against an ordered fold."""

import random

import pytest
from pyspark.sql import functions as F

from bookweave.operators import book, integrity, ledger, placement, snapshots
from bookweave.schema import EVENT

COLUMNS = [c.split()[0] for c in EVENT.split(", ")]


def make(spark, rows, market="SZ"):
    """rows: dicts with seq, kind and what matters; the rest has defaults."""
    base = {"market": market, "trading_day": 20260828, "symbol": "000001", "channel": 1, "ord_type": None, "side": None, "flag": None, "status": None, "bid_no": None, "ask_no": None, "price": None, "qty": 0, "quote_ms": 0}
    full = [{**base, **r} for r in rows]
    for r in full:
        if r["kind"] == "A" and r["ord_type"] is None:
            r["ord_type"] = "limit"
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in full], EVENT)


def add(seq, side, no, price, qty, kind="limit", ms=0):
    return {"seq": seq, "kind": "A", "side": side, "bid_no" if side == "B" else "ask_no": no, "price": price, "qty": qty, "ord_type": kind, "quote_ms": ms}


def trade(seq, bid, ask, price, qty, ms=0):
    return {"seq": seq, "kind": "T", "side": "N", "bid_no": bid, "ask_no": ask, "price": price, "qty": qty, "quote_ms": ms}


def cancel(seq, side, no, qty, ms=0):
    return {"seq": seq, "kind": "C", "side": side, "bid_no" if side == "B" else "ask_no": no, "qty": qty, "quote_ms": ms}


GOLDEN = [add(1, "B", 101, 100_000, 100), add(2, "B", 102, 100_000, 50), add(3, "S", 201, 101_000, 120), trade(4, 101, 201, 100_500, 40), cancel(5, "B", 102, 50), trade(6, 101, 201, 100_700, 60), cancel(7, "S", 201, 20)]
STATES = {1: {("B", 100_000): (100, 1)}, 2: {("B", 100_000): (150, 2)}, 3: {("B", 100_000): (150, 2), ("S", 101_000): (120, 1)}, 4: {("B", 100_000): (110, 2), ("S", 101_000): (80, 1)}, 5: {("B", 100_000): (60, 1), ("S", 101_000): (80, 1)}, 6: {("S", 101_000): (20, 1)}, 7: {}}


def levels(df):
    return {(r.order_side, r.price): (r.quantity, r.order_count) for r in df.collect()}


def test_golden_lifecycle(spark):
    events = make(spark, GOLDEN)
    led = ledger.ledger(events)
    changes = book.deltas(led).cache()
    for seq, want in STATES.items():
        assert levels(book.level_totals(changes.filter(F.col("seq") <= seq))) == want, seq
    s = book.trade_stats(events).first()
    assert (s.last_price, s.low_price, s.high_price, s.volume, int(s.turnover), s.trades) == (100_700, 100_500, 100_700, 100, 10_062_000, 2)
    four = ledger.ledger(events.filter("seq <= 4"))
    queue = [(r.order_no, r.remaining, r.quantity_ahead) for r in book.fifo_queue(ledger.active_orders(four)).filter("order_side = 'B'").orderBy("position").collect()]
    assert queue == [(101, 60, 0), (102, 50, 60)]
    assert ledger.reference_violations(events, led).count() == 0


def placed(spark, rows, policy="rest_at_last_trade"):
    events = make(spark, rows)
    found = placement.placements(events, policy)
    return levels(book.level_totals(placement.placed_deltas(events, ledger.ledger(events), found))), found.collect()


def test_hidden_reentry(spark):
    got, _ = placed(spark, [add(1, "S", 301, 100_000, 100), add(2, "B", 302, 101_000, 150, "hide_if_crossing"), trade(3, 302, 301, 100_000, 100)])
    assert got == {("B", 101_000): (50, 1)}


def test_market_remainder(spark):
    rows = [add(1, "S", 1, 55_000, 100), add(2, "B", 2, None, 150, "market"), trade(3, 2, 1, 55_000, 40)]
    assert placed(spark, rows)[0] == {("S", 55_000): (60, 1)}
    assert placed(spark, [*rows, trade(4, 2, 1, 55_000, 60)])[0] == {("B", 55_000): (50, 1)}
    far = [add(1, "S", 1, 100_000, 100), add(2, "S", 3, 100_100, 100), add(4, "B", 4, None, 300, "market"), trade(5, 4, 1, 100_000, 100)]
    assert placed(spark, far)[0] == {("B", 100_000): (200, 1), ("S", 100_100): (100, 1)}
    assert placed(spark, [*far, trade(6, 4, 3, 100_100, 100)])[0] == {("B", 100_000): (100, 1)}
    assert placed(spark, [*far, trade(6, 4, 3, 100_100, 100), cancel(7, "B", 4, 100)])[0] == {}


BEFORE, AFTER = [add(1, "S", 1, 100_000, 100), add(2, "B", 2, 123_456, 300, "market", 10)], [add(6, "B", 6, 100_000, 50, "limit", 11)]


@pytest.mark.parametrize(("rows", "policy", "bid", "what"), [
    ([trade(3, 2, 1, 100_000, 100, 10), cancel(4, "B", 2, 200, 10)], "require_evidence", 50, "cancelled"),
    ([trade(3, 2, 1, 100_000, 100, 10)], "require_evidence", None, "no_completion_evidence"),
    ([trade(4, 2, 1, 100_000, 100, 11)], "rest_at_last_trade", 250, None),
    ([trade(4, 2, 1, 100_000, 100, 11), cancel(5, "B", 2, 200, 11)], "rest_at_last_trade", 50, None),
    ([trade(4, 2, 1, 100_000, 100, 10)], "require_evidence", None, "non_adjacent"),
    ([trade(3, 2, 1, 100_000, 100, 11)], "require_evidence", None, "quote_time_boundary"),
    ([trade(3, 2, 1, 100_000, 100, 10), cancel(4, "B", 2, 199, 10)], "require_evidence", None, "inexact_cancel"),
])
def test_market_order_cases(spark, rows, policy, bid, what):
    got, found = placed(spark, BEFORE + rows + AFTER, policy)
    codes = [r.code for r in found if r.what != "placement"]
    assert codes == ([what] if what else [])
    if bid is not None:
        assert got.get(("B", 100_000), (0, 0))[0] == bid


def test_contiguous_remainder(spark):
    got, found = placed(spark, [*BEFORE, trade(3, 2, 1, 100_000, 100, 10), add(4, "B", 4, 100_000, 50, "limit", 11)], "assume_contiguous")
    assert got == {("B", 100_000): (250, 2)} and [r.code for r in found if r.what == "group"] == ["inferred"]


def test_same_side_best(spark):
    got, found = placed(spark, [add(1, "B", 1, 100_000, 150), add(2, "B", 2, None, 300, "same_side_best")], "require_evidence")
    assert got == {("B", 100_000): (450, 2)} and [r.what for r in found] == ["placement"]
    assert [r.code for r in placed(spark, [add(2, "B", 2, None, 300, "same_side_best")])[1]] == ["no_completion_evidence"]
    assert [r.code for r in placed(spark, [add(2, "B", 2, None, 300, "same_side_best"), cancel(3, "B", 2, 300)])[1]] == ["cancelled"]


def test_places_in_the_queue(spark):
    """An order that came to rest later stands behind those that were there; one that never did is in no queue."""
    rows = [add(1, "S", 1, 100_000, 100), add(2, "B", 2, None, 150, "market"), add(3, "B", 3, 99_000, 10), add(4, "B", 4, None, 20, "market"), trade(5, 2, 1, 99_000, 100), add(6, "B", 6, 99_000, 5)]
    events = make(spark, rows)
    led = ledger.ledger(events)
    live = ledger.active_orders(led, placement.placements(events))
    assert {(r.order_no, r.visible, r.price) for r in live.collect()} == {(2, True, 99_000), (3, True, 99_000), (4, False, None), (6, True, 99_000)}
    assert [(r.order_no, r.quantity_ahead) for r in book.fifo_queue(live).orderBy("position").collect()] == [(3, 0), (2, 10), (6, 60)]


def random_day(rng, n, kinds=("limit",)):
    rows, left, seq = [], {}, 0
    for _ in range(n):
        seq += rng.choice([1, 1, 2])
        bids, asks = [[k for k in left if k[0] == s] for s in "BS"]
        pick = rng.random()
        if pick < 0.5 or not left:
            side = rng.choice("BS")
            q = rng.randrange(1, 9) * 10
            rows.append(add(seq, side, seq, rng.randrange(95, 106) * 100, q, rng.choice(kinds)))
            left[side, seq] = q
        elif pick < 0.8 and bids and asks:
            b, a = rng.choice(bids), rng.choice(asks)
            q = rng.randrange(1, min(left[b], left[a]) + 1)
            rows.append(trade(seq, b[1], a[1], rng.randrange(95, 106) * 100, q))
            for k in (b, a):
                left[k] -= q
                if not left[k]:
                    del left[k]
        else:
            k = rng.choice(list(left))
            rows.append(cancel(seq, k[0], k[1], left.pop(k)))
    return rows


def simulated(rows):
    orders, out = {}, {}
    for r in rows:
        if r["kind"] == "A":
            orders[r["side"], r.get("bid_no") or r.get("ask_no")] = [r["price"], r["qty"]]
        for side, no in (("B", r.get("bid_no")), ("S", r.get("ask_no"))):
            if r["kind"] != "A" and no:
                o = orders[side, no]
                o[1] = 0 if r["kind"] == "C" else o[1] - r["qty"]
    for (side, _), (price, q) in orders.items():
        if q:
            was = out.get((side, price), (0, 0))
            out[side, price] = (was[0] + q, was[1] + 1)
    return out


def test_random_days(spark):
    """Many books in one job: sums of changes equal a book kept event by event, and break no rule of their own."""
    days = {f"{i:06d}": random_day(random.Random(i), 60) for i in range(40)}
    events = make(spark, [{**r, "symbol": s} for s, rows in days.items() for r in rows])
    led = ledger.ledger(events)
    changes = book.deltas(led)
    got = {s: {} for s in days}
    for r in book.level_totals(changes).collect():
        got[r.symbol][r.order_side, r.price] = (r.quantity, r.order_count)
    assert got == {s: simulated(rows) for s, rows in days.items()}
    assert ledger.reference_violations(events, led).count() == 0
    assert book.invariant_breaks(ledger.active_orders(led), book.level_totals(changes), book.side_totals(changes)).count() == 0


def plain_book(rows):
    """Visible levels after a day, by a book that is searched whole at every step: market orders are hidden until they have traded, then take that price; hidden ones show once they do not cross."""
    orders = {}

    def best(side):
        prices = [o["price"] for (s, _), o in orders.items() if s == side and o["seen"] and o["left"]]
        return (max if side == "B" else min)(prices) if prices else None

    def clear(side, price):
        other = best("S" if side == "B" else "B")
        return other is None or (price < other if side == "B" else price > other)

    for r in rows:
        named = [(s, n) for s, n in (("B", r.get("bid_no")), ("S", r.get("ask_no"))) if n]
        if r["kind"] == "A":
            kind = r["ord_type"]
            orders[named[0]] = {"price": r["price"], "left": r["qty"], "kind": kind, "seen": kind == "limit" or kind == "hide_if_crossing" and clear(r["side"], r["price"])}
        elif r["kind"] == "C":
            orders[named[0]]["left"] = 0
        else:
            for k in named:
                orders[k]["left"] -= r["qty"]
            for k in named:
                o = orders[k]
                if o["left"] and not o["seen"]:
                    if o["kind"] == "market":
                        o["price"] = r["price"]
                    o["seen"] = clear(k[0], o["price"])
    out = {}
    for (side, _), o in orders.items():
        if o["seen"] and o["left"]:
            was = out.get((side, o["price"]), (0, 0))
            out[side, o["price"]] = (was[0] + o["left"], was[1] + 1)
    return out


def test_placements_give_the_whole_book(spark):
    """Placed orders by sums of changes, against a book of its own that keeps every order and looks for the best at each step."""
    days = {f"{i:06d}": random_day(random.Random(100 + i), 60, ("limit", "limit", "market", "hide_if_crossing")) for i in range(40)}
    events = make(spark, [{**r, "symbol": s} for s, rows in days.items() for r in rows])
    found = placement.placements(events)
    got = {s: {} for s in days}
    for r in book.level_totals(placement.placed_deltas(events, ledger.ledger(events), found)).collect():
        got[r.symbol][r.order_side, r.price] = (r.quantity, r.order_count)
    assert got == {s: plain_book(rows) for s, rows in days.items()}
    assert found.filter("what = 'placement'").groupBy("symbol").count().count() > 30


def test_runs_of_points_lose_no_level(spark):
    """The best levels at every point, by runs of points and by looking at all levels."""
    rng = random.Random(3)
    rows, now = [], {}
    for k in range(1, 200):
        for _ in range(rng.randrange(3)):
            side, price = rng.choice("BS"), rng.randrange(40)
            q, n = now.get((side, price), (0, 0))
            d = (-q, -n) if n and rng.random() < 0.4 else (rng.randrange(1, 9), 1)
            now[side, price] = (q + d[0], n + d[1])
            rows.append(("SZ", 1, "000001", side, price, k, *d))
    changes = spark.createDataFrame(rows, "market string, trading_day int, symbol string, order_side string, price long, k long, dqty long, dcount long")
    last = F.lit(230).cast("bigint")
    for run in (1, 16, 64):
        got = {(r.order_side, r.k, r.level): (r.price, r.quantity, r.order_count) for r in snapshots.best_states(changes, last, 4, run).collect()}
        want, held = {}, {}
        for k in range(1, 231):
            for _, _, _, side, price, at, q, n in rows:
                if at == k:
                    was = held.get((side, price), (0, 0))
                    held[side, price] = (was[0] + q, was[1] + n)
            for side in "BS":
                live = sorted((p for (s, p), (_, n) in held.items() if s == side and n), reverse=side == "B")
                want |= {(side, k, i + 1): (p, *held[side, p]) for i, p in enumerate(live[:4])}
        assert got == want


def test_every_fault_is_found(spark):
    rows = [add(1, "B", 1, 100, 50), add(2, "B", 1, 100, 50), add(3, "S", 2, 100, 10), trade(4, 1, 2, 100, 20), cancel(5, "B", 9, 1), trade(6, 8, 0, 100, 1), {"seq": 7, "kind": "C", "bid_no": 1, "ask_no": 2, "qty": 1}]
    sz = make(spark, rows)
    assert {(r.seq, r.code) for r in ledger.reference_violations(sz, ledger.ledger(sz)).collect()} >= {(2, "duplicate_add"), (4, "overfill"), (5, "unknown_cancel"), (6, "unknown_trade"), (7, "cancel_sides")}
    sh = make(spark, [{**add(1, "B", 1, 100, 50), "flag": "S"}, {**trade(2, 9, 0, 100, 1), "side": "B"}, {**trade(3, 1, 0, 100, 1), "side": "S"}, {**trade(4, 1, 9, 100, 1), "side": "B"}], "SH")
    assert {(r.seq, r.code) for r in ledger.reference_violations(sh, ledger.ledger(sh)).collect()} == {(1, "add_side"), (2, "unknown_trade"), (4, "unknown_trade")}
    assert ledger.first_violations(ledger.reference_violations(sz, ledger.ledger(sz))).first().seq == 2
    closed = make(spark, [add(1, "B", 1, 100, 50), {"seq": 2, "kind": "S", "status": "CLOSE"}, add(3, "B", 3, 100, 50)], "SH")
    assert [r.seq for r in integrity.after_close(closed).collect()] == [3]
