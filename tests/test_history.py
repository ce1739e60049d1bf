"""Places in the queue at any event, and first broken rules, against books that are kept event by event."""

import random

from pyspark.sql import functions as F
from test_books import add, cancel, make, trade

from bookweave.operators import book, history, ledger, placement, slices
from bookweave.schema import BOOK
from bookweave.shared import written


def random_day(rng, n, symbols=("000001",)):
    rows, live = [], {}
    for seq in range(1, n + 1):
        symbol = rng.choice(symbols)
        mine = {k: o for k, o in live.items() if k[0] == symbol}
        if not mine or rng.random() < 0.55:
            side = rng.choice("BS")
            price = rng.choice([100, 101]) if side == "B" else rng.choice([102, 103])
            live[symbol, seq] = [side, price, rng.randrange(1, 50)]
            rows.append({**add(seq, side, seq, price, live[symbol, seq][2]), "symbol": symbol})
            continue
        key = rng.choice(list(mine))
        side, price, left = live[key]
        if rng.random() < 0.4:
            rows.append({**cancel(seq, side, key[1], left), "symbol": symbol})
            del live[key]
        else:
            q = rng.randrange(1, left + 1)
            rows.append({**trade(seq, key[1] if side == "B" else None, key[1] if side == "S" else None, price, q), "symbol": symbol})
            live[key][2] -= q
            if not live[key][2]:
                del live[key]
    return rows


def queues(rows):
    """(symbol, at, no) to (price, remaining, position, ahead), kept event by event."""
    state, out = [], {}
    for r in sorted(rows, key=lambda r: r["seq"]):
        no = r.get("bid_no") or r.get("ask_no")
        if r["kind"] == "A":
            state.append([r["symbol"], r["side"], r["price"], no, r["qty"]])
        else:
            o = next(x for x in state if x[0] == r["symbol"] and x[3] == no)
            o[4] = 0 if r["kind"] == "C" else o[4] - r["qty"]
            state = [x for x in state if x[4]]
        for i, (s, side, price, no, left) in enumerate(state):
            ahead = [x for x in state[:i] if x[:3] == [s, side, price]]
            out[s, r["seq"], no] = (price, left, len(ahead) + 1, sum(x[4] for x in ahead))
    return out


def test_places_at_any_event(spark, monkeypatch):
    """All orders at all events, also of other books' numbers; orders that do not stand are left out. The same in small slices."""
    rows = random_day(random.Random(5), 260, ("000001", "000002"))
    led = ledger.ledger(written(make(spark, rows), "events"))
    changes = written(book.deltas(led), "changes")
    orders = led.filter("kind = 'A'").select(*BOOK, "order_side", "order_no")
    asked = orders.withColumn("at_seq", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(260).cast("long"))))
    want = queues(rows)
    # a book's state at a number of another book is that after its own last one
    full, last = {}, {}
    for at in range(1, 261):
        symbol = next(r["symbol"] for r in rows if r["seq"] == at)
        last[symbol] = {no: v for (s, n, no), v in want.items() if n == at and s == symbol}
        full |= {(s, at, no): v for s, x in last.items() for no, v in x.items()}
    for bits in (16, 3):
        monkeypatch.setattr(slices, "NUMBERS", bits)
        got = {(r.symbol, r.at_seq, r.order_no): (r.price, r.remaining, r.position, r.quantity_ahead) for r in history.queue_at(changes, asked).collect()}
        assert got == full


def test_places_of_orders_that_rest_late(spark):
    """A market order stands where it came to rest, behind what was there by then."""
    rows = [add(1, "S", 1, 100, 5), add(2, "B", 2, None, 8, "market"), add(3, "B", 3, 100, 4), trade(4, 2, 1, 100, 5), add(5, "B", 5, 100, 9)]
    events = written(make(spark, rows), "events")
    led = ledger.ledger(events)
    placed = placement.placements(events)
    changes = written(placement.placed_deltas(events, led, placed), "changes")
    asked = spark.createDataFrame([("SZ", 20260828, "000001", "B", n, 5) for n in (2, 3, 5)], "market string, trading_day int, symbol string, order_side string, order_no long, at_seq long")
    got = {r.order_no: (r.price, r.remaining, r.position, r.quantity_ahead) for r in history.queue_at(changes, asked).collect()}
    assert got == {3: (100, 4, 1, 0), 2: (100, 3, 2, 4), 5: (100, 9, 3, 7)}


def test_good_books_break_nothing_and_damage_is_found_at_once(spark):
    rows = random_day(random.Random(9), 300)
    led = written(ledger.ledger(make(spark, rows)), "ledger")
    changes = written(book.deltas(led), "changes")
    assert history.first_breaks(led, changes, changes, changes).collect() == []
    hurt = written(changes.withColumn("dqty", F.when(F.col("seq") == 40, F.col("dqty") + 1).otherwise(F.col("dqty"))), "hurt")
    at = changes.filter("seq = 40").first()
    got = sorted((r.rule, r.first_seq) for r in history.first_breaks(led, changes, hurt, changes).filter("rule <> 'empty'").collect())
    assert got == [("level", 40), ("side", 40)] and at is not None
    found = history.first_breaks(led, changes, hurt, hurt).filter("rule <> 'empty'").collect()
    assert [(r.rule, r.price, r.first_seq) for r in found] == [("level", at.price, 40)]


def test_only_what_goes_and_what_is_asked_is_laid_out(spark, monkeypatch):
    """Orders of a level that stand are counted by their place alone: the tree of runs has no row of them."""
    seen, real = {}, history.written
    monkeypatch.setattr(history, "written", lambda df, name: seen.setdefault(name, real(df, name)))
    rows = [add(n, "B", n, 100, n) for n in range(1, 65)] + [trade(65, 3, None, 100, 2), cancel(66, "B", 5, 5)]
    changes = written(book.deltas(ledger.ledger(make(spark, rows))), "changes")
    asked = spark.createDataFrame([("SZ", 20260828, "000001", "B", 64, 66), ("SZ", 20260828, "000001", "B", 5, 66)], "market string, trading_day int, symbol string, order_side string, order_no long, at_seq long")
    assert [tuple(r) for r in history.queue_at(changes, asked).collect()] == [("SZ", 20260828, "000001", "B", 64, 100, 66, 64, 63, sum(range(1, 64)) - 7)]
    assert seen["runs"].count() <= 4 * 7
