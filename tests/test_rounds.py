"""Placements found in rounds are those of the fold, for every kind of order and every policy."""

import random

import pytest
from pyspark.sql import functions as F
from test_books import BEFORE, AFTER, add, cancel, make, random_day, trade

from bookweave import market_day
from bookweave.operators import ledger, placement, rounds
from bookweave.plans import days, special
from bookweave.shared import written

KINDS = ("limit", "limit", "limit", "market", "same_side_best", "hide_if_crossing", "opposite_best", "always_hide", "unpriced")


def same(spark, events, policy):
    events = written(events, "events")
    want = sorted(map(repr, placement.placements(events, policy).collect()))
    assert sorted(map(repr, rounds.placements_in_rounds(events, policy).collect())) == want
    return want


@pytest.mark.parametrize("policy", placement.POLICIES)
def test_random_books(spark, policy):
    """Orders of all kinds that depend on one another, in forty books."""
    rows = [{**r, "symbol": f"{i:06d}"} for i in range(40) for r in random_day(random.Random(300 + i), 50, KINDS)]
    found = same(spark, make(spark, rows), policy)
    assert sum("'placement'" in x for x in found) > 100 and sum("'violation'" in x for x in found) > 10


def test_chains(spark):
    """Each order's price is that of the one before, so that every round settles one more."""
    rows = [add(1, "B", 1, 100_000, 10)]
    for i in range(2, 9):
        rows += [add(2 * i, "B", 2 * i, None, 10, "same_side_best"), cancel(2 * i + 1, "B", 1 if i == 2 else 2 * i - 2, 10)]
    found = same(spark, make(spark, rows), "rest_at_last_trade")
    assert len(found) == 7 and all("price=100000" in x for x in found)


def test_response_groups(spark):
    """Islands of answers: complete, cut short by number, time or another order, cancelled, cancelled inexactly, and taken to rest."""
    cases = [
        [trade(3, 2, 1, 100_000, 100, 10), cancel(4, "B", 2, 200, 10)], [trade(3, 2, 1, 100_000, 100, 10)], [trade(4, 2, 1, 100_000, 100, 10)], [trade(3, 2, 1, 100_000, 100, 11)], [trade(3, 2, 1, 100_000, 100, 10), cancel(4, "B", 2, 199, 10)],
        [cancel(3, "B", 2, 300, 10)], [trade(3, 2, 1, 100_000, 300, 10)], [add(3, "S", 3, 100_100, 5, "limit", 10), cancel(4, "B", 2, 300, 10)], [trade(3, 2, 1, 99_000, 100, 10)], [trade(3, 2, 1, 100_000, 100, 10), add(4, "S", 9, 100_200, 1, "limit", 10)], [],
    ]
    rows = [{**r, "symbol": f"{i:06d}"} for i, case in enumerate(cases) for r in [*BEFORE, *case, *AFTER]]
    for policy in placement.POLICIES[1:]:
        assert same(spark, make(spark, rows), policy)


def test_large_books_go_in_rounds(spark, tmp_path, monkeypatch):
    """A day whose larger books are placed in rounds, and the others by folding, is the day it was."""
    e = special._mixed(spark, days_sf := "/root/testdata/sf0.001").filter("seq <= 60")
    e = e.withColumns({"trading_day": F.lit(days.TRADING_DAY), "quote_ms": F.lit(days.MIDNIGHT + 36_000_000) + F.col("seq"), "bid_no": F.col("bid_no") * 1, "seq": F.col("seq")})
    counts = sorted(r["count"] for r in e.groupBy("symbol").count().collect())
    led = written(ledger.ledger(e := written(e, "events")), "ledger")
    whole = sorted(map(repr, market_day._placements(e, led, "rest_at_last_trade").collect()))
    monkeypatch.setattr(market_day, "LARGE_BOOK", counts[len(counts) // 2])
    assert sorted(map(repr, market_day._placements(e, led, "rest_at_last_trade").collect())) == whole and days_sf


def test_best_prices(spark):
    """Best prices at every point are those of summing up all moves before it, over several runs of points."""
    r = random.Random(7)
    moves, stands = [], {}
    for k in range(1, 402):
        for _ in range(r.randrange(3)):
            side, price = r.choice("BS"), r.randrange(100, 106)
            d = r.choice((1, -1)) if stands.get((side, price)) else 1
            stands[side, price] = stands.get((side, price), 0) + d
            moves.append(("SZ", 1, "000001", side, price, k, d))
    rows = spark.createDataFrame(moves, "market string, trading_day int, symbol string, order_side string, price long, k long, dcount long")
    last = spark.createDataFrame([("SZ", 1, "000001", 400)], "market string, trading_day int, symbol string, last_k long")
    got = {x.k: (x.bid, x.ask) for x in rounds._best_prices(rows, last).collect()}
    for k in range(1, 401):
        at = {}
        for *_, side, price, when, d in moves:
            if when <= k:
                at[side, price] = at.get((side, price), 0) + d
        of = lambda s, f: f((p for (side, p), n in at.items() if side == s and n > 0), default=None)  # noqa: B023, E731
        assert got.get(k, (None, None)) == (of("B", max), of("S", min))
    assert set(got) <= set(range(1, 401))


def test_a_round_is_two_tables(spark, monkeypatch):
    """Points are numbered and groups of answers are told once, whatever the rounds; a round writes best prices and guesses."""
    names, kept = [], rounds.written
    monkeypatch.setattr(rounds, "written", lambda df, name: (names.append(name), kept(df, name))[1])
    rounds.placements_in_rounds(kept(special._mixed(spark, "/root/testdata/sf0.001"), "mixed"), "require_evidence")
    assert names.count("groups") == names.count("numbered") == 1 and names.count("best") == names.count("guess") - 1 > 1 and "changes" not in names
