"""Where orders without a price of their own rest: the one step that depends on the book at that moment.

A fold over one book's events in native order decides, for market, same-side-best and hide-if-crossing
orders only, when and at what price they become visible. Everything else about them is relational again:
a placement is a change of +remaining, and only what follows it shows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookweave.operators.book import deltas
from bookweave.schema import BOOK
from bookweave.shared import written

POLICIES = ("rest_at_last_trade", "require_evidence", "assume_contiguous")
GROUP_LIMIT = 65_536
_OUT = "market string, trading_day int, symbol string, what string, order_side string, order_no bigint, rest_seq bigint, sub_seq int, price bigint, remaining bigint, code string"


class _Side:
    """Quantities by price and the best price."""

    def __init__(self, sign: int):
        self.sign, self.at, self.heap = sign, {}, []

    def change(self, price: int, q: int) -> None:
        if price not in self.at:
            self.at[price] = 0
            heapq.heappush(self.heap, self.sign * price)
        self.at[price] += q

    def best(self) -> int | None:
        while self.heap and self.at.get(self.sign * self.heap[0], 0) <= 0:
            self.at.pop(self.sign * heapq.heappop(self.heap), None)
        return self.sign * self.heap[0] if self.heap else None


def fold(events: Iterable[dict], policy: str) -> Iterator[tuple]:
    """(what, side, order_no, rest_seq, sub_seq, price, remaining, code) for one book's events in native order.

    what: placement, group (a closed response group; code `completed`, `cancelled`, or `inferred`) or violation.
    Only live orders, live levels and one event ahead are held.
    """
    sides = {"B": _Side(-1), "S": _Side(1)}
    orders: dict[tuple[str, int], dict] = {}
    out: list[tuple] = []
    rows = iter(events)
    ahead = next(rows, None)

    def rest(side, no, o, seq, sub):
        o["visible"] = True
        sides[side].change(o["price"], o["left"])
        if o["type"] != "limit":
            out.append(("placement", side, no, seq, sub, o["price"], o["left"], None))

    def take(side, no, q, seq):
        o = orders.get((side, no))
        if o is None or o["left"] <= 0:
            return None
        q = min(q, o["left"])
        o["left"] -= q
        if o["visible"]:
            sides[side].change(o["price"], -q)
        if not o["left"]:
            del orders[side, no]
        return o

    def inside(side, price):
        other = sides["S" if side == "B" else "B"].best()
        return other is None or (price < other if side == "B" else price > other)

    def trade(e):
        both = []
        for sub, (side, no) in enumerate((("B", e["bid_no"]), ("S", e["ask_no"]))):
            if no:
                o = take(side, no, e["qty"], e["seq"])
                if o is not None:
                    both.append((sub, side, no, o))
        for sub, side, no, o in both:
            if o["left"] > 0 and not o["visible"] and not o["never"] and o["type"] != "same_side_best":
                if o["type"] == "market":
                    o["price"] = e["price"]
                if inside(side, o["price"]):
                    rest(side, no, o, e["seq"], sub)

    while ahead is not None:
        e, ahead = ahead, next(rows, None)
        if e["kind"] == "T":
            trade(e)
        elif e["kind"] == "C":
            for side, no in (("B", e["bid_no"]), ("S", e["ask_no"])):
                if no:
                    take(side, no, 1 << 62, e["seq"])
        elif e["kind"] == "A":
            side, kind = e["side"], e["ord_type"] or "limit"
            no = e["bid_no"] if side == "B" else e["ask_no"]
            o = orders[side, no] = {"price": e["price"], "left": e["qty"], "visible": False, "type": kind, "never": kind == "always_hide"}
            mine, theirs = sides[side].best(), sides["S" if side == "B" else "B"].best()
            if kind == "limit":
                rest(side, no, o, e["seq"], 0)
            elif kind == "hide_if_crossing":
                if inside(side, o["price"]):
                    rest(side, no, o, e["seq"], 0)
            elif kind == "same_side_best" and mine is not None:
                o["price"] = mine
                rest(side, no, o, e["seq"], 0)
            elif kind == "opposite_best":
                if theirs is None:
                    out.append(("violation", side, no, e["seq"], 0, None, o["left"], "missing_reference_price"))
                else:
                    o["price"] = theirs
                    rest(side, no, o, e["seq"], 0)
            elif kind == "unpriced":
                out.append(("violation", side, no, e["seq"], 0, None, o["left"], "unpriced_visible"))
            elif kind == "same_side_best" or (kind == "market" and policy != "rest_at_last_trade"):
                # the executions that follow at once, and nothing else, tell what became of it
                o["never"], prices, code = True, set(), None
                seq, size = e["seq"], 0
                while ahead is not None and o["left"] > 0 and size < GROUP_LIMIT:
                    r = ahead
                    named = r["kind"] in "TC" and (r["bid_no"] if side == "B" else r["ask_no"]) == no
                    if not named:
                        break
                    if r["seq"] != seq + 1:
                        code = "non_adjacent"
                        break
                    if r["quote_ms"] != e["quote_ms"]:
                        code = "quote_time_boundary"
                        break
                    if r["kind"] == "T":
                        if theirs is None or kind == "same_side_best":
                            code = "illegal_trade"
                            break
                        prices.add(r["price"])
                        trade(r)
                    else:
                        if (r["ask_no"] if side == "B" else r["bid_no"]) or r["qty"] != o["left"]:
                            code = "inexact_cancel"
                            break
                        take(side, no, 1 << 62, r["seq"])
                        code = "cancelled"
                    seq, size, ahead = r["seq"], size + 1, next(rows, None)
                if o["left"] == 0:
                    out.append(("group", side, no, seq, size, None, 0, code or "completed"))
                elif kind == "market" and policy == "assume_contiguous" and code is None and size and prices == {theirs} and ahead is not None and ahead["seq"] == seq + 1:
                    o["price"] = theirs
                    out.append(("group", side, no, seq, size, theirs, o["left"], "inferred"))
                    rest(side, no, o, seq, 0 if side == "B" else 1)
                else:
                    out.append(("violation", side, no, seq, size, None, o["left"], code or "no_completion_evidence"))
        yield from out
        out.clear()


def placements(events: DataFrame, policy: str = "rest_at_last_trade") -> DataFrame:
    """Placements, response groups and violations of every book; see fold. A task reads its books in order, a batch of narrow rows at a time."""
    if policy not in POLICIES:
        raise ValueError(f"policy {policy}")
    narrow = ["seq", "kind", "ord_type", "side", "bid_no", "ask_no", "price", "qty", "quote_ms"]
    names = [c.split()[0] for c in _OUT.split(", ")]
    kinds = [{"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}[c.split()[1]] for c in _OUT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in [*BOOK, *narrow]), strict=True))
        out: list[tuple] = []
        for book, events in groupby(rows, key=lambda r: r[:3]):
            for x in fold((dict(zip(narrow, r[3:], strict=True)) for r in events), policy):
                out.append((*book, *x))
                if len(out) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                    out.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    # books of limit orders alone need no fold
    other = written(events.filter("kind = 'A' AND coalesce(ord_type, 'limit') <> 'limit'").select(*BOOK).distinct(), "folded")
    rows = events.filter("kind <> 'S'").select(*BOOK, *narrow).join(other, BOOK, "left_semi")
    return rows.repartition(*BOOK).sortWithinPartitions(*BOOK, "seq").mapInArrow(run, _OUT)


def placed_deltas(events: DataFrame, led: DataFrame, placed: DataFrame) -> DataFrame:
    """Visible changes of all orders: limit orders as ever, others from where they rest. What has no number is no order, as in the ledger."""
    order = [*BOOK, "order_side", "order_no"]
    number = F.when(F.col("side") == "B", F.col("bid_no")).otherwise(F.col("ask_no"))
    other = events.filter("kind = 'A' AND coalesce(ord_type, 'limit') <> 'limit'").select(*BOOK, F.col("side").alias("order_side"), number.alias("order_no")).distinct()
    other = written(other, "unpriced")  # where they are few, or none, the ledger is not shuffled for them
    if other.isEmpty():
        return deltas(led)
    at = placed.filter("what = 'placement' AND order_no <> 0").select(*order, "rest_seq", F.col("price").alias("rest_price"), "remaining", "sub_seq")
    shown = at.select(*BOOK, "order_side", F.col("rest_price").alias("price"), "order_no", F.col("rest_seq").alias("seq"), "sub_seq", F.lit(None).cast("bigint").alias("quote_ms"), F.col("remaining").alias("dqty"), F.lit(1).cast("bigint").alias("dcount"))
    later = led.filter("ref_status = 'active'").join(at.select(*order, "rest_seq", "rest_price"), order).filter("seq > rest_seq").select(
        *BOOK, "order_side", F.col("rest_price").alias("price"), "order_no", "seq", "sub_seq", "quote_ms", (F.col("remaining_after") - F.col("remaining_before")).alias("dqty"), F.when(F.col("remaining_after") == 0, -1).otherwise(0).cast("bigint").alias("dcount"))
    return deltas(led, other).unionByName(shown).unionByName(later)
