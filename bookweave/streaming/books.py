"""Incremental books on Structured Streaming, in two stateful steps.

The gate, a state per channel, brings rows into native order: a row waits until the one before it is there, a number that
was already passed on is told apart, and one that does not come is given up, and told, once the watermark is far enough
behind it. The books, a state per book, apply what the gate passes on: every event tells the levels that it changed, and
every boundary a book's trade statistics before it, either when an event at or after it comes or when the watermark has
passed it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_ROW = "symbol string, kind string, bid_no bigint, ask_no bigint, price bigint, qty bigint, quote_ms bigint"
_FIELDS = [c.split()[0] for c in _ROW.split(", ")]
_PASSED = f"market string, trading_day int, channel int, what string, seq bigint, upto bigint, {_ROW}, released timestamp"
_OUT = "market string, trading_day int, symbol string, what string, seq bigint, upto bigint, channel int, order_side string, price bigint, quantity bigint, order_count bigint, at_ms bigint, volume bigint, trades bigint"


#: The state store that map states and timers need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Rows that wait lie in the state by runs of this many numbers, and orders by runs of this many order numbers, as powers of two.
_HELD, _ORDERS = 12, 12
#: Rows that a book works on, and tells of, at once.
_BATCH = 20_000


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    numbers = [n for n, t in (c.split() for c in schema.split(", ")) if t in ("bigint", "int")]
    return pd.DataFrame(rows, columns=_names(schema)).astype(dict.fromkeys(numbers, "Int64"))


def _plain(batch: pd.DataFrame, names: list[str]) -> Iterator[tuple]:
    """Rows of plain values; absent ones are None."""
    text = ("symbol", "kind", "what")
    of = lambda c: batch[c].astype(object).where(batch[c].notna(), None).tolist()
    return zip(*(of(c) if c in text else [None if x is None else int(x) for x in of(c)] for c in names), strict=True)


class _Entries:
    """A map state, read and written once a batch per key that is touched."""

    def __init__(self, state):
        self.state, self.now, self.changed = state, {}, set()

    def get(self, key: tuple) -> tuple | None:
        if key not in self.now:
            self.now[key] = self.state.getValue(key) if self.state.containsKey(key) else None
        return self.now[key]

    def put(self, key: tuple, value: tuple | None) -> None:
        self.now[key] = value
        self.changed.add(key)

    def flush(self) -> None:
        for key in self.changed:
            if self.now[key] is not None:
                self.state.updateValue(key, self.now[key])
            elif self.state.containsKey(key):
                self.state.removeKey(key)


class _Orders:
    """Live orders (price, rest) by side and number; a run of numbers is one entry of the state, so that a call to the state serves many orders."""

    def __init__(self, state):
        self.runs, self.now, self.changed = _Entries(state), {}, set()

    def run(self, side: str, no: int) -> dict[int, tuple[int, int]]:
        key = (side, no >> _ORDERS)
        if key not in self.now:
            packed = self.runs.get(key)
            self.now[key] = {n: (p, q) for n, p, q in np.frombuffer(packed[0], np.int64).reshape(-1, 3).tolist()} if packed else {}
        return self.now[key]

    def get(self, side: str, no: int) -> tuple[int, int] | None:
        return self.run(side, no).get(no)

    def put(self, side: str, no: int, value: tuple[int, int] | None) -> None:
        run = self.run(side, no)
        self.changed.add((side, no >> _ORDERS))
        if value is None:
            run.pop(no, None)
        else:
            run[no] = value

    def flush(self) -> None:
        for key in self.changed:
            rows = [(n, *v) for n, v in self.now[key].items()]
            self.runs.put(key, (np.array(rows, np.int64).tobytes(),) if rows else None)
        self.runs.flush()


_HELD_ROW = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64()}[t]) for n, t in (c.split() for c in f"seq bigint, {_ROW}".split(", "))])


class _Held:
    """Rows that wait, by number: each run of numbers is one entry of the state, read and written once a call."""

    def __init__(self, state, some: int):
        self.state, self.now, self.changed = state, {}, set()
        self.keys = {k for (k,) in state.keys()} if some else set()

    def get(self, run: int) -> pa.Table:
        if run not in self.now:
            self.now[run] = pa.ipc.open_stream(self.state.getValue((run,))[0]).read_all() if run in self.keys else _HELD_ROW.empty_table()
        return self.now[run]

    def put(self, run: int, rows: pa.Table) -> None:
        self.now[run] = rows
        self.changed.add(run)
        (self.keys.add if rows.num_rows else self.keys.discard)(run)

    def first(self) -> tuple[int, int] | None:
        """The first number that waits, and its row's time."""
        if not self.keys:
            return None
        rows = self.get(min(self.keys))
        return rows["seq"][0].as_py(), rows["quote_ms"][0].as_py() or 0

    def flush(self) -> None:
        for run in self.changed:
            if (rows := self.now[run]).num_rows:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema) as w:
                    w.write_table(rows.combine_chunks())
                self.state.updateValue((run,), (sink.getvalue().to_pybytes(),))
            elif self.state.containsKey((run,)):
                self.state.removeKey((run,))


class _Gate(StatefulProcessor):
    """State of a channel: the next number, how many rows wait, and which number is waited for until when; and the rows that wait."""

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "next bigint, held bigint, missing bigint, until bigint")
        self.held = handle.getMapState("held", "run bigint", "rows binary")

    def _at(self) -> tuple[int, int, int | None, int | None]:
        return self.place.get() if self.place.exists() else (1, 0, None, None)

    def _passed(self, key: tuple, clock: int, what: str, rows: pa.Table) -> pd.DataFrame:
        # what is passed on is as late as the watermark at most, however long it has waited
        out = rows.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        out["released"] = pd.to_datetime(np.maximum(rows["quote_ms"].fill_null(0).to_numpy(), clock + 1), unit="ms")
        out[["market", "trading_day", "channel"]] = key
        return out.assign(what=what, upto=pd.array([None] * len(out), "Int64"))[_names(_PASSED)]

    def _lost(self, key: tuple, clock: int, gaps: list[tuple[int, int]]) -> pd.DataFrame:
        at = pd.Timestamp(max(0, clock + 1), unit="ms")
        return _frame([(*key, "gap", first, upto, *(None,) * len(_FIELDS), at) for first, upto in gaps], _PASSED)

    def _fresh(self, rows: Iterator[pd.DataFrame], at: int, held: _Held) -> tuple[pa.Table, pa.Table]:
        """Rows whose number is there for the first time, in order, put among those that wait; and the late ones."""
        tables = [pa.Table.from_pandas(b[_HELD_ROW.names], _HELD_ROW, preserve_index=False) for b in rows]
        new = pa.concat_tables(tables) if tables else _HELD_ROW.empty_table()
        order = np.argsort(new["seq"].to_numpy(), kind="stable")
        new = new.take(order)
        seq = new["seq"].to_numpy()
        late = seq < at
        late[1:] |= seq[1:] == seq[:-1]
        for run in sorted(held.keys & set(np.unique(seq >> _HELD).tolist())):
            a, b = np.searchsorted(seq, (run << _HELD, (run + 1) << _HELD))
            late[a:b] |= np.isin(seq[a:b], held.get(run)["seq"].to_numpy())
        return new.filter(pa.array(~late)), new.filter(pa.array(late))

    def _waits(self, fresh: pa.Table, held: _Held) -> None:
        seq = fresh["seq"].to_numpy()
        for run in np.unique(seq >> _HELD).tolist():
            a, b = np.searchsorted(seq, (run << _HELD, (run + 1) << _HELD)).tolist()
            both = pa.concat_tables([held.get(run), fresh.slice(a, b - a)])
            held.put(run, both.take(np.argsort(both["seq"].to_numpy())) if both.num_rows > b - a else both)

    def _drained(self, at: int, held: _Held, out: list[pa.Table]) -> int:
        """Pass on all rows from the next number on that follow one another; the next number then."""
        while (run := at >> _HELD) in held.keys:
            rows = held.get(run)
            seq = rows["seq"].to_numpy()
            n = int(np.argmin(np.append(seq == at + np.arange(len(seq)), False)))
            if not n:
                return at
            out.append(rows.slice(0, n))
            held.put(run, rows.slice(n))
            at += n
        return at

    def _given_up(self, clock: int, at: int, held: _Held, out: list[pa.Table], gaps: list[tuple[int, int]]) -> int:
        """Note numbers that rows have waited for too long, and pass these rows on; the next number then."""
        while (first := held.first()) is not None and first[1] + self.gap_ms <= clock:
            gaps.append((at, first[0] - 1))
            at = self._drained(first[0], held, out)
        return at

    def _kept(self, at: int, count: int, held: _Held, missing: int | None, until: int | None) -> None:
        """Keep the place, and a timer for the number that is missing now."""
        if missing is not None and (not count or missing != at):
            self.handle.deleteTimer(until)
            missing = until = None
        if count and missing is None:
            missing, until = at, held.first()[1] + self.gap_ms
            self.handle.registerTimer(until)
        held.flush()
        self.place.update((at, count, missing, until))

    def _told(self, key: tuple, clock: int, out: list[pa.Table], gaps: list[tuple[int, int]]) -> Iterator[pd.DataFrame]:
        if gaps:
            yield self._lost(key, clock, gaps)
        if out:
            rows = pa.concat_tables(out)
            # status rows count, and do no more
            rows = rows.filter(pc.fill_null(pc.not_equal(rows["kind"], "S"), True))
            for i in range(0, rows.num_rows, _BATCH):
                yield self._passed(key, clock, "row", rows.slice(i, _BATCH))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        clock, (at, count, missing, until) = timerValues.getCurrentWatermarkInMs(), self._at()
        held, out, gaps = _Held(self.held, count), [], []
        fresh, late = self._fresh(rows, at, held)
        self._waits(fresh, held)
        at = self._given_up(clock, self._drained(at, held, out), held, out, gaps)
        self._kept(at, count + fresh.num_rows - sum(t.num_rows for t in out), held, missing, until)
        if late.num_rows:
            yield self._passed(key, clock, "late", late)
        yield from self._told(key, clock, out, gaps)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        clock, (at, count, missing, until) = timerValues.getCurrentWatermarkInMs(), self._at()
        held, out, gaps = _Held(self.held, count), [], []
        at = self._given_up(clock, at, held, out, gaps)
        # the timer that is running out is gone already
        gone = expiredTimerInfo.getExpiryTimeInMs() == until
        self._kept(at, count - sum(t.num_rows for t in out), held, None if gone else missing, None if gone else until)
        yield from self._told(key, clock, out, gaps)

    def close(self) -> None:
        pass


class _Book(StatefulProcessor):
    """State of a book: live orders and levels, statistics, the latest time and the next boundary."""

    def __init__(self, step_ms: int | None, until_ms: int | None, gap_ms: int):
        self.step_ms, self.until_ms, self.gap_ms = step_ms, until_ms, gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.orders = handle.getMapState("orders", "side string, run bigint", "orders binary")
        self.levels = handle.getMapState("levels", "side string, price bigint", "quantity bigint, orders bigint")
        self.stats = handle.getValueState("stats", "volume bigint, trades bigint, high bigint, bound bigint, seq bigint")

    def _stats(self) -> tuple[int, int, int | None, int | None, int]:
        return self.stats.get() if self.stats.exists() else (0, 0, None, None, 0)

    def _timed(self, was: int | None, bound: int | None) -> None:
        """Move the timer from one boundary to another. It waits as long as the gate may, whose rows could still count."""
        if was != bound:
            for at, change in ((was, self.handle.deleteTimer), (bound, self.handle.registerTimer)):
                if at is not None and at <= (self.until_ms or 0):
                    change(at + self.gap_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        orders, levels = _Orders(self.orders), _Entries(self.levels)
        volume, trades, high, bound, last = self._stats()
        was, out = bound, []
        tell = lambda what, seq, side=None, price=None, q=None, n=None, ms=None, upto=None, channel=None: out.append((*key, what, seq, upto, channel, side, price, q, n, ms, volume, trades))

        def move(side, price, q, n, seq, ms) -> None:
            old = levels.get((side, price)) or (0, 0)
            new = (old[0] + q, old[1] + n)
            levels.put((side, price), new if new[1] else None)
            tell("level", seq, side, price, *new, ms)

        # the gate passes rows on in order, so that this batch's come after all before it; within it the shuffle may have mixed them
        mine = pd.concat(list(rows)).sort_values("seq", kind="stable")
        names = ["seq", "what", "upto", "channel", *_FIELDS[1:]]
        for seq, what, upto, channel, kind, bid, ask, price, qty, ms in (r for i in range(0, len(mine), _BATCH) for r in _plain(mine.iloc[i : i + _BATCH], names)):
            if len(out) >= _BATCH:
                yield _frame(out, _OUT)
                out.clear()
            if what != "row":
                tell(what, seq, ms=ms, upto=upto, channel=channel)
                continue
            if high is not None and ms < high:
                tell("time", seq, ms=ms)
            if self.step_ms:
                bound = (ms // self.step_ms + 1) * self.step_ms if bound is None else bound
                while bound <= ms:
                    tell("snapshot", seq, ms=bound)
                    bound += self.step_ms
            if kind == "T":
                volume, trades = volume + qty, trades + 1
            high, last = max(ms, high or ms), seq
            for side, no in (("B", bid), ("S", ask)):
                if not no:
                    continue
                if kind == "A":
                    orders.put(side, no, (price, qty))
                    move(side, price, qty, 1, seq, ms)
                elif (o := orders.get(side, no)) is not None:
                    q = o[1] if kind == "C" else min(o[1], qty)
                    orders.put(side, no, (o[0], o[1] - q) if q < o[1] else None)
                    move(side, o[0], -q, -int(q == o[1]), seq, ms)
        orders.flush()
        levels.flush()
        if high is not None:
            self._timed(was, bound)
            self.stats.update((volume, trades, high, bound, last))
        if out:
            yield _frame(out, _OUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Boundaries that the watermark has passed, with nothing after them yet."""
        volume, trades, high, bound, last = self._stats()
        clock, out = timerValues.getCurrentWatermarkInMs(), []
        if bound is None or expiredTimerInfo.getExpiryTimeInMs() != bound + self.gap_ms:
            return
        while bound <= self.until_ms and bound + self.gap_ms <= clock:
            out.append((*key, "snapshot", last, None, None, None, None, None, None, bound, volume, trades))
            bound += self.step_ms
        if bound <= self.until_ms:
            self.handle.registerTimer(bound + self.gap_ms)
        self.stats.update((volume, trades, high, bound, last))
        yield _frame(out, _OUT)

    def close(self) -> None:
        pass


def incremental_books(events: DataFrame, step_ms: int | None = None, until_ms: int | None = None, late: str = "1 minute", gap_ms: int = 5_000) -> DataFrame:
    """Stream of rows: `level` (a level's totals after an event), `snapshot` (statistics before a boundary, up to until_ms), `late` (a number already passed on, or there twice), `gap` (numbers seq to upto never came) and `time` (a quote time behind the latest one).

    events: a streaming DataFrame of canonical events whose seq is dense from 1 on each channel, as a channel's rows are
    before any are left out; they may arrive in any order. Rows of kind S change no book, but count and move the watermark on,
    which is `late` behind the latest quote time of all channels; what comes still later is dropped by Spark and becomes a gap. A
    missing number is given up once the watermark is gap_ms past the first row that waits for it, and boundaries that no
    event passes are told gap_ms after them. The state is in RocksDB: rows that wait by runs of numbers, orders by runs of
    order numbers, and levels; the gate does no more than pass rows on, the books are spread over all tasks.
    """
    if events.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass") != STORE:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {STORE}")
    narrow = events.select("market", "trading_day", "channel", "seq", *_FIELDS, F.timestamp_millis("quote_ms").alias("ts")).withWatermark("ts", late)
    passed = narrow.groupBy("market", "trading_day", "channel").transformWithStateInPandas(_Gate(gap_ms), outputStructType=_PASSED, outputMode="Append", timeMode="EventTime", eventTimeColumnName="released")
    keyed = passed.withColumn("symbol", F.coalesce("symbol", F.lit("")))
    return keyed.groupBy("market", "trading_day", "symbol").transformWithStateInPandas(_Book(step_ms, until_ms, gap_ms), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")


def trade_windows(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Trades, volume, and high and low price per symbol and tumbling window; events: streaming, with ts. A row of any kind moves the watermark on, `late` behind the latest ts."""
    price, qty = (F.when(F.col("kind") == "T", F.col(c)) for c in ("price", "qty"))
    t = events.withWatermark("ts", late).groupBy("market", "symbol", F.window("ts", width).alias("w"))
    # no filter before: it would go below the watermark, which then saw trades alone
    sums = t.agg(F.count_if(F.col("kind") == "T").alias("trades"), F.sum(qty).alias("volume"), F.max(price).alias("high_price"), F.min(price).alias("low_price")).filter("trades > 0")
    return sums.select("market", "symbol", F.col("w.start").alias("window_start"), "trades", "volume", "high_price", "low_price")
