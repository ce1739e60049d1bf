"""The gate and the books, batch by batch: order, gaps, late rows, boundaries by the clock."""

import pandas as pd
import pytest
from test_books import add, cancel, make, trade

from bookweave.plans import special
from bookweave.streaming import books


@pytest.fixture
def told(spark, tmp_path):
    """Runs batches of rows through the stream, one file a batch, and gives all rows that were told in order."""

    def run(batches, **options):
        before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", books.STORE)
        source, schema = str(tmp_path / "in"), make(spark, []).schema
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
        query = books.incremental_books(stream, late="1 second", gap_ms=2_000, **options).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True)
        try:
            for i, rows in enumerate(batches):
                make(spark, rows).coalesce(1).write.parquet(f"{source}/{i}")
                query.start().awaitTermination()
        finally:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
        return [r.asDict() for r in spark.read.parquet(str(tmp_path / "out")).collect()]

    return run


def clock(ms, seq=1):
    return {"seq": seq, "kind": "S", "channel": 0, "symbol": "", "quote_ms": ms}


def test_rows_wait_for_their_turn(told):
    """The trade comes first, its order twice; nothing is applied before its number is there, and the repeat is told."""
    out = told([[trade(2, 1, None, 100, 30, 20)], [add(1, "B", 1, 100, 50, ms=10)], [add(1, "B", 1, 100, 50, ms=10), cancel(3, "B", 1, 20, 30)]])
    levels = sorted((r["seq"], r["quantity"], r["order_count"]) for r in out if r["what"] == "level")
    assert levels == [(1, 50, 1), (2, 20, 1), (3, 0, 0)] and [r["seq"] for r in out if r["what"] == "late"] == [1]


def test_a_lost_number_is_given_up(told):
    """Number 2 never comes in time: it is told once the watermark is far enough, what waited is applied, and when it comes it is late."""
    rows = [[add(1, "B", 1, 100, 50, ms=1_000), add(3, "B", 3, 100, 10, ms=2_000)], [add(4, "B", 4, 101, 5, ms=2_500)], [clock(9_000)], [add(2, "S", 2, 200, 7, ms=9_100), add(6, "B", 6, 99, 1, ms=9_200)]]
    out = told(rows)
    assert [(r["channel"], r["seq"], r["upto"]) for r in out if r["what"] == "gap"] == [(1, 2, 2)]
    assert sorted((r["seq"], r["price"]) for r in out if r["what"] == "level") == [(1, 100), (3, 100), (4, 101)]
    assert [(r["seq"], r["symbol"]) for r in out if r["what"] == "late"] == [(2, "000001")]


def test_gaps_one_behind_another(told):
    """Several gaps of one channel are given up together when the clock jumps, in order."""
    out = told([[add(n, "B", n, 100 + n, 1, ms=1_000 + n) for n in (2, 5, 6, 9)], [clock(50_000)]])
    assert sorted((r["seq"], r["upto"]) for r in out if r["what"] == "gap") == [(1, 1), (3, 4), (7, 8)]
    assert sorted(r["seq"] for r in out if r["what"] == "level") == [2, 5, 6, 9]


def test_boundaries_by_the_clock(told):
    """Boundaries are told by an event that passes them or by the watermark, once each, with what came before them."""
    rows = [[add(1, "B", 1, 100, 50, ms=500), add(2, "S", 2, 100, 50, ms=600), trade(3, 1, 2, 100, 20, 700)], [clock(4_500)], [trade(4, 1, 2, 100, 5, 5_200), clock(30_000, 2)]]
    out = told(rows, step_ms=1_000, until_ms=8_000)
    snaps = sorted((r["at_ms"], r["volume"], r["trades"]) for r in out if r["what"] == "snapshot")
    assert snaps == [(1_000 * k, 20 if k <= 5 else 25, 1 if k <= 5 else 2) for k in range(1, 9)]


def test_store_is_asked_for(spark):
    with pytest.raises(ValueError, match="stateStore"):
        books.incremental_books(spark.readStream.format("rate").load())


class _Counted:
    """A map state that counts the calls it gets."""

    def __init__(self):
        self.rows, self.calls = {}, 0

    def _call(self, f):
        self.calls += 1
        return f()

    def containsKey(self, k):
        return self._call(lambda: k in self.rows)

    def getValue(self, k):
        return self._call(lambda: self.rows[k])

    def updateValue(self, k, v):
        self._call(lambda: self.rows.update({k: v}))

    def removeKey(self, k):
        self._call(lambda: self.rows.pop(k))

    def keys(self):
        return self._call(lambda: iter(list(self.rows)))


class _Handle:
    def __init__(self):
        self.maps, self.place, self.timers = {}, None, []

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, _Counted())

    def getValueState(self, *_):
        handle = self

        class Value:
            exists = staticmethod(lambda: handle.place is not None)
            get = staticmethod(lambda: handle.place)
            update = staticmethod(lambda v: setattr(handle, "place", v))

        return Value()

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class _Clock:
    def __init__(self, at=0):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: at


def _rows(numbers):
    numbers = list(numbers)
    return pd.DataFrame({"seq": numbers, "symbol": "000001", "kind": "A", "bid_no": numbers, "ask_no": float("nan"), "price": 100, "qty": 1, "quote_ms": 1_000})


def test_state_is_asked_by_runs():
    """Ten thousand rows that wait, and as many orders, are some dozen calls to the state, not one or more each; a row's number that waits is late when it comes again."""
    handle, gate = _Handle(), books._Gate(2_000)
    gate.init(handle)
    give = lambda *frames: pd.concat([pd.DataFrame(columns=["what"]), *gate.handleInputRows(("SZ", 1, 1), iter(frames), _Clock())])
    assert len(give(_rows(reversed(range(5_002, 10_001))), _rows(range(2, 5_001)))) == 0 and handle.place == (1, 9_998, 1, 3_000)
    assert give(_rows([7, 7])).what.tolist() == ["late", "late"]
    out = give(_rows([1]))
    assert out.seq.tolist() == list(range(1, 5_001)) and set(out.what) == {"row"} and handle.place == (5_001, 4_999, 5_001, 3_000)
    out = pd.concat(gate.handleExpiredTimer(("SZ", 1, 1), _Clock(3_000), _Clock(3_000)))
    assert out.iloc[0][["what", "seq", "upto"]].tolist() == ["gap", 5_001, 5_001] and out[out.what == "row"].seq.tolist() == list(range(5_002, 10_001)) and handle.place == (10_001, 0, None, None)
    orders = books._Orders(state := _Counted())
    for n in range(1, 10_001):
        orders.put("B", n, (100, n))
    orders.flush()
    again = books._Orders(state)
    assert again.get("B", 4_096) == (100, 4_096) and again.get("S", 1) is None
    assert handle.maps["held"].calls + state.calls < 60


def test_all_repeats_are_told(spark):
    """Every hundredth row of the whole feed comes twice, those of the first days among them."""
    sf = "/root/testdata/sf0.001"
    told = special.stream_late(spark, sf).agg({"rows": "sum"}).first()[0]
    assert told == special._numbered(spark, sf).filter("seq % 100 = 0").count() > 0
