"""Faulty days and files are refused, or books end where they break a rule; days are told apart."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_books import make
from test_sources import DAY, SH, put, sh_rows

from bookweave import market_day
from bookweave.operators import faults, ledger
from bookweave.plans import audits, days
from bookweave.sources import vendor

SF = "/root/testdata/sf0.001"


def test_a_good_file_is_replayed(spark, tmp_path):
    put(tmp_path, "mdl_4_24_0", "SH", SH, sh_rows())
    day = market_day.replay_day(spark, str(tmp_path), "SH", [DAY], step_ms=3_600_000)
    assert day.snapshots.filter("kind = 'market_close'").count() == 1 and day.violations.count() == 0


@pytest.mark.parametrize("what", ["type", "footer", "missing"])
def test_a_faulty_file_is_refused(spark, tmp_path, what):
    """Before any row is read: the rows of these files would break rules too."""
    if what == "type":
        schema = [(n, pa.int32() if n == "Qty" else t) for n, t in SH]
        put(tmp_path, "mdl_4_24_0", "SH", schema, [])
    elif what == "footer":
        put(tmp_path, "mdl_4_24_0", "SZ", SH, [])
    days_ = [DAY] if what == "missing" else None
    with pytest.raises(vendor.FaultyFile, match={"type": "Qty is int32, not int64", "footer": "clara.raw.market is SZ, not SH", "missing": "no such file"}[what]):
        market_day.replay_day(spark, str(tmp_path), "SH", days_)


def test_a_faulty_day_is_refused(spark, tmp_path):
    """The first fault by channel and number is told; nothing is sampled."""
    e = days.vendor_events(spark, SF, "SZ")
    n = F.floor(F.col("seq") / 20)
    days.write_ticks(e.withColumn("qty", F.when((F.col("kind") == "C") & (n % 50 == 0), F.col("qty") + 1).otherwise(F.col("qty"))), str(tmp_path), "SZ")
    with pytest.raises(faults.FaultyDay, match="code cancel_quantity"):
        market_day.replay_day(spark, str(tmp_path), "SZ", step_ms=days.STEP, check_files=False)
    cut = market_day.replay_day(spark, str(tmp_path), "SZ", step_ms=days.STEP, check_files=False, on_fault="cut")
    kept = market_day.replay_day(spark, str(tmp_path), "SZ", step_ms=days.STEP, check_files=False, on_fault="keep")
    assert 0 < cut.snapshots.count() < kept.snapshots.count() == e.select("symbol").distinct().count() * 52
    with pytest.raises(ValueError, match="on_fault"):
        market_day.replay_day(spark, str(tmp_path), "SZ", on_fault="ignore")


def test_where_books_end(spark):
    """A book's own first fault, its channel's, and a fault without a number, which leaves nothing."""
    rows = [{"seq": s, "kind": "A", "side": "B", "bid_no": s, "price": 100, "qty": 1, "quote_ms": s * 10, "symbol": x, "channel": c} for s, x, c in [(1, "000001", 1), (2, "000002", 1), (3, "000001", 1), (4, "000002", 1), (5, "000003", 2), (6, "000004", 3), (7, "000001", 1)]]
    events = make(spark, rows)
    wrong = [("000001", 1, 7, "late"), ("000001", 1, 3, "early"), (None, 1, 4, "shared"), ("000004", 3, None, "whole")]
    v = spark.createDataFrame([("SZ", 20260828, *w) for w in wrong], "market string, trading_day int, symbol string, channel int, seq long, code string")
    ends = faults.book_ends(v, events, events)
    assert sorted((r.symbol, r.end_seq, r.code, r.end_ms) for r in ends.collect()) == [("000001", 3, "early", 30), ("000002", 4, "shared", 40), ("000004", 0, "whole", 0)]
    assert sorted(r.seq for r in faults.before_end(events, ends).collect()) == [1, 2, 5]
    assert faults.refuse(v.filter("false")) is None
    with pytest.raises(faults.FaultyDay, match="seq 3, code early"):
        faults.refuse(v.filter("channel = 1"))
    assert ledger.first_violations(v.filter("channel = 1"), ["market"]).first().code == "early"


def test_planted_faults_are_there(spark):
    """The queries' inputs hold what they are about."""
    cut = audits.cut_books(spark, SF).collect()
    assert any(r.scheduled < 51 and r.closes == 0 for r in cut) and any(r.closes == 1 for r in cut)
    r = audits.replay_report(spark, SF).first()
    assert r.after_close_events and r.late and r.repaired_streams and r.runs > r.repaired_streams and r.unselected
