import decimal
import hashlib
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bookweave.operators import book, integrity, ledger, reference, snapshots
from bookweave.schema import BOOK
from bookweave.sources import sinks, vendor

D = decimal.Decimal
DAY = 20260828
#: Footer entries of the format, and (below) columns and types of its feeds.
META = {**vendor.FOOTER, "clara.raw.schema_hash": "h", "clara.raw.date": str(DAY)}


def put(root, feed, market, schema, rows):
    path = vendor.feed_path(str(root), DAY, feed)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    meta = {**META, "clara.raw.market": market, "clara.raw.feed": feed, "clara.raw.schema_id": vendor.SCHEMA_ID.format(market=market, feed=feed)}
    s = pa.schema(schema).with_metadata(meta)
    pq.write_table(pa.Table.from_pylist([dict(zip([n for n, _ in schema], r, strict=True)) for r in rows], schema=s), path)
    return path


SH = [("BizIndex", pa.uint64()), ("Channel", pa.uint64()), ("SecurityID", pa.large_string()), ("TickTime", pa.large_string()), ("Type", pa.large_string()), ("BuyOrderNO", pa.uint64()), ("SellOrderNO", pa.uint64()),
      ("Price", pa.decimal128(38, 3)), ("Qty", pa.int64()), ("TickBSFlag", pa.large_string()), ("LocalTime", pa.large_string()), ("source_row_no", pa.uint64())]


def sh_rows():
    rows = [(1, "600000", "09:20:00.000", "A", 1, 0, 10000, 100, "B"), (2, "510300", "09:30:00.000", "A", 2, 0, 1000, 1, "B"), (3, "600000", "10:15:00.000", "A", 0, 3, 11000, 200, "S"),
            (4, "600000", "14:00:00.000", "T", 1, 3, 10500, 40, "N"), (5, "600000", "14:30:00.000", "D", 1, 0, 0, 60, "B"), (6, "600000", "15:00:01.000", "S", 0, 0, 0, 0, "CLOSE")]
    return [(b, 1, s, t, k, x, y, D(p) / 1000, q, f, "09:00:00.000", i) for i, (b, s, t, k, x, y, p, q, f) in enumerate(rows)]


def test_shanghai_day(spark, tmp_path):
    path = put(tmp_path, "mdl_4_24_0", "SH", SH, sh_rows())
    ticks = vendor.read_sh_ticks(spark, str(tmp_path), [DAY])
    assert vendor.violations(ticks).count() == 0
    c = integrity.run_counters(ticks, "stocks").first()
    assert (c.input_rows, c.selected, c.unselected, c.applied, c.status_rows) == (6, 5, 1, 4, 1)
    mine = ticks.filter("symbol = '600000'")
    led = ledger.ledger(mine)
    assert ledger.reference_violations(mine, led).count() == 0
    changes = book.deltas(led)
    grid = {r.boundary_ms: r for r in snapshots.grid_snapshots(mine, changes, 3_600_000).collect()}
    times = sorted(grid)
    assert len(times) == 4
    # a snapshot holds what came strictly before it
    assert grid[times[0]].asks == [] and grid[times[1]].asks[0].price == 110_000
    close = snapshots.close_snapshots(mine, changes).first()
    assert close.ask_total == 160 and close.bid_total == 0 and close.boundary_ms == times[3] + 1000
    files = spark.createDataFrame([(path, "SH", "mdl_4_24_0")], "path string, market string, feed string")
    assert vendor.check_footers(spark, files).filter("not ok").count() == 0
    sha = hashlib.sha256(str(pq.ParquetFile(path).schema_arrow.remove_metadata()).encode()).hexdigest()
    known = "path string, market string, feed string, date string, bytes long, rows long, schema_sha256 string"
    inv = spark.createDataFrame([(path, "SH", "mdl_4_24_0", str(DAY), os.path.getsize(path), 6, sha), (path + "x", "SH", "mdl_4_24_0", str(DAY), 1, 1, sha)], known)
    assert [(r.check, r.ok) for r in vendor.inventory_check(spark, inv).filter("NOT ok").collect()] == [("exists", False)]
    wrong = spark.createDataFrame([(path, "SZ", "mdl_6_33_0", "20260829", 7, 5, "0")], known)
    assert {r.check for r in vendor.inventory_check(spark, wrong).filter("NOT ok").collect()} == {"market", "feed", "date", "bytes", "rows", "schema_sha256", "schema_id"}
    assert vendor.check_types(spark, files).count() == 0
    assert {r.column for r in vendor.check_types(spark, files.withColumn("feed", F.lit("mdl_6_33_0"))).collect()} == {"ChannelNo", "ApplSeqNum", "OrderQty", "Side", "TransactTime", "OrdType", "Price"}
    raw = spark.read.parquet(path)
    assert vendor.check_schema(raw, vendor.FEEDS["sh_ticks"][1]) == []
    assert vendor.check_schema(raw.drop("Qty"), vendor.FEEDS["sh_ticks"][1]) == [("Qty", "bigint", "missing")]
    wide = sinks.wide_snapshots(snapshots.grid_snapshots(mine, changes, 3_600_000).withColumns({"channel": F.lit(1), "kind": F.lit("scheduled")}))
    row = wide.orderBy("boundary_time").collect()[1]
    assert row.ask_price_1 == D("11.0000") and row.ask_price_2 is None and row.bid_qty_1 == 100
    out = str(tmp_path / "out")
    sinks.write_snapshots(snapshots.grid_snapshots(mine, changes, 3_600_000).withColumns({"channel": F.lit(1), "kind": F.lit("scheduled")}), out)
    assert spark.read.parquet(out).count() == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        vendor.read_sh_ticks(spark, str(tmp_path), [20260829]).count()


def test_shanghai_faults(spark, tmp_path):
    rows = sh_rows()
    rows[0] = (*rows[0][:3], "09:20", *rows[0][4:])
    rows[2] = (rows[2][0], 1, " ", rows[2][3], "A", 0, 3, D(0), 200, "S", "", 2)
    put(tmp_path, "mdl_4_24_0", "SH", SH, rows)
    got = {(r.seq, r.code) for r in vendor.violations(vendor.read_sh_ticks(spark, str(tmp_path))).collect()}
    assert got == {(1, "time"), (3, "symbol"), (3, "price"), (3, "local_time")}


SZO = [("ChannelNo", pa.int32()), ("ApplSeqNum", pa.int64()), ("SecurityID", pa.large_string()), ("Price", pa.decimal128(38, 4)), ("OrderQty", pa.int64()), ("Side", pa.int32()), ("TransactTime", pa.large_string()), ("OrdType", pa.int32()), ("LocalTime", pa.large_string()), ("source_row_no", pa.uint64())]
SZE = [("ChannelNo", pa.int32()), ("ApplSeqNum", pa.int64()), ("BidApplSeqNum", pa.int64()), ("OfferApplSeqNum", pa.int64()), ("SecurityID", pa.large_string()), ("LastPx", pa.decimal128(38, 4)), ("LastQty", pa.int64()), ("ExecType", pa.int32()), ("TransactTime", pa.large_string()), ("LocalTime", pa.large_string()), ("source_row_no", pa.uint64())]


def test_shenzhen_day(spark, tmp_path):
    put(tmp_path, "mdl_6_33_0", "SZ", SZO, [(1, 1, "000001", D(10), 100, 49, "09:20:00.000", 50, "x", 0), (1, 2, "000001", D(11), 200, 50, "09:21:00.000", 50, "x", 1)])
    put(tmp_path, "mdl_6_36_0", "SZ", SZE, [(1, 3, 1, 2, "000001", D("10.5"), 40, 70, "09:30:00.000", "x", 0), (1, 4, 1, 0, "000001", D(0), 60, 52, "09:31:00.000", "x", 1)])
    e = vendor.read_sz(spark, str(tmp_path))
    assert vendor.violations(e).count() == 0
    led = ledger.ledger(e)
    assert ledger.reference_violations(e, led).count() == 0
    assert integrity.duplicate_sequences(e.filter("stream = 'orders'"), e.filter("stream = 'executions'")).count() == 0
    close = snapshots.close_snapshots(e, book.deltas(led)).first()
    assert close.bids == [] and close.asks[0].quantity == 160 and close.last_price == 105_000
    wrong = e.withColumn("qty", F.when(F.col("kind") == "C", 59).otherwise(F.col("qty")).cast("bigint"))
    assert [r.code for r in ledger.reference_violations(wrong, ledger.ledger(wrong)).collect()] == ["cancel_quantity"]
    runs = integrity.natural_runs(e.filter("stream = 'orders'").withColumn("source_row", -F.col("source_row")), [*BOOK, "channel"]).first()
    assert (runs.rows, runs.runs, runs.duplicates) == (2, 2, 0)
    assert book.book_summary(e, led).first().active_orders == 1


def test_reference_frames(spark, tmp_path):
    names = [("SecurityID", pa.large_string()), ("UpdateTime", pa.large_string()), ("source_row_no", pa.uint64()), ("TradingPhaseCode", pa.large_string()), ("LocalTime", pa.large_string()), ("SeqNo", pa.int64())]
    names += [(n, pa.decimal128(38, 6)) for n in ("LastPrice", "HighPrice", "LowPrice", "WeightedAvgBidPx", "WeightedAvgOfferPx")] + [("Turnover", pa.decimal128(38, 4)), ("TurnNum", pa.uint32())]
    names += [(n, pa.int64()) for n in ("Volume", "TotalBidQty", "TotalOfferQty")] + [("PreCloPrice", pa.decimal128(38, 4))]
    for i in range(1, 11):
        for w, c in (("Ask", "NumOrdersS"), ("Bid", "NumOrdersB")):
            names += [(f"{w}Price{i}", pa.decimal128(38, 6)), (f"{w}Volume{i}", pa.int64()), (f"{c}{i}", pa.uint32())]
    base = {"SecurityID": "000001", "UpdateTime": "15:00:00.000", "TradingPhaseCode": "E0", "LastPrice": D("10.5"), "HighPrice": D("1234.5649"), "LowPrice": D(0), "Turnover": D(420), "TurnNum": 1, "Volume": 40, "TotalBidQty": 0, "TotalOfferQty": 160,
            "WeightedAvgOfferPx": D(11), "AskPrice1": D(11), "AskVolume1": 160, "NumOrdersS1": 1}
    rows = [{**base, "source_row_no": 0}, {**base, "source_row_no": 1, "BidPrice3": D(9)}, {**base, "source_row_no": 2, "LowPrice": D(-1)}]
    put(tmp_path, "mdl_6_28_0", "SZ", names, [tuple(r.get(n) for n, _ in names) for r in rows])
    path = vendor.feed_path(str(tmp_path), DAY, "mdl_6_28_0")
    files = spark.createDataFrame([(path, "SZ", "mdl_6_28_0")], "path string, market string, feed string")
    assert vendor.check_schema(spark.read.parquet(path), vendor.snapshot_contract("SZ")) == [] and vendor.check_types(spark, files).count() == 0
    got = vendor.read_reference(spark, str(tmp_path), "SZ").orderBy("source_row").collect()
    assert got[0].load_error == [] and got[0].asks[0].price == 110_000 and got[0].bids == [] and got[0].high_price == 12_345_649 and got[0].low_price is None
    assert got[0].turnover == 4_200_000 and got[0].missing_reception and got[0].high_limit is None
    assert got[1].load_error == ["bids"] and got[2].load_error == ["low_price"]
    assert [r.file_row for r in got] == [0, 1, 2]


def test_frames_keep_the_order_of_their_file(spark):
    """A number or time that falls is seen where the frame stands, not where its number would put it."""
    rows = [("SZ", DAY, "000001", f, i, n, t) for f, i, n, t in [("a", 0, 1, 10), ("a", 1, 5, 10), ("a", 2, 3, 20), ("a", 3, 6, 15), ("b", 0, 6, 20), ("b", 1, 7, 20)]]
    f = spark.createDataFrame(rows, "market string, trading_day int, symbol string, file_name string, file_row long, source_row long, quote_ms long")
    found = [(r.source_row, r.quote_ms, r.previous_ms, r.previous_row) for r in reference.position_faults(f).orderBy("source_row", "quote_ms").collect()]
    assert found == [(3, 20, 10, 5), (6, 15, 20, 3), (6, 20, 15, 6)]
    assert reference.position_faults(f, ("source_row", "quote_ms")).count() == 2


def test_report_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("SH", 3)], "market string, n long")
    sinks.write_report(df, str(tmp_path / "r"))
    assert sinks.read_report(spark, str(tmp_path / "r"), "market string, n long").collect() == df.collect()
    df.withColumn("schema_version", F.lit(1)).write.json(str(tmp_path / "old"))
    with pytest.raises(ValueError, match="version"):
        sinks.read_report(spark, str(tmp_path / "old"), "market string, n long")
