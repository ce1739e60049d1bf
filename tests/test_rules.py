"""Numeric vectors, phase sequences, limits, windows and report rules."""

import random

import pytest
from pyspark.sql import functions as F

from bookweave.functions import scalars as S
from bookweave.operators import reference, reports, validation

DAY = 20260828
MIDNIGHT = 1_787_875_200_000 - 28_800_000  # 2026-08-28 at UTC+8


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def L(v, kind="bigint"):
    return F.lit(v).cast(kind)


def test_times(spark):
    good = {"00:00:00.000": 0, "09:30:00.001": 34_200_001, "23:59:60.999": 86_400_999}
    bad = ["", "09:30:00", "09:30:00.0000", "24:00:00.000", "09:60:00.000", "09:30:61.000", "aa:30:00.000", "09-30-00.000"]
    df = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string")
    got = {r.t: r.x for r in df.select("t", S.clock_ms(F.col("t")).alias("x")).collect()}
    assert got == {**good, **dict.fromkeys(bad)}
    assert one(spark, S.market_ts(L(DAY, "int"), F.lit("09:30:00.000"))) == MIDNIGHT + 34_200_000
    assert one(spark, S.time_of_day(L(MIDNIGHT + 5))) == 5
    days = {20240229: True, 20230229: False, 20241301: False, 99: False, 20260828: True}
    df = spark.createDataFrame([(d,) for d in days], "d int")
    assert {r.d: r.x for r in df.select("d", S.valid_day(F.col("d")).alias("x")).collect()} == days


def test_close_band(spark):
    want = {4400: (4000, 4800), 247_200: (222_500, 271_900), 1_769_900: (1_592_900, 1_946_900), 100: (100, 200), 400: (300, 500), 10_500: (9500, 11_600), 0: None, 101: None}
    df = spark.createDataFrame([(b,) for b in want], "b long")
    assert {r.b: tuple(r.x) if r.x else None for r in df.select("b", S.close_band(F.col("b")).alias("x")).collect()} == want


def test_turnover(spark):
    pairs = {135_011_623_292_600: 135_011_623_293_000, 41_026_830_961_490: 41_026_830_961_500, 18_414_873_243_130: 18_414_873_243_100, 1_234_567_890_125: 1_234_567_890_130, 9_999_999_999_995: 10_000_000_000_000}
    rows = [(a, e + d) for a, e in pairs.items() for d in (-1, 0, 1)]
    df = spark.createDataFrame(rows, "a long, e long")
    for r in df.select("a", "e", S.turnover_compat(F.lit(True), F.col("e"), F.col("a")).alias("x"), S.turnover_compat(F.lit(False), F.col("e"), F.col("a")).alias("y")).collect():
        assert r.x == (pairs[r.a] == r.e) and not r.y


def test_prices(spark):
    q = lambda m, k, p: one(spark, S.rounded(L(p), S.quantum(F.lit(m), F.lit(k))))
    assert q("SH", "stock", 89_086) == 89_090 and q("SZ", "stock", 113_222) == 113_200 and q("SZ", "etf", 997_194) == 997_190
    assert one(spark, S.weighted_price_q(L(69_274_900), L(1000), L(10))) == 69_270 and one(spark, S.weighted_price(L(1), L(0))) is None
    assert one(spark, S.rescaled(L(7994), 3)) == 79_940 and one(spark, S.rescaled(L(12_345_649), 6)) == 123_456 and one(spark, S.rescaled(L(12_345_650), 6)) == 123_457
    assert one(spark, S.ref_price(L(0), 3)) is None and one(spark, S.ref_price_error(L(-1))) and one(spark, S.ref_quantity(L(1500), "SH")) is None and one(spark, S.ref_quantity(L(2000), "SH")) == 2
    assert one(spark, S.ref_amount(L(0), 5)) == 0 and one(spark, S.ref_amount(L(None), 5)) is None
    assert one(spark, S.to_units(F.lit("1.234").cast("decimal(38,3)"), 3)) == 12_340
    with pytest.raises(ValueError, match="scale"):
        S.to_units(F.lit(1), 5)
    assert one(spark, S.weighted_match(L(5), L(15))) and not one(spark, S.weighted_match(L(5), L(16))) and one(spark, S.weighted_match(L(None), L(None))) and not one(spark, S.weighted_match(L(None), L(1)))


def test_closing_vwap(spark):
    t = lambda h, m, s, ms: MIDNIGHT + ((h * 60 + m) * 60 + s) * 1000 + ms
    rows = [("SZ", DAY, "000001", 1, "T", 10_000, 100, t(14, 54, 59, 999)), ("SZ", DAY, "000001", 2, "T", 10_020, 100, t(14, 55, 0, 0)), ("SZ", DAY, "000001", 3, "T", 10_040, 100, t(14, 56, 0, 0))]
    e = spark.createDataFrame(rows, "market string, trading_day int, symbol string, seq long, kind string, price long, qty long, quote_ms long")
    assert validation.closing_vwap(e, L(10)).first().close_price == 10_030 and validation.closing_vwap(e, L(100)).first().close_price == 10_000
    f = validation.closing_auction(e.withColumn("quote_ms", F.col("quote_ms") + 120_000)).first()
    assert f.auction_trade and f.base_seq == 1


def frames(spark, market, symbol, day, statuses):
    rows = [(market, day, symbol, s, MIDNIGHT + ms, i + 1) for i, (s, ms) in enumerate(statuses)]
    return spark.createDataFrame(rows, "market string, trading_day int, symbol string, status string, quote_ms long, source_row long")


def chosen(spark, *args):
    return {r.source_row: r.anchor for r in reference.select_phases(frames(spark, *args)).filter("anchor IS NOT NULL").collect()}


@pytest.mark.parametrize(("statuses", "want"), [
    ("O0 B0 B0 T0 B0 T0 C0 E0 E0", {2: "pre_open", 4: "continuous", 6: "continuous", 8: "market_close"}),
    ("S0 H0 E0", {}),
    ("H0 T0 E0 C0 E0", {2: "continuous", 5: "market_close"}),
    ("O0 H0 B0 O0 B0 T0 C0 H0 E0 C0 E0", {5: "pre_open", 6: "continuous", 11: "market_close"}),
])
def test_phases_sz(spark, statuses, want):
    assert chosen(spark, "SZ", "000001", DAY, [(s, i) for i, s in enumerate(statuses.split())]) == want


def test_phases_sh(spark):
    at = lambda s, ms: (s, ms)
    a, b = reference.OPEN_FROM, reference.OPEN_TO
    seq = [at("TRADE", a - 10), at("TRADE", a), at("OCALL", a + 1), at("TRADE", a + 2), at("TRADE", a + 3), at("TRADE", b), at("CLOSE", b + 1), at("CCALL", b + 2), at("SUSP", b + 3), at("CLOSE", b + 4), at("CCALL", b + 5), at("CLOSE", b + 6), at("CLOSE", b + 7)]
    assert chosen(spark, "SH", "600000", DAY, seq) == {4: "pre_open", 6: "continuous", 12: "market_close"}
    fund = [("TRADE", b), ("CLOSE", b + 1)]
    assert chosen(spark, "SH", "510300", 20260705, fund) == {1: "continuous", 2: "market_close"} and chosen(spark, "SH", "510300", 20260706, fund) == {1: "continuous"}


def automaton(statuses):
    """The SZ rules one frame at a time."""
    out, prev, traded, zone, opened, closed = [], None, False, False, False, False
    for s in statuses:
        a = None
        if s == "E0" and prev == "C0" and not closed:
            a, closed = "market_close", True
        elif s == "B0" and prev == "O0" and not traded and not zone and not opened:
            a, opened = "pre_open", True
        elif s == "T0" and not zone:
            a, traded = "continuous", True
        zone = zone or s == "C0"
        prev = s
        out.append(a)
    return out


def test_phases_are_the_automatons(spark):
    rng = random.Random(4)
    seqs = [[rng.choice(["O0", "B0", "T0", "C0", "E0", "H0"]) for _ in range(rng.randrange(1, 12))] for _ in range(1500)]
    rows = [("SZ", DAY, f"{i:06d}", s, j, j) for i, q in enumerate(seqs) for j, s in enumerate(q)]
    df = spark.createDataFrame(rows, "market string, trading_day int, symbol string, status string, quote_ms long, source_row long")
    got = {}
    for r in reference.select_phases(df).select("symbol", "source_row", "anchor").collect():
        got.setdefault(int(r.symbol), {})[r.source_row] = r.anchor
    assert all([got[i][j] for j in range(len(q))] == automaton(q) for i, q in enumerate(seqs))


def test_limits(spark):
    rows = [("a", 1, 9_999_999_999_999, 100, False), ("b", 1, 10**13, 100, True), ("c", 1, 10**13, 100, False), ("d", 1, 110_000, 90_000, False), ("d", 2, 110_000, 90_100, False), ("d", 3, 0, 0, False)]
    df = spark.createDataFrame([("SZ", DAY, *r) for r in rows], "market string, trading_day int, symbol string, source_row long, high_limit long, low_limit long, missing boolean")
    got = {r.symbol: r for r in reference.day_limits(df, missing=F.col("missing")).collect()}
    assert got["a"].kind == got["b"].kind == "unlimited" and got["b"].high_limit == 9_999_999_999_999 and got["b"].normalised == 1
    assert got["c"].error == "invalid" and got["d"].error == "conflict" and got["d"].error_row == 2 and got["d"].high_limit == 110_000


def test_windows(spark):
    df = spark.createDataFrame([("SZ", "159001", "continuous", 1000), ("SZ", "300001", "continuous", 1000), ("SH", "600000", "continuous", 1000), ("SH", "600000", "pre_open", 1000)], "market string, symbol string, anchor string, quote_ms long")
    assert [(r.win_from, r.win_to) for r in validation.with_window(df).collect()] == [(1000, 2100), (1000, 4000), (0, 2000), (1000, 2000)]
    with pytest.raises(ValueError, match="window"):
        validation.with_window(df, ahead_ms=0)


def test_band_projection(spark):
    base = ("SZ", DAY, "300001")
    rows = [(*base, "B", 110_100 + 100 * i, 1000, 1) for i in range(10)] + [(*base, "B", 90_000 + 100 * i, 10, 1) for i in range(12)] + [(*base, "S", 110_000, 20, 1), (*base, "S", 110_100, 30, 1)]
    levels = spark.createDataFrame(rows, "market string, trading_day int, symbol string, order_side string, price long, quantity long, order_count long")
    band = spark.createDataFrame([(*base, 90_000, 110_000)], "market string, trading_day int, symbol string, low long, high long")
    inside, out = validation.banded(levels, band)
    sums = {r.order_side: r for r in inside.groupBy("order_side").agg(F.sum("quantity").alias("q"), F.max("price").alias("top"), S.weighted_price_q(F.sum(F.col("price") * F.col("quantity")), F.sum("quantity"), L(100)).alias("v")).collect()}
    assert (sums["B"].q, sums["B"].top, sums["B"].v, sums["S"].q) == (120, 91_100, 90_600, 20)
    assert {r.order_side: r.excluded for r in out.collect()} == {"B": 10_000, "S": 30}


def test_outcomes(spark):
    df = spark.createDataFrame([(True, False, True, False, True), (False, True, True, False, True), (False, False, False, False, True), (False, False, True, True, True), (False, False, True, False, True), (False, False, True, False, False)], "c boolean, l boolean, s boolean, e boolean, m boolean")
    got = [r.x for r in df.select(validation.outcome(*(F.col(c) for c in "clsem")).alias("x")).collect()]
    assert got == ["data_error", "data_error", "missing_source", "data_error", "matched", "mismatched"]
    none = spark.createDataFrame([], "frame_id long, market string, trading_day int, symbol string, class string, anchor string, quote_ms long, outcome string, fields array<string>, reason string, tag string")
    s = reports.run_summary(none).first()
    assert s.outcome == "no_eligible" and not s.accepted and s.match_rate is None
