"""Queries of validation, phases, scalar rules and reports, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.functions import scalars as S
from bookweave.operators import book, reference, reports, snapshots, validation
from bookweave.plans import core
from bookweave.plans.core import DAY, ORIGIN_MS
from bookweave.plans.feed import CANONICAL_CTE, ms, order_feed
from bookweave.schema import BOOK
from bookweave.shared import new_path, written
from bookweave.sources import sinks

HALF_HOUR = 1_800_000


# ------------------------------------------------------------------ frames against states


def _frames(base: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Our own snapshots as published frames, their averages rounded as the market's are, some spoilt by rule."""
    feed, changes = base
    snaps = snapshots.grid_snapshots(feed, changes, origin=F.lit(ORIGIN_MS), **core.GRID)
    k, q = F.col("k"), F.lit(100).cast("bigint")
    snaps = snaps.withColumns({f"{s}_vwap": S.weighted_price_q(F.col(f"{s}_amount"), F.col(f"{s}_total"), q) for s in ("bid", "ask")})
    wrong = {
        "volume": F.when(k % 5 == 0, F.col("volume") + 100).otherwise(F.col("volume")),
        "bid_vwap": F.when(k % 3 == 0, F.col("bid_vwap") + 9).when(k % 7 == 0, F.col("bid_vwap") + 11).otherwise(F.col("bid_vwap")),
        "ask_total": F.when(k % 5 == 0, F.col("ask_total") - 1).otherwise(F.col("ask_total")),
        "bids": F.when(k % 11 == 0, F.slice("bids", 1, 3)).otherwise(F.col("bids")),
    }
    named = snaps.withColumns(wrong).withColumn("frame_id", F.col("symbol").cast("bigint") * 1000 + k).withColumn("quote_ms", F.col("boundary_ms"))
    return written(validation.with_window(named, HALF_HOUR, HALF_HOUR, (HALF_HOUR, HALF_HOUR)), "frames")


def candidate_join(spark, sf_dir):
    points = order_feed(spark, sf_dir).select(*BOOK, "seq", "quote_ms").withColumn("high_ms", F.max("quote_ms").over(W.partitionBy(*BOOK).orderBy("seq").rowsBetween(W.unboundedPreceding, -1)))
    frames = core.snapshot_grid(spark, sf_dir).select(F.lit("SZ").alias("market"), F.lit(20240101).alias("trading_day"), "symbol", (F.col("symbol").cast("bigint") * 1000 + F.col("k")).alias("frame_id"), F.col("boundary_ms").alias("quote_ms"))
    return validation.candidates(validation.with_window(frames, HALF_HOUR, HALF_HOUR, (HALF_HOUR, HALF_HOUR)), written(points, "points"), HALF_HOUR)


def _chosen(spark, sf_dir, with_depth):
    base = core.rebuilt(spark, sf_dir)
    points, frames = written(validation.states(*base), "states"), _frames(base)
    found = validation.candidates(frames, points, HALF_HOUR)
    best = validation.best_match(frames, found, points, base[1] if with_depth else None)
    return best.select("frame_id", "symbol", "seq", "at_ms", "matched", F.array_join(F.array_sort(F.transform("fields", lambda x: x["field"])), ",").alias("differ"))


def first_match(spark, sf_dir):
    return _chosen(spark, sf_dir, False)


def best_candidate(spark, sf_dir):
    return _chosen(spark, sf_dir, True)


def close_vwap(spark, sf_dir):
    return validation.closing_vwap(written(order_feed(spark, sf_dir), "feed"), F.lit(100).cast("bigint"), DAY).select("symbol", "close_price", "quantity")


def closing_auction_flag(spark, sf_dir):
    return validation.closing_auction(order_feed(spark, sf_dir)).select("symbol", "auction_trade", "base_price", "base_ms", "base_seq")


def close_projection(spark, sf_dir):
    """Side totals of the levels inside the closing band of 100,000 units less a hundred for each symbol, and what is outside."""
    levels = core.level_totals(spark, sf_dir)
    band = levels.select(*BOOK).distinct().withColumn("b", S.close_band(F.lit(91_000).cast("bigint") - 100 * F.col("symbol").cast("bigint"))).select(*BOOK, "b.low", "b.high")
    inside, out = validation.banded(levels, band)
    kept = inside.groupBy("symbol", "order_side").agg(F.sum("quantity").alias("quantity"), F.count("*").alias("levels"), S.weighted_price_q(F.sum(F.col("price").cast("decimal(19,0)") * F.col("quantity").cast("decimal(19,0)")), F.sum("quantity"), F.lit(100).cast("bigint")).alias("vwap"))
    return kept.join(out.select("symbol", "order_side", "excluded"), ["symbol", "order_side"], "full")


def price_reconciliation(spark, sf_dir):
    """Which closing prices that differ are explained by the closing rule."""
    feed = written(order_feed(spark, sf_dir), "feed")
    flags, vwap = validation.closing_auction(feed), validation.closing_vwap(feed, F.lit(100).cast("bigint"), DAY)
    stats = book.trade_stats(feed)
    rows = stats.join(flags, BOOK).join(vwap, BOOK).withColumn("n", F.col("symbol").cast("int"))
    expected = F.when(F.col("n") % 3 == 0, F.col("close_price")).otherwise(F.col("last_price"))
    tag = validation.reconciled(expected != F.col("last_price"), F.when(F.col("n") % 2 == 0, "stock").otherwise("etf"), F.col("n") % 5 == 0, F.col("trades"), expected, F.col("close_price"), F.lit(None).cast("bigint"))
    return rows.select("symbol", tag.alias("tag"))


def window_rules(spark, sf_dir):
    """Default windows of symbols made from customers."""
    n = F.col("c_custkey")
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.when(n % 2 == 0, "SZ").otherwise("SH").alias("market"), F.concat(F.get(F.array(*map(F.lit, ["000", "159", "300", "600", "510", "900"])), (n % 6).cast("int")), F.lpad((n % 1000).cast("string"), 3, "0")).alias("symbol"),
        F.when(n % 5 == 0, "pre_open").otherwise("continuous").alias("anchor"), (n * 1000).alias("quote_ms"),
    )
    kind = S.symbol_class(F.col("market"), F.col("symbol"))
    return validation.with_window(rows).select("market", "symbol", "anchor", "quote_ms", "win_from", "win_to", kind.alias("class"), S.quantum(F.col("market"), kind).alias("quantum"))


# ------------------------------------------------------------------ phases

SZ_STATUS = {"view": "T0", "click": "B0", "purchase": "C0", "signup": "O0", "error": "E0"}
SH_STATUS = {"view": "TRADE", "click": "OCALL", "purchase": "CCALL", "signup": "TRADE", "error": "CLOSE"}


def _phase_frames(spark, sf_dir, market):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    codes = F.create_map(*(F.lit(x) for kv in (SZ_STATUS if market == "SZ" else SH_STATUS).items() for x in kv))
    head = F.lit("000") if market == "SZ" else F.when(F.col("user_id") % 2 == 0, "600").otherwise("510")
    return e.select(F.lit(market).alias("market"), (F.lit(20260600) + F.col("user_id") % 60 * 2).cast("int").alias("trading_day"), F.concat(head, F.lpad((F.col("user_id") % 20).cast("string"), 3, "0")).alias("symbol"), codes[F.col("event_type")].alias("status"), ms("ts").alias("quote_ms"), F.col("event_id").alias("source_row"))


def phase_select_sz(spark, sf_dir):
    return reference.select_phases(_phase_frames(spark, sf_dir, "SZ")).select("symbol", "trading_day", "source_row", "anchor", "skip_reason")


def phase_select_sh(spark, sf_dir):
    return reference.select_phases(_phase_frames(spark, sf_dir, "SH")).select("symbol", "trading_day", "source_row", "anchor", "skip_reason")


def selection_audit(spark, sf_dir):
    frames = _phase_frames(spark, sf_dir, "SZ")
    days = frames.select("market", "trading_day").distinct().crossJoin(spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.lpad(F.col("n_nationkey").cast("string"), 6, "0").alias("symbol")))
    a = reference.selection_audit(reference.select_phases(frames), days)
    return a.select("symbol", "trading_day", "frames", "selected", "pre_open", "continuous", "market_close", "coverage", F.coalesce(F.element_at("by_status", "T0"), F.lit(0)).alias("t0"), F.coalesce(F.element_at("by_reason", reference.UNEXPECTED), F.lit(0)).alias("unexpected"), F.element_at("first_sample", reference.UNEXPECTED)["quote_ms"].alias("unexpected_first_ms"), F.element_at("first_sample", reference.UNEXPECTED)["previous_status"].alias("unexpected_after"))


def symbol_coverage(spark, sf_dir):
    """How many of 25 symbols have selected frames, frames that are not eligible, or none, over all days."""
    frames = _phase_frames(spark, sf_dir, "SZ")
    days = frames.select("market", "trading_day").distinct().crossJoin(spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.lpad(F.col("n_nationkey").cast("string"), 6, "0").alias("symbol")))
    return reports.symbol_totals(reference.selection_audit(reference.select_phases(frames), days))


def preopen_cutoff(spark, sf_dir):
    """The last pre-open frame's second of each day; every fourth day is without opening calls, and so without pre-open frames."""
    frames = _phase_frames(spark, sf_dir, "SZ").filter("NOT (trading_day % 8 = 0 AND status = 'O0')")
    return reference.preopen_cutoff(reference.select_phases(frames))


def position_faults(spark, sf_dir):
    """Frames in the order of their file: every third has an earlier time, every seventh a lower number, every eleventh the number before its own."""
    row = F.col("file_row")
    f = _phase_frames(spark, sf_dir, "SZ").withColumn("file_row", F.col("source_row"))
    last = F.lag("file_row").over(W.partitionBy("symbol", "trading_day").orderBy("file_row"))
    f = f.withColumns({"quote_ms": F.col("quote_ms") - F.when(row % 3 == 0, 90_000_000).otherwise(0), "source_row": F.when(row % 7 == 0, row - 100_000).when(row % 11 == 0, F.coalesce(last, row)).otherwise(row)})
    return reference.position_faults(f, ("file_row",)).select("symbol", "trading_day", "source_row", "quote_ms", "previous_ms", "previous_row")


def duplicate_times(spark, sf_dir):
    f = reference.select_phases(_phase_frames(spark, sf_dir, "SZ").withColumn("quote_ms", F.floor(F.col("quote_ms") / DAY) * DAY))
    return reference.duplicate_times(f).select("symbol", "trading_day", "source_row", "frames")


def day_limits(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    n = F.col("o_custkey")
    k = F.col("o_orderkey")
    frames = o.select(
        F.lit("SZ").alias("market"), F.lit(20260828).alias("trading_day"), n.cast("string").alias("symbol"), k.alias("source_row"),
        F.when(n % 4 == 0, F.when(k % 2 == 0, 10_000_000_000_000).otherwise(9_999_999_999_999)).when((n % 4 == 1) & (k % 5 == 0), 12_300).otherwise(110_000).cast("bigint").alias("high_limit"),
        F.when(n % 4 == 0, 100).when((n % 4 == 2) & (k % 7 == 0), 0).otherwise(90_000).cast("bigint").alias("low_limit"), (n % 8 == 0).alias("missing"),
    )
    return reference.day_limits(frames, missing=F.col("missing")).drop("market", "trading_day")


# ------------------------------------------------------------------ scalar rules over plain tables


def decimal_units(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    raw = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return li.groupBy("l_orderkey").agg(F.sum(S.to_units((raw * 10).cast("decimal(38,0)") / F.lit(1000).cast("decimal(4,0)"), 3)).alias("units"), F.sum(S.rescaled(raw, 6)).alias("rounded6"), F.sum(S.ref_price(raw - 3_000_000, 3)).alias("ref3"), F.count_if(S.ref_price_error(raw - 3_000_000)).alias("errors"), F.sum(S.ref_quantity(raw, "SH")).alias("whole"))


def weighted_price(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    p, q = F.round(F.col("l_extendedprice")).cast("bigint"), F.col("l_quantity").cast("bigint")
    t = li.groupBy("l_suppkey").agg(F.sum(p * q).alias("m"), F.sum(q).alias("q"))
    return t.select("l_suppkey", S.weighted_price(F.col("m"), F.col("q")).alias("vwap"), S.weighted_price_q(F.col("m"), F.col("q"), F.lit(100).cast("bigint")).alias("vwap100"), S.rounded(F.col("m"), F.lit(10).cast("bigint")).alias("m10"), S.weighted_match(F.col("m") % 50, F.col("q") % 50).alias("close"))


def price_band(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    b = S.close_band(F.col("o_orderkey") * 50)
    return o.select("o_orderkey", b["low"].alias("low"), b["high"].alias("high"))


def turnover_compat(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    x = F.round(F.col("l_extendedprice") * 100).cast("bigint") * 1_000_003 + F.col("l_orderkey")
    kept = S.turnover_compat(F.col("l_linenumber") % 2 == 0, (F.floor((x + 500) / 1000) * 1000), x)
    return li.select("l_orderkey", "l_linenumber", kept.alias("agrees"))


def clock_times(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    text = F.concat_ws(":", two(k % 26), two(k % 61), F.concat(two(k % 63), F.lit("."), F.lpad((k % 1000).cast("string"), 3, "0")))
    day = (F.lit(20240000) + k % 1300).cast("int")
    return o.select("o_orderkey", S.valid_day(day).alias("valid"), S.clock_ms(text).alias("clock"), S.market_ts(day, text).alias("at_ms"), S.time_of_day(k * 7_777_777).alias("tod"))


def symbol_class(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    s, m = F.lpad((F.col("o_orderkey") * 7919 % 1_000_000).cast("string"), 6, "0"), F.when(F.col("o_orderkey") % 2 == 0, "SZ").otherwise("SH")
    return o.groupBy(m.alias("market"), S.symbol_class(m, s).alias("class"), S.symbol_prefix(s).alias("prefix")).agg(F.count("*").alias("rows"))


def limit_classes(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    high = F.get(F.array(*map(F.lit, [9_999_999_999_999, 10_000_000_000_000, 110_000, 50, 0])), (k % 5).cast("int"))
    low = F.get(F.array(*map(F.lit, [100, -9_999_999_999_999, 90_000, 120_000])), (k % 4).cast("int"))
    return o.groupBy(S.limit_class(high, low, k % 3 == 0).alias("class")).agg(F.count("*").alias("rows"))


# ------------------------------------------------------------------ reports


def _records(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    i = F.col("event_id")
    code = lambda names, n: F.get(F.array(*map(F.lit, names)), (i % n).cast("int"))
    outcome = F.when(i % 17 == 0, "data_error").when(i % 29 == 0, "missing_source").when(i % 5 == 0, "mismatched").otherwise("matched")
    fields = F.when(outcome == "mismatched", F.filter(F.array(code(["bids", "asks", "volume"], 3), F.when(i % 2 == 0, F.lit("last_price"))), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))
    return e.select(
        i.alias("frame_id"), F.when(i % 2 == 0, "SZ").otherwise("SH").alias("market"), F.lit(20260828).alias("trading_day"), F.lpad((F.col("user_id") % 50 * 11_117).cast("string"), 6, "0").alias("symbol"),
        code(["stock", "chinext", "etf"], 3).alias("class"), code(reports.ANCHORS, 7).alias("anchor0"), i.alias("quote_ms"), outcome.alias("outcome"), fields.alias("fields"),
        F.when(outcome == "data_error", "load_error").when(outcome == "missing_source", "symbol_unseen").alias("reason"), F.when((outcome == "matched") & (i % 50 == 1), "stock_close_vwap").alias("tag"),
    ).withColumn("anchor", F.coalesce("anchor0", F.lit("continuous"))).drop("anchor0")


def outcome_breakdown(spark, sf_dir):
    return reports.outcome_breakdown(_records(spark, sf_dir))


def run_summary(spark, sf_dir):
    return reports.run_summary(_records(spark, sf_dir))


def report_round_trip(spark, sf_dir):
    """The summary as a report that was written and read back."""
    path = new_path(spark, "report")
    sinks.write_report(run_summary(spark, sf_dir), path)
    return sinks.read_report(spark, path, "total bigint, comparable bigint, matched bigint, mismatched bigint, data_error bigint, missing_source bigint, match_rate double, outcome string, accepted boolean")


def regression_audit(spark, sf_dir):
    """Inversions of the native sequence as the audit that was written."""
    path = new_path(spark, "regressions")
    rows = core.seq_inversions(spark, sf_dir)
    sinks.write_regressions(rows, path)
    return spark.read.schema(rows.schema).json(path)


def detail_counts(spark, sf_dir):
    return reports.detail_counts(_records(spark, sf_dir))


def mismatched_symbols(spark, sf_dir):
    return reports.mismatched_symbols(_records(spark, sf_dir), "0")


def mismatch_count_check(spark, sf_dir):
    return reports.expect_count(reports.mismatched_symbols(_records(spark, sf_dir)), 100)


def mismatches_by_prefix(spark, sf_dir):
    return reports.mismatches_by_prefix(_records(spark, sf_dir))


def coverage(spark, sf_dir):
    """All records, and symbols that have none."""
    r = _records(spark, sf_dir)
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.lit("SZ").alias("market"), F.lpad((F.col("n_nationkey") + 777_000).cast("string"), 6, "0").alias("symbol"), F.lit("etf").alias("class"))
    return reports.coverage(r, r.groupBy("market", "symbol").agg(F.min("class").alias("class")).unionByName(nations))


def retained_details(spark, sf_dir):
    return reports.retained(_records(spark, sf_dir), 300).select("frame_id", "symbol", "anchor", "outcome", "place")


def conservation_checks(spark, sf_dir):
    """Checks that fail by rule: the audit selects one frame too many and counts three too many, and seven details are called omitted."""
    r = _records(spark, sf_dir)
    audit = r.agg((F.count("*") + 1).alias("selected"), (F.count("*") + 3).alias("frames"), F.create_map(F.lit("T0"), F.count("*")).alias("by_status"), F.create_map(F.lit("other"), F.lit(1).cast("bigint")).alias("by_reason"))
    details = r.filter((F.col("outcome") != "matched") | F.col("tag").isNotNull())
    return reports.conservation(r, audit, details, 7)


def campaign(spark, sf_dir):
    r = _records(spark, sf_dir).withColumn("trading_day", F.lit(20260801) + (F.col("frame_id") % 10).cast("int"))
    per = r.groupBy("market", "trading_day").agg(F.count("*").alias("total"), F.count_if(F.col("outcome").isin("matched", "mismatched")).alias("comparable"), *(F.count_if(F.col("outcome") == o).alias(o) for o in reports.OUTCOMES))
    per = per.withColumn("version", F.when(F.col("trading_day") % 2 == 0, 2).otherwise(1)).withColumn("accepted", F.col("mismatched") == 0)
    return reports.campaign(per)


def queries():
    names = [
        candidate_join, first_match, best_candidate, close_vwap, closing_auction_flag, close_projection, price_reconciliation, window_rules, phase_select_sz, phase_select_sh, selection_audit, symbol_coverage,
        preopen_cutoff, position_faults, duplicate_times, day_limits, decimal_units, weighted_price, price_band, turnover_compat, clock_times, symbol_class, limit_classes, outcome_breakdown,
        run_summary, report_round_trip, regression_audit, detail_counts, mismatched_symbols, mismatch_count_check, mismatches_by_prefix, coverage, retained_details, conservation_checks, campaign,
    ]
    return {f.__name__: f for f in names}


# ------------------------------------------------------------------ SQL

_FEED = f"WITH {CANONICAL_CTE}"
_FRAMES = f"""{core._GRID},
w AS (SELECT symbol, k, CAST(symbol AS BIGINT) * 1000 + k AS frame_id, boundary_ms AS t, boundary_ms - {HALF_HOUR} AS a, boundary_ms + {HALF_HOUR} AS z FROM b),
p AS (SELECT symbol, seq, quote_ms AS q, max(quote_ms) OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h, lag(seq) OVER (PARTITION BY symbol ORDER BY seq) AS prev FROM f),
i AS (SELECT frame_id, p.seq, p.prev, q FROM w JOIN p ON p.symbol = w.symbol AND q >= a AND q < z AND coalesce(h < z, true)),
x AS (SELECT frame_id, (SELECT max(p.seq) FROM p WHERE p.symbol = w.symbol AND p.q < z AND coalesce(p.h < z, true)) AS seq, z - 1 AS q FROM w),
c AS (SELECT frame_id, seq, min(q) AS at_ms FROM (SELECT frame_id, seq, q FROM i UNION ALL SELECT frame_id, prev, q FROM i UNION ALL SELECT frame_id, seq, q FROM x) GROUP BY frame_id, seq)"""
_STATS = """,
tt AS (SELECT f.symbol, f.seq, arg_max(t.price, t.seq) AS last_price, max(t.price) AS high_price, min(t.price) AS low_price, count(t.seq) AS trades, coalesce(sum(t.qty), 0) AS volume, coalesce(sum(t.price * t.qty), 0) AS turnover
  FROM f LEFT JOIN f t ON t.symbol = f.symbol AND t.kind = 'T' AND t.seq <= f.seq GROUP BY 1, 2),
gg AS (SELECT f.symbol, f.seq, coalesce(sum(g.dq) FILTER (g.order_side = 'B'), 0) AS bq, coalesce(sum(g.dq) FILTER (g.order_side = 'S'), 0) AS sq, sum(g.dq * g.price) FILTER (g.order_side = 'B') AS bm, sum(g.dq * g.price) FILTER (g.order_side = 'S') AS sm
  FROM f JOIN g ON g.symbol = f.symbol AND g.seq <= f.seq GROUP BY 1, 2),
st AS (SELECT tt.*, bq, sq, CASE WHEN bq > 0 THEN (bm + bq * 100 // 2) // (bq * 100) * 100 END AS bv, CASE WHEN sq > 0 THEN (sm + sq * 100 // 2) // (sq * 100) * 100 END AS sv FROM tt JOIN gg USING (symbol, seq)),
as_of AS (SELECT w.*, (SELECT max(seq) FROM f WHERE f.symbol = w.symbol AND f.quote_ms < w.t) AS s FROM w),
ex AS (SELECT a.frame_id, a.symbol, a.k, a.s, last_price, high_price, low_price, coalesce(trades, 0) AS trades, coalesce(turnover, 0) AS turnover, coalesce(bq, 0) AS bq, coalesce(volume, 0) + CASE WHEN k % 5 = 0 THEN 100 ELSE 0 END AS volume,
  coalesce(sq, 0) - CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS sq, bv + CASE WHEN k % 3 = 0 THEN 9 WHEN k % 7 = 0 THEN 11 ELSE 0 END AS bv, sv
  FROM as_of a LEFT JOIN st ON st.symbol = a.symbol AND st.seq = a.s)"""
_DIFFER = {
    "last_price": "e.last_price IS DISTINCT FROM s.last_price", "high_price": "e.high_price IS DISTINCT FROM s.high_price", "low_price": "e.low_price IS DISTINCT FROM s.low_price",
    "volume": "e.volume <> coalesce(s.volume, 0)", "turnover": "e.turnover <> coalesce(s.turnover, 0)", "trades": "e.trades <> coalesce(s.trades, 0)", "bid_total": "e.bq <> coalesce(s.bq, 0)", "ask_total": "e.sq <> coalesce(s.sq, 0)",
    "bid_vwap": "NOT ((e.bv IS NULL AND s.bv IS NULL) OR coalesce(abs(e.bv - s.bv) <= 10, false))", "ask_vwap": "NOT ((e.sv IS NULL AND s.sv IS NULL) OR coalesce(abs(e.sv - s.sv) <= 10, false))",
}
_DEPTH = """,
need AS (SELECT DISTINCT e.symbol, c.seq FROM c JOIN ex e USING (frame_id) UNION SELECT symbol, s FROM ex),
dl AS (SELECT n.symbol, n.seq, order_side, price, sum(dq) AS q, sum(dc) AS c FROM need n JOIN g ON g.symbol = n.symbol AND g.seq <= n.seq GROUP BY ALL HAVING sum(dc) > 0),
dr AS (SELECT *, row_number() OVER (PARTITION BY symbol, seq, order_side ORDER BY CASE WHEN order_side = 'B' THEN -price ELSE price END) AS r FROM dl),
dp AS (SELECT symbol, seq, coalesce(string_agg(concat(price, ':', q, ':', c), ',' ORDER BY r) FILTER (order_side = 'B'), '') AS bids, coalesce(string_agg(concat(price, ':', q, ':', c), ',' ORDER BY r) FILTER (order_side = 'S'), '') AS asks,
  coalesce(string_agg(concat(price, ':', q, ':', c), ',' ORDER BY r) FILTER (order_side = 'B' AND r <= 3), '') AS bids3 FROM dr WHERE r <= 10 GROUP BY symbol, seq)"""


def _choice(depth: bool) -> str:
    parts = dict(_DIFFER)
    if depth:
        parts |= {"bids": "CASE WHEN e.k % 11 = 0 THEN coalesce(de.bids3, '') ELSE coalesce(de.bids, '') END <> coalesce(ds.bids, '')", "asks": "coalesce(de.asks, '') <> coalesce(ds.asks, '')"}
    fields = ", ".join(f"CASE WHEN {sql} THEN '{name}' END" for name, sql in parts.items())
    join = " LEFT JOIN dp de ON de.symbol = e.symbol AND de.seq = e.s LEFT JOIN dp ds ON ds.symbol = e.symbol AND ds.seq = c.seq" if depth else ""
    return f"""{_FEED}{core._TOUCH}{core._SIGNED}{_FRAMES}{_STATS}{_DEPTH if depth else ''},
m AS (SELECT c.frame_id, e.symbol, c.seq, c.at_ms, list_sort(list_filter([{fields}], lambda y: y IS NOT NULL)) AS d
  FROM c JOIN ex e USING (frame_id) LEFT JOIN st s ON s.symbol = e.symbol AND s.seq = c.seq{join}),
n AS (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY len(d), at_ms, seq NULLS FIRST) AS nth FROM m)
SELECT frame_id, symbol, seq, at_ms, len(d) = 0 AS matched, array_to_string(d, ',') AS differ FROM n WHERE nth = 1"""


def _status_sql(codes: dict[str, str]) -> str:
    return "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in codes.items()) + " END"


def _phase_cte(market: str) -> str:
    head = "'000'" if market == "SZ" else "CASE WHEN user_id % 2 = 0 THEN '600' ELSE '510' END"
    codes = _status_sql(SZ_STATUS if market == "SZ" else SH_STATUS)
    tod = "(quote_ms + 28800000) % 86400000"
    if market == "SZ":
        kinds = "status = 'B0' AS op, status = 'T0' AS ru, false AS ea, status = 'O0' AS au, status = 'C0' AS ca, status = 'E0' AS cl, false AS fund"
        pred, pred_open = "prev = 'C0'", "prev = 'O0'"
    else:
        kinds = f"status = 'TRADE' AND {tod} >= 33900000 AND {tod} < 34200000 AS op, status = 'TRADE' AND {tod} >= 34200000 AS ru, status = 'TRADE' AND {tod} < 33900000 AS ea, status = 'OCALL' AS au, status = 'CCALL' AS ca, status = 'CLOSE' AS cl, symbol LIKE '510%' AND trading_day < 20260706 AS fund"
        pred = "CASE WHEN fund THEN prev = 'TRADE' AND coalesce(run0 < row_, false) AND NOT coalesce(call_ < row_, false) ELSE prev = 'CCALL' END"
        pred_open = "prev = 'OCALL'"
    over = "OVER (PARTITION BY trading_day, symbol)"
    missing = "'status_not_applicable'" if market == "SZ" else "'missing_normal_predecessor'"
    return f"""WITH fr AS (SELECT CAST(20260600 + user_id % 60 * 2 AS INTEGER) AS trading_day, concat({head}, lpad(CAST(user_id % 20 AS VARCHAR), 3, '0')) AS symbol, {codes} AS status, epoch_us(ts) // 1000 AS quote_ms, event_id AS row_ FROM events),
k0 AS (SELECT *, lag(status) OVER (PARTITION BY trading_day, symbol ORDER BY row_) AS prev, {kinds} FROM fr),
k1 AS (SELECT *, min(CASE WHEN ca THEN row_ END) {over} AS call_, min(CASE WHEN ru THEN row_ END) {over} AS run0 FROM k0),
k2 AS (SELECT *, min(CASE WHEN cl AND coalesce({pred}, false) THEN row_ END) {over} AS close_ FROM k1),
k3 AS (SELECT *, coalesce(call_ < row_, false) OR (fund AND coalesce(close_ < row_, false)) AS zone FROM k2),
k4 AS (SELECT *, min(CASE WHEN ru AND NOT zone THEN row_ END) {over} AS run_ FROM k3),
k5 AS (SELECT *, min(CASE WHEN op AND coalesce({pred_open}, false) AND NOT coalesce(run_ < row_, false) AND NOT zone THEN row_ END) {over} AS open_ FROM k4),
k6 AS (SELECT *, CASE WHEN close_ = row_ THEN 'market_close' WHEN open_ = row_ THEN 'pre_open' WHEN ru AND NOT zone THEN 'continuous' END AS anchor FROM k5),
k AS (SELECT *, CASE WHEN anchor IS NOT NULL THEN NULL WHEN cl AND close_ < row_ THEN 'additional_static_frame' WHEN cl THEN 'missing_normal_predecessor' WHEN op AND zone THEN 'unexpected_phase_transition'
  WHEN op AND run_ < row_ THEN {missing} WHEN op AND open_ < row_ THEN 'additional_static_frame' WHEN op THEN 'missing_normal_predecessor' WHEN ru THEN 'unexpected_phase_transition'
  WHEN ea AND zone THEN 'unexpected_phase_transition' WHEN ea THEN 'outside_selection_window' WHEN au AND (zone OR run_ < row_) THEN 'unexpected_phase_transition' WHEN ca AND close_ < row_ THEN 'unexpected_phase_transition' ELSE 'status_not_applicable' END AS skip_reason FROM k6)"""


_RECORDS = """WITH r AS (
  SELECT event_id AS i, event_id AS frame_id, CASE WHEN event_id % 2 = 0 THEN 'SZ' ELSE 'SH' END AS market, lpad(CAST(user_id % 50 * 11117 AS VARCHAR), 6, '0') AS symbol,
    CASE event_id % 3 WHEN 0 THEN 'stock' WHEN 1 THEN 'chinext' ELSE 'etf' END AS class, CASE event_id % 7 WHEN 0 THEN 'pre_open' WHEN 2 THEN 'market_close' ELSE 'continuous' END AS anchor,
    CASE WHEN event_id % 17 = 0 THEN 'data_error' WHEN event_id % 29 = 0 THEN 'missing_source' WHEN event_id % 5 = 0 THEN 'mismatched' ELSE 'matched' END AS outcome FROM events),
r2 AS (SELECT *, CASE WHEN outcome = 'matched' AND i % 50 = 1 THEN 'stock_close_vwap' END AS tag FROM r)"""
_COUNTS = "count(*) AS total, count(*) FILTER (outcome IN ('matched', 'mismatched')) AS comparable, count(*) FILTER (outcome = 'matched') AS matched, count(*) FILTER (outcome = 'mismatched') AS mismatched, count(*) FILTER (outcome = 'data_error') AS data_error, count(*) FILTER (outcome = 'missing_source') AS missing_source"


def oracle_sql():
    sz, sh = _phase_cte("SZ"), _phase_cte("SH")
    last_day = f"{_FEED}, t AS (SELECT *, max(quote_ms) OVER (PARTITION BY symbol) AS last FROM f WHERE kind = 'T'), v AS (SELECT symbol, sum(price * qty) AS m, sum(qty) AS q FROM t WHERE quote_ms >= last - {DAY} GROUP BY symbol)"
    lv = f"{_FEED}{core._TOUCH}{core._SIGNED}"
    big = "CAST({} AS BIGINT)".format
    return {
        "candidate_join": f"{_FEED}{_FRAMES} SELECT frame_id, seq, at_ms FROM c",
        "first_match": _choice(False),
        "best_candidate": _choice(True),
        "close_vwap": f"{last_day} SELECT symbol, CAST((m + q * 100 // 2) // (q * 100) * 100 AS BIGINT) AS close_price, CAST(q AS BIGINT) AS quantity FROM v",
        "closing_auction_flag": f"{_FEED}, t AS (SELECT *, (quote_ms + 28800000) % 86400000 AS tod FROM f WHERE kind = 'T') SELECT symbol, max(CASE WHEN tod BETWEEN 53820000 AND 54000000 THEN 1 ELSE 0 END) = 1 AS auction_trade, arg_max(price, seq) FILTER (tod < 53820000) AS base_price, arg_max(quote_ms, seq) FILTER (tod < 53820000) AS base_ms, max(seq) FILTER (tod < 53820000) AS base_seq FROM t GROUP BY symbol",
        "close_projection": f"""{lv}, bd AS (SELECT *, 91000 - 100 * CAST(symbol AS BIGINT) AS p0 FROM lv),
bb AS (SELECT *, price BETWEEN greatest(100, least(p0 - 100, (p0 * 9 + 500) // 1000 * 100)) AND greatest(p0 + 100, (p0 * 11 + 500) // 1000 * 100) AS inside FROM bd)
SELECT symbol, order_side, CAST(sum(quantity) FILTER (inside) AS BIGINT) AS quantity, nullif(count(*) FILTER (inside), 0) AS levels, CAST((sum(price * quantity) FILTER (inside) + sum(quantity) FILTER (inside) * 100 // 2) // (sum(quantity) FILTER (inside) * 100) * 100 AS BIGINT) AS vwap, CAST(sum(quantity) FILTER (NOT inside) AS BIGINT) AS excluded FROM bb GROUP BY symbol, order_side""",
        "price_reconciliation": f"""{last_day}, l AS (SELECT symbol, arg_max(price, seq) AS lp FROM f WHERE kind = 'T' GROUP BY symbol), j AS (SELECT symbol, CAST(symbol AS INTEGER) AS n, lp, (m + q * 100 // 2) // (q * 100) * 100 AS cp FROM v JOIN l USING (symbol))
SELECT symbol, CASE WHEN n % 3 = 0 AND cp <> lp AND n % 5 <> 0 THEN CASE WHEN n % 2 = 0 THEN 'stock_close_vwap' ELSE 'etf_close_vwap' END END AS tag FROM j""",
        "window_rules": """WITH s AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'SZ' ELSE 'SH' END AS market, concat(['000','159','300','600','510','900'][CAST(c_custkey % 6 AS INTEGER) + 1], lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')) AS symbol, CASE WHEN c_custkey % 5 = 0 THEN 'pre_open' ELSE 'continuous' END AS anchor, c_custkey * 1000 AS quote_ms FROM customer),
c AS (SELECT *, CASE WHEN market = 'SZ' AND symbol LIKE '159%' OR market = 'SH' AND symbol LIKE '510%' THEN 'etf' WHEN market = 'SZ' AND symbol LIKE '300%' THEN 'chinext' WHEN market = 'SZ' AND symbol LIKE '000%' OR market = 'SH' AND symbol LIKE '600%' THEN 'stock' ELSE 'other' END AS class FROM s)
SELECT market, symbol, anchor, quote_ms, class, quote_ms - CASE WHEN anchor = 'pre_open' OR market = 'SZ' THEN 0 ELSE 1000 END AS win_from, quote_ms + CASE WHEN anchor = 'pre_open' THEN 1000 WHEN market = 'SZ' AND class = 'etf' THEN 1100 WHEN class = 'chinext' THEN 3000 ELSE 1000 END AS win_to, CAST(CASE WHEN market = 'SZ' AND class IN ('stock', 'chinext') THEN 100 ELSE 10 END AS BIGINT) AS quantum FROM c""",
        "phase_select_sz": f"{sz} SELECT symbol, trading_day, row_ AS source_row, anchor, skip_reason FROM k",
        "phase_select_sh": f"{sh} SELECT symbol, trading_day, row_ AS source_row, anchor, skip_reason FROM k",
        "selection_audit": f"""{sz}, a AS (SELECT symbol, trading_day, count(*) AS frames, count(anchor) AS selected, count(*) FILTER (anchor = 'pre_open') AS pre_open, count(*) FILTER (anchor = 'continuous') AS continuous, count(*) FILTER (anchor = 'market_close') AS market_close,
  count(*) FILTER (status = 'T0') AS t0, count(*) FILTER (skip_reason = 'unexpected_phase_transition') AS unexpected, arg_min(quote_ms, row_) FILTER (skip_reason = 'unexpected_phase_transition') AS unexpected_first_ms, arg_min(prev, row_) FILTER (skip_reason = 'unexpected_phase_transition') AS unexpected_after FROM k GROUP BY symbol, trading_day),
y AS (SELECT DISTINCT trading_day, lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS symbol FROM k, nation)
SELECT symbol, trading_day, coalesce(frames, 0) AS frames, coalesce(selected, 0) AS selected, coalesce(pre_open, 0) AS pre_open, coalesce(continuous, 0) AS continuous, coalesce(market_close, 0) AS market_close, coalesce(t0, 0) AS t0, coalesce(unexpected, 0) AS unexpected, unexpected_first_ms, unexpected_after,
  CASE WHEN coalesce(selected, 0) > 0 THEN 'selected' WHEN frames > 0 THEN 'no_eligible_references' ELSE 'no_reference_records' END AS coverage FROM y LEFT JOIN a USING (symbol, trading_day)""",
        "symbol_coverage": f"""{sz}, d AS (SELECT DISTINCT CAST(20260600 + user_id % 60 * 2 AS INTEGER) AS trading_day FROM events), y AS (SELECT trading_day, lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS symbol FROM d, nation),
a AS (SELECT symbol, trading_day, count(*) AS frames, count(anchor) AS selected FROM k GROUP BY ALL)
SELECT count(*) AS symbols, count(*) FILTER (selected > 0) AS with_selected, count(*) FILTER (frames IS NULL) AS without_records, count(*) FILTER (frames > 0 AND selected = 0) AS without_eligible FROM y LEFT JOIN a USING (symbol, trading_day)""",
        "preopen_cutoff": f"""{sz.replace("FROM fr)", "FROM fr WHERE NOT (trading_day % 8 = 0 AND status = 'O0'))", 1)}
SELECT 'SZ' AS market, trading_day, coalesce(max(quote_ms) FILTER (anchor = 'pre_open') + 1000, epoch_us(try_strptime(CAST(trading_day AS VARCHAR), '%Y%m%d')) // 1000 - 28800000 + 34200000) AS cutoff_ms FROM k GROUP BY trading_day""",
        "position_faults": f"""{sz}, y AS (SELECT symbol, trading_day, row_, quote_ms - CASE WHEN row_ % 3 = 0 THEN 90000000 ELSE 0 END AS q,
    CASE WHEN row_ % 7 = 0 THEN row_ - 100000 WHEN row_ % 11 = 0 THEN coalesce(lag(row_) OVER (PARTITION BY symbol, trading_day ORDER BY row_), row_) ELSE row_ END AS r FROM fr),
z AS (SELECT *, lag(q) OVER b AS pq, lag(r) OVER b AS pr FROM y WINDOW b AS (PARTITION BY symbol, trading_day ORDER BY row_))
SELECT symbol, trading_day, r AS source_row, q AS quote_ms, pq AS previous_ms, pr AS previous_row FROM z WHERE q < pq OR r <= pr""",
        "duplicate_times": f"{sz}, y AS (SELECT *, count(*) OVER (PARTITION BY symbol, trading_day, quote_ms // {DAY}) AS frames FROM k WHERE anchor = 'continuous') SELECT symbol, trading_day, row_ AS source_row, frames FROM y WHERE frames > 1",
        "day_limits": """WITH s AS (SELECT CAST(o_custkey AS VARCHAR) AS symbol, o_orderkey AS r, o_custkey % 8 = 0 AS missing,
  CASE WHEN o_custkey % 4 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 10000000000000 ELSE 9999999999999 END WHEN o_custkey % 4 = 1 AND o_orderkey % 5 = 0 THEN 12300 ELSE 110000 END AS h,
  CASE WHEN o_custkey % 4 = 0 THEN 100 WHEN o_custkey % 4 = 2 AND o_orderkey % 7 = 0 THEN 0 ELSE 90000 END AS l FROM orders),
c AS (SELECT *, CASE WHEN h = 9999999999999 AND l = 100 OR h = 10000000000000 AND l = 100 AND missing THEN 'unlimited' WHEN l > 0 AND l <= h AND h < 9999999999999 AND h % 100 = 0 AND l % 100 = 0 THEN 'limited' ELSE 'invalid' END AS kind, CASE WHEN h = 10000000000000 AND missing THEN 9999999999999 ELSE h END AS n FROM s),
p AS (SELECT symbol, min(r) AS fr, arg_min(n, r) AS fh, arg_min(l, r) AS fl, arg_min(kind, r) AS fk FROM c WHERE kind <> 'invalid' GROUP BY symbol),
e AS (SELECT c.symbol, r, CASE WHEN kind = 'invalid' THEN 'invalid' ELSE 'conflict' END AS w FROM c LEFT JOIN p USING (symbol) WHERE kind = 'invalid' OR (r >= fr AND (n <> fh OR l <> fl)))
SELECT g.symbol, CAST(fh AS BIGINT) AS high_limit, CAST(fl AS BIGINT) AS low_limit, fk AS kind, (SELECT arg_min(w, r) FROM e WHERE e.symbol = g.symbol) AS error, (SELECT min(r) FROM e WHERE e.symbol = g.symbol) AS error_row, g.normalised
FROM (SELECT symbol, count(*) FILTER (n <> h) AS normalised FROM c GROUP BY symbol) g LEFT JOIN p ON p.symbol = g.symbol""",
        "decimal_units": "WITH s AS (SELECT l_orderkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS x FROM lineitem) SELECT l_orderkey, CAST(sum(x * 100) AS BIGINT) AS units, CAST(sum((x + 50) // 100) AS BIGINT) AS rounded6, CAST(sum(CASE WHEN x > 3000000 THEN (x - 3000000) * 10 END) AS BIGINT) AS ref3, count(*) FILTER (x < 3000000) AS errors, CAST(sum(CASE WHEN x % 1000 = 0 THEN x // 1000 END) AS BIGINT) AS whole FROM s GROUP BY l_orderkey",
        "weighted_price": "WITH s AS (SELECT l_suppkey, CAST(sum(CAST(round(l_extendedprice) AS BIGINT) * CAST(l_quantity AS BIGINT)) AS BIGINT) AS m, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY l_suppkey) SELECT l_suppkey, (m + q // 2) // q AS vwap, (m + q * 100 // 2) // (q * 100) * 100 AS vwap100, (m + 5) // 10 * 10 AS m10, abs(m % 50 - q % 50) <= 10 AS close FROM s",
        "price_band": "WITH s AS (SELECT o_orderkey, o_orderkey * 50 AS b FROM orders) SELECT o_orderkey, CASE WHEN b > 0 AND b % 100 = 0 THEN greatest(100, least(b - 100, (b * 9 + 500) // 1000 * 100)) END AS low, CASE WHEN b > 0 AND b % 100 = 0 THEN greatest(b + 100, (b * 11 + 500) // 1000 * 100) END AS high FROM s",
        "turnover_compat": "WITH s AS (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) * 1000003 + l_orderkey AS x FROM lineitem), t AS (SELECT *, (x + 500) // 1000 * 1000 AS e, CAST(10 AS BIGINT) ** greatest(length(CAST(x AS VARCHAR)) - 12, 0) AS pd FROM s), u AS (SELECT *, CAST(pd AS BIGINT) AS p FROM t) SELECT l_orderkey, l_linenumber, e = x OR (l_linenumber % 2 = 0 AND (x + p // 2) // p * p = e) AS agrees FROM u",
        "clock_times": """WITH s AS (SELECT o_orderkey AS k, 20240000 + o_orderkey % 1300 AS d FROM orders), v AS (SELECT *, try_strptime(CAST(d AS VARCHAR), '%Y%m%d') AS day, CASE WHEN k % 26 < 24 AND k % 61 < 60 AND k % 63 <= 60 THEN (k % 26 * 60 + k % 61) * 60000 + k % 63 * 1000 + k % 1000 END AS clock FROM s)
SELECT k AS o_orderkey, day IS NOT NULL AS valid, clock, epoch_us(day) // 1000 + clock - 28800000 AS at_ms, (k * 7777777 + 28800000) % 86400000 AS tod FROM v""",
        "symbol_class": """WITH s AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'SZ' ELSE 'SH' END AS market, substr(lpad(CAST(o_orderkey * 7919 % 1000000 AS VARCHAR), 6, '0'), 1, 3) AS prefix FROM orders)
SELECT market, CASE WHEN market = 'SH' AND (prefix BETWEEN '510' AND '513' OR prefix BETWEEN '515' AND '518' OR prefix BETWEEN '560' AND '563' OR prefix = '588') OR market = 'SZ' AND prefix = '159' THEN 'etf' WHEN market = 'SZ' AND prefix BETWEEN '300' AND '302' THEN 'chinext'
  WHEN market = 'SH' AND (prefix IN ('600', '601', '603', '605') OR prefix BETWEEN '688' AND '689') OR market = 'SZ' AND prefix BETWEEN '000' AND '003' THEN 'stock' ELSE 'other' END AS class, prefix, count(*) AS rows FROM s GROUP BY ALL""",
        "limit_classes": """WITH s AS (SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 9999999999999 WHEN 1 THEN 10000000000000 WHEN 2 THEN 110000 WHEN 3 THEN 50 ELSE 0 END AS h, CASE o_orderkey % 4 WHEN 0 THEN 100 WHEN 1 THEN -9999999999999 WHEN 2 THEN 90000 ELSE 120000 END AS l FROM orders)
SELECT CASE WHEN h = 9999999999999 AND l IN (100, -9999999999999) OR h = 10000000000000 AND l = 100 AND k % 3 = 0 THEN 'unlimited' WHEN h = 110000 AND l IN (100, 90000) THEN 'limited' ELSE 'invalid' END AS class, count(*) AS rows FROM s GROUP BY 1""",
        "outcome_breakdown": f"{_RECORDS} SELECT class, anchor, {_COUNTS} FROM r2 GROUP BY GROUPING SETS ((), (class, anchor))",
        "run_summary": f"{_RECORDS}, t AS (SELECT {_COUNTS} FROM r2) SELECT *, CASE WHEN comparable > 0 THEN matched / comparable END AS match_rate, CASE WHEN mismatched + data_error + missing_source > 0 THEN 'failed' WHEN comparable = 0 THEN 'no_eligible' ELSE 'passed' END AS outcome, mismatched + data_error + missing_source = 0 AND comparable > 0 AS accepted FROM t",
        "report_round_trip": f"{_RECORDS}, t AS (SELECT {_COUNTS} FROM r2) SELECT *, CASE WHEN comparable > 0 THEN matched / comparable END AS match_rate, CASE WHEN mismatched + data_error + missing_source > 0 THEN 'failed' WHEN comparable = 0 THEN 'no_eligible' ELSE 'passed' END AS outcome, mismatched + data_error + missing_source = 0 AND comparable > 0 AS accepted FROM t",
        "regression_audit": core.oracle_sql()["seq_inversions"],
        "detail_counts": f"""{_RECORDS}, d AS (SELECT 'field' AS kind, CASE i % 3 WHEN 0 THEN 'bids' WHEN 1 THEN 'asks' ELSE 'volume' END AS key FROM r2 WHERE outcome = 'mismatched' UNION ALL SELECT 'field', 'last_price' FROM r2 WHERE outcome = 'mismatched' AND i % 2 = 0
  UNION ALL SELECT 'reason', CASE outcome WHEN 'data_error' THEN 'load_error' ELSE 'symbol_unseen' END FROM r2 WHERE outcome IN ('data_error', 'missing_source') UNION ALL SELECT 'tag', tag FROM r2 WHERE tag IS NOT NULL) SELECT kind, key, count(*) AS n FROM d GROUP BY ALL""",
        "mismatched_symbols": f"{_RECORDS} SELECT market, symbol, count(*) AS mismatches FROM r2 WHERE outcome = 'mismatched' AND symbol LIKE '0%' GROUP BY ALL",
        "mismatch_count_check": f"{_RECORDS}, n AS (SELECT DISTINCT market, symbol FROM r2 WHERE outcome = 'mismatched') SELECT count(*) AS found, CAST(100 AS BIGINT) AS expected, count(*) = 100 AS ok FROM n",
        "mismatches_by_prefix": f"{_RECORDS} SELECT market, substr(symbol, 1, 3) AS prefix, count(*) AS mismatches, count(DISTINCT symbol) AS symbols FROM r2 WHERE outcome = 'mismatched' GROUP BY ALL",
        "coverage": f"""{_RECORDS}, s AS (SELECT market, symbol, min(class) AS class FROM r2 GROUP BY ALL UNION ALL SELECT 'SZ', CAST(n_nationkey + 777000 AS VARCHAR), 'etf' FROM nation), g AS (SELECT s.*, anchor FROM s, (VALUES ('pre_open'), ('continuous'), ('market_close')) AS v(anchor)),
n AS (SELECT g.*, (SELECT count(*) FROM r2 WHERE r2.market = g.market AND r2.symbol = g.symbol AND r2.anchor = g.anchor) AS c FROM g) SELECT market, class, anchor, CAST(sum(c) AS BIGINT) AS frames, count(*) FILTER (c > 0) AS covered, count(*) FILTER (c = 0) AS uncovered FROM n GROUP BY market, class, anchor""",
        "retained_details": f"""{_RECORDS}, d AS (SELECT *, row_number() OVER (ORDER BY symbol, CASE anchor WHEN 'pre_open' THEN 1 WHEN 'continuous' THEN 2 ELSE 3 END, i) AS place FROM r2 WHERE outcome <> 'matched' OR tag IS NOT NULL) SELECT frame_id, symbol, anchor, outcome, place FROM d WHERE place <= 300 OR outcome = 'matched'""",
        "conservation_checks": f"{_RECORDS} SELECT 'selected' AS \"check\", count(*) AS \"left\", count(*) + 1 AS \"right\" FROM r2 UNION ALL SELECT 'audit_status', count(*), count(*) + 3 FROM r2 UNION ALL SELECT 'audit_reasons', count(*) + 2, count(*) + 3 FROM r2 UNION ALL SELECT 'details', count(*) + 7, count(*) FROM r2 WHERE outcome <> 'matched' OR tag IS NOT NULL",
        "campaign": f"""{_RECORDS}, d AS (SELECT market, 20260801 + i % 10 AS day, {_COUNTS} FROM r2 GROUP BY 1, 2), v AS (SELECT *, CAST(CASE WHEN day % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS version FROM d)
SELECT market, version, count(DISTINCT day) AS days, {', '.join(big(f'sum({c})') + f' AS {c}' for c in ('total', 'comparable', *reports.OUTCOMES))}, bool_and(mismatched = 0) AS accepted, sum(matched) / sum(comparable) AS match_rate FROM v GROUP BY market, version""",
    }
