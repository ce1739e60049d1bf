"""What keeps work in proportion to rows: compiled methods, rows parsed once, days told by arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookweave import market_day
from bookweave.functions import scalars as S
from bookweave.operators import integrity, ledger, placement, validation
from bookweave.operators.slices import Running, running
from bookweave.plans import audits, core, days
from bookweave.shared import LARGEST_METHOD, written
from bookweave.sources import vendor

SMALL = "/root/testdata/sf0.001"


def test_methods_that_are_not_compiled_are_not_used(spark):
    written(spark.range(3), "range")
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= LARGEST_METHOD


def test_vendor_rows_are_parsed_once(spark):
    root, _ = days._files(spark, SMALL, "SH")
    day = market_day.rebuild(spark, root, "SH")
    assert day.rows.count() > day.events.count() // 2 > 0
    assert set(day.events.inputFiles()) == set(day.rows.inputFiles())
    assert not any("date=" in f for f in day.rows.inputFiles())


def test_days_agree_with_the_calendar(spark):
    day = F.col("day")
    whole = spark.range(16_000_000, 21_100_000, 1, 4).select(F.col("id").cast("int").alias("day")).filter("day % 10000 BETWEEN 0 AND 1400 AND day DIV 10000 IN (1600, 1700, 1900, 1999, 2000, 2023, 2024, 2100)")
    odd = spark.createDataFrame([(x,) for x in (None, -20240101, 0, 101, 9_999_999, 10_000_101, 99_991_231, 99_991_232, 100_000_101)], "day int")
    told = F.try_to_date(day.cast("string"), "yyyyMMdd")
    good = F.coalesce(day.cast("string").rlike("^[0-9]{8}$") & told.isNotNull(), F.lit(False))
    for rows in (whole, odd):
        x = rows.select(day, S.valid_day(day).alias("valid"), S.day_epoch_ms(day).alias("ms"), good.alias("good"), F.when(good, F.unix_date(told).cast("bigint") * 86_400_000).alias("wanted"))
        assert x.filter("valid <> good OR NOT (ms <=> wanted)").limit(5).collect() == []


def test_events_are_read_once_for_the_feed(spark):
    """A feed's plan scans the events once and joins nothing."""
    from bookweave.plans.feed import order_feed

    for df in (order_feed(spark, SMALL), days.vendor_events(spark, SMALL, "SZ"), days.vendor_events(spark, SMALL, "SH")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("event_type#") and plan.count("Relation [") == 1 and "Join" not in plan


def test_orders_with_prices_of_their_own_are_not_shuffled_again(spark):
    """Where no order is placed, changes follow from the ledger alone; times that go back are looked for once."""
    root, _ = days._files(spark, SMALL, "SZ")
    day = market_day.rebuild(spark, root, "SZ")
    led = written(ledger.ledger(day.events), "ledger")
    plan = placement.placed_deltas(day.events, led, day.placed)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and day.changes.count() > 0
    assert "Window" not in day.regressions._jdf.queryExecution().optimizedPlan().toString()


def test_classes_are_counted_by_book_first(spark):
    rows = spark.createDataFrame([("SZ", 1, "000001", 1, "A", "selected"), ("SZ", 1, "000001", 2, "S", "selected"), ("SZ", 1, None, None, None, "unselected"), ("SZ", 2, "000002", 1, "T", "after_cutoff")], "market string, trading_day int, symbol string, channel int, kind string, row_class string")
    one = integrity.class_counters(rows).first().asDict()
    assert one == {"input_rows": 4, "selected": 2, "unsupported": 0, "unselected": 1, "after_cutoff": 1, "channels": 2, "symbols": 1, "applied": 1, "status_rows": 1}
    assert integrity.class_counters(rows.limit(0)).first().asDict() == dict.fromkeys(one, 0)
    plan = integrity.class_counters(rows, ["market", "trading_day"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate [market")


def test_days_are_published_together(spark, monkeypatch):
    """The ledger of three days' frames is one job, not one for each day."""
    asked, real = [], ledger.ledger
    monkeypatch.setattr(ledger, "ledger", lambda events: asked.append(1) or real(events))
    root = audits._three_days(spark, SMALL)
    assert len(asked) == 1
    frames = vendor.read_reference(spark, root, "SZ").groupBy("trading_day").agg(F.count_distinct("symbol").alias("symbols"), F.min("quote_ms").alias("ms"), F.count("*").alias("frames")).orderBy("trading_day").collect()
    assert [r.trading_day for r in frames] == audits.DAYS and sum(r.symbols for r in frames) == days.vendor_events(spark, SMALL, "SZ").select("symbol").distinct().count()
    assert all(r.frames == 52 * r.symbols and r.ms == days.midnight(r.trading_day) + 33_300_000 + days.STEP for r in frames)


def test_last_values_of_slices_are_aggregated_by_hash(spark):
    """A slice's last value is told by the number alone, so nothing is sorted for it."""
    rows = spark.createDataFrame([(1, n, n % 7) for n in range(9)], "k int, n bigint, v bigint")
    out = running(rows, ["k"], "n", {"last": Running("last", F.col("v"))})
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.n, r.last) for r in out.collect()) == [(n, n % 7) for n in range(9)]
    faulty = spark.createDataFrame([(1, 1, 5), (1, 2, None), (1, 3, 4), (1, 4, 4)], "k int, source_row bigint, seq bigint")
    found = integrity.sequence_regressions(faulty, ["k"])
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert [(r.previous_seq, r.seq, r.previous_row, r.row, r.equal) for r in found.collect()] == [(4, 4, 3, 4, True)]


def test_states_know_the_event_before(spark):
    """Candidates take the event before from the states, and number points themselves only where some are hidden."""
    feed, changes = core.rebuilt(spark, SMALL)
    points = written(validation.states(feed, changes), "states")
    frames = spark.createDataFrame([(i, "SZ", 20240101, f"{i % 20:06d}", core.ORIGIN_MS + i * 43_200_000) for i in range(1, 40)], "frame_id bigint, market string, trading_day int, symbol string, quote_ms bigint")
    frames = validation.with_window(frames, 1000, 3000)
    known, numbered = (validation.candidates(frames, p, 3000) for p in (points, points.drop("prev_seq")))
    windows = [x._jdf.queryExecution().optimizedPlan().toString().count("Window [") for x in (known, numbered)]
    assert windows[0] < windows[1] and sorted(known.collect()) == sorted(numbered.collect())


def test_rules_are_gone_through_once(spark):
    """What a day's rows break is written before the day is refused; to look again reads no rows."""
    root, _ = days._files(spark, SMALL, "SH")
    broken = market_day.replay_day(spark, root, "SH", step_ms=days.STEP, check_files=False).violations
    plan = broken._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Aggregate" not in plan and broken.count() == 0


def test_rules_need_no_changes(spark, monkeypatch):
    """Broken rules alone are told without the books' changes, which are written once if asked for."""
    seen, real = [], market_day.written
    monkeypatch.setattr(market_day, "written", lambda df, name: seen.append(name) or real(df, name))
    root, _ = days._files(spark, SMALL, "SH")
    day = market_day.rebuild(spark, root, "SH")
    assert day.violations.count() == 0 and "changes" not in seen
    assert day.changes.count() == day.changes.count() > 0 and seen.count("changes") == 1
