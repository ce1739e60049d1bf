"""Whole market days, from vendor files to results: rebuild every book and sample it, or hold it against published frames.

Both take many days at once and return DataFrames; nothing runs before one of them is used, but for the
tables that several of them share, which are written to the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookweave.functions.scalars import clock_ms, day_epoch_ms, in_class
from bookweave.operators import faults, integrity, ledger, placement, reference, reports, rounds, snapshots, validation
from bookweave.operators.book import deltas
from bookweave.schema import BOOK
from bookweave.shared import written
from bookweave.sources import vendor

MARKETS = ("SH", "SZ")
DAY = ["market", "trading_day"]
#: Events beyond which a book is not folded by one task.
LARGE_BOOK = 5_000_000


@dataclass(frozen=True)
class Day:
    """Books rebuilt: selected events, their visible changes, placements (Shenzhen), events earlier than one before them, and all rules that rows break."""

    rows: DataFrame
    events: DataFrame
    placed: DataFrame | None
    regressions: DataFrame
    violations: DataFrame
    ledger: DataFrame

    @cached_property
    def changes(self) -> DataFrame:
        """Written when first asked for; what asks for broken rules alone needs none."""
        out = deltas(self.ledger) if self.placed is None else placement.placed_deltas(self.events, self.ledger, self.placed)
        return written(out, "changes")


@dataclass(frozen=True)
class Replay:
    """snapshots (kind scheduled or market_close), counters (a row per market and day), streams that had to be put in order, and the rules that rows break (none in a good day)."""

    snapshots: DataFrame
    counters: DataFrame
    repairs: DataFrame
    violations: DataFrame


@dataclass(frozen=True)
class Validation:
    """A record per selected frame, what was selected per symbol and day, and, for each market and day, how far anchors and symbols are covered, a summary, and all of it as one nested report."""

    records: DataFrame
    audit: DataFrame
    coverage: DataFrame
    symbols: DataFrame
    summary: DataFrame
    reports: DataFrame
    violations: DataFrame


def _checked(spark: SparkSession, root: str, market: str, days: list[int] | None, on_fault: str, check_files: bool, frames: bool = False) -> None:
    if market not in MARKETS:
        raise ValueError(f"market {market}")
    if on_fault not in faults.POLICIES:
        raise ValueError(f"on_fault {on_fault}")
    if check_files:
        vendor.refuse_faulty_files(spark, root, market, days, frames)


def _read(spark: SparkSession, root: str, market: str, days: list[int] | None) -> DataFrame:
    if market not in MARKETS:
        raise ValueError(f"market {market}")
    rows = vendor.read_sh_ticks(spark, root, days) if market == "SH" else vendor.read_sz(spark, root, days)
    local = day_epoch_ms(F.col("trading_day")) - 28_800_000 + clock_ms(F.col("local_time"))
    return rows.withColumn("local_ms", local).drop("local_time")  # no later step asks for the text


def _wanted(rows: DataFrame, universe: str, symbols: list[str] | None) -> Column:
    return F.col("symbol").isin(integrity.checked_symbols(symbols)) if symbols is not None else integrity.in_universe(universe)


def _placements(events: DataFrame, led: DataFrame, policy: str) -> DataFrame:
    """Where orders rest: large books in rounds, by all tasks together, the others by folding, a book a task. Both give the same rows."""
    large = written(events.groupBy(*BOOK).agg(F.count("*").alias("n")).filter(F.col("n") > LARGE_BOOK).select(*BOOK), "large")
    if large.isEmpty():
        return placement.placements(events, policy)
    inside, outside = (written(events.join(large, BOOK, how), "books") for how in ("left_semi", "left_anti"))
    return placement.placements(outside, policy).unionByName(rounds.placements_in_rounds(inside, policy, led))


def rebuild(spark: SparkSession, root: str, market: str, days: list[int] | None = None, universe: str = "both", symbols: list[str] | None = None, policy: str = "rest_at_last_trade", cutoff: DataFrame | None = None) -> Day:
    """Scan, select, order and rebuild the books of a market's days.

    cutoff: market, trading_day, cutoff_ms; rows from then on are left out. Rows that break a rule of their
    own fields are violations and apply to no book.
    """
    rows = _read(spark, root, market, days)
    if cutoff is not None:
        rows = rows.join(cutoff.select("market", "trading_day", "cutoff_ms"), ["market", "trading_day"], "left")
        late = F.coalesce(F.col("quote_ms") >= F.col("cutoff_ms"), F.lit(False))
    else:
        late = F.lit(False)
    chosen = F.when(~_wanted(rows, universe, symbols), F.when(integrity.in_universe("both"), "unselected").otherwise("unsupported")).when(late, "after_cutoff").otherwise("selected")
    # written as read: every row is parsed once, and filters on what was parsed do not parse it again
    rows = written(rows.withColumn("row_class", chosen), "rows")
    selected = rows.filter("row_class = 'selected'")
    events = selected.filter(F.size("faults") == 0).drop("faults", "row_class", "cutoff_ms")
    led = written(ledger.ledger(events), "ledger")
    regressions = written(integrity.time_regressions(events), "regressions")
    wrong = [
        vendor.violations(selected).select(*BOOK, "channel", "seq", "code"),
        ledger.reference_violations(events, led),
        integrity.after_close(events).select(*BOOK, "channel", "seq", F.lit("after_close").alias("code")),
        regressions.filter("NOT same_second").select(*BOOK, F.lit(None).cast("int").alias("channel"), "seq", F.lit("time_regression").alias("code")),
        integrity.duplicate_sequences(rows).select("market", "trading_day", F.lit(None).cast("string").alias("symbol"), "channel", "seq", F.lit("duplicate_sequence").alias("code")),
        integrity.channel_conflicts(events).select(*BOOK, F.col("first_channel").alias("channel"), F.lit(None).cast("bigint").alias("seq"), F.lit("channel_conflict").alias("code")),
    ]
    placed = None
    if market == "SZ":
        placed = written(_placements(events, led, policy), "placements")
        wrong.append(placed.filter("what = 'violation'").select(*BOOK, F.lit(None).cast("int").alias("channel"), F.col("rest_seq").alias("seq"), "code"))
    else:
        # native order is a channel's, over all its rows
        wrong.append(integrity.sequence_regressions(rows, ["market", "trading_day", "channel"]).select("market", "trading_day", F.lit(None).cast("string").alias("symbol"), "channel", "seq", F.lit("sequence_order").alias("code")))
    violations = wrong[0]
    for w in wrong[1:]:
        violations = violations.unionByName(w)
    return Day(rows, events, placed, regressions, violations, led)


def _counters(day: Day, repairs: DataFrame, snaps: DataFrame | None = None) -> DataFrame:
    """For each market and day: class_counters of what was read, and of what was rebuilt, put in order and sampled."""
    same = day.regressions.groupBy(*DAY).agg(F.count_if("same_second").alias("same_second_regressions"))
    limit = (F.col("market") == "SZ") & (F.col("kind") == "A") & (F.col("ord_type") == "limit")
    direct = day.events.groupBy(*DAY).agg(F.count_if(limit).alias("direct_rest_limits"))
    by_symbol = integrity.late_events(day.events).groupBy(*DAY).agg(F.sum("late").alias("after_close_events"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("symbol", "late")))).alias("after_close_by_symbol"))
    streams = repairs.groupBy(*DAY).agg(F.count("*").alias("repaired_streams"), F.array_sort(F.collect_list(F.struct("channel", "stream", "rows", "runs", "duplicates"))).alias("repairs"))
    parts = [same, direct, by_symbol, streams]
    groups = ("pending_groups", "inferred_remainders", "empty_same_side_cancels")
    if day.placed is not None:
        order = day.events.filter("kind = 'A'").select(*BOOK, F.col("side").alias("order_side"), F.col("seq").alias("order_no"), "ord_type")
        told = day.placed.filter("what = 'group'").join(order, [*BOOK, "order_side", "order_no"], "left")
        parts.append(told.groupBy(*DAY).agg(F.count("*").alias(groups[0]), F.count_if(F.col("code") == "inferred").alias(groups[1]), F.count_if((F.col("ord_type") == "same_side_best") & (F.col("code") == "cancelled")).alias(groups[2])))
    if snaps is not None:
        parts.append(snaps.groupBy(*DAY).agg(F.count_if(F.col("kind") == "scheduled").alias("scheduled"), F.count_if(F.col("kind") == "market_close").alias("market_close"), F.count("*").alias("output_rows")))
    out = integrity.class_counters(day.rows, DAY)
    for part in parts:  # a row a day each
        out = out.join(part, DAY, "left")
    none = [c for c in groups if c not in out.columns]
    return out.withColumns({c: F.lit(0).cast("bigint") for c in none}).fillna(0)


def _repairs(day: Day) -> DataFrame:
    """Streams of Shenzhen, whose two files are merged by number; Shanghai's order is checked, not mended."""
    return integrity.sequence_repairs(day.rows.filter("row_class = 'selected' AND market = 'SZ'"))


def replay_day(
    spark: SparkSession, root: str, market: str, days: list[int] | None = None, step_ms: int = 30_000, depth: int = 10, universe: str = "both", symbols: list[str] | None = None, policy: str = "rest_at_last_trade",
    on_fault: str = "raise", check_files: bool = True,
) -> Replay:
    """Every selected security's book at each boundary of the grid and at the close.

    A file whose footer or types are wrong is refused before any row is read. A day that breaks a rule is refused before
    anything of it is told (on_fault `raise`), or its books end at their first faults (`cut`): boundaries after them, and
    their closes, are not told.
    """
    _checked(spark, root, market, days, on_fault, check_files)
    day = rebuild(spark, root, market, days, universe, symbols, policy)
    events, changes, violations, ends = day.events, day.changes, day.violations, None
    if on_fault != "keep":
        violations = written(violations, "violations")  # the rules are gone through once, and the caller may look again
    if on_fault == "raise":
        faults.refuse(violations)
    elif on_fault == "cut":
        ends = written(faults.book_ends(violations, events, day.rows.filter("row_class = 'selected'")), "ends")
        events, changes = (written(faults.before_end(x, ends), "before") for x in (events, changes))
    grid = snapshots.grid_snapshots(events, changes, step_ms, depth).drop("k").withColumn("kind", F.lit("scheduled"))
    close = snapshots.close_snapshots(events, changes, depth).withColumn("kind", F.lit("market_close"))
    if ends is not None:
        grid = grid.join(ends.select(*BOOK, "end_ms"), BOOK, "left").filter("end_ms IS NULL OR boundary_ms <= end_ms").drop("end_ms")
        close = close.join(ends, BOOK, "left_anti")
    channel = written(events.groupBy(*BOOK).agg(F.min("channel").alias("channel")), "channels")
    snaps = written(grid.unionByName(close).join(channel, BOOK), "snapshots")
    repairs = written(_repairs(day), "repairs")
    return Replay(snaps, _counters(day, repairs, snaps), repairs, violations)


def _hidden_points(placed: DataFrame) -> DataFrame:
    """(book, seq) of states inside a response group, which is seen only as a whole."""
    group = placed.filter("what = 'group' AND rest_seq > order_no")
    return group.select(*BOOK, F.explode(F.sequence("order_no", F.col("rest_seq") - 1)).alias("seq")).distinct()


def validate_day(
    spark: SparkSession, root: str, market: str, days: list[int] | None = None, universe: str = "both", symbols: list[str] | None = None, policy: str = "require_evidence",
    back_ms: int | None = None, ahead_ms: int | None = None, pre_open_only: bool = False, on_fault: str = "raise", check_files: bool = True, details: int = 5_000,
) -> Validation:
    """Hold every selected published frame against the states rebuilt round its time.

    With pre_open_only, events after the last selected pre-open frame of the day (09:30 where there is none) are left out,
    and so are other anchors. Faulty files and days are refused, unless on_fault is `keep`. details: records that a day's
    report keeps.
    """
    _checked(spark, root, market, days, on_fault, check_files, frames=True)
    if on_fault == "cut":
        raise ValueError("a day that is held against published frames is whole or not at all: on_fault is raise or keep")
    frames = vendor.read_reference(spark, root, market, days)
    frames = frames.filter(_wanted(frames, universe, symbols))
    id_ = F.concat_ws("-", "trading_day", "symbol", "source_row")
    picked = written(reference.select_phases(frames, pre_open_only=pre_open_only).withColumn("frame_id", id_), "phases")
    limits = reference.day_limits(frames, missing=F.col("missing_reception")) if market == "SZ" else None
    cutoff = reference.preopen_cutoff(picked) if pre_open_only else None
    day = rebuild(spark, root, market, days, universe, symbols, policy, cutoff)
    positions = reference.position_faults(frames).select(*BOOK, F.lit(None).cast("int").alias("channel"), F.lit(None).cast("bigint").alias("seq"), F.lit("reference_position").alias("code"))
    violations = day.violations.unionByName(positions)
    if on_fault == "raise":
        violations = written(violations, "violations")
        faults.refuse(violations)

    shared = reference.duplicate_times(picked).select("frame_id", F.lit(True).alias("twice"))
    selected = picked.filter("anchor IS NOT NULL").join(shared, "frame_id", "left")
    selected = written(selected.withColumn("load_error", F.when(F.coalesce("twice", F.lit(False)), F.concat("load_error", F.array(F.lit("duplicate_time")))).otherwise(F.col("load_error"))).drop("twice"), "selected")

    points = written(validation.states(day.events, day.changes), "states")
    open_ = validation.with_window(selected.filter("anchor <> 'market_close'"), back_ms, ahead_ms)
    seen = points if day.placed is None else points.drop("prev_seq").join(_hidden_points(day.placed), [*BOOK, "seq"], "left_anti")  # of those seen, the one before is another
    best = validation.best_match(open_, validation.candidates(open_, seen), points, day.changes)
    columns = ["frame_id", "seq", "apply_seq", "at_ms", "matched", "fields", "tag", "error", "excluded_bid", "excluded_ask"]
    none = {"tag": "string", "error": "string", "excluded_bid": "bigint", "excluded_ask": "bigint"}
    best = best.withColumns({c: F.lit(None).cast(t) for c, t in none.items()}).select(*columns)
    cut = snapshots.close_cut(day.events)
    close = validation.closing_match(selected.filter("anchor = 'market_close'"), cut, points, day.changes, day.events, limits).select(*columns)

    books = day.events.select(*BOOK, F.lit(True).alias("seen")).distinct()
    late = integrity.late_events(day.events) if market == "SZ" else day.events.filter("false").select(*BOOK, F.lit(0).cast("bigint").alias("late"))
    all_ = selected.join(best.unionByName(close), "frame_id", "left").join(books, BOOK, "left").join(late, BOOK, "left")
    after = (F.col("anchor") == "market_close") & (F.coalesce("late", F.lit(0)) > 0)
    conditions = after, F.size("load_error") > 0, F.coalesce("seen", F.lit(False)), F.col("error").isNotNull()
    kind = F.when(in_class(F.col("market"), F.col("symbol"), "etf"), "etf").otherwise("stock")
    result = validation.outcome(*conditions, F.coalesce("matched", F.lit(False)))
    fields = F.array_sort(F.transform("fields", lambda x: x["field"]))
    records = all_.select(
        "frame_id", *BOOK, kind.alias("class"), "anchor", "quote_ms", "source_row", result.alias("outcome"), validation.failure_reason(*conditions).alias("reason"),
        F.when(result == "mismatched", fields).otherwise(F.array().cast("array<string>")).alias("fields"), F.when(result == "matched", F.col("tag")).alias("tag"), "seq", "apply_seq", "at_ms", "excluded_bid", "excluded_ask",
    )
    records = written(records, "records")
    books_ = integrity.observed_books(frames, day.events)
    audit = reference.selection_audit(picked, books_)
    cover = reports.coverage(records, books_.withColumn("class", kind), DAY)
    counters = _counters(day, _repairs(day))
    seen_days = books_.select(*DAY).distinct().join(counters.select(*DAY, F.col("after_close_events").alias("after_close")), DAY, "left")
    summary = reports.day_summaries(records, seen_days, diagnostic=back_ms is not None or ahead_ms is not None, strict_policy=policy == "require_evidence")
    documents = reports.day_reports(records, audit, cover, counters, summary, details)
    return Validation(records, audit, cover, reports.symbol_totals(audit, DAY), summary, documents, violations)
