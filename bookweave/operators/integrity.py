"""Universe, row classes, ordering checks and run counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookweave.functions.scalars import PREFIXES, in_class, time_of_day
from bookweave.operators.slices import Running, running
from bookweave.schema import BOOK

FIFTEEN = 54_000_000


def in_universe(universe: str) -> Column:
    """stocks, etfs or both."""
    stock, etf = (in_class(F.col("market"), F.col("symbol"), k) for k in ("stock", "etf"))
    return {"stocks": stock, "etfs": etf, "both": stock | etf}[universe]


def checked_symbols(symbols: list[str]) -> list[str]:
    """An explicit list of symbols; an empty one, or a symbol of no supported class, is refused."""
    known = {p for ps in PREFIXES.values() for p in ps}
    wrong = [s for s in symbols if not (len(s) == 6 and s.isascii() and s.isdigit() and s[:3] in known)]
    if not symbols or wrong:
        raise ValueError(f"symbols {wrong or symbols}")
    return sorted(set(symbols))


def select_symbols(events: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows of the listed (market, symbol) pairs."""
    return events.join(symbols.select("market", "symbol").distinct(), ["market", "symbol"], "left_semi")


def row_class(universe: str = "both", cutoff_ms: Column | None = None) -> Column:
    """selected, unsupported, unselected or after_cutoff, tested in the order symbol, universe, time."""
    c = F.when(~in_universe("both"), "unsupported").when(~in_universe(universe), "unselected")
    if cutoff_ms is not None:
        c = c.when(F.col("quote_ms") >= cutoff_ms, "after_cutoff")
    return c.otherwise("selected")


def business(events: DataFrame) -> DataFrame:
    """Events that change books or statistics; status rows do not, nor do they move time on."""
    return events.filter("kind <> 'S'")


def _after(rows: DataFrame, key: list[str], order: str, seq: str) -> DataFrame:
    """key, seq, row, and the seq and row before it in source order. Slices alone are windows; what lies before a slice is one row."""
    narrow = rows.select(*key, F.col(seq).alias("seq"), F.col(order).cast("bigint").alias("row"))
    none = F.lit(-(1 << 63))  # a row without a sequence is one before, too
    out = running(narrow, key, "row", {"previous_seq": Running("last", F.coalesce("seq", none), before=True), "previous_row": Running("last", F.col("row"), before=True)})
    return out.select(*key, F.nullif("previous_seq", none).alias("previous_seq"), "seq", "previous_row", "row")


def sequence_regressions(rows: DataFrame, key: list[str], order: str = "source_row", seq: str = "seq") -> DataFrame:
    """Rows, in source order, whose sequence is not above the one before: previous, current and whether they are equal. Read twice."""
    return _after(rows, key, order, seq).filter("seq <= previous_seq").withColumn("equal", F.col("seq") == F.col("previous_seq"))


def natural_runs(rows: DataFrame, key: list[str], order: str = "source_row", seq: str = "seq") -> DataFrame:
    """For each key: rows, ascending runs in source order, and duplicates. Read three times."""
    runs = _after(rows, key, order, seq).groupBy(*key).agg(F.count("*").alias("rows"), (F.count_if(F.col("seq") < F.col("previous_seq")) + 1).alias("runs"))
    again = rows.filter(F.col(seq).isNotNull()).groupBy(*key, seq).agg((F.count("*") - 1).alias("n")).groupBy(*key).agg(F.sum("n").alias("duplicates"))
    return runs.join(again, key, "left").fillna(0, ["duplicates"])


def duplicate_sequences(*streams: DataFrame, key: list[str] = ("market", "trading_day", "channel")) -> DataFrame:
    """Sequence numbers that occur more than once on a channel, over one stream or several together."""
    all_ = streams[0].select(*key, "seq")
    for s in streams[1:]:
        all_ = all_.unionByName(s.select(*key, "seq"))
    return all_.groupBy(*key, "seq").agg(F.count("*").alias("rows")).filter("rows > 1")


def channel_conflicts(events: DataFrame) -> DataFrame:
    """Symbols seen on more than one channel, with the channel that came first by sequence."""
    return events.groupBy(*BOOK).agg(F.count_distinct("channel").alias("channels"), F.min_by("channel", "seq").alias("first_channel")).filter("channels > 1")


def time_regressions(events: DataFrame) -> DataFrame:
    """Business events earlier than the latest before them in their book: the high-water mark and whether both are in one second (allowed in validation). Read twice."""
    rows = business(events).select(*BOOK, "seq", "quote_ms")
    high = running(rows, BOOK, "seq", {"high_ms": Running("max", F.col("quote_ms"), before=True)})
    second = lambda c: F.floor(F.col(c) / 1000)
    return high.filter("quote_ms < high_ms").withColumn("same_second", second("quote_ms") == second("high_ms"))


def after_close(events: DataFrame) -> DataFrame:
    """Business events that come after their book's first CLOSE status row. Read twice."""
    close = events.filter("kind = 'S' AND status = 'CLOSE'").groupBy(*BOOK).agg(F.min("seq").alias("close_seq"))
    return events.filter("kind <> 'S'").join(close, BOOK).filter("seq > close_seq")


def late_events(events: DataFrame) -> DataFrame:
    """SZ business events after 15:00 by symbol."""
    late = (F.col("market") == "SZ") & (time_of_day(F.col("quote_ms")) > FIFTEEN)
    return business(events).filter(late).groupBy(*BOOK).agg(F.count("*").alias("late"))


def observed_symbols(*frames: DataFrame) -> DataFrame:
    """Every (market, symbol) that occurs in any of the frames, once."""
    out = frames[0].select("market", "symbol")
    for f in frames[1:]:
        out = out.union(f.select("market", "symbol"))
    return out.distinct()


def observed_books(*frames: DataFrame) -> DataFrame:
    """Every (market, trading_day, symbol) that occurs in any of the frames, once."""
    out = frames[0].select(*BOOK)
    for f in frames[1:]:
        out = out.union(f.select(*BOOK))
    return out.distinct()


def run_counters(events: DataFrame, universe: str = "both", cutoff_ms: Column | None = None) -> DataFrame:
    """One row: input rows, rows by class, channels, symbols, applied and status rows of what is selected."""
    return class_counters(events.withColumn("row_class", row_class(universe, cutoff_ms)))


def class_counters(events: DataFrame, by: list[str] | None = None) -> DataFrame:
    """run_counters of rows whose row_class is known, one row or one for each of `by`."""
    c, n = F.col("row_class"), F.col("__rows")
    chosen = c == "selected"
    total = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).cast("bigint")
    # rows of a book, channel and class are counted first, so that what is told apart is few
    each = events.groupBy(*BOOK, "channel", "row_class", (F.col("kind") == "S").alias("__status")).agg(F.count("*").alias("__rows"))
    return each.groupBy(*(by or [])).agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("input_rows"), *(total(c == k).alias(k) for k in ("selected", "unsupported", "unselected", "after_cutoff")),
        F.count_distinct(F.when(chosen, F.col("channel"))).alias("channels"), F.count_distinct(F.when(chosen, F.struct(*BOOK))).alias("symbols"),
        total(chosen & ~F.col("__status")).alias("applied"), total(chosen & F.col("__status")).alias("status_rows"),
    )


def sequence_repairs(rows: DataFrame) -> DataFrame:
    """Streams of a channel whose rows are not in native order in their file, and so had to be put in order: runs and duplicates. Read three times."""
    return natural_runs(rows.filter("stream IS NOT NULL"), ["market", "trading_day", "channel", "stream"]).filter("runs > 1")
