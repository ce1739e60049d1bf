"""The exchange's published snapshots: which frames count, by trading phase, and what they say about a day's limits.

The phase rules look sequential, but each frame's fate follows from windows over its symbol's frames in
source order: the status before it, whether trading was seen before, and where the closing zone began.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.functions.scalars import day_epoch_ms, in_class, limit_class, time_of_day
from bookweave.schema import BOOK

#: From this day funds in Shanghai close through a closing call like stocks.
SH_ETF_CLOSE_CALL_FROM = 20260706
OPEN_FROM, OPEN_TO = 33_900_000, 34_200_000  # 09:25 and 09:30

NOT_APPLICABLE, REPEATED, UNEXPECTED, MISSING, OUTSIDE = "status_not_applicable", "additional_static_frame", "unexpected_phase_transition", "missing_normal_predecessor", "outside_selection_window"


def select_phases(frames: DataFrame, order: str = "source_row", pre_open_only: bool = False) -> DataFrame:
    """frames (book, status, quote_ms, order) with anchor (pre_open, continuous or market_close; null if skipped) and skip_reason.

    With pre_open_only, frames of other anchors do not apply.
    """
    w = W.partitionBy(*BOOK).orderBy(order)
    before = w.rowsBetween(W.unboundedPreceding, -1)
    ever = lambda c: F.coalesce(F.max(c.cast("int")).over(before), F.lit(0)) == 1
    f = frames.withColumn("__prev", F.lag("status").over(w))
    sh, tod, s = F.col("market") == "SH", time_of_day(F.col("quote_ms")), F.col("status")
    early_fund = sh & in_class(F.col("market"), F.col("symbol"), "etf") & (F.col("trading_day") < SH_ETF_CLOSE_CALL_FROM)
    trade = F.coalesce(F.when(sh, s == "TRADE").otherwise(s == "T0"), F.lit(False))
    opening = F.coalesce(F.when(sh, (s == "TRADE") & (tod >= OPEN_FROM) & (tod < OPEN_TO)).otherwise(s == "B0"), F.lit(False))
    running = F.coalesce(F.when(sh, (s == "TRADE") & (tod >= OPEN_TO)).otherwise(s == "T0"), F.lit(False))
    early = F.coalesce(sh & (s == "TRADE") & (tod < OPEN_FROM), F.lit(False))
    call, close = F.coalesce(s == F.when(sh, "CCALL").otherwise("C0"), F.lit(False)), F.coalesce(s == F.when(sh, "CLOSE").otherwise("E0"), F.lit(False))
    auction = F.coalesce(s == F.when(sh, "OCALL").otherwise("O0"), F.lit(False))

    f = f.withColumns({"__call": call, "__close": close, "__open": opening, "__run": running, "__early": early, "__auction": auction, "__fund": early_fund})
    f = f.withColumns({"__called": ever(F.col("__call")), "__ran": ever(F.col("__run"))})
    pred_close = F.when(F.col("__fund"), (F.col("__prev") == "TRADE") & F.col("__ran") & ~F.col("__called")).otherwise(F.col("__prev") == F.when(sh, "CCALL").otherwise("C0"))
    f = f.withColumn("__close_ok", F.coalesce(F.col("__close") & pred_close, F.lit(False)))
    f = f.withColumn("__closed", ever(F.col("__close_ok")))
    f = f.withColumn("__zone", F.col("__called") | (F.col("__fund") & F.col("__closed")))
    f = f.withColumn("__traded", ever(F.col("__run") & ~F.col("__zone")))
    pred_open = F.col("__prev") == F.when(sh, "OCALL").otherwise("O0")
    f = f.withColumn("__open_ok", F.coalesce(F.col("__open") & pred_open & ~F.col("__traded") & ~F.col("__zone"), F.lit(False)))
    f = f.withColumn("__opened", ever(F.col("__open_ok")))

    t = F.col
    anchor = (
        F.when(t("__close"), F.when(~t("__closed") & t("__close_ok"), "market_close"))
        .when(t("__open"), F.when(t("__open_ok") & ~t("__opened"), "pre_open"))
        .when(t("__run"), F.when(~t("__zone"), "continuous"))
    )
    reason = (
        F.when(t("__close"), F.when(t("__closed"), REPEATED).otherwise(MISSING))
        .when(t("__open"), F.when(t("__zone"), UNEXPECTED).when(t("__traded"), F.when(sh, MISSING).otherwise(NOT_APPLICABLE)).when(t("__opened"), REPEATED).otherwise(MISSING))
        .when(t("__run"), UNEXPECTED)
        .when(t("__early"), F.when(t("__zone"), UNEXPECTED).otherwise(OUTSIDE))
        .when(t("__auction"), F.when(t("__traded") | t("__zone"), UNEXPECTED).otherwise(NOT_APPLICABLE))
        .when(t("__call"), F.when(t("__closed"), UNEXPECTED).otherwise(NOT_APPLICABLE))
        .otherwise(NOT_APPLICABLE)
    )
    f = f.withColumn("anchor", anchor).withColumn("skip_reason", F.when(F.col("anchor").isNull(), reason)).withColumn("previous_status", F.col("__prev"))
    if pre_open_only:
        other = F.col("anchor") != "pre_open"
        f = f.withColumns({"skip_reason": F.when(other, NOT_APPLICABLE).otherwise(F.col("skip_reason")), "anchor": F.when(~other, F.col("anchor"))})
    return f.select(*frames.columns, "previous_status", "anchor", "skip_reason")


def position_faults(frames: DataFrame, order: tuple[str, ...] = ("file_name", "file_row")) -> DataFrame:
    """Frames that break their book's order, selected or not: a time or a row number that falls, or a row number that does not rise, from one frame to the next in the files.

    order: where a frame stands, by default in its file as it was read. A frame without a time or a number breaks none.
    """
    w = W.partitionBy(*BOOK).orderBy(*order)
    f = frames.withColumns({"previous_ms": F.lag("quote_ms").over(w), "previous_row": F.lag("source_row").over(w)})
    return f.filter("quote_ms < previous_ms OR source_row <= previous_row").select(*BOOK, "source_row", "quote_ms", "previous_ms", "previous_row")


def duplicate_times(selected: DataFrame) -> DataFrame:
    """Continuous frames that share their time with another of their book; each is a load error."""
    n = F.count("*").over(W.partitionBy(*BOOK, "quote_ms"))
    return selected.filter("anchor = 'continuous'").withColumn("frames", n).filter("frames > 1")


def preopen_cutoff(selected: DataFrame) -> DataFrame:
    """One row per market and day: a second after the last selected pre-open frame, or 09:30 where there is none."""
    last = F.max(F.when(F.col("anchor") == "pre_open", F.col("quote_ms")))
    opening = day_epoch_ms(F.col("trading_day")) - 28_800_000 + OPEN_TO
    return selected.groupBy("market", "trading_day").agg(last.alias("last")).select("market", "trading_day", F.coalesce(F.col("last") + 1000, opening).alias("cutoff_ms"))


#: Skip reasons of which the first frame is kept as a sample.
SAMPLED = [MISSING, OUTSIDE, UNEXPECTED]


def selection_audit(selected: DataFrame, symbols: DataFrame | None = None, order: str = "source_row") -> DataFrame:
    """Per book: frames, frames by status, selected by anchor, skipped by reason, the first sample of three reasons, and coverage.

    coverage: `selected`, `no_eligible_references`, or, for books of symbols (market, symbol, trading_day)
    without any frame, `no_reference_records`.
    """
    per = lambda c: F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "n"))))
    total = selected.groupBy(*BOOK).agg(
        F.count("*").alias("frames"), F.count("anchor").alias("selected"), *(F.count_if(F.col("anchor") == a).alias(a) for a in ("pre_open", "continuous", "market_close")),
    )
    status = selected.filter("status IS NOT NULL").groupBy(*BOOK, "status").agg(F.count("*").alias("n")).groupBy(*BOOK).agg(per("status").alias("by_status"))
    previous = "previous_status" if "previous_status" in selected.columns else F.lit(None).cast("string").alias("previous_status")
    sample = F.min_by(F.struct("quote_ms", F.col(order).alias("source_row"), previous, "status"), order)
    skipped = selected.filter("skip_reason IS NOT NULL").groupBy(*BOOK, "skip_reason").agg(F.count("*").alias("n"), sample.alias("first"))
    sampled = F.filter(F.collect_list(F.struct("skip_reason", "first")), lambda x: x["skip_reason"].isin(SAMPLED))
    reason = skipped.groupBy(*BOOK).agg(per("skip_reason").alias("by_reason"), F.map_from_entries(F.array_sort(sampled)).alias("first_sample"))
    if symbols is not None:
        total = symbols.select(*BOOK).distinct().join(total, BOOK, "left").fillna(0, ["frames", "selected", "pre_open", "continuous", "market_close"])
    coverage = F.when(F.col("selected") > 0, "selected").when(F.col("frames") > 0, "no_eligible_references").otherwise("no_reference_records")
    return total.join(status, BOOK, "left").join(reason, BOOK, "left").withColumn("coverage", coverage)


def day_limits(frames: DataFrame, order: str = "source_row", missing: Column | None = None) -> DataFrame:
    """Per book over all frames: the first pair of limits, whether it has an upper limit, and the first sticky error.

    frames: high_limit and low_limit in units. A pair that is invalid, or differs from the first, is an
    error from there on. A rounded "no limit" counts as one where `missing` (reception fields) holds.
    """
    gone = F.lit(False) if missing is None else missing
    kind = limit_class(F.col("high_limit"), F.col("low_limit"), gone)
    fixed = F.when((kind == "unlimited") & gone & (F.col("high_limit") == 10_000_000_000_000), F.lit(9_999_999_999_999).cast("bigint")).otherwise(F.col("high_limit"))
    f = frames.select(*BOOK, order, kind.alias("kind"), fixed.alias("high"), F.col("low_limit").alias("low"), (fixed != F.col("high_limit")).alias("normalised"))
    good = F.when(F.col("kind") != "invalid", F.struct("high", "low"))
    w = W.partitionBy(*BOOK).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    f = f.withColumn("first", F.first(good, ignorenulls=True).over(w))
    wrong = F.when(F.col("kind") == "invalid", "invalid").when((F.col("high") != F.col("first.high")) | (F.col("low") != F.col("first.low")), "conflict")
    f = f.withColumn("wrong", wrong)
    return f.groupBy(*BOOK).agg(
        F.min_by("first", F.when(F.col("first").isNotNull(), F.col(order))).alias("pair"), F.min_by("kind", F.when(F.col("kind") != "invalid", F.col(order))).alias("kind"),
        F.min_by("wrong", F.when(F.col("wrong").isNotNull(), F.col(order))).alias("error"), F.min(F.when(F.col("wrong").isNotNull(), F.col(order))).alias("error_row"), F.count_if("normalised").alias("normalised"),
    ).select(*BOOK, F.col("pair.high").alias("high_limit"), F.col("pair.low").alias("low_limit"), "kind", "error", "error_row", "normalised")
