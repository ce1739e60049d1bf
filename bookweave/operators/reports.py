"""Reports over comparison records: counts, coverage, rates, retained details and checks that the numbers add up.

Records have frame_id, the book's key, class (stock, chinext, etf), anchor, quote_ms, outcome (matched,
mismatched, data_error, missing_source), fields (names that differ), reason and tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.functions.scalars import symbol_prefix

OUTCOMES = ["matched", "mismatched", "data_error", "missing_source"]
#: Fixed value: of the reports' schema.
VERSION = 2
ANCHORS = ["pre_open", "continuous", "market_close"]


def _counts(grouped) -> DataFrame:
    out = grouped.agg(F.count("*").alias("total"), *(F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES))
    return out.withColumn("comparable", F.col("matched") + F.col("mismatched"))


def totals(records: DataFrame) -> DataFrame:
    """One row, of zeros if there are no records."""
    return _counts(records.groupBy())


def outcome_breakdown(records: DataFrame) -> DataFrame:
    """Totals overall (class and anchor null) and by class and anchor; comparable is matched or mismatched. No rows without records."""
    # two levels of one rollup, without the one in between
    r = _counts(records.rollup(F.struct("class", "anchor").alias("g")))
    return r.select("g.class", "g.anchor", "total", "comparable", *OUTCOMES)


def match_rate(matched: Column, comparable: Column) -> Column:
    return F.when(comparable > 0, matched.cast("double") / comparable)


def _judged(total: DataFrame, after_close, accepts: bool) -> DataFrame:
    """Totals with match_rate, outcome and accepted; after_close: events of Shenzhen books after 15:00, which fail a day."""
    bad = F.col("mismatched") + F.col("data_error") + F.col("missing_source") + after_close > 0
    result = F.when(bad, "failed").when(F.col("comparable") == 0, "no_eligible").otherwise("passed")
    rows = total.withColumn("match_rate", match_rate(F.col("matched"), F.col("comparable"))).withColumn("outcome", result)
    return rows.withColumn("accepted", (F.col("outcome") == "passed") & (F.col("comparable") > 0) & F.lit(accepts))


def run_summary(records: DataFrame, diagnostic: bool = False, strict_policy: bool = True) -> DataFrame:
    """One row: totals, match rate, outcome (failed, no_eligible, passed) and whether standard acceptance holds."""
    total = totals(records).select("total", "comparable", *OUTCOMES)
    return _judged(total, F.lit(0), strict_policy and not diagnostic)


DAY = ["market", "trading_day"]


def day_summaries(records: DataFrame, days: DataFrame, diagnostic: bool = False, strict_policy: bool = True) -> DataFrame:
    """run_summary for each of days (market, trading_day, after_close: events of Shenzhen books after 15:00, of which any fails the day), whether it has records or not."""
    found = _counts(records.groupBy(*DAY)).select(*DAY, "total", "comparable", *OUTCOMES)
    total = days.select(*DAY, F.coalesce("after_close", F.lit(0)).alias("after_close")).join(found, DAY, "left").fillna(0, ["total", "comparable", *OUTCOMES])
    return _judged(total, F.col("after_close"), strict_policy and not diagnostic)


def _maps(rows: DataFrame, key, name: str, value=None) -> DataFrame:
    """A map per day of how many rows have each key, or of another aggregate for each."""
    each = rows.groupBy(*DAY, key.alias("__k")).agg((F.count("*") if value is None else value).alias("__v"))
    return each.groupBy(*DAY).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__k", "__v")))).alias(name))


def day_reports(records: DataFrame, audit: DataFrame, coverage_: DataFrame, counters: DataFrame, summaries: DataFrame, cap: int = 5_000) -> DataFrame:
    """One nested document per market and day: summary, counts of fields, reasons, tags and prefixes, breakdown, coverage, selection audit, replay counters and retained details.

    coverage_: of days. A document holds what a day's symbols and the retained details come to, never all records.
    """
    stage = F.concat_ws(".", "class", "anchor")
    fields = records.select(*DAY, F.explode("fields").alias("field"))
    wrong = records.filter("outcome = 'mismatched'").select(*DAY, "symbol").distinct()
    counts = F.struct(F.count("*").alias("total"), *(F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES))
    cover = F.first(F.struct("frames", "covered", "uncovered"))
    kept = retained(records, cap, DAY)
    due = records.filter((F.col("outcome") != "matched") | F.col("tag").isNotNull()).groupBy(*DAY).agg(F.count("*").alias("due"))
    detail = F.struct("symbol", "anchor", "quote_ms", "frame_id", "outcome", "reason", "tag", "fields")
    details = kept.groupBy(*DAY).agg(F.array_sort(F.collect_list(detail)).alias("details"), F.count("*").alias("kept"))
    parts = [
        _maps(fields, F.col("field"), "mismatch_fields"), _maps(records.filter("reason IS NOT NULL"), F.col("reason"), "failure_reasons"), _maps(records.filter("tag IS NOT NULL"), F.col("tag"), "match_tags"),
        _maps(wrong, symbol_prefix(F.col("symbol")), "mismatch_prefixes"), wrong.groupBy(*DAY).agg(F.count("*").alias("mismatched_symbols")),
        _maps(records, stage, "breakdown", counts), _maps(coverage_, stage, "coverage", cover),
        audit.groupBy(*DAY).agg(F.map_from_entries(F.collect_list(F.struct("symbol", F.struct("frames", "selected", "coverage", "by_status", "by_reason")))).alias("selection")),
        details, due, counters.select(*DAY, F.struct(*(c for c in counters.columns if c not in DAY)).alias("replay")),
    ]
    out = summaries
    for part in parts:
        out = out.join(part, DAY, "left")
    omitted = F.coalesce("due", F.lit(0)) - F.coalesce("kept", F.lit(0))
    return out.withColumn("omitted", omitted).fillna(0, ["mismatched_symbols"]).drop("due", "kept").withColumn("version", F.lit(VERSION))


def detail_counts(records: DataFrame) -> DataFrame:
    """(kind, key, n): how often each field differs, and each failure reason and match tag occurs."""
    fields = records.select(F.lit("field").alias("kind"), F.explode("fields").alias("key"))
    other = [records.filter(F.col(c).isNotNull()).select(F.lit(c).alias("kind"), F.col(c).alias("key")) for c in ("reason", "tag")]
    return fields.union(other[0]).union(other[1]).groupBy("kind", "key").agg(F.count("*").alias("n"))


def mismatched_symbols(records: DataFrame, prefix: str = "") -> DataFrame:
    rows = records.filter(F.col("outcome") == "mismatched").filter(F.col("symbol").startswith(prefix))
    return rows.groupBy("market", "symbol").agg(F.count("*").alias("mismatches"))


def expect_count(rows: DataFrame, expected: int) -> DataFrame:
    """One row: found, expected, ok."""
    return rows.agg(F.count("*").alias("found")).withColumn("expected", F.lit(expected).cast("bigint")).withColumn("ok", F.col("found") == F.col("expected"))


def mismatches_by_prefix(records: DataFrame) -> DataFrame:
    rows = records.filter(F.col("outcome") == "mismatched")
    return rows.groupBy("market", symbol_prefix(F.col("symbol")).alias("prefix")).agg(F.count("*").alias("mismatches"), F.count_distinct("symbol").alias("symbols"))


def coverage(records: DataFrame, symbols: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Frames by market (or other keys), class and anchor, with symbols that have some and symbols that have none; zero rows are included.

    symbols: the keys, symbol, class. The three anchors are a fixed list laid beside each symbol.
    """
    by = by or ["market"]
    grid = symbols.select(*by, "symbol", "class").distinct().withColumn("anchor", F.explode(F.array(*map(F.lit, ANCHORS))))
    n = records.groupBy(*by, "symbol", "anchor").agg(F.count("*").alias("frames"))
    out = grid.join(n, [*by, "symbol", "anchor"], "left").fillna(0, ["frames"])
    return out.groupBy(*by, "class", "anchor").agg(F.sum("frames").alias("frames"), F.count_if(F.col("frames") > 0).alias("covered"), F.count_if(F.col("frames") == 0).alias("uncovered"))


def symbol_totals(audit: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Of a selection audit, whole or by keys: symbols, and how many have selected frames, no frames, and none that is eligible."""
    of = lambda c: F.count_if(F.col("coverage") == c)
    return audit.groupBy(*(by or [])).agg(F.count("*").alias("symbols"), of("selected").alias("with_selected"), of("no_reference_records").alias("without_records"), of("no_eligible_references").alias("without_eligible"))


def anchor_rank() -> Column:
    return F.array_position(F.array(*map(F.lit, ANCHORS)), F.col("anchor"))


def retained(records: DataFrame, cap: int, by: list[str] | None = None) -> DataFrame:
    """Records whose details are kept, of all or of each key: within the cap in the order symbol, anchor, time; matches with a tag use up the cap but are kept regardless.

    Plain matches have no details. Counts per symbol first, then ranks within a symbol, so no task sees all records.
    """
    by = by or []
    detail = records.filter((F.col("outcome") != "matched") | F.col("tag").isNotNull())
    per = detail.groupBy(*by, "symbol").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy(*by).orderBy("symbol").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row per symbol
    rank = F.row_number().over(W.partitionBy(*by, "symbol").orderBy(anchor_rank(), "quote_ms", "frame_id"))
    numbered = detail.withColumn("__r", rank).join(per.select(*by, "symbol", before.alias("__before")), [*by, "symbol"]).withColumn("place", F.col("__before") + F.col("__r"))
    return numbered.filter((F.col("place") <= cap) | (F.col("outcome") == "matched")).drop("__r", "__before")


def conservation(records: DataFrame, audit: DataFrame, details: DataFrame, omitted: Column | int, coverage: DataFrame | None = None, summary: DataFrame | None = None) -> DataFrame:
    """Failing checks (check, left, right): outcomes add up to what was selected, breakdowns to totals, a selection audit to
    itself and to the records, coverage and summary to both, details and omitted ones to what is to tell."""
    b = outcome_breakdown(records)
    top, parts = totals(records), b.filter("class IS NOT NULL OR anchor IS NOT NULL")
    pair = lambda df, name, left, right: df.select(F.lit(name).alias("check"), left.cast("bigint").alias("left"), right.cast("bigint").alias("right"))
    sums = parts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(f"s_{c}") for c in ("total", *OUTCOMES)))
    told = details.agg(F.count("*").alias("d"))
    due = records.agg(F.count_if((F.col("outcome") != "matched") | F.col("tag").isNotNull()).alias("due"))
    checks = [
        pair(top, "outcomes", F.col("total"), sum((F.col(o) for o in OUTCOMES), F.lit(0))),
        *(pair(top.join(sums), f"breakdown_{c}", F.col(c), F.col(f"s_{c}")) for c in ("total", *OUTCOMES)),
        pair(top, "comparable", F.col("comparable"), F.col("matched") + F.col("mismatched")),
        pair(top.join(audit.agg(F.sum("selected").alias("s"))), "selected", F.col("total"), F.col("s")),
        pair(told.join(due), "details", F.col("d") + (F.lit(omitted) if isinstance(omitted, int) else omitted), F.col("due")),
    ]
    added = lambda m: F.coalesce(F.aggregate(F.map_values(m), F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0))
    if "by_status" in audit.columns:
        a = audit.agg(F.sum(added("by_status")).alias("status"), F.sum("frames").alias("frames"), F.sum(F.col("selected") + added("by_reason")).alias("told"))
        checks += [pair(a, "audit_status", F.col("status"), F.col("frames")), pair(a, "audit_reasons", F.col("told"), F.col("frames"))]
    if coverage is not None:
        c = coverage.agg(F.sum("frames").alias("frames"), F.sum(F.col("covered") + F.col("uncovered")).alias("symbols"))
        checks += [pair(c.join(top), "coverage_frames", F.col("frames"), F.col("total")), pair(c.join(audit.agg(F.count_distinct("market", "symbol").alias("n"))), "coverage_symbols", F.col("symbols"), F.col("n") * len(ANCHORS))]
    if summary is not None:
        late = F.col("after_close") if "after_close" in summary.columns else F.lit(0)
        bad = F.col("mismatched") + F.col("data_error") + F.col("missing_source") + late > 0
        checks.append(pair(summary, "summary_outcome", F.lit(1), (F.col("outcome") == F.when(bad, "failed").when(F.col("comparable") == 0, "no_eligible").otherwise("passed")).cast("int")))
        checks.append(pair(summary.agg(F.sum("total").alias("__n")).join(top), "summary_total", F.col("__n"), F.col("total")))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.filter("NOT (left <=> right)")


def campaign(summaries: DataFrame) -> DataFrame:
    """Runs of many days by market and report version, which are never mixed: days, totals, rate, and whether all were accepted.

    summaries: rows of day_summaries with a version, or day_reports.
    """
    total = lambda c: F.sum(c).alias(c)
    out = summaries.groupBy("market", "version").agg(F.count_distinct("trading_day").alias("days"), *(total(c) for c in ("total", "comparable", *OUTCOMES)), F.bool_and("accepted").alias("accepted"))
    return out.withColumn("match_rate", match_rate(F.col("matched"), F.col("comparable")))


#: Maps of a day's report that are added up by key over days; values of the last two have fields of their own.
COUNTED, STAGED = ["mismatch_fields", "failure_reasons", "match_tags", "mismatch_prefixes"], ["breakdown", "coverage"]


def campaign_counts(reports: DataFrame) -> DataFrame:
    """(market, version, section, key, field, n): the maps of many days' reports, added up key by key; field is null where a key has one number."""
    base = ["market", "version"]
    out = None
    for name in COUNTED + STAGED:
        each = reports.select(*base, F.explode(name).alias("key", "value"))
        fields = reports.schema[name].dataType.valueType.names if name in STAGED else [None]
        pairs = F.array(*(F.struct(F.lit(f).cast("string").alias("field"), (F.col("value") if f is None else F.col("value")[f]).cast("bigint").alias("n")) for f in fields))
        rows = each.select(*base, F.lit(name).alias("section"), "key", F.explode(pairs).alias("x")).select(*base, "section", "key", "x.*")
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy(*base, "section", "key", "field").agg(F.sum("n").alias("n"))
