"""Faulty days and files, day reports and campaigns over several days, each with its SQL.

Three trading days follow one another; a symbol is traded on the day that its number divided by three leaves. On the
second day every symbol has one order more after the close.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookweave import market_day
from bookweave.operators import reports
from bookweave.plans import days as one_day
from bookweave.plans.days import DAY, MIDNIGHT, STEP, TRADING_DAY
from bookweave.schema import BOOK
from bookweave.shared import new_path, written
from bookweave.sources import sinks, vendor

DAYS = [TRADING_DAY + i for i in range(3)]
#: Details that a day's report keeps.
DETAILS = 40


def _three_days(spark: SparkSession, sf_dir: str) -> str:
    """Vendor files of three Shenzhen days."""
    root, nth = new_path(spark, "vendor"), F.substring("symbol", 4, 3).cast("int") % 3
    days = one_day.vendor_events(spark, sf_dir, "SZ").withColumns({"trading_day": F.lit(TRADING_DAY) + nth, "quote_ms": F.col("quote_ms") + nth * DAY})
    events = written(days, "days")
    more = events.filter(F.col("trading_day") == DAYS[1]).groupBy(*BOOK, "channel").agg((F.max("seq") + 20).alias("seq"), F.lit(one_day.midnight(DAYS[1]) + 54_005_000).alias("quote_ms"))
    more = more.withColumns({"kind": F.lit("A"), "ord_type": F.lit("limit"), "side": F.lit("B"), "bid_no": F.col("seq"), "price": F.lit(90_000).cast("bigint"), "qty": F.lit(100).cast("bigint")})
    events = events.unionByName(written(more, "late"), allowMissingColumns=True)
    for day in DAYS:
        one_day.write_ticks(events.filter(F.col("trading_day") == day), root, "SZ", day)
    one_day._publish(root, events, "SZ", tuple(DAYS))
    return root


def _reports(spark, sf_dir) -> DataFrame:
    """Reports of three days, validated in one job, written and read back."""
    made = market_day.validate_day(spark, _three_days(spark, sf_dir), "SZ", check_files=False, details=DETAILS).reports
    path = new_path(spark, "reports")
    sinks.write_day_reports(made, path)
    return sinks.read_day_reports(spark, path, made)


def report_days(spark, sf_dir):
    """What stands in the reports: totals, replay counters, what was selected, retained details and whether the day is accepted."""
    r = _reports(spark, sf_dir)
    picked = F.aggregate(F.map_values("selection"), F.lit(0).cast("bigint"), lambda a, x: a + x["selected"])
    return r.select(
        "trading_day", "version", "outcome", "accepted", "total", "comparable", *reports.OUTCOMES, "match_rate", "mismatched_symbols", "after_close", "replay.applied", "replay.direct_rest_limits", "replay.symbols",
        F.size(F.map_keys("replay.after_close_by_symbol")).alias("late_symbols"), F.size(F.map_keys("selection")).alias("audited"), picked.alias("selected"), F.size("details").alias("details"), "omitted",
    ).withColumn("late_symbols", F.greatest("late_symbols", F.lit(0)))


def campaign_days(spark, sf_dir):
    """The three days' reports rolled up."""
    return reports.campaign(_reports(spark, sf_dir))


def campaign_keys(spark, sf_dir):
    """The maps of the three days' reports, added up key by key."""
    return reports.campaign_counts(_reports(spark, sf_dir))


def _files(spark, events: DataFrame) -> str:
    root = new_path(spark, "vendor")
    one_day.write_ticks(written(events, "events"), root, "SZ")
    return root


def cut_books(spark, sf_dir):
    """Snapshots of a day on which every fiftieth event, where it is a cancel, takes one share too many: each book ends at its first."""
    e = one_day.vendor_events(spark, sf_dir, "SZ")
    wrong = (F.col("kind") == "C") & (F.floor(F.col("seq") / 20) % 50 == 0)
    root = _files(spark, e.withColumn("qty", F.when(wrong, F.col("qty") + 1).otherwise(F.col("qty"))))
    snaps = market_day.replay_day(spark, root, "SZ", step_ms=STEP, on_fault="cut", check_files=False).snapshots
    return snaps.groupBy("symbol").agg(F.count_if(F.col("kind") == "scheduled").alias("scheduled"), F.count_if(F.col("kind") == "market_close").alias("closes"), F.sum("volume").alias("volume"), F.max(F.when(F.col("kind") == "scheduled", F.col("boundary_ms"))).alias("last_ms"))


def replay_report(spark, sf_dir):
    """Counters of a Shenzhen day of stocks that runs ten minutes late, and whose executions are not all in order in their file."""
    e = one_day.vendor_events(spark, sf_dir, "SZ").withColumn("quote_ms", F.col("quote_ms") + 600_000)
    moved = (F.col("kind") != "A") & (F.floor(F.col("seq") / 20) % 13 == 0)
    root = _files(spark, e.withColumn("source_row", F.when(moved, (F.col("seq") + 2_000) * 2 + 1).otherwise(F.col("seq") * 2)))
    c = market_day.replay_day(spark, root, "SZ", step_ms=STEP, universe="stocks", check_files=False).counters
    summed = lambda f: F.coalesce(F.aggregate("repairs", F.lit(0).cast("bigint"), lambda a, x: a + x[f]), F.lit(0))
    late = F.array_join(F.transform(F.map_entries("after_close_by_symbol"), lambda x: F.concat_ws("=", x["key"], x["value"])), ",")
    return c.select("trading_day", "input_rows", "selected", "unselected", "applied", "symbols", "channels", "direct_rest_limits", "after_close_events", late.alias("late"), "repaired_streams", summed("rows").alias("repaired_rows"), summed("runs").alias("runs"), "scheduled", "market_close")


# ------------------------------------------------------------------ files

_STORED = {"uint64": pa.uint64(), "int64": pa.int64(), "int32": pa.int32(), "large_string": pa.large_string(), "decimal128(38, 3)": pa.decimal128(38, 3)}
_FEED, _CONTRACT = vendor.FEEDS["sh_ticks"]


def _customer_files(spark, sf_dir) -> DataFrame:
    """A tick file for each nation, its rows made from the nation's customers, with faults in footers and types by its number: nation, path, market, feed, date, bytes, rows, schema_sha256."""
    root = new_path(spark, "files")
    wanted = [(n, vendor.stored_type(n, t.replace(";", ","))) for n, t in vendor._columns(_CONTRACT)]
    out = "nation int, path string, market string, feed string, date string, bytes bigint, rows bigint, schema_sha256 string"

    def write(table: pa.Table) -> pa.Table:
        import pyarrow.parquet as pq

        n, ids = table.column("c_nationkey")[0].as_py(), table.column("c_custkey").combine_chunks()
        fields = {c: _STORED["int32" if n % 4 == 1 and c == "Qty" else t] for c, t in wanted if not (n % 4 == 2 and c == "Price")}
        meta = {
            "clara.raw.market": "XX" if n % 5 == 3 else "SH", "clara.raw.feed": _FEED, "clara.raw.document_version": "4.0" if n % 5 == 1 else "4.1", "clara.raw.format_version": "2", "clara.raw.date": str(TRADING_DAY),
            "clara.raw.schema_id": vendor.SCHEMA_ID.format(market="SH", feed=_FEED), **({} if n % 5 == 2 else {"clara.raw.schema_hash": "h"}),
        }
        rows = pa.table([ids.cast(pa.string()).cast(t) if "string" in str(t) else ids.cast(pa.int64()).cast(t) for t in fields.values()], schema=pa.schema(list(fields.items())))
        fs, inner, _ = vendor._open(path := f"{root}/nation={n}/part-0.parquet")
        fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(inner) as f:
            pq.write_table(rows.replace_schema_metadata(meta), f)
        size, hashed = fs.get_file_info(inner).size, hashlib.sha256(str(rows.schema.remove_metadata()).encode()).hexdigest()
        return pa.Table.from_pylist([{"nation": n, "path": path, "market": "SH", "feed": _FEED, "date": str(TRADING_DAY), "bytes": size, "rows": len(rows), "schema_sha256": hashed}], schema=pa.schema([("nation", pa.int32()), *((c, pa.string()) for c in ("path", "market", "feed", "date")), ("bytes", pa.int64()), ("rows", pa.int64()), ("schema_sha256", pa.string())]))

    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_nationkey").cast("int").alias("c_nationkey"), F.col("c_custkey").cast("bigint").alias("c_custkey"))
    return written(customers.groupBy("c_nationkey").applyInArrow(write, out), "files")


def _nation() -> F.Column:
    return F.regexp_extract("path", "nation=([0-9]+)", 1).cast("int").alias("nation")


def footer_faults(spark, sf_dir):
    return vendor.check_footers(spark, _customer_files(spark, sf_dir)).filter("NOT ok").select(_nation(), "key", "expected", "actual")


def type_faults(spark, sf_dir):
    return vendor.check_types(spark, _customer_files(spark, sf_dir)).select(_nation(), "column", "expected", "actual")


def inventory_faults(spark, sf_dir):
    """An inventory that is wrong about the rows of every third nation, about the bytes of the next, and that names a file that is not there."""
    files, n = _customer_files(spark, sf_dir), F.col("nation")
    told = files.withColumns({"rows": F.when(n % 3 == 1, F.col("rows") + 1).otherwise(F.col("rows")), "bytes": F.when(n % 3 == 2, F.col("bytes") + 7).otherwise(F.col("bytes")), "path": F.when(n == 24, F.replace("path", F.lit("part-0"), F.lit("part-1"))).otherwise(F.col("path"))})
    found = vendor.inventory_check(spark, told).filter("NOT ok").select(_nation(), "check", "expected", "actual")
    return found.withColumns({c: F.when(F.col("check") == "bytes", None).otherwise(F.col(c)) for c in ("expected", "actual")})


def queries():
    names = [report_days, campaign_days, campaign_keys, cut_books, replay_report, footer_faults, type_faults, inventory_faults]
    return {f.__name__: f for f in names}


# ------------------------------------------------------------------ SQL


def _records_sql() -> str:
    """CTEs: what each frame of the three days comes to (y)."""
    one = one_day._validate_sql("SZ", "true")
    return f"""WITH one AS ({one}),
y0 AS (SELECT *, CAST(substr(symbol, 4) AS INTEGER) AS n, CAST({TRADING_DAY} + CAST(substr(symbol, 4) AS INTEGER) % 3 AS INTEGER) AS trading_day FROM one),
y AS (SELECT trading_day, n, symbol, class, anchor, quote_ms, CASE WHEN late THEN 'data_error' ELSE outcome END AS outcome, CASE WHEN late THEN 'events_after_close' ELSE reason END AS reason, CASE WHEN late THEN '' ELSE fields END AS fields, CASE WHEN late THEN NULL ELSE tag END AS tag
  FROM (SELECT *, n % 3 = 1 AND anchor = 'market_close' AS late FROM y0))"""


def _totals(rows: str) -> str:
    of = ", ".join(f"count(*) FILTER (outcome = '{o}') AS {o}" for o in reports.OUTCOMES)
    return f"count(*) AS total, count(*) FILTER (outcome IN ('matched', 'mismatched')) AS comparable, {of} FROM {rows}"


def oracle_sql():
    records, feed = _records_sql(), one_day._cte("SZ")
    ticks = f"{feed}, nos AS (SELECT *, CAST(substr(symbol, 4) AS INTEGER) AS n FROM f)"
    plain = {"mismatch_fields": "unnest(string_split(fields, ',')) AS key FROM y WHERE fields <> ''", "failure_reasons": "reason AS key FROM y WHERE reason IS NOT NULL", "match_tags": "tag AS key FROM y WHERE tag IS NOT NULL"}
    keys = [f"SELECT '{s}' AS section, key, CAST(NULL AS VARCHAR) AS field, count(*) AS n FROM (SELECT {q}) GROUP BY key" for s, q in plain.items()]
    keys.append("SELECT 'mismatch_prefixes', substr(symbol, 1, 3), NULL, count(DISTINCT symbol) FROM y WHERE outcome = 'mismatched' GROUP BY 2")
    keys += [f"SELECT 'breakdown', class || '.' || anchor, '{f}', count(*) FILTER ({c}) FROM y GROUP BY 2" for f, c in [("total", "true"), *((o, f"outcome = '{o}'") for o in reports.OUTCOMES)]]
    keys += [f"SELECT 'coverage', class || '.' || anchor, '{f}', {c} FROM y GROUP BY class, anchor" for f, c in (("frames", "count(*)"), ("covered", "count(DISTINCT symbol)"), ("uncovered", "0"))]
    nations = "WITH c AS (SELECT CAST(c_nationkey AS INTEGER) AS nation, count(*) AS rows FROM customer GROUP BY 1)"
    footers = [("1", "clara.raw.document_version", "4.1", "'4.0'"), ("3", "clara.raw.market", "SH", "'XX'"), ("2", "clara.raw.schema_hash", "not empty", "NULL")]
    union = lambda parts: reduce(lambda a, b: f"{a} UNION ALL {b}", parts)
    listed = [
        ("nation % 3 = 1", "rows", "CAST(rows + 1 AS VARCHAR)", "CAST(rows AS VARCHAR)"), ("nation % 3 = 2", "bytes", "NULL", "NULL"), ("nation % 5 = 1", "document_version", "'4.1'", "'4.0'"), ("nation % 5 = 3", "market", "'SH'", "'XX'"), ("nation % 5 = 2", "hashed", "'true'", "'false'"),
    ]
    return {
        "report_days": f"""{records}, t AS (SELECT trading_day, max(n % 3) AS d, count(DISTINCT symbol) AS symbols, count(DISTINCT symbol) FILTER (outcome = 'mismatched') AS mismatched_symbols, count(*) FILTER (outcome <> 'matched' OR tag IS NOT NULL) AS due, {_totals('y')} GROUP BY trading_day),
k AS (SELECT trading_day, count(*) FILTER (place <= {DETAILS} OR outcome = 'matched') AS details FROM (SELECT *, row_number() OVER (PARTITION BY trading_day ORDER BY symbol, CASE anchor WHEN 'pre_open' THEN 1 WHEN 'continuous' THEN 2 ELSE 3 END, quote_ms) AS place FROM y WHERE outcome <> 'matched' OR tag IS NOT NULL) GROUP BY 1),
e AS (SELECT CAST({TRADING_DAY} + n % 3 AS INTEGER) AS trading_day, count(*) AS applied, count(*) FILTER (kind = 'A') AS adds FROM ({ticks} SELECT * FROM nos) GROUP BY 1)
SELECT t.trading_day, CAST(2 AS INTEGER) AS version, CASE WHEN mismatched + data_error + missing_source + CASE WHEN d = 1 THEN symbols ELSE 0 END > 0 THEN 'failed' ELSE 'passed' END AS outcome, mismatched + data_error + missing_source + CASE WHEN d = 1 THEN symbols ELSE 0 END = 0 AS accepted, total, comparable, matched, mismatched, data_error, missing_source,
  matched / comparable AS match_rate, mismatched_symbols, CASE WHEN d = 1 THEN symbols ELSE 0 END AS after_close, applied + CASE WHEN d = 1 THEN symbols ELSE 0 END AS applied, adds + CASE WHEN d = 1 THEN symbols ELSE 0 END AS direct_rest_limits, symbols,
  CAST(CASE WHEN d = 1 THEN symbols ELSE 0 END AS INTEGER) AS late_symbols, CAST(symbols AS INTEGER) AS audited, total AS selected, CAST(details AS INTEGER) AS details, due - details AS omitted
FROM t JOIN k USING (trading_day) JOIN e USING (trading_day)""",
        "campaign_days": f"{records}, t AS (SELECT count(DISTINCT trading_day) AS days, {_totals('y')}) SELECT 'SZ' AS market, CAST(2 AS INTEGER) AS version, days, total, comparable, matched, mismatched, data_error, missing_source, matched / comparable AS match_rate, mismatched + data_error + missing_source = 0 AS accepted FROM t",
        "campaign_keys": f"{records} SELECT 'SZ' AS market, CAST(2 AS INTEGER) AS version, * FROM ({union(keys)})",
        "cut_books": f"""{feed}, z AS (SELECT symbol, arg_min(quote_ms, seq) AS end_ms FROM f WHERE kind = 'C' AND seq // 20 % 50 = 0 GROUP BY symbol),
b AS (SELECT s.symbol, k, CASE WHEN k <= 27 THEN {MIDNIGHT} + 33300000 + k * {STEP} WHEN k <= 51 THEN {MIDNIGHT} + 46800000 + (k - 27) * {STEP} ELSE {MIDNIGHT} + 54000001 END AS upto, end_ms FROM (SELECT DISTINCT symbol FROM f) s LEFT JOIN z USING (symbol), (SELECT unnest(range(1, 53)) AS k)),
x AS (SELECT b.*, (SELECT coalesce(sum(qty), 0) FROM f WHERE f.symbol = b.symbol AND kind = 'T' AND quote_ms < upto) AS volume FROM b WHERE end_ms IS NULL OR (k < 52 AND upto <= end_ms))
SELECT symbol, count(*) FILTER (k < 52) AS scheduled, count(*) FILTER (k = 52) AS closes, CAST(sum(volume) AS BIGINT) AS volume, max(upto) FILTER (k < 52) AS last_ms FROM x GROUP BY symbol""",
        "replay_report": f"""{feed}, g AS (SELECT *, quote_ms + 600000 > {MIDNIGHT} + 54000000 AS late, CASE WHEN kind <> 'A' AND seq // 20 % 13 = 0 THEN (seq + 2000) * 2 + 1 ELSE seq * 2 END AS row_ FROM f), s AS (SELECT * FROM g WHERE symbol NOT LIKE '159%'),
r AS (SELECT channel, kind = 'A' AS adds, count(*) AS rows, count(*) FILTER (seq < p) + 1 AS runs FROM (SELECT *, lag(seq) OVER (PARTITION BY channel, kind = 'A' ORDER BY row_) AS p FROM s) GROUP BY 1, 2 HAVING count(*) FILTER (seq < p) > 0),
l AS (SELECT string_agg(symbol || '=' || n, ',' ORDER BY symbol) AS late, CAST(sum(n) AS BIGINT) AS n FROM (SELECT symbol, count(*) AS n FROM s WHERE late GROUP BY symbol))
SELECT CAST({TRADING_DAY} AS INTEGER) AS trading_day, (SELECT count(*) FROM g) AS input_rows, count(*) AS selected, (SELECT count(*) FROM g WHERE symbol LIKE '159%') AS unselected, count(*) AS applied, count(DISTINCT symbol) AS symbols, count(DISTINCT channel) AS channels, count(*) FILTER (kind = 'A') AS direct_rest_limits,
  coalesce((SELECT n FROM l), 0) AS after_close_events, coalesce((SELECT late FROM l), '') AS late, (SELECT count(*) FROM r) AS repaired_streams, CAST(coalesce((SELECT sum(rows) FROM r), 0) AS BIGINT) AS repaired_rows, CAST(coalesce((SELECT sum(runs) FROM r), 0) AS BIGINT) AS runs, count(DISTINCT symbol) * 51 AS scheduled, count(DISTINCT symbol) AS market_close FROM s""",
        "footer_faults": nations + " " + union([f"SELECT nation, '{k}' AS key, '{e}' AS expected, {a} AS actual FROM c WHERE nation % 5 = {m}" for m, k, e, a in footers]),
        "type_faults": nations + " SELECT nation, 'Qty' AS \"column\", 'int64' AS expected, 'int32' AS actual FROM c WHERE nation % 4 = 1 UNION ALL SELECT nation, 'Price', 'decimal128(38, 3)', 'missing' FROM c WHERE nation % 4 = 2",
        "inventory_faults": nations + " " + union([f"SELECT nation, '{k}' AS \"check\", {e} AS expected, {a} AS actual FROM c WHERE nation <> 24 AND {w}" for w, k, e, a in listed] + ["SELECT nation, 'exists', 'true', 'false' FROM c WHERE nation = 24"]),
    }
