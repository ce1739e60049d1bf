"""Vendor tick and snapshot tables: contracts, scans into canonical columns, and violations instead of silent nulls.

Layout: <root>/date=YYYYMMDD/<feed>/part-0.parquet; many days are read in one job. Prices are exact
decimals and become integer units. Spark reads unsigned 64-bit columns as decimal(20,0).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookweave.functions.scalars import market_ts, missing_reception, ref_amount, ref_price, ref_price_error, ref_quantity, rescaled

#: Feed names and columns with their types as Spark reads them.
FEEDS = {
    "sh_ticks": ("mdl_4_24_0", "BizIndex decimal(20,0), Channel decimal(20,0), SecurityID string, TickTime string, Type string, BuyOrderNO decimal(20,0), SellOrderNO decimal(20,0), Price decimal(38,3), Qty bigint, TickBSFlag string, LocalTime string, source_row_no decimal(20,0)"),
    "sz_orders": ("mdl_6_33_0", "ChannelNo int, ApplSeqNum bigint, SecurityID string, Price decimal(38,4), OrderQty bigint, Side int, TransactTime string, OrdType int, LocalTime string, source_row_no decimal(20,0)"),
    "sz_executions": ("mdl_6_36_0", "ChannelNo int, ApplSeqNum bigint, BidApplSeqNum bigint, OfferApplSeqNum bigint, SecurityID string, LastPx decimal(38,4), LastQty bigint, ExecType int, TransactTime string, LocalTime string, source_row_no decimal(20,0)"),
}
SNAPSHOT_FEEDS = {"SH": "MarketData", "SZ": "mdl_6_28_0"}
#: Footer entries that every file must have, and those that must not be empty.
FOOTER = {"clara.raw.document_version": "4.1", "clara.raw.format_version": "2"}
FOOTER_FILLED = ["clara.raw.schema_hash", "clara.raw.schema_id"]
STATUS_FLAGS = ["CCALL", "CLOSE", "TRADE"]


def feed_path(root: str, day: int | str, feed: str) -> str:
    return f"{root.rstrip('/')}/date={day}/{feed}/part-0.parquet"


def _scan(spark: SparkSession, root: str, feed: str, schema: str, days: list[int] | None) -> DataFrame:
    """All files of a feed with trading_day from their path; a named day without a file is an error."""
    paths = [feed_path(root, d, feed) for d in days] if days else [feed_path(root, "*", feed)]
    return spark.read.option("basePath", root).schema(f"{schema}, date int").parquet(*paths).withColumnRenamed("date", "trading_day")


def _long(c: str) -> Column:
    return F.col(c).cast("bigint")


def _text(c: str) -> Column:
    """Trimmed text; empty is null, and null is a violation where the field is required."""
    return F.nullif(F.trim(c), F.lit(""))


def _number(c: str) -> Column:
    return F.nullif(_long(c), F.lit(0))


def _checked(df: DataFrame, faults: dict[str, Column]) -> DataFrame:
    """df with faults: the names of the rules a row breaks."""
    broken = {n: F.coalesce(c, F.lit(True)) for n, c in faults.items()}
    named = F.filter(F.array(*(F.when(c, n) for n, c in broken.items())), lambda x: x.isNotNull())
    # rows that break no rule, as most do, are spared the array
    return df.withColumn("faults", F.when(reduce(or_, broken.values()), named).otherwise(F.array().cast("array<string>")))


_COMMON = ["market", "trading_day", "symbol", "channel", "seq", "source_row", "stream", "kind", "ord_type", "side", "flag", "status", "bid_no", "ask_no", "price", "qty", "quote_ms", "local_time", "faults"]


def read_sh_ticks(spark: SparkSession, root: str, days: list[int] | None = None) -> DataFrame:
    """Shanghai ticks as canonical events (A add, D cancel, T trade, S status) with the rules each row breaks."""
    raw = _scan(spark, root, *FEEDS["sh_ticks"], days)
    kind = F.when(_text("Type") == "D", "C").when(_text("Type").isin("A", "T", "S"), _text("Type"))
    flag, status = _text("TickBSFlag"), F.coalesce(F.col("kind") == "S", F.lit(False))
    df = raw.select(
        F.lit("SH").alias("market"), "trading_day", _text("SecurityID").alias("symbol"), _long("Channel").cast("int").alias("channel"), _long("BizIndex").alias("seq"), _long("source_row_no").alias("source_row"),
        F.lit("ticks").alias("stream"), kind.alias("kind"), flag.alias("raw_flag"), _number("BuyOrderNO").alias("bid_no"), _number("SellOrderNO").alias("ask_no"), (F.col("Price") * 10_000).cast("bigint").alias("price"), F.col("Qty").alias("qty"),
        market_ts(F.col("trading_day"), F.trim("TickTime")).alias("quote_ms"), _text("LocalTime").alias("local_time"),
    )
    add, cancel, priced = (F.coalesce(F.col("kind").isin(*k), F.lit(False)) for k in ("A", "C", "AT"))
    df = df.withColumns({
        "ord_type": F.when(add, "limit"),
        "side": F.when(add | cancel, F.when(F.col("bid_no").isNotNull() & F.col("ask_no").isNull(), "B").when(F.col("ask_no").isNotNull() & F.col("bid_no").isNull(), "S")).otherwise(F.when(~status, F.when(F.col("raw_flag").isin("B", "S", "N"), F.col("raw_flag")))),
        "status": F.when(status, F.col("raw_flag")), "flag": F.when(~status, F.when(F.col("raw_flag").isin("B", "S", "N"), F.col("raw_flag")).otherwise("other")),
        "price": F.when(priced, F.col("price")),
    })
    df = _checked(df, {
        "kind": F.col("kind").isNull(), "sequence": ~(F.col("seq") > 0), "symbol": F.col("symbol").isNull(), "time": F.col("quote_ms").isNull(), "local_time": F.col("local_time").isNull(), "flag": F.col("raw_flag").isNull(),
        "price": priced & ~(F.col("price") > 0), "quantity": ~status & ~(F.col("qty") > 0), "side": (add | cancel) & F.col("side").isNull(), "status": status & ~F.col("status").isin(*STATUS_FLAGS, "START", "OCALL", "SUSP", "ENDTR"),
    })
    return df.select(*_COMMON)


def read_sz_orders(spark: SparkSession, root: str, days: list[int] | None = None) -> DataFrame:
    """Shenzhen orders as adds; the order's number is its own sequence number."""
    raw = _scan(spark, root, *FEEDS["sz_orders"], days)
    side = F.when(F.col("Side") == 49, "B").when(F.col("Side") == 50, "S")
    kind = F.when(F.col("OrdType") == 49, "market").when(F.col("OrdType") == 50, "limit").when(F.col("OrdType") == 85, "same_side_best")
    df = raw.select(
        F.lit("SZ").alias("market"), "trading_day", _text("SecurityID").alias("symbol"), F.col("ChannelNo").alias("channel"), F.col("ApplSeqNum").alias("seq"), _long("source_row_no").alias("source_row"), F.lit("orders").alias("stream"), F.lit("A").alias("kind"),
        kind.alias("ord_type"), side.alias("side"), F.lit(None).cast("string").alias("flag"), F.lit(None).cast("string").alias("status"), F.when(side == "B", F.col("ApplSeqNum")).alias("bid_no"), F.when(side == "S", F.col("ApplSeqNum")).alias("ask_no"),
        F.when(kind == "limit", (F.col("Price") * 10_000).cast("bigint")).alias("price"), F.col("OrderQty").alias("qty"), market_ts(F.col("trading_day"), F.trim("TransactTime")).alias("quote_ms"), _text("LocalTime").alias("local_time"),
    )
    return _checked(df, {
        "side": F.col("side").isNull(), "type": F.col("ord_type").isNull(), "sequence": ~(F.col("seq") > 0), "symbol": F.col("symbol").isNull(), "time": F.col("quote_ms").isNull(), "local_time": F.col("local_time").isNull(),
        "price": F.coalesce(F.col("ord_type") == "limit", F.lit(False)) & ~(F.col("price") > 0), "quantity": ~(F.col("qty") > 0),
    }).select(*_COMMON)


def read_sz_executions(spark: SparkSession, root: str, days: list[int] | None = None) -> DataFrame:
    """Shenzhen executions: trades and cancels, which name orders by sequence number."""
    raw = _scan(spark, root, *FEEDS["sz_executions"], days)
    kind = F.when(F.col("ExecType") == 70, "T").when(F.col("ExecType") == 52, "C")
    bid, ask = _number("BidApplSeqNum"), _number("OfferApplSeqNum")
    df = raw.select(
        F.lit("SZ").alias("market"), "trading_day", _text("SecurityID").alias("symbol"), F.col("ChannelNo").alias("channel"), F.col("ApplSeqNum").alias("seq"), _long("source_row_no").alias("source_row"), F.lit("executions").alias("stream"), kind.alias("kind"),
        F.lit(None).cast("string").alias("ord_type"), F.when(kind == "C", F.when(ask.isNull(), "B").otherwise("S")).otherwise("N").alias("side"), F.lit(None).cast("string").alias("flag"), F.lit(None).cast("string").alias("status"),
        bid.alias("bid_no"), ask.alias("ask_no"), F.when(kind == "T", (F.col("LastPx") * 10_000).cast("bigint")).alias("price"), F.col("LastQty").alias("qty"), market_ts(F.col("trading_day"), F.trim("TransactTime")).alias("quote_ms"), _text("LocalTime").alias("local_time"),
    )
    return _checked(df, {
        "kind": F.col("kind").isNull(), "sequence": ~(F.col("seq") > 0), "symbol": F.col("symbol").isNull(), "time": F.col("quote_ms").isNull(), "local_time": F.col("local_time").isNull(),
        "price": F.coalesce(F.col("kind") == "T", F.lit(False)) & ~(F.col("price") > 0), "quantity": ~(F.col("qty") > 0),
    }).select(*_COMMON)


def read_sz(spark: SparkSession, root: str, days: list[int] | None = None) -> DataFrame:
    """Both Shenzhen streams as one, ordered by sequence on a channel; equal numbers are for duplicate_sequences to find."""
    return read_sz_orders(spark, root, days).unionByName(read_sz_executions(spark, root, days))


#: Snapshot columns by market: source name and decimal scale (None: integer).
_REFERENCE = {
    "SH": {"status": "InstruStatus", "last_price": ("LastPrice", 3), "high_price": ("HighPrice", 3), "low_price": ("LowPrice", 3), "turnover": ("Turnover", 5), "trades": "TradNumber", "volume": ("TradVolume", 3), "bid_total": ("TotalBidVol", 3), "ask_total": ("TotalAskVol", 3), "bid_vwap": ("WAvgBidPri", 3), "ask_vwap": ("WAvgAskPri", 3), "level": 3},
    "SZ": {"status": "TradingPhaseCode", "last_price": ("LastPrice", 6), "high_price": ("HighPrice", 6), "low_price": ("LowPrice", 6), "turnover": ("Turnover", 4), "trades": "TurnNum", "volume": ("Volume", None), "bid_total": ("TotalBidQty", None), "ask_total": ("TotalOfferQty", None), "bid_vwap": ("WeightedAvgBidPx", 6), "ask_vwap": ("WeightedAvgOfferPx", 6), "level": 6},
}


def decode_levels(df: DataFrame, side: str, market: str, depth: int = 10) -> tuple[Column, Column]:
    """Array of a side's levels, empty ones left out, and whether any level is half filled."""
    word, count = ("Bid", "NumOrdersB") if side == "B" else ("Ask", "NumOrdersS")
    scale = _REFERENCE[market]["level"]
    raw = lambda c, s: (F.col(c) * 10**s).cast("bigint")
    rows = F.array(*(F.struct(raw(f"{word}Price{i}", scale).alias("p"), (raw(f"{word}Volume{i}", 3) if market == "SH" else _long(f"{word}Volume{i}")).alias("q"), _long(f"{count}{i}").alias("n")) for i in range(1, depth + 1)))
    none = lambda c: F.coalesce(c, F.lit(0)) == 0
    filled = F.filter(rows, lambda x: (x["p"] > 0) & (x["q"] > 0) & (x["n"] > 0))
    half = F.exists(rows, lambda x: ~((none(x["p"]) & none(x["q"]) & none(x["n"])) | F.coalesce((x["p"] > 0) & (x["q"] > 0) & (x["n"] > 0), F.lit(False))))
    levels = F.transform(filled, lambda x: F.struct(rescaled(x["p"], scale).alias("price"), ref_quantity(x["q"], market).alias("quantity"), x["n"].alias("order_count")))
    return levels, half


def read_reference(spark: SparkSession, root: str, market: str, days: list[int] | None = None) -> DataFrame:
    """Published snapshots with the twelve comparable fields in our units; load_error names the rules a frame breaks, and is empty for a good one. file_name and file_row tell where it stands."""
    c = _REFERENCE[market]
    feed = SNAPSHOT_FEEDS[market]
    paths = [feed_path(root, d, feed) for d in days] if days else [feed_path(root, "*", feed)]
    raw = spark.read.option("basePath", root).parquet(*paths)
    scaled = lambda f: _long(c[f][0]) if c[f][1] is None else (F.col(c[f][0]) * 10 ** c[f][1]).cast("bigint")
    price = lambda f: ref_price(scaled(f), c[f][1])
    bids, bad_b = decode_levels(raw, "B", market)
    asks, bad_a = decode_levels(raw, "S", market)
    prices = ["last_price", "high_price", "low_price", "bid_vwap", "ask_vwap"]
    quantities = ["volume", "bid_total", "ask_total"]
    optional = lambda n, e: e if n in raw.columns else F.lit(None).cast("bigint")
    limit = lambda n: optional(n, F.when((F.col(n) * 1_000_000) % 100 == 0, (F.col(n) * 10_000).cast("bigint")))
    df = raw.select(
        F.lit(market).alias("market"), F.col("date").cast("int").alias("trading_day"), _text("SecurityID").alias("symbol"), market_ts(F.col("date").cast("int"), F.trim("UpdateTime")).alias("quote_ms"), _long("source_row_no").alias("source_row"), F.trim(c["status"]).alias("status"),
        *(price(f).alias(f) for f in prices), *(ref_quantity(scaled(f), market).alias(f) for f in quantities), ref_amount(scaled("turnover"), c["turnover"][1]).cast("decimal(38,0)").alias("turnover"), _long(c["trades"]).alias("trades"),
        bids.alias("bids"), asks.alias("asks"), bad_b.alias("__bad_b"), bad_a.alias("__bad_a"), *(ref_price_error(scaled(f)).alias(f"__neg_{f}") for f in prices),
        missing_reception(F.col("SeqNo"), F.col("LocalTime")).alias("missing_reception"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("file_row"),
        *((optional("PreCloPrice", ref_price((F.col("PreCloPrice") * 10_000).cast("bigint"), 4)).alias("previous_close"), limit("HighLimitPrice").alias("high_limit"), limit("LowLimitPrice").alias("low_limit")) if market == "SZ" else ()),
    )
    rules = {**{f: F.col(f"__neg_{f}") for f in prices}, **{f: F.col(f).isNull() for f in [*quantities, "turnover", "trades", "quote_ms", "symbol"]}, "bids": F.col("__bad_b"), "asks": F.col("__bad_a")}
    return _checked(df, rules).withColumnRenamed("faults", "load_error").drop(*[x for x in df.columns if x.startswith("__")])


def _columns(contract: str) -> list[list[str]]:
    """(name, type) pairs of a contract."""
    return [x.strip().split(" ", 1) for x in contract.replace("(20,0)", "(20;0)").replace("(38,", "(38;").split(",")]


def snapshot_contract(market: str, depth: int = 10) -> str:
    """Columns of a market's published frames with their types as Spark reads them; limits are optional and not in it."""
    c = _REFERENCE[market]
    kind = lambda s: "bigint" if s is None else f"decimal(38,{s})"
    rows = ["SecurityID string", "UpdateTime string", "source_row_no decimal(20,0)", f"{c['status']} string", "LocalTime string", "SeqNo bigint", f"{c['trades']} bigint", *(f"{n} {kind(s)}" for n, s in (x for x in c.values() if isinstance(x, tuple)))]
    for word, count in (("Ask", "NumOrdersS"), ("Bid", "NumOrdersB")):
        for i in range(1, depth + 1):
            rows += [f"{word}Price{i} decimal(38,{c['level']})", f"{word}Volume{i} {'decimal(38,3)' if market == 'SH' else 'bigint'}", f"{count}{i} bigint"]
    return ", ".join(rows + (["PreCloPrice decimal(38,4)"] if market == "SZ" else []))


def check_schema(df: DataFrame, contract: str) -> list[tuple[str, str, str]]:
    """(column, expected type, actual type) of every column that is missing or of another type than its contract."""
    have = dict(df.dtypes)
    return [(n, t, have.get(n, "missing")) for n, t in ((n, t.replace(";", ",")) for n, t in _columns(contract)) if have.get(n) != t]


def stored_type(name: str, kind: str) -> str:
    """The exact type of a contract's column in its file, where Spark's reader widens unsigned numbers."""
    if name.startswith("NumOrders") or name in ("TradNumber", "TurnNum"):
        return "uint32"
    return {"decimal(20,0)": "uint64", "string": "large_string", "int": "int32", "bigint": "int64"}.get(kind, kind.replace("decimal(", "decimal128(").replace(",", ", "))


def contract_of(market: str, feed: str) -> str:
    return snapshot_contract(market) if feed in SNAPSHOT_FEEDS.values() else next(c for f, c in FEEDS.values() if f == feed)


def check_types(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, column, expected, actual) of every column of files (path, market, feed) whose stored type is not its contract's; from footers alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, market, feed in zip(b["path"], b["market"], b["feed"], strict=True):
                fs, inner, pq = _open(path)
                with fs.open_input_file(inner) as f:
                    have = {x.name: str(x.type) for x in pq.ParquetFile(f).schema_arrow}
                wanted = {n: stored_type(n, t.replace(";", ",")) for n, t in _columns(contract_of(market, feed))}
                rows += [(path, n, t, have.get(n, "missing")) for n, t in wanted.items() if have.get(n) != t]
            yield pd.DataFrame(rows, columns=["path", "column", "expected", "actual"])

    return files.select("path", "market", "feed").mapInPandas(run, "path string, column string, expected string, actual string")


def violations(rows: DataFrame) -> DataFrame:
    """A row per broken rule: book, stream, channel, seq, source_row, code."""
    return rows.select("market", "trading_day", "symbol", "stream", "channel", "seq", "source_row", F.explode("faults").alias("code"))


def _open(path: str):
    import pyarrow.fs
    import pyarrow.parquet as pq

    fs, inner = pyarrow.fs.FileSystem.from_uri(path) if ":/" in path else (pyarrow.fs.LocalFileSystem(), path)
    return fs, inner, pq


def check_footers(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, key, expected, actual, ok) for the footer of each file of files (path, market, feed). One small task per slice of the list."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, market, feed in zip(b["path"], b["market"], b["feed"], strict=True):
                fs, inner, pq = _open(path)
                with fs.open_input_file(inner) as f:
                    meta = {k.decode(): v.decode() for k, v in (pq.ParquetFile(f).metadata.metadata or {}).items()}
                for key, want in {**FOOTER, "clara.raw.market": market, "clara.raw.feed": feed}.items():
                    rows.append((path, key, want, meta.get(key), meta.get(key) == want))
                rows += [(path, key, "not empty", meta.get(key), bool(meta.get(key))) for key in FOOTER_FILLED]
            yield pd.DataFrame(rows, columns=["path", "key", "expected", "actual", "ok"])

    return files.select("path", "market", "feed").mapInPandas(run, "path string, key string, expected string, actual string, ok boolean")


def feeds_of(market: str, frames: bool = False) -> list[str]:
    """A market's event feeds, and that of its published frames."""
    names = ["sh_ticks"] if market == "SH" else ["sz_orders", "sz_executions"]
    return [FEEDS[n][0] for n in names] + ([SNAPSHOT_FEEDS[market]] if frames else [])


def day_files(spark: SparkSession, root: str, market: str, days: list[int] | None, frames: bool = False) -> DataFrame:
    """(path, market, feed) of every file of a market's days; a named day without one is an error."""
    found = []
    for feed in feeds_of(market, frames):
        for pattern in [feed_path(root, d, feed) for d in days] if days else [feed_path(root, "*", feed)]:
            path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
            there = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
            if not there:
                raise FaultyFile(f"{pattern}: no such file")
            found += [(re.sub("^file:/+", "/", x.getPath().toString()), market, feed) for x in there]
    return spark.createDataFrame(found, "path string, market string, feed string")


class FaultyFile(ValueError):
    """A file whose footer or types are not its contract's; none of its rows has been read."""


def refuse_faulty_files(spark: SparkSession, root: str, market: str, days: list[int] | None, frames: bool = False, told: int = 20) -> None:
    """Raises FaultyFile if a footer entry or a stored type of any file of the days is wrong; executors read the footers."""
    files = day_files(spark, root, market, days, frames).repartition("path")
    footers = check_footers(spark, files).filter("NOT ok").select("path", F.col("key").alias("what"), "expected", "actual")
    types = check_types(spark, files).select("path", F.col("column").alias("what"), "expected", "actual")
    if wrong := footers.unionByName(types).orderBy("path", "what").limit(told).collect():
        raise FaultyFile("; ".join(f"{r.path}: {r.what} is {r.actual}, not {r.expected}" for r in wrong))


#: Fixed value: how a file's schema id is made up.
SCHEMA_ID = "tonglian.level2.v4_1.{market}.{feed}"


def inventory_check(spark: SparkSession, inventory: DataFrame) -> DataFrame:
    """(path, check, expected, actual, ok) for every file of inventory (path, market, feed, date, bytes, rows, schema_sha256).

    Checked are size, rows (and that there are any), the hash of the fields, that the folder has one part
    only, and the footer's entries. Of a file that is not there only `exists` is told.
    """

    def look(path: str) -> dict[str, str | None]:
        fs, inner, pq = _open(path)
        from pyarrow.fs import FileSelector

        info = fs.get_file_info(inner)
        if not info.is_file:
            return {}
        with fs.open_input_file(inner) as f:
            parquet = pq.ParquetFile(f)
            meta, schema = parquet.metadata, str(parquet.schema_arrow.remove_metadata())
        footer = {k.decode().removeprefix("clara.raw."): v.decode() for k, v in (meta.metadata or {}).items() if k.startswith(b"clara.raw.")}
        parts = sum(x.path.endswith(".parquet") for x in fs.get_file_info(FileSelector(inner.rsplit("/", 1)[0])))
        return {**footer, "bytes": str(info.size), "rows": str(meta.num_rows), "any_rows": str(meta.num_rows > 0).lower(), "schema_sha256": hashlib.sha256(schema.encode()).hexdigest(), "parts": str(parts), "hashed": str(bool(footer.get("schema_hash"))).lower()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                have = look(r["path"])
                if not have:
                    out.append((r["path"], "exists", "true", "false", False))
                    continue
                want = {k: str(r[k]) for k in ("market", "feed", "date", "bytes", "rows", "schema_sha256")}
                want |= {"any_rows": "true", "parts": "1", "hashed": "true", "schema_id": SCHEMA_ID.format(**r), **{k.removeprefix("clara.raw."): v for k, v in FOOTER.items()}}
                out += [(r["path"], k, v, have.get(k), have.get(k) == v) for k, v in want.items()]
            yield pd.DataFrame(out, columns=["path", "check", "expected", "actual", "ok"])

    rows = inventory.select("path", "market", "feed", F.col("date").cast("string").alias("date"), F.col("bytes").cast("bigint").alias("bytes"), F.col("rows").cast("bigint").alias("rows"), "schema_sha256")
    return rows.mapInPandas(run, "path string, check string, expected string, actual string, ok boolean")
