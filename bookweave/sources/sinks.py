"""Snapshot and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

REPORT_VERSION = 2


def wide_snapshots(snaps: DataFrame, depth: int = 10) -> DataFrame:
    """Nested snapshots (with channel and kind) as one wide row each: asks before bids, level 1 to depth; price decimal(18,4), null beyond the depth there is."""
    money = lambda c: (c / F.lit(10_000).cast("decimal(5,0)")).cast("decimal(18,4)")
    price = lambda c: money(c.cast("decimal(18,0)"))

    def level(column: str, name: str) -> list:
        out = []
        for i in range(depth):
            x = F.get(column, i)
            out += [price(x["price"]).alias(f"{name}_price_{i + 1}"), x["quantity"].alias(f"{name}_qty_{i + 1}"), x["order_count"].alias(f"{name}_orders_{i + 1}")]
        return out

    turnover = (F.col("turnover").cast("decimal(34,0)") / F.lit(10_000).cast("decimal(5,0)")).cast("decimal(38,4)")
    times = {"boundary_time": "boundary_ms", "last_local_time": "last_local_ms", "last_quote_time": "last_quote_ms"}
    return snaps.select(
        "trading_day", "market", "channel", "symbol", F.col("kind").alias("snapshot_kind"), *(F.timestamp_millis(c).alias(n) for n, c in times.items()), *level("asks", "ask"), *level("bids", "bid"),
        "bid_total", price(F.col("bid_vwap")).alias("bid_vwap"), "ask_total", price(F.col("ask_vwap")).alias("ask_vwap"), *(price(F.col(c)).alias(c) for c in ("last_price", "high_price", "low_price")), "trades", "volume", turnover.alias("turnover"),
    )


def write_snapshots(snaps: DataFrame, root: str, depth: int = 10) -> None:
    """Parquet under date=/market=/channel=, scheduled rows before closing ones; a large channel is several files that follow one another."""
    wide = wide_snapshots(snaps, depth).withColumnRenamed("trading_day", "date")
    order = ["date", "market", "channel", F.col("snapshot_kind").desc(), "symbol", "boundary_time"]
    wide.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("append").partitionBy("date", "market", "channel").parquet(root)


def write_report(report: DataFrame, path: str) -> None:
    report.withColumn("schema_version", F.lit(REPORT_VERSION)).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a written report; another schema version is refused."""
    df = spark.read.schema(f"{schema}, schema_version int").json(path)
    if not df.filter(f"schema_version IS NULL OR schema_version <> {REPORT_VERSION}").isEmpty():
        raise ValueError(f"report {path} is not of schema version {REPORT_VERSION}")
    return df.drop("schema_version")


def write_day_reports(reports: DataFrame, root: str) -> None:
    """A nested JSON document per market and day under market=/trading_day=; one that is there already is replaced."""
    reports.repartition("market", "trading_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("market", "trading_day").json(root)


def read_day_reports(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    """Documents of all markets and days under root, of whatever version; like: any reports, whose schema they have."""
    inner = [f for f in like.schema if f.name not in ("market", "trading_day")]
    read = spark.read.schema(StructType([*inner, *(like.schema[c] for c in ("market", "trading_day"))])).json(root)
    return read.select(*like.columns)


def write_regressions(rows: DataFrame, path: str) -> None:
    """Audit of sequence regressions, a JSON line each."""
    rows.write.mode("overwrite").json(path)
