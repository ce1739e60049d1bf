"""A legal order feed made from the ``events`` table: by SQL in DuckDB, and by the same rules in one pass over pairs of orders in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.shared import compilable

FEED_CTE = """base AS (
  SELECT event_id, ts, CAST(user_id % 20 AS BIGINT) AS sym,
         CASE WHEN event_type IN ('view','signup') THEN 'B' ELSE 'S' END AS side,
         CASE WHEN event_type IN ('view','signup') THEN 100000 - CAST(event_id % 37 AS BIGINT) * 100
              ELSE 99700 + CAST(event_id % 37 AS BIGINT) * 100 END AS price,
         CAST(100 * (1 + event_id % 5) AS BIGINT) AS qty
  FROM events WHERE event_type <> 'error'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sym, side ORDER BY ts, event_id) AS rn FROM base),
pairs AS (
  SELECT b.sym, b.event_id AS bid_id, s.event_id AS ask_id, s.price,
         CASE WHEN b.ts > s.ts THEN b.ts ELSE s.ts END AS ts,
         CASE WHEN b.event_id > s.event_id THEN b.event_id ELSE s.event_id END AS trig,
         CASE WHEN b.qty < s.qty THEN b.qty ELSE s.qty END AS qty
  FROM ranked b JOIN ranked s ON b.sym = s.sym AND b.rn = s.rn AND b.side = 'B' AND s.side = 'S'
  WHERE b.rn % 2 = 0),
adds AS (
  SELECT sym, ts, 0 AS k, event_id AS trig, 'A' AS kind, side, CASE WHEN side = 'B' THEN event_id END AS bid_id,
         CASE WHEN side = 'S' THEN event_id END AS ask_id, price, qty FROM ranked),
trades AS (SELECT sym, ts, 1 AS k, trig, 'T' AS kind, 'N' AS side, bid_id, ask_id, price, qty FROM pairs),
rem AS (
  SELECT r.sym, r.event_id, r.side, r.price, r.ts, r.qty - COALESCE(p.q, 0) AS remaining, COALESCE(p.ts, r.ts) AS cts,
         COALESCE(p.trig, r.event_id) AS trig
  FROM ranked r LEFT JOIN (
    SELECT bid_id AS id, qty AS q, ts, trig FROM pairs UNION ALL SELECT ask_id, qty, ts, trig FROM pairs) p ON p.id = r.event_id),
cancels AS (
  SELECT sym, cts AS ts, 2 AS k, trig, 'C' AS kind, side, CASE WHEN side = 'B' THEN event_id END AS bid_id,
         CASE WHEN side = 'S' THEN event_id END AS ask_id, CAST(NULL AS BIGINT) AS price, remaining AS qty
  FROM rem WHERE event_id % 3 = 0 AND remaining > 0),
u AS (SELECT * FROM adds UNION ALL SELECT * FROM trades UNION ALL SELECT * FROM cancels),
feed AS (
  SELECT sym, ts, row_number() OVER (PARTITION BY sym ORDER BY ts, trig, k, COALESCE(bid_id, -1), COALESCE(ask_id, -1)) AS seq,
         kind, side, bid_id, ask_id, price, qty FROM u)"""

#: The same in DuckDB's SQL with the canonical columns: `f`.
CANONICAL_CTE = (
    FEED_CTE
    + """,
f AS (
  SELECT 'SZ' AS market, 20240101 AS trading_day, lpad(CAST(sym AS VARCHAR), 6, '0') AS symbol, CAST(1 + sym % 4 AS INTEGER) AS channel,
         seq, kind, side, bid_id AS bid_no, ask_id AS ask_no, price, qty, epoch_us(ts) // 1000 AS quote_ms, ts FROM feed)"""
)


def ms(column: str):
    """Epoch milliseconds of a timestamp without zone."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {column})").cast("bigint")


def pair_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of FEED_CTE's `feed`, with rn: an event names none but the orders of its (sym, rn). event_id is a key.

    A bid and an ask of one number are one row, from which all their events follow; so events are read once and nothing is joined.
    """
    compilable(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_type <> 'error'")
    orders = events.select(F.expr("CAST(user_id % 20 AS BIGINT)").alias("sym"), F.expr("CASE WHEN event_type IN ('view', 'signup') THEN 'B' ELSE 'S' END").alias("side"), F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id")
    numbered = orders.withColumn("rn", F.row_number().over(W.partitionBy("sym", "side").orderBy("ts", "event_id")))
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    pairs = numbered.groupBy("sym", "rn").agg(of("B", "event_id").alias("b"), of("B", "ts").alias("b_ts"), of("S", "event_id").alias("s"), of("S", "ts").alias("s_ts"))
    sizes = pairs.selectExpr("*", "sym IS NOT NULL AND rn % 2 = 0 AND b IS NOT NULL AND s IS NOT NULL AS meets", "CAST(100 * (1 + b % 5) AS BIGINT) AS b_qty", "CAST(100 * (1 + s % 5) AS BIGINT) AS s_qty")
    met = sizes.selectExpr("*", "CASE WHEN meets THEN CASE WHEN b_ts > s_ts THEN b_ts ELSE s_ts END END AS t_ts", "CASE WHEN meets THEN greatest(b, s) END AS t_trig", "CASE WHEN meets THEN least(b_qty, s_qty) END AS t_qty")
    # 0 and 1: adds of the bid and the ask; 2: their trade; 3 and 4: cancels of what is left of them
    each = met.withColumn("what", F.explode(F.array(*(F.lit(i) for i in range(5))))).filter("""CASE what WHEN 0 THEN b IS NOT NULL WHEN 1 THEN s IS NOT NULL WHEN 2 THEN meets
        WHEN 3 THEN b % 3 = 0 AND b_qty > coalesce(t_qty, 0) ELSE s % 3 = 0 AND s_qty > coalesce(t_qty, 0) END""")
    rows = each.selectExpr(
        "sym", "rn", "CASE what WHEN 0 THEN b_ts WHEN 1 THEN s_ts WHEN 2 THEN t_ts WHEN 3 THEN coalesce(t_ts, b_ts) ELSE coalesce(t_ts, s_ts) END AS ts",
        "CASE what WHEN 0 THEN b WHEN 1 THEN s WHEN 2 THEN t_trig WHEN 3 THEN coalesce(t_trig, b) ELSE coalesce(t_trig, s) END AS trig",
        "CASE WHEN what < 2 THEN 0 WHEN what = 2 THEN 1 ELSE 2 END AS k", "CASE WHEN what < 2 THEN 'A' WHEN what = 2 THEN 'T' ELSE 'C' END AS kind", "CASE WHEN what IN (0, 3) THEN 'B' WHEN what = 2 THEN 'N' ELSE 'S' END AS side",
        "CASE WHEN what IN (0, 2, 3) THEN b END AS bid_id", "CASE WHEN what IN (1, 2, 4) THEN s END AS ask_id",
        "CASE WHEN what = 0 THEN 100000 - CAST(b % 37 AS BIGINT) * 100 WHEN what < 3 THEN 99700 + CAST(s % 37 AS BIGINT) * 100 END AS price",
        "CASE what WHEN 0 THEN b_qty WHEN 1 THEN s_qty WHEN 2 THEN t_qty WHEN 3 THEN b_qty - coalesce(t_qty, 0) ELSE s_qty - coalesce(t_qty, 0) END AS qty",
    )
    order = W.partitionBy("sym").orderBy("ts", "trig", "k", F.expr("coalesce(bid_id, -1)"), F.expr("coalesce(ask_id, -1)"))
    return rows.withColumn("seq", F.row_number().over(order)).drop("trig", "k")


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical events of the SZ market, twenty symbols over four channels, numbered in each book."""
    return pair_feed(spark, sf_dir).select(
        F.lit("SZ").alias("market"), F.lit(20240101).alias("trading_day"), F.lpad(F.col("sym").cast("string"), 6, "0").alias("symbol"),
        (F.lit(1) + F.col("sym") % 4).cast("int").alias("channel"), F.col("seq").cast("bigint").alias("seq"), "kind",
        F.lit("limit").alias("ord_type"), "side", F.lit(None).cast("string").alias("flag"), F.lit(None).cast("string").alias("status"),
        F.col("bid_id").alias("bid_no"), F.col("ask_id").alias("ask_no"), "price", F.col("qty").cast("bigint").alias("qty"), ms("ts").alias("quote_ms"),
    )
