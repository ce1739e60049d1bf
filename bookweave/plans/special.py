"""Queries of the placement fold and the streaming books over the derived feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookweave.operators import book, ledger, placement, rounds
from bookweave.operators.slices import TIMES, Running, running
from bookweave.plans import core
from bookweave.plans.core import ORIGIN_MS
from bookweave.plans.feed import CANONICAL_CTE, order_feed
from bookweave.schema import EVENT
from bookweave.shared import new_path, written
from bookweave.streaming import books


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with some orders turned into market, same-side-best and hide-if-crossing ones by number."""
    feed = order_feed(spark, sf_dir)
    no = F.coalesce("bid_no", "ask_no")
    kind = F.when(no % 9 == 0, "market").when(no % 10 == 1, "same_side_best").when(no % 11 == 2, "hide_if_crossing").otherwise("limit")
    return feed.withColumn("ord_type", F.when(F.col("kind") == "A", kind))


def placements(spark, sf_dir):
    return placement.placements(_mixed(spark, sf_dir)).select("symbol", "what", "order_side", "order_no", "rest_seq", "price", "remaining", "code")


def placements_in_rounds(spark, sf_dir):
    """The same rows without the fold."""
    return rounds.placements_in_rounds(written(_mixed(spark, sf_dir), "mixed")).select("symbol", "what", "order_side", "order_no", "rest_seq", "price", "remaining", "code")


def response_groups(spark, sf_dir):
    """Islands of answers, without the fold: what each order that waits for them came to."""
    found = rounds.placements_in_rounds(written(_mixed(spark, sf_dir), "mixed"), "require_evidence").filter("what <> 'placement'")
    return found.select("symbol", "what", "order_side", "order_no", "rest_seq", "remaining", "code")


def evidence_groups(spark, sf_dir):
    return placement.placements(_mixed(spark, sf_dir), "require_evidence").groupBy("symbol", "what", "code").agg(F.count("*").alias("rows"))


def placed_levels(spark, sf_dir):
    feed = _mixed(spark, sf_dir)
    led = ledger.ledger(feed)
    return book.level_totals(placement.placed_deltas(feed, led, placement.placements(feed)))


def never_crossing(spark, sf_dir):
    """Orders that hide if they cross, in a book whose other side is far away: all rest at once, so the levels are those of limit orders."""
    feed = order_feed(spark, sf_dir)
    apart = feed.withColumn("price", F.when(F.col("side") == "B", F.col("price") - 50_000).otherwise(F.col("price"))).withColumn("ord_type", F.when(F.col("kind") == "A", F.lit("hide_if_crossing")))
    led = ledger.ledger(apart)
    return book.level_totals(placement.placed_deltas(apart, led, placement.placements(apart)))


#: Parts that a stream is fed in, before one that moves time on.
PARTS = 4


def _numbered(spark, sf_dir) -> DataFrame:
    """The feed with each channel's rows numbered from 1, as an exchange numbers them."""
    feed = written(order_feed(spark, sf_dir), "feed")
    numbered = running(feed, ["market", "trading_day", "channel"], "quote_ms", {"no": Running("count", F.lit(1))}, ["symbol", "seq"], TIMES)
    return written(numbered.withColumnRenamed("seq", "book_seq").withColumnRenamed("no", "seq"), "numbered")


def _with_clock(feed: DataFrame) -> DataFrame:
    """feed with a status row of a channel of its own, two months after the last row, in a part after all others: time goes on."""
    clock = feed.groupBy("market", "trading_day").agg((F.max("quote_ms") + 60 * core.DAY).alias("quote_ms")).withColumns({"channel": F.lit(0), "seq": F.lit(1).cast("bigint"), "kind": F.lit("S"), "symbol": F.lit(""), "part": F.lit(PARTS)})
    return feed.unionByName(clock, allowMissingColumns=True)


def _stream(spark, feed: DataFrame, part, columns: list[str]) -> DataFrame:
    """feed as a file stream that is read one part at a time, in the order of their numbers; all parts are written at once."""
    path = new_path(spark, "feed")
    for i, rows in enumerate(_parts(feed.withColumn("part", part.cast("int")))):
        rows.select(*columns).repartition("channel").write.mode("append").parquet(f"{path}/batch={i}")
    return spark.readStream.schema(feed.select(*columns).schema).option("maxFilesPerTrigger", 8).parquet(f"{path}/batch=*")


def _parts(feed: DataFrame) -> list[DataFrame]:
    kept = written(feed, "parts")
    return [kept.filter(F.col("part") == i) for i in range(PARTS + 1)]


def _drained(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over all there is now, and read what it wrote."""
    spark = stream.sparkSession
    out = new_path(spark, name)
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", new_path(spark, f"{name}-checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


_EVENTS = [c.split()[0] for c in EVENT.split(", ")]
#: End of the derived feed's thirty days.
UNTIL_MS = ORIGIN_MS + 30 * core.DAY


#: How far the derived feed's parts run into one another, and how long a number is waited for.
LATE, GAP_MS = "20 days", core.DAY


def _dealt(feed: DataFrame) -> DataFrame:
    """Parts by time, a week each; of three runs of fifty rows one comes a part later, so that the gate holds the other two back."""
    week = F.least(F.floor((F.col("quote_ms") - ORIGIN_MS) / (8 * core.DAY)), F.lit(PARTS - 1))
    return feed.withColumn("part", F.least(week + F.when(F.floor(F.col("seq") / 50) % 3 == 1, 1).otherwise(0), F.lit(PARTS - 1)).cast("int"))


def _told(spark, feed: DataFrame, step_ms: int | None = None) -> DataFrame:
    """What the books tell of a feed that is dealt out in parts."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", books.STORE)
    try:
        stream = _stream(spark, _with_clock(feed), F.col("part"), _EVENTS)
        return _drained(books.incremental_books(stream, step_ms, UNTIL_MS, LATE, GAP_MS), "books")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def _books(spark, sf_dir):
    return _told(spark, _dealt(_numbered(spark, sf_dir)), core.DAY)


def stream_levels(spark, sf_dir):
    """The last state of every level that the stream told of."""
    rows = _books(spark, sf_dir).filter("what = 'level'")
    last = rows.groupBy("market", "trading_day", "symbol", "order_side", "price").agg(F.max_by(F.struct("quantity", "order_count"), "seq").alias("x"))
    return last.filter("x.order_count > 0").select("market", "trading_day", "symbol", "order_side", "price", "x.quantity", "x.order_count")


def stream_snapshots(spark, sf_dir):
    return _books(spark, sf_dir).filter("what = 'snapshot'").select("symbol", F.col("at_ms").alias("boundary_ms"), "volume", "trades")


def stream_trade_windows(spark, sf_dir):
    """All windows: a row a month after the last one closes those that are open."""
    feed = order_feed(spark, sf_dir)
    end = feed.groupBy("market", "trading_day", "channel").agg((F.max("quote_ms") + 30 * core.DAY).alias("quote_ms")).withColumn("kind", F.lit("S"))
    days = F.when(F.col("kind") == "S", PARTS - 1).otherwise(F.least(F.floor((F.col("quote_ms") - ORIGIN_MS) / (8 * core.DAY)), F.lit(PARTS - 1)))
    feed = feed.unionByName(end, allowMissingColumns=True).withColumn("ts", F.timestamp_millis("quote_ms"))
    out = _drained(books.trade_windows(_stream(spark, feed, days, ["ts", *_EVENTS])), "windows")
    return out.select("market", "symbol", F.unix_millis("window_start").alias("window_ms"), "trades", "volume", "high_price", "low_price")


def stream_late(spark, sf_dir):
    """Rows that came twice: every hundredth row of each channel comes again a part later (in the last part at the latest), and no part is as far behind as the watermark."""
    feed = _dealt(_numbered(spark, sf_dir))
    again = feed.filter("seq % 100 = 0").withColumn("part", F.least(F.col("part") + 1, F.lit(PARTS - 1)))
    return _told(spark, feed.unionByName(again)).filter("what = 'late'").groupBy(F.floor(F.col("seq") / 100).alias("hundred")).agg(F.count("*").alias("rows"))


def _lossy(spark, sf_dir):
    """The feed without the cancels whose number divides by seven, and three rows more after each: numbers that never come."""
    feed = _dealt(_numbered(spark, sf_dir))
    lost = feed.filter("kind = 'C' AND seq % 7 = 0").select("channel", F.explode(F.array(*(F.col("seq") + i for i in range(4)))).alias("seq")).distinct()
    return _told(spark, feed.join(lost, ["channel", "seq"], "left_anti"), core.DAY)


def stream_gaps(spark, sf_dir):
    """Numbers that were given up, on each channel."""
    return _lossy(spark, sf_dir).filter("what = 'gap'").select("channel", "seq", "upto")


def stream_lossy_snapshots(spark, sf_dir):
    """Statistics at every boundary of the feed with lost rows: all that came is applied."""
    return _lossy(spark, sf_dir).filter("what = 'snapshot'").select("symbol", F.col("at_ms").alias("boundary_ms"), "volume", "trades")


def queries():
    names = [placements, placements_in_rounds, response_groups, evidence_groups, placed_levels, never_crossing, stream_levels, stream_snapshots, stream_trade_windows, stream_late, stream_gaps, stream_lossy_snapshots]
    return {f.__name__: f for f in names}


#: A book kept event by event: os are its live orders after event i. An order is rest (the event at which it took its place), and its price then.
_ORDER = "STRUCT(side VARCHAR, no BIGINT, price BIGINT, lft BIGINT, vis BOOLEAN, typ VARCHAR, never BOOLEAN, rest BIGINT)"


def _fold_sql(policy: str) -> str:
    """CTEs: ev (events with their order's type) and st (the books after each of them)."""
    never = "typ = 'same_side_best' AND mine IS NULL" + (" OR typ = 'market'" if policy != "rest_at_last_trade" else "")
    best = lambda os, side: f"list_{'max' if side == 'B' else 'min'}(list_transform(list_filter({os}, lambda o: o.vis AND o.side = '{side}'), lambda o: o.price))"
    pack = lambda side, no, price, lft, vis, typ, nv, rest: f"struct_pack(side := {side}, no := {no}, price := {price}, lft := {lft}, vis := {vis}, typ := {typ}, never := {nv}, rest := {rest})"

    def rested(os: str, side: str) -> str:
        """Hidden orders of a trade's side that now stand inside the other side's best."""
        other, inside = ("ba", "<") if side == "B" else ("bb", ">")
        price = "CASE WHEN o.typ = 'market' THEN price ELSE o.price END"
        hit = f"o.side = '{side}' AND o.no = {'bid_no' if side == 'B' else 'ask_no'} AND NOT o.vis AND NOT o.never AND o.typ <> 'same_side_best' AND ({other} IS NULL OR {price} {inside} {other})"
        return f"list_transform({os}, lambda o: CASE WHEN {hit} THEN {pack('o.side', 'o.no', price, 'o.lft', 'true', 'o.typ', 'o.never', 'seq')} ELSE o END)"

    new = pack("side", "no", "CASE typ WHEN 'limit' THEN price WHEN 'hide_if_crossing' THEN price WHEN 'same_side_best' THEN mine END", "qty", "CASE typ WHEN 'limit' THEN true WHEN 'hide_if_crossing' THEN theirs IS NULL OR CASE WHEN side = 'B' THEN price < theirs ELSE price > theirs END WHEN 'same_side_best' THEN mine IS NOT NULL ELSE false END", "typ", never, "seq")
    left = f"list_filter(list_transform(os, lambda o: CASE WHEN o.no = CASE WHEN o.side = 'B' THEN bid_no ELSE ask_no END THEN {pack('o.side', 'o.no', 'o.price', 'o.lft - qty', 'o.vis', 'o.typ', 'o.never', 'o.rest')} ELSE o END), lambda o: o.lft > 0)"
    gone = "list_filter(os, lambda o: coalesce(o.no <> CASE WHEN o.side = 'B' THEN bid_no ELSE ask_no END, true))"
    return f"""WITH RECURSIVE {CANONICAL_CTE},
ev AS (SELECT symbol, seq, kind, side, bid_no, ask_no, coalesce(bid_no, ask_no) AS no, price, qty, quote_ms,
  CASE WHEN kind = 'A' THEN CASE WHEN coalesce(bid_no, ask_no) % 9 = 0 THEN 'market' WHEN coalesce(bid_no, ask_no) % 10 = 1 THEN 'same_side_best' WHEN coalesce(bid_no, ask_no) % 11 = 2 THEN 'hide_if_crossing' ELSE 'limit' END END AS typ FROM f),
st AS (
  SELECT DISTINCT symbol, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS theirs, CAST([] AS {_ORDER}[]) AS os FROM ev
  UNION ALL
  SELECT symbol, seq, theirs, CASE kind WHEN 'A' THEN list_append(os, CAST({new} AS {_ORDER})) WHEN 'C' THEN {gone} ELSE t2 END
  FROM (
    SELECT *, {rested('t1', 'S')} AS t2 FROM (
      SELECT *, {best('t1', 'B')} AS bb FROM (
        SELECT *, {rested('t0', 'B')} AS t1 FROM (
          SELECT *, {best('t0', 'S')} AS ba FROM (
            SELECT ev.*, os, CASE WHEN kind = 'T' THEN {left} END AS t0, CASE WHEN side = 'B' THEN b0 ELSE a0 END AS mine, CASE WHEN side = 'B' THEN a0 ELSE b0 END AS theirs
            FROM (SELECT *, {best('os', 'B')} AS b0, {best('os', 'S')} AS a0 FROM st) s JOIN ev ON ev.symbol = s.symbol AND ev.seq = s.i + 1))))))"""


#: Orders that take no place of their own when they come: what the events that follow at once, and nothing else, tell of each (gr).
_GROUPS = """,
mo AS (SELECT ev.*, theirs FROM ev JOIN st ON st.symbol = ev.symbol AND st.i = ev.seq JOIN (SELECT symbol, i, unnest(os) AS o FROM st) x ON x.symbol = ev.symbol AND x.i = ev.seq AND x.o.side = ev.side AND x.o.no = ev.no WHERE kind = 'A' AND x.o.never),
tc AS (
  SELECT mo.symbol, mo.side, mo.no, mo.seq AS came, mo.qty AS size, e.seq, e.kind, e.qty, row_number() OVER w AS rn, e.seq - mo.seq = row_number() OVER w AS next_, e.quote_ms = mo.quote_ms AS same_, mo.typ = 'market' AND mo.theirs IS NOT NULL AS legal,
    CASE WHEN mo.side = 'B' THEN e.ask_no ELSE e.bid_no END AS other, mo.qty - coalesce(sum(CASE WHEN e.kind = 'T' THEN e.qty END) OVER (PARTITION BY mo.symbol, mo.side, mo.no ORDER BY e.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lb
  FROM mo JOIN ev e ON e.symbol = mo.symbol AND e.kind IN ('T', 'C') AND e.seq > mo.seq AND CASE WHEN mo.side = 'B' THEN e.bid_no ELSE e.ask_no END = mo.no
  WINDOW w AS (PARTITION BY mo.symbol, mo.side, mo.no ORDER BY e.seq)),
fb AS (SELECT symbol, side, no, coalesce(min(rn) FILTER (NOT (next_ AND same_ AND kind = 'T' AND legal AND lb > 0)), count(*) + 1) AS b FROM tc GROUP BY ALL),
gl AS (SELECT mo.symbol, mo.side, mo.no, mo.seq AS came, coalesce(b, 1) AS b, greatest(mo.qty - coalesce((SELECT sum(qty) FROM tc WHERE tc.symbol = mo.symbol AND tc.side = mo.side AND tc.no = mo.no AND rn < b), 0), 0) AS lft FROM mo LEFT JOIN fb USING (symbol, side, no)),
gr AS (
  SELECT gl.symbol, CASE WHEN gl.lft = 0 OR (next_ AND same_ AND kind = 'C' AND other IS NULL AND qty = gl.lft) THEN 'group' ELSE 'violation' END AS what, gl.side AS order_side, gl.no AS order_no,
    gl.came + gl.b - 1 + CASE WHEN gl.lft > 0 AND next_ AND same_ AND kind = 'C' AND other IS NULL AND qty = gl.lft THEN 1 ELSE 0 END AS rest_seq,
    CASE WHEN gl.lft > 0 AND next_ AND same_ AND kind = 'C' AND other IS NULL AND qty = gl.lft THEN 0 ELSE gl.lft END AS remaining,
    CASE WHEN gl.lft = 0 THEN 'completed' WHEN NOT coalesce(next_, false) THEN 'no_completion_evidence' WHEN NOT same_ THEN 'quote_time_boundary' WHEN kind = 'T' THEN 'illegal_trade' WHEN other IS NULL AND qty = gl.lft THEN 'cancelled' ELSE 'inexact_cancel' END AS code
  FROM gl LEFT JOIN tc ON tc.symbol = gl.symbol AND tc.side = gl.side AND tc.no = gl.no AND tc.rn = gl.b),
pl AS (SELECT symbol, 'placement' AS what, o.side AS order_side, o.no AS order_no, o.rest AS rest_seq, o.price, o.lft AS remaining, CAST(NULL AS VARCHAR) AS code FROM (SELECT symbol, i, unnest(os) AS o FROM st) WHERE o.vis AND o.typ <> 'limit' AND o.rest = i),
told AS (SELECT * FROM pl UNION ALL SELECT symbol, what, order_side, order_no, rest_seq, NULL, CAST(remaining AS BIGINT), code FROM gr)"""


def oracle_sql():
    feed = f"WITH {CANONICAL_CTE}"
    levels = core.oracle_sql()["level_totals"]
    numbered = f"{feed}, n AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY quote_ms, symbol, seq) AS no FROM f)"
    lossy = f"{numbered}, lost AS (SELECT DISTINCT channel, no + i AS no FROM n, (SELECT unnest(range(4)) AS i) WHERE kind = 'C' AND no % 7 = 0), k AS (SELECT * FROM n ANTI JOIN lost USING (channel, no))"
    return {
        "placements": f"{_fold_sql('rest_at_last_trade')}{_GROUPS} SELECT * FROM told",
        "placements_in_rounds": f"{_fold_sql('rest_at_last_trade')}{_GROUPS} SELECT * FROM told",
        "response_groups": f"{_fold_sql('require_evidence')}{_GROUPS} SELECT symbol, what, order_side, order_no, rest_seq, CAST(remaining AS BIGINT) AS remaining, code FROM gr",
        "evidence_groups": f"{_fold_sql('require_evidence')}{_GROUPS} SELECT symbol, what, code, count(*) AS rows FROM told GROUP BY ALL",
        "placed_levels": f"""{_fold_sql('rest_at_last_trade')}, z AS (SELECT symbol, unnest(arg_max(os, i)) AS o FROM st GROUP BY symbol)
SELECT 'SZ' AS market, 20240101 AS trading_day, symbol, o.side AS order_side, o.price AS price, CAST(sum(o.lft) AS BIGINT) AS quantity, count(*) AS order_count FROM z WHERE o.vis GROUP BY ALL""",
        "never_crossing": levels.replace("symbol, order_side, price, CAST(sum", "symbol, order_side, price - CASE WHEN order_side = 'B' THEN 50000 ELSE 0 END AS price, CAST(sum").replace("GROUP BY symbol, order_side, price", "GROUP BY symbol, order_side, ac.price"),
        "stream_levels": levels,
        "stream_snapshots": f"""{feed}, s AS (SELECT symbol, min(quote_ms) // 86400000 + 1 AS a FROM f GROUP BY symbol), b AS (SELECT symbol, unnest(range(a, {UNTIL_MS // core.DAY + 1})) * 86400000 AS boundary_ms FROM s)
SELECT symbol, boundary_ms, CAST(coalesce((SELECT sum(qty) FROM f WHERE f.symbol = b.symbol AND kind = 'T' AND quote_ms < boundary_ms), 0) AS BIGINT) AS volume, (SELECT count(*) FROM f WHERE f.symbol = b.symbol AND kind = 'T' AND quote_ms < boundary_ms) AS trades FROM b""",
        "stream_trade_windows": f"{feed} SELECT market, symbol, quote_ms // 86400000 * 86400000 AS window_ms, count(*) AS trades, CAST(sum(qty) AS BIGINT) AS volume, max(price) AS high_price, min(price) AS low_price FROM f WHERE kind = 'T' GROUP BY ALL",
        "stream_late": f"{numbered} SELECT no // 100 AS hundred, count(*) AS rows FROM n WHERE no % 100 = 0 GROUP BY 1",
        "stream_gaps": f"{lossy}, x AS (SELECT channel, no, lag(no, 1, 0) OVER (PARTITION BY channel ORDER BY no) AS before FROM k) SELECT channel, CAST(before + 1 AS BIGINT) AS seq, CAST(no - 1 AS BIGINT) AS upto FROM x WHERE no > before + 1",
        "stream_lossy_snapshots": f"""{lossy}, s AS (SELECT symbol, min(quote_ms) // 86400000 + 1 AS a FROM k GROUP BY symbol), b AS (SELECT symbol, unnest(range(a, {UNTIL_MS // core.DAY + 1})) * 86400000 AS boundary_ms FROM s)
SELECT symbol, boundary_ms, CAST(coalesce((SELECT sum(qty) FROM k WHERE k.symbol = b.symbol AND kind = 'T' AND quote_ms < boundary_ms), 0) AS BIGINT) AS volume, (SELECT count(*) FROM k WHERE k.symbol = b.symbol AND kind = 'T' AND quote_ms < boundary_ms) AS trades FROM b""",
    }
