"""Every query with SQL gives the same rows on the smallest tables, and every query imports without a session."""

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from bookweave import market_day
from bookweave import queries as q
from bookweave.operators import reports
from bookweave.plans import days

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return v if v is None or isinstance(v, (int, str, bool)) else str(v) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = q.queries()[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    cur = duck.execute(q.oracle_sql()[name])
    have = [d[0] for d in cur.description]
    want = sorted((tuple(plain(dict(zip(have, r, strict=True))[c]) for c in names) for r in cur.fetchall()), key=repr)
    assert sorted(have) == names and got == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_a_validated_day_adds_up(spark):
    """Every number of a validation agrees with the others; symbols that were never published are told."""
    v = days._validated(spark, SF, "SH", universe="etfs")
    assert v.violations.count() == 0 and v.records.count() > 0
    cap = 10
    kept = reports.retained(v.records, cap)
    left = v.records.filter("outcome <> 'matched' OR tag IS NOT NULL").count() - kept.count()
    assert reports.conservation(v.records, v.audit, kept, left, v.coverage, v.summary).collect() == []
    assert v.symbols.count() == 1 and v.symbols.first().symbols == v.audit.count() == v.symbols.first().with_selected
    r = v.reports.first()
    assert r.total == v.records.count() and len(r.selection) == v.audit.count() and r.replay.applied > 0 and r.version == 2


def test_groups_are_seen_as_a_whole(spark, tmp_path):
    """Under strict rules a market order and its answers are one step: no frame is held against the states between."""
    root = str(tmp_path)
    day = F.lit(days.TRADING_DAY)
    at = lambda s: days.MIDNIGHT + 36_000_000 + s
    rows = [(1, "A", "limit", "S", None, 1, 100_000, 100, at(0)), (2, "A", "market", "B", 2, None, None, 300, at(1000)), (3, "T", None, "N", 2, 1, 100_000, 100, at(1000)), (4, "C", None, "B", 2, None, None, 200, at(1000)), (5, "A", "limit", "B", 5, None, 99_000, 50, at(1001))]
    events = spark.createDataFrame(rows, "seq long, kind string, ord_type string, side string, bid_no long, ask_no long, price long, qty long, quote_ms long").withColumns({"market": F.lit("SZ"), "symbol": F.lit("000001"), "channel": F.lit(1), "trading_day": day})
    days.write_ticks(events, root, "SZ")
    book_ = market_day.rebuild(spark, root, "SZ", policy="require_evidence")
    assert book_.violations.count() == 0 and sorted(r.seq for r in market_day._hidden_points(book_.placed).collect()) == [2, 3]
    c = market_day.replay_day(spark, root, "SZ", step_ms=3_600_000, policy="require_evidence", check_files=False).counters.first()
    assert (c.pending_groups, c.inferred_remainders, c.direct_rest_limits, c.scheduled, c.market_close) == (1, 0, 2, 4, 1)
    with pytest.raises(ValueError, match="symbols"):
        market_day.rebuild(spark, root, "SZ", symbols=["999999"])


def test_plans_read_the_feed_once(spark):
    """Snapshots stand on the written feed and changes: no plan goes back to the source or sorts it again."""
    for name, most in (("snapshot_stats", 12), ("snapshot_depth", 12), ("close_snapshot", 24)):
        plan = q.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "events.parquet" not in plan and plan.count("Scan parquet") <= 8 and plan.count("Exchange hashpartitioning") <= most, (name, plan.count("Scan parquet"), plan.count("Exchange hashpartitioning"))


def test_a_feed_validates_against_its_own_snapshots(spark):
    """Unspoilt frames all match, depth included; only the spoilt ones differ, in the field that was spoilt."""
    rows = q.queries()["best_candidate"](spark, SF).collect()
    assert rows
    for r in rows:
        k = r.frame_id % 1000
        want = {f for f, hit in (("volume", k % 5 == 0), ("ask_total", k % 5 == 0)) if hit}
        extra = set(r.differ.split(",")) - {""} - want
        assert want <= set(r.differ.split(",")) | set() and extra <= ({"bids"} if k % 11 == 0 else set()) | ({"bid_vwap"} if k % 7 == 0 else set()), (k, r.differ)
