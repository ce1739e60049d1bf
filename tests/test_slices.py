"""Values that run on over slices are those of one window over everything; no task gets a whole book."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.operators import book, integrity, ledger, slices, validation
from bookweave.operators.slices import Running, running
from bookweave.plans import checks, core
from bookweave.schema import BOOK
from bookweave.shared import written

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_running_values(spark):
    """All kinds, with and without the row itself, with nulls, ties, negative places and gaps."""
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.choice([-70, -1, 0, 1, 7, 8, 9, 40, 41, 42, 1000, 10**12 + rng.randrange(40)]), i, rng.choice([None, rng.randrange(100)])) for i in range(300)]
    rows = written(spark.createDataFrame(data, "k string, o long, t long, v long"), "rows")
    kinds = {f"{kind}_{b}": Running(kind, F.col("v"), b) for kind in ("sum", "count", "max", "min", "last") for b in (False, True)}
    w = W.partitionBy("k").orderBy("o", "t")
    want = rows.withColumns({n: c.over(w) for n, c in kinds.items()})
    for bits in (0, 3, 50):
        got = running(rows, ["k"], "o", kinds, ["t"], bits)
        assert got.schema.simpleString() == want.schema.simpleString()
        fill = {n: 0 for n in kinds if n.startswith("count")}
        assert rows_of(got.fillna(fill)) == rows_of(want.fillna(fill))


@pytest.fixture(scope="module")
def base(spark):
    return core.rebuilt(spark, SF)


def test_everything_that_runs_is_the_same_in_slices(spark, base, monkeypatch):
    feed, changes = base
    odd = written(feed.withColumn("quote_ms", F.when(F.col("seq") % 7 == 0, F.col("quote_ms") - 5_000_000).otherwise(F.col("quote_ms"))), "odd")
    frames = checks._frames(base)

    def results():
        points = written(validation.states(*base), "states")
        found = written(validation.candidates(frames, points, checks.HALF_HOUR), "found")
        out = [book.running_stats(feed), book.apply_sequence(feed), integrity.time_regressions(odd), points, found, validation.best_match(frames, found, points, changes), validation.depth_at(changes, points.filter("seq % 5 = 1"))]
        shuffled = odd.withColumn("source_row", F.col("qty") * 1000 + F.col("seq") % 1000)
        return [rows_of(x) for x in [*out, integrity.sequence_regressions(shuffled, ["channel"]), integrity.natural_runs(shuffled, ["channel"])]]

    whole = results()
    monkeypatch.setattr(slices, "NUMBERS", 4)
    monkeypatch.setattr(slices, "TIMES", 12)
    assert all(whole) and results() == whole


def test_one_book_is_many_tasks_work(spark, monkeypatch):
    """A book that holds all events: no window is over the book's rows, and no task has more than a few slices."""
    monkeypatch.setattr(slices, "NUMBERS", 6)
    rows = spark.range(20_000).select(F.lit("SZ").alias("market"), F.lit(20260828).alias("trading_day"), F.lit("000001").alias("symbol"), F.col("id").alias("seq"), F.lit("T").alias("kind"), F.lit(100).cast("long").alias("price"), F.lit(1).cast("long").alias("qty"), F.col("id").alias("quote_ms"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = book.running_stats(written(rows, "rows"))
        tasks = out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("volume").alias("v")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) == 16 and max(t.n for t in tasks) < 4_000 and max(t.v for t in tasks) == 20_000
    plan = book.running_stats(rows)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "__e_" not in line:
            assert "__slice" in line.split("], [")[1], line


def test_order_checks_see_no_whole_channel(spark):
    rows = ledger.references(core._feed(spark, SF)).withColumn("source_row", F.col("seq"))
    for df in (integrity.sequence_regressions(rows, ["channel"]), integrity.natural_runs(rows, ["channel"]), integrity.time_regressions(core._feed(spark, SF))):
        for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines():
            if "Window [" in line and "__e_" not in line:
                assert "__slice" in line.split("], [")[1], line
    assert BOOK == ["market", "trading_day", "symbol"]
