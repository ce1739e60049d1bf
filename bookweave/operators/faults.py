"""Where books end that break a rule: nothing from a book's first fault on is applied or told."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookweave.schema import BOOK

#: What becomes of a day with faults: it is refused, its books end at their first ones, or rows that break no rule of their own are applied all the same.
POLICIES = ("raise", "cut", "keep")


class FaultyDay(ValueError):
    """A day that breaks a rule; nothing of it has been written."""


def refuse(violations: DataFrame) -> None:
    """Raises FaultyDay with the first rule broken by (day, channel, sequence), if there is one."""
    order = [F.asc_nulls_last(c) for c in ("market", "trading_day", "channel", "seq", "symbol", "code")]
    if (first := violations.orderBy(*order).limit(1).collect()):
        raise FaultyDay(", ".join(f"{k} {v}" for k, v in first[0].asDict().items() if v is not None))


def book_ends(violations: DataFrame, events: DataFrame, rows: DataFrame) -> DataFrame:
    """Books that end early: end_seq (their first fault, or that of their channel), code, and end_ms, the last time at which what came before is the whole book.

    violations: market, trading_day, symbol (null: of a whole channel), channel, seq (null: from the start on), code. rows:
    what was selected, faulty rows among it. All are read more than once.
    """
    at = F.min(F.struct(F.coalesce("seq", F.lit(0)).alias("seq"), "code")).alias("at")
    own = violations.filter("symbol IS NOT NULL").groupBy(*BOOK).agg(at).withColumnRenamed("at", "own")
    shared = violations.filter("symbol IS NULL").groupBy("market", "trading_day", "channel").agg(at).withColumnRenamed("at", "shared")
    books = rows.filter("symbol IS NOT NULL").select(*BOOK, "channel").distinct()
    ends = books.join(own, BOOK, "left").join(shared, ["market", "trading_day", "channel"], "left").withColumn("at", F.least("own", "shared")).filter("at IS NOT NULL")
    ends = ends.groupBy(*BOOK).agg(F.min("at").alias("at")).select(*BOOK, F.col("at.seq").alias("end_seq"), F.col("at.code").alias("code"))
    fault = rows.join(ends, BOOK).filter("seq = end_seq").groupBy(*BOOK).agg(F.min("quote_ms").alias("fault_ms"))
    good = events.filter("kind <> 'S'").join(ends, BOOK).filter("seq < end_seq").groupBy(*BOOK).agg(F.max("quote_ms").alias("good_ms"))
    return ends.join(fault, BOOK, "left").join(good, BOOK, "left").select(*BOOK, "end_seq", "code", F.coalesce("fault_ms", "good_ms", F.lit(0)).alias("end_ms"))


def before_end(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows (book, seq) that come before their book's end."""
    return rows.join(ends.select(*BOOK, "end_seq"), BOOK, "left").filter("end_seq IS NULL OR seq < end_seq").drop("end_seq")
