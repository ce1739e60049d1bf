"""Line deduplication by overlapping windows of three consecutive lines.

Every run of three lines is hashed; a window that occurs anywhere else earlier, by (doc_id, place), is a
repeat, and the lines that repeats cover are removed, overlapping covers merged.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookweave.llm.common import small_batches, stored, table, text_of

LINES = 3


def _windows(docs: DataFrame) -> DataFrame:
    """doc_id, th, at (0-based line of the window's start), h1, h2: 128 bits over three lines."""
    lines = docs.select("doc_id", "th", F.split(text_of(), "\n", -1).alias("lines")).filter(F.size("lines") >= LINES)
    each = lines.select("doc_id", "th", "lines", F.explode(F.sequence(F.lit(0), F.size("lines") - LINES)).alias("at"))
    three = [F.col("lines")[F.col("at") + i] for i in range(LINES)]
    return each.select("doc_id", "th", "at", F.xxhash64(*three).alias("h1"), F.xxhash64(F.lit(7919), *reversed(three)).alias("h2"))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), at: every occurrence of a window but the first by (doc_id, th, at)."""
    windows = _windows(docs)
    first = (
        windows.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "th", "at")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("h1", "h2", "first")
    )
    # written, so that the join stands on two plain exchanges and Spark can split the partition of a very common window
    return windows.join(stored(first, "windows"), ["h1", "h2"]).filter(~F.struct("doc_id", "th", "at").eqNullSafe(F.col("first"))).select("doc_id", "th", "at")


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, starts: pd.Series) -> pd.Series:
    def cut(t: str, at) -> str:
        lines = t.split("\n")
        covered = bytearray(len(lines))
        for i in at:
            covered[i : i + LINES] = b"\1" * LINES
        return "\n".join(x for x, gone in zip(lines, covered, strict=True) if not gone)

    return pd.Series([cut(t, a) for t, a in zip(text, starts, strict=True)], dtype=object)


@F.pandas_udf(T.IntegerType())
def _merged(starts: pd.Series) -> pd.Series:
    def size(at) -> int:
        n = end = 0
        for i in sorted(at):
            n += i + LINES - max(end, i)
            end = i + LINES
        return n

    return starts.map(size).astype("int32")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with repeats cut out of `text`, and lines_removed; every row and column is kept.

    A later occurrence loses all three lines; only a window's first occurrence by (doc_id, line) keeps
    them, unless another repeat covers them. Lines compare exactly; a text of under three lines, empty or
    null stays as it is. Different texts under one doc_id, or under none, are documents of their own, in the
    order of their hashes; a null doc_id comes first. Equal rows are treated alike, and are no repeats of each
    other. A text all of whose lines go becomes empty. Texts are looked at whole, however long. A column
    lines_removed of docs is replaced, other columns are kept. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    columns = [c for c in docs.columns if c != "lines_removed"]
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    gone = repeated_windows(keyed).groupBy(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).agg(F.collect_set("at").alias("__starts"))
    joined = docs.join(gone, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__th")), "left")
    hit = F.col("__starts").isNotNull()
    kept = joined.filter(~hit).select(*columns, F.lit(0).alias("lines_removed"))
    cut = joined.filter(hit)
    cut = cut.select(*(_without("text", "__starts").alias("text") if c == "text" else c for c in columns), _merged("__starts").alias("lines_removed"))
    return kept.unionByName(cut)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = {
    "op5_line_dedup": """
WITH lines AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
each AS (
  SELECT doc_id, unnest(range(CAST(len(l) AS BIGINT))) AS p, l FROM lines),
row_ AS (SELECT doc_id, p, l[p + 1] AS s, CASE WHEN p + 3 <= len(l) THEN l[p + 1 : p + 3] END AS win FROM each),
ranked AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) AS nth FROM row_ WHERE win IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, p + o AS p FROM ranked, (VALUES (0), (1), (2)) AS v(o) WHERE nth > 1),
merged AS (
  SELECT row_.doc_id, string_agg(CASE WHEN gone.p IS NULL THEN s END, chr(10) ORDER BY row_.p) AS text,
         CAST(count(gone.p) AS INTEGER) AS lines_removed
  FROM row_ LEFT JOIN gone ON row_.doc_id = gone.doc_id AND row_.p = gone.p GROUP BY row_.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(m.text, '') END AS text, m.lines_removed
FROM documents d JOIN merged m ON d.doc_id = m.doc_id
"""
}
