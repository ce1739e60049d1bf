"""Two-pass external shuffle of records into shards.

Pass one scatters records into memory-sized buckets by a seeded hash; pass two shuffles each bucket
with Fisher-Yates (Spark's ``shuffle`` of an array) and writes it. The buckets one behind the other are one
random order of all records, which is cut into shards whose sizes differ by one row at most (law ``rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.llm.common import new_path, stored, table, text_of

#: Buckets whose first places are summed up together.
TOGETHER = 1024
#: Copies of one row that one task numbers.
NUMBERED = 256


def size_of(text: str = "text") -> Column:
    return (F.octet_length(text_of(text)) + F.lit(16)).cast("bigint")


def _starts(rows: DataFrame) -> DataFrame:
    """bucket, start: how many rows are in the buckets before. Summed in two steps, so that no task sees a row for every bucket."""
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("part", F.floor(F.col("bucket") / TOGETHER))
    before = lambda *by: W.partitionBy(*by).orderBy("bucket" if by else "part").rowsBetween(W.unboundedPreceding, -1)
    of = lambda w: F.coalesce(F.sum("n").over(w), F.lit(0))
    parts = counts.groupBy("part").agg(F.sum("n").alias("n")).select("part", of(before()).alias("first"))
    inside = counts.select("part", "bucket", of(before("part")).alias("inside"))
    return inside.join(parts, "part").select("bucket", (F.col("first") + F.col("inside")).alias("start"))


def shard_records(docs: DataFrame, shards: int = 40, seed: int = 17, bucket_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, text, shard and slot of every row.

    A row's bucket follows from seed, doc_id and text; rows that are there more than once are numbered
    besides, so that copies scatter too. Null texts stay null. Repeated rows are all kept and get slots of their own.
    A text longer than a bucket has one nearly to itself. An empty table gives an empty result; columns but
    doc_id and text are left behind. The order within a bucket is drawn anew each time this is computed:
    write it (write_shards) before it is used twice.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    total = rows.agg(F.coalesce(F.sum(size_of()), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    buckets = max(1, -(-total["bytes"] // bucket_bytes))
    again = stored(rows.groupBy("doc_id", "th").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("d"), F.col("th").alias("h")), "repeated")
    here = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h"))
    # repeated rows are numbered, in runs that are dealt out first: no draw, so that whatever reads rows sees the same ones
    runs = rows.join(again, here, "left_semi").groupBy("doc_id", "text", "th").agg(F.count("*").alias("n")).select("doc_id", "text", "th", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / NUMBERED))).alias("run"))
    last = F.least(F.col("n"), (F.col("run") + 1) * NUMBERED) - 1
    copies = runs.repartition("doc_id", "th", "run").select("doc_id", "text", "th", F.explode(F.sequence(F.col("run") * NUMBERED, last)).alias("copy"))
    marked = rows.join(again, here, "left_anti").withColumn("copy", F.lit(None).cast("bigint")).unionByName(copies)
    place = F.xxhash64(F.lit(seed), "doc_id", "th", "copy")
    rows = marked.select("doc_id", "text", "th", F.pmod(place, F.lit(buckets)).alias("bucket"))

    # first in an order of their own, whatever the order in which they arrive
    record = F.struct(F.xxhash64(F.lit(seed + 1), "doc_id", "th").alias("h"), "doc_id", "text")
    shuffled = rows.groupBy("bucket").agg(F.shuffle(F.array_sort(F.collect_list(record)), F.lit(seed)).alias("records"))
    dealt = shuffled.join(stored(_starts(rows), "starts"), "bucket").select("start", F.posexplode("records").alias("at", "r")).withColumn("place", F.col("start") + F.col("at"))
    n, s = F.lit(total["n"]).cast("bigint"), F.lit(shards).cast("bigint")
    div = lambda a, b: F.call_function("div", a, b)
    shard = div(F.col("place") * s, n)
    return dealt.select("r.doc_id", "r.text", shard.cast("int").alias("shard"), (F.col("place") - div(shard * n + s - 1, s)).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """A folder per shard, its rows in order of slot within each file. Every task writes the buckets that it has shuffled."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands in the shards once they are written."""
    path = new_path(spark, "shards")
    write_shards(shard_records(table(spark, sf_dir, "documents"), shards=40), path)
    back = spark.read.schema("doc_id bigint, text string, slot bigint, shard int").parquet(path)
    return back.select("doc_id", size_of().alias("size"), F.crc32(text_of()).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
