"""Exact deduplication by an extendible-hash index on shared files.

Every text is hashed. Keys that more than one row has are indexed: buckets of keys that hold more text than one may are
split by one more bit of the key, the directory doubling each time, until none is overfull. Owner tasks take the pages
of a range of keys each, bucket by bucket, chain texts of one key and compare their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookweave.llm.common import small_batches, stored, table

#: Bytes of text beyond which a bucket is split, and how many times as much an owner's range of keys has, as a power of two.
BUCKET_BYTES, OWNER_BITS = 1 << 20, 2
#: Bytes of text that a task holds while it merges copies.
MERGED_BYTES = 32 << 20

_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_PAGE = "key bigint, sha binary, n bigint, last bigint, text binary"


def _later(a: int | None, b: int | None) -> int | None:
    return a if b is None or a is not None and a > b else b


def _hashed(bits: int):
    """Rows to doc_id, key and sha of each, and for one row of each text of a batch its text, n and last (the largest doc_id)."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("sha", pa.binary()), ("n", pa.int64()), ("last", pa.int64()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, seen, first, rows = batch.column("doc_id").to_pylist(), {}, {}, []
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                text = (text or b"").translate(_LOWER)
                if text in first:
                    seen[text][0] += 1
                    seen[text][1] = _later(seen[text][1], ids[i])
                    rows.append(rows[first[text]])
                else:
                    seen[text], first[text] = [1, ids[i]], i
                    key = xxhash.xxh3_64_intdigest(text) >> (64 - bits) << (64 - bits)
                    rows.append((key - (1 << 64) if key >> 63 else key, hashlib.sha256(text).digest()))
            one = {i: text for text, i in first.items()}
            told = [(*seen[one[i]], one[i]) if i in one else (None, None, None) for i in range(len(rows))]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip([ids, *zip(*rows, strict=True), *zip(*told, strict=True)] if rows else [[]] * 6, schema, strict=True)], schema=schema)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of equal key and text as one, as far as a task sees them together."""
    held: dict[tuple, list] = {}
    size = 0

    def out():
        cols = list(zip(*((o, b, k, s, n, last, t) for (o, b, k, t), (s, n, last) in held.items()), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["owner", "bucket", "key", "sha", "n", "last", "text"])

    for batch in batches:
        for o, b, k, s, n, last, t in zip(*(batch.column(c).to_pylist() for c in ("owner", "bucket", "key", "sha", "n", "last", "text")), strict=True):
            if (own := held.get((o, b, k, t))) is not None:
                own[1], own[2] = own[1] + n, _later(own[2], last)
            else:
                held[o, b, k, t] = [s, n, last]
                size += len(t)
        if size > MERGED_BYTES:
            yield out()
            held, size = {}, 0
    if held:
        yield out()


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages in order of bucket to links: key, sha, n, keep_id. One bucket is held at a time; a key's different texts are a chain."""

    def out(bucket: dict[int, list]) -> pa.RecordBatch:
        links = [(key, *link[1:]) for key, chain in bucket.items() for link in chain]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*links, strict=True), (pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True)], ["key", "sha", "n", "keep_id"])

    at, bucket = None, {}
    for batch in batches:
        for o, b, key, sha, n, last, text in zip(*(batch.column(c).to_pylist() for c in ("owner", "bucket", "key", "sha", "n", "last", "text")), strict=True):
            if (o, b) != at:
                if bucket:
                    yield out(bucket)
                at, bucket = (o, b), {}
            chain = bucket.setdefault(key, [])
            for link in chain:
                if link[0] == text:
                    link[2], link[3] = link[2] + n, _later(link[3], last)
                    break
            else:
                chain.append([text, sha, n, last])
    if bucket:
        yield out(bucket)


def _leading(bits: int) -> Column:
    """The first bits of the key."""
    return F.lit(0).cast("bigint") if bits == 0 else F.shiftrightunsigned("key", 64 - bits)


def directory(keys: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """Keys (key, bytes) dealt into buckets: key, bucket (its leading bits), depth; and the depth at which the directory began.

    A bucket of more bytes than it may have is split by one more bit until it fits; one key is never split. The
    directory begins at the depth that buckets filled to the brim would need. Each doubling reads only keys of overfull
    buckets.
    """
    total = keys.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    begin = depth = max(0, (total // bucket_bytes).bit_length() - 1)
    done, left = [], keys
    while True:
        here = left.withColumn("bucket", _leading(depth))
        sizes = here.groupBy("bucket").agg(F.sum("bytes").alias("all"), (F.min("key") < F.max("key")).alias("several"))
        over = stored(sizes.select("bucket", (F.col("several") & (F.col("all") > bucket_bytes)).alias("over")), "directory")
        split = here.join(over, "bucket")
        done.append(split.filter("NOT over").select("key", "bucket", F.lit(depth).alias("depth")))
        if over.filter("over").isEmpty():
            break
        left, depth = stored(split.filter("over").select("key", "bytes"), "overfull"), depth + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out, begin


def exact_groups(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, key_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: a row per row of docs.

    Texts are equal when they are after A-Z are put in lower case; null is the empty text. Of equal texts the row with the
    largest doc_id stays, a row without doc_id only if none has one; of several rows with that doc_id and an equal text,
    which are alike, one stays. Texts are hashed and compared whole, however long. Keys of key_bits bits (fewer
    collide often) never decide: bytes do. An empty table gives an empty result; columns but doc_id and text are left
    behind.
    """
    spark = docs.sparkSession
    small_batches(spark)
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_hashed(key_bits), "doc_id bigint, " + _PAGE)
    rows = stored(read.withColumn("place", F.monotonically_increasing_id()), "rows")

    # a row per key and SHA-256 first, so that a text of very many copies is combined before it is shuffled
    heads = stored(rows.groupBy("key", "sha").agg(F.count("*").alias("rows"), F.max(F.struct("doc_id", "place")).alias("last"), F.max(F.octet_length("text")).cast("bigint").alias("bytes")), "heads")
    keys = stored(heads.groupBy("key").agg(F.sum("rows").alias("n"), F.sum("bytes").alias("bytes")).filter("n > 1").select("key", "bytes"), "keys")
    placed, depth = directory(keys, bucket_bytes)
    owner = _leading(max(0, depth - OWNER_BITS))
    first = F.call_function("shiftleft", F.col("bucket"), F.lit(64) - F.col("depth"))  # of a bucket's range of keys
    placed = stored(placed.select("key", owner.alias("owner"), first.alias("bucket")), "index")

    page = "owner bigint, bucket bigint, " + _PAGE
    entries = rows.filter("n IS NOT NULL").select("key", "sha", "n", "last", "text").join(placed, "key").select("owner", "bucket", "key", "sha", "n", "last", "text").mapInArrow(_merged, page)
    links = entries.repartition("owner").sortWithinPartitions("owner", "bucket", "key").mapInArrow(_chained, "key bigint, sha binary, n bigint, keep_id bigint")
    same = F.assert_true((F.col("n") == F.col("rows")) & F.col("keep_id").eqNullSafe(F.col("last.doc_id")))
    links = stored(stored(links, "links").join(heads, ["key", "sha"]).select("key", "sha", "n", "keep_id", F.col("last.place").alias("keep_place"), same.alias("checked")), "links")

    linked = rows.select("doc_id", "key", "sha", "place").join(links.drop("checked"), ["key", "sha"], "left")
    alone = F.col("n").isNull()
    return linked.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("place") == F.col("keep_place"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = {
    "op12_exact_dedup": """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d
"""
}
