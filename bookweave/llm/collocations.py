"""Phrase collocations from count streams in prefix and suffix order.

Words, pairs and triples are counted whole, each length only where the shorter phrases in it are frequent. The counts
of all lengths, in one stream, are put in order of their words (prefix order) and of their words read backwards (suffix
order). In prefix order a phrase comes after its first word and its first two, so that one pass gives the counts of its
left parts and hands its own count to the phrases it extends; suffix order gives the right ones. A stream is cut into
ranges; what a range has to hand on is one row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.llm.common import small_batches, stored, table

#: Longest phrase, bytes of text whose phrases are counted before they are passed on, and bits (as a power of two) that tell which phrases may be frequent: 8 MB at most.
LONGEST, COUNTED_BYTES, BITS = 3, 1 << 20, 26
#: Parts in which a language's best phrases are looked for first.
PARTS = 64

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], np.uint8)
_WORD = np.array([i not in b" \t" + _BREAKS for i in range(256)])
_BREAK = np.array([i in _BREAKS for i in range(256)])
_FACTORS = (1_000_003, 8191)
_NAMES = ["w1", "w2", "w3"]


def _words(text: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Of all words: number, the different words, text each is in, and whether the next word follows in the same piece."""
    text = text.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    word = _WORD[raw]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    begins, ends = offsets[:-1][offsets[:-1] < len(raw)], offsets[1:][offsets[1:] > 0] - 1
    first[begins], last[ends] = word[begins], word[ends]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) + 1 - starts
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    each = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(_LOWER[raw[word]])]).dictionary_encode()
    of, piece = np.searchsorted(offsets, starts, side="right") - 1, np.searchsorted(np.flatnonzero(_BREAK[raw]), starts)
    return each.indices.to_numpy(zero_copy_only=False), each.dictionary, of, (of[1:] == of[:-1]) & (piece[1:] == piece[:-1])


def _place(words: list, lang):
    """Bit of a phrase of one or two words, from checksums of its words and language; for numbers and columns alike."""
    return sum((w * f for w, f in zip(words, _FACTORS, strict=False)), lang)


def _bits(counts: DataFrame, words: list[str]) -> np.ndarray:
    """Bits of the phrases of counts: 2**BITS of them, put together by Spark in pieces of 4 KB."""
    at = F.pmod(_place([F.crc32(w) for w in words], F.crc32("lang")), F.lit(1 << BITS)) + 1
    pieces = counts.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for r in pieces.collect():
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["piece"] - 1) * len(part) : r["piece"] * len(part)] = part
    return out


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    at = at & (8 * len(bits) - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _occurrences(size: int, bits):
    """Texts (lang, text) to lang, the words and f of phrases of a size, counted over COUNTED_BYTES of text."""

    def count(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        text, lang = (pa.concat_arrays([b.column(c) for b in batches]) for c in ("text", "lang"))
        ids, words, of, follows = _words(text)
        lang = lang.dictionary_encode()
        langs, ids = lang.dictionary, ids.astype(np.int64)
        code = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[of]
        crc = np.array([zlib.crc32(w) for w in words.to_pylist()], np.int64)
        own = np.array([zlib.crc32((x or "").encode()) for x in langs.to_pylist()], np.int64)
        v = max(1, len(words))
        if size == 1:
            key, parts = code * v + ids, []
        else:
            known = bits.value
            if size == 2:
                frequent = _has(known, _place([crc[ids]], own[code]))
                two = follows & frequent[:-1] & frequent[1:]
                first = np.flatnonzero(two)
                key = (code[first] * v + ids[first]) * v + ids[first + 1]
            else:
                pair, at = np.unique(np.where(follows, (code[:-1] * v + ids[:-1]) * v + ids[1:], -1), return_inverse=True)
                frequent = (pair >= 0) & _has(known, _place([crc[pair // v % v], crc[pair % v]], own[pair // v // v]))
                two = frequent[at]
                first = np.flatnonzero(two[:-1] & two[1:])
                key = at[first] * v + ids[first + 2]
        key, f = np.unique(key, return_counts=True)
        parts = []
        for _ in range(size if size < 3 else 1):
            parts.append(key % v)
            key = key // v
        if size == 3:
            pair = pair[key]
            parts += [pair % v, pair // v % v]
            key = pair // v // v
        strings = words.cast(pa.string())
        return pa.RecordBatch.from_arrays([langs.cast(pa.string()).take(pa.array(key)), *(strings.take(pa.array(p)) for p in reversed(parts)), pa.array(f)], ["lang", *_NAMES[:size], "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_bytes = [], 0
        for batch in batches:
            held.append(batch)
            held_bytes += batch.nbytes
            if held_bytes >= COUNTED_BYTES:
                yield count(held)
                held, held_bytes = [], 0
        if held:
            yield count(held)

    return run


def _counted(texts: DataFrame, size: int, known: DataFrame | None) -> DataFrame:
    """lang, words and f of all phrases of a size whose shorter phrases may be in known."""
    bits = known.sparkSession.sparkContext.broadcast(_bits(known, _NAMES[: size - 1])) if known is not None else None
    columns = _NAMES[:size]
    each = texts.mapInArrow(_occurrences(size, bits), "lang string, " + ", ".join(f"{c} string" for c in columns) + ", f bigint")
    return each.groupBy("lang", *columns).agg(F.sum("f").alias("f"))


def _led(stream: DataFrame) -> DataFrame:
    """A stream (lang, w1, w2, w3, phrase, f) in order of its words: f1 and f2, the counts of the first word and the first two, of phrases longer than these.

    The order is cut into ranges. In each the last shorter phrase so far leads; where a range begins behind it, it is the
    last one of the ranges before, one row each.
    """
    order = ["lang", *_NAMES]
    cut = stored(stream.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "stream")
    one = F.when(F.col("w2").isNull(), F.struct("lang", "w1", "f"))
    two = F.when(F.col("w2").isNotNull() & F.col("w3").isNull(), F.struct("lang", "w1", "w2", "f"))
    so_far = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    handed = cut.groupBy("part").agg(F.max(one).alias("one"), F.max(two).alias("two"))
    handed = handed.select("part", F.last("one", ignorenulls=True).over(before).alias("one_before"), F.last("two", ignorenulls=True).over(before).alias("two_before"))
    here = cut.withColumns({"one": F.last(one, ignorenulls=True).over(so_far), "two": F.last(two, ignorenulls=True).over(so_far)}).filter("w2 IS NOT NULL")
    both = here.join(handed, "part").withColumns({"one": F.coalesce("one", "one_before"), "two": F.coalesce("two", "two_before")})
    return both.select(*order, "phrase", "f", F.col("one.f").alias("f1"), F.when(F.col("w3").isNotNull(), F.col("two.f")).alias("f2"))


def _score(left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)): 38 digits."""
    wide = lambda c: c.cast("decimal(16,0)")
    return F.call_function("div", wide(F.col("f")) * wide(F.col("f")) * F.lit(1_000_000).cast("decimal(7,0)"), wide(left) * wide(right))


def collocations(docs: DataFrame, least: int = 10, inside: int = 50, best: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two or three words that occur `least` times.

    A text is cut into pieces at `.,;:!?` and line ends, pieces into words at spaces and tabs; A-Z are put in lower case.
    a counts a phrase, l and r the parts of the cut with the lowest score (ties: the shorter first part), n all words of
    the language. A pair goes if a triple that holds it occurs at least `inside` times for each hundred of its own. Equal
    scores are ranked by a, then by phrase in order of bytes. Null texts are empty; a null lang is `und`. Repeated rows
    count each. Texts are read whole. An empty table gives an empty result; columns but lang and text are left behind.
    """
    small_batches(docs.sparkSession, COUNTED_BYTES >> 20)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    words = stored(_counted(texts, 1, None), "words")
    counts = [words.filter(F.col("f") >= least)]
    for size in range(2, LONGEST + 1):
        counts.append(stored(_counted(texts, size, counts[-1]).filter(F.col("f") >= least), "phrases"))

    def stream(backwards: bool) -> DataFrame:
        out = None
        for size, c in enumerate(counts, 1):
            names = _NAMES[:size]
            of = [F.col(x) for x in (reversed(names) if backwards else names)] + [F.lit(None).cast("string")] * (LONGEST - size)
            c = c.select("lang", *(x.alias(y) for x, y in zip(of, _NAMES, strict=True)), F.concat_ws(" ", *names).alias("phrase"), "f")
            out = c if out is None else out.unionByName(c)
        return out

    forward, back = stored(_led(stream(False)), "prefix"), stored(_led(stream(True)), "suffix")
    longer = forward.filter("w3 IS NOT NULL").select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "f").unionByName(back.filter("w3 IS NOT NULL").select("lang", F.concat_ws(" ", "w2", "w1").alias("phrase"), "f"))
    extended = longer.groupBy("lang", "phrase").agg(F.max("f").alias("more"))
    both = forward.join(back.select("lang", "phrase", F.col("f1").alias("b1"), F.col("f2").alias("b2")).hint("merge"), ["lang", "phrase"]).join(extended.hint("merge"), ["lang", "phrase"], "left")
    both = both.filter(F.col("w3").isNotNull() | F.col("more").isNull() | (F.lit(100) * F.col("more") < F.lit(inside) * F.col("f")))
    cut = lambda k, left, right: F.struct(_score(F.col(left), F.col(right)).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
    x = F.when(F.col("w3").isNull(), cut(1, "f1", "b1")).otherwise(F.least(cut(1, "f1", "b2"), cut(2, "f2", "b1")))
    scored = both.select("lang", "phrase", F.col("f").alias("a"), x.alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    by = [F.desc("score"), F.desc("a"), "phrase"]
    some = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("nth", F.row_number().over(W.partitionBy("lang", "part").orderBy(*by))).filter(F.col("nth") <= best)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*by)).cast("bigint")).filter(F.col("rank") <= best)
    return ranked.join(words.groupBy("lang").agg(F.sum("f").alias("n")), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = {
    "op11_phrase_collocations": r"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, unnest([[w[i]], CASE WHEN i + 1 <= len(w) THEN [w[i], w[i + 1]] END, CASE WHEN i + 2 <= len(w) THEN [w[i], w[i + 1], w[i + 2]] END]) AS g FROM i),
f AS (SELECT lang, g, count(*) AS f FROM g WHERE g IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE len(g) >= 2 AND f >= 10),
cuts AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM c),
scored AS (
  SELECT cuts.lang, cuts.g, a, k, x.f AS l, y.f AS r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = cuts.g[1:k] JOIN f y ON y.lang = cuts.lang AND y.g = cuts.g[k + 1:]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ AS (SELECT lang, g[1:2] AS g, f FROM c WHERE len(g) = 3 UNION ALL SELECT lang, g[2:3], f FROM c WHERE len(g) = 3),
most AS (SELECT lang, g, max(f) AS more FROM inner_ GROUP BY ALL),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.g, ' ')) AS rank, array_to_string(b.g, ' ') AS phrase, a, l, r, score
  FROM best b LEFT JOIN most m ON m.lang = b.lang AND m.g = b.g WHERE m.more IS NULL OR 100 * m.more < 50 * a)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""
}
