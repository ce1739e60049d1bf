"""Benchmark decontamination by spaced-seed hashing.

Fixed masks choose which of a few consecutive tokens are hashed; the others may differ. Hashes of test
items are joined with those at every token of every document, and along each line of hits the two texts
are compared token by token, so that passages with some words replaced are still found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.llm.common import stored, table, text_of

#: Tokens whose place has a 1 are hashed. Every stretch of LEAST tokens or more of which three in four are equal,
#: wherever the others stand, meets one of these three (a test goes through all such stretches of 14 to 27 tokens;
#: a longer one holds one of these).
MASKS = ["1010000111", "110111", "1111001"]
#: Tokens that must be compared, and fewest tokens of an item that is looked for unless asked otherwise; items between are looked for whole and unchanged.
LEAST, SHORTEST = 14, 4
#: An equal token counts one, another takes away three: a stretch of three equal ones in four comes to nought.
_OFF = 3
#: What a line is: a text, an item (wh: its words' hash) and how far the one is shifted against the other.
_LINE = ["doc_id", "th", "item_id", "wh", "shift"]


def _tokens(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def _each_seed(words: DataFrame, keys: list[str], masks: list[str]) -> DataFrame:
    """keys, mask (its number), at (token where the seed begins), seed. Outer: a plain explode would have Spark filter by the array's size first, computed over again within itself."""
    least = min(map(len, masks))
    hashed = words.select(*keys, F.transform("words", lambda w: F.xxhash64(w)).alias("h")).filter(F.size("h") >= least)
    places = F.sequence(F.lit(0), F.size("h") - least)

    def of(m: int, mask: str) -> Column:
        seed = lambda i: F.xxhash64(F.lit(m), *(F.get("h", i + k) for k, c in enumerate(mask) if c == "1"))
        return F.transform(places, seed if len(mask) == least else lambda i: F.when(i + len(mask) <= F.size("h"), seed(i)))

    seeds = F.concat(*(of(m, mask) for m, mask in enumerate(masks)))
    each = hashed.select(*keys, (F.size("h") - (least - 1)).alias("m"), seeds.alias("seeds")).select(*keys, "m", F.posexplode_outer("seeds").alias("p", "seed"))
    return each.filter("seed IS NOT NULL").select(*keys, F.floor(F.col("p") / F.col("m")).cast("int").alias("mask"), (F.col("p") % F.col("m")).alias("at"), "seed")


def _stretches(lines: DataFrame) -> DataFrame:
    """keys of a line, compared, excess, back: each place of a line (item_id, text and shift) at which a stretch of `least` tokens or more ends that is not below nought, with the longest one there.

    steps: 1 or -3 a token. With the sums of steps up to each place, the longest stretch that ends at one begins at the
    first place whose sum is not higher: a running minimum over the places in the order of their sums.
    """
    whole = F.aggregate("steps", F.lit(0), lambda a, x: a + x)
    equal = F.size(F.filter("steps", lambda x: x == 1))
    place = lambda p, x: F.struct(p.cast("int").alias("p"), x.alias("x"))
    start = place(F.lit(0), F.lit(0))
    # mostly the whole of what lies side by side will do, or too few tokens are equal anywhere
    places = F.when(F.col("whole") >= 0, F.array(start, place(F.col("length"), F.col("whole")))).otherwise(F.concat(F.array(start), F.transform("steps", lambda x, i: place(i + 1, x))))
    some = lines.withColumns({"whole": whole, "equal": equal}).filter("whole >= 0 OR 4 * equal >= 3 * least")
    each = some.select(*_LINE, "first", "least", F.inline(places))
    line = W.partitionBy(*_LINE)
    each = each.withColumn("c", F.sum("x").over(line.orderBy("p").rowsBetween(W.unboundedPreceding, 0)))
    each = each.withColumn("low", F.min(F.struct("p", "c")).over(line.orderBy("c").rangeBetween(W.unboundedPreceding, 0)))
    return each.filter("p - low.p >= least").select(*_LINE, "first", (F.col("p") - F.col("low.p")).alias("compared"), (F.col("c") - F.col("low.c")).alias("excess"), (-F.col("low.p")).alias("back"))


def _found(docs: DataFrame, benchmark: DataFrame, shortest: int) -> DataFrame:
    """doc_id, th (hash of the text), item_id, matched, compared, first_token: one row per text and test item it holds."""
    words = _tokens(text_of())
    items = benchmark.select("item_id", words.alias("words")).withColumn("n", F.size("words")).filter(F.col("n") >= max(1, shortest))
    short = [r["n"] for r in items.filter(F.col("n") < LEAST).select("n").distinct().collect()]  # thirteen lengths at most
    masks = MASKS + ["1" * n for n in sorted(short)]
    own = F.when(F.col("n") >= LEAST, F.col("mask") < len(MASKS)).otherwise((F.col("at") == 0) & (F.col("mask") == len(MASKS) - 1 + F.array_position(F.array(*map(F.lit, sorted(short) or [0])), F.col("n"))))
    seeds = _each_seed(items, ["item_id", "n"], masks).filter(own).select("item_id", F.col("at").alias("j"), "seed", "mask")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    hits = _each_seed(texts.select("doc_id", "th", words.alias("words")), ["doc_id", "th"], masks).join(stored(seeds, "seeds"), ["seed", "mask"])
    # stored, so that only texts with a hit are taken apart again, and Spark knows how many there are
    lines = stored(hits.select("doc_id", "th", "item_id", (F.col("at") - F.col("j")).alias("shift")).distinct(), "lines")

    hit = lines.select(F.col("doc_id").alias("d"), F.col("th").alias("h")).distinct()
    here = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h"))
    taken = texts.join(hit, here, "left_semi").distinct().select(F.col("doc_id").alias("d"), F.col("th").alias("h"), words.alias("t"))
    both = lines.join(taken, here).join(items.distinct().select("item_id", F.col("words").alias("w"), "n"), "item_id")
    first = F.greatest(F.lit(0), -F.col("shift"))
    both = both.withColumns({"first": first, "length": F.least(F.col("n"), F.size("t") - F.col("shift")) - first, "least": F.least(F.col("n"), F.lit(LEAST))}).filter("length >= least")
    step = lambda x, y: F.when(x == y, 1).otherwise(F.when(F.col("n") < LEAST, -1_000_000).otherwise(-_OFF))
    steps = F.zip_with(F.slice("w", F.col("first") + 1, F.col("length")), F.slice("t", F.col("first") + F.col("shift") + 1, F.col("length")), step)
    best = _stretches(both.select("doc_id", "th", "item_id", F.xxhash64("w").alias("wh"), "shift", "first", "least", "length", steps.alias("steps")))
    told = best.select("doc_id", "th", "item_id", F.struct(F.col("compared").cast("int").alias("compared"), ((F.col("excess") + F.lit(_OFF) * F.col("compared")) / (_OFF + 1)).cast("int").alias("matched"), (F.col("back") - F.col("first") - F.col("shift")).alias("back")).alias("x"))
    return told.groupBy("doc_id", "th", "item_id").agg(F.max("x").alias("x")).select("doc_id", "th", "item_id", "x.matched", "x.compared", (-F.col("x.back")).cast("int").alias("first_token"))


def contaminated(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, item_id, matched, compared, first_token: one row per document and test item it holds.

    A document holds an item if the two, laid side by side somewhere, agree in three of four tokens over a
    stretch of 14 tokens or more; told is the longest such stretch (of these the one with most equal
    tokens, then the first). Every such stretch is found. Items of fewer tokens must be there whole and
    unchanged; those under `shortest` tokens, which are phrases of every text, are not looked for. Null and empty texts match
    nothing, however long a text is it is searched whole, repeated rows count once, and texts that share a
    doc_id are one document. An empty table on either side gives an empty result; columns but doc_id and
    text are left behind.
    """
    best = F.max(F.struct("compared", "matched", (-F.col("first_token")).alias("back"))).alias("x")
    return _found(docs, benchmark, shortest).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "x.matched", "x.compared", (-F.col("x.back")).alias("first_token"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Rows of docs whose text holds no test item, all columns kept. Each text counts for itself, with or without a doc_id."""
    gone = stored(_found(docs, benchmark, shortest).select(F.col("doc_id").alias("__doc"), F.col("th").alias("__th")).distinct(), "leaks")
    return docs.join(gone, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__th")), "left_anti")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"


def _keys(words: str, at: str) -> str:
    keys = [f"CASE WHEN {at} + {len(mask)} <= len({words}) THEN concat_ws(' ', '{m}', " + ", ".join(f"{words}[{at} + {i + 1}]" for i, c in enumerate(mask) if c == "1") + ") END" for m, mask in enumerate(MASKS)]
    return f"unnest([{', '.join(keys)}])"


ORACLE = {
    "op7_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS t FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
di AS (SELECT doc_id, t, unnest(range(len(t))) AS i FROM d),
bj AS (SELECT item_id, w, unnest(range(len(w))) AS j FROM b WHERE len(w) >= {LEAST}),
dk AS (SELECT doc_id, i, {_keys('t', 'i')} AS k FROM di),
bk AS (SELECT item_id, j, {_keys('w', 'j')} AS k FROM bj),
hits AS (
  SELECT DISTINCT doc_id, item_id, i - j AS shift FROM dk JOIN bk USING (k)
  UNION SELECT doc_id, item_id, i FROM di JOIN b ON len(w) BETWEEN {SHORTEST} AND {LEAST - 1} AND t[i + 1] = w[1] AND t[i + 1 : i + len(w)] = w),
side AS (
  SELECT doc_id, item_id, shift, t, w, greatest(0, -shift) AS a, least(len(w), len(t) - shift) AS z, least(len(w), {LEAST}) AS least_ FROM hits JOIN d USING (doc_id) JOIN b USING (item_id)),
each AS (SELECT doc_id, item_id, shift, least_, len(w) AS n, unnest(range(a, z)) AS p, t, w FROM side),
marks AS (SELECT doc_id, item_id, shift, least_, p, CASE WHEN t[p + shift + 1] = w[p + 1] THEN 1 WHEN n < {LEAST} THEN -1000000 ELSE -3 END AS s FROM each),
sums AS (SELECT doc_id, item_id, shift, least_, p + 1 AS p, sum(s) OVER (PARTITION BY doc_id, item_id, shift ORDER BY p) AS c FROM marks
  UNION ALL SELECT doc_id, item_id, shift, least_, a, 0 FROM side),
found AS (
  SELECT x.doc_id, x.item_id, y.p - x.p AS compared, (y.c - x.c + 3 * (y.p - x.p)) // 4 AS matched, x.p + x.shift AS first_token
  FROM sums x JOIN sums y ON x.doc_id = y.doc_id AND x.item_id = y.item_id AND x.shift = y.shift AND y.p - x.p >= x.least_ AND y.c >= x.c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY compared DESC, matched DESC, first_token) AS nth FROM found)
SELECT doc_id, item_id, CAST(matched AS INTEGER) AS matched, CAST(compared AS INTEGER) AS compared, CAST(first_token AS INTEGER) AS first_token FROM ranked WHERE nth = 1
"""
}
