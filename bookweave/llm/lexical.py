"""Ranked lexical search by an Aho-Corasick scan of the documents.

No index of the documents is made. The terms of all items, each between guards, are one automaton that is broadcast and
counts terms in every text as it is read; what it tells maps to the items that hold the term. One scan gives the
counts of the whole table, a second one the scores.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookweave.llm.common import small_batches, stored, table, text_of

#: Bytes of item text that one automaton serves; further items have automata and scans of their own.
ITEM_BYTES = 8 << 20
#: Scores that a task holds at once, and parts in which an item's best documents are looked for first.
HELD, PARTS = 1 << 20, 64

_GUARD = 0x20
_IS_TERM = np.array([i >= 0x80 or chr(i).isalnum() for i in range(256)])
_NORMAL = bytes(i + 32 if 65 <= i <= 90 else i if _IS_TERM[i] else _GUARD for i in range(256))
_TERM = re.compile(rb"[^ ]+")
_MATCHERS: dict[str, ahocorasick.Automaton] = {}


def _terms(text: str | None) -> list[str]:
    """Terms as strings of one character a byte."""
    return [t.decode("latin-1") for t in _TERM.findall((text or "").encode("utf-8", "surrogatepass").translate(_NORMAL))]


def _matcher(terms) -> ahocorasick.Automaton:
    """The automaton of a broadcast list of terms, built once in each worker. Every term stands between two guards, so that only whole terms of a text match."""
    if terms.name not in _MATCHERS:
        _MATCHERS.clear()
        machine = ahocorasick.Automaton()
        for i, term in enumerate(terms.value):
            machine.add_word(f" {term} ", i)
        machine.make_automaton()
        _MATCHERS[terms.name] = machine
    return _MATCHERS[terms.name]


class _Terms:
    """A broadcast list of terms, by whose name a worker knows the automaton that it has built of them."""

    def __init__(self, spark: SparkSession, terms: list[str]):
        self.name, self._sent = uuid.uuid4().hex, spark.sparkContext.broadcast(terms)

    @property
    def value(self) -> list[str]:
        return self._sent.value


def _scanned(batch: pa.RecordBatch, machine: ahocorasick.Automaton) -> Iterator[tuple[int, int, dict[int, int]]]:
    """Of each text: its place in the batch, its number of terms, and how often each term of the automaton occurs."""
    told = itemgetter(1)
    for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
        text = b" " + (text or b"").translate(_NORMAL) + b" "
        raw = np.frombuffer(text, np.uint8) != _GUARD
        yield i, int(np.count_nonzero(raw[1:] & ~raw[:-1])), Counter(map(told, machine.iter(text.decode("latin-1")))) if len(machine) else {}


def _corpus(docs: DataFrame, terms: _Terms) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and documents that hold each of `terms`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, some, all_, df = _matcher(terms), 0, 0, np.zeros(len(terms.value), np.int64)
        for batch in batches:
            for _, n, found in _scanned(batch, machine):
                some, all_ = some + (n > 0), all_ + n
                df[list(found)] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *held.tolist()], pa.int64()), pa.array([some, all_, *df[held].tolist()], pa.int64())], ["term", "n"])

    df = np.zeros(len(terms.value) + 2, np.int64)
    for r in docs.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]
    return int(df[-2]), int(df[-1]), df[:-2]


def _best(score: np.ndarray, item: np.ndarray, doc: np.ndarray, none: np.ndarray, top: int) -> np.ndarray:
    """Rows of the `top` best of each item: highest score, then smallest doc_id, those without one last."""
    order = np.lexsort((doc, none, -score, item))
    own = item[order]
    begin = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    nth = np.arange(len(own)) - np.repeat(begin, np.diff(np.append(begin, len(own))))
    return order[nth < top]


def _scores(docs: DataFrame, terms: _Terms, weights, postings, items: int, documents: int, total: int, top: int) -> DataFrame:
    """item (its number), doc_id, score: the best of each item among the rows of each task.

    postings: of each term, where in (item, times) its items begin and end, and these.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, w = _matcher(terms), weights.value
        bounds, of_item, times = postings.value
        least, kept = np.zeros(items, np.int64), [np.zeros(0, np.int64)] * 4

        def add(rows: list[tuple[int, int, dict[int, int]]], ids: np.ndarray, none: np.ndarray) -> None:
            at = np.repeat(np.arange(len(rows)), [len(f) for _, _, f in rows])
            term = np.fromiter((t for _, _, f in rows for t in f), np.int64, len(at))
            tf = np.fromiter((c for _, _, f in rows for c in f.values()), np.int64, len(at))
            m = np.array([75 + 25 * n * documents // total for _, n, _ in rows], np.int64)
            part = w[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[at]))
            many = bounds[term + 1] - bounds[term]
            post = np.repeat(bounds[term] - np.cumsum(many) + many, many) + np.arange(many.sum())
            sums = np.zeros(len(rows) * items, np.int64)
            np.add.at(sums, np.repeat(at, many) * items + of_item[post], np.repeat(part, many) * times[post])
            sums = sums.reshape(len(rows), items)
            doc, item = np.nonzero((sums > 0) & (sums >= least))
            place = np.array([i for i, _, _ in rows])[doc]
            new = (sums[doc, item], item, ids[place], none[place])
            kept[:] = [np.concatenate(x) for x in zip(kept, new, strict=True)]
            if len(kept[0]) > 4 * top * items:
                shrink()

        def shrink() -> None:
            rows = _best(*kept, top)
            kept[:] = [x[rows] for x in kept]
            own, count = np.unique(kept[1], return_counts=True)
            last = np.cumsum(count) - 1
            least[own[count == top]] = kept[0][last[count == top]]

        step = max(1, HELD // items)
        for batch in batches:
            ids = batch.column("doc_id")
            none, ids = np.asarray(ids.is_null()).astype(np.int64), np.asarray(ids.fill_null(0))
            rows = []
            for row in _scanned(batch, machine):
                if row[2]:
                    rows.append(row)
                if len(rows) == step:
                    add(rows, ids, none)
                    rows = []
            if rows:
                add(rows, ids, none)
        if len(kept[0]):
            shrink()
            yield pa.RecordBatch.from_arrays([pa.array(kept[1], pa.int64()), pa.array(kept[2], pa.int64(), mask=kept[3] > 0), pa.array(kept[0], pa.int64())], ["item", "doc_id", "score"])

    return docs.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, top: int = 20, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents of each item, with a score above 0.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case; a null text has
    none. All documents are scanned whole for each automaton, which serves about item_bytes of item text; an item is never cut.
    Equal scores are ranked by doc_id, rows without one last; repeated rows are ranked each. Equal items count once;
    different texts under one item_id (null is one too) are one item with the terms of all. Empty tables give an empty
    result; columns but the ids and texts are left behind.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    asked = stored(items.select("item_id", text_of().alias("text")).distinct(), "items")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = max(1, -(-size // item_bytes))
    best = None
    for group in range(groups):
        mine = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == group).collect()
        wanted: dict[object, Counter] = {}
        for r in mine:
            wanted.setdefault(r["item_id"], Counter()).update(_terms(r["text"]))
        names = list(wanted)
        words = sorted({t for c in wanted.values() for t in c})
        if not words:
            continue
        number = {t: i for i, t in enumerate(words)}
        terms = _Terms(spark, words)
        documents, total, df = _corpus(texts, terms)
        if not total:
            break
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        posting = sorted((number[t], i, k) for i, name in enumerate(names) for t, k in wanted[name].items())
        term, item, times = (np.array(x, np.int64) for x in zip(*posting, strict=True))
        bounds = np.searchsorted(term, np.arange(len(words) + 1))
        send = spark.sparkContext.broadcast
        scored = _scores(texts, terms, send(weight), send((bounds, item, times)), len(names), documents, total, top)
        ids = spark.createDataFrame(list(enumerate(names)), f"item bigint, item_id {items.schema['item_id'].dataType.simpleString()}")
        scored = scored.join(F.broadcast(ids), "item").drop("item")
        best = scored if best is None else best.unionByName(scored)
    if best is None:
        return asked.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score"))
    by = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = best.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).withColumn("nth", F.row_number().over(W.partitionBy("item_id", "part").orderBy(*by))).filter(F.col("nth") <= top)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(*by))).filter(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_FIND = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = {
    "op13_lexical_search": f"""
WITH d AS (SELECT doc_id, {_FIND} AS t FROM documents),
q AS (SELECT item_id, unnest({_FIND}) AS term FROM benchmark),
qt AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
s AS (SELECT count(*) FILTER (len(t) > 0) AS docs, CAST(sum(len(t)) AS BIGINT) AS words FROM d),
e AS (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM e GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, s),
x AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // words))) AS x FROM tf, s),
r AS (SELECT item_id, doc_id, CAST(sum(times * w * x) AS BIGINT) AS score FROM qt JOIN w USING (term) JOIN x USING (term) GROUP BY ALL),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""
}
