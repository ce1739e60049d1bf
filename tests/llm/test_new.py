"""Exact copies, collocations and lexical search against plain Python, with edge cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bookweave.llm import collocations, exact, lexical

A = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(A, A.lower())
LONG = "Word " * 40_000 + "\n" + "x" * 100_000
EXTRA = ("n", "key", "sha", "last", "place", "owner", "bucket", "part", "f", "phrase", "w1", "rank", "score", "item", "term")


def frame(spark, rows, lang=True):
    return spark.createDataFrame(rows, "doc_id long, text string" + ", lang string" * lang).withColumns({c: F.lit(1) for c in EXTRA})


ROWS = [
    (1, None, "en"), (2, "", None), (3, " \n\t ", "en"), (4, LONG, "de"), (5, "Ärger IST groß", "de"), (6, "Ärger ist groß", "de"), (7, "ärger ist groß", "de"),
    (8, "same", "en"), (8, "same", "en"), (None, "same", None), (None, "alone", None), (None, "twice", "en"), (None, "Twice", "en"), (9, "123 !?", "fr"),
]


@pytest.mark.parametrize(("bits", "size"), [(64, 1 << 20), (2, 1), (64, 1), (0, 40)])
def test_exact_groups(spark, bits, size):
    """Keys that collide, buckets that never fit: bytes decide. Copies with and without ids, ties, other columns."""
    rng = random.Random(bits)
    words = ["alpha", "Alpha", "beta", "Gamma delta", "gamma delta", "É", "é"]
    rows = ROWS + [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))), "en") for i in range(300)]
    got = exact.exact_groups(frame(spark, rows), bucket_bytes=size, key_bits=bits).collect()
    assert len(got) == len(rows) and list(got[0].asDict()) == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    groups = defaultdict(list)
    for d, t, _ in rows:
        groups[(t or "").translate(LOWER)].append(d)
    want = Counter()
    for t, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        left = 1
        for d in ids:
            kept = d == keep and left == 1
            left -= kept
            want[d, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter(map(tuple, got)) == want


def test_exact_groups_of_nothing(spark):
    assert exact.exact_groups(frame(spark, [])).collect() == []


def test_directory_splits_until_buckets_fit(spark):
    """Every bucket fits or is one key; buckets are ranges of keys that don't overlap, and no key is lost."""
    rng = random.Random(4)
    keys = sorted({rng.randrange(-(2**63), 2**63) for _ in range(500)} | {rng.randrange(1 << 20) for _ in range(100)} | {-1, 0})
    placed, _ = exact.directory(spark.createDataFrame([(k, 10 if k else 5000) for k in keys], "key long, bytes long"), 200)
    rows = placed.collect()
    assert sorted(r.key for r in rows) == keys
    by = defaultdict(list)
    for r in rows:
        assert (r.key % 2**64) >> (64 - r.depth) == (r.bucket if r.depth else 0)
        by[r.bucket, r.depth].append(r.key)
    assert all(len(x) == 1 or 10 * len(x) <= 200 for x in by.values())
    ends = sorted(((b << (64 - d), (b + 1) << (64 - d)) for b, d in by))
    assert all(x[1] <= y[0] for x, y in zip(ends, ends[1:]))


def plain_collocations(rows, least, inside, best):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in f.items():
        rows = []
        for p, a in c.items():
            if len(p) == 1 or a < least:
                continue
            if any(100 * b >= inside * a and b >= least for q, b in c.items() if len(q) > len(p) and p in (q[:2], q[1:])):
                continue
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:best], 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, monkeypatch, small):
    """All phrases counted plainly; with few bits and small batches nothing is lost either."""
    if small:
        monkeypatch.setattr(collocations, "BITS", 15)
        monkeypatch.setattr(collocations, "COUNTED_BYTES", 50)
    rng = random.Random(7)
    words = ["of", "the", "The", "new", "york", "a b", "zürich", "ÄB", "x"] + [f"w{i}" for i in range(30)]
    end = [" ", " ", "  ", "\t", " ", ". ", ",", "\n", "!", " \r\n"]
    rows = ROWS + [(50 + i, "".join((rng.choice(words[:9]) if rng.random() < 0.6 else rng.choice(words)) + rng.choice(end) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None])) for i in range(200)]
    rows += [(900, "new york city. " * 12, "en"), (901, "no no no no no no no no no no no no no", "und")]
    for least, inside, best in ((10, 50, 2000), (3, 90, 7)):
        got = sorted(tuple(r) for r in collocations.collocations(frame(spark, rows), least, inside, best).collect())
        assert got == plain_collocations(rows, least, inside, best)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(frame(spark, [])).collect() == []
    assert collocations.collocations(frame(spark, [(1, None, "en"), (2, " , ", None)])).collect() == []


def test_large_counts(spark):
    """Products beyond 64 bits are exact."""
    a, x, y = 3_000_000_019, 7_000_000_001, 9_000_000_011
    row = spark.createDataFrame([(a, x, y)], "f long, x long, y long").select(collocations._score(F.col("x"), F.col("y")).alias("s")).first()
    assert row.s == 10**6 * a * a // (x * y)


def plain_search(rows, items, top):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    docs = [(d, Counter(find(t))) for d, t, *_ in rows]
    n = [sum(c.values()) for _, c in docs]
    some, total = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(Counter)
    for i, t in dict.fromkeys((i, t or "") for i, t in items):
        asked[i].update(find(t))
    out = []
    for i, q in asked.items():
        scored = []
        for (d, c), own in zip(docs, n):
            s = sum(k * math.floor(1000 * math.log((2 * some + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * (75 + 25 * own * some // total))) for t, k in q.items() if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)]
    return Counter(out)


@pytest.mark.parametrize(("item_bytes", "held"), [(8 << 20, 1 << 20), (60, 1 << 20), (8 << 20, 20)])
def test_search(spark, monkeypatch, item_bytes, held):
    """Every document scored plainly; several automata, and small chunks, give the same. Terms at edges, side by side and inside others."""
    monkeypatch.setattr(lexical, "HELD", held)
    rng = random.Random(2)
    words = ["the", "The", "then", "he", "straße", "ÉCOLE", "école", "x1", "日本", "a", "b", "zz"]
    rows = ROWS + [(rng.randrange(60), "".join(rng.choice(words) + rng.choice(" -\n\x00_") for _ in range(rng.randrange(40))), "en") for i in range(150)]
    items = [(1, "the école"), (1, "the école"), (2, "The THE x1 zz"), (3, None), (4, "nowhere"), (None, "same a b"), (5, "日本-straße"), (5, "twice"), (6, "he " * 30 + "word")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in EXTRA})
    for top in (3, 20):
        got = lexical.search(frame(spark, rows), asked, top, item_bytes).collect()
        assert Counter(map(tuple, got)) == plain_search(rows, items, top)


def test_search_of_nothing(spark):
    asked = spark.createDataFrame([(1, "the")], "item_id long, text string")
    for docs, items in ((frame(spark, []), asked), (frame(spark, ROWS), asked.limit(0)), (frame(spark, [(1, None, "en"), (2, "?!", "en")]), asked)):
        out = lexical.search(docs, items)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.collect() == []


def test_phrases_are_counted_over_little_text(spark):
    """A worker holds at most two counts' worth of text, however large a batch Spark would send."""
    from bookweave.llm import collocations

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, str(64 << 20))
    docs = spark.createDataFrame([(i, "one two three, one two", "en") for i in range(20)], "doc_id bigint, text string, lang string")
    assert [(r.phrase, r.a) for r in collocations.collocations(docs).collect()] == [("one two three", 20)]
    assert int(spark.conf.get(key)) <= 1 << 20 and collocations.COUNTED_BYTES <= 1 << 20


def test_near_duplicates_free_what_the_language_stage_kept():
    """A worker lives on from stage to stage; the model of the first would be held through all that follow."""
    import pyarrow as pa

    from bookweave.llm import common, jaccard, language

    class Docs:
        def mapInArrow(self, run, _):
            return run

    texts = {k: " ".join(f"{k}{i * i % 89} word{i % 7}" for i in range(300)) for k in ("a", "b")}
    assert language.Model.of(texts) is language.Model.of(dict(texts)) and len(common._KEPT) == 1
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["some words of a text and more"], "t": [1]})
    assert sum(b.num_rows for b in jaccard._described(Docs(), 3, 16)(iter([batch]))) > 1
    assert not common._KEPT
