"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from bookweave.llm import decontaminate, jaccard, language, line_dedup, packing, secrets, sharding, surrogates, transport, warc

LONG = "word " * 40_000 + "\n" + "x" * 100_000
ROWS = [(1, None), (2, ""), (3, "   \n\t "), (4, LONG), (5, "same text here\nsecond line\nthird line"), (5, "same text here\nsecond line\nthird line"), (6, "same text here\nsecond line\nthird line"), (None, "no id\nat all\nin this row"), (7, "123 !?"), (8, "café 日本 token = abcdefgh1")]
EXTRA = "doc_id long, text string, lang string, shard int, size string, key string, a int, b int, n int, kind string, bucket int, seed int, length int, spans string, media int, lines_removed string, th int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en" if d != 2 else None, 1, "x", "k", 1, 1, 1, "z", 1, 1, 1, "s", 1, "r", 1) for d, t in ROWS]
    return spark.createDataFrame(rows, EXTRA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], EXTRA)


def test_sharding(docs, nothing):
    rows = sharding.shard_records(docs, shards=4, bucket_bytes=500).collect()
    assert len(rows) == len(ROWS)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sorted((r.doc_id or -1, r.text or "") for r in rows) == sorted((d or -1, t or "") for d, t in ROWS)
    assert sharding.shard_records(nothing).count() == 0


def test_shard_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = sharding.op2_sharding(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        t = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(t) + 16, zlib.crc32(t), "rows", None)


def test_shards_are_mixed_and_written(spark, tmp_path):
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    out = sharding.shard_records(docs, shards=7, bucket_bytes=4096)
    sharding.write_shards(out, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 2000 and back.select("shard").distinct().count() == 7
    order = [r.doc_id for r in back.filter("shard = 0").orderBy("slot").collect()]
    assert order != sorted(order)


def test_line_dedup(docs, nothing):
    rows = line_dedup.dedup_lines(docs).collect()
    assert len(rows) == len(ROWS) and rows[0].asDict().keys() == {*docs.columns}
    got = sorted(((r.doc_id or -1), r.text, r.lines_removed) for r in rows if r.doc_id in (5, 6))
    five = "same text here\nsecond line\nthird line"
    assert got == [(5, five, 0), (5, five, 0), (6, "", 3)]
    assert {r.doc_id: r.text for r in rows}[4] == LONG and {r.doc_id: r.text for r in rows}[1] is None
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_line_dedup_of_texts_without_id(spark):
    """Texts without an id, and several under one, are documents of their own; repeated rows are no repeats of each other."""
    rows = [(None, "a\nb\nc\nx"), (None, "a\nb\nc\ny"), (None, "a\nb\nc\ny"), (3, "a\nb\nc"), (4, "k\nl\nm\n1"), (4, "k\nl\nm\n2")]
    got = [(r.doc_id, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(got) == 6 and (3, "") in got
    without = sorted(t for d, t in got if d is None)
    assert without in (["a\nb\nc\nx", "y", "y"], ["a\nb\nc\ny", "a\nb\nc\ny", "x"])
    assert sorted(t for d, t in got if d == 4) in (["1", "k\nl\nm\n2"], ["2", "k\nl\nm\n1"])


def test_archive(spark, tmp_path):
    """Pages that are null, empty, very long or repeated, with clashing columns, and no pages."""
    long = "x" * 3_000_000
    rows = [(1, "http://a", None), (2, None, ""), (3, "http://b", long), (4, "http://c", long), (4, "http://c", long), (None, "http://d", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("c") for c in ("digest", "payload", "type", "d", "kept", "n")})
    warc.archive(pages, str(tmp_path / "w"))
    got = sorted((r.record_id, r.type, r.http_length) for r in warc.read_archive(spark, str(tmp_path / "w")).collect())
    assert got == sorted([("<urn:page:1>", "response", 0), ("<urn:page:2>", "response", 0), ("<urn:page:3>", "revisit", 3_000_000), ("<urn:page:4>", "response", 3_000_000), ("<urn:page:4>", "response", 3_000_000), ("<urn:page:>", "response", 5)])
    warc.archive(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).count() == 0


def test_damaged_streams():
    stream = transport.mux(b"x" * 5000)
    for wrong in (stream[188:], stream[:188] + stream[376:], b"", stream[:-1]):
        with pytest.raises(ValueError):
            transport.demux(wrong)


def test_line_windows_overlap(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc\nd\ne"), (2, "x\nb\nc\nd\ne\ny"), (3, "a\nb"), (4, "q\nq\nq\nq")], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.lines_removed) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: ("a\nb\nc\nd\ne", 0), 2: ("x\ny", 4), 3: ("a\nb", 0), 4: ("q", 3)}


def test_jaccard(docs, nothing):
    rows = jaccard.near_duplicates(docs, 4, 85).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(ROWS)
    assert [got[i].n_shingles for i in (1, 2, 3)] == [0, 0, 0] and all(got[i].component_id == i for i in (1, 2, 3, 4, 7))
    assert got[5].component_id == got[6].component_id == 5 and got[None].component_id is None
    assert jaccard.near_duplicates(nothing).count() == 0
    kept = jaccard.one_of_each(docs).collect()
    assert sorted(r.doc_id or -1 for r in kept) == [-1, 1, 2, 3, 4, 5, 7, 8]


def test_contaminated(spark, docs, nothing):
    words = [f"w{i}" for i in range(30)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, ""), (4, "too short"), (1, " ".join(words))], "item_id long, text string")
    changed = [w if i % 6 else "zz" for i, w in enumerate(words)]
    more = spark.createDataFrame([(20, "pre " + " ".join(words) + " post"), (21, " ".join(changed)), (22, " ".join(reversed(words))), (23, " ".join(words[:8])), (20, "pre " + " ".join(words) + " post")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs.select("doc_id", "text").union(more), bench).collect()}
    assert got == {(20, 1), (21, 1)}
    kept = decontaminate.decontaminate(docs.select("doc_id", "text").union(more).union(spark.createDataFrame([(None, " ".join(words)), (1, " ".join(words))], "doc_id long, text string")), bench)
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted([d or -1 for d, _ in ROWS] + [22, 23])
    assert decontaminate.contaminated(nothing, bench).count() == 0 and decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.decontaminate(docs, bench).count() == len(ROWS)


def test_language(docs, nothing):
    rows = language.predict(docs).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(ROWS) and all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 7)) and got[5].lang_pred == "en"
    assert language.predict(nothing).count() == 0
    assert {r.doc_id for r in language.in_a_language(docs).collect()} >= {4, 5, 6}


def test_short_texts_are_in_a_language(spark):
    """Too short to be told from random letters; long random ones go."""
    learnt = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    short = ["Re.", "A.", "De.", "Erö.", "Edrere.", "A.\nAll rights reserved."]
    rng = random.Random(4)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300)), "123"]
    more = spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate(short + noise)], learnt.schema)
    kept = {r.doc_id - 10**9 for r in language.in_a_language(learnt.union(more)).filter(f"doc_id >= {10**9}").collect()}
    assert kept == set(range(len(short)))


def test_packing(docs, nothing):
    rows = packing.pack_documents(docs).collect()
    seats = {}
    for r in rows:
        seats.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seats.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    assert {r.doc_id: r.length for r in rows if r.doc_id in (1, 2)} == {1: 1, 2: 1}
    long = sorted((r.piece, r.start, r.length) for r in rows if r.doc_id == 4)
    assert all(n == 2048 for _, _, n in long[1:]) and long[0][1] == 0 and all(a[1] + a[2] == b[1] for a, b in zip(long, long[1:]))
    assert len([r for r in rows if r.doc_id == 5]) == 2
    assert packing.pack_documents(nothing).count() == 0


def test_media(docs, nothing):
    rows = transport.media_features(transport.with_media(docs)).collect()
    assert len(rows) == len(ROWS)
    for r, (d, t) in zip(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_bytes)), sorted(ROWS, key=lambda x: (x[0] is None, x[0] or 0, len((x[1] or "").encode()))), strict=True):
        n, body = transport.padded(t)
        assert (r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (d, n, len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-16:]))
        assert r.media_bytes % 188 == 0 and r.feature.endswith("counter_errors=0")
    assert transport.media_features(transport.with_media(nothing)).count() == 0


def test_secrets(docs, nothing):
    rows = secrets.secret_report(docs).collect()
    assert len(rows) == len(ROWS)
    got = {r.doc_id: r for r in rows}
    assert got[8].spans == "assign:8:25" and got[1].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secrets.secret_report(nothing).count() == 0


def test_surrogates(docs, nothing):
    rows = surrogates.replace_pii(docs).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in rows) == sorted((d or -1, t or "") for d, t in ROWS)
    assert surrogates.replace_pii(nothing).count() == 0


def test_pipeline_stages(spark, docs, nothing):
    """Every stage on nulls, empty and very long texts, repeated rows and ids, clashing columns, and an empty table."""
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    wide = docs.unionByName(docs.sparkSession.createDataFrame([(5, "quite another text under the same id, of some length", "en", 1, "x", "k", 1, 1, 1, "z", 1, 1, 1, "s", 1, "r", 1)], docs.schema))
    more = {c: F.lit("c") for c in ("doc", "c", "t", "rep", "label", "component", "d", "th", "at", "n_chars2", "draw", "lot", "part", "first")}
    wide = wide.withColumns(more)
    ids = lambda df: sorted((r.doc_id or -1, r.text or "") for r in df.collect())
    rows = ids(wide)
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, wide, sf)
        assert out.columns == [c for c in wide.columns if c != "lines_removed" or name != "line_dedup"], name
        got = ids(out)
        assert stage(spark, wide.limit(0), sf).count() == 0, name
        if name == "line_dedup":
            assert {d for d, _ in got} == {d for d, _ in rows} - {6}
        elif name == "language":
            assert {d for d, _ in got} == {-1, 4, 5, 6, 8} and all(x in rows for x in got)
        elif name == "near_duplicates":
            assert got == sorted(set(rows) - {(6, ROWS[4][1])})
        else:
            assert got == rows
    packed = p.pack(spark, wide, sf).collect()
    assert {r.doc_id for r in packed} == {d for d, _ in ROWS} and p.pack(spark, wide.limit(0), sf).count() == 0
