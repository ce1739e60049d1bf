"""A Spark data source for WARC archives, read and written.

Reading plans partitions over files, takes equality, set and prefix conditions on record headers (and
record types) down to the parser, parses a record's headers before anything else, and skips records that
are not wanted without inflating their payload where the member says how long it is. A schema without
``payload`` leaves payloads undecoded. Writing makes one gzip member per record in one file per task; a
manifest written on commit names the files that count, so that failed or repeated tasks leave nothing behind.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage

from bookweave.llm.common import new_path, small_batches, stored, table, text_of

SCHEMA = "record_id string, type string, target_uri string, date string, payload_digest string, refers_to string, http_length bigint, payload binary"
#: Columns that are record headers.
HEADERS = {"record_id": "WARC-Record-ID", "type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
BATCH_BYTES = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _fs(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9+]+:/", path) else (pyarrow.fs.LocalFileSystem(), path)


def _head(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


@dataclass
class FilePart(InputPartition):
    files: list[str] = field(default_factory=list)


class _Input:
    """Records of one archive: (headers, function that gives the block), one after another."""

    def __init__(self, f, size: int):
        self.f, self.size = f, size

    def _member(self, at: int) -> tuple[bytes, int | None]:
        """Start of the gzip member at `at`, and its length if its extra field has it."""
        start = self.f.read_at(2048, at)
        if len(start) > 20 and start[3] & 4 and start[12:14] == b"SL":
            return start, int.from_bytes(start[16:20], "little")
        return start, None

    def gzipped(self) -> Iterator[tuple[dict, object]]:
        at = 0
        while at < self.size:
            start, length = self._member(at)
            inflate = zlib.decompressobj(31)
            got, read = inflate.decompress(start), at + len(start)
            while b"\r\n\r\n" not in got and not inflate.eof and read < self.size:
                more = self.f.read_at(1 << 16, read)
                got, read = got + inflate.decompress(more), read + len(more)
            head, _, rest = got.partition(b"\r\n\r\n")
            headers = _head(head)

            def block(inflate=inflate, rest=rest, read=read, headers=headers, at=at, length=length):
                parts = [rest]
                while not inflate.eof and read < self.size:
                    more = self.f.read_at(max(1 << 16, (at + length - read) if length else 0), read)
                    parts.append(inflate.decompress(more))
                    read += len(more)
                return b"".join(parts)[: int(headers.get("content-length", 0))], read - len(inflate.unused_data)

            if length:
                yield headers, lambda b=block: b()[0]
                at += length
            else:
                whole, at = block()
                yield headers, lambda w=whole: w

    def plain(self) -> Iterator[tuple[dict, object]]:
        at = 0
        while at < self.size:
            got = b""
            while b"\r\n\r\n" not in got and at + len(got) < self.size:
                got += self.f.read_at(8192, at + len(got))
            head, _, _ = got.partition(b"\r\n\r\n")
            if not head.strip():
                return
            headers, n = _head(head), len(head) + 4
            length = int(headers.get("content-length", 0))
            yield headers, lambda a=at + n, k=length: self.f.read_at(k, a)
            at += n + length + 4


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema, self.options, self.wanted = schema, options, []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.wanted.append((name, "in", (f.value,)))
            elif name in HEADERS and isinstance(f, In):
                self.wanted.append((name, "in", tuple(f.value)))
            elif name in HEADERS and isinstance(f, StringStartsWith):
                self.wanted.append((name, "starts", f.value))
            else:
                yield f

    def partitions(self) -> list[FilePart]:
        fs, root = _fs(self.options["path"])
        infos = [i for i in fs.get_file_info(pyarrow.fs.FileSelector(root)) if i.is_file]
        manifests = [i for i in infos if re.match(r"_manifest-.*\.json$", i.base_name)]
        if manifests:
            named = {x for m in manifests for x in json.loads(fs.open_input_stream(m.path).read())}
            infos = [i for i in infos if i.base_name in named]
        files = sorted((i.path, i.size) for i in infos if re.search(r"\.warc(\.gz)?$", i.base_name) and i.size)
        most, parts, room = int(self.options.get("partitionbytes", 32 << 20)), [], 0
        for path, size in files:
            if room < size or not parts:
                parts.append(FilePart(None))
                parts[-1].files, room = [], most
            parts[-1].files.append(path)
            room -= size
        return parts or [FilePart(None)]

    def _keeps(self, headers: dict) -> bool:
        for name, how, value in self.wanted:
            x = headers.get(HEADERS[name].lower())
            if x is None or (x not in value if how == "in" else not x.startswith(value)):
                return False
        return True

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        fs, _ = _fs(self.options["path"])
        names = schema.names
        blocks = "payload" in names or "http_length" in names
        rows: list[dict] = []
        held = 0
        for path in partition.files or []:
            with fs.open_input_file(path) as f:
                records = _Input(f, f.size())
                for headers, block in records.gzipped() if path.endswith(".gz") else records.plain():
                    if not self._keeps(headers):
                        continue
                    row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
                    if blocks:
                        body = block()
                        if headers.get("content-type", "").startswith("application/http"):
                            head, _, body = body.partition(b"\r\n\r\n")
                            n = _head(head).get("content-length")
                            row["http_length"] = int(n) if n and n.isdigit() else None
                        row["payload"] = None if row["type"] == "revisit" else body
                        held += len(body)
                    rows.append(row)
                    if held > BATCH_BYTES or len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist([{c: r.get(c) for c in names} for r in rows], schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([{c: r.get(c) for c in names} for r in rows], schema)


@dataclass
class Written(WriterCommitMessage):
    file: str | None


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.date, self.level = options["path"], options.get("date", "1970-01-01T00:00:00Z"), int(options.get("level", 1))

    def _record(self, row: dict) -> bytes:
        payload, revisit = row["payload"], row["type"] == "revisit"
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['http_length']}\r\n\r\n".encode()
        block = http + (b"" if revisit else payload or b"")
        lines = [("WARC-Type", row["type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", self.date), ("WARC-Target-URI", row["target_uri"]), ("WARC-Payload-Digest", row["payload_digest"])]
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", row["refers_to"])] if revisit else []
        lines += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
        clean = lambda v: "".join(c if c >= " " else f"%{ord(c):02X}" for c in v)
        head = "WARC/1.1\r\n" + "".join(f"{k}: {clean(v)}\r\n" for k, v in lines if v is not None) + "\r\n"
        raw = head.encode("utf-8", "replace") + block + b"\r\n\r\n"
        squeeze = zlib.compressobj(self.level, zlib.DEFLATED, -15)
        body = squeeze.compress(raw) + squeeze.flush()
        tail = zlib.crc32(raw).to_bytes(4, "little") + (len(raw) & 0xFFFFFFFF).to_bytes(4, "little")
        size = 20 + len(body) + 8
        return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x08\0SL\x04\0" + size.to_bytes(4, "little") + body + tail

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _fs(self.path)
        fs.create_dir(root, recursive=True)
        name, out = f"part-{uuid.uuid4().hex}.warc.gz", None
        for b in iterator:
            for row in b.to_pylist():
                out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
                out.write(self._record(row))
        if out:
            out.close()
        return Written(name if out else None)

    def commit(self, messages) -> None:
        fs, root = _fs(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps([m.file for m in messages if m and m.file]).encode())

    def abort(self, messages) -> None:
        fs, root = _fs(self.path)
        for m in messages:
            if m and m.file:
                fs.delete_file(f"{root}/{m.file}")


class WarcSource(DataSource):
    """format("warc"): options path, partitionBytes (reading), date and level (writing)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """A row of the source's schema per page, in UTF-8; a null html is empty.

    Of pages with equal payloads of at least `least` bytes, the one with the largest page_id is the
    response and the others revisit it; rows that repeat that page_id, and rows without one, are responses.
    A page is taken whole, however long (Spark's limit of 2 GB for a value keeps its member below the 4 GB that
    its length field can tell). Other columns are left behind. An empty table gives an empty result.
    """
    payload = F.encode(text_of("html"), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("http_length", F.octet_length("payload").cast("bigint")).withColumn("digest", F.sha1("payload"))
    groups = rows.filter(F.col("http_length") >= least).groupBy(F.col("digest").alias("d"))
    kept = groups.agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).filter("n > 1").select("d", "kept")
    # written, so that the join stands on two plain exchanges and Spark can split the partition of a very common payload
    joined = rows.join(stored(kept, "payloads"), (F.col("digest") == F.col("d")) & (F.col("http_length") >= least), "left")
    again = F.coalesce(F.col("page_id") < F.col("kept"), F.lit(False))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    return joined.select(
        urn("page_id").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("type"), F.col("url").alias("target_uri"),
        F.lit(None).cast("string").alias("date"), F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.when(again, urn("kept")).alias("refers_to"), "http_length", F.when(~again, F.col("payload")).alias("payload"),
    )


def archive(pages: DataFrame, path: str) -> None:
    spark = pages.sparkSession
    register(spark)
    small_batches(spark)
    page_records(pages).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    register(spark)
    return spark.read.format("warc").schema(schema).load(path)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    archive(table(spark, sf_dir, "pages"), path)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")
    r = read_archive(spark, path)
    return r.select(
        page("record_id").alias("page_id"),
        F.when(F.col("type") == "revisit", F.col("http_length")).otherwise(F.octet_length("payload")).cast("bigint").alias("payload_bytes"),
        F.when(F.col("type") == "revisit", F.regexp_extract("payload_digest", "^sha1:(.*)$", 1)).otherwise(F.sha1("payload")).alias("payload_digest"),
        F.col("type").alias("record_type"), page("refers_to").alias("refers_to"), F.col("target_uri").alias("url"),
    )


ORACLE = {
    "op1_warc": """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, url, CAST(strlen(h) AS BIGINT) AS n, sha1(h) AS d FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS last FROM q)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to, url FROM r
"""
}
