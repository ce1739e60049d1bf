"""Media columns: MPEG transport streams in a binary column.

A payload becomes the elementary stream of a one-programme transport stream (ISO/IEC 13818-1): a program
association and a program map table, then one PES packet for each access unit, each with a time stamp, a
random-access flag and a clock reference. Reading parses the tables, checks every packet's continuity
counter, reassembles the PES packets and gives back the payload with its time stamps.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookweave.llm.common import small_batches, table, text_of

PACKET, BODY, SYNC = 188, 184, 0x47
#: Bytes of payload in one access unit, and ticks of the 90 kHz clock between two.
UNIT, TICKS = 64 * 192, 3600
PAT_PID, PMT_PID, STREAM_PID, PROGRAM, STREAM_TYPE, STREAM_ID = 0, 0x1000, 0x100, 1, 0x06, 0xBD

_CRC: list[int] = []


def crc32_mpeg(data: bytes) -> int:
    """The tables' checksum: polynomial 0x04C11DB7, most significant bit first, no final inversion."""
    if not _CRC:
        for i in range(256):
            c = i << 24
            for _ in range(8):
                c = (c << 1) ^ (0x04C11DB7 if c & 0x80000000 else 0)
            _CRC.append(c & 0xFFFFFFFF)
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC[(c >> 24) ^ b]
    return c


def _section(pid: int, table_id: int, number: int, body: bytes) -> bytes:
    """A packet with one whole section."""
    head = bytes([table_id, 0xB0 | (len(body) + 9) >> 8, (len(body) + 9) & 0xFF]) + number.to_bytes(2, "big") + b"\xc1\0\0"
    section = head + body
    section += crc32_mpeg(section).to_bytes(4, "big")
    return (bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10, 0]) + section).ljust(PACKET, b"\xff")


TABLES = _section(PAT_PID, 0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big")) + _section(
    PMT_PID, 2, PROGRAM, (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\0" + bytes([STREAM_TYPE]) + (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\0"
)


def _stamp(t: int) -> bytes:
    return bytes([0x21 | (t >> 29) & 0x0E, (t >> 22) & 0xFF, 1 | (t >> 14) & 0xFE, (t >> 7) & 0xFF, 1 | (t << 1) & 0xFE])


def mux(payload: bytes) -> bytes:
    """The transport stream of a payload."""
    out, count = [TABLES], 0
    for k, at in enumerate(range(0, len(payload), UNIT)):
        unit = payload[at : at + UNIT]
        time = k * TICKS
        pes = b"\0\0\1" + bytes([STREAM_ID]) + (len(unit) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(time) + unit
        # first packet: adaptation field with random access and clock; the last is stuffed by one
        field = b"\x50" + (time << 15 | 0x7E00).to_bytes(6, "big")
        room = BODY - 1 - len(field)
        if len(pes) < room:
            field = field.ljust(BODY - 1 - len(pes), b"\xff")
            room = len(pes)
        out.append(bytes([SYNC, 0x40 | STREAM_PID >> 8, STREAM_PID & 0xFF, 0x30 | count & 15, len(field)]) + field + pes[:room])
        count += 1
        rest = np.frombuffer(pes, np.uint8)[room:]
        full = len(rest) // BODY
        if full:
            packets = np.empty((full, PACKET), np.uint8)
            packets[:, 0], packets[:, 1], packets[:, 2] = SYNC, STREAM_PID >> 8, STREAM_PID & 0xFF
            packets[:, 3] = 0x10 | (count + np.arange(full)) & 15
            packets[:, 4:] = rest[: full * BODY].reshape(full, BODY)
            out.append(packets.tobytes())
            count += full
        if left := len(rest) - full * BODY:
            stuff = b"" if left == BODY - 1 else b"\0".ljust(BODY - 1 - left, b"\xff")
            out.append(bytes([SYNC, STREAM_PID >> 8, STREAM_PID & 0xFF, 0x30 | count & 15, len(stuff)]) + stuff + rest[full * BODY :].tobytes())
            count += 1
    return b"".join(out)


def _table(packet: np.ndarray, table_id: int) -> bytes:
    raw = packet.tobytes()
    start = 5 + raw[4] if not raw[3] & 0x20 else 5 + raw[4] + 1 + raw[5 + raw[4]]
    section = raw[start : start + 3 + ((raw[start + 1] & 0x0F) << 8 | raw[start + 2])]
    if section[0] != table_id or crc32_mpeg(section):
        raise ValueError("damaged program table")
    return section


def _first(packets: np.ndarray, which: np.ndarray, what: str) -> np.ndarray:
    if not which.any():
        raise ValueError(f"no {what}")
    return packets[which.argmax()]


def demux(stream: bytes) -> dict:
    """payload, stamps, random_access (offsets in the payload), packets and counter_errors of a transport stream.

    Raises ValueError where packets, tables or the programme are damaged or missing.
    """
    if not stream or len(stream) % PACKET:
        raise ValueError("not a whole number of transport packets")
    p = np.frombuffer(stream, np.uint8).reshape(-1, PACKET)
    if (p[:, 0] != SYNC).any():
        raise ValueError("lost synchronisation")
    pid = (p[:, 1] & 0x1F).astype(np.int32) << 8 | p[:, 2]
    first = (p[:, 1] & 0x40) != 0
    pat = _table(_first(p, (pid == PAT_PID) & first, "program association table"), 0)
    programs = {int.from_bytes(pat[i : i + 2], "big"): int.from_bytes(pat[i + 2 : i + 4], "big") & 0x1FFF for i in range(8, len(pat) - 4, 4)}
    if PROGRAM not in programs:
        raise ValueError(f"no programme {PROGRAM}")
    pmt = _table(_first(p, (pid == programs[PROGRAM]) & first, "program map table"), 2)
    i = 12 + ((pmt[10] & 0x0F) << 8 | pmt[11])
    es = (pmt[i + 1] & 0x1F) << 8 | pmt[i + 2]
    p, first = p[pid == es], first[pid == es]
    has_field, has_body = (p[:, 3] & 0x20) != 0, (p[:, 3] & 0x10) != 0
    counter = p[has_body, 3] & 15
    errors = int(np.count_nonzero((counter[1:] - counter[:-1]) % 16 != 1))
    start = np.where(has_field, 5 + p[:, 4].astype(np.int32), 4)
    start[~has_body] = PACKET
    sizes = PACKET - start
    data = p[np.arange(PACKET) >= start[:, None]].tobytes()
    ends = np.cumsum(sizes)
    begins = (ends - sizes)[first].tolist()
    access = (has_field & (p[:, 4] > 0) & ((p[:, 5] & 0x40) != 0))[first].tolist()
    parts, stamps, points, at = [], [], [], 0
    for b, e, a in zip(begins, [*begins[1:], len(data)], access, strict=True):
        if data[b : b + 3] != b"\0\0\1":
            raise ValueError("not a PES packet")
        if data[b + 7] & 0x80:
            x = data[b + 9 : b + 14]
            stamps.append((x[0] & 0x0E) << 29 | x[1] << 22 | (x[2] & 0xFE) << 14 | x[3] << 7 | x[4] >> 1)
        if a:
            points.append(at)
        parts.append(data[b + 9 + data[b + 8] : min(e, b + 6 + (data[b + 4] << 8 | data[b + 5]))])
        at += len(parts[-1])
    return {"payload": b"".join(parts), "stamps": stamps, "random_access": points, "packets": len(p), "counter_errors": errors}


def padded(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b" " * (-len(raw) % 192 or 192 * (not raw))


def with_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each row's text, padded with spaces to a positive multiple of 192 bytes, as a transport stream.

    A null text is an empty one. A text is taken whole, however long; equal texts, repeated rows among them, give
    equal streams, each row its own. Other columns are left behind. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession, 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [padded(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([n for n, _ in made], pa.int64()), pa.array([mux(x) for _, x in made], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id bigint, n_bytes bigint, media binary")


def media_features(media: DataFrame) -> DataFrame:
    """What the stored streams hold: sizes and digests of payload and stream, and a line of features. Damaged streams raise."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for stream in b.column("media").to_pylist():
                x = demux(stream)
                body, s = x["payload"], x["stamps"]
                points = x["random_access"]
                feature = f"units={len(s)};packets={x['packets']};first={s[0] if s else ''};last={s[-1] if s else ''};random_access={len(points)};last_point={points[-1] if points else ''};counter_errors={x['counter_errors']}"
                rows.append((len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-16:]), len(stream), hashlib.sha256(stream).hexdigest(), feature))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names)

    return media.mapInArrow(run, "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(with_media(table(spark, sf_dir, "documents")))
