"""Media columns: text payloads in MPEG transport streams, written and read back.

``mux`` lays a payload out as a single-program transport stream of 188-byte packets: program association and map
tables before every group of access units, one elementary stream of private data in PES packets with presentation
timestamps, a clock reference at each access unit and the random-access flag at the first unit of a group.
``demux`` parses such a stream: program tables (with their checksums), continuity counters, adaptation fields,
PES reassembly, timestamps and random-access points; and returns the payload.

The unit of the format is the byte, so storage is lossless.  Each row is handled by itself where it is read: no
shuffle, memory bounded by a few rows.  Edge cases: null or empty text is 64 zero bytes; equal texts give equal
rows; an empty table gives no rows; input columns other than id and text are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
# Fixed values of the format, ISO/IEC 13818-1.
PACKET, SYNC, PAT_PID, STREAM_PRIVATE_PES, PRIVATE_STREAM_1, CLOCK = 188, 0x47, 0, 0x06, 0xBD, 90_000
#: Choices of this writer: PIDs, packets an access unit, units a group, clock ticks a unit.
PMT_PID, ES_PID, UNIT_PACKETS, GROUP_UNITS, UNIT_TICKS = 0x1000, 0x100, 16, 8, 3600
#: Bytes before the data in a unit's first packet: packet header, adaptation field with clock, PES header.
ADAPTATION, PES_HEADER = 8, 14
FIRST = PACKET - 4 - ADAPTATION - PES_HEADER
UNIT = FIRST + (UNIT_PACKETS - 1) * (PACKET - 4)


class Stream(NamedTuple):
    payload: bytes
    timestamps: list[int]
    random_access: list[int]  # indices of units
    packets: int
    continuity_errors: int
    stream_type: int


@lru_cache(1)
def crc_table() -> list[int]:
    table = []
    for n in range(256):
        c = n << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        table.append(c)
    return table


def crc32_mpeg(data: bytes) -> int:
    c, table = 0xFFFFFFFF, crc_table()
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ table[c >> 24 ^ b]
    return c


@lru_cache(64)
def table_packet(pid: int, counter: int) -> bytes:
    """The program association or map table in a packet of its own."""
    body = struct.pack(">HH", 1, 0xE000 | PMT_PID) if pid == PAT_PID else struct.pack(">HHBHH", 0xE000 | ES_PID, 0xF000, STREAM_PRIVATE_PES, 0xE000 | ES_PID, 0xF000)
    section = struct.pack(">BHHBBB", 0 if pid == PAT_PID else 2, 0xB000 | 5 + len(body) + 4, 1, 0xC1, 0, 0) + body
    section += struct.pack(">I", crc32_mpeg(section))
    return (struct.pack(">BHB", SYNC, 0x4000 | pid, 0x10 | counter) + b"\0" + section).ljust(PACKET, b"\xff")


def clock_field(ticks: int, random: bool) -> bytes:
    """Adaptation field with a program clock reference, eight bytes with its length."""
    return struct.pack(">BBIH", ADAPTATION - 1, 0x40 * random | 0x10, ticks >> 1 & 0xFFFFFFFF, (ticks & 1) << 15 | 0x7E00)


def pes_header(n: int, ticks: int) -> bytes:
    stamp = struct.pack(">BHH", 0x21 | ticks >> 29 & 0x0E, ticks >> 14 & 0xFFFE | 1, ticks << 1 & 0xFFFE | 1)
    return struct.pack(">IHBBB", 0x100 | PRIVATE_STREAM_1, n + 8, 0x80, 0x80, 5) + stamp


def mux(payload: bytes) -> bytes:
    units = -(-len(payload) // UNIT)
    out, counter = [], 0
    for u in range(units):
        if u % GROUP_UNITS == 0:
            tables = u // GROUP_UNITS & 15
            out += [table_packet(PAT_PID, tables), table_packet(PMT_PID, tables)]
        data, ticks = payload[u * UNIT : (u + 1) * UNIT], u * UNIT_TICKS
        clock, header = clock_field(ticks, u % GROUP_UNITS == 0), pes_header(len(data), ticks)
        if short := max(0, FIRST - len(data)):
            clock = bytes([clock[0] + short]) + clock[1:] + b"\xff" * short
        out.append(struct.pack(">BHB", SYNC, 0x4000 | ES_PID, 0x30 | counter) + clock + header + data[:FIRST])
        counter = counter + 1 & 15
        rest = data[FIRST:]
        full = len(rest) // (PACKET - 4)
        if full:
            block = np.empty((full, PACKET), np.uint8)
            block[:, :3] = (SYNC, ES_PID >> 8, ES_PID & 255)
            block[:, 3] = 0x10 | (counter + np.arange(full) & 15)
            block[:, 4:] = np.frombuffer(rest, np.uint8, full * (PACKET - 4)).reshape(full, -1)
            out.append(block.tobytes())
            counter = counter + full & 15
        if tail := rest[full * (PACKET - 4) :]:
            stuffing = PACKET - 5 - len(tail)
            out.append(struct.pack(">BHBB", SYNC, ES_PID, 0x30 | counter, stuffing) + (b"\0" + b"\xff" * (stuffing - 1) if stuffing else b"") + tail)
            counter = counter + 1 & 15
    return b"".join(out)


def section_of(packet: np.ndarray) -> bytes:
    """The table section that starts in this packet, its checksum verified."""
    raw = packet.tobytes()
    at = 4 + (1 + raw[4] if raw[3] & 0x20 else 0)
    at += 1 + raw[at]
    section = raw[at : at + 3 + (struct.unpack_from(">H", raw, at + 1)[0] & 0xFFF)]
    if crc32_mpeg(section):
        raise ValueError("checksum of a program table")
    return section


def demux(media: bytes) -> Stream:
    if len(media) % PACKET:
        raise ValueError("not a whole number of packets")
    p = np.frombuffer(media, np.uint8).reshape(-1, PACKET)
    if not (p[:, 0] == SYNC).all():
        raise ValueError("lost synchronisation")
    pid = (p[:, 1].astype(np.int32) & 0x1F) << 8 | p[:, 2]
    starts = (p[:, 1] & 0x40) > 0
    field, carries = (p[:, 3] & 0x20) > 0, (p[:, 3] & 0x10) > 0
    associations = {p[k].tobytes()[4:] for k in np.flatnonzero((pid == PAT_PID) & starts)}
    map_pids = {struct.unpack_from(">H", s, at + 2)[0] & 0x1FFF for raw in associations for s in [section_of(np.frombuffer(b"\x47\x40\0\x10" + raw, np.uint8))] for at in range(8, len(s) - 4, 4) if s[at : at + 2] != b"\0\0"}
    streams: dict[int, int] = {}
    for m in map_pids:
        for raw in {p[k].tobytes()[4:] for k in np.flatnonzero((pid == m) & starts)}:
            s = section_of(np.frombuffer(b"\x47\x40\0\x10" + raw, np.uint8))
            at = 12 + (struct.unpack_from(">H", s, 10)[0] & 0xFFF)
            while at < len(s) - 4:
                kind, es, info = struct.unpack_from(">BHH", s, at)
                streams[es & 0x1FFF] = kind
                at += 5 + (info & 0xFFF)
    errors = 0
    for x in {PAT_PID, *map_pids, *streams}:
        counters = p[(pid == x) & carries, 3] & 15
        errors += int(((counters[1:] - counters[:-1] & 15) != 1).sum())
    es = next(iter(streams))
    mine = np.flatnonzero((pid == es) & carries)
    q = p[mine]
    begin = 4 + np.where(field[mine], 1 + q[:, 4].astype(np.int64), 0)
    body = q[np.arange(PACKET) >= begin[:, None]].tobytes()
    ends = np.cumsum(PACKET - begin)
    random = field[mine] & (q[:, 4] > 0) & ((q[:, 5] & 0x40) > 0)
    first = np.flatnonzero(starts[mine])
    edges = [*(ends[first] - (PACKET - begin[first])).tolist(), len(body)]
    parts, stamps = [], []
    for a, b in zip(edges, edges[1:]):
        code, n, _, flags, header = struct.unpack_from(">IHBBB", body, a)
        if code >> 8 != 1:
            raise ValueError("no PES packet where one starts")
        if flags & 0x80:
            t1, t2, t3 = struct.unpack_from(">BHH", body, a + 9)
            stamps.append((t1 >> 1 & 7) << 30 | t2 >> 1 << 15 | t3 >> 1)
        parts.append(body[a + 9 + header : a + 6 + n if n else b])
    return Stream(b"".join(parts), stamps, np.flatnonzero(random[first]).tolist(), len(p), errors, streams[es])


def feature_of(s: Stream) -> str:
    samples = np.frombuffer(s.payload, np.uint8)
    return (
        f"packets={s.packets};units={len(s.timestamps)};type={s.stream_type};pts={s.timestamps[0]}-{s.timestamps[-1]};"
        f"seconds={len(s.timestamps) * UNIT_TICKS / CLOCK:.2f};random_access={len(s.random_access)};discontinuities={s.continuity_errors};mean={samples.mean():.4f};max={samples.max()}"
    )


def padded(text: bytes) -> bytes:
    """The text and zeros up to a positive multiple of 64 bytes."""
    return text.ljust(max(64, -(-len(text) // 64) * 64), b"\0")


def store_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        n = [len(t or b"") for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array([mux(padded(t or b"")) for t in texts], pa.binary())], names=["doc_id", "n_bytes", "media"])


def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, media in slices(batches, "media"):
        rows = []
        for m in media:
            s = demux(m)
            rows.append((len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-64:]), len(m), hashlib.sha256(m).hexdigest(), feature_of(s)))
        a, b, c, d, e, f = zip(*rows)
        i64 = pa.int64()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(a, i64), pa.array(b), pa.array(c, i64), pa.array(d, i64), pa.array(e), pa.array(f)], names=[x.split()[0] for x in SCHEMA.split(", ")])


def units_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, media in slices(batches, "media"):
        got = [demux(m) for m in media]
        i64 = pa.int64()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.timestamps for s in got], pa.list_(i64)), pa.array([s.random_access for s in got], pa.list_(i64)), pa.array([s.continuity_errors for s in got], i64), pa.array([s.payload for s in got], pa.binary())], names=["doc_id", "timestamps", "random_access", "continuity_errors", "payload"])


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: each text's transport stream."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(store_batches, "doc_id long, n_bytes long, media binary")


def timeline(stored: DataFrame) -> DataFrame:
    """Of stored streams: presentation timestamps, indices of random-access units, continuity errors, payload."""
    return stored.select("doc_id", "n_bytes", "media").mapInArrow(units_batches, "doc_id long, timestamps array<long>, random_access array<long>, continuity_errors long, payload binary")


def features(stored: DataFrame) -> DataFrame:
    """Rows of SCHEMA from stored streams, all read back from the stored bytes."""
    return stored.select("doc_id", "n_bytes", "media").mapInArrow(read_batches, SCHEMA)
