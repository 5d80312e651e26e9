"""Matroska media columns: EBML elements, clusters, lacing and cues to packet tables, and a muxer for 8-bit PCM.

`packets` turns a column of Matroska files into one row a packet: track, timestamp, byte range, and the bytes that header
stripping took from its head. `store_samples` writes
a payload as unsigned 8-bit mono PCM at 8 kHz; `describe` reads the stored files back and computes features.

A null file has no packets; a file that isn't Matroska, is cut short, or has compressed or encrypted frames raises
ValueError. Null text is the empty payload, which is padded like any other; a very long text is one file, held whole by
its task. Repeated rows give repeated results, so there are no ties. An empty table gives no row. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import shared_dir, small_batches

#: Element ids of the Matroska specification.
EBML, EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE, DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ_VERSION = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, MUXING_APP, WRITING_APP, DURATION = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4D80, 0x5741, 0x4489
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, FLAG_LACING, CODEC_ID, AUDIO, SAMPLING, CHANNELS, BIT_DEPTH, DEFAULT_DURATION = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86, 0xE1, 0xB5, 0x9F, 0x6264, 0x23E383
TRACK_TIMESTAMP_SCALE, CONTENT_ENCODINGS, CONTENT_ENCODING, ENCODING_SCOPE, ENCODING_TYPE, COMPRESSION, COMP_ALGO, COMP_SETTINGS = 0x23314F, 0x6D80, 0x6240, 0x5032, 0x5033, 0x5034, 0x4254, 0x4255
HEADER_STRIPPING, SCOPE_FRAMES = 3, 1
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
#: Elements that end an element of unknown size.
TOP = {SEGMENT, INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1941A469, 0x1043A770, 0x1254C367, EBML}

RATE, UNIT = 8000, 192
FRAME, LACE, CLUSTER_BLOCKS = 8 * UNIT, 8, 16
NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3
PACKETS = "packet long, track long, timestamp_ns long, cluster long, offset long, size long, keyframe boolean, lacing int, cued boolean, prefix binary"


def element(eid: int, data: bytes) -> bytes:
    return eid.to_bytes((eid.bit_length() + 7) // 8, "big") + vint(len(data)) + data


def vint(n: int, length: int = 0) -> bytes:
    """A size; all value bits set would mean unknown, so such numbers take a byte more."""
    while not length or n >= (1 << 7 * length) - 1:
        length += 1
    return (n | 1 << 7 * length).to_bytes(length, "big")


def uint(eid: int, n: int) -> bytes:
    return element(eid, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def signed_vint(n: int) -> bytes:
    length = 1
    while not -(1 << 7 * length - 1) < n < 1 << 7 * length - 1:
        length += 1
    return (n + (1 << 7 * length - 1) - 1 | 1 << 7 * length).to_bytes(length, "big")


def lace(frames: list[bytes], mode: int | None = None) -> tuple[int, bytes]:
    """Flags and data of a block. Equal frames take fixed lacing, others EBML lacing, unless a mode is named."""
    sizes = [len(x) for x in frames]
    if len(frames) == 1:
        return NO_LACING, frames[0]
    if mode is None:
        mode = FIXED if len(set(sizes)) == 1 else EBML_LACING
    head = bytes([len(frames) - 1])
    if mode == XIPH:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif mode == EBML_LACING:
        head += vint(sizes[0]) + b"".join(signed_vint(b - a) for a, b in zip(sizes[:-2], sizes[1:-1], strict=True))
    elif len(set(sizes)) > 1:
        raise ValueError("fixed lacing needs frames of one size")
    return mode, head + b"".join(frames)


def mux_pcm(payload: bytes, mode: int | None = None) -> bytes:
    """A Matroska file with the payload as 8-bit samples; timestamps are in ms, which are 8 samples each."""
    head = element(EBML, uint(EBML_VERSION, 1) + uint(EBML_READ_VERSION, 1) + uint(EBML_MAX_ID, 4) + uint(EBML_MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + uint(DOC_TYPE_VERSION, 4) + uint(DOC_TYPE_READ_VERSION, 2))
    ms = lambda at: at * 1000 // RATE
    body = [element(INFO, uint(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", ms(len(payload)))) + element(MUXING_APP, b"casebook") + element(WRITING_APP, b"casebook"))]
    audio = element(AUDIO, element(SAMPLING, struct.pack(">d", RATE)) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8))
    body.append(element(TRACKS, element(TRACK_ENTRY, uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + uint(FLAG_LACING, 1) + uint(DEFAULT_DURATION, FRAME * 10**9 // RATE) + element(CODEC_ID, b"A_PCM/INT/LIT") + audio)))
    at, cues = sum(map(len, body)), []
    for c in range(0, len(payload), FRAME * LACE * CLUSTER_BLOCKS):
        parts = [uint(TIMESTAMP, ms(c))]
        for b in range(c, min(len(payload), c + FRAME * LACE * CLUSTER_BLOCKS), FRAME * LACE):
            frames = [payload[f : f + FRAME] for f in range(b, min(len(payload), b + FRAME * LACE), FRAME)]
            kind, data = lace(frames, mode)
            parts.append(element(SIMPLE_BLOCK, vint(1) + struct.pack(">hB", ms(b) - ms(c), 0x80 | kind << 1) + data))
        cluster = element(CLUSTER, b"".join(parts))
        cues.append(element(CUE_POINT, uint(CUE_TIME, ms(c)) + element(CUE_TRACK_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER_POSITION, at))))
        body.append(cluster)
        at += len(cluster)
    body.append(element(CUES, b"".join(cues)))
    return head + element(SEGMENT, b"".join(body))


def read_vint(data: bytes, at: int) -> tuple[int, int, int]:
    """Value without the length mark, its length, and the value that means unknown."""
    if at >= len(data) or not data[at]:
        raise ValueError(f"no vint at byte {at}")
    n = 9 - data[at].bit_length()
    if at + n > len(data):
        raise ValueError("a vint is cut short")
    unknown = (1 << 7 * n) - 1
    return int.from_bytes(data[at : at + n], "big") & unknown, n, unknown


def elements(data: bytes, at: int, end: int, parent: int = 0) -> Iterator[tuple[int, int, int, int]]:
    """Id, place, and the bounds of the data of each element between at and end."""
    while at < end:
        n = 9 - data[at].bit_length()
        if n > 4:
            raise ValueError(f"no element id at byte {at}")
        eid = int.from_bytes(data[at : at + n], "big")
        if parent == CLUSTER and eid in TOP:
            return
        size, m, unknown = read_vint(data, at + n)
        first = at + n + m
        if size == unknown:
            last = end
            if eid == CLUSTER:
                last = first
                for _, _, _, last in elements(data, first, end, CLUSTER):
                    pass
        else:
            last = first + size
        if last > end:
            raise ValueError(f"element {eid:x} is cut short")
        yield eid, at, first, last
        at = last


def number(data: bytes, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def frames_of(data: bytes, at: int, end: int, kind: int) -> list[tuple[int, int]]:
    """Place and size of each frame of a block's data."""
    if kind == NO_LACING:
        return [(at, end - at)]
    if at >= end:
        raise ValueError("a lace is cut short")
    n, at = data[at] + 1, at + 1
    sizes: list[int] = []
    if kind == XIPH:
        for _ in range(n - 1):
            first = at
            while at < end and data[at] == 255:
                at += 1
            if at >= end:
                raise ValueError("a lace is cut short")
            sizes.append((at - first) * 255 + data[at])
            at += 1
    elif kind == EBML_LACING:
        for k in range(n - 1):
            x, m, unknown = read_vint(data, at)
            sizes.append(sizes[-1] + x - (unknown >> 1) if k else x)
            at += m
    else:
        if (end - at) % n:
            raise ValueError("fixed lacing with a rest")
        sizes = [(end - at) // n] * (n - 1)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("laced frames are longer than their block")
    out = []
    for size in sizes:
        out.append((at, size))
        at += size
    return out


def real(data: bytes, a: int, b: int) -> float:
    if b - a not in (0, 4, 8):
        raise ValueError(f"a float of {b - a} bytes")
    return struct.unpack(">f" if b - a == 4 else ">d", data[a:b])[0] if b > a else 0.0


def stripped(data: bytes, a: int, b: int) -> bytes:
    """What a track's content encodings took from the head of each frame. Other encodings of frames raise."""
    prefix = b""
    for e, _, p, q in elements(data, a, b):
        if e != CONTENT_ENCODING:
            continue
        own = {f: (u, v) for f, _, u, v in elements(data, p, q)}
        if ENCODING_SCOPE in own and not number(data, *own[ENCODING_SCOPE]) & SCOPE_FRAMES:
            continue
        how = {f: (u, v) for f, _, u, v in elements(data, *own[COMPRESSION])} if COMPRESSION in own else {}
        if (ENCODING_TYPE in own and number(data, *own[ENCODING_TYPE])) or COMP_ALGO not in how or number(data, *how[COMP_ALGO]) != HEADER_STRIPPING:
            raise ValueError("frames are compressed or encrypted")
        u, v = how.get(COMP_SETTINGS, (0, 0))
        prefix += data[u:v]
    return prefix


def parse(data: bytes) -> list[tuple]:
    """The packet table of a file: PACKETS. Laced frames after the first are a default duration later each."""
    out, scale, durations, cued, doc_type = [], 1_000_000, {}, set(), b""
    scales: dict[int, float] = {}
    prefixes: dict[int, bytes] = {}
    for eid, _, a, b in elements(data, 0, len(data)):
        if eid == EBML:
            doc_type = b"".join(data[x:y] for e, _, x, y in elements(data, a, b) if e == DOC_TYPE)
        if eid != SEGMENT:
            continue
        base = a
        for e, at, x, y in elements(data, a, b):
            if e == INFO:
                scale = next((number(data, p, q) for k, _, p, q in elements(data, x, y) if k == TIMESTAMP_SCALE), scale)
            elif e == TRACKS:
                for k, _, p, q in elements(data, x, y):
                    if k == TRACK_ENTRY:
                        own = {f: number(data, u, v) for f, _, u, v in elements(data, p, q) if f in (TRACK_NUMBER, DEFAULT_DURATION)}
                        track = own.get(TRACK_NUMBER, 0)
                        durations[track] = own.get(DEFAULT_DURATION, 0)
                        for f, _, u, v in elements(data, p, q):
                            if f == TRACK_TIMESTAMP_SCALE:
                                scales[track] = real(data, u, v)
                            elif f == CONTENT_ENCODINGS:
                                prefixes[track] = stripped(data, u, v)
            elif e == CUES:
                for point, _, p, q in elements(data, x, y):
                    for k, _, u, v in elements(data, p, q) if point == CUE_POINT else ():
                        if k == CUE_TRACK_POSITIONS:
                            own = {f: number(data, s, t) for f, _, s, t in elements(data, u, v)}
                            cued.add((own.get(CUE_TRACK, 0), own.get(CUE_CLUSTER_POSITION, -1)))
            elif e == CLUSTER:
                time = 0
                for k, _, p, q in elements(data, x, y, CLUSTER):
                    if k == TIMESTAMP:
                        time = number(data, p, q)
                    inner = [(p, q, k)] if k == SIMPLE_BLOCK else [(u, v, f) for f, _, u, v in elements(data, p, q) if f == BLOCK] if k == BLOCK_GROUP else []
                    for p, q, f in inner:  # noqa: B020, PLW2901
                        track, m, _ = read_vint(data, p)
                        if q - p - m < 3:
                            raise ValueError("a block is cut short")
                        shift, flags = struct.unpack_from(">hB", data, p + m)
                        begin = time * scale + (shift * scale if scales.get(track, 1.0) == 1.0 else round(shift * scale * scales[track]))
                        kind = flags >> 1 & 3
                        for i, (u, size) in enumerate(frames_of(data, p + m + 3, q, kind)):
                            out.append([len(out), track, begin + i * durations.get(track, 0), at - base, u, size, f == SIMPLE_BLOCK and bool(flags & 0x80), kind])
    if doc_type not in (b"matroska", b"webm"):
        raise ValueError("not a Matroska file")
    return [(*x, (x[1], x[3]) in cued, prefixes.get(x[1], b"")) for x in out]


def packet_bytes(data: bytes, row: tuple) -> bytes:
    """A packet as its codec wants it: what was stripped from its head, then its byte range."""
    return row[9] + data[row[4] : row[4] + row[5]]


def packets(files: DataFrame, key: str = "doc_id", media: str = "media") -> DataFrame:
    """One row for each packet of each file: the key and PACKETS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if data.is_valid and (rows := parse(data.as_py())):
                    cols = list(zip(*rows, strict=True))
                    kinds = [pa.int64()] * 6 + [pa.bool_(), pa.int32(), pa.bool_(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(rows), pa.int64()), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=["key", *(x.split()[0] for x in PACKETS.split(", "))])

    small_batches(files.sparkSession)
    return files.select(F.col(key).cast("long"), media).mapInArrow(run, f"key long, {PACKETS}").withColumnRenamed("key", key)


def store_samples(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write each text's payload as a Matroska file to the shared folder: doc_id, n_bytes, media."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [(x or "").encode() for x in batch.column(1).to_pylist()]
            media = [mux_pcm(x.ljust(max(UNIT, -(-len(x) // UNIT) * UNIT))) for x in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    spark = docs.sparkSession
    small_batches(spark)
    path = path or shared_dir(spark)
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary").write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def feature(samples: np.ndarray, n_packets: int) -> str:
    """Integer statistics of unsigned samples around 128: packets, sum, energy, peak, sign changes, 8 histogram bins."""
    x = samples.astype(np.int64) - 128
    bins = np.bincount(samples >> 5, minlength=8)
    return f"packets={n_packets};sum={x.sum()};energy={(x * x).sum()};peak={np.abs(x).max() if len(x) else 0};crossings={np.count_nonzero((x[1:] < 0) != (x[:-1] < 0))};hist={'-'.join(map(str, bins))}"


def describe(stored: DataFrame) -> DataFrame:
    """Read the files back: payload, its digests, those of the stored form, and the feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data in batch.column(2).to_pylist():
                rows = parse(data)
                payload = b"".join(packet_bytes(data, r) for r in rows)
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature(np.frombuffer(payload, np.uint8), len(rows))))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    small_batches(stored.sparkSession)
    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
