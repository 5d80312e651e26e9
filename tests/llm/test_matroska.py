from __future__ import annotations

import hashlib
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casebook.llm import matroska as m


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 60), st.integers(0, 2**32), st.sampled_from([None, m.XIPH, m.EBML_LACING]))
def test_round_trip(units, seed, mode):
    payload = hashlib.shake_128(str(seed).encode()).digest(units * m.UNIT * 7 + 0)
    rows = m.parse(data := m.mux_pcm(payload, mode))
    assert b"".join(data[r[4] : r[4] + r[5]] for r in rows) == payload
    assert [r[2] for r in rows] == [i * m.FRAME * 10**9 // m.RATE for i in range(len(rows))]
    assert all(r[8] for r in rows)


def test_unknown_sizes_and_block_groups():
    head = m.element(m.EBML, m.element(m.DOC_TYPE, b"webm"))
    block = m.vint(2) + b"\x00\x05\x00" + b"frame"
    cluster = b"\x1f\x43\xb6\x75\x01\xff\xff\xff\xff\xff\xff\xff" + m.uint(m.TIMESTAMP, 7) + m.element(m.BLOCK_GROUP, m.element(m.BLOCK, block))
    rows = m.parse(head + b"\x18\x53\x80\x67\xff" + cluster + cluster)
    assert [(r[1], r[2], r[5], r[6], r[7]) for r in rows] == [(2, 12_000_000, 5, False, 0)] * 2
    with pytest.raises(ValueError):
        m.parse(m.mux_pcm(bytes(400))[:-3])


def track_file(*entry: bytes, block: bytes = m.vint(1) + b"\x00\x05\x00" + b"frame", cues: bytes = b"") -> bytes:
    track = m.element(m.TRACK_ENTRY, m.uint(m.TRACK_NUMBER, 1) + b"".join(entry))
    body = m.element(m.TRACKS, track) + m.element(m.CUES, cues) + m.element(m.CLUSTER, m.uint(m.TIMESTAMP, 7) + m.element(m.SIMPLE_BLOCK, block))
    return m.element(m.EBML, m.element(m.DOC_TYPE, b"matroska")) + m.element(m.SEGMENT, body)


def test_track_scale_and_header_stripping():
    coding = lambda algo, scope=1: m.element(m.CONTENT_ENCODINGS, m.element(m.CONTENT_ENCODING, m.uint(m.ENCODING_SCOPE, scope) + m.element(m.COMPRESSION, m.uint(m.COMP_ALGO, algo) + m.element(m.COMP_SETTINGS, b"\x0b\x77"))))
    data = track_file(m.element(m.TRACK_TIMESTAMP_SCALE, struct.pack(">f", 0.5)), coding(3))
    (row,) = m.parse(data)
    assert row[2] == 9_500_000 and row[9] == b"\x0b\x77" and m.packet_bytes(data, row) == b"\x0b\x77frame"
    (row,) = m.parse(data := track_file(coding(0, scope=2)))
    assert row[2] == 12_000_000 and m.packet_bytes(data, row) == b"frame"
    with pytest.raises(ValueError, match="compressed"):
        m.parse(track_file(coding(0)))


def test_cues_may_hold_a_checksum():
    assert len(m.parse(track_file(cues=m.element(0xBF, b"\x00\x01\x02\x03")))) == 1


@pytest.mark.parametrize("block", [b"\x81\x00", b"\x81\x00\x00\x02", b"\x81\x00\x00\x02\x01\xff", b"\x81\x00\x00\x06\x02\x81", b"\x81\x00\x00\x04\x01\x00"])
def test_blocks_cut_short(block):
    with pytest.raises(ValueError):
        m.parse(track_file(block=block))


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_damaged_files_raise_value_errors_only(data):
    raw = bytearray(m.mux_pcm(bytes(range(192)) * 20, m.XIPH))
    for _ in range(data.draw(st.integers(1, 4))):
        raw[data.draw(st.integers(0, len(raw) - 1))] = data.draw(st.integers(0, 255))
    try:
        m.parse(bytes(raw[: data.draw(st.integers(0, len(raw)))]))
    except ValueError:
        pass


def test_query(spark):
    texts = ["", None, "x", "é" * 100, "y" * 192, "z" * 100_000, "x"]
    docs = spark.createDataFrame([(i, t, b"m") for i, t in enumerate(texts)] + [(None, "x", b"m")], "doc_id long, text string, media binary")
    rows = m.describe(m.store_samples(docs)).collect()
    assert len(rows) == 8
    for r in rows:
        raw = (texts[r.doc_id] if r.doc_id is not None else "x") or ""
        pad = raw.encode().ljust(max(192, -(-len(raw.encode()) // 192) * 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw.encode()), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-16:]))
    assert len({(r.media_sha256, r.feature) for r in rows if r.doc_id in (2, 6, None)}) == 1
    table = m.packets(m.store_samples(docs))
    assert table.where("doc_id = 5").count() == -(-100_032 // m.FRAME)
    assert m.describe(m.store_samples(docs.limit(0))).count() == 0
