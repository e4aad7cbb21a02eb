"""Stored files against a decoder written plainly from the file format, one bit at a time."""

import collections
import hashlib
import zlib

import pytest

from weftline.llm import media, registry

SF = "/root/testdata/sf0.001"


def plain_lzw(data, size):
    clear, end = 1 << size, (1 << size) + 1
    bits, out, table, last, width, at = int.from_bytes(data, "little"), bytearray(), None, None, size + 1, 0
    while True:
        code = bits >> at & (1 << width) - 1
        at += width
        if code == clear:
            table, last, width = [bytes([i]) for i in range(clear)] + [b"", b""], None, size + 1
            continue
        if code == end:
            return bytes(out)
        entry = table[code] if code < len(table) else last + last[:1]
        out += entry
        if last is not None and len(table) < 4096:
            table.append(last + entry[:1])
            if len(table) == 1 << width and width < 12:
                width += 1
        last = entry


def plain_gif(data):
    """(samples' red values of each frame, delay) of files without interlacing."""
    assert data[:6] == b"GIF89a"
    flags, p, frames, delay = data[10], 13, [], 0
    palette = None
    if flags & 0x80:
        n = 3 * (2 << (flags & 7))
        palette, p = data[p : p + n], p + n

    def blocks(p):
        body = b""
        while data[p]:
            body, p = body + data[p + 1 : p + 1 + data[p]], p + 1 + data[p]
        return body, p + 1

    while data[p] != 0x3B:
        if data[p] == 0x21:
            label = data[p + 1]
            body, p = blocks(p + 2)
            if label == 0xF9:
                delay = int.from_bytes(body[1:3], "little")
            continue
        w, h, local = int.from_bytes(data[p + 5 : p + 7], "little"), int.from_bytes(data[p + 7 : p + 9], "little"), data[p + 9]
        p, colours = p + 10, palette
        if local & 0x80:
            n = 3 * (2 << (local & 7))
            colours, p = data[p : p + n], p + n
        size = data[p]
        body, p = blocks(p + 1)
        samples = plain_lzw(body, size)
        assert len(samples) == w * h
        frames.append((bytes(colours[3 * s] for s in samples), delay))
    return frames


@pytest.mark.parametrize("odd", [False, True])
def test_op5_equals_a_plain_reading(spark, odd_dir, odd):
    docs = spark.read.parquet(f"{odd_dir if odd else SF}/documents.parquet")
    want = collections.Counter()
    for i, t in docs.select("doc_id", "text").collect():
        b = (t or "").encode()
        stored = media.store_and_read(b)[0]
        frames = plain_gif(stored)
        payload = b"".join(f for f, _ in frames)
        assert payload == b.ljust(max(64, -(-len(b) // 64) * 64), b"\0")
        bins = [sum(payload.count(v) for v in range(32 * k, 32 * k + 32)) for k in range(8)]
        want[(i, len(b), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), f"{len(frames)}x64:" + ",".join(map(str, bins)), len(frames), 10 * sum(d for _, d in frames), tuple(bins))] += 1
    rows = registry.queries()["op5_media"](spark, odd_dir if odd else SF).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256, r.feature, r.n_frames, r.duration_ms, tuple(r.red)) for r in rows) == want
