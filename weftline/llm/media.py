"""Media columns: GIF files in and out, frames as columns.

The decoder reads the LZW code stream (clear codes, growing code widths, a full table that stays),
global and local palettes, interlacing, the graphic control's delay, transparency and disposal (0 and
1 leave the frame, 2 clears it to the background, 3 restores what was there before), and composes
every frame on the logical screen. The encoder writes 8-bit samples as frames of WIDTH columns under
a grey palette, so red equals the sample and reading back is exact.

A null text is empty: its payload is 64 zero bytes. Broken files, and those that declare
more than MOST_PIXELS pixels, raise ValueError in decode(); frames() gives no rows for them or for null
content.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weftline.llm.arrow import map_batches

#: Samples in a row and rows in a frame of the files that encode_samples() writes; delay in 1/100 s.
WIDTH, ROWS, DELAY = 64, 1024, 10
#: Pixels of a screen or frame that decode() composes, at most: a file whose header declares more is taken as broken.
MOST_PIXELS = 1 << 24
#: Bins of a frame's histogram, over each colour channel.
BINS = 8
CLEAR, END, FULL = 256, 257, 4096
GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).tobytes()


def _widths(n: int, size: int) -> np.ndarray:
    """Bits of the codes after a clear code: the table has 2**size + 2 entries, and one more from the second code on."""
    entries = (1 << size) + 2 + np.maximum(np.arange(n) - 1, 0)
    return np.minimum(12, np.floor(np.log2(entries)).astype(np.int64) + 1)


def lzw_codes(data: bytes) -> list[int]:
    """Codes for 8-bit samples, with a clear code first and whenever the table is full, and the end code."""
    out, table, fresh = [CLEAR], {}, CLEAR + 2
    put, get = out.append, table.get
    samples = iter(data)
    run = next(samples, None)
    if run is None:
        return [CLEAR, END]
    for b in samples:
        key = run << 8 | b
        code = get(key)
        if code is not None:
            run = code
            continue
        put(run)
        run = b
        if fresh < FULL:
            table[key] = fresh
            fresh += 1
        else:
            put(CLEAR)
            table.clear()
            fresh = CLEAR + 2
    put(run)
    put(END)
    return out


def pack(codes: list[int]) -> bytes:
    """Codes as bits, least significant first. Widths follow from each code's distance to the clear code before it."""
    c = np.array(codes, dtype=np.int64)
    at = np.arange(len(c))
    since = at - 1 - np.maximum.accumulate(np.where(np.concatenate([[True], c[:-1] == CLEAR]), at - 1, -1))
    width = _widths(int(since.max()) + 1, 8)[since]
    width[0] = 9
    end = np.cumsum(width)
    first = end - width
    value, byte = c << (first & 7), first >> 3
    n = int(end[-1] + 7 >> 3) + 3
    total = sum(np.bincount(byte + k, weights=(value >> 8 * k) & 255, minlength=n) for k in range(3))
    return total.astype(np.uint8)[: n - 3].tobytes()


def lzw_decode(stream: bytes, size: int, wanted: int) -> bytes:
    """Samples of a code stream with a minimum code size; at most ``wanted``, short streams give fewer."""
    clear, end = 1 << size, (1 << size) + 1
    raw = np.frombuffer(stream + b"\0\0\0", dtype=np.uint8).astype(np.int64)
    bits, pos, got = 8 * len(stream), 0, 0
    out: list[bytes] = []
    literals = [bytes([i]) for i in range(clear)] + [b"", b""]
    table, prev, seen = literals[:], None, 0
    widths = _widths(FULL + 2, size)
    while got < wanted:
        width = widths[min(seen, FULL) :] if seen < FULL else np.full(FULL, 12)
        last = pos + np.cumsum(width)
        width, last = width[: (n := int(np.searchsorted(last, bits, "right")))], last[:n]
        if not n:
            break
        first = last - width
        i = first >> 3
        codes = (raw[i] | raw[i + 1] << 8 | raw[i + 2] << 16) >> (first & 7) & (1 << width) - 1
        stop = np.flatnonzero((codes == clear) | (codes == end))
        k = int(stop[0]) if len(stop) else n
        grow, put, size_now = table.append, out.append, len(table)
        known = codes[:k].tolist()
        if prev is None and known:
            if known[0] >= clear:
                raise ValueError("a code stream starts with a code that is not defined")
            prev = table[known[0]]
            put(prev)
            got += 1
            del known[0]
        for code in known:
            if code < size_now:
                text = table[code]
            elif code == size_now:
                text = prev + prev[:1]
            else:
                raise ValueError("a code is not defined")
            if size_now < FULL:
                grow(prev + text[:1])
                size_now += 1
            put(text)
            got += len(text)
            prev = text
        seen += k
        if k == n:
            pos = int(last[-1])
            continue
        pos = int(last[k])
        if codes[k] == end:
            break
        table, prev, seen = literals[:], None, 0
    return b"".join(out)[:wanted]


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def encode(frames: list[np.ndarray], palette: bytes = GREY, delays: list[int] | None = None, screen: tuple[int, int] | None = None, disposal: int = 1, transparent: int | None = None) -> bytes:
    """A GIF of frames of palette indices (rows x columns), each at the upper left corner."""
    height, width = screen or (max(f.shape[0] for f in frames), max(f.shape[1] for f in frames))
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), palette]
    for k, f in enumerate(frames):
        delay = delays[k] if delays else DELAY
        out.append(b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (transparent is not None), delay, transparent or 0) + b"\0")
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, f.shape[1], f.shape[0], 0) + b"\x08" + _blocks(pack(lzw_codes(f.tobytes()))))
    return b"".join(out) + b"\x3b"


@dataclass
class Frame:
    """rgba: the composed screen, as shown; box: left, top, width and height of the frame's own part."""

    index: int
    start_ms: int
    delay_ms: int
    disposal: int
    box: tuple[int, int, int, int]
    rgba: np.ndarray

    def histogram(self, bins: int = BINS) -> list[int]:
        """Shown pixels by red, green and blue, each in ``bins`` bins."""
        shown = self.rgba[self.rgba[..., 3] > 0]
        return np.concatenate([np.bincount(shown[:, c] >> 8 - bins.bit_length() + 1, minlength=bins) for c in range(3)]).tolist()


def decode(data: bytes) -> Iterator[Frame]:
    """The frames in order, one in memory at a time."""
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    p = 13

    def colours(flag: int) -> np.ndarray | None:
        nonlocal p
        if not flag & 0x80:
            return None
        n = 2 << (flag & 7)
        table = np.frombuffer(data, np.uint8, 3 * n, p).reshape(n, 3)
        p += 3 * n
        return table

    def sub_blocks() -> bytes:
        nonlocal p
        parts = []
        while data[p]:
            parts.append(data[p + 1 : p + 1 + data[p]])
            p += data[p] + 1
        p += 1
        return b"".join(parts)

    if width * height > MOST_PIXELS:
        raise ValueError("too large a screen")
    common = colours(flags)
    screen = np.zeros((height, width, 4), np.uint8)
    disposal, clear_index, delay, index, clock = 0, None, 0, 0, 0
    while True:
        kind = data[p] if p < len(data) else 0x3B
        p += 1
        if kind == 0x3B:
            return
        if kind == 0x21:
            label = data[p]
            p += 1
            body = sub_blocks()
            if label == 0xF9:
                packed, delay, index_ = struct.unpack("<BHB", body[:4])
                disposal, clear_index = packed >> 2 & 7, index_ if packed & 1 else None
            continue
        if kind != 0x2C:
            raise ValueError("an unknown block")
        left, top, w, h, local = struct.unpack_from("<HHHHB", data, p)
        p += 9
        palette = colours(local)
        palette = common if palette is None else palette
        if palette is None:
            raise ValueError("a frame without a palette")
        size = data[p]
        p += 1
        if w * h > MOST_PIXELS:
            raise ValueError("too large a frame")
        samples = lzw_decode(sub_blocks(), size, w * h)
        pixels = np.frombuffer(samples.ljust(w * h, b"\0"), np.uint8).reshape(h, w)
        if local & 0x40:
            order = np.concatenate([np.arange(a, h, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])
            pixels = pixels[np.argsort(order)]
        rows, columns = max(0, min(h, height - top)), max(0, min(w, width - left))
        pixels = pixels[:rows, :columns]
        before = screen.copy() if disposal == 3 else None
        area = screen[top : top + rows, left : left + columns]
        painted = np.empty((rows, columns, 4), np.uint8)
        painted[..., :3] = palette[np.minimum(pixels, len(palette) - 1)]
        painted[..., 3] = 255
        if clear_index is None:
            area[:] = painted
        else:
            seen = pixels != clear_index
            area[seen] = painted[seen]
        yield Frame(index, clock * 10, delay * 10, disposal, (left, top, w, h), screen)
        if disposal == 2:
            area[:] = 0
        elif disposal == 3:
            screen = before
        clock, index = clock + delay, index + 1
        disposal, clear_index, delay = 0, None, 0


def encode_samples(payload: bytes) -> bytes:
    """A GIF whose frames' samples, in order, are the payload; its length must be a multiple of WIDTH."""
    pixels = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    frames = [pixels[i : i + ROWS] for i in range(0, len(pixels), ROWS)]
    return encode(frames, screen=(min(len(pixels), ROWS), WIDTH))


def read_samples(stored: bytes) -> tuple[bytes, list[int], np.ndarray]:
    """The samples, the frames' delays in ms and the summed red histogram, from the composed frames."""
    parts, histogram, delays = [], np.zeros(BINS, np.int64), []
    for f in decode(stored):
        left, top, w, h = f.box
        red = f.rgba[top : top + h, left : left + w, 0]
        parts.append(red.tobytes())
        histogram += np.bincount(red.reshape(-1) >> 5, minlength=BINS)
        delays.append(f.delay_ms)
    return b"".join(parts), delays, histogram


FRAME_SCHEMA = "frame int, start_ms int, delay_ms int, disposal int, width int, height int, red array<long>, green array<long>, blue array<long>, rgba_sha256 string"


def frames(df: DataFrame, content: str = "content", key: str = "doc_id") -> DataFrame:
    """One row for each timed frame of each file: key, frame, times, size, histogram columns and a digest of the composed pixels."""

    def run(batches):
        for b in batches:
            rows = []
            for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = []
                try:
                    for f in decode(data or b""):
                        hist = f.histogram()
                        found.append((k, f.index, f.start_ms, f.delay_ms, f.disposal, f.box[2], f.box[3], hist[:BINS], hist[BINS : 2 * BINS], hist[2 * BINS :], hashlib.sha256(f.rgba.tobytes()).hexdigest()))
                except (ValueError, IndexError, struct.error):
                    found = []
                rows += found
            names = [key, *(x.split()[0] for x in FRAME_SCHEMA.split(", "))]
            kinds = [b.schema.field(0).type, *[pa.int32()] * 6, *[pa.list_(pa.int64())] * 3, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    return map_batches(df.select(key, content), run, f"{key} {dict(df.dtypes)[key]}, {FRAME_SCHEMA}")


STORED_SCHEMA = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long, duration_ms long, red array<long>"


def store_and_read(text: bytes) -> tuple[bytes, tuple]:
    """The GIF of a text, and what reading it back gives, as in STORED_SCHEMA."""
    payload = text.ljust(max(64, -(-len(text) // 64) * 64), b"\0")
    stored = encode_samples(payload)
    back, delays, histogram = read_samples(stored)
    if back != payload:
        raise ValueError("the stored samples differ")
    feature = f"{len(delays)}x{WIDTH}:" + ",".join(map(str, histogram.tolist()))
    return stored, (len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature, len(delays), sum(delays), histogram.tolist())


def store_texts(df: DataFrame, text: str = "text", key: str = "doc_id", keep_media: bool = False) -> DataFrame:
    """key and STORED_SCHEMA for each row, the GIF itself too with keep_media."""
    names = [key, *(x.split()[0] for x in STORED_SCHEMA.split(", "))] + ["content"] * keep_media
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())] + [pa.binary()] * keep_media

    def run(batches):
        for b in batches:
            rows = []
            for x in b.column(1):
                stored, facts = store_and_read(x.as_buffer().to_pybytes() if x.is_valid else b"")
                rows.append(facts + ((stored,) if keep_media else ()))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]], names=names)

    return map_batches(df.select(key, text), run, f"{key} {dict(df.dtypes)[key]}, {STORED_SCHEMA}" + ", content binary" * keep_media)


def op5_media(documents: DataFrame) -> DataFrame:
    return store_texts(documents)
