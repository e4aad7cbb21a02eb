"""Words of texts as 64-bit hashes, with numpy over whole groups of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of texts that are handled together; a longer text is handled alone.
TOGETHER = 1 << 20
_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 1 << 64)
_rng = np.random.default_rng(20240)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: Which bytes separate words: white space; or all ASCII but letters and digits.
SPACES = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
NON_WORDS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_R**i and _R**-i modulo 2**64 for i up to n."""
    size = max(1 << 16, 1 << int(n).bit_length())
    if size not in _powers:
        if size <= 2 * TOGETHER:
            _powers.clear()
        made = tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, r, np.uint64)])) for r in (_R, _R_INVERSE))
        if size > 2 * TOGETHER:
            return made
        _powers[size] = made
    return _powers[size]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def groups(texts: list[bytes], limit: int = TOGETHER) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P with hash of data[a:b] = (P[b] - P[a]) * inverse[a], and inverse. data: bytes, or 64-bit hashes of words."""
    power, inverse = powers(len(data))
    p = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_BYTE[data] if data.dtype == np.uint8 else data) * power[: len(data)], out=p[1:])
    return p, inverse


def edges(data: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~separators[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def words(texts: list[bytes], separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and the number of words of each text."""
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    start, stop = edges(data, separators)
    p, inverse = prefix_hash(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return mix((p[stop] - p[start]) * inverse[start]), np.diff(np.searchsorted(start, np.concatenate([[0], ends])))


def utf8(column) -> list[bytes]:
    """The bytes of an Arrow string column; a null is empty."""
    return [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in column]
