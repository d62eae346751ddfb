"""Word shingles of UTF-8 columns as 64-bit hashes, computed over whole Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.default_rng(11)
_BYTE = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_STEP = np.uint64(0x9E3779B97F4A7C15 & ~7 | 3)  # 3 mod 8: its powers differ early
_TURN = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text the index of its first word (one more at the end)."""
    base = int(offsets[0])
    data = data[base:int(offsets[-1])]
    offsets = offsets.astype(np.int64) - base
    solid = ~_SPACE[data]
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    starts[inner] = solid[inner]  # a text's first word does not join the text before
    at = np.flatnonzero(starts)
    first = np.searchsorted(at, offsets)
    if not len(at):
        return np.zeros(0, dtype=np.uint64), first
    data, solid = data[at[0]:], solid[at[0]:]
    at = at - at[0]
    place = np.arange(len(data)) - np.repeat(at, np.diff(np.append(at, len(data))))
    powers = np.cumprod(np.full(int(place.max()) + 1, _STEP, dtype=np.uint64))
    value = _BYTE[data] * powers[place]
    value[~solid] = 0
    return mixed(np.add.reduceat(value, at)), first


def shingle_sets(column: pa.Array, words: int, block_bytes: int = 1_000_000) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``words``-word shingles (nulls are empty).

    A text with fewer words is one shingle of all of them; one without words has none.
    """
    for data, offsets in text_blocks(column, block_bytes):
        hashes, first = word_hashes(data, offsets)
        rolled = None
        if len(hashes) >= words:
            m = len(hashes) - words + 1
            rolled = np.full(m, words, dtype=np.uint64)
            for k in range(words):
                rolled = rolled + hashes[k:k + m] * _TURN[k]
            rolled = mixed(rolled)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= words:
                yield np.unique(rolled[a:b - words + 1])
            elif b > a:
                yield mixed(np.asarray([(b - a)], dtype=np.uint64) + (hashes[a:b] * _TURN[:b - a]).sum(dtype=np.uint64))
            else:
                yield hashes[:0]


def text_blocks(column: pa.Array, block_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Byte and offset views of a string column, in blocks of about ``block_bytes`` (a text stays whole)."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + block_bytes, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield data, offsets[at:to + 1]
        at = to


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit numbers that stand for a set of hashes."""
    n = np.uint64(len(tokens))
    pair = mixed(np.asarray([tokens.sum(dtype=np.uint64) + n, mixed(tokens ^ _TURN[15]).sum(dtype=np.uint64) ^ n], dtype=np.uint64))
    return tuple(pair.view(np.int64).tolist())
