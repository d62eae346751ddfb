"""Token ids of a public byte-level BPE vocabulary, each distinct chunk of a group of texts encoded once.

The vocabulary's pattern cuts a text at white space: a run of it before a word gives its last space to
the word (any other last character stands alone) and is a piece by itself otherwise. So a text's ids are the
concatenated ids of its chunks (a word with the space before it, or a piece of white space). Chunks
repeat, texts hardly do. The places where chunks start come from the bytes of a group of texts at once and
Arrow numbers the distinct chunks. The words among them are encoded in one call, joined by line breaks: that
white space is a piece of its own there too, and the tokens' lengths in bytes tell the words' ids apart.
Pieces of white space are few; their ids are cached in two generations of bounded size in bytes. Texts
with white space beyond ASCII are encoded whole, and neither they nor long pieces are ever cached.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

LONG = 64  # characters of a chunk that is not cached
GROUP = 4 << 20  # characters of texts that are cut together
SLICE = 1 << 20  # chunks whose distinct ones are encoded together
ENTRY_BYTES = 200  # of a cached chunk beside its text and ids
OTHER_SPACE = re.compile(r"[^\S \t\n\r\x0b\x0c]")
OTHER_ASCII_SPACE = "\x1c\x1d\x1e\x1f"
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True


def chunk_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places in the bytes of texts (text k is ``bounds[k]:bounds[k + 1]``) where their chunks start.

    A chunk is a word with the space before it, a run of white space up to the character before a
    word or to the end of the text, or that one character if it is no space.
    """
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    space = _SPACE[data]
    start = edge[:n].copy()
    if n:
        here, before, word = space[1:], space[:-1], ~space[1:]
        start[1:] |= here & ~before  # a run of white space
        start[1:] |= word & before & (data[:-1] != 32)  # a word without a space of its own
        start[1:-1] |= here[:-1] & before[:-1] & word[1:] & ~edge[2:n]  # a run's last character, before a word
    return np.flatnonzero(start)


def _ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def rank_encoder(path: str, pattern: str, ranks: dict[bytes, int] | None = None):
    """Encoder over a vocabulary in rank form; special tokens' strings are ordinary text."""
    import tiktoken

    ranks = ranks or _ranks(path)
    return tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class ChunkEncoder:
    """``encode(texts)`` gives little-endian unsigned 32-bit ids as bytes, one item per text.

    ``path`` and ``pattern`` name the vocabulary in rank form, whose ids are those of the JSON
    form of the same vocabulary (a test compares them); it is about three times as fast.
    ``specials`` gives ids of strings that are found in text before anything else.
    """

    def __init__(self, path: str, pattern: str, max_bytes: int = 64_000_000, specials: dict[str, int] | None = None):
        ranks = _ranks(path)
        self.one = rank_encoder(path, pattern, ranks).encode_ordinary
        self.token_bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.token_bytes[rank] = len(token)
        self.specials = specials or {}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self.max_bytes = max_bytes
        self.held_bytes = 0  # of the young generation; the old one has at most as many
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, pieces: list[str]) -> list[bytes]:
        return [array("I", [self.specials[p]] if p in self.specials else self.one(p)).tobytes() for p in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        out, group, chars = [b""] * len(texts), [], 0
        for k, text in enumerate(texts):
            if not self._is_plain(text):
                out[k] = self._encode_other(text)
                continue
            group.append(k)
            chars += len(text)
            if chars >= GROUP:
                self._fill(out, texts, group)
                group, chars = [], 0
        self._fill(out, texts, group)
        return out

    def _fill(self, out: list[bytes], texts: list[str], group: list[int]) -> None:
        for k, ids in zip(group, self._encode_plain([texts[k] for k in group]), strict=True):
            out[k] = ids

    def _is_plain(self, text: str) -> bool:
        if any(s in text for s in self.specials):
            return False
        return not any(c in text for c in OTHER_ASCII_SPACE) if text.isascii() else not OTHER_SPACE.search(text)

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """Texts without special strings and without white space beyond ASCII, all at once."""
        held = pa.array(texts, pa.large_string())
        _, bounds, buffer = held.buffers()
        bounds = np.frombuffer(bounds, dtype=np.int64)[:len(texts) + 1] if texts else np.zeros(1, dtype=np.int64)
        data = np.frombuffer(buffer, dtype=np.uint8)[:bounds[-1]] if buffer else np.zeros(0, dtype=np.uint8)
        starts = chunk_starts(data, bounds)
        offsets = np.append(starts, len(data))
        sizes, parts = np.zeros(len(starts) + 1, dtype=np.int64), []
        for at in range(0, len(starts), SLICE):
            cut = offsets[at:at + SLICE + 1]
            chunks = pa.LargeStringArray.from_buffers(len(cut) - 1, pa.py_buffer(cut), buffer).dictionary_encode()
            pool, first, width = self._distinct(chunks.dictionary)
            of = chunks.indices.to_numpy()
            size = width[of]
            end = np.cumsum(size)
            parts.append(pool[np.repeat(first[of] - (end - size), size) + np.arange(end[-1])])
            sizes[at + 1:at + 1 + len(of)] = size
        flat = np.concatenate(parts) if parts else np.zeros(0, dtype="<u4")
        cuts = np.cumsum(sizes)[np.searchsorted(starts, bounds)].tolist()
        return [flat[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]

    def _encode_other(self, text: str) -> bytes:
        """A text with special strings, or one that is encoded whole."""
        parts = self.special.split(text) if self.specials else [text]
        return b"".join(
            array("I", [self.specials[part]]).tobytes() if k % 2
            else self._encode_plain([part])[0] if self._is_plain(part) else array("I", self.one(part)).tobytes()
            for k, part in enumerate(parts))

    def _distinct(self, chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct chunks in one array, and where each chunk's own start there and how many they are."""
        _, offsets, data = chunks.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[chunks.offset:chunks.offset + len(chunks) + 1]
        lengths = np.diff(offsets)
        data = np.frombuffer(data, dtype=np.uint8)
        # Only a word's last character is no white space.
        blank = _SPACE[data[offsets[1:] - 1]]
        words, pieces = np.flatnonzero(~blank), np.flatnonzero(blank)
        first, width = np.zeros(len(chunks), dtype=np.int64), np.zeros(len(chunks), dtype=np.int64)
        pool = np.zeros(0, dtype="<u4")
        if len(words):
            ends = np.cumsum(lengths[words] + 1) - 1  # of each word among the joined ones
            starts = ends - lengths[words]
            joined = data[np.minimum(np.repeat(offsets[words] - starts, lengths[words] + 1) + np.arange(ends[-1] + 1), len(data) - 1)]
            joined[ends] = 10
            pool = np.array(self.one(joined[:-1].tobytes().decode()), dtype="<u4")
            at = np.concatenate([[0], np.cumsum(self.token_bytes[pool])])
            first[words] = np.searchsorted(at, starts)
            width[words] = np.searchsorted(at, ends) - first[words]
        if len(pieces):
            ids = self._lookup(chunks.take(pa.array(pieces)).to_pylist())
            width[pieces] = [len(x) // 4 for x in ids]
            first[pieces] = len(pool) + np.cumsum(width[pieces]) - width[pieces]
            pool = np.concatenate([pool, np.frombuffer(b"".join(ids), dtype="<u4")])
        return pool, first, width

    def _lookup(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks, new ones encoded and the short ones of them kept."""
        out = []
        for c in chunks:
            ids = self.young.get(c)
            if ids is None:
                ids = self.old.get(c)
                if ids is None:
                    ids = array("I", self.one(c)).tobytes()
                if len(c) <= LONG:
                    self.young[c] = ids
                    self.held_bytes += ENTRY_BYTES + len(c) + len(ids)
            out.append(ids)
        if self.held_bytes > self.max_bytes:
            self.old, self.young, self.held_bytes = self.young, {}, 0
        return out


@lru_cache(maxsize=2)
def worker_encoder(path: str, pattern: str, specials: tuple[tuple[str, int], ...] = ()) -> ChunkEncoder:
    """One encoder for all tasks that a Python worker runs, so that each finds the chunks of the ones before."""
    return ChunkEncoder(path, pattern, specials=dict(specials))
