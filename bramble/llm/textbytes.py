"""Words and rolling hashes of many texts at once, in numpy.

Words are [^\\x20\\x09-\\x0D]+ of the UTF-8 bytes. Texts are joined with a line break, so no
word crosses two of them. Every word has two 64-bit numbers. Hashes of runs of words are
polynomials modulo 2^64 over such numbers, from prefix sums, with a final mix; two runs agree
on a hash when they agree on the words, and else with odds of about 2^-64 a pair.
"""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_128_digest

_BLANK = b" " * 8
_BLANKS = np.uint64(int.from_bytes(_BLANK, "little"))
_SALTS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """hash(values[i:j]) for any i < j after one pass, as (P[j] - P[i]) / base^i."""

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base | 1), np.uint64(pow(base | 1, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, self.base)]), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, self.inverse)]), dtype=np.uint64)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[:len(values)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.down[start])


class Words:
    """Reader of batches of texts: word spans, their document, and two 64-bit numbers a word.

    Words of up to eight bytes are numbered by their bytes themselves, so two of them differ
    in both numbers; longer ones by the halves of their XXH3-128."""

    def __init__(self):
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.kept = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n bytes of eight
        self.of_words = Rolling(0xC2B2AE3D27D4EB4F)
        self.of_words_again = Rolling(0x9E3779B97F4A7C15)

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document offsets in words, length n + 1; first and second numbers of the words;
        word starts in bytes)."""
        raw = b"\n".join(texts) + b"\n" + _BLANK  # any eight bytes from a word's start exist
        joined = np.frombuffer(raw, np.uint8)
        blank = self.space[joined]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank])))
        start, end = edge[0::2], edge[1::2]
        ends_at = np.cumsum([len(t) + 1 for t in texts])
        docs = np.concatenate([[0], np.searchsorted(start, ends_at)])
        size = end - start
        eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))  # the eight bytes from every place
        kept = self.kept[np.minimum(size, 8)]
        # a word has no blank, so filling with blanks keeps the length
        bytes_ = (eight[start] & kept) | (_BLANKS & ~kept)
        first, second = mix(bytes_ ^ _SALTS[0]), mix(bytes_ ^ _SALTS[1])
        long = np.flatnonzero(size > 8)
        if len(long):
            digests = b"".join([xxh3_128_digest(raw[i:j]) for i, j in zip(start[long].tolist(), end[long].tolist())])
            halves = np.frombuffer(digests, np.uint64).reshape(-1, 2)
            first[long], second[long] = halves[:, 0], halves[:, 1]
        return docs, first, second, start
