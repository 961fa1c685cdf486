"""Whole Arrow batches of texts as flat numpy arrays: words, lines, rolling word windows.

Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes, which is the same as of the code points.
Hashes are polynomials modulo 2**64 read off prefix sums, mixed with the length.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):  # not glibc
    _trim = None

U = np.uint64
STEP = 1 << 18  # by which tables of powers grow; a worker keeps them
SLICE_BYTES = 1 << 20  # texts are worked on in slices of about this size; one longer text is one slice

_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True


def byte_class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as were needed so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = -(-n // STEP) * STEP
            self.up = np.cumprod(np.concatenate([[U(1)], np.full(n, self.base, U)]))
            self.down = np.cumprod(np.concatenate([[U(1)], np.full(n, self.inverse, U)]))
        return self.up, self.down


# two bases that are 5 modulo 8: differences of their powers keep almost all bits
_BYTES = [_Powers(0x9E3779B97F4A7C15), _Powers(0xD6E8FEB86659FD95)]
_WORDS = [_Powers(0xA0761D6478BD642D), _Powers(0xE7037ED1A0B428DD)]
_TABLES = [mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) for seed in (11, 29)]


@dataclass
class Flat:
    """Texts one after another: ``data[offsets[i]:offsets[i+1]]`` is text i."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, "right") - 1

    def pieces(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, start and end of each stretch of marked bytes, cut at the ends of texts."""
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edge = self.offsets[(self.offsets > 0) & (self.offsets < len(self.data))]
        first[edge] |= inside[edge]
        last[edge - 1] |= inside[edge - 1]
        starts = np.flatnonzero(first)
        return self.text_of(starts), starts, np.flatnonzero(last) + 1

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.pieces(~_SEP[self.data])

    @cached_property
    def _prefix(self) -> list[np.ndarray]:
        out = []
        for table, powers in zip(_TABLES, _BYTES, strict=True):
            up, _ = powers.get(len(self.data) + 1)
            out.append(np.concatenate([[U(0)], np.cumsum(table[self.data] * up[:len(self.data)])]))
        return out

    def hashes(self, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each stretch of bytes."""
        _, down = _BYTES[which].get(len(self.data) + 1)
        p = self._prefix[which]
        return mix((p[ends] - p[starts]) * down[starts] + (ends - starts).astype(U))

    def windows(self, k: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First word (index into ``words``) and hash of every window of k words of one text."""
        text, starts, ends = self.words
        n = len(text)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, U)
        up, down = _WORDS[which].get(n + 1)
        p = np.concatenate([[U(0)], np.cumsum(self.hashes(starts, ends, which) * up[:n])])
        at = np.flatnonzero(text[:n - k + 1] == text[k - 1:])
        return at, mix((p[at + k] - p[at]) * down[at] + U(k))

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r"""Text, start and end of each line with a word, texts cut at \n."""
        text, starts, ends = self.pieces(self.data != 10)
        words = np.concatenate([[0], np.cumsum(~_SEP[self.data], dtype=np.int64)])
        real = words[ends] > words[starts]
        return text[real], starts[real], ends[real]


def lowered(f: Flat) -> Flat:
    """The texts with A-Z lower-cased, and nothing else."""
    big = (f.data >= 0x41) & (f.data <= 0x5A)
    return Flat(f.data + (big * np.uint8(0x20)), f.offsets)


def repeated(keys: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of keys found twice or more within their text, and of those with an equal key before."""
    own = mix(keys + texts.astype(U) * U(0x9E3779B97F4A7C15))
    order = np.argsort(own, kind="stable")
    same = own[order[1:]] == own[order[:-1]]
    later, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return any_, later


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Marks of the n words under windows of k words from the given starts."""
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + k, -1)
    return np.cumsum(edges[:n]) > 0


def flat(texts: pa.Array) -> Flat:
    """Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    whole = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
    body = whole.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return Flat(data[offsets[0]:offsets[-1]], offsets - offsets[0])


def give_back() -> None:
    """Memory that Arrow and numpy hold but do not use goes to the system: a worker lives on, idle, through other stages."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[tuple[pa.RecordBatch, Flat]]:
    """The batch in slices of about SLICE_BYTES of text; then unused memory is given back."""
    if not batch.num_rows:
        return
    whole = flat(batch.column(text))
    cuts = [0]
    while cuts[-1] < batch.num_rows:
        ahead = np.searchsorted(whole.offsets, whole.offsets[cuts[-1]] + SLICE_BYTES, "right") - 1
        cuts.append(int(min(batch.num_rows, max(cuts[-1] + 1, ahead))))
    for a, b in zip(cuts, cuts[1:], strict=False):
        o = whole.offsets[a:b + 1]
        yield batch.slice(a, b - a), Flat(whole.data[o[0]:o[-1]], o - o[0])
    del whole
    give_back()
