"""Token ids of whole texts, each distinct word of a task encoded once.

The pattern of a byte-level BPE never joins a word with what stands before the one space that
leads it, nor a letter with a sign after it, so a text is cut there, every distinct cut is encoded by
the tokenizer, and the ids are put together again. Texts with white space beyond ASCII's, or with a
token that was added to the vocabulary (such as an end of text), are given to the tokenizer whole.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np

from .textops import Flat, byte_class, mix

MOST_CUTS = 800_000  # remembered by a worker; beyond that it starts anew

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = byte_class("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SIGN = byte_class("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        self.start, self.size = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)

    def _learn(self, hashes: list[int], cuts: list[str]) -> None:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(cuts, add_special_tokens=False)]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum()))
        at = len(self.known)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while at + len(size) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.start[at:at + len(size)] = self.used + np.cumsum(size) - size
        self.size[at:at + len(size)] = size
        self.known.update(zip(hashes, range(at, at + len(size)), strict=True))
        self.used += len(ids)

    def _odd(self, f: Flat) -> np.ndarray:
        """Texts with white space that is not ASCII's, with control characters near it, or with added tokens."""
        d = f.data
        odd = (d >= 0x1C) & (d <= 0x1F)
        if len(d) > 1 and (d >= 0x80).any():
            odd[:-1] |= (d[:-1] == 0xC2) & ((d[1:] == 0x85) | (d[1:] == 0xA0))
            two = d[:-2].astype(np.uint32) << 16 | d[1:-1].astype(np.uint32) << 8 | d[2:]
            odd[:-2] |= ((two >= 0xE28080) & (two <= 0xE2808A)) | np.isin(
                two, [0xE19A80, 0xE1A08E, 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])
        raw = f.data.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                odd[at] = True
                at = raw.find(token, at + 1)
        return f.per_text(odd) > 0

    @staticmethod
    def _cuts(f: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, start and end of the cuts, in order: words with one leading space, white space."""
        space = _SPACE[f.data]
        text, starts, ends = f.pieces(~space)
        if len(f.data) > 1:  # a letter and a sign after it are never in one token
            turn = np.flatnonzero(_LETTER[f.data[:-1]] & _SIGN[f.data[1:]]) + 1
            turn = turn[f.offsets[f.text_of(turn)] != turn]
            starts, ends = np.sort(np.concatenate([starts, turn])), np.sort(np.concatenate([ends, turn]))
            text = f.text_of(starts)
        gap_text, a, b = f.pieces(space)
        if not len(gap_text):
            return text, starts, ends
        last = b == f.offsets[gap_text + 1]  # at the end of its text: one cut
        led = ~last & (f.data[b - 1] == 0x20)
        lead = np.zeros(len(f.data) + 1, bool)
        lead[b[led]] = True
        starts = starts - lead[starts]
        rest = np.where(last, b, b - 1)
        single = ~last & ~led
        text = np.concatenate([text, gap_text[rest > a], gap_text[single]])
        starts = np.concatenate([starts, a[rest > a], b[single] - 1])
        ends = np.concatenate([ends, rest[rest > a], b[single]])
        order = np.argsort(starts, kind="stable")
        return text[order], starts[order], ends[order]

    def __call__(self, f: Flat) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin (and the end)."""
        if len(self.known) > MOST_CUTS:
            self._forget()
        text, starts, ends = self._cuts(f)
        odd = np.flatnonzero(self._odd(f))
        plain = ~np.isin(text, odd)
        text, starts, ends = text[plain], starts[plain], ends[plain]
        h = f.hashes(starts, ends)
        if len(odd):  # each of these is one cut
            text = np.concatenate([text, odd])
            starts, ends = np.concatenate([starts, f.offsets[odd]]), np.concatenate([ends, f.offsets[odd + 1]])
            h = np.concatenate([h, mix(f.hashes(f.offsets[odd], f.offsets[odd + 1], 1))])
            order = np.argsort(text, kind="stable")
            text, starts, ends, h = text[order], starts[order], ends[order], h[order]
        own, first, back = np.unique(h, return_index=True, return_inverse=True)
        names = own.tolist()
        new = [i for i, x in enumerate(names) if x not in self.known]
        if new:
            raw = f.data.tobytes()
            at = first[new]
            self._learn([names[i] for i in new],
                        [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        where = np.fromiter((self.known[x] for x in names), np.int64, len(names))[back]
        size = self.size[where]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(self.start[where] - total[:-1], size) + np.arange(total[-1])]
        per_text = np.bincount(text, size, f.n).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_text)])


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of a worker, which keeps what it has learnt (MOST_CUTS bound it) from task to task."""
    return Encoder(path)
