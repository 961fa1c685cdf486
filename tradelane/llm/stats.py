"""Statistics of whole texts, many texts at once."""

from __future__ import annotations

import numpy as np

from .textops import Flat, byte_class, covered, mix, repeated

WINDOW = 8
_SYMBOL = byte_class("#*$%&|<>")
_UPPER = byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = byte_class("abcdefghijklmnopqrstuvwxyz")
_DIGIT = byte_class("0123456789")
_STOP = byte_class(".!?")
_COMMA = byte_class(",;:")
_BANG = byte_class("!")
_OTHER = byte_class("()[]{}/\\@_=+~^\"'-`")

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def counts(f: Flat) -> dict[str, np.ndarray]:
    """The five base counts of each text, whole texts."""
    text, starts, ends = f.words
    chars = np.concatenate([[0], np.cumsum((f.data & 0xC0) != 0x80, dtype=np.int64)])
    at, hashes = f.windows(WINDOW)
    twice, _ = repeated(hashes, text[at])
    under = covered(at[twice], WINDOW, len(text))
    lines, a, b = f.lines
    _, later = repeated(f.hashes(a, b), lines)
    n = f.n
    return {
        "n_words": np.bincount(text, minlength=n),
        "word_chars": np.bincount(text, chars[ends] - chars[starts], n).astype(np.int64),
        "n_symbols": f.per_text(_SYMBOL[f.data]),
        "n_dup_lines": np.bincount(lines[later], minlength=n),
        "n_repeat_words": np.bincount(text[under], minlength=n),
        "n_lines": np.bincount(lines, minlength=n),
    }


#: +1: never less likely good with more of it; -1: never more likely good.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "distinct_share": 1,
            "bang_share": -1}
FEATURES = ["log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share",
            "upper_share", "lower_share", "digit_share", "stop_share", "comma_share", "bang_share",
            "other_share", "distinct_share", "words_a_line", "wide_share", "long_words",
            "short_words", "top_word", "symbol_words"]


def features(f: Flat, c: dict[str, np.ndarray]) -> np.ndarray:
    """One row of FEATURES per text; empty texts give zeros."""
    text, starts, ends = f.words
    n = f.n
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    size = ends - starts
    h = f.hashes(starts, ends)
    _, kept, runs = np.unique(mix(h + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                              return_index=True, return_counts=True)
    distinct_of = text[kept]
    top = np.zeros(n, np.int64)
    np.maximum.at(top, distinct_of, runs)
    last = f.data[np.maximum(ends - 1, 0)] if len(ends) else np.zeros(0, np.uint8)
    of = lambda mask: f.per_text(mask[f.data]) / chars
    cols = {
        "log_words": np.log1p(c["n_words"]),
        "mean_word": c["word_chars"] / words,
        "symbol_share": c["n_symbols"] / chars,
        "dup_line_share": c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
        "repeat_share": c["n_repeat_words"] / words,
        "upper_share": of(_UPPER), "lower_share": of(_LOWER), "digit_share": of(_DIGIT),
        "stop_share": f.per_text(_STOP[f.data]) / words, "comma_share": f.per_text(_COMMA[f.data]) / words,
        "bang_share": f.per_text(_BANG[f.data]) / words, "other_share": of(_OTHER),
        "distinct_share": np.bincount(distinct_of, minlength=n) / words,
        "words_a_line": np.log1p(c["n_words"] / np.maximum(c["n_lines"], 1)),
        "wide_share": f.per_text(f.data >= 0x80) / chars,
        "long_words": np.bincount(text[size > 12], minlength=n) / words,
        "short_words": np.bincount(text[size < 3], minlength=n) / words,
        "top_word": top / words,
        "symbol_words": np.bincount(text[_SYMBOL[last]], minlength=n) / words,
    }
    return np.stack([cols[k] for k in FEATURES], 1).astype(np.float64)
