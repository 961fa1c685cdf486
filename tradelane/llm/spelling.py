r"""Spelling variants of a corpus's vocabulary by reduced-alphabet generation.

Words are counted over all texts, combined per slice before Spark adds them up. Every letter of a
word is hashed to one of SYMBOLS symbols, which gives its reduced word; one edit of a word is one
edit of its reduced word or none. So each word generates the reduced word itself and its full
neighbourhood of one edit (deletions, replacements, insertions, each once) as keys, the keys are
joined with the reduced vocabulary, and the pairs found are verified on the original words. A
filter of bounded size over the reduced vocabulary keeps most keys that nobody has out of the shuffle.

Only a word's neighbours share its keys, so there is no hot key: a key has no more words than the
alphabet allows for one reduced word. A word's form has ten times its count, so chains of forms are
short; they are followed by doubling.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import filter_of, may_hold
from .tables import cut, texts
from .textops import Flat, byte_class, lowered, mix, slices

MIN_LENGTH = 7  # code points of a word
MIN_COUNT = 2  # occurrences of a word
RATIO = 10  # a form occurs at least so many times as often
DROP = 31  # a run whose checksum this divides loses a code point
SYMBOLS = 8
LONG_RUN = 64  # bytes; longer runs are checked one by one
BATCH = 4096  # words whose neighbourhoods are made at a time
U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTER = byte_class("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each stretch of bytes, going on from the crc32 of what stands before it."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    order = order[np.searchsorted(-size[order], -LONG_RUN):]
    state, at = ~before[order].astype(np.uint32), starts[order]
    longest = int(size[order[0]]) if len(order) else 0
    left = np.searchsorted(-size[order], -np.arange(longest), "left")  # those longer than j bytes come first
    for j, k in enumerate(left.tolist()):
        state[:k] = _CRC[(state[:k] ^ data[at[:k] + j]) & np.uint32(255)] ^ (state[:k] >> np.uint32(8))
    out = np.zeros(len(size), np.int64)
    out[order] = ~state
    for i in np.flatnonzero(size > LONG_RUN).tolist():
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(before[i]))
    return out


def letter_runs(f: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    r"""Text, start, end and code points of each maximal run of A-Z, a-z and U+00C0 to U+00FF."""
    lead = f.data == 0xC3  # U+00C0 to U+00FF are C3 80 to C3 BF
    inside = _LETTER[f.data] | lead
    inside[1:] |= lead[:-1]
    text, starts, ends = f.pieces(inside)
    leads = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])
    return text, starts, ends, (ends - starts) - (leads[ends] - leads[starts])


def _count(min_length: int):
    """The words of each slice with their number, runs with a telling checksum shortened."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, f in slices(batch):
                f = lowered(f)
                text, starts, ends, size = letter_runs(f)
                long_ = size >= min_length
                text, starts, ends, size = text[long_], starts[long_], ends[long_], size[long_]
                before = np.array([zlib.crc32(f"{'' if d is None else d}:".encode())
                                   for d in rows.column("doc_id").to_pylist()], np.int64)
                crc = checksums(f.data, starts, ends, before[text])
                cut_short = crc % DROP == 0
                raw = f.data.tobytes()
                own, first, n = np.unique(f.hashes(starts, ends)[~cut_short], return_index=True, return_counts=True)
                a, b = starts[~cut_short][first].tolist(), ends[~cut_short][first].tolist()
                words, counts = [raw[x:y].decode() for x, y in zip(a, b, strict=True)], n.tolist()
                for x, y, k in zip(starts[cut_short].tolist(), ends[cut_short].tolist(),
                                   (crc % np.maximum(size, 1))[cut_short].tolist(), strict=True):
                    word = raw[x:y].decode()
                    word = word[:k] + word[k + 1:]
                    if len(word) >= min_length:
                        words.append(word)
                        counts.append(1)
                yield pa.record_batch([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])
    return run


def _by_length(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of one length and their reduced words, a row of symbols (from 1) each."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        points = np.frombuffer("".join(words[i] for i in at.tolist()).encode("utf-32-le"), "<u4").reshape(len(at), n)
        yield at, points.astype(U) % U(symbols) + U(1)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[U(1)], np.full(n, _BASE, U)]))


def _key(value: np.ndarray, length: int) -> np.ndarray:
    return mix(value + U(length * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)).view(np.int64)


def reduced_keys(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """A key of each word's reduced word."""
    out = np.zeros(len(words), np.int64)
    for at, s in _by_length(words, symbols):
        n = s.shape[1]
        out[at] = _key((s * _powers(n)[:n]).sum(1, dtype=U), n)
    return out


def neighbourhoods(words: list[str], symbols: int = SYMBOLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word (its place) and key of every reduced word at most one edit from the word's own, each once."""
    for at, s in _by_length(words, symbols):
        n = s.shape[1]
        up = _powers(n + 1)
        terms = s * up[:n]
        before = np.concatenate([np.zeros((len(at), 1), U), np.cumsum(terms, axis=1, dtype=U)], axis=1)
        whole = before[:, -1:]
        yield at, _key(whole[:, 0], n)
        # of equal symbols side by side, deleting the first is enough
        rest = before[:, :-1] + (whole - before[:, 1:]) * U(_INVERSE)
        new = np.ones(s.shape, bool)
        new[:, 1:] = s[:, 1:] != s[:, :-1]
        yield np.repeat(at, new.sum(1)), _key(rest[new], n - 1)
        after = np.concatenate([s, np.zeros((len(at), 1), U)], axis=1)
        for x in range(1, symbols + 1):
            other = s != U(x)
            yield np.repeat(at, other.sum(1)), _key((whole + (U(x) - s) * up[:n])[other], n)
            # a symbol put before its equal is the same as behind it
            place = after != U(x)
            more = before + U(x) * up[:n + 1] + (whole - before) * U(_BASE)
            yield np.repeat(at, place.sum(1)), _key(more[place], n + 1)


def _with_key(symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("key", pa.array(reduced_keys(b.column("word").to_pylist(), symbols), pa.int64()))
    return run


def _generate(held, symbols: int):
    """Each word once per key of its neighbourhood that the reduced vocabulary may hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH):
                b = batch.slice(a, BATCH)
                words, ns = b.column("word"), b.column("n")
                for at, keys in neighbourhoods(words.to_pylist(), symbols):
                    real = may_hold(held, keys)
                    take = pa.array(at[real])
                    yield pa.record_batch([pa.array(keys[real]), words.take(take), ns.take(take)], ["key", "word", "n"])
    return run


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n of the words of all texts that are long and frequent enough."""
    counted = texts(docs, id_col, text_col).mapInArrow(_count(min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, n, near, near_n for every two words of ``words`` (word, n) that are one edit apart, both ways."""
    reduced = cut(words.mapInArrow(_with_key(symbols), "word string, n long, key long"), "reduced-words")
    generated = reduced.drop("key").mapInArrow(_generate(filter_of(reduced, "key"), symbols),
                                               "key long, word string, n long")
    pairs = generated.join(reduced.toDF("near", "near_n", "key"), "key")
    return pairs.where(F.levenshtein("word", "near", 1) == 1).drop("key")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of every word with a form: the end of its chain. Each round doubles the steps."""
    on = forms.toDF("word", "root")
    while True:
        ahead = on.toDF("at", "next")
        both = cut(on.join(ahead, on["root"] == ahead["at"], "left").select("word", "root", "next"), "roots")
        on = both.select("word", F.coalesce("next", "root").alias("root"))
        if both.where("next is not null").isEmpty():
            return on


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
                      symbols: int = SYMBOLS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Null and empty texts have no words; a null id counts as an empty one in the checksum. Long texts are
    read whole, as one slice. Rows that repeat count as often as they stand there. Of near words that
    are equally frequent the smallest in code-point order is the form. Other columns of ``docs`` are
    not looked at. An empty table gives no rows.
    """
    words = cut(vocabulary(docs, min_length, min_count, id_col, text_col), "vocabulary")
    near = near_words(words, symbols).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best_n = -F.col("best.less")
    found = cut(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(best_n >= F.col("n") * ratio, F.col("best.near")).alias("form"),
        F.when(best_n >= F.col("n") * ratio, best_n).alias("form_n")), "forms")
    roots = _roots(found.where("form is not null").select("word", "form"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
