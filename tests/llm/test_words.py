"""Spelling variants and ranked search against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from checks import compare
from tests.llm.helpers import AWKWARD, frame, prose
from tradelane.llm import search, spelling
from tradelane.llm.textops import slices

SMALL = "/root/testdata/sf0.01"
AZ = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_ranked_search"])
def test_query_matches_sql(spark, name):
    assert compare.compare(spark, compare.connect(SMALL), name, entry.queries()[name],
                           entry.oracle_sql()[name], SMALL) is None


def test_checksums_go_on_from_a_prefix():
    r = random.Random(1)
    runs = [bytes(r.randrange(256) for _ in range(n)) for n in [0, 1, 2, 63, 64, 65, 5000, *range(10)]]
    data = np.frombuffer(b"".join(runs), np.uint8)
    ends = np.cumsum([len(x) for x in runs])
    before = np.array([zlib.crc32(str(i).encode()) for i in range(len(runs))])
    got = spelling.checksums(data, ends - [len(x) for x in runs], ends, before)
    assert got.tolist() == [zlib.crc32(str(i).encode() + x) for i, x in enumerate(runs)]


def test_letter_runs_of_awkward_texts():
    made = AWKWARD + ["aÀÿ×÷b Āa ſ\xbfß1x", "ÀÁ", "é" * 9]
    got = []
    for rows, f in slices(pa.record_batch({"text": pa.array(made, pa.string())})):
        base = len(got)
        got += [[] for _ in range(rows.num_rows)]
        for t, a, b, n in zip(*(x.tolist() for x in spelling.letter_runs(f)), strict=True):
            word = f.data[a:b].tobytes().decode()
            assert len(word) == n
            got[base + t].append(word)
    assert got == [re.findall("[A-Za-zÀ-ÿ]+", t or "") for t in made]


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows, min_length, min_count, ratio):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(AZ)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_length:
                count[run] += 1
    count = {w: n for w, n in count.items() if n >= min_count}
    close = {w: [v for v in count if near(w, v)] for w in count}
    best = {w: min(v, key=lambda x: (-count[x], x)) for w, v in close.items() if v}
    form = {w: b for w, b in best.items() if count[b] >= ratio * count[w]}
    out = set()
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(close[w]), count[form[w]] if w in form else None))
    return out


@pytest.mark.parametrize("symbols", [1, 3, 8])
def test_spelling_variants(spark, symbols):
    r = random.Random(symbols)
    base = ["".join(r.choice("abcABéÿ") for _ in range(r.randint(2, 6))) for _ in range(25)]

    def misspelt(w):
        i = r.randrange(len(w) + 1)
        return r.choice([w[:i] + "c" + w[i:], w[:i] + w[i + 1:], w[:i] + "é" + w[i + 1:], w])
    made = [" ".join(misspelt(r.choice(base[:1 + i % 25])) for _ in range(60)) for i in range(50)] + AWKWARD
    ids = [*range(len(made) - 3), None, 5, 5]
    docs = frame(spark, made, ids)
    for settings in ({"min_length": 2, "min_count": 1, "ratio": 2}, {"min_length": 4, "min_count": 2, "ratio": 3}):
        got = spelling.spelling_variants(docs, symbols=symbols, **settings)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        rows = [tuple(x) for x in got.collect()]
        assert len(rows) == len(set(rows))
        assert set(rows) == brute_variants(list(zip(ids, made, strict=True)), **settings)


def test_long_chain_of_forms(spark):
    chain = ["x" * (7 + i) for i in range(9)]
    made = [" ".join([w] * 2 ** i) for i, w in enumerate(chain)]
    rows = spelling.spelling_variants(frame(spark, made, [None] * 9), min_count=1, ratio=2).collect()
    want = brute_variants([(None, t) for t in made], 7, 1, 2)
    assert {tuple(r) for r in rows} == want and max(len(r.root) - len(r.word) for r in rows) > 4


def test_neighbourhoods_have_every_key_once():
    made = ["aab", "abc", "aaaa", "é", "zzzzzzzz"]
    for symbols in (1, 2, 8):
        found = [(w, k) for at, keys in spelling.neighbourhoods(made, symbols)
                 for w, k in zip(at.tolist(), keys.tolist(), strict=True)]
        assert len(found) == len(set(found))
        for i, w in enumerate(made):
            edits = {w} | {w[:j] + w[j + 1:] for j in range(len(w))} | {
                w[:j] + chr(c) + w[j + e:] for j in range(len(w) + 1) for e in (0, 1) for c in range(200, 208)
                if j + e <= len(w)}
            edits.discard("")
            keys = {k for at, k in found if at == i}
            assert set(spelling.reduced_keys(sorted(edits), symbols).tolist()) <= keys


def test_spelling_variants_of_nothing(spark):
    docs = frame(spark, ["short", None])
    assert spelling.spelling_variants(docs).count() == 0
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, top):
    split = [(d, Counter(TERM.findall((t or "").translate(AZ)))) for d, t in docs]
    split = [(d, c) for d, c in split if c]
    n_docs, n_terms = len(split), sum(c.total() for _, c in split)
    df = Counter(t for _, c in split for t in c)
    out = []
    for item, text in items:
        asked = set(TERM.findall((text or "").translate(AZ)))
        found = []
        for d, c in split:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                found.append((-score, d is not None, d or 0))
        found = sorted(found)[:top]
        out += [(item, i + 1, d if real else None, -s) for i, (s, real, d) in enumerate(found)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("shard_docs", "bundle_items", "top", "shard_postings"),
                         [(3, 2, 4, 10**6), (7, 50, 10, 20), (4096, 64, 1, 10**6)])
def test_search(spark, shard_docs, bundle_items, top, shard_postings):
    r = random.Random(shard_docs)
    made = [prose(i, r.randint(0, 60), 5 + i) for i in range(90)] + AWKWARD + ["the W1 w2"] * 5
    ids = [*range(len(made) - 5), 3, 3, None, None, -2]
    asked = [prose(1000 + i, 8, 60) for i in range(12)] + AWKWARD + ["W1", "nobody has this1"]
    item_ids = [*range(len(asked) - 2), 1, None]
    items = frame(spark, asked, item_ids).withColumnRenamed("doc_id", "item_id")
    got = search.search(frame(spark, made, ids), items, top, shard_docs=shard_docs, bundle_items=bundle_items,
                        shard_postings=shard_postings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute_search(list(zip(ids, made, strict=True)), list(zip(item_ids, asked, strict=True)), top)
    assert sorted((tuple(x) for x in got.collect()), key=repr) == want


def test_search_of_nothing(spark):
    docs = frame(spark, ["a b", None])
    items = docs.withColumnRenamed("doc_id", "item_id")
    assert search.search(docs.limit(0), items).count() == 0
    assert search.search(docs, items.limit(0)).count() == 0
    assert search.search(docs.where("text is null"), items).count() == 0
